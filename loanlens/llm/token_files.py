"""Token ids as flat unsigned integer files with 64-bit document offsets (op 11).

Documents are dealt to shards by ranges of their id and sorted inside, so that
shard order and place in the shard are ascending id order over the whole table.
A shard's task encodes its texts as they come and appends to three flat files
below one folder:

* ``shard-N.ids``  token ids, unsigned 16 bits wide (32 for larger vocabularies), little-endian
* ``shard-N.idx``  64-bit offsets into them: one per document and the end
* ``shard-N.doc``  64-bit document ids, in the same order

The folder's ``manifest`` (Parquet) has one row per shard: documents, ids, and
its base, that is how many ids and documents lie in the shards before it
(prefix sums over the shards' counts, in two levels). It is written last, so a
folder without a manifest isn't complete. Readers map the files into memory
and take the slices they need; global position = base + offset.

Each file is written under a name of the attempt and then renamed; a repeated
task replaces it by the same bytes. Folders of other stores than local disks
go through ``pyarrow.fs`` and are read by ranges.

Encoding: the text pieces between safe cuts (a space before a visible
character, a mark after a letter) are encoded once per task by the tokenizers library and laid out by
index after that; where a tokenizer's own settings don't make such cuts safe,
whole texts are encoded. The result is that of encoding the whole text.

Scale: one shuffle (of the texts, by range of id), no text or id on the driver.
A range is split by a hash of the text where one id repeats on many rows.

Edge cases: null and empty texts have just the end id; null ids come first;
rows of one id follow each other by a hash of their text, equal rows each have
their ids; an empty table gives an empty result; other columns are ignored.
Ids must be whole numbers.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlens.session import checkpoint_dir

from .common import ship_package, text_chunks

#: Text bytes per shard; small tables have a shard per core.
SHARD_BYTES = 128 << 20
#: Documents per reading step.
READ_DOCS = 4_096
#: Text bytes per step, pieces per call of the library, and ids kept for pieces met before.
_STEP_BYTES = 4 << 20
_ENCODE, _JOIN = 16_384, 1_024
_CACHE_IDS = 3 << 19
# Bytes after which a space may not be cut off: white space and control bytes,
# and the lead bytes of all Unicode white space above them.
_AFTER_SPACE = np.ones(256, dtype=bool)
_AFTER_SPACE[:0x21] = False
_AFTER_SPACE[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False
_VISIBLE = frozenset(np.flatnonzero(_AFTER_SPACE).tolist())
# Marks that begin a piece of their own after an ASCII letter or digit.
_MARKS = b",.;:!?)"
_LETTERS = np.array([chr(b).isalnum() and b < 128 for b in range(256)])


# ------------------------------------------------------------------ encoding

def cuts_are_safe(spec: dict) -> bool:
    """Whether a space before a visible character, and a mark after a letter, always begin a new piece of this tokenizer."""
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not any(map(str.isspace, t["content"])) and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                for t in spec.get("added_tokens", ()))
    return (plain and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space", True))


class Encoder:
    """Token ids of text columns through the tokenizers library, each distinct piece once.

    Pieces met before are looked up; when there are too many, those met in one
    step only are forgotten.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        self.tokenizer = Tokenizer.from_str(spec)
        parsed = json.loads(spec)
        self.safe = cuts_are_safe(parsed)
        special = "".join(t["content"] for t in parsed.get("added_tokens", ()))
        self.marks = np.zeros(256, bool)
        self.marks[[b for b in _MARKS if chr(b) not in special]] = True
        self.widths = _token_bytes(self.tokenizer, parsed) if self.safe else None
        self.known: dict[bytes, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.place, self.size, self.met = (np.zeros(0, np.int32) for _ in range(3))

    def _encode(self, texts: list[bytes]) -> list[list[int]]:
        run = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [e.ids for e in run([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces, some thousand at a time, as the library's results are large.

        Pieces that begin with a cut at a space are encoded together: joined
        they give the same ids, and the widths of the ids part them again.
        """
        joint = [p for p in pieces if len(p) > 1 and p[0] == 0x20 and p[1] in _VISIBLE and (p.isascii() or _valid(p))
                 ] if self.safe else []
        for i in range(0, len(joint), _ENCODE):
            part = joint[i: i + _ENCODE]
            lists = self._encode([b"".join(part[k: k + _JOIN]) for k in range(0, len(part), _JOIN)])
            ids = np.fromiter(chain.from_iterable(lists), np.uint32, sum(map(len, lists)))
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
            upto = np.searchsorted(np.cumsum(self.widths[ids]), ends, "left") + 1
            self._keep(part, ids, np.diff(upto, prepend=0))
        together = set(joint)
        rest = [p for p in pieces if p not in together]
        for i in range(0, len(rest), _ENCODE):
            part = rest[i: i + _ENCODE]
            lists = self._encode(part)
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            self._keep(part, np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum())), size)

    def _keep(self, pieces: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used // 4 + len(ids) + (1 << 16), np.uint32)])
        self.ids[self.used: self.used + len(ids)] = ids
        self.place = np.concatenate([self.place, (self.used + np.cumsum(size) - size).astype(np.int32)])
        self.size = np.concatenate([self.size, size.astype(np.int32)])
        self.met = np.concatenate([self.met, np.zeros(len(size), np.int32)])
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.used += len(ids)

    def _forget(self) -> None:
        stay = np.flatnonzero(self.met > 1)
        if self.size[stay].sum() > _CACHE_IDS // 2:
            stay = stay[:0]
        size, place, ids = self.size[stay].astype(np.int64), self.place[stay], self.ids
        flat = ids[np.arange(size.sum()) + np.repeat(place - (np.cumsum(size) - size), size)]
        pieces = list(self.known)
        pieces = [pieces[i] for i in stay]
        self.known, self.ids, self.used = {}, np.zeros(len(flat) + (1 << 16), np.uint32), 0
        self.place, self.size, self.met = (np.zeros(0, np.int32) for _ in range(3))
        self._keep(pieces, flat, size)

    def _starts(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """First byte of every piece: at documents, at spaces before a visible character, at marks after a letter or digit."""
        begin = np.zeros(len(data), bool)
        filled = offs[:-1] < offs[1:]
        if self.safe:
            begin[:-1] = (data[:-1] == 0x20) & _AFTER_SPACE[data[1:]]
            begin[offs[1:][filled] - 1] = False
            begin[1:] |= self.marks[data[1:]] & _LETTERS[data[:-1]]
        begin[offs[:-1][filled]] = True
        return np.flatnonzero(begin)

    def chunks(self, column: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids with an end id after each document, ids per document) of pieces of a text column."""
        for first, last, data, offs in text_chunks(column, _STEP_BYTES):
            starts = self._starts(data, offs) if len(data) else np.zeros(0, np.int64)
            bounds = np.append(starts, len(data)).astype(np.int32)
            pieces = pa.Array.from_buffers(pa.binary(), len(starts), [
                None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
            distinct = pieces.dictionary.to_pylist()
            if self.used > _CACHE_IDS:
                self._forget()
            new = [p for p in distinct if p not in self.known]
            if new:
                self._learn(new)
            number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
            self.met[number] += 1
            which = number[pieces.indices.to_numpy(zero_copy_only=False)]
            n, place = self.size[which].astype(np.int64), self.place[which]
            doc = np.searchsorted(offs, starts, "right") - 1
            counts = np.bincount(doc, weights=n, minlength=last - first).astype(np.int64)
            run = np.arange(n.sum())
            ids = np.full(len(run) + last - first, end_id, "<u4")
            ids[run + np.repeat(doc, n)] = self.ids[run + np.repeat(place - (np.cumsum(n) - n), n)]
            yield first, ids, counts + 1


def _valid(piece: bytes) -> bool:
    try:
        piece.decode()
    except UnicodeDecodeError:
        return False
    return True


def _token_bytes(tokenizer, spec: dict) -> np.ndarray:
    """Bytes of text that each id of a byte-level vocabulary stands for (one letter of the vocabulary is one byte)."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
    for token, i in vocabulary.items():
        width[i] = len(token)
    for added in spec.get("added_tokens", ()):
        width[added["id"]] = len(added["content"].encode())
    return width


@lru_cache(maxsize=1)
def _encoder(spec: str) -> Encoder:
    return Encoder(spec)


# --------------------------------------------------------------------- files

def store_of(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a path or address."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return (pafs.LocalFileSystem(), folder) if "://" not in folder else pafs.FileSystem.from_uri(folder)


def _flat(folder: str, name: str, dtype: str):
    """A flat file as an array to slice: mapped into memory, or read by ranges where it isn't local."""
    fs, path = store_of(f"{folder}/{name}")
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    return _Ranges(fs.open_input_file(path), np.dtype(dtype))


class _Ranges:
    def __init__(self, file, dtype: np.dtype):
        self.file, self.dtype = file, dtype

    def __getitem__(self, part: slice) -> np.ndarray:
        w = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((part.stop - part.start) * w, part.start * w), self.dtype)


def _written(batches: Iterator[pa.RecordBatch], folder: str, spec: str, end_id: int, width: str) -> tuple:
    """Write this task's shard; (shard, documents, documents with a null id, ids)."""
    task = TaskContext.get()
    shard = task.partitionId()
    fs, base = store_of(folder)
    fs.create_dir(base, recursive=True)
    names = {kind: f"{base}/shard-{shard:06d}.{kind}" for kind in ("ids", "idx", "doc")}
    temp = {kind: f"{name}.{task.taskAttemptId()}.tmp" for kind, name in names.items()}
    out = {kind: fs.open_output_stream(name) for kind, name in temp.items()}
    docs = nulls = total = 0
    encoder = _encoder(spec)
    out["idx"].write(np.zeros(1, "<i8").tobytes())
    for batch in batches:
        key = batch.column(0)
        docs, nulls = docs + len(key), nulls + key.null_count
        out["doc"].write(key.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        for _, ids, counts in encoder.chunks(batch.column(1), end_id):
            out["ids"].write(ids.astype(width).tobytes())
            out["idx"].write((total + np.cumsum(counts)).astype("<i8").tobytes())
            total += int(counts.sum())
    for kind, stream in out.items():
        stream.close()
        fs.move(temp[kind], names[kind])
    return shard, docs, nulls, total


def _with_bases(shards: DataFrame) -> DataFrame:
    """Each shard's base: ids and documents of all shards before it (prefix sums over groups of shards, then inside)."""
    grouped = shards.withColumn("lot", F.expr("shard div 1024"))
    lots = grouped.groupBy("lot").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    before = Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select("lot", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"lot_{c}") for c in "dt"])
    inside = Window.partitionBy("lot").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    put = lambda c, lot: (F.col(lot) + F.coalesce(F.sum(c).over(inside), F.lit(0))).cast("long")
    return grouped.join(lots, "lot").select(
        "shard", "docs", "nulls", "tokens", put("docs", "lot_d").alias("first_doc"),
        put("tokens", "lot_t").alias("first_token"), "width")


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 0, folder: str | None = None,
                      shard_bytes: int = SHARD_BYTES) -> str:
    """Encode ``docs`` (doc_id, text) into flat files; the folder that holds them and their manifest."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    from tokenizers import Tokenizer

    top = max(end_id, Tokenizer.from_str(text).get_vocab_size(with_added_tokens=True) - 1)
    width = "<u2" if top < 1 << 16 else "<u4"
    spec = spark.sparkContext.broadcast(text)      # one vocabulary file
    folder = folder or f"{checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-size // shard_bytes))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64(F.coalesce("text", F.lit("")))]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def write(batches):
        shard, count, nulls, total = _written(batches, folder, spec.value, end_id, width)
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int64()), "docs": pa.array([count], pa.int64()),
            "nulls": pa.array([nulls], pa.int64()), "tokens": pa.array([total], pa.int64()),
            "width": pa.array([width])})

    shards = dealt.mapInArrow(write, "shard long, docs long, nulls long, tokens long, width string")
    counts = f"{folder}/counts"
    shards.write.parquet(counts)
    _with_bases(spark.read.parquet(counts)).write.parquet(f"{folder}/manifest")
    return folder


def _read(spark: SparkSession, folder: str, step: int, rows, schema: str) -> DataFrame:
    """``rows(doc ids, offsets, base, ids)`` of every ``step`` documents, read from the files by Spark tasks."""
    ship_package(spark)
    manifest = spark.read.parquet(f"{folder}/manifest").where("docs > 0")
    from_doc = F.explode(F.sequence(F.lit(0).cast("long"), F.col("docs") - 1, F.lit(step).cast("long")))
    pieces = manifest.withColumn("lo", from_doc).select(
        "shard", "nulls", "first_token", "width", "lo", F.least(F.col("lo") + step, F.col("docs")).alias("hi"))

    def read(batches):
        for batch in batches:
            for p in batch.to_pylist():
                name, lo, hi = f"shard-{p['shard']:06d}", p["lo"], p["hi"]
                at = np.asarray(_flat(folder, f"{name}.idx", "<i8")[lo: hi + 1])
                doc = np.asarray(_flat(folder, f"{name}.doc", "<i8")[lo: hi])
                ids = np.asarray(_flat(folder, f"{name}.ids", p["width"])[int(at[0]): int(at[-1])])
                yield rows(pa.array(doc, pa.int64(), mask=np.arange(lo, hi) < p["nulls"]), at, p["first_token"], ids)

    return pieces.repartition("shard", "lo").mapInArrow(read, schema)


def read_token_files(spark: SparkSession, folder: str, step: int = READ_DOCS) -> DataFrame:
    """(doc_id, start, ids) of every document; ``start`` counts the ids of all documents before it."""
    def rows(doc, at, base, ids):
        parts = pa.ListArray.from_arrays(pa.array((at - at[0]).astype(np.int32)), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([doc, pa.array(base + at[:-1]), parts], ["doc_id", "start", "ids"])

    return _read(spark, folder, step, rows, "doc_id long, start long, ids array<int>")


def token_report(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the files, then per document, read back from them: doc_id, start, n_tokens, ids_crc32."""
    def rows(doc, at, base, ids):
        wide, here = ids.astype("<u4"), at - at[0]
        crc = [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(here[:-1], here[1:])]
        return pa.RecordBatch.from_arrays(
            [doc, pa.array(base + at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"])

    folder = write_token_files(docs, tokenizer_path, end_id)
    return _read(docs.sparkSession, folder, READ_DOCS, rows, "doc_id long, start long, n_tokens long, ids_crc32 long")
