"""Repeated byte windows by depth-limited most-significant-digit radix passes (op 9).

Every suffix is ordered only through its first ``LENGTH`` bytes; groups that
are still equal after the last digit are exactly the repeated windows. To keep
the first pass far below one row per byte, windows travel in runs: all
neighbouring windows whose smallest ``GRAM``-byte hash sits at the same place
(their anchor, a function of the window's bytes alone) form one context.

Pass 1: digit = anchor hash. Pass 2: contexts that share an anchor but differ
are cut into blocks of ``BLOCK`` windows; digit = the 81 bytes or more common
to all windows of a block. Pass 3: blocks that still differ are cut into single
windows; digit = all bytes. In every pass rows sort by (digit, whole content,
document, start) inside hash partitions: a lone digit is dropped, a content
seen before is cut as a whole (all its windows start earlier elsewhere), and
only the first row of each of several contents goes to the next pass.

Scale: each task first combines equal contents of its chunk, so a passage that
a third of all documents hold brings one row per chunk to its partition; the
passes stream over sorted rows and keep one row between batches. Digits and
contents are 64-bit hashes each, compared together. Texts are dealt by id once,
zstandard-compressed, for the passes that need their bytes again.

Edge cases: null or empty text, and texts under ``LENGTH`` bytes, lose nothing;
rows with a null id neither match nor lose anything; repeated rows (same id and
text) are one document, so they do not repeat each other; different texts under
one id are outside the contract; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ByteHash, mix, save_table, ship_package, signed, text_chunks

LENGTH = 100
GRAM = 24
#: Windows of one context at most: the anchor's place in them differs.
REACH = LENGTH - GRAM + 1
BLOCK = 20
_DONE = 255  # lead byte of a row that is known to repeat


def _place(at: np.ndarray, lead: np.ndarray | int, span: np.ndarray | int) -> np.ndarray:
    """First window start, anchor distance and further window starts in one long."""
    return (at << 16) | (np.asarray(lead) << 8) | span


def _combine(key: np.ndarray, ctx: np.ndarray, doc: np.ndarray, place: np.ndarray):
    """Chunk rows, sorted; later copies of a content become rows marked as done.

    Returns (order, key, ctx, doc, place, done) without exactly repeated rows.
    """
    order = np.lexsort((place, doc, ctx, key))
    key, ctx, doc, place = key[order], ctx[order], doc[order], place[order]
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (ctx[1:] == ctx[:-1])
    twin = same.copy()
    twin[1:] &= (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
    done = same & ~twin
    key = np.where(done, signed(mix(doc.view(np.uint64) * np.uint64(0x9E3779B1) + place.view(np.uint64))), key)
    place = np.where(done, place | (_DONE << 8), place)
    keep = ~twin
    return order[keep], key[keep], ctx[keep], doc[keep], place[keep], done[keep]


def contexts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, content hash, document number, start, lead, span) of every context."""
    size = np.diff(offs)
    z = np.zeros(0, np.int64)
    if len(data) < LENGTH or size.max() < LENGTH:
        return z.view(np.uint64), z.view(np.uint64), z, z, z, z
    hashes = ByteHash(data)
    gram = hashes.all_grams(GRAM)
    low = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = REACH - width
    low = np.minimum(low[: len(low) - rest], low[rest:])
    # window starts that stay inside their document
    valid = np.ones(len(low), bool)
    for_tail = offs[1:]
    for k in np.flatnonzero(for_tail - LENGTH + 1 < len(low)):
        valid[max(offs[k], for_tail[k] - LENGTH + 1): for_tail[k]] = False
    start = np.flatnonzero(valid)
    anchor = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else z
    if not len(new):
        return z.view(np.uint64), z.view(np.uint64), z, z, z, z
    first, last = start[new], start[np.r_[new[1:] - 1, len(start) - 1]]
    at = anchor[new]
    lead, span = at - first, last - first
    shape = (lead.astype(np.uint64) << np.uint64(8)) | span.astype(np.uint64)
    content = mix(hashes.ranges(first, last + LENGTH) + shape)
    doc = np.searchsorted(offs, first, "right") - 1
    return gram[at], content, doc, first - offs[doc], lead, span


def _context_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j, data, offs in text_chunks(batch.column(1)):
            gram, content, doc, at, lead, span = contexts(data, offs)
            _, key, ctx, of, place, _ = _combine(signed(gram), signed(content), ids[i:j][doc],
                                                 _place(at, lead, span))
            yield pa.record_batch([pa.array(x) for x in (key, ctx, of, place)],
                                  names=["key", "ctx", "doc_id", "place"])


def _digit_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, ctx, doc_id, place): what repeats (open=false) or stays open.

    Rows may carry their bytes as a fifth column, which open rows keep.
    """
    last = (None, None, None, None)  # the last row that was not marked as done
    held = None                      # first row of a key with one content so far
    for batch in batches:
        names = batch.schema.names[2:]
        place = batch.column(3).to_numpy()
        done = (place >> 8 & 255) == _DONE
        yield pa.record_batch([c.filter(pa.array(done)) for c in batch.columns[2:]]
                              + [pa.array(np.zeros(done.sum(), bool))], names=[*names, "open"])
        batch = batch.filter(pa.array(~done))
        if not batch.num_rows:
            continue
        key, ctx, doc, place = (batch.column(k).to_numpy() for k in range(4))
        prev = [np.r_[x[:1], x[:-1]] for x in (key, ctx, doc, place)]
        for p, v in zip(prev, last):
            if v is not None:
                p[0] = v
        same_key = key == prev[0]
        same = same_key & (ctx == prev[1])
        if last[0] is None:
            same_key[0] = same[0] = False
        twin = same & (doc == prev[2]) & (place == prev[3])
        head = ~same
        group = np.cumsum(~same_key)           # 0: goes on from the last batch
        heads = np.bincount(group, weights=head, minlength=group[-1] + 1).astype(np.int64)
        carried = held is not None and heads[0] > 0 and group[0] == 0
        if group[0] == 0 and (held is None or carried):
            heads[0] += 2 if held is None else 1
        elif group[0] != 0:
            heads[0] = 0
        several = heads[group] > 1
        is_open = head & several
        out = is_open | (same & ~twin)
        rows = [c.filter(pa.array(out)) for c in batch.columns[2:]]
        flags = pa.array(is_open[out])
        if carried:
            rows = [pa.concat_arrays([h, c]) for h, c in zip(held, rows)]
            flags = pa.concat_arrays([pa.array([True]), flags])
        yield pa.record_batch([*rows, flags], names=[*names, "open"])
        final = group[-1]
        if final != 0 or group[0] != 0 or carried:
            held = None
            if heads[final] == 1:
                at = int(np.flatnonzero(head & (group == final))[0])
                held = [c.slice(at, 1) for c in batch.columns[2:]]
        last = (key[-1], ctx[-1], doc[-1], place[-1])


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in smaller pieces, so that few unpacked texts are held at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _pack_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=3)
    for batch in _pieces(batches):
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        yield pa.record_batch([batch.column(0), pa.array([z.compress(t or b"") for t in texts], pa.binary())],
                              names=["doc_id", "packed"])


def _unpacked(column: pa.Array) -> pa.Array:
    z = zstandard.ZstdDecompressor()
    return pa.array([z.decompress(p) for p in column.to_pylist()], pa.binary())


def _block_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open contexts (doc_id, packed text, places) cut into blocks of windows, with their bytes."""
    for batch in _pieces(batches):
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j, data, offs in text_chunks(_unpacked(batch.column(1))):
            lists = batch.column(2).slice(i, j - i)
            doc = np.repeat(np.arange(j - i), lists.value_lengths().to_numpy())
            place = lists.flatten().to_numpy()
            first = (place >> 16) + offs[doc]
            span = place & 255
            inside = first + span + LENGTH <= offs[doc + 1]
            doc, place, first, span = doc[inside], place[inside], first[inside], span[inside]
            anchor = first + (place >> 8 & 255)
            hashes = ByteHash(data)
            parts = []
            for q, low in enumerate(range(GRAM - LENGTH, 1, BLOCK)):
                high = min(low + BLOCK - 1, 0)
                lo, hi = np.maximum(first, anchor + low), np.minimum(first + span, anchor + high)
                ok = lo <= hi
                a, b, p = lo[ok], hi[ok], anchor[ok]
                digit = mix(hashes.ranges(p + high, p + low + LENGTH) + np.uint64(q))
                shape = ((p - a).astype(np.uint64) << np.uint64(8)) | (b - a).astype(np.uint64)
                parts.append((digit, mix(hashes.ranges(a, b + LENGTH) + shape), doc[ok], a, b))
            digit, content, of, a, b = (np.concatenate(x) for x in zip(*parts))
            order, key, ctx, doc_id, at, done = _combine(
                signed(digit), signed(content), ids[i:j][of], _place(a - offs[of], 0, b - a))
            raw = data.tobytes()
            pieces = [None if d else raw[x: y + LENGTH] for d, x, y in zip(done, a[order], b[order])]
            yield pa.record_batch([pa.array(key), pa.array(ctx), pa.array(doc_id), pa.array(at),
                                   pa.array(pieces, pa.binary())],
                                  names=["key", "ctx", "doc_id", "place", "bytes"])


def _window_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open blocks cut into single windows: (two hashes of the window, doc_id, place)."""
    for batch in batches:
        ids, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for i, j, data, offs in text_chunks(batch.column(2)):
            count = np.diff(offs) - LENGTH + 1
            row = np.repeat(np.arange(j - i), count)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            start = offs[row] + step
            w = [signed(ByteHash(data, salt).ranges(start, start + LENGTH)) for salt in (0, 1)]
            at = (place[i:j][row] >> 16) + step
            _, key, ctx, doc, where, _ = _combine(w[0], w[1], ids[i:j][row], _place(at, 0, 0))
            yield pa.record_batch([pa.array(x) for x in (key, ctx, doc, where)],
                                  names=["key", "ctx", "doc_id", "place"])


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "ctx", "doc_id", "place")


def repeated_windows(docs: DataFrame, text_by_id: DataFrame) -> DataFrame:
    """(doc_id, place): runs of windows that also start earlier.

    ``text_by_id`` holds (doc_id, packed text) dealt by id; it is the same
    shuffle that the caller joins again, so Spark runs it once.
    """
    first = save_table(
        _sorted(docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).mapInArrow(
            _context_pass, "key long, ctx long, doc_id long, place long"))
        .mapInArrow(_digit_pass, "doc_id long, place long, open boolean"), "repeat-contexts")
    opened = first.where("open").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    second = _sorted(text_by_id.join(opened, "doc_id").select("doc_id", "packed", "places").mapInArrow(
        _block_pass, "key long, ctx long, doc_id long, place long, bytes binary")
    ).mapInArrow(_digit_pass, "doc_id long, place long, bytes binary, open boolean")
    third = _sorted(second.where("open").select("doc_id", "place", "bytes").mapInArrow(
        _window_pass, "key long, ctx long, doc_id long, place long")
    ).mapInArrow(_digit_pass, "doc_id long, place long, open boolean")
    return (first.where("not open").select("doc_id", "place")
            .union(second.where("not open").select("doc_id", "place"))
            .union(third.where("not open").select("doc_id", "place")))


def merged_runs(places: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Byte ranges covered by runs of windows, joined where they touch."""
    at = np.sort(places >> 16 << 8 | places & 255)
    runs: list[list[int]] = []
    for v in at.tolist():
        lo, hi = v >> 8, min((v >> 8) + (v & 255) + LENGTH, size)
        if lo >= hi:
            continue
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    return [tuple(r) for r in runs]


def _cut_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        texts = _unpacked(batch.column(1))
        out = []
        for k in range(batch.num_rows):
            raw = texts[k].as_py()
            places = batch.column(2)[k]
            runs = merged_runs(places.values.to_numpy(), len(raw)) if places.is_valid else []
            digest, pos = hashlib.sha256(), 0
            for lo, hi in runs:
                digest.update(raw[pos:lo])
                pos = hi
            digest.update(raw[pos:])
            out.append((len(raw), sum(h - l for l, h in runs), runs, digest.hexdigest()))
        yield pa.record_batch(
            [batch.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
             pa.array([[{"start": l, "end": h} for l, h in o[2]] for o in out],
                      pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array([o[3] for o in out], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"])


def cut_repeats(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, removed spans, digest of the rest."""
    ship_package(docs.sparkSession)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text_by_id = table.mapInArrow(_pack_pass, "doc_id long, packed binary").repartition("doc_id")
    cuts = repeated_windows(table, text_by_id).groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    return text_by_id.join(cuts, "doc_id", "left").select("doc_id", "packed", "places").mapInArrow(
        _cut_pass, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, "
                   "kept_sha256 string")
