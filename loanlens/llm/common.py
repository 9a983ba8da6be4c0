"""Helpers shared by the operators: stored tables, components, byte hashing."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.operators.ranking import ordinals
from loanlens.session import checkpoint_dir, ship_package  # noqa: F401 - the operators import it from here

#: Bytes of text that one vectorised step of a task handles at a time (a longer
#: single document is a step of its own).
CHUNK_BYTES = 1 << 20
#: Documents per step, so that a document's number fits 16 bits.
CHUNK_DOCS = 60_000

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor rereads stored files. The folder is
    the session's ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Groups above this part of all rows are joined by broadcast (there are at most that many).
HOT_PART = 10_000


def attach_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size_col: str, total: int) -> DataFrame:
    """``rows`` left-joined with the columns of ``groups`` (unique by ``keys``) without a hot key in one task.

    Groups with more than ``total / HOT_PART`` rows are at most HOT_PART and are
    broadcast; their rows are dealt evenly in the shuffle that joins the rest.
    """
    more = [c for c in groups.columns if c not in keys]
    hot = F.col(size_col) > max(total // HOT_PART, 1)
    large = groups.where(hot).select(*keys, F.struct(*more).alias("_large"))
    # always 0, but not a constant to the optimizer, which would drop it from the keys of the shuffle
    none = (F.col(size_col) % 1).cast("int").alias("_deal")
    rest = groups.where(~hot).select(*keys, F.struct(*more).alias("_rest"), none)
    met = rows.join(F.broadcast(large), keys, "left").withColumn("_deal", F.when(
        F.col("_large").isNotNull(), 1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).otherwise(0).cast("int"))
    met = met.join(rest.hint("shuffle_hash"), [*keys, "_deal"], "left")
    return met.select(*rows.columns, *[F.coalesce(F.col(f"_large.{c}"), F.col(f"_rest.{c}")).alias(c) for c in more])


def text_digest() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def with_row_ids(docs: DataFrame, name: str = "_row") -> DataFrame:
    """:func:`number_rows`, the documents only."""
    return number_rows(docs, name)[0]


def number_rows(docs: DataFrame, name: str = "_row") -> tuple[DataFrame, DataFrame | None]:
    """(``docs`` with row numbers, table (_new, _odd) of the numbers that aren't ids and the ids they stand for, or None).

    ``docs`` gets a number per (doc_id, text): the doc_id where just one row has it, else one above all ids.

    Rows without an id and rows that share one can so be told apart (a text that
    repeats under its id keeps one number); they are numbered by id, nulls
    last, then by a digest of their text.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    odd = save_table(ids.where("n > 1 or doc_id is null").select(F.col("doc_id").alias("_odd")), "odd-ids")
    if odd.isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long")), None
    top = docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0] or 0
    # the table of odd ids is small in any sound table, and then Spark broadcasts it
    pairs = (docs.select("doc_id", text_digest().alias("_digest"))
             .join(odd, F.col("doc_id").eqNullSafe(F.col("_odd")), "left_semi").distinct()
             .withColumn("_order", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_digest")))
    numbered = save_table(ordinals(pairs.withColumn("_all", F.lit(0)), ["_all"], "_order", "_place").select(
        F.col("doc_id").alias("_odd"), "_digest", (F.col("_place").cast("long") + F.lit(top + 1)).alias("_new")), "odd-numbers")
    same = F.col("doc_id").eqNullSafe(F.col("_odd")) & (text_digest() == F.col("_digest"))
    return docs.join(numbered, same, "left").select(
        *docs.columns, F.coalesce("_new", F.col("doc_id").cast("long")).alias(name)), numbered.select("_new", "_odd")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for an undirected edge table (a, b); component = smallest node.

    Alternates "large star" and "small star" steps: each is one min-aggregate
    per node (map-side combined, so a hub costs one row per task) and one join.
    Every round is stored, so nothing is recomputed or held on the driver; the
    loop stops when a round leaves the edge set unchanged.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b"), F.col("a")))
            lows = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            return (both.join(lows, "a").where("b > a")
                    .select(F.col("b").alias("a"), F.col("m").alias("b")))
        lows = e.groupBy("a").agg(F.min("b").alias("m"))
        kept = e.join(lows, "a")
        return kept.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            lows.select("a", F.col("m").alias("b")))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    cur = save_table(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "cc")
    seen = mark(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        nxt = star(cur, True).where("a <> b").distinct()
        nxt = save_table(star(nxt.select(F.greatest("a", "b").alias("a"),
                                         F.least("a", "b").alias("b")), False).distinct(), "cc")
        now = mark(nxt)
        cur = nxt
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


# ---------------------------------------------------------------- byte hashing

_ROLL = np.uint64(0x9E3779B97F4A7C15 | 1)
_ROLL_INV = np.uint64(pow(int(_ROLL), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective avalanche) over unsigned integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _byte_values(salt: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * salt + 0x2545F4914F6CDD1D))


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_ROLL, _ROLL_INV)):
            full = np.full(n, base, np.uint64)
            full[0] = 1
            _POWERS[k] = np.cumprod(full)
    return _POWERS[0], _POWERS[1]


#: Longer ranges are hashed byte by byte: sums mod 2**64 have collisions of 1,024 bytes and more.
_LONG_RANGE = 256


class ByteHash:
    """Hashes of any byte range of one buffer from prefix sums (mod 2**64); long ranges get a digest."""

    def __init__(self, data: np.ndarray, salt: int = 0):
        n = len(data)
        self._data, self._salt = data, salt
        up, self._down = _powers(n + 1)
        self._prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_byte_values(salt)[data] * up[:n], out=self._prefix[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of data[start:end] per range; equal bytes give equal hashes."""
        out = mix((self._prefix[end] - self._prefix[start]) * self._down[start]
                  + (end - start).astype(np.uint64))
        for i in np.flatnonzero(end - start > _LONG_RANGE):
            digest = hashlib.blake2b(self._data[start[i]: end[i]].tobytes(), digest_size=8, key=bytes([self._salt]))
            out[i] = int.from_bytes(digest.digest(), "little")
        return out

    def all_grams(self, k: int) -> np.ndarray:
        """Mixed hash of every k-byte range, by start."""
        n = len(self._prefix) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        return mix((self._prefix[k:] - self._prefix[:-k]) * self._down[: n - k + 1] + np.uint64(k))


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) pieces of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.binary()), b"")
    n = len(column)
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int32)[column.offset: column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1
        j = min(max(j, i + 1), n, i + CHUNK_DOCS)
        yield i, j, data[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document number) of every word; words never cross documents."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~separator[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offs[:-1][offs[:-1] < offs[1:]]
    first[begins] = inside[begins]
    ends = offs[1:][offs[:-1] < offs[1:]] - 1
    last[ends] = inside[ends]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offs, start, "right") - 1


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark longs."""
    return x.view(np.int64)
