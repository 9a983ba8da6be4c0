"""Spelling variants by a bit-sliced position index (op 12).

Words are the maximal letter runs of all texts (A-Z lower-cased) with at least
``min_length`` code points and ``min_count`` occurrences. Two are near if one
inserted, deleted or replaced code point turns one into the other. A word's
form is its most frequent near word, if that is ``ratio`` times as frequent;
its root is the end of the chain of forms.

Index: a block of up to ``BLOCK`` words of length m and m + 1 has, per position
and letter, a bitset of the words with that letter there, 64 words to a machine
word. A query of length m walks its letters once for all words of the block:

* exact:    Z' = Z & B[j][q_j]
* replaced: S' = (S & B[j][q_j]) | (Z & ~B[j][q_j])
* longer:   I' = (I | Z) & B[j + 1][q_j]        (the word has one more letter before)

so the words without an error and with one error so far are followed at the
same time; at the end S are the near words of length m and I | Z those of
length m + 1. Shorter ones follow by symmetry. The steps of all (query, 64
words) pairs of many blocks are numpy operations over one array, from which
pairs without a bit left are dropped.

Blocks: one error leaves the first or the last ``m div 2`` letters unchanged, so
words meet by length and by each of these two keys. A key with more than
``BLOCK`` words is cut into parts, and every part of the index meets every part
of the queries in a block of its own; blocks are then bounded, whatever the
key. Near pairs that share both keys count under the first.

Scale: words are counted with map-side sums before any shuffle; only distinct
frequent words go into blocks (four rows each). Near words are aggregated per
word. Chains of forms at least multiply the count by ``ratio`` at every step,
so pointer doubling ends after a few joins.

Edge cases: null texts have no words, a null doc_id counts as an empty one in
the damage hash; ties of frequency go to the smallest form in code-point order;
words of any length are handled; repeated rows count again; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save_table, ship_package

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of one key that meet in one block; larger keys are cut into parts of this size.
BLOCK = 4_096
# Work of one vectorised step: (query, 64 words) pairs, and letters of words.
_PAIRS = 1 << 19
_CHARS = 1 << 21


def damaged(word: Column, doc_id: Column, every: int) -> Column:
    """The word, without its code point h % length where ``every`` divides h = crc32 of 'doc_id:word'."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, cut).otherwise(word)


def word_counts(docs: DataFrame, min_length: int, min_count: int, damage_every: int | None) -> DataFrame:
    """(word, n) of all texts; ``damage_every`` first deletes a letter of some runs (:func:`damaged`)."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        "text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    word = F.translate("run", UPPER, LOWER)
    if damage_every:
        runs, word = runs.select("doc_id", word.alias("run")), damaged(F.col("run"), F.col("doc_id"), damage_every)
    return (runs.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _keyed(words: DataFrame) -> DataFrame:
    """(m, last, key, word, n, asks): every word under its keys for blocks of its own length and the length below.

    ``asks`` marks rows that are queries as well as indexed words.
    """
    size = F.length("word")
    half = lambda m: F.expr(f"({m}) div 2").cast("int")
    rows = words.withColumn("size", size).withColumn("m", F.explode(F.array(F.col("size"), F.col("size") - 1)))
    k = half("m")
    both = F.array(F.struct(F.lit(False).alias("last"), F.substring(F.col("word"), F.lit(1), k).alias("key")),
                   F.struct(F.lit(True).alias("last"), F.substring(F.col("word"), F.col("size") - k + 1, k).alias("key")))
    return rows.select("word", "n", "m", (F.col("m") == F.col("size")).alias("asks"), F.explode(both).alias("b")).select(
        "m", "b.last", "b.key", "word", "n", "asks")


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """Rows with the parts (i of the index, q of the queries) whose block they go to, and what they are there."""
    large = (rows.groupBy("m", "last", "key").agg(F.count("*").alias("total"), F.max("asks").alias("any"))
             .where(F.col("total") > 1).select("m", "last", "key", F.ceil(F.col("total") / block).cast("int").alias("parts")))
    # keys of a single word have no pairs; parts = 1 for nearly all of the rest
    met = rows.join(large, ["m", "last", "key"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    plan = lambda i, q, indexed, asks: F.struct(i.alias("i"), q.alias("q"), indexed.alias("indexed"), asks.alias("asks"))
    part, yes, no = F.col("part"), F.lit(True), F.lit(False)
    as_word = F.transform(every, lambda q: plan(part, q, yes, no))
    as_query = F.when(F.col("asks"), F.transform(every, lambda i: plan(i, part, no, yes))).otherwise(F.array().cast(
        "array<struct<i:int,q:int,indexed:boolean,asks:boolean>>"))
    places = F.when(F.col("parts") == 1, F.array(plan(F.lit(0), F.lit(0), yes, F.col("asks")))).otherwise(
        F.concat(as_word, as_query))
    return met.select("m", "last", "key", "word", "n", F.explode(places).alias("p")).select(
        "m", "last", "key", "p.i", "p.q", "word", "n", "p.indexed", "p.asks")


# ----------------------------------------------------------- in one task

def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, block starts) of sorted rows, cut between blocks."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        starts = _starts(table, ("m", "last", "key", "i", "q"))
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts[:-1]
        held = table.slice(starts[-1]) if len(starts) else None
    if held is not None and held.num_rows:
        yield held, _starts(held, ("m", "last", "key", "i", "q"))


def _starts(table: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    n = table.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for name in names:
        c = table.column(name).combine_chunks()
        new[1:] |= pc.not_equal(c.slice(1), c.slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points per word and position, 0 after a word's end."""
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)


def near_in_blocks(m: int, last: bool, words: list[str], indexed: np.ndarray, asks: np.ndarray,
                   block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query row, indexed row) of all near pairs of rows of one block; words have m or m + 1 letters, queries m."""
    where, queries = np.flatnonzero(indexed), np.flatnonzero(asks)
    blocks = int(block.max()) + 1
    held = np.bincount(block[where], minlength=blocks)
    columns = -(-held // 64)
    first = np.cumsum(columns) - columns
    slot = first[block[where]] * 64 + np.arange(len(where)) - (np.cumsum(held) - held)[block[where]]
    row_of = np.full(int(columns.sum()) * 64, -1)
    row_of[slot] = where
    bit, col = np.left_shift(np.uint64(1), (slot % 64).astype(np.uint64)), slot // 64

    codes = _codes(words, m + 1)
    letters, flat = np.unique(codes, return_inverse=True)
    codes = flat.reshape(codes.shape)
    n_col = int(columns.sum())

    def sliced(position: int) -> np.ndarray:
        """Bitsets by (letter, column) of one position."""
        out = np.zeros(len(letters) * n_col, np.uint64)
        np.add.at(out, codes[where, position] * n_col + col, bit)
        return out

    longer = np.zeros(n_col, np.uint64)
    np.add.at(longer, col, np.where(letters[codes[where, m]] > 0, bit, np.uint64(0)))
    occupied = np.zeros(n_col, np.uint64)
    np.add.at(occupied, col, bit)

    per = columns[block[queries]]
    query = np.repeat(queries, per)
    at = np.repeat(first[block[queries]] - (np.cumsum(per) - per), per) + np.arange(len(query))
    exact, one, extra = occupied[at], np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    same_key = np.zeros(len(at), np.uint64)
    here = sliced(0)
    for j in range(m):
        ahead = sliced(j + 1)
        cell = codes[query, j] * n_col + at
        b = here[cell]
        extra = (extra | exact) & ahead[cell]
        one = (one & b) | (exact & ~b)
        exact = exact & b
        here = ahead
        if last and j + 1 == m // 2:
            same_key = exact.copy()      # these meet under their first letters
        alive = (exact | one | extra) != 0
        if np.count_nonzero(alive) < 0.7 * len(alive):
            query, at, exact, one, extra, same_key = (x[alive] for x in (query, at, exact, one, extra, same_key))
            if not len(query):
                break
    found = ((one & ~longer[at]) | ((extra | exact) & longer[at])) & ~same_key
    some = np.flatnonzero(found)
    bits = np.unpackbits(found[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pair, offset = np.nonzero(bits)
    return query[some[pair]], row_of[at[some[pair]] * 64 + offset]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n) in both directions, from rows sorted by block."""
    for table, starts in _whole_blocks(batches):
        ends = np.append(starts[1:], table.num_rows)
        m, last = (table.column(c).to_numpy() for c in ("m", "last"))
        n, indexed, asks = (table.column(c).to_numpy() for c in ("n", "indexed", "asks"))
        word = table.column("word").combine_chunks()
        asked, rows = np.add.reduceat(asks.astype(np.int64), starts), ends - starts
        columns = -(-np.add.reduceat(indexed.astype(np.int64), starts) // 64)
        use = np.flatnonzero((asked > 0) & (rows > 1))
        i = 0
        while i < len(use):
            kind, pairs, chars, k = (m[starts[use[i]]], last[starts[use[i]]]), 0, 0, i
            while k < len(use) and (m[starts[use[k]]], last[starts[use[k]]]) == kind and (
                    k == i or pairs < _PAIRS and chars < _CHARS):
                pairs += int(asked[use[k]] * columns[use[k]])
                chars += int(rows[use[k]] * (kind[0] + 1))
                k += 1
            picked = np.concatenate([np.arange(starts[b], ends[b]) for b in use[i:k]])
            block = np.repeat(np.arange(k - i), rows[use[i:k]])
            names = word.take(pa.array(picked))
            q, w = near_in_blocks(int(kind[0]), bool(kind[1]), names.to_pylist(), indexed[picked], asks[picked], block)
            i = k
            if len(q):
                long = (pc.utf8_length(names).to_numpy(zero_copy_only=False)[w] > kind[0])
                a, b = np.concatenate([q, w[long]]), np.concatenate([w, q[long]])
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(a)), names.take(pa.array(b)), pa.array(n[picked][b], pa.int64())],
                    ["word", "near", "near_n"])


# --------------------------------------------------------------- operator

def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n): all ordered pairs of near words of a table (word, n) of distinct words."""
    ship_package(words.sparkSession)
    order = ["m", "last", "key", "i", "q"]
    blocks = _dealt(_keyed(words), block)
    return (blocks.repartition(*order).sortWithinPartitions(*order)
            .mapInArrow(_near, "word string, near string, near_n long"))


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: pointer doubling until no pointer moves."""
    links = save_table(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = save_table(links.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-links")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = 5,
                      damage_every: int | None = None) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = save_table(word_counts(docs, min_length, min_count, damage_every), "spelling-words")
    nothing = F.lit(None)
    rows = near_words(words).select("word", nothing.cast("long").alias("n"), F.struct(
        (-F.col("near_n")).alias("order"), F.col("near").alias("form")).alias("near")).union(
        words.select("word", "n", nothing.cast("struct<order:bigint,form:string>").alias("near")))
    per = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), F.min("near").alias("best"))
    strong = -F.col("best.order") >= ratio * F.col("n")
    forms = save_table(per.select("word", "n", "n_near", F.when(strong, F.col("best.form")).alias("form"),
                                  F.when(strong, -F.col("best.order")).alias("form_n")), "spelling-forms")
    return forms.join(follow_forms(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
