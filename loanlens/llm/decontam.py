"""Benchmark decontamination over a distributed positional inverted index (op 8).

DataFrame functions only. :func:`build_index` stores a posting (term, document,
position) for every training token that is a benchmark term; it is written in
document order without a shuffle. Each benchmark window (``size`` consecutive
words of an item, or a whole shorter item) looks up its two rarest terms by
their posting counts over all documents, shifts each list by the term's offset
in the window and intersects them: a start that both lists give (within
``slop`` words for proximity) is a candidate. A document's candidates are then
compared with its words: equal runs are phrase matches; where every term of the
window has an occurrence within ``slop`` words of its own place, it is a
proximity match.

Scale: the term table and the windows are small, but nothing forces a
broadcast: Spark chooses it by their stored size and shuffles otherwise.
Candidate lists are keyed by (window, document, place), so a passage that a
third of all documents hold spreads over them; the final join is by document.

Edge cases: a null or empty text has no words and no hits; an item without
words has no window; rows with a null id or one that other texts share are
indexed under a number of their own (:func:`with_row_ids`); repeated rows each
get their own full result; an item id that is null hits but
is left out of the digest; empty tables give no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save_table, with_row_ids

#: Words before lower-casing: digits, ASCII letters and everything beyond ASCII.
#: The separators are listed one by one because Java tests such a class with one
#: table lookup, and ranges one after the other.
WORD = "[^" + "".join(f"\\x{c:02x}" for c in range(128) if not chr(c).isalnum()) + "]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(word: Column) -> Column:
    """A-Z lowered; most words have none, and skip the per-character map."""
    return F.when(word.rlike("[A-Z]"), F.translate(word, _UPPER, _LOWER)).otherwise(word)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def windows_of(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct windows: window (hash), terms, items (ids as strings)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"),
                             F.transform(words_of(F.col("text")), _lower).alias("ws"))
    cut = F.when(F.size("ws") <= size, F.array("ws")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size("ws") - size + 1), lambda i: F.slice("ws", i, size)))
    return (items.where(F.size("ws") > 0).select("item", F.explode(cut).alias("terms"))
            .groupBy("terms").agg(F.array_distinct(F.collect_list(F.struct("item"))).alias("items"))
            .select(F.xxhash64("terms").alias("window"), "terms", F.col("items.item").alias("items")))


def build_index(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Stored postings (term, doc_id, pos) of all benchmark terms in all documents."""
    terms = save_table(windows.select(F.explode("terms").alias("w")).distinct()
                       .select(F.xxhash64("w").alias("term")), "index-terms")
    tokens = (docs.select("doc_id", F.posexplode(words_of(F.col("text"))).alias("pos", "raw"))
              .select("doc_id", "pos", F.xxhash64(_lower(F.col("raw"))).alias("term")))
    return save_table(tokens.join(terms, "term", "left_semi"), "index-postings")


def candidates(index: DataFrame, windows: DataFrame, slop: int) -> DataFrame:
    """(window, doc_id, start): places where the two rarest terms of a window agree."""
    frequency = save_table(index.groupBy("term").agg(F.count("*").alias("df")), "index-df")
    placed = windows.select("window", F.size("terms").alias("n"), F.posexplode("terms").alias("off", "w")).select(
        "window", "n", "off", F.xxhash64("w").alias("term"))
    # windows with a term that no document holds cannot occur
    rarest = (placed.join(frequency, "term").groupBy("window", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "off", "term"))).alias("by_df"))
              .where(F.size("by_df") == F.col("n")))
    rarest = save_table(rarest.select(
        "window", "n", F.col("by_df")[0].alias("first"),
        F.when(F.col("n") > 1, F.get("by_df", F.lit(1))).alias("second")), "index-rarest")

    def postings(which: str) -> DataFrame:
        return index.join(
            rarest.where(F.col(which).isNotNull()).select(
                "window", "n", F.col(which)["term"].alias("term"), F.col(which)["off"].alias("off")), "term"
        ).select("window", "n", "doc_id", (F.col("pos") - F.col("off")).alias("start"))

    width = slop + 1
    first = postings("first").select(
        "*", F.explode(F.array(*[F.floor(F.col("start") / width) + d for d in (-1, 0, 1)])).alias("place"))
    second = postings("second").select(
        "window", "doc_id", F.col("start").alias("start2"), F.floor(F.col("start") / width).alias("place"))
    both = (first.where("n > 1").join(second, ["window", "doc_id", "place"])
            .where(F.abs(F.col("start") - F.col("start2")) <= slop)
            .select("window", "doc_id", "start"))
    single = postings("first").where("n = 1").select("window", "doc_id", "start")
    return both.union(single).distinct()


def matches(docs: DataFrame, benchmark: DataFrame, size: int = 10, slop: int = 2) -> DataFrame:
    """One row per document: doc_id, n_words, phrase and near match arrays.

    ``phrase`` and ``near`` hold (start, terms, items): exact runs, and windows
    whose terms all lie within ``slop`` words of their place (exact ones too).
    """
    windows = save_table(windows_of(benchmark, size), "index-windows")
    docs = with_row_ids(docs.select("doc_id", "text")).select(F.col("doc_id").alias("given_id"), F.col("_row").alias("doc_id"), "text")
    index = build_index(docs, windows)
    found = candidates(index, windows, slop).join(windows, "window").groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "terms", "items")).alias("found"))
    rows = (docs.join(found.hint("shuffle_hash"), "doc_id", "left")
            .select(F.col("given_id").alias("doc_id"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"), "found",
                    # the generator computes the words once, not in each use below
                    F.explode(F.array(F.when(F.col("found").isNotNull(), F.transform(
                        words_of(F.col("text")), _lower)))).alias("ws")))

    def exact(m: Column) -> Column:
        return (m["start"] >= 0) & (
            F.slice("ws", F.greatest(m["start"], F.lit(0)) + 1, F.size(m["terms"])) == m["terms"])

    def close(m: Column) -> Column:
        def at_home(term: Column, k: Column) -> Column:
            low = F.greatest(m["start"] + k - slop, F.lit(0))
            return F.array_contains(F.slice("ws", low + 1, F.greatest(m["start"] + k + slop + 1 - low, F.lit(0))), term)
        return F.forall(F.transform(m["terms"], at_home), lambda x: x)

    return rows.select("doc_id", "n_words", F.filter("found", exact).alias("phrase"),
                       F.filter("found", close).alias("near"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, slop: int = 2) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, n_near_items.

    A word inside any phrase match is hit; ``n_near_items`` counts items that
    only have proximity matches.
    """
    def items(col: str) -> Column:
        return F.coalesce(F.array_distinct(F.flatten(F.transform(col, lambda m: m["items"]))),
                          F.array().cast("array<string>"))

    hit = F.array_distinct(F.flatten(F.transform(
        "phrase", lambda m: F.sequence(m["start"], m["start"] + F.size(m["terms"]) - 1))))
    return (matches(docs, benchmark, size, slop)
            .select("doc_id", "n_words", F.coalesce(F.size(hit), F.lit(0)).cast("long").alias("h"),
                    items("phrase").alias("ids"), items("near").alias("near_ids"))
            .select("doc_id", "n_words", F.greatest("h", F.lit(0).cast("long")).alias("n_hit"),
                    F.size("ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.array_sort("ids"), ",").cast("binary"), 256).alias("items_sha256"),
                    (F.col("h") > 0).alias("contaminated"),
                    F.size(F.array_except("near_ids", "ids")).cast("long").alias("n_near_items")))
