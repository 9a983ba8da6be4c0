"""Jaccard join, exact dedup, decontamination and repeats against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import types as T

from loanlens.llm import jaccard_join, repeats
from loanlens.llm.decontam import contamination
from loanlens.llm.exact_dedup import exact_duplicates
from loanlens.llm.jaccard_join import similarity_classes
from loanlens.llm.repeats import cut_repeats
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("keep_id", T.StringType()), T.StructField("n_words", T.IntegerType())])


def frame(spark, rows, parts=3):
    """Documents with extra columns whose names clash with the results'."""
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], DOCS).repartition(parts)


def table(spark, name):
    df = spark.read.parquet(f"{SMALL}/{name}.parquet")
    return df, [tuple(r) for r in df.select(*df.columns[:2]).collect()]


def words(r, n, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def mutated(r, text, changes):
    w = text.split()
    for _ in range(changes):
        w[r.randrange(len(w))] = f"z{r.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def near_rows():
    r, rows = random.Random(5), []
    for size in (4, 6, 9, 14, 25, 60, 150, 400, 900):
        base = words(r, size, 5000)
        for _ in range(14):
            rows.append(mutated(r, base, r.choice((0, 0, 1, 1, 2, 3, max(1, size // 60), max(1, size // 40)))))
    shared = words(r, 30, 5000)
    rows += [words(r, r.randrange(5, 80), 5000) + " " + shared for _ in range(60)]  # a passage many share
    rows += [None, "", " \t\n ", "One two", "one TWO", "one two three", "x" * 5000, "x" * 5000]
    return list(enumerate(rows, start=3))


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_jaccard_join_matches_brute_force(spark, near_rows, n, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links)
           for r in similarity_classes(frame(spark, near_rows), n, percent).collect()}
    assert got == brute.similarity_classes(near_rows, n, percent)


def test_jaccard_join_cuts_large_groups_into_blocks(spark, near_rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 700)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links)
           for r in similarity_classes(frame(spark, near_rows), 5, 80).collect()}
    assert got == brute.similarity_classes(near_rows, 5, 80)


def test_signatures_meet_for_every_linked_pair():
    """Pigeonhole: linked sets share a signature, also with light segments skipped."""
    r = np.random.default_rng(3)
    for t in (80, 90):
        bands = jaccard_join.plan_bands(3000, t)
        assert bands[0].low == 1 and all(a.high + 1 == b.low for a, b in zip(bands, bands[1:]))
        frequent = np.sort(r.integers(0, 2 ** 63, 300).astype(np.uint64) * np.uint64(2))
        for _ in range(400):
            n = int(np.exp(r.uniform(0, 7)))
            common = r.choice(frequent, min(len(frequent), r.integers(0, n + 1)), replace=False)
            a = np.unique(np.r_[common, r.integers(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1)])
            b = a.copy()
            while True:  # as far away as a link allows
                c = np.delete(b, r.integers(len(b))) if r.random() < 0.5 and len(b) > 1 else np.union1d(
                    b, r.integers(0, 2 ** 63, 1).astype(np.uint64))
                both = len(np.intersect1d(a, c))
                if 100 * both < t * (len(a) + len(c) - both):
                    break
                b = c
            if len(a) == len(b) and (a == b).all():
                continue
            sets = [a, b]
            s, d = jaccard_join.signatures(np.concatenate(sets), np.repeat([0, 1], [len(a), len(b)]),
                                           np.array([len(a), len(b)]), bands, t, frequent)
            assert len(np.intersect1d(s[d == 0], s[d == 1])), (t, len(a), len(b))


def test_exact_duplicates(spark):
    rows = [(1, "a"), (2, "a"), (5, "a"), (3, "b"), (4, None), (9, ""), (6, "c" * 9000), (7, "c" * 9000),
            (8, "c" * 8999 + "d"), (None, "n"), (None, "a"), (10, "A"), (10, "A")]
    got = sorted(map(tuple, exact_duplicates(frame(spark, rows)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)
    want = []
    for i, t in rows:
        same = [j for j, u in rows if (u or "") == (t or "")]
        keep = max((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, brute.sha((t or "").encode())))
    assert got == sorted(want, key=str)


def test_decontamination_matches_brute_force(spark):
    (docs, d_rows), (bench, b_rows) = table(spark, "documents"), table(spark, "benchmark")
    b_rows = b_rows + [(900, "Ça va 42"), (901, "solo"), (902, ""), (903, None), (904, "!!")]
    item = b_rows[0][1]
    near = item.split()
    near[2], near[3] = near[3], near[2]
    d_rows = d_rows + [(10 ** 6, "xx " + item.upper() + " yy"), (10 ** 6 + 1, "ça VA 42, solo. Solo"),
                       (10 ** 6 + 2, "Ça va 4 2"), (10 ** 6 + 3, None), (10 ** 6 + 4, " ".join(near[:12])),
                       (10 ** 6 + 5, item + " " + item)]
    got = {r.doc_id: r for r in contamination(
        frame(spark, d_rows), spark.createDataFrame(b_rows, "item_id long, text string")).collect()}
    want = brute.contamination(d_rows, b_rows)
    assert {i: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for i, r in got.items()} == want
    assert sum(x[4] for x in want.values()) > 3
    assert got[10 ** 6 + 4].n_near_items >= 1  # swapped words: proximity only


def test_repeats_match_brute_force(spark):
    r = random.Random(11)
    docs, rows = table(spark, "documents")
    passage = "".join(r.choice("abcdefgh ") for _ in range(260))
    rows = [(i, t) for i, t in rows if i is not None][:80]
    top = max(i for i, _ in rows)
    extra = [passage, "q" + passage, passage[3:180] + "!", "é" + passage[40:141], passage[50:149], "z" * 700, "z" * 99,
             "ab" * 200, None, "", "x" * 100, "x" * 101, passage + passage, rows[3][1], (rows[4][1] or "")[::-1]]
    rows += [(top + 1 + k, t) for k, t in enumerate(extra)]
    got = {x.doc_id: (x.n_bytes, x.n_removed, len(x.spans), x.kept_sha256)
           for x in cut_repeats(frame(spark, rows, 5)).collect()}
    assert got == brute.cut_repeats(rows)


def test_repeats_when_batches_are_tiny(spark):
    """The streaming passes give the same over many small batches."""
    r = random.Random(2)
    passage = "".join(r.choice("abcdefgh ") for _ in range(400))
    rows = []
    for k in range(60):
        a, b = sorted(r.sample(range(400), 2))
        rows.append((k, "".join(r.choice("uvw") for _ in range(r.randrange(60))) + passage[a:b]
                     + "".join(r.choice("uvw") for _ in range(r.randrange(60)))))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {x.doc_id: (x.n_bytes, x.n_removed, len(x.spans), x.kept_sha256)
               for x in cut_repeats(frame(spark, rows, 4)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == brute.cut_repeats(rows)


def test_repeated_rows_do_not_repeat_each_other(spark):
    r = random.Random(4)
    text = "".join(r.choice("abcdef") for _ in range(300))
    got = cut_repeats(frame(spark, [(1, text), (1, text), (2, text), (None, text)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 300)]


@pytest.mark.parametrize("run", [
    lambda d: similarity_classes(d, 3, 90), exact_duplicates, cut_repeats,
    lambda d: contamination(d, d.sparkSession.createDataFrame([(1, "one two")], "item_id long, text string"))])
def test_empty_tables(spark, run):
    assert run(frame(spark, [])).collect() == []


def test_no_benchmark_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in contamination(frame(spark, [(1, "a b")]), none).collect()] == [(1, 2, 0, 0)]


def test_merged_runs_join_where_they_touch():
    place = repeats._place(np.array([0, 100, 250]), 0, np.array([0, 5, 0]))
    assert repeats.merged_runs(place, 1000) == [(0, 205), (250, 350)]
    assert repeats.merged_runs(place, 300) == [(0, 205), (250, 300)]


def test_links_across_many_size_bands(spark):
    """Linked sets of 2 and 10 words lie four bands apart at threshold 20."""
    docs = spark.createDataFrame([(1, "a b"), (2, "a b c d e f g h i j"), (3, "x y")], "doc_id long, text string")
    got = {r.doc_id: r for r in similarity_classes(docs, words=1, threshold=20).collect()}
    assert got[2].component_id == 1 and got[1].n_links == got[2].n_links == 1 and got[3].component_id == 3
    assert jaccard_join.bands_back(jaccard_join.plan_bands(100_000, 20)) == 4


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


def test_long_words_that_collide_in_sums_are_told_apart(spark):
    one, two = thue_morse(2048), thue_morse(2048, "b", "a")
    got = {r.doc_id: (r.component_id, r.n_links) for r in similarity_classes(
        frame(spark, [(1, one), (2, two), (3, one + " x"), (4, two + " x")]), 3, 90).collect()}
    assert got == {i: (i, 0) for i in (1, 2, 3, 4)}


def test_reordered_windows_are_not_near(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    w = item.split()
    rows = [(1, item), (2, " ".join(w[::-1])), (3, " ".join([w[1], w[0], *w[2:]])), (4, " ".join(w[5:] + w[:5])),
            (5, " ".join(w[:4] + ["x", "y"] + w[4:])), (6, " ".join(w[:4] + ["x", "y", "z"] + w[4:]))]
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_near_items) for r in contamination(frame(spark, rows), bench).collect()}
    assert got[1] == (10, 0) and got[3] == (0, 1)
    assert got[2] == got[4] == got[6] == (0, 0) and got[5][0] == 0


def test_rows_without_an_id_or_with_a_shared_one_are_documents_too(spark, near_rows):
    text = " ".join(f"w{k}" for k in range(40))
    close = text + " and"
    rows = [(5, text), (5, "other words only here, never seen " * 3), (9, close), (None, text), (None, "lonely " * 9), (None, None), (7, "q r s")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in
                  similarity_classes(frame(spark, rows), 5, 80).collect()), key=str)
    assert got == sorted([(5, 36, 5, 2), (5, 6, 5, 0), (9, 37, 5, 2), (None, 36, 5, 2), (None, 1, None, 0), (None, 0, None, 0),
                          (7, 1, 7, 0)], key=str)
    bench = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(12)))], "item_id long, text string")
    hits = sorted(((r.doc_id, r.n_hit) for r in contamination(frame(spark, rows), bench).collect()), key=str)
    assert hits == sorted([(5, 12), (5, 0), (9, 12), (None, 12), (None, 0), (None, 0), (7, 0)], key=str)


def test_a_hot_text_and_very_long_texts(spark):
    long = "lorem ipsum " * 60_000
    rows = [(i, "the same") for i in range(3000)] + [(i, f"own {i}") for i in range(3000, 4000)] + [
        (5000, long), (5001, long), (5002, long + "x")]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_duplicates(frame(spark, rows)).collect()}
    assert got[0] == (2999, 3000, False) and got[2999] == (2999, 3000, True) and got[3500] == (3500, 1, True)
    assert got[5000] == (5001, 2, False) and got[5002] == (5002, 1, True) and len(got) == 4003


def test_rows_of_hot_groups_are_dealt_evenly(spark, monkeypatch):
    from loanlens.llm import common

    monkeypatch.setattr(common, "HOT_PART", 20)
    rows = spark.range(2000).selectExpr("id", "cast(if(id % 3 = 0, 0, id div 10) as int) AS k")
    groups = common.save_table(rows.groupBy("k").count().where("count > 1").withColumnRenamed("count", "n"), "groups")
    met = common.attach_groups(rows, groups, ["k"], "n", 2000)
    assert "hashpartitioning(k#" in (plan := met._jdf.queryExecution().toString()) and "_deal#" in [
        line for line in plan.splitlines() if "hashpartitioning(k#" in line][0]
    got = {r.id: r.n for r in met.collect()}
    sizes = {r.k: r["count"] for r in rows.groupBy("k").count().collect()}
    assert got == {r.id: sizes[r.k] if sizes[r.k] > 1 else None for r in rows.collect()} and len(got) == 2000
