"""Token files, spelling variants and centroid clustering against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loanlens.llm import centroids, spelling, token_files
from loanlens.llm.centroids import VantageTree, cluster_report, cluster_vectors
from loanlens.llm.spelling import damaged, near_words, spelling_variants
from loanlens.llm.token_files import Encoder, read_token_files, token_report, write_token_files

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


# ------------------------------------------------------------- token files

PARTS = [" ", "  ", "\n", "\t", "\xa0", " ", "　", "\x85", "a", "b", "word", "Word", "'s", "'ll", "é", "漢", "1", "23", ".",
         ",", "!", "<|endoftext|>", "<|endo", "|>", "​", "\x00", "\x1f", "\x7f", "﻿", "😀", "é"]


def test_pieces_encode_as_whole_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "_CACHE_IDS", 400)      # forgets all the time
    monkeypatch.setattr(token_files, "_STEP_BYTES", 5_000)
    with open(VOCABULARY, encoding="utf-8") as f:
        encoder = Encoder(f.read())
    assert encoder.safe
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 40))) for _ in range(4000)] + [None, "", " ", "x" * 9000]
    got = []
    for _, ids, counts in encoder.chunks(pa.array(texts), 0):
        got += [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids + [0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_unsafe_tokenizers_encode_whole_texts():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    encoder, plain = Encoder(spec), Tokenizer.from_str(spec)
    assert not encoder.safe
    texts = ["Hello  big World.", "", "a, b"]
    got = [ids.tolist() for _, ids, _ in encoder.chunks(pa.array(texts), 0)]
    assert sum(got, []) == sum((plain.encode(t, add_special_tokens=False).ids + [0] for t in texts), [])


def test_files_hold_every_document_in_id_order(spark, tokenizer, tmp_path):
    r = random.Random(5)
    rows = [(r.randint(-50, 10**12), " ".join(r.choices(PARTS[8:], k=r.randint(0, 60))), 1) for _ in range(700)]
    rows += [(None, "no id", 1), (None, None, 1), (7, None, 1), (8, "", 1), (9, "w " * 60_000, 1)]
    rows += [(5, f"hot {i % 300}", 1) for i in range(900)] + [(6, "same", 1)] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(5)
    folder = write_token_files(df, VOCABULARY, folder=str(tmp_path / "tokens"), shard_bytes=30_000)
    back = read_token_files(spark, folder, step=64).orderBy("start").collect()
    assert [b.doc_id for b in back] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    at, seen = 0, Counter()
    for b in back:
        assert b.start == at and b.ids[-1] == 0
        at += len(b.ids)
        seen[(b.doc_id, tuple(b.ids))] += 1
    assert seen == Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, _ in rows)
    manifest = spark.read.parquet(folder + "/manifest").orderBy("shard").collect()
    assert sum(m.docs for m in manifest) == len(rows) and len([m for m in manifest if m.docs]) > 4
    shard = manifest[0]
    flat = np.fromfile(f"{folder}/shard-{shard.shard:06d}.ids", "<u2")
    offsets = np.fromfile(f"{folder}/shard-{shard.shard:06d}.idx", "<i8")
    assert shard.width == "<u2" and len(flat) == shard.tokens == offsets[-1] and len(offsets) == shard.docs + 1
    report = {r.start: (r.doc_id, r.n_tokens, r.ids_crc32) for r in token_report(df, VOCABULARY).collect()}
    assert report == {b.start: (b.doc_id, len(b.ids), zlib.crc32(np.array(b.ids, "<u4").tobytes())) for b in back}


def test_no_documents_no_token_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_report(empty, VOCABULARY).collect() == []


# ------------------------------------------------------- spelling variants

def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.fixture(scope="module")
def vocabulary():
    r = random.Random(11)
    words = {"".join(r.choices("abé", k=r.randint(2, 9))) for _ in range(900)}
    words |= {"x" * 700, "x" * 701, "x" * 350 + "y" + "x" * 349, "prefixes", "prefixed", "prefix", "prefixs", "ab", "aab"}
    return sorted(words)


@pytest.mark.parametrize("block", [3, 70, 4096])
def test_near_words_are_all_pairs_one_error_apart(spark, vocabulary, block):
    df = spark.createDataFrame([(w, len(w)) for w in vocabulary if len(w) > 2], "word string, n long").repartition(3)
    got = [(r.word, r.near, r.near_n) for r in near_words(df, block).collect()]
    long = [w for w in vocabulary if len(w) > 2]
    want = {(a, b, len(b)) for a in long for b in long if near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500


def test_damage_deletes_one_letter_of_some_words(spark):
    words = [f"wörter{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    df = spark.createDataFrame([(i % 3 or None, w) for i, w in enumerate(words)], "doc_id long, w string")
    from pyspark.sql import functions as F

    got = [r[0] for r in df.select(damaged(F.col("w"), F.col("doc_id"), 7)).collect()]
    want = []
    for i, w in enumerate(words):
        h = zlib.crc32(f"{i % 3 or ''}:{w}".encode())
        k = h % len(w)
        want.append(w[:k] + w[k + 1:] if h % 7 == 0 else w)
    assert sorted(got) == sorted(want) and got != words


def test_variants_follow_forms_to_their_roots(spark):
    counts = {"letters": 700, "leters": 130, "leterz": 20, "letterss": 6, "singles": 9, "Ünique": 5, "ünique": 30, "rare": 90,
              "equalab": 50, "equalac": 50, "equalax": 6}
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    rows = [(1, text, 1), (2, None, 1), (3, "", 1), (None, "LETTERS, letters-letters", 1), (4, "few few", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word int").repartition(2)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(df).collect()}
    assert got == {
        "letters": (None, "letters", 703, 2, None), "leters": ("letters", "letters", 130, 2, 703),
        "leterz": ("leters", "letters", 20, 1, 130), "letterss": ("letters", "letters", 6, 1, 703),
        "singles": (None, "singles", 9, 0, None), "Ünique": ("ünique", "ünique", 5, 1, 30), "ünique": (None, "ünique", 30, 1, None),
        "equalab": (None, "equalab", 50, 2, None), "equalac": (None, "equalac", 50, 2, None),
        "equalax": ("equalab", "equalab", 6, 2, 50)}
    assert spelling_variants(df.limit(0)).collect() == []


def test_variants_of_a_corpus_against_a_plain_version(spark):
    r = random.Random(2)
    stems = ["".join(r.choices("abcdefgh", k=r.randint(5, 9))) for _ in range(60)]
    rows = [(i, " ".join(r.choices(stems, weights=range(60, 0, -1), k=200)).title() if i % 3 else " ".join(r.choices(stems, k=90)))
            for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counts = Counter()
    for i, t in rows:
        for w in t.lower().split():
            h = zlib.crc32(f"{i}:{w}".encode())
            k = h % len(w)
            counts[w[:k] + w[k + 1:] if h % 19 == 0 else w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    by, form = defaultdict(list), {}
    for w in words:
        by[w] = [x for x in words if near(w, x)]
        best = min(by[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 5 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    want = {w: (form.get(w), root(w), n, len(by[w]), words.get(form.get(w))) for w, n in words.items()}
    got = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in spelling_variants(df, damage_every=19).collect()}
    assert got == want and len(form) > 20


# ------------------------------------------------------ centroid clustering

@pytest.mark.parametrize("k, dim, spread", [(1, 3, 5), (2, 2, 1), (16, 64, 40), (40, 3, 3), (7, 4, 10**6)])
def test_tree_finds_the_nearest_centroid_and_the_smallest_on_ties(k, dim, spread):
    r = np.random.default_rng(k)
    points = r.integers(-spread, spread + 1, (k, dim))
    points[-1] = points[0]          # equal centroids
    x = np.concatenate([r.integers(-spread, spread + 1, (500, dim)), points])
    number, d2 = VantageTree(points).nearest(x)
    all_d2 = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert np.array_equal(d2, all_d2.min(axis=1)) and np.array_equal(number, all_d2.argmin(axis=1))


def plain_clusters(rows, k, rounds, dim, scale=64, seed=1):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in start[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        cents = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if groups[j] else c for j, c in enumerate(cents)]
    found = [(i, *nearest(v)) for i, v in kept]
    per = Counter()
    for _, d, j in found:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(i), j, d, per[j], sum(per.values()), sha[j]) for i, d, j in found)


def test_clusters_match_a_plain_version_with_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(centroids, "_BLOCK_CELLS", 4_000)
    r = random.Random(9)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [r.gauss(i % 4, 0.3) for _ in range(5)]) for i in range(400)]
    rows += [(900, [0.25] * 5)] * 300 + [(None, [0.1] * 5), (None, None), (901, None), (902, []), (903, [1.0] * 4), (904, [1.0] * 6),
             (905, [1.0, None, 1.0, 1.0, 1.0]), (906, [nan] * 5), (907, [inf, 0.0, 0.0, 0.0, 0.0]), (908, [-0.001] * 5)]
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, cluster int, distance string").repartition(6)
    got = sorted((str(x.vec_id), x.cluster, x.distance, x.cluster_inertia, x.inertia, x.centroid_sha256)
                 for x in cluster_report(df, k=6, dim=5).collect())
    assert got == plain_clusters(rows, 6, 3, 5)
    few = spark.createDataFrame([(1, [1.0, 2.0]), (2, [5.0, 5.0])], "vec_id long, embedding array<float>")
    assert {x.distance for x in cluster_report(few, k=16, dim=2).collect()} == {0}
    assert cluster_report(few.limit(0), dim=2).collect() == []


def test_components_too_large_for_exact_distances_stop_the_job(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        cluster_vectors(df, dim=2)
