"""Exact set-similarity self-join on word shingles by universe partition (op 3).

Two sets link when ``100 * |r & s| >= t * |r | s|``; then they differ in at
most H tokens, where H follows from their sizes. For each size band the token
universe is cut by hash into m segments. Allocation 1 gives a segment's whole
content as signature; allocation 2 adds its one-deletion neighbourhood, so the
segment also matches when one side has one token more. As the allocations of a
band sum to more than H, two linked sets agree in some signature (pigeonhole).

Cost-based allocation works on two levels. Per band, :func:`plan_bands`
compares many exact segments with few one-deletion segments by estimated rows
and chance matches. Per set, segments get allocation 0 where they would match
most: a band has more segments than H + 1, and a set that can differ from any
partner in at most h tokens indexes only its h + 1 best ones. "Best" is an
order of contents (most tokens off a bounded list of frequent shingles first,
then by hash), the same for every set. Two linked sets agree in at least
m - h segments; the best of those has at least m - h - 1 worse ones on either
side, so it is among the h + 1 best of both: nothing is lost. (With one-deletion
segments, whose contents differ between the sides, a signature without a rare
token is left out only while spare segments last, and two sets that both run
out of them both emit theirs.) The frequent list only moves cost, never results.

Flow: one pass gives each document its set key (equal sets collapse into one
class); a second emits signatures, pre-aggregated per chunk into a pivot row
plus star edges, so a hot signature brings one row per chunk to its task;
star edges join into candidate groups; each group's classes are compared
exactly inside tasks by counting shared tokens through postings. Large groups
are cut by size class and block, and block pairs meet in separate tasks, so
memory is bounded by two blocks; each task returns a spanning forest and link
counts, never all pairs.

Edge cases: null or empty text (or only white space) is an empty set, linked
with nothing, its own component; rows with a null id or one that other texts
share are linked like others (:func:`number_rows`), and their component is the
smallest id that links reach, null if none does; repeated rows are copies; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (ByteHash, LOWER, connected_components, mix, number_rows, save_table, ship_package, signed, text_chunks,
                     word_spans)

#: Tokens in one comparison block.
BLOCK_TOKENS = 1_000_000
#: Most entries of the frequent-shingle list (8 bytes each).
FREQUENT_LIMIT = 131_072
#: A shingle counts for that list where a chunk of documents has it this often.
FREQUENT_IN_CHUNK = 2


@dataclass(frozen=True)
class Band:
    """One size band: sets of ``low..high`` tokens as the smaller side."""

    low: int
    high: int
    reach: int       # largest partner size
    segments: int    # 0: only equal sets can link
    deletions: bool  # allocation 2 on every segment


def max_difference(n: np.ndarray | int, other: np.ndarray | int, t: int):
    """Most tokens in which two linked sets of these sizes can differ."""
    return (n + other) * (100 - t) // (100 + t)


def plan_bands(largest: int, t: int, chance: float = 0.05, population: float = 1e6) -> list[Band]:
    """Bands up to ``largest`` tokens with their segment count and allocation.

    ``chance`` is the share of frequent tokens in a text and ``population`` the
    sets in a band: a segment of k tokens is taken to match by chance with
    ``population * chance ** k`` sets. Costs are signature rows plus those.
    """
    bands, low = [], 1
    ratio = 1.3 if t >= 90 else 1.5
    while low <= max(1, largest):
        high = max(low, int(low * ratio) - 1)
        reach = high * 100 // t
        h = int(max_difference(high, reach, t))
        if h == 0:
            bands.append(Band(low, high, reach, 0, False))
        else:
            whole = h + 2 + h // 6
            pairs = h // 2 + 2 + (h // 2 + 1) // 25
            cost_whole = whole * (1 + population * chance ** (low / whole))
            cost_pairs = (pairs + high) * (1 + population * chance ** (low / pairs - 1))
            deletions = cost_pairs < cost_whole and high <= 64
            bands.append(Band(low, high, reach, pairs if deletions else whole, deletions))
        low = high + 1
    return bands


def bands_back(bands: list[Band]) -> int:
    """Most bands between a set's own band and a lower one whose reach covers it."""
    lows = [b.low for b in bands]
    return max((int(np.searchsorted(lows, b.reach, "right")) - 1 - k for k, b in enumerate(bands)), default=0)


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hash, document number, set size): distinct shingles, sorted within documents."""
    start, end, doc = word_spans(data, offs)
    docs = len(offs) - 1
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(docs, np.int64)
    w = ByteHash(LOWER[data]).ranges(start, end)
    per_doc = np.bincount(doc, minlength=docs)
    n = len(w)
    full = np.flatnonzero(doc[: n - words + 1] == doc[words - 1:]) if n >= words else np.zeros(0, np.int64)
    found, of = [], []

    def shingle(at: np.ndarray, size: int) -> None:
        acc = mix(w[at] + np.uint64(size))
        for k in range(1, size):
            acc = mix(acc + w[at + k] * np.uint64(2 * k + 1))
        found.append(acc)
        of.append(doc[at])

    shingle(full, words)
    begins = np.searchsorted(doc, np.arange(docs))
    for size in range(1, words):
        shingle(begins[per_doc == size], size)
    h, d = np.concatenate(found), np.concatenate(of)
    order = np.argsort(h)
    order = order[np.argsort(d[order].astype(np.uint16), kind="stable")]
    h, d = h[order], d[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[keep], d[keep]
    return h, d, np.bincount(d, minlength=docs)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, values.dtype)


def set_keys(h: np.ndarray, d: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums over each document's set (together its key)."""
    keys = np.zeros((2, len(size)), np.uint64)
    starts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]]) if len(d) else np.zeros(0, np.int64)
    for k in range(2):
        keys[k, d[starts]] = _sums(mix(h + np.uint64(0x51ED270B + 7919 * k)), starts)
    return keys[0], keys[1]


def signatures(h: np.ndarray, d: np.ndarray, size: np.ndarray, bands: list[Band], t: int,
               frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, document number) of each set for each band instance it takes part in."""
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lows = np.array([b.low for b in bands])
    own = np.searchsorted(lows, size, "right") - 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        rare_token = (frequent[at] != h).astype(np.int64)
    else:
        rare_token = np.ones(len(h), np.int64)
    value = mix(h ^ np.uint64(0xA5A5A5A55A5A5A5A))
    high32 = h >> np.uint64(32)
    out_s, out_d = [], []
    for back in range(bands_back(bands) + 1):
        inst = own - back
        ok = (inst >= 0) & (size > 0)
        reach = np.array([b.reach for b in bands])[np.maximum(inst, 0)]
        segs = np.array([b.segments for b in bands])[np.maximum(inst, 0)]
        highs = np.array([b.high for b in bands])[np.maximum(inst, 0)]
        dele = np.array([b.deletions for b in bands])[np.maximum(inst, 0)]
        ok &= (size <= reach) & (segs > 0)
        if not ok.any():
            continue
        # the largest difference this set can have with a partner in this instance
        partner = size * 100 // t if back == 0 else highs
        worst = max_difference(size, partner, t)
        pick = ok[d]
        hd, hv, rr = d[pick], value[pick], rare_token[pick]
        m = segs[hd].astype(np.uint64)
        seg = (high32[pick] * m) >> np.uint64(32)
        new = np.r_[True, (hd[1:] != hd[:-1]) | (seg[1:] != seg[:-1])]
        starts = np.flatnonzero(new)
        sd, sg = hd[starts], seg[starts].astype(np.int64)
        total, rare = _sums(hv, starts), _sums(rr, starts)
        tag = mix(sg.astype(np.uint64) + (inst[sd].astype(np.uint64) << np.uint64(32)))
        sig = mix(total + tag)
        docs = np.flatnonzero(ok)
        filled = np.bincount(sd, minlength=len(size))
        # whole segments: the worst + 1 best; empty segments are the worst of all
        need = worst + 1
        order = np.argsort(((255 - np.minimum(rare, 255)).astype(np.uint64) << np.uint64(56)) | (sig >> np.uint64(8)))
        order = order[np.argsort(sd[order].astype(np.uint16), kind="stable")]
        rank = np.empty(len(sd), np.int64)
        rank[order] = np.arange(len(sd)) - np.searchsorted(sd, np.arange(len(size)))[sd[order]]
        # one-deletion segments: those without a rare token are skipped while spare ones last
        skipped = segs - filled + np.bincount(sd, weights=rare <= 1, minlength=len(size)).astype(np.int64)
        short = dele & (skipped > segs - 1 - worst // 2)
        keep = np.where(dele[sd], (rare > 0) | short[sd], rank < need[sd])
        out_s.append(sig[keep])
        out_d.append(sd[keep])
        missing = np.where(dele, short * segs, need) - filled
        for x in docs[missing[docs] > 0]:
            empty = np.setdiff1d(np.arange(segs[x]), sg[sd == x])
            e_sig = mix(mix(empty.astype(np.uint64) + (np.uint64(inst[x]) << np.uint64(32))))
            out_s.append(e_sig if dele[x] else np.sort(e_sig)[: missing[x]])
            out_d.append(np.full(len(out_s[-1]), x))
        if dele[docs].any():  # one-deletion neighbourhoods
            of = np.cumsum(new) - 1
            rest_rare = rare[of] - rr
            take = dele[hd] & ((rest_rare > 0) | short[hd])
            out_s.append(mix((total[of] - hv)[take] + tag[of][take]))
            out_d.append(hd[take])
    if not out_s:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_s), np.concatenate(out_d)


def _key_pass(words: int, doc_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            for i, j, data, offs in text_chunks(text):
                h, d, size = shingle_sets(data, offs, words)
                k1, k2 = set_keys(h, d, size)
                common, times = np.unique(h, return_counts=True)
                common, times = common[times >= FREQUENT_IN_CHUNK], times[times >= FREQUENT_IN_CHUNK]
                n, f = j - i, len(common)
                yield pa.record_batch([
                    pa.concat_arrays([ids.slice(i, n).cast(doc_type), pa.nulls(f, doc_type)]),
                    pa.array(np.r_[size, times]),
                    pa.array(np.r_[signed(k1), signed(common)]),
                    pa.array(np.r_[signed(k2), np.zeros(f, np.int64)]),
                    pa.array(np.r_[np.zeros(n, bool), np.ones(f, bool)]),
                ], names=["doc_id", "n_shingles", "k1", "k2", "is_token"])
    return run


def _star(sig: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pivot rows (sig, p, p) and edge rows (spread key, p, member) of one chunk."""
    if not len(sig):
        return sig, doc, doc
    order = np.lexsort((doc, sig))
    sig, doc = sig[order], doc[order]
    first = np.r_[True, sig[1:] != sig[:-1]]
    pivot = doc[np.flatnonzero(first)][np.cumsum(first) - 1]
    edge = np.unique(np.stack([pivot, doc])[:, ~first & (pivot != doc)], axis=1)
    key = mix(edge[0].view(np.uint64) * np.uint64(31) + edge[1].view(np.uint64))
    return (np.r_[sig[first], key], np.r_[doc[first], edge[0]], np.r_[doc[first], edge[1]])


def _signature_pass(words: int, bands: list[Band], t: int, frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, data, offs in text_chunks(batch.column(1)):
                h, d, size = shingle_sets(data, offs, words)
                s, of = signatures(h, d, size, bands, t, frequent)
                sig, a, b = _star(s, ids[i:j][of])
                yield pa.record_batch([pa.array(signed(sig)), pa.array(a), pa.array(b)],
                                      names=["sig", "a", "b"])
    return run


def _bucket_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (sig, a): joins the pivots of one signature into a star.

    Only the last signature and its pivot are kept between batches.
    """
    last, pivot = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, a, b = (batch.column(k).to_numpy() for k in range(3))
        edge = a != b
        out_a, out_b = [a[edge]], [b[edge]]
        sig, a = sig[~edge], a[~edge]
        if len(sig):
            first = np.r_[sig[0] != last, sig[1:] != sig[:-1]]
            starts = np.flatnonzero(first)
            head = np.r_[pivot, a[starts]]
            mine = head[np.cumsum(first)]
            hit = ~first & (mine != a)
            out_a.append(mine[hit])
            out_b.append(a[hit])
            last, pivot = sig[-1], mine[-1]
        x, y = np.concatenate(out_a), np.concatenate(out_b)
        if len(x):
            yield pa.record_batch([pa.array(x), pa.array(y)], names=["a", "b"])


def _set_pass(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = [batch.column(k).to_numpy() for k in (2, 3)]
            for i, j, data, offs in text_chunks(batch.column(1)):
                h, d, size = shingle_sets(data, offs, words)
                k1, k2 = set_keys(h, d, size)
                same = (signed(k1) == want[0][i:j]) & (signed(k2) == want[1][i:j])
                cut = np.r_[0, np.cumsum(size)]
                keep = pa.array(same)
                sets = pa.array([h[cut[k]: cut[k + 1]].tobytes() for k in range(j - i)], pa.binary())
                rest = [batch.column(k).slice(i, j - i).filter(keep) for k in (0, *range(4, batch.num_columns))]
                yield pa.record_batch(
                    [rest[0], sets.filter(keep), *rest[1:]],
                    names=["doc_id", "tokens", *batch.schema.names[4:]])
    return run


def block_links(ids: np.ndarray, side: np.ndarray, weight: np.ndarray, sets: list[np.ndarray],
                t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forest edges and link counts among sets; sides 0 and 1 meet only each other, 2 meets all.

    Shared tokens are counted through postings, one set against the block.
    """
    n = len(ids)
    size = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(n), size)
    order = np.argsort(tokens, kind="stable")
    ordered = tokens[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
    group = np.empty(len(tokens), np.int64)
    group[order] = np.cumsum(first) - 1
    g_start = np.r_[np.flatnonzero(first), len(ordered)]
    postings = of[order]
    cut = np.r_[0, np.cumsum(size)]
    parent = np.arange(n)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges, links = [], np.zeros(n, np.int64)
    for x in range(n):
        g = group[cut[x]: cut[x + 1]]
        a, b = g_start[g], g_start[g + 1]
        shared = b - a > 1
        a, b = a[shared], b[shared]
        if not len(a):
            continue
        span = b - a
        idx = np.repeat(a - np.r_[0, np.cumsum(span)[:-1]], span) + np.arange(span.sum())
        both = np.bincount(postings[idx], minlength=n)
        hit = 100 * both >= t * (size[x] + size - both)
        hit &= (side == 2) | (side[x] == 2) | (side != side[x])
        hit[x] = False
        near = np.flatnonzero(hit)
        links[x] = weight[near].sum()
        for y in near[near > x]:
            p, q = root(x), root(y)
            if p != q:
                parent[q] = p
                edges.append((ids[x], ids[y]))
    e = np.array(edges, np.int64).reshape(-1, 2)
    has = links > 0
    return (np.r_[e[:, 0], ids[has]], np.r_[e[:, 1], ids[has]],
            np.r_[np.zeros(len(e), np.int64), links[has]])


def _compare(t: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        _, pick = np.unique(ids, return_index=True)  # rows repeated whole
        blobs = table.column("tokens").to_pylist()
        a, b, n = block_links(ids[pick], table.column("side").to_numpy()[pick],
                              table.column("copies").to_numpy()[pick],
                              [np.frombuffer(blobs[k], np.uint64) for k in pick], t)
        return pa.table({"a": a, "b": b, "links": n})
    return run


def _cells(groups: DataFrame, t: int) -> DataFrame:
    """Classes of candidate groups dealt to comparison cells (cell, side).

    Groups below a block are packed together (any link found is a true one);
    a larger group is cut by size class and, within it, into blocks, and a
    class goes to each pair of its block with a block it can link to.
    """
    sized = groups.groupBy("component").agg(F.sum("n_shingles").alias("tokens"))
    total = sized.where(F.col("tokens") <= BLOCK_TOKENS).agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("all_tokens")).first()[0]
    packs = int(total // BLOCK_TOKENS) + 1
    parts = groups.join(sized, "component")
    small = parts.where(F.col("tokens") <= BLOCK_TOKENS).select(
        "doc_id", "k1", "k2", "copies",
        F.concat(F.lit("p"), F.pmod(F.xxhash64("component"), F.lit(packs)).cast("string")).alias("cell"),
        F.lit(2).cast("long").alias("side"))
    step = float(np.log(100 / t)) * 1.000001  # linked sizes differ by one class at most
    large = parts.where(F.col("tokens") > BLOCK_TOKENS).withColumn(
        "cls", F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(step)))
    blocks = large.groupBy("component", "cls").agg(
        F.ceil(F.sum("n_shingles") / F.lit(BLOCK_TOKENS)).cast("int").alias("blocks"))
    mine = large.join(blocks, ["component", "cls"]).withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    others = blocks.select("component", F.col("cls").alias("cls_o"), F.col("blocks").alias("blocks_o"),
                           F.explode(F.sequence(F.col("cls") - 1, F.col("cls") + 1)).alias("cls"))
    dealt = (mine.join(others, ["component", "cls"])
             .withColumn("block_o", F.explode(F.sequence(F.lit(0), F.col("blocks_o") - 1)))
             .withColumn("here", F.struct("cls", "block"))
             .withColumn("there", F.struct(F.col("cls_o").alias("cls"), F.col("block_o").alias("block"))))
    large_rows = dealt.select(
        "doc_id", "k1", "k2", "copies",
        F.concat_ws(":", F.col("component").cast("string"),
                    F.least("here", "there").cast("string"),
                    F.greatest("here", "there").cast("string")).alias("cell"),
        F.when(F.col("here") == F.col("there"), 2).when(F.col("here") < F.col("there"), 0)
        .otherwise(1).cast("long").alias("side"))
    return small.union(large_rows)


def similarity_classes(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, n_links.

    ``threshold`` is in percent. ``component_id`` is the smallest doc_id that
    links reach; ``n_links`` counts the other rows a row links to directly.
    """
    ship_package(docs.sparkSession)
    rows, numbers = number_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    found = _numbered_classes(rows.select(F.col("_row").alias("doc_id"), "text"), words, threshold)
    if numbers is None:
        return found
    # rows without an id or with a shared one: back from their numbers to ids
    found = save_table(found.join(numbers, F.col("doc_id") == F.col("_new"), "left").withColumn(
        "given", F.when(F.col("_new").isNull(), F.col("doc_id")).otherwise(F.col("_odd"))), "jaccard-numbered")
    least = found.groupBy(F.col("component_id")).agg(F.min("given").alias("least"))
    return found.join(least, "component_id").select(
        F.col("given").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"), "n_links")


def _numbered_classes(table: DataFrame, words: int, threshold: int) -> DataFrame:
    """:func:`similarity_classes` of a table whose ids each stand for one text."""
    keyed = save_table(table.mapInArrow(
        _key_pass(words, pa.int64()),
        "doc_id long, n_shingles long, k1 long, k2 long, is_token boolean"), "jaccard-keys")
    rows = keyed.where(~F.col("is_token")).select("doc_id", "n_shingles", "k1", "k2")
    # stored, so that the joins below read plain shuffles, which Spark can split at a hot class
    classes = save_table(rows.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2", "n_shingles")
                         .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "jaccard-classes")
    top = (keyed.where("is_token").groupBy("k1").agg(F.sum("n_shingles").alias("times"))
           .orderBy(F.desc("times"), "k1").limit(FREQUENT_LIMIT).select("k1").collect())
    frequent = np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))
    largest = rows.agg(F.max("n_shingles")).first()[0] or 0
    bands = plan_bands(int(largest), threshold)

    sigs = table.where("doc_id is not null").mapInArrow(
        _signature_pass(words, bands, threshold, frequent), "sig long, a long, b long")
    stars = sigs.repartition("sig").sortWithinPartitions("sig", "a").mapInArrow(
        _bucket_pass, "a long, b long").distinct()
    reps = rows.where("n_shingles > 0 and doc_id is not null").join(
        classes, ["k1", "k2", "n_shingles"]).groupBy("doc_id").agg(F.min("rep").alias("rep"))
    edges = (stars.join(reps.select(F.col("doc_id").alias("a"), F.col("rep").alias("ra")), "a")
             .join(reps.select(F.col("doc_id").alias("b"), F.col("rep").alias("rb")), "b")
             .select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    candidates = connected_components(edges)

    members = classes.select(F.col("rep").alias("doc_id"), "k1", "k2", "n_shingles", "copies")
    groups = save_table(members.join(candidates.withColumnRenamed("node", "doc_id"), "doc_id"), "jaccard-groups")
    cells = save_table(_cells(groups, threshold), "jaccard-cells")
    with_text = table.join(
        cells.groupBy("doc_id", "k1", "k2", "copies").agg(
            F.collect_list(F.struct("cell", "side")).alias("to")).hint("shuffle_hash"), "doc_id").select(
        "doc_id", "text", "k1", "k2", "copies", "to")
    sets = with_text.mapInArrow(
        _set_pass(words), "doc_id long, tokens binary, copies long, to array<struct<cell:string,side:long>>")
    found = save_table(
        sets.select("doc_id", "tokens", "copies", F.inline("to")).groupBy("cell").applyInArrow(
            _compare(threshold), "a long, b long, links long"), "jaccard-links")
    components = connected_components(found.where("a <> b").select("a", "b"))
    links = found.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    return (rows.join(classes, ["k1", "k2", "n_shingles"], "left")
            .join(components.withColumnRenamed("node", "rep"), "rep", "left")
            .join(links, "rep", "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("component", "rep", "doc_id").alias("component_id"),
                    (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0)))
                    .cast("long").alias("n_links")))
