"""Toxicity by a classifier chain of linear models (op 5).

Links follow one another: each category's logistic model reads which hashed
words and word beginnings a text has, plus the probabilities of all earlier
links. For training, those earlier probabilities are out-of-fold predictions,
so a later link never sees a model's answer for a row it was fitted on; for
scoring, links fitted on all training rows are chained. Categories are columns
of the labels where ``categories`` names some. Where the labels just say toxic
or not, they are found in the training rows: the features that toxic texts have
much more often than others are split in two by which of them occur together in
toxic texts (second singular vector of their row matrix), a toxic row belongs
to the group that more of its features are in, and to ``other`` without any.
Each fold's out-of-fold answers use groups found without that fold. The last
link is the label itself and decides.

Fitting reads at most ``max_rows`` labelled rows (by hash order of their id),
whose features Spark computes and the driver fits; L1 keeps the models sparse,
so long clean texts do not add up noise. Three settings bound what a link may
learn from, and nothing else: features are hashed to ``bits`` bits, so some
share a weight; those in fewer than ``min_rows`` training rows are too rare to
weigh; a link chooses among the ``screened`` ones of largest label contrast.
Scoring reads every word of every text; it ships the few hundred weights
and runs over all rows as one narrow pass without a shuffle.

Edge cases: null or empty text has no features and scores by the intercepts;
without a toxic labelled row every probability is 0; several labels of one id
count as their maximum; null labels are ignored; repeated rows repeat their
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ByteHash, LOWER, mix, ship_package, text_chunks, word_spans

#: Links of labels without categories: two groups of toxic texts, those in neither, the label.
FOUND = ("group_1", "group_2", "other")

_NOT_LETTER = np.zeros(256, bool)
_NOT_LETTER[:128] = True
_NOT_LETTER[65:91] = _NOT_LETTER[97:123] = False


@dataclass(frozen=True)
class ChainSettings:
    """Training and feature settings."""

    max_rows: int = 6000     # labelled rows that fitting reads at most
    folds: int = 3
    bits: int = 20           # hashed feature space
    stems: tuple[int, ...] = (4, 6)  # bytes of word beginnings
    min_rows: int = 3        # training rows that must have a feature
    screened: int = 4000     # features with the largest label contrast that a link may use
    l1: float = 0.0003
    steps: int = 100
    categories: tuple[str, ...] = ()  # 0/1 columns of the labels; none: groups are found
    group_terms: int = 200   # features of largest contrast that tell the groups, and their least contrast
    group_contrast: float = 4.0

    @property
    def links(self) -> tuple[str, ...]:
        return (*(self.categories or FOUND), "toxic")


def text_features(data: np.ndarray, offs: np.ndarray, cfg: ChainSettings) -> tuple[np.ndarray, np.ndarray]:
    """(feature, document number) of every word and word beginning, repeats included."""
    start, end, doc = word_spans(data, offs, _NOT_LETTER)
    hashes = ByteHash(LOWER[data])
    shift = np.uint64(64 - cfg.bits)
    word = hashes.ranges(start, end) >> shift
    stems = [mix(hashes.ranges(start, np.minimum(start + n, end)) + np.uint64(n)) >> shift for n in cfg.stems]
    return np.concatenate([word, *stems]).astype(np.int64), np.tile(doc, 1 + len(stems))


@dataclass(frozen=True)
class Link:
    """One fitted link: sparse feature weights, weights of earlier links, intercept."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def probability(self, doc: np.ndarray, feature: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Per row of ``before`` (earlier probabilities); (doc, feature) pairs are distinct."""
        logit = self.intercept + before @ self.earlier
        if len(self.features) and len(feature):
            at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
            w = np.where(self.features[at] == feature, self.weights[at], 0.0)
            logit = logit + np.bincount(doc, weights=w, minlength=len(before))
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


_NEVER = Link(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), -60.0)


def fit_link(doc: np.ndarray, col: np.ndarray, names: np.ndarray, before: np.ndarray, y: np.ndarray,
             train: np.ndarray, cfg: ChainSettings) -> Link:
    """L1 logistic regression by accelerated proximal gradient on screened features.

    ``doc`` and ``col`` are the (row, feature number) pairs of all labelled rows
    and ``train`` marks those to fit on; ``names`` are the features' hashes.
    """
    if not y[train].any():
        return Link(_NEVER.features, _NEVER.weights, np.zeros(before.shape[1]), _NEVER.intercept)
    share = y[train].mean()
    have = np.bincount(col, weights=train[doc], minlength=len(names))
    pos = np.bincount(col, weights=(train * y)[doc], minlength=len(names))
    contrast = np.abs(pos - have * share) / np.sqrt(have * share * (1 - share) + 1e-9)
    contrast[have < cfg.min_rows] = 0
    kept = np.sort(np.argsort(-contrast, kind="stable")[: cfg.screened])
    kept = kept[contrast[kept] > 0]
    place = np.full(len(names), -1, np.int32)
    place[kept] = np.arange(len(kept))
    use = (place[col] >= 0) & train[doc]
    row = np.cumsum(train) - 1
    r, c = row[doc[use]].astype(np.int32), place[col[use]]
    before, y, rows = before[train], y[train], int(train.sum())
    k, e = len(kept), before.shape[1]

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(r, weights=w[:k][c], minlength=rows) + before @ w[k: k + e] + w[-1]

    def backward(g: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(c, weights=g[r], minlength=k), before.T @ g, g.sum()] / rows

    probe = np.ones(k + e + 1)
    for _ in range(12):  # largest curvature
        probe = backward(forward(probe))
        top = np.linalg.norm(probe)
        probe /= top
    step = 4 / top
    w = np.zeros(k + e + 1)
    w[-1] = np.log(share / max(1 - share, 1e-6))
    z, t = w.copy(), 1.0
    shrink = np.r_[np.full(k, cfg.l1 * step), np.zeros(e + 1)]
    for _ in range(cfg.steps):
        p = 1 / (1 + np.exp(-np.clip(forward(z), -60, 60)))
        nxt = z - step * backward(p - y)
        nxt = np.sign(nxt) * np.maximum(np.abs(nxt) - shrink, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = nxt + (t - 1) / t_next * (nxt - w)
        w, t = nxt, t_next
    used = np.flatnonzero(w[:k])
    return Link(names[kept[used]], w[:k][used], w[k: k + e], float(w[-1]))


def _feature_pass(cfg: ChainSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in text_chunks(batch.column(1)):
                feature, doc = text_features(data, offs, cfg)
                pairs = np.unique(doc << cfg.bits | feature)
                counts = np.bincount(pairs >> cfg.bits, minlength=j - i)
                values = pa.array((pairs & ((1 << cfg.bits) - 1)).astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), values)
                yield pa.record_batch([batch.column(0).slice(i, j - i), lists, batch.column(2).slice(i, j - i)],
                                      names=["doc_id", "features", "labels"])
    return run


def training_rows(docs: DataFrame, labels: DataFrame, cfg: ChainSettings) -> DataFrame:
    """At most ``max_rows`` labelled texts: doc_id, features, labels (categories, then toxic).

    An id whose rows differ counts once, with its last text in byte order.
    """
    ship_package(docs.sparkSession)
    told = [F.coalesce(F.max(F.col(c).cast("int")), F.lit(0)) for c in (*cfg.categories, "toxic")]
    picked = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg(F.array(*told).alias("labels")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.max_rows))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(picked), "doc_id")  # at most max_rows ids
    rows = rows.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("labels").alias("labels"))
    return rows.select("doc_id", "text", "labels").mapInArrow(
        _feature_pass(cfg), "doc_id long, features array<int>, labels array<int>")


def _training_arrays(rows: DataFrame, cfg: ChainSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row number, feature) pairs, labels (row, link) and ids of the bounded training rows, by id."""
    got = rows.toArrow().sort_by("doc_id")

    def lists(name: str) -> pa.Array:
        col = got.column(name).combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.list_(pa.int32()))
        return col

    features = lists("features")
    doc = np.repeat(np.arange(got.num_rows, dtype=np.int32), features.value_lengths().to_numpy())
    told = lists("labels").flatten().to_numpy().reshape(got.num_rows, len(cfg.categories) + 1) > 0
    return doc, features.flatten().to_numpy().copy(), told, got.column("doc_id").to_numpy().astype(np.uint64)


def toxic_groups(doc: np.ndarray, col: np.ndarray, features: int, toxic: np.ndarray, train: np.ndarray,
                 cfg: ChainSettings) -> np.ndarray:
    """Group (0 or 1) of every feature that tells toxic rows among ``train``, -1 for the others."""
    group = np.full(features, -1)
    share = toxic[train].mean() if train.any() else 0.0
    if not 0 < share < 1:
        return group
    have = np.bincount(col, weights=train[doc], minlength=features)
    pos = np.bincount(col, weights=(train & toxic)[doc], minlength=features)
    contrast = (pos - have * share) / np.sqrt(have * share * (1 - share) + 1e-9)
    contrast[pos < cfg.min_rows] = 0
    terms = np.argsort(-contrast, kind="stable")[: cfg.group_terms]
    terms = terms[contrast[terms] >= cfg.group_contrast]
    place = np.full(features, -1)
    place[terms] = np.arange(len(terms))
    use = (place[col] >= 0) & (train & toxic)[doc]
    _, row = np.unique(doc[use], return_inverse=True)
    group[terms] = 0
    if len(terms) < 2 or not len(row) or row.max() < 1:
        return group
    together = np.zeros((row.max() + 1, len(terms)))
    together[row, place[col[use]]] = 1.0
    scale = np.sqrt(np.maximum(together.sum(axis=0), 1.0))
    scaled = together / np.sqrt(together.sum(axis=1, keepdims=True)) / scale
    # the trivial first direction goes; what is left first parts the terms
    first = scale / np.linalg.norm(scale)
    second = np.linalg.svd(scaled - np.outer(scaled @ first, first), full_matrices=False)[2][0]
    group[terms] = (second * np.sign(second[0] or 1.0) < 0).astype(int)
    return group


def _categories(doc: np.ndarray, col: np.ndarray, group: np.ndarray, toxic: np.ndarray) -> list[np.ndarray]:
    """Targets of the links FOUND: toxic rows by the group that more of their features are in."""
    rows = len(toxic)
    count = [np.bincount(doc[group[col] == g], minlength=rows) for g in (0, 1)]
    none = (count[0] == 0) & (count[1] == 0)
    first = count[0] >= count[1]
    return [toxic & first & ~none, toxic & ~first, toxic & none]


@dataclass(frozen=True)
class Chain:
    """Fitted links in order and the probability from which the last one decides."""

    links: list[Link]
    threshold: float


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Middle of the gap with the best F1 over out-of-fold answers."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    last = np.r_[p[order][1:] != p[order][:-1], True]  # a cut lies between different answers
    k = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def fit_chain(docs: DataFrame, labels: DataFrame, cfg: ChainSettings = ChainSettings()) -> Chain:
    """Links fitted in order; the threshold comes from out-of-fold answers of the last."""
    doc, feature, told, ids = _training_arrays(training_rows(docs, labels, cfg), cfg)
    toxic, rows = told[:, -1], len(told)
    if not toxic.any():
        return Chain([Link(n.features, n.weights, np.zeros(k), n.intercept)
                      for k, n in enumerate([_NEVER] * len(cfg.links))], 0.5)
    # feature numbers, without features too rare for any link
    often = np.bincount(feature, minlength=1 << cfg.bits) >= cfg.min_rows
    names = np.flatnonzero(often)
    number = np.cumsum(often, dtype=np.int32) - 1
    keep = often[feature]
    doc, col = doc[keep], number[feature[keep]]
    del feature, keep, number, often
    fold = (mix(ids) % np.uint64(cfg.folds)).astype(np.int64)
    everyone = np.ones(rows, bool)

    def targets(train: np.ndarray, like: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
        """Targets of all links, with groups found in ``train`` and numbered like the given ones."""
        if cfg.categories:
            return [told[:, k] for k in range(told.shape[1])], None
        group = toxic_groups(doc, col, len(names), toxic, train, cfg)
        if like is not None:
            both = (group >= 0) & (like >= 0)
            if 2 * np.count_nonzero(group[both] != like[both]) > np.count_nonzero(both):
                group = np.where(group >= 0, 1 - group, -1)
        return [*_categories(doc, col, group, toxic), toxic], group

    whole, group = targets(everyone, None)
    held_out = [targets(fold != f, group)[0] for f in range(cfg.folds)]
    chain, before = [], np.zeros((rows, 0))
    for k in range(len(cfg.links)):
        chain.append(fit_link(doc, col, names, before, whole[k].astype(float), everyone, cfg))
        answer = np.zeros(rows)  # out of fold, for the links to come and the threshold
        for f in range(cfg.folds):
            held = fold == f
            if held.any() and (~held).any():
                link = fit_link(doc, col, names, before, held_out[f][k].astype(float), ~held, cfg)
                wanted = np.zeros(len(names), bool)
                wanted[np.searchsorted(names, link.features)] = True
                hit = wanted[col] & held[doc]
                answer[held] = link.probability(doc[hit], names[col[hit]], before)[held]
        before = np.c_[before, answer]
    # with few labels the best cut can lie low: never call a text toxic below the base rate
    return Chain(chain, max(best_threshold(before[:, -1], toxic), float(toxic.mean())))


def chain_probabilities(chain: list[Link], doc: np.ndarray, feature: np.ndarray, rows: int, bits: int) -> np.ndarray:
    """(rows, links) probabilities; features may repeat within a row."""
    used = np.zeros(1 << bits, bool)
    for link in chain:
        used[link.features] = True
    hit = used[feature]
    pairs = np.unique(doc[hit] << bits | feature[hit])
    d, f = pairs >> bits, pairs & ((1 << bits) - 1)
    before = np.zeros((rows, 0))
    for link in chain:
        before = np.c_[before, link.probability(d, f, before)]
    return before


def _score_pass(chain: Chain, cfg: ChainSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in text_chunks(batch.column(1)):
                feature, doc = text_features(data, offs, cfg)
                p = chain_probabilities(chain.links, doc, feature, j - i, cfg.bits)
                yield pa.record_batch(
                    [batch.column(0).slice(i, j - i), *[pa.array(p[:, k]) for k in range(len(chain.links))],
                     pa.array(p[:, -1] >= chain.threshold)], names=["doc_id", *[f"p_{x}" for x in cfg.links], "toxic"])
    return run


def score(docs: DataFrame, chain: Chain, cfg: ChainSettings = ChainSettings()) -> DataFrame:
    """One row per input row: doc_id, p_<link> for every link, toxic."""
    ship_package(docs.sparkSession)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return table.mapInArrow(_score_pass(chain, cfg), "doc_id long, " + ", ".join(
        f"p_{x} double" for x in cfg.links) + ", toxic boolean")


def reject_toxic(docs: DataFrame, chain: Chain, cfg: ChainSettings = ChainSettings()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the chain does not call toxic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            for i, j, data, offs in text_chunks(text):
                feature, doc = text_features(data, offs, cfg)
                p = chain_probabilities(chain.links, doc, feature, j - i, cfg.bits)
                yield batch.slice(i, j - i).filter(pa.array(p[:, -1] < chain.threshold))
    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, cfg: ChainSettings = ChainSettings()) -> DataFrame:
    return score(docs, fit_chain(docs, labels, cfg), cfg)
