"""Centroid clustering of integer vectors through a vantage-point tree (op 13).

Vectors of exactly ``dim`` finite components become integers
``floor(scale * x)``. Each round builds a vantage-point tree over the current
centroids on the driver, broadcasts it, and finds every vector's nearest
centroid by a best-first branch-and-bound of its own; centroids then move to
the componentwise ``floor(sum / count)`` of their vectors, in whole numbers.

Search: every vector keeps a lower bound per open tree node and always opens
the node of the smallest one. An inner node measures its vantage centroid and
opens both sides, with the bound that the triangle inequality gives from the
side's smallest and largest distance to the vantage point; a leaf measures its
centroids. A node is left closed only when its bound lies above the best
distance found (inclusive radius, less a margin far above float rounding), so
centroids at equal distance are all measured. Distances are exact integers and
ties go to the smaller centroid number. A task works through blocks of rows:
one step opens the next node of every row of the block.

Scale: the vectors are stored once as integers; each round is one scan whose
tasks emit one row per centroid (count and component sums), so a cluster with a
third of all rows costs one row per task. The driver holds ``k`` centroids of
``dim`` components and nothing that grows with the table.

Edge cases: null vectors, null or non-finite components and other lengths are
left out; a null vec_id hashes as the empty text; repeated rows are vectors of
their own (starting order of equal hashes: by components); with fewer than
``k`` kept vectors each is a centroid; none kept gives an empty result; an
empty cluster keeps its centroid; other columns are ignored. Components beyond
``2**27`` stop the job with an error, as their distances may leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save_table, ship_package

#: Largest absolute component: 64 * (2 * 2**27)**2 still fits a long.
LARGEST = 1 << 27
_BLOCK_CELLS = 1 << 17


@dataclass
class VantageTree:
    """Vantage-point tree over integer centroids; node 0 is the root."""

    points: np.ndarray
    leaf_size: int = 2
    #: Per node: centroid numbers measured there (one vantage point, or a leaf's).
    members: list[np.ndarray] = field(default_factory=list)
    #: Per node: (child, smallest, largest distance of the child's centroids to the vantage point).
    children: list[list[tuple[int, float, float]]] = field(default_factory=list)

    def __post_init__(self):
        self._grow(np.arange(len(self.points)))

    def _grow(self, numbers: np.ndarray) -> int:
        me = len(self.members)
        self.children.append([])
        if len(numbers) <= self.leaf_size:
            self.members.append(numbers)
            return me
        self.members.append(numbers[:1])
        rest = numbers[1:]
        apart = squared(self.points[rest], self.points[numbers[0]])
        near = apart <= np.sort(apart)[(len(rest) - 1) // 2]
        for side in (near, ~near):
            if side.any():
                far = np.sqrt(apart[side].astype(np.float64))
                self.children[me].append((self._grow(rest[side]), float(far.min()), float(far.max())))
        return me

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid number, squared distance) of every row of ``x``."""
        n, nodes = len(x), len(self.members)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.points))
        bound = np.full((n, nodes), np.inf)
        bound[:, 0] = 0.0
        open_rows = np.arange(n)
        while len(open_rows):
            pick = bound[open_rows].argmin(axis=1)
            low = bound[open_rows, pick]
            going = low <= np.sqrt(best[open_rows].astype(np.float64))
            open_rows, pick, low = open_rows[going], pick[going], low[going]
            bound[open_rows, pick] = np.inf
            for node in np.unique(pick):
                here = pick == node
                rows, base = open_rows[here], low[here]
                for c in self.members[node]:
                    d2 = squared(x[rows], self.points[c])
                    better = (d2 < best[rows]) | ((d2 == best[rows]) & (c < number[rows]))
                    best[rows[better]], number[rows[better]] = d2[better], c
                if self.children[node]:
                    d = np.sqrt(d2.astype(np.float64))
                    for child, lo, hi in self.children[node]:
                        gap = np.maximum(d - hi, lo - d) - 1e-9 * (1.0 + d + hi)
                        bound[rows, child] = np.maximum(np.maximum(gap, base), 0.0)
        return number, best


def squared(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to one integer point."""
    gap = x - point
    return np.einsum("ij,ij->i", gap, gap)


def integer_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, parts): vectors with exactly ``dim`` finite components, as whole numbers."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    checked = F.transform(vector_col, lambda x: F.when(
        F.abs(x.cast("double")) * scale < LARGEST, F.floor(x.cast("double") * scale)).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}")).cast("long")))
    return (vectors.where((F.size(vector_col) == dim) & ~bad)
            .select(F.col(id_col).alias("vec_id"), checked.cast("array<int>").alias("parts")))


def _blocks(batches: Iterator[pa.RecordBatch], dim: int, nodes: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, integer matrix) pieces small enough for a bound per row and tree node."""
    step = max(64, _BLOCK_CELLS // max(nodes, dim))
    for batch in batches:
        ids, parts = batch.column(0), batch.column(1)
        flat = parts.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)
        for i in range(0, len(ids), step):
            yield ids.slice(i, step), flat[i: i + step]


def _move(stored: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor(sum / count) per component of a cluster that has vectors."""
    k, dim = centroids.shape
    tree = stored.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def sums(batches):
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, x in _blocks(batches, dim, len(tree.value.members)):
            number, _d = tree.value.nearest(x)
            order = np.argsort(number, kind="stable")
            heads = np.flatnonzero(np.diff(number[order], prepend=-1))
            total[number[order[heads]]] += np.add.reduceat(x[order], heads, axis=0)
            count += np.bincount(number, minlength=k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used], pa.int64()),
             pa.array(list(total[used]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    part = stored.mapInArrow(sums, "cluster int, n long, sums array<long>")
    per = (part.select("cluster", "n", F.posexplode("sums").alias("pos", "s"))
           .groupBy("cluster", "pos").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")))
    moved = centroids.copy()
    for r in per.collect():      # at most k * dim rows
        moved[r["cluster"], r["pos"]] = int(r["s"]) // int(r["n"])
    return moved


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64,
                    seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), final centroids).

    Starts from the ``k`` kept vectors of smallest sha256 of ``seed:vec_id``.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    stored = save_table(integer_vectors(vectors, dim, scale, id_col, vector_col), "vectors")
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = (stored.orderBy(F.sha2(text.cast("binary"), 256), "parts").limit(k).select("parts").collect())
    if not first:
        return stored.selectExpr("vec_id", "cast(0 as int) as cluster", "0L as distance"), np.zeros((0, dim), np.int64)
    centroids = np.array([r["parts"] for r in first], np.int64)
    for _ in range(rounds):
        centroids = _move(stored, centroids)
    tree = spark.sparkContext.broadcast(VantageTree(centroids))

    def assign(batches):
        for ids, x in _blocks(batches, dim, len(tree.value.members)):
            number, d2 = tree.value.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(number, pa.int32()), pa.array(d2, pa.int64())], ["vec_id", "cluster", "distance"])

    schema = f"vec_id {stored.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    return save_table(stored.mapInArrow(assign, schema), "clusters"), centroids


def cluster_report(vectors: DataFrame, **settings) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    found, centroids = cluster_vectors(vectors, **settings)
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in per)
    rows = [(r["cluster"], int(r["s"]), total, hashlib.sha256(
        ",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()) for r in per]
    sums = found.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(sums), "cluster").select(   # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
