"""Running counts over range partitions, and what follows from them: exact
quantiles, ordinals, and the rank-sum ROC AUC per group (M12).

AUC = sum over positives of (#negatives scored lower + half the tied
negatives) / (P * N): the Mann-Whitney U with mean ranks on ties, equal to
the trapezoid ROC area.

Plan:
1. (group, value) -> counts with a map-side combined aggregate, so a value
   shared by a third of the rows is one row after the first stage.
2. Spark's range partitioner deals the distinct (group, value) rows to
   partitions in order; the dealt rows are stored with their partition's number
   (a second sampling could draw other ranges). Totals per (group, partition)
   get a running sum over the partitions, and rows are summed inside their
   partition only. A window holds one partition's rows of a group, or one row
   per partition; neither grows with the group, as Spark sets the number of
   partitions by the data.
3. One grouped aggregate over the rows (AUC), or a lookup of the wanted ranks
   in the partitions that hold them (quantiles).

All sums are of integers and half-integers, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import checkpoint_dir


def _ranged(counts: DataFrame, group_cols: Sequence[str], order_col: str, weight_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the number _part of their range, totals (group, _part, _off, _sum)) in (group, value) order."""
    g = list(group_cols)
    checkpoint_dir(counts.sparkSession)
    rows = (counts.repartitionByRange(*g, order_col).withColumn("_part", F.spark_partition_id())
            .checkpoint(eager=True))
    totals = rows.groupBy(*g, "_part").agg(F.sum(weight_col).alias("_sum"))
    before = Window.partitionBy(*g).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return rows, totals.withColumn("_off", F.coalesce(F.sum("_sum").over(before), F.lit(0)))


def _summed(rows: DataFrame, totals: DataFrame, group_cols: Sequence[str], order_col: str, weight_col: str) -> DataFrame:
    g = list(group_cols)
    inside = Window.partitionBy(*g, "_part").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(totals.drop("_sum"), g + ["_part"]).withColumn(
        "_before", F.col("_off") + F.coalesce(F.sum(weight_col).over(inside), F.lit(0))).drop("_off", "_part"))


def running_count(counts: DataFrame, group_cols: Sequence[str], order_col: str, weight_col: str) -> DataFrame:
    """``counts`` plus ``_before`` = total weight of rows of the same group with a
    strictly smaller ``order_col`` (rows must be distinct per group and value)."""
    rows, totals = _ranged(counts, group_cols, order_col, weight_col)
    return _summed(rows, totals, group_cols, order_col, weight_col)


def ordinals(values: DataFrame, group_cols: Sequence[str], order_col: str, name: str) -> DataFrame:
    """Distinct (group, value) rows plus their place in the group's order, from 0."""
    return running_count(values.withColumn("_one", F.lit(1)), group_cols, order_col, "_one").drop("_one").withColumn(
        name, F.col("_before").cast("int")).drop("_before")


def exact_quantiles(counts: DataFrame, group_cols: Sequence[str], value_col: str,
                    count_col: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy / pandas default).

    ``counts`` holds one row per (group, value) with its multiplicity. The
    value at 0-based rank r is the one whose [before, before + count) range
    holds r; for p the ranks floor(h) and ceil(h), h = (n - 1) p, are first
    placed in the range partition that holds them, and only rows of those
    partitions are summed up and compared.
    Result: (group..., p, q).
    """
    g = list(group_cols)
    rows, totals = _ranged(counts, g, value_col, count_col)
    wanted = totals.groupBy(*g).agg(F.sum("_sum").alias("_n")).select(
        *g, F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"), "_n")
    wanted = wanted.withColumn("_h", (F.col("_n") - 1) * F.col("p")).withColumn("_r", F.explode(F.array_distinct(
        F.array(F.floor("_h"), F.ceil("_h")))))
    placed = wanted.join(totals, g).where("_off <= _r and _r < _off + _sum").select(*g, "p", "_h", "_r", "_part")
    needed = rows.join(placed.select(*g, "_part").distinct(), g + ["_part"], "left_semi")
    ranked = _summed(needed, totals, g, value_col, count_col)
    here = (F.col("_before") <= F.col("_r")) & (F.col("_r") < F.col("_before") + F.col(count_col))
    at = lambda rank: F.max(F.when(F.col("_r") == rank("_h"), F.col(value_col)))
    picked = ranked.join(placed.drop("_part"), g).where(here).groupBy(*g, "p", "_h").agg(
        at(F.floor).alias("_vlo"), at(F.ceil).alias("_vhi"))
    frac = F.col("_h") - F.floor("_h")
    return picked.select(*g, "p", (F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo"))).alias("q"))


def score_counts(df: DataFrame, group_cols: Sequence[str], score_col: str,
                 label_col: str) -> DataFrame:
    g = list(group_cols)
    y = F.col(label_col)
    return df.where(F.col(score_col).isNotNull() & y.isNotNull()).groupBy(*g, score_col).agg(
        F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"))


def rank_auc(df: DataFrame, group_cols: Sequence[str], score_col: str, label_col: str) -> DataFrame:
    """(group..., n, n_pos, n_neg, auc); auc is null when a class is absent.

    Callers group by a handful of keys (levels, model x fold).
    """
    if not group_cols:
        out = rank_auc(df.withColumn("_all", F.lit(1)), ["_all"], score_col, label_col)
        return out.drop("_all")
    g = list(group_cols)
    pts = score_counts(df, g, score_col, label_col)
    pb = running_count(pts, g, score_col, "_neg")
    below = F.col("_before")
    pb = pb.withColumn("_u", F.col("_pos").cast("double") * (below + F.col("_neg") * 0.5))
    out = pb.groupBy(*g).agg(
        F.sum("_pos").cast("bigint").alias("n_pos"), F.sum("_neg").cast("bigint").alias("n_neg"),
        F.sum("_u").alias("_u"))
    return out.select(
        *g, (F.col("n_pos") + F.col("n_neg")).alias("n"), "n_pos", "n_neg",
        F.try_divide(F.col("_u"), (F.col("n_pos") * F.col("n_neg")).cast("double")).alias("auc"))


def subgroup_auc(df: DataFrame, group_col: str, score_col: str, label_col: str,
                 min_n: int, codes: Sequence[str] | None = None) -> DataFrame:
    """A19 + F7: AUC per subgroup; groups below min_n or with one class skipped."""
    d = df.where(F.col(group_col).isin(*codes)) if codes else df
    r = rank_auc(d, [group_col], score_col, label_col)
    return (r.where((F.col("n") >= min_n) & (F.col("n_pos") > 0) & (F.col("n_neg") > 0))
            .select(group_col, "n", F.col("n_pos").alias("defaults"),
                    F.try_divide(F.col("n_pos").cast("double"), F.col("n").cast("double"))
                    .alias("default_rate"), "auc"))
