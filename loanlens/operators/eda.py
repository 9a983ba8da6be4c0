"""Profiling of the clean dataset.

Each table is one aggregate over the data plus a ``stack``-style unpivot of
the single result row, never a job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens import functions as LF
from loanlens.config import RiskConfig
from loanlens.operators.ranking import exact_quantiles

# Profiled and correlated columns, in report order.
NUMERIC_COLS = ("gpa", "original_loan_amount", "current_balance", "credits_earned", "num_loans")
CORRELATION_COLS = ("gpa", "credits_earned", "original_loan_amount", "current_balance",
                    "num_loans", "graduated", "withdrawn")
QUANTILES = (0.25, 0.5, 0.75)


def class_balance(clean: DataFrame, label: str = "default_flag") -> DataFrame:
    """Rows and share per class value (absent classes are not listed)."""
    wide = clean.agg(F.count(F.lit(1)).alias("_total"),
                     F.count_if(F.col(label) == 0).alias("n0"),
                     F.count_if(F.col(label) == 1).alias("n1"))
    stack = F.explode(F.array(
        F.struct(F.lit(0).alias("cls"), F.col("n0").alias("n")),
        F.struct(F.lit(1).alias("cls"), F.col("n1").alias("n"))))
    return (wide.select("_total", stack.alias("s"))
            .where(F.col("s.n") > 0)
            .select(F.col("s.cls").alias(label), F.col("s.n").cast("bigint").alias("n"),
                    LF.safe_rate("s.n", "_total").alias("pct")))


def missing_values(clean: DataFrame) -> DataFrame:
    """Missing rows and share for every column."""
    cols = clean.columns
    wide = clean.agg(F.count(F.lit(1)).alias("_total"),
                     *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m_{i}")
                       for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"m_{i}").cast("bigint").alias("v"))
        for i, c in enumerate(cols)]))
    return wide.select("_total", stack.alias("s")).select(
        F.col("s.name").alias("column_name"), F.col("s.v").alias("missing_n"),
        LF.safe_rate("s.v", "_total").alias("missing_pct"))


def _long_values(df: DataFrame, cols) -> DataFrame:
    """(column, value) rows for the non-null values of ``cols``."""
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]))
    return df.select(stack.alias("s")).select("s.feature", "s.value").where(
        F.col("value").isNotNull())


def quantiles(df: DataFrame, cols, probs, approx: bool = False,
              accuracy: int = 100_000) -> DataFrame:
    """(feature, p, q): per-column quantiles, linear interpolation like pandas.

    Exact mode reduces rows to (feature, value, count) with a map-side
    combined aggregate, then finds the ranks with a distributed running count
    (``ranking.exact_quantiles``): no task ever holds a whole column. ``approx`` uses the fixed-size
    ``percentile_approx`` sketch instead (no interpolation).
    """
    long = _long_values(df, cols)
    if approx:
        ps = F.array(*[F.lit(float(p)) for p in probs])
        arr = long.groupBy("feature").agg(F.percentile_approx("value", ps, accuracy).alias("_q"))
        return arr.select("feature", F.posexplode("_q").alias("_i", "q")).select(
            "feature", F.element_at(ps, F.col("_i") + 1).alias("p"), "q")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    return exact_quantiles(counts, ["feature"], "value", "cnt", probs)


def numeric_distribution(clean: DataFrame, cfg: RiskConfig,
                         cols=NUMERIC_COLS) -> DataFrame:
    """Min, max, mean, median, sample std, p25, p75 per numeric column, unrounded.

    The moments are one wide aggregate over the rows, unpivoted after.
    """
    present = [c for c in cols if c in clean.columns]
    stats = (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_samp))
    wide = clean.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{i}")
                       for i, c in enumerate(present) for n, f in stats])
    moments = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{n}_{i}").alias(n) for n, _ in stats])
        for i, c in enumerate(present)])).alias("s")).select("s.*")
    q = quantiles(clean, present, QUANTILES, cfg.approx_quantiles, cfg.approx_accuracy)
    qw = q.groupBy("feature").agg(*[
        F.max(F.when(F.col("p") == p, F.col("q"))).alias(name)
        for p, name in zip(QUANTILES, ("p25", "median", "p75"))])
    out = moments.join(qw, "feature")
    return out.select("feature", "min", "max", "mean", "median", "std", "p25", "p75")


def display_view(table: DataFrame, digits: int = 4) -> DataFrame:
    """The same table with its fractions rounded half to even, for display only."""
    return table.select(*[LF.display_round(c, digits).alias(c) if kind == "double" else F.col(c)
                          for c, kind in table.dtypes])


def correlation_with_default(clean: DataFrame, cols=CORRELATION_COLS,
                             label: str = "default_flag") -> DataFrame:
    """A10: Pearson r of each column with the label over pair-complete rows.

    Columns with fewer than two complete pairs are left out; a constant column
    gives a null r rather than an error.
    """
    present = [c for c in cols if c in clean.columns]
    aggs = []
    for i, c in enumerate(present):
        both = F.col(c).isNotNull() & F.col(label).isNotNull()
        aggs += [F.count_if(both).alias(f"n_{i}"), LF.safe_corr(c, label).alias(f"r_{i}")]
    wide = clean.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"n_{i}").alias("n_pairs"),
                 F.col(f"r_{i}").alias("r")) for i, c in enumerate(present)]))
    long = wide.select(stack.alias("s")).select("s.*").where(F.col("n_pairs") >= 2)
    return long.select("feature", "r", LF.corr_direction("r").alias("direction"),
                       F.abs("r").alias("abs_r")).orderBy(F.desc("abs_r"), "feature")   # L6
