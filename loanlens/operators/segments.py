"""Default-rate segmentation.

The nine segment dimensions are computed in ONE shuffle: every clean row is
exploded to (segment, value, flag) and grouped by (segment, value). The
explode and the partial aggregate run in the same map stage, so what crosses
the network is one row per distinct value per task, however skewed a value
is. Everything after that runs on the small per-value table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens import functions as LF
from loanlens.config import FALLBACK_TOP, RiskConfig

# ---------------------------------------------------------------------------
# Segment keys and report titles, in report order
# ---------------------------------------------------------------------------
SEGMENTS = (
    ("level", "Level (LEVL_CODE)"),
    ("student_type", "Student type"),
    ("campus", "Campus"),
    ("gpa_band", "GPA band"),
    ("age_band", "Age band"),
    ("state", "State"),
    ("loan_amount", "Loan amount"),
    ("payment_plan", "Payment plan"),
    ("program", "Program"),
)
STATUS_TITLE = "Graduation / Withdrawal"
STATUS_LABELS = ("Not graduated", "Graduated", "Not withdrawn", "Withdrawn")
IDR_TITLE = "IDR Policy Finding"
IDR_LABELS = ("IDR enrolled", "Non-IDR")
# Chart cuts of the ordered segment tables.
TOP_STATES = 10
TOP_PROGRAMS = 15
# Cuts of the result page.
PAGE_CUTS = (("state", 10), ("program", 12))


def with_segment_columns(clean: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Derived segment columns: level label, three bands (+ ordinals), IDR."""
    return clean.select(
        "*",
        LF.level_label("level").alias("level_label"),
        LF.gpa_band("gpa").alias("gpa_band"),
        LF.band_ordinal("gpa", LF.GPA_EDGES).alias("gpa_band_ord"),
        LF.age_band("age").alias("age_band"),
        LF.band_ordinal("age", LF.AGE_EDGES).alias("age_band_ord"),
        LF.loan_band("original_loan_amount").alias("loan_band"),
        LF.band_ordinal("original_loan_amount", LF.LOAN_EDGES).alias("loan_band_ord"),
        LF.idr_flag("payment_plan", cfg.idr_pattern).alias("idr_enrolled"),
    )


_DIMENSION_SOURCE = {   # segment key -> (value column, band-order column)
    "level": ("level_label", None),
    "student_type": ("student_type", None),
    "campus": ("campus_code", None),
    "gpa_band": ("gpa_band", "gpa_band_ord"),
    "age_band": ("age_band", "age_band_ord"),
    "state": ("state", None),
    "loan_amount": ("loan_band", "loan_band_ord"),
    "payment_plan": ("payment_plan", None),
    "program": ("program", None),
}


def _dimension_values(keys) -> Column:
    """explode(array(struct(segment, value, band_ord) per key)) as one SQL expression."""
    parts = []
    for key in keys:
        value, ord_col = _DIMENSION_SOURCE[key]
        # -1: not a band segment (a non-null int keeps the column's type simple)
        o = f"coalesce(`{ord_col}`, -1)" if ord_col else "CAST(-1 AS INT)"
        parts.append(f"named_struct('segment', '{key}', 'value', CAST(`{value}` AS STRING), "
                     f"'band_ord', {o})")
    return F.expr(f"explode(array({', '.join(parts)}))")


def segment_counts(clean: DataFrame, cfg: RiskConfig, keys=tuple(k for k, _ in SEGMENTS)) -> DataFrame:
    """(segment, value, band_ord, n, defaults) for every non-null value of the named segments."""
    d = with_segment_columns(clean, cfg)
    long = d.select(F.col("default_flag"), _dimension_values(keys).alias("s")).select(
        "default_flag", "s.*").where(F.col("value").isNotNull())
    return long.groupBy("segment", "value").agg(
        F.min("band_ord").alias("band_ord"),
        F.count(F.lit(1)).alias("n"),
        F.sum("default_flag").cast("bigint").alias("defaults"))


def _min_n(cfg: RiskConfig) -> Column:
    arms = " ".join(f"WHEN '{key}' THEN {int(n)}" for key, n in cfg.min_n_overrides)
    return F.expr(f"CASE segment {arms} ELSE {int(cfg.min_n_default)} END") if arms \
        else F.lit(cfg.min_n_default)


def _title(segment: str = "segment") -> Column:
    return LF.map_or_keep(segment, dict(SEGMENTS))


def overall(clean: DataFrame) -> DataFrame:
    """One row with n, defaults and the overall default rate."""
    return clean.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("default_flag").cast("bigint").alias("defaults"),
        LF.safe_rate(F.sum("default_flag"), F.count(F.lit(1))).alias("default_rate"))


def apply_min_n(g: DataFrame, top: int, always_fallback: bool = False) -> DataFrame:
    """A11 core on (segment, value, n, defaults, min_n, ...) rows.

    Groups below the segment's min_n are dropped; when no group of a segment
    reaches it (or ``always_fallback``), that segment shows its ``top`` largest
    groups instead. The segments' maxima are a grouped aggregate. Only segments
    that fall back are ranked, and by a literal limit: every task cuts its
    values to the ``top`` largest of each segment before the shuffle, and the
    merge ranks those, so no task holds all values of a segment.
    """
    rate = LF.safe_rate("defaults", "n")
    columns = [c for c in g.columns if c != "min_n"]
    largest = F.row_number().over(Window.partitionBy("segment").orderBy(F.desc("n"), F.asc("value")))
    if always_fallback:
        shown = g.withColumn("_rn", largest).where(F.col("_rn") <= top).select(*columns)
        return shown.withColumn("default_rate", rate)
    most = g.groupBy("segment").agg(F.max("n").alias("_max"))
    known = g.join(most, "segment")
    kept = known.where("_max >= min_n and n >= min_n").select(*columns)
    fallback = known.where("_max < min_n").withColumn("_rn", largest).where(F.col("_rn") <= top).select(*columns)
    return kept.unionByName(fallback).withColumn("default_rate", rate)


def segment(df: DataFrame, group_col: str, min_n: int = 5, top: int = FALLBACK_TOP,
            label: str = "default_flag") -> DataFrame:
    """Default rate per value of one column (null values are not a group)."""
    g = (df.where(F.col(group_col).isNotNull())
         .groupBy(F.col(group_col).cast("string").alias("value"))
         .agg(F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("defaults"))
         .withColumn("segment", F.lit(group_col)).withColumn("min_n", F.lit(min_n)))
    return apply_min_n(g, top).select("value", "n", "defaults", "default_rate")


def segment_rates(clean: DataFrame, cfg: RiskConfig, keys: tuple[str, ...] | None = None) -> DataFrame:
    """A11/A12 + D17: default rate per value of the nine segment dimensions, or of some of them."""
    wanted = tuple(k for k, _ in SEGMENTS) if keys is None else tuple(keys)
    # the levels are counted in any case, for the overall rate
    counts = segment_counts(clean, cfg, tuple(dict.fromkeys([*wanted, "level"])))
    g = counts.withColumn("min_n", _min_n(cfg))
    shown = g if "level" in wanted else g.where(F.col("segment") != "level")
    rates = apply_min_n(shown, cfg.fallback_top, cfg.always_fallback)
    # every clean row has a level, so the level counts hold the overall rate;
    # the subquery reuses the counts' shuffle
    overall_rate = g.where(F.col("segment") == "level").select(
        LF.safe_rate(F.sum("defaults"), F.sum("n"))).scalar()
    return rates.select(
        "segment", _title("segment").alias("title"), "value", "band_ord", "n",
        "defaults", "default_rate",
        LF.rate_flag("default_rate", overall_rate, cfg.near_band).alias("flag"))


def ordered(rates: DataFrame) -> DataFrame:
    """L1 (ties broken by n, then value); band segments by band order (L3)."""
    return rates.orderBy("segment", F.desc("default_rate"), F.desc("n"), F.asc("value"))


def band_ordered(rates: DataFrame) -> DataFrame:
    """L3: band segments in band order (band_ord is -1 outside band segments)."""
    return rates.orderBy("segment", "band_ord", "value")


def top_segments(rates: DataFrame, cuts=(("state", TOP_STATES), ("program", TOP_PROGRAMS))
                 ) -> DataFrame:
    """The first k values of a segment in rate order (one window pass).

    The literal ``rn <= max(k)`` filter lets Spark keep only the top rows
    per task before the shuffle; the per-segment cut follows.
    """
    keys = [key for key, _ in cuts]
    k_max = max(k for _, k in cuts)
    cut = F.lit(None).cast("int")
    for key, k in cuts:
        cut = F.when(F.col("segment") == key, F.lit(k)).otherwise(cut)
    w = Window.partitionBy("segment").orderBy(
        F.desc("default_rate"), F.desc("n"), F.asc("value"))
    ranked = (rates.where(F.col("segment").isin(*keys))
              .withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") <= k_max))
    return ranked.where(F.col("_rn") <= cut).withColumn(
        "seg_rank", F.col("_rn").cast("bigint")).drop("_rn")


def status_rates(clean: DataFrame) -> DataFrame:
    """Four overlapping status groups, fixed order, zero-filled."""
    g, w, y = F.col("graduated"), F.col("withdrawn"), F.col("default_flag")
    conds = (g == 0, g == 1, w == 0, w == 1)
    aggs = []
    for i, cond in enumerate(conds):
        aggs += [F.count_if(cond).alias(f"n_{i}"),
                 F.coalesce(F.sum(F.when(cond, y)), F.lit(0)).cast("bigint").alias(f"d_{i}")]
    wide = clean.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("status"),
                 F.col(f"n_{i}").alias("n"), F.col(f"d_{i}").alias("defaults"))
        for i, label in enumerate(STATUS_LABELS)]))
    return wide.select(stack.alias("s")).select(
        "s.position", "s.status", F.col("s.n").cast("bigint").alias("n"), "s.defaults",
        LF.safe_rate("s.defaults", "s.n").alias("default_rate"))


def idr_finding(clean: DataFrame, cfg: RiskConfig) -> DataFrame:
    """A14 + D20: IDR vs non-IDR rates and their difference, one row."""
    idr = LF.idr_flag("payment_plan", cfg.idr_pattern)
    y = F.col("default_flag")
    wide = clean.agg(
        F.count_if(idr).alias("idr_n"),
        F.coalesce(F.sum(F.when(idr, y)), F.lit(0)).cast("bigint").alias("idr_defaults"),
        F.count_if(~idr).alias("non_idr_n"),
        F.coalesce(F.sum(F.when(~idr, y)), F.lit(0)).cast("bigint").alias("non_idr_defaults"))
    return wide.select(
        "idr_n", "idr_defaults", LF.safe_rate("idr_defaults", "idr_n").alias("idr_rate"),
        "non_idr_n", "non_idr_defaults",
        LF.safe_rate("non_idr_defaults", "non_idr_n").alias("non_idr_rate"),
    ).withColumn("idr_differential", F.col("non_idr_rate") - F.col("idr_rate"))


def segment_report(clean: DataFrame, cfg: RiskConfig, rates: DataFrame | None = None,
                   status: DataFrame | None = None, idr: DataFrame | None = None) -> DataFrame:
    """U1 + D18: nine segments, status and IDR rows in one table.

    A caller that has the three tables already passes them, so that nothing is
    computed again.
    """
    rates = segment_rates(clean, cfg) if rates is None else rates
    status = status_rates(clean) if status is None else status
    idr = idr_finding(clean, cfg) if idr is None else idr
    seg_pos = F.lit(None).cast("int")
    for i, (key, _) in reversed(list(enumerate(SEGMENTS))):
        seg_pos = F.when(F.col("segment") == key, F.lit(i)).otherwise(seg_pos)
    segs = rates.select(
        seg_pos.alias("seg_pos"), F.col("title").alias("segment"), "value", "n", "defaults",
        "default_rate")
    status = status.select(
        F.lit(len(SEGMENTS)).alias("seg_pos"), F.lit(STATUS_TITLE).alias("segment"),
        F.col("status").alias("value"), "n", "defaults", "default_rate")
    idr_rows = idr.select(F.explode(F.array(
        F.struct(F.lit(IDR_LABELS[0]).alias("value"), F.col("idr_n").alias("n"),
                 F.col("idr_defaults").alias("defaults"), F.col("idr_rate").alias("default_rate")),
        F.struct(F.lit(IDR_LABELS[1]).alias("value"), F.col("non_idr_n").alias("n"),
                 F.col("non_idr_defaults").alias("defaults"),
                 F.col("non_idr_rate").alias("default_rate")))).alias("s")).select(
        F.lit(len(SEGMENTS) + 1).alias("seg_pos"), F.lit(IDR_TITLE).alias("segment"),
        "s.value", F.col("s.n").cast("bigint").alias("n"), "s.defaults", "s.default_rate")
    report = segs.unionByName(status).unionByName(idr_rows)
    return report.withColumn("default_rate_text", LF.percent_text("default_rate"))


def band_counts(clean: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Q13: rows, defaults and rate per GPA / age / loan band (no min_n)."""
    keys = ("gpa_band", "age_band", "loan_amount")
    return (segment_counts(clean, cfg, keys)
            .select("segment", "value", "band_ord", "n", "defaults",
                    LF.safe_rate("defaults", "n").alias("default_rate")))
