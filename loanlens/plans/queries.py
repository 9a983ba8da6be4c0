"""Registered queries: (spark, sf_dir) -> DataFrame.

Every query starts from the raw borrower export derived from the driver's
tables (``sources.fixture``) and runs the library operators on it, so its
work grows with the tables.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.config import ModelConfig, RiskConfig
from loanlens.operators import clean as C
from loanlens.operators import eda as E
from loanlens.operators import segments as S
from loanlens.operators.conform import conform, reject_report
from loanlens.operators.dates import date_order
from loanlens.operators.folds import fold_class_weights, stratified_folds
from loanlens.operators.ranking import subgroup_auc
from loanlens.session import checkpoint_dir, run_large_stages_compiled
from loanlens.sources.fixture import as_profile, raw_borrowers
from loanlens.sources.profiles import get_profile

PROFILE = get_profile("banner")
CFG = RiskConfig()
MODEL_CFG = ModelConfig()


# Logical plans of the raw export and the clean table, built once per
# (application, sf_dir): DataFrames are immutable lazy plans, so queries can
# share them; building the long column expressions costs ~2 s of py4j calls
# per query otherwise. Nothing is cached: each query scans only the columns
# and tables it needs.
_PLANS: dict[tuple, DataFrame] = {}
_PLANS_LOCK = threading.RLock()


def _memo(kind: str, spark: SparkSession, sf_dir: str, build) -> DataFrame:
    run_large_stages_compiled(spark)
    key = (kind, spark.sparkContext.applicationId, id(spark), sf_dir)
    with _PLANS_LOCK:
        if key not in _PLANS:
            _PLANS[key] = build()
        return _PLANS[key]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo("raw", spark, sf_dir, lambda: raw_borrowers(spark, sf_dir))


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed rows with every typed column and the validity flag (all rows)."""
    return _memo("wide", spark, sf_dir, lambda: C.with_clean_columns(
        conform(_raw(spark, sf_dir), PROFILE), PROFILE, CFG))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo("clean", spark, sf_dir,
                 lambda: C.project_final(_wide(spark, sf_dir).where(F.col("_valid"))))


def _compared(df: DataFrame) -> DataFrame:
    """Fractions to nine decimals, where two engines' summation orders still agree."""
    return df.select(*[F.round(c, 9).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def q_conform_headers(spark, sf_dir):
    return conform(_raw(spark, sf_dir), PROFILE)


def q_reject_report(spark, sf_dir):
    return reject_report(conform(_raw(spark, sf_dir), PROFILE), CFG.level_codes)


def q_clean_dataset(spark, sf_dir):
    return _clean(spark, sf_dir)


def q_population_counts(spark, sf_dir):
    return C.population_counts_wide(_wide(spark, sf_dir))


def q_level_breakdown(spark, sf_dir):
    return C.level_breakdown(_clean(spark, sf_dir), CFG.level_codes)


def q_default_rate_by_level(spark, sf_dir):
    return C.default_rate_by_level(_clean(spark, sf_dir))


def q_enrollment_breakdown(spark, sf_dir):
    return C.enrollment_breakdown(_raw(spark, sf_dir), PROFILE, CFG)


def q_feature_completeness(spark, sf_dir):
    return C.feature_completeness(_clean(spark, sf_dir))


def q_class_balance(spark, sf_dir):
    return E.class_balance(_clean(spark, sf_dir))


def q_missing_values(spark, sf_dir):
    return E.missing_values(_clean(spark, sf_dir))


def q_numeric_distribution(spark, sf_dir):
    return _compared(E.numeric_distribution(_clean(spark, sf_dir), CFG))


def q_correlation_with_default(spark, sf_dir):
    return _compared(E.correlation_with_default(_clean(spark, sf_dir)))


def q_band_counts(spark, sf_dir):
    return S.band_counts(_clean(spark, sf_dir), CFG)


def q_segment_rates(spark, sf_dir):
    return S.ordered(S.segment_rates(_clean(spark, sf_dir), CFG))        # L1


def q_segment_fallback(spark, sf_dir):
    return S.segment_rates(_clean(spark, sf_dir), CFG.fallback_only())


def q_status_rates(spark, sf_dir):
    return S.status_rates(_clean(spark, sf_dir))


def q_idr_finding(spark, sf_dir):
    return S.idr_finding(_clean(spark, sf_dir), CFG)


def q_segment_report(spark, sf_dir):
    return S.segment_report(_clean(spark, sf_dir), CFG)


def q_top_segments(spark, sf_dir):
    return S.top_segments(S.segment_rates(_clean(spark, sf_dir), CFG, ("state", "program")))


def q_page_cuts(spark, sf_dir):
    """The states and programs the result page shows."""
    return S.top_segments(S.segment_rates(_clean(spark, sf_dir), CFG, tuple(k for k, _ in S.PAGE_CUTS)), S.PAGE_CUTS)


def q_clean_dataset_colleague(spark, sf_dir):
    """Q3 through another export profile (dotted headers, other codes)."""
    prof = get_profile("colleague")
    return C.clean_dataset(as_profile(_raw(spark, sf_dir), prof), prof, CFG)


def q_date_order(spark, sf_dir):
    """The vote on the order of the birth dates' numbers, over all rows of the export."""
    return date_order(conform(_raw(spark, sf_dir), PROFILE), "birth_date")


def q_overall_rate(spark, sf_dir):
    return S.overall(_clean(spark, sf_dir))


FEATURE_CUT = 10   # features shown on the result page
IDR_ALERT = 0.05   # the page highlights an IDR differential of five points or more


def kpi_counts(raw: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """A16 without the model: all counts in ONE aggregate over the conformed rows."""
    from loanlens import functions as LF

    if wide is None:
        wide = C.with_clean_columns(conform(raw, PROFILE), PROFILE, CFG)
    valid, y = F.col("_valid"), F.col("_default_flag")
    idr = LF.idr_flag("_payment_plan", CFG.idr_pattern)
    aggs = [F.count_if(valid).alias("valid_population"),
            F.coalesce(F.sum(F.when(valid, y)), F.lit(0)).cast("bigint").alias("defaults")]
    for code in CFG.level_codes:
        in_level = valid & (F.col("_level") == code)
        aggs.append(LF.safe_rate(F.sum(F.when(in_level, y)), F.count_if(in_level))
                    .alias(f"default_rate_{code.lower()}"))
    aggs += [LF.safe_rate(F.sum(F.when(valid & idr, y)), F.count_if(valid & idr)).alias("idr_rate"),
             LF.safe_rate(F.sum(F.when(valid & ~idr, y)), F.count_if(valid & ~idr))
             .alias("non_idr_rate")]
    return (wide.agg(*aggs)
            .withColumn("default_rate", LF.safe_rate("defaults", "valid_population"))
            .withColumn("idr_differential", F.col("non_idr_rate") - F.col("idr_rate"))
            .withColumn("idr_alert", F.col("idr_differential") >= IDR_ALERT))


def q_kpi_counts(spark, sf_dir):
    return kpi_counts(_raw(spark, sf_dir), _wide(spark, sf_dir))


def _folded(spark, sf_dir):
    """The training rows with the folds that the models use."""
    from loanlens.operators.model import CAT_FEATURES, FOLD_TIE_COLS, NUM_FEATURES

    rows = _clean(spark, sf_dir).select("student_id", "default_flag", *CAT_FEATURES, *NUM_FEATURES)
    return stratified_folds(rows, "student_id", "default_flag", MODEL_CFG.folds, MODEL_CFG.seed,
                            MODEL_CFG.fold_hex_digits, tie_cols=FOLD_TIE_COLS)


def q_stratified_folds(spark, sf_dir):
    return _folded(spark, sf_dir).select("student_id", "default_flag", "fold")


def q_class_weights(spark, sf_dir):
    return fold_class_weights(_folded(spark, sf_dir), k=MODEL_CFG.folds)


def q_rank_auc_by_level(spark, sf_dir):
    """M12 on a deterministic score (lower GPA = higher risk)."""
    scored = _clean(spark, sf_dir).withColumn(
        "score", -F.coalesce(F.col("gpa"), F.lit(0.0)))
    return subgroup_auc(scored, "level", "score", "default_flag", MODEL_CFG.subgroup_min_n)


def _fixed_rule_metrics(spark, sf_dir):
    from loanlens.operators.model import fold_metrics

    gpa = F.coalesce(F.col("gpa"), F.lit(0.0))
    scored = _folded(spark, sf_dir).select(
        F.lit("fixed rule").alias("model"), F.lit(0).alias("position"), "fold",
        "default_flag", (-gpa).alias("score"), (gpa < 2.0).cast("int").alias("pred"))
    checkpoint_dir(spark)
    return fold_metrics(scored.checkpoint(eager=True))     # read by the counts and by the ranks


def q_fold_metrics_fixed_score(spark, sf_dir):
    """M7 metric arithmetic per fold on a fixed rule (score -gpa, flag gpa < 2)."""
    return _fixed_rule_metrics(spark, sf_dir).drop("model", "position")


def q_cv_summary_fixed_score(spark, sf_dir):
    """A18 on the fixed rule: mean and population std of its fold metrics."""
    from loanlens.operators.model import cv_summary

    return _compared(cv_summary(_fixed_rule_metrics(spark, sf_dir)).drop("model", "position"))


def q_fold_medians(spark, sf_dir):
    """M1: numeric medians of every training fold, and of all rows (-1)."""
    from loanlens.operators.model import NUM_FEATURES, fold_medians

    return fold_medians(_folded(spark, sf_dir), list(NUM_FEATURES), MODEL_CFG.folds)


def q_fold_categories(spark, sf_dir):
    """M2: category numbers of every training fold, and of all rows (-1)."""
    from loanlens.operators.model import CAT_FEATURES, category_index

    return category_index(_folded(spark, sf_dir), list(CAT_FEATURES), MODEL_CFG.folds)


def q_importance_fixed_score(spark, sf_dir):
    """Roll-up of a fixed per-category score (defaults among its rows, per row of the table)."""
    from loanlens.operators.model import CAT_FEATURES, rollup_importance, top_features

    clean = _clean(spark, sf_dir)
    long = clean.select("default_flag", F.explode(F.array(*[
        F.struct(F.lit(c).alias("root"), F.coalesce(c, F.lit("Unknown")).alias("value"))
        for c in CAT_FEATURES])).alias("s")).select("default_flag", "s.*")
    per = long.groupBy("root", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("default_flag").alias("d"))
    scored = per.select(F.concat_ws("_", "root", "value").alias("feature"), "root",
                        F.try_divide(F.col("d").cast("double"), F.col("n")).alias("importance"))
    return _compared(top_features(rollup_importance(scored), FEATURE_CUT))


SQL_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_headers": q_conform_headers,
    "reject_report": q_reject_report,
    "clean_dataset": q_clean_dataset,
    "clean_dataset_colleague": q_clean_dataset_colleague,
    "population_counts": q_population_counts,
    "level_breakdown": q_level_breakdown,
    "default_rate_by_level": q_default_rate_by_level,
    "enrollment_breakdown": q_enrollment_breakdown,
    "feature_completeness": q_feature_completeness,
    "class_balance": q_class_balance,
    "missing_values": q_missing_values,
    "numeric_distribution": q_numeric_distribution,
    "correlation_with_default": q_correlation_with_default,
    "band_counts": q_band_counts,
    "segment_rates": q_segment_rates,
    "segment_fallback": q_segment_fallback,
    "status_rates": q_status_rates,
    "idr_finding": q_idr_finding,
    "segment_report": q_segment_report,
    "top_segments": q_top_segments,
    "overall_rate": q_overall_rate,
    "kpi_counts": q_kpi_counts,
    "stratified_folds": q_stratified_folds,
    "class_weights": q_class_weights,
    "rank_auc_by_level": q_rank_auc_by_level,
    "fold_metrics_fixed_score": q_fold_metrics_fixed_score,
    "cv_summary_fixed_score": q_cv_summary_fixed_score,
    "fold_medians": q_fold_medians,
    "fold_categories": q_fold_categories,
    "importance_fixed_score": q_importance_fixed_score,
    "page_cuts": q_page_cuts,
    "date_order": q_date_order,
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from loanlens.plans.model_queries import MODEL_QUERIES

    return {**SQL_QUERIES, **MODEL_QUERIES}


__all__ = ["all_queries", "SQL_QUERIES", "PROFILE", "CFG", "MODEL_CFG"]
