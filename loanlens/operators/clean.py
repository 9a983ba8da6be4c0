"""ETL: typed clean dataset (D1-D11, P7, F1) and its counts.

Every step is a narrow projection on the conformed rows, so the whole clean
table is one scan stage with no shuffle. The counts are single global
aggregates (partial per task, one tiny merge) instead of a job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens import functions as LF
from loanlens.config import RiskConfig
from loanlens.operators.conform import conform, filter_valid, valid_level
from loanlens.sources.profiles import Profile

# The columns of the clean dataset, in its order.
FEATURES = (
    "level", "program", "major", "student_type", "campus_code",
    "age", "state",
    "gpa", "credits_earned", "graduated", "withdrawn",
    "num_loans", "original_loan_amount", "current_balance", "payment_plan",
)
FINAL_COLUMNS = ("student_id",) + FEATURES + ("default_flag",)
TEXT_COLUMNS = ("student_id", "level", "program", "major", "student_type",
                "campus_code", "state", "payment_plan")
DOUBLE_COLUMNS = ("age", "gpa", "credits_earned", "num_loans",
                  "original_loan_amount", "current_balance")
INT_COLUMNS = ("graduated", "withdrawn", "default_flag")

CLEAN_SCHEMA = T.StructType([
    T.StructField(c, T.StringType() if c in TEXT_COLUMNS
                  else T.DoubleType() if c in DOUBLE_COLUMNS else T.IntegerType(),
                  c not in INT_COLUMNS)
    for c in FINAL_COLUMNS
])


def with_clean_columns(conformed: DataFrame, profile: Profile, cfg: RiskConfig) -> DataFrame:
    """All typed columns next to the conformed text (no filter yet).

    Missing-value text becomes null here, once, at the dataset boundary. Texts
    are stripped in a first projection and read as numbers or date parts in a
    second: an expression that is used several times would be evaluated as
    often in one projection (a number's text was stripped and matched four times).
    """
    c = F.col
    text = ("student_id", "program", "major", "student_type", "campus_code", "state", "payment_plan",
            "gpa", "credits_earned", "num_loans", "days_delinquent")
    money = ("original_loan_amount", "current_balance")
    numbers = ("gpa", "credits_earned", "num_loans", "days_delinquent", *money)
    stripped = conformed.select(
        "*", *[LF.normalize_str(n).alias(f"_text_{n}") for n in text],
        *[LF.normalize_str(LF.without_currency(n)).alias(f"_text_{n}") for n in money],
        LF.date_text("birth_date").alias("_text_birth"))
    read = stripped.select("*", *[LF.plain_number(f"_text_{n}").alias(f"_read_{n}") for n in numbers],
                           LF.parts_of("_text_birth").alias("_read_birth"))
    typed = read.select(
        "*",
        *[LF.known(f"_text_{n}").alias(f"_{n}") for n in ("student_id", "program", "major", "student_type", "campus_code")],
        F.upper(LF.known("_text_state")).alias("_state"),
        LF.known("_text_payment_plan").alias("_payment_plan"),
        LF.age_years(LF.date_of(c("_read_birth"), cfg.day_first), cfg.as_of).alias("_age"),
        *[LF.finite(f"_read_{n}").alias(f"_{n}") for n in ("gpa", "credits_earned", "num_loans", *money)],
        LF.flag_equals("graduated_ind", profile.graduated_true_value).alias("_graduated"),
        LF.flag_in("enrollment_status", profile.withdrawn_codes).alias("_withdrawn"),
        LF.default_flag(F.coalesce(LF.finite("_read_days_delinquent"), F.lit(0.0)), cfg.threshold_days).alias("_default_flag"),
        valid_level(cfg.level_codes).alias("_valid"),
    ).withColumn("_level", c("level"))
    return typed.drop(*[f"_text_{n}" for n in (*text, *money, "birth")], *[f"_read_{n}" for n in (*numbers, "birth")])


def project_final(wide: DataFrame) -> DataFrame:
    """The fixed 17 columns; the raw birth date is never carried over."""
    return wide.select(*[F.col(f"_{name}").alias(name) for name in FINAL_COLUMNS])


def clean_dataset(raw: DataFrame, profile: Profile, cfg: RiskConfig) -> DataFrame:
    """Conform, type and filter: the clean borrower table (Q3)."""
    return clean_conformed(conform(raw, profile), profile, cfg)


def clean_conformed(conformed: DataFrame, profile: Profile, cfg: RiskConfig) -> DataFrame:
    """Type and filter rows that have canonical names already."""
    return project_final(with_clean_columns(conformed, profile, cfg).where(F.col("_valid")))


def population_counts(raw: DataFrame, profile: Profile, cfg: RiskConfig) -> DataFrame:
    """A1 + A3: raw, excluded and valid rows, defaults and rate, shape.

    One aggregate over the conformed rows (before the filter) gives every
    count in a single pass.
    """
    return population_counts_wide(with_clean_columns(conform(raw, profile), profile, cfg))


def population_counts_wide(wide: DataFrame) -> DataFrame:
    """A1 + A3 on the output of ``with_clean_columns`` (all rows)."""
    valid = F.col("_valid")
    agg = wide.agg(
        F.count(F.lit(1)).alias("total_raw"),
        F.count_if(valid).alias("valid_population"),
        F.sum(F.when(valid, F.col("_default_flag"))).cast("bigint").alias("defaults"),
    )
    return agg.select(
        "total_raw",
        (F.col("total_raw") - F.col("valid_population")).alias("excluded_invalid_level"),
        "valid_population",
        F.coalesce(F.col("defaults"), F.lit(0)).cast("bigint").alias("defaults"),
        LF.safe_rate(F.coalesce(F.col("defaults"), F.lit(0)), "valid_population")
        .alias("default_rate"),
        F.col("valid_population").alias("n_rows"),
        F.lit(len(FINAL_COLUMNS)).cast("bigint").alias("n_cols"),
    )


def level_breakdown(clean: DataFrame, level_codes) -> DataFrame:
    """A2: rows and share per canonical level, zero-filled."""
    aggs = [F.count_if(F.col("level") == code).alias(f"n_{i}") for i, code in enumerate(level_codes)]
    wide = clean.agg(F.count(F.lit(1)).alias("_total"), *aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(code).alias("level"), F.col(f"n_{i}").alias("n"))
        for i, code in enumerate(level_codes)]))
    return wide.select("_total", stack.alias("s")).select(
        F.col("s.level").alias("level"), F.col("s.n").cast("bigint").alias("n"),
        LF.safe_rate("s.n", "_total").alias("share"))


def default_rate_by_level(clean: DataFrame) -> DataFrame:
    """A4: n, defaults and rate per level present in the data."""
    return clean.groupBy("level").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("default_flag").cast("bigint").alias("defaults"),
        LF.safe_rate(F.sum("default_flag"), F.count(F.lit(1))).alias("default_rate"),
    )


def enrollment_breakdown(raw: DataFrame, profile: Profile, cfg: RiskConfig) -> DataFrame:
    """A5: valid rows per raw enrollment status (missing status not counted)."""
    conformed = filter_valid(conform(raw, profile), cfg.level_codes)
    return (conformed.where(F.col("enrollment_status").isNotNull())
            .groupBy("enrollment_status").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "enrollment_status"))           # L8


def _unpivot_counts(wide: DataFrame, names, value_fmt: str, total: str = "_total") -> DataFrame:
    stack = F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(value_fmt.format(i=i)).cast("bigint").alias("v"))
        for i, n in enumerate(names)]))
    return wide.select(F.col(total), stack.alias("s"))


def feature_completeness(clean: DataFrame) -> DataFrame:
    """Non-null rows and share for the 15 features."""
    wide = clean.agg(F.count(F.lit(1)).alias("_total"),
                     *[F.count(F.col(f)).alias(f"c_{i}") for i, f in enumerate(FEATURES)])
    long = _unpivot_counts(wide, FEATURES, "c_{i}")
    return long.select(F.col("s.name").alias("feature"), F.col("s.v").alias("non_null"),
                       LF.safe_rate("s.v", "_total").alias("share"))
