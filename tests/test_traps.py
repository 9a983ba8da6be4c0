
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens import functions as LF
from loanlens.config import IDR_PATTERN, RiskConfig
from loanlens.operators.eda import numeric_distribution, quantiles
from loanlens.operators.model import cv_summary


def one_col(spark, values, dtype=T.StringType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))


def test_t1_null_comparisons_are_false_not_null(spark):
    df = one_col(spark, [None])
    r = df.select(LF.flag_equals("x", "Y").alias("g"), LF.flag_in("x", ["WD"]).alias("w"),
                  LF.idr_flag("x", IDR_PATTERN).alias("i")).first()
    assert (r.g, r.w, r.i) == (0, 0, False)


def test_t2_ansi_bad_text_never_fails_a_job(spark):
    df = one_col(spark, ["abc", "12/34/5678", "$$", "1e400"])
    rows = df.select(LF.to_numeric("x").alias("n"), LF.clean_currency("x").alias("c"),
                     LF.parse_date("x").alias("d")).collect()
    assert all(r.d is None for r in rows)
    assert rows[3].n is None


def test_t3_lenient_casts_are_guarded(spark):
    got = [r[0] for r in one_col(spark, ["1.5d", "2f", "NaN", "Infinity", "0x1p3"]).select(
        LF.to_numeric("x")).collect()]
    assert got == [None] * 5


def test_t4_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(2.0, 0), (2.0, 1)], "x double, y int")
    assert df.agg(LF.safe_corr("x", "y")).first()[0] is None


def test_t5_strip_tabs_newlines_and_no_break_space(spark):
    got = one_col(spark, [" \tUG \n", " gr　"]).select(LF.normalize_str_upper("x")).collect()
    assert [r[0] for r in got] == ["UG", "GR"]


def test_t7_percent_text_half_even_on_binary_value(spark):
    got = one_col(spark, [1 / 16, 3 / 2000, 0.0625 * 3], T.DoubleType()).select(
        LF.percent_text("x")).collect()
    assert [r[0] for r in got] == [f"{1 / 16:.1%}", f"{3 / 2000:.1%}", f"{0.0625 * 3:.1%}"]


def test_t8_quantiles_interpolate_linearly(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    got = {r.p: r.q for r in quantiles(df, ["v"], (0.25, 0.5)).collect()}
    assert got == {0.25: 1.75, 0.5: 2.5}


def test_t10_sample_std_in_profile_population_std_in_cv(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "gpa double")
    assert numeric_distribution(df, RiskConfig(), cols=("gpa",)).first().std == pytest.approx(1.291, abs=1e-3)
    m = spark.createDataFrame([("m", 0, float(v), 0.0, 0.0, 0.0, 0.0) for v in (1, 2, 3, 4)],
                              "model string, position int, roc_auc double, f1 double, "
                              "precision double, recall double, accuracy double")
    assert cv_summary(m).first().roc_auc_std == pytest.approx(1.118, abs=1e-3)


def test_t11_dates_need_explicit_formats(spark):
    df = one_col(spark, ["05/15/2000"])
    assert df.select(F.try_to_timestamp("x")).first()[0] is None
    assert df.select(LF.parse_date("x")).first()[0] is not None
