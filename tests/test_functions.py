"""Column functions: cleaners, flags, bands, formatting, traps."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens import functions as LF
from loanlens.config import OVERDUE_DAYS, IDR_PATTERN


def col_values(spark, values, expr_fn, dtype=T.StringType()):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_normalize_str_strips_whitespace(spark):
    assert col_values(spark, ["  hello  ", "world", "  "], LF.normalize_str) == ["hello", "world", ""]


def test_normalize_str_strips_mixed_whitespace(spark):
    assert col_values(spark, ["\t  foo \n", "bar  ", "baz", " x "], LF.normalize_str) == [
        "foo", "bar", "baz", "x"]


def test_normalize_str_upper(spark):
    assert col_values(spark, ["  hello  ", "World", "ug"], LF.normalize_str_upper) == [
        "HELLO", "WORLD", "UG"]


def test_to_numeric_valid(spark):
    assert col_values(spark, ["1.5", "3", "0", " 7 ", ".5", "1e3"], LF.to_numeric) == [
        1.5, 3.0, 0.0, 7.0, 0.5, 1000.0]


def test_to_numeric_invalid_is_null(spark):
    assert col_values(spark, ["abc", None, "N/A"], LF.to_numeric) == [None, None, None]


def test_to_numeric_traps_are_null(spark):
    # Spark's own cast would accept these ('1.5d' -> 1.5, 'NaN' -> NaN)
    assert col_values(spark, ["1.5d", "2f", "NaN", "inf", "1_000", ""], LF.to_numeric) == [None] * 6


def test_clean_currency(spark):
    assert col_values(spark, ["$1,234.56", "$0.00", "500"], LF.clean_currency) == [1234.56, 0.0, 500.0]
    assert col_values(spark, ["N/A", "unknown", None, "(500)"], LF.clean_currency) == [None] * 4


def test_default_flag_boundary(spark):
    days = ["269", "270", "271", "0", None, "junk"]
    got = col_values(spark, days, lambda c: LF.default_flag(LF.delinquent_days(c), OVERDUE_DAYS))
    assert got == [0, 0, 1, 0, 0, 0]
    assert OVERDUE_DAYS == 270


def test_na_tokens_to_null(spark):
    got = col_values(spark, ["", " NA ", "null", "None", "n/a", "x", "NAN"], LF.na_to_null)
    assert got == [None, None, None, None, None, "x", "NAN"]


def test_gpa_band_right_closed(spark):
    got = col_values(spark, [0.0, 0.5, 2.0, 2.01, 4.0, 4.3, None, -1.0], LF.gpa_band, T.DoubleType())
    assert got == [None, "< 2.0", "< 2.0", "2.0–2.5", "3.5–4.0", None, None, None]


def test_age_and_loan_bands(spark):
    assert col_values(spark, [20.0, 20.5, 40.0, 41.0, 121.0], LF.age_band, T.DoubleType()) == [
        "< 20", "20–24", "30–39", "40+", None]
    assert col_values(spark, [5000.0, 5000.01, 999999.0, 1e6], LF.loan_band, T.DoubleType()) == [
        "< $5K", "$5K–$15K", "> $50K", None]


def test_idr_flag(spark):
    plans = ["Income-Based Repayment - Partial Financial Hardship", "Pay as You Earn (PAYE)",
             "Saving on a Valuable Education (SAVE)", "Income Contingent Repayment",
             "IBR", "SAVE", "Graduated 10-Year Repayment", None]
    got = col_values(spark, plans, lambda c: LF.idr_flag(c, IDR_PATTERN))
    assert got == [True] * 4 + [False] * 4


def test_percent_text_rounds_like_python(spark):
    fracs = [(1, 16), (3, 16), (3, 2000), (23, 2000), (1, 3), (7, 40)]
    got = col_values(spark, [d / n for d, n in fracs], LF.percent_text, T.DoubleType())
    assert got == [f"{d / n:.1%}" for d, n in fracs]


def test_rate_flag(spark):
    got = col_values(spark, [0.20, 0.13, 0.06, 0.0999], lambda c: LF.rate_flag(c, F.lit(0.10), 0.03),
                     T.DoubleType())
    assert got == ["above", "near", "below", "near"]


def test_safe_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 0)], "x double, y int")
    assert df.agg(LF.safe_corr("x", "y")).first()[0] is None


def test_safe_corr_matches_corr(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (3.5, 1), (None, 1), (0.5, 0)], "x double, y int")
    got, ref = df.agg(LF.safe_corr("x", "y"), F.corr("x", "y")).first()
    assert got == pytest.approx(ref, rel=1e-12)


def test_parse_date_and_age(spark):
    same_day = ["2000-05-15", "05/15/2000", "5/15/2000", "2000-5-15", "2000/05/15", "2000-05-15T00:00:00",
                "2000-05-15 00:00:00.0", "2000-05-15T10:20:30Z", " 5/15/2000 12:00 AM "]
    assert col_values(spark, same_day, lambda c: LF.parse_date(c).cast("string")) == ["2000-05-15"] * len(same_day)
    assert col_values(spark, ["2000-13-01", "2/30/2000", "15.05.2000", "2000-05", "15/05-2000", "5/15/00", "20001341", "", "1/2/3"],
                      LF.parse_date) == [None] * 9
    first = ["15/05/2000", "15.05.2000", "15-5-2000 10:00", "2000-05-15", "20000515", "2000.5.15"]
    assert col_values(spark, first, lambda c: LF.parse_date(c, day_first=True).cast("string")) == ["2000-05-15"] * 6
    got = col_values(spark, ["2000-05-15", "05/15/2000", "unknown", None],
                     lambda c: LF.age_years(LF.parse_date(c), "2026-01-01"))
    assert got == [25.0, 25.0, None, None]


def test_feature_family_and_direction(spark):
    assert col_values(spark, ["gpa", "num_loans", "program"], LF.feature_family) == [
        LF.FAMILY_ACADEMIC, LF.FAMILY_LOAN, LF.FAMILY_OTHER]
    assert col_values(spark, [0.0, -0.1, 0.2], LF.corr_direction, T.DoubleType()) == ["+", "-", "+"]


def test_approx_quantiles_option(spark):
    from loanlens.config import RiskConfig
    from loanlens.operators.eda import numeric_distribution

    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "gpa double")
    exact = numeric_distribution(df, RiskConfig(), cols=("gpa",)).first()
    approx = numeric_distribution(df, RiskConfig(approx_quantiles=True), cols=("gpa",)).first()
    assert exact.median == 50.5 and exact.p25 == 25.75
    assert abs(approx.median - 50.5) <= 1 and abs(approx.p25 - 25.75) <= 1


def test_display_view_rounds_half_to_even_and_keeps_the_rest(spark):
    from loanlens.operators.eda import display_view

    df = spark.createDataFrame([("x", 3, 0.00025), ("y", 4, 0.00035)], "a string, n int, v double")
    assert [tuple(r) for r in display_view(df).collect()] == [
        ("x", 3, 0.0002), ("y", 4, 0.0004)]


@pytest.mark.parametrize("texts, order, ambiguous, counts", [
    (["03/04/1999", "13/04/1999", "1999-04-03", "unknown", "nonsense", None], "day", False, (1, 0, 1, 2, 2)),
    (["03/04/1999", "04/13/1999", "19990403"], "month", False, (0, 1, 2, 1, 0)),
    (["03/04/1999", "1.2.1999"], "month", True, (0, 0, 2, 2, 0)),
    (["1999-04-03", ""], "month", False, (1, 0, 0, 0, 0)),
    ([], "month", False, (0, 0, 0, 0, 0))])
def test_columns_vote_on_the_order_of_their_dates(spark, texts, order, ambiguous, counts):
    from loanlens.operators.dates import COUNTS, date_order

    df = spark.createDataFrame([(t,) for t in texts], "b string")
    got = date_order(df, "b").first()
    assert (got.date_order, got.ambiguous, tuple(got[c] for c in COUNTS)) == (order, ambiguous, counts)
