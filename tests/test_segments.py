"""Segmentation: min-n filter, fallback, status, IDR, report text."""

from pyspark.sql import functions as F

from loanlens.config import RiskConfig
from loanlens.operators import segments as S


def _df(spark, values, defaults):
    return spark.createDataFrame(list(zip(values, defaults)), "grp string, default_flag int")


def test_segment_filters_groups_below_min_n(spark):
    g = S.segment(_df(spark, ["A"] * 8 + ["B"] * 3, [1, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0]), "grp", 5).collect()
    assert [r.value for r in g] == ["A"] and g[0].n == 8


def test_segment_falls_back_when_no_group_qualifies(spark):
    g = S.segment(_df(spark, list("AABBCC"), [1, 0, 1, 0, 0, 0]), "grp", 5).collect()
    assert {r.value for r in g} == {"A", "B", "C"}


def test_segment_caps_fallback_at_15(spark):
    g = S.segment(_df(spark, [f"plan-{i}" for i in range(30)], [i % 2 for i in range(30)]), "grp", 5)
    assert g.count() == 15


def test_segment_fallback_keeps_largest_groups(spark):
    values = [f"v{i:02d}" for i in range(20) for _ in range(1 + (i % 4))]
    g = S.segment(_df(spark, values, [0] * len(values)), "grp", 100).collect()
    assert len(g) == 15 and min(r.n for r in g) >= 2


def test_segment_all_null_is_empty(spark):
    df = spark.createDataFrame([(None, 0), (None, 1), (None, 0)], "grp string, default_flag int")
    assert S.segment(df, "grp", 5).count() == 0


def _clean_like(spark):
    rows = []
    for i in range(40):
        rows.append((f"S{i}", "UG" if i % 3 else "GR", "P", "M", "New", "MAIN", 22.0 + i % 5, "NH",
                     1.5 + (i % 5) * 0.5, 10.0, i % 2, int(i % 7 == 0), 1.0, 4000.0 + 1000 * i, 1.0,
                     "Income-Based Repayment" if i % 4 == 0 else "Standard", int(i % 5 == 0)))
    schema = ("student_id string, level string, program string, major string, student_type string, "
              "campus_code string, age double, state string, gpa double, credits_earned double, "
              "graduated int, withdrawn int, num_loans double, original_loan_amount double, "
              "current_balance double, payment_plan string, default_flag int")
    return spark.createDataFrame(rows, schema)


def test_status_rates_fixed_order(spark):
    rows = S.status_rates(_clean_like(spark)).orderBy("position").collect()
    assert [r.status for r in rows] == list(S.STATUS_LABELS)
    assert rows[0].n + rows[1].n == 40 and rows[2].n + rows[3].n == 40


def test_idr_finding(spark):
    r = S.idr_finding(_clean_like(spark), RiskConfig()).first()
    assert r.idr_n == 10 and r.non_idr_n == 30
    assert r.idr_differential == r.non_idr_rate - r.idr_rate


def test_segment_rates_flags_and_titles(spark):
    rates = S.segment_rates(_clean_like(spark), RiskConfig())
    got = rates.where(F.col("segment") == "level").collect()
    assert {r.value for r in got} == {"UG — Undergraduate", "GR — Graduate"}
    assert {r.title for r in got} == {"Level (LEVL_CODE)"}
    assert all(r.flag in ("above", "near", "below") for r in rates.collect())


def test_segment_report_text(spark):
    rep = S.segment_report(_clean_like(spark), RiskConfig()).collect()
    assert all(r.default_rate_text == f"{r.default_rate:.1%}" for r in rep)
    assert {r.segment for r in rep} >= {S.STATUS_TITLE, S.IDR_TITLE, "GPA band"}


def test_band_order_and_top_k(spark):
    rates = S.segment_rates(_clean_like(spark), RiskConfig())
    bands = [r.band_ord for r in S.band_ordered(rates.where(F.col("segment") == "gpa_band")).collect()]
    assert bands == sorted(bands)
    top = S.top_segments(rates, cuts=(("level", 1),)).collect()
    best = max(rates.where(F.col("segment") == "level").collect(), key=lambda r: (r.default_rate, r.n))
    assert len(top) == 1 and top[0].value == best.value and top[0].seg_rank == 1


def test_a_segment_with_many_values_is_cut_in_every_task(spark):
    g = (spark.range(200_000).selectExpr(
        "'wide' AS segment", "cast(id AS string) AS value", "-1 AS band_ord",
        "cast(1 + id % 4 AS bigint) AS n", "0L AS defaults", "5 AS min_n").repartition(16)
        .union(spark.sql("SELECT 'small', 'a', -1, 9L, 3L, 5 UNION ALL SELECT 'small', 'b', -1, 2L, 0L, 5")))
    shown = S.apply_min_n(g, 15)
    rows = shown.collect()
    assert {(r.value, r.n) for r in rows if r.segment == "small"} == {("a", 9)}
    wide = [r.value for r in rows if r.segment == "wide"]
    assert sorted(wide) == sorted(sorted(str(i) for i in range(200_000) if i % 4 == 3)[:15])
    plan = shown._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan   # before the shuffle and after it
