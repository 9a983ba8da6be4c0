"""Raw Banner-style borrower table derived from the driver's tables.

The test tables hold no borrowers, so one borrower is made per order:
orders ⋈ customer ⋈ nation, plus the order's line count from lineitem. The
text is deliberately dirty (blanks around ids and codes, lower-case codes,
'N/A' and 'unknown' cells, currency text) so the cleaning rules have work.
Rules are listed in FIXTURES.md §3; the same rows are produced by the DuckDB
text in ``loanlens.plans.oracle`` for the parity check.

Plan: lineitem is pre-aggregated to one row per order before the join (map
side combine), orders ⋈ customer is a shuffle join on the customer key, and
nation (a 25-row dimension) is left to Catalyst's size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.sources.profiles import get_profile
from loanlens.sources.raw import read_table

# ---------------------------------------------------------------------------
# Fixed values of the fixture (plan names by order-priority digit)
# ---------------------------------------------------------------------------
PLAN_BY_PRIORITY = {
    "1": "Standard Repayment",
    "2": "Revised Pay As You Earn (REPAYE)",
    "3": "Income-Based Repayment - Partial Financial Hardship",
    "4": "Graduated 10-Year Repayment",
    "5": "Income Contingent Repayment",
}


def _pad(c: Column, width: int) -> Column:
    s = c.cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), "0")


def _thousands(amt: Column) -> Column:
    """Integer text with one thousands comma (amounts are below 1,000,000)."""
    return F.when(amt >= 1000, F.concat((amt / 1000).cast("bigint").cast("string"), F.lit(","),
                                        _pad(amt % 1000, 3))).otherwise(amt.cast("string"))


def borrower_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined inputs, one row per order, only the columns the fixture needs."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    lines = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines")))
    return (orders
            .join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))


def raw_borrowers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 17-column raw export (all text) of FIXTURES.md §3."""
    src = borrower_source(spark, sf_dir)
    k = F.col("o_orderkey")
    pr = F.substring("o_orderpriority", 1, 1)
    amt = F.floor(F.col("o_totalprice") / F.lit(8.0))
    gpa_h = F.floor((F.col("c_acctbal") + F.lit(1000.0)) * F.lit(420.0) / F.lit(11000.0)
                    + F.lit(0.5))
    a = F.when(pr.isin("2", "3", "5"), F.lit(1)).otherwise(F.lit(6))
    b = F.when(F.col("c_acctbal") < 4000, F.lit(10)).otherwise(F.lit(2))
    plan = F.lit(None).cast("string")
    for digit, name in PLAN_BY_PRIORITY.items():
        plan = F.when(pr == digit, F.lit(name)).otherwise(plan)
    lvl = k % 20
    iso_birth = F.concat((F.lit(1950) + k % 61).cast("string"), F.lit("-"), _pad(F.lit(1) + k % 12, 2),
                         F.lit("-"), _pad(F.lit(1) + k % 28, 2))
    cols = {
        "ID": F.concat(F.when(k % 9 == 0, F.lit("  ")).otherwise(F.lit("")), F.lit("S"), _pad(k, 8)),
        "LEVL_CODE": (F.when(lvl < 4, F.lit("GR")).when(lvl == 4, F.lit(" gr "))
                      .when(lvl == 5, F.lit("CE")).when(lvl == 6, F.lit(None).cast("string"))
                      .otherwise(F.lit("UG"))),
        "PROGRAM": F.when(k % 50 != 0, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" "))),
        "MAJR_DESC": F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("o_orderstatus")),
        "STYP_DESC": (F.when(F.col("o_orderstatus") == "F", F.lit("First time student"))
                      .when(F.col("o_orderstatus") == "P", F.lit("Transfer Student"))
                      .otherwise(F.lit("Returning Student"))),
        "CAMP_CODE": F.col("n_name"),
        "BIRTH_DATE": (F.when(k % 41 == 0, F.lit("unknown"))
                       .when(k % 43 == 0, F.lit(None).cast("string"))
                       .when(k % 47 == 0, F.concat_ws("/", F.lit(1) + k % 12, F.lit(1) + k % 28, F.lit(1950) + k % 61))
                       .when(k % 53 == 0, F.concat(iso_birth, F.lit("T00:00:00")))
                       .otherwise(iso_birth)),
        "STATE1": (F.when(F.col("n_regionkey") == 0, F.lit("NH"))
                   .when(F.col("n_regionkey") == 1, F.lit("ma"))
                   .when(F.col("n_regionkey") == 2, F.lit(" Ny "))
                   .when(F.col("n_regionkey") == 3, F.lit("VT"))),
        "OVERALL_LGPA_GPA": F.when(k % 37 == 0, F.lit("N/A")).otherwise(
            F.concat((gpa_h / 100).cast("bigint").cast("string"), F.lit("."), _pad(gpa_h % 100, 2))),
        "OVERALL_LGPA_HOURS_EARNED": (k % 131).cast("string"),
        "GRADUATED_IND": (F.when(k % 5 == 0, F.lit("Y")).when(k % 5 == 1, F.lit("y "))
                          .when(k % 5 == 2, F.lit(None).cast("string")).otherwise(F.lit("N"))),
        "SFBETRM_ESTS_CODE": (F.when(k % 19 == 0, F.lit("WD")).when(k % 19 == 1, F.lit("w7"))
                              .when(k % 19 == 2, F.lit("W4")).otherwise(F.lit("EL"))),
        "Days Delinquent": (F.when(k % 23 == 0, F.lit(None).cast("string"))
                            .when(k % 29 == 0, F.lit("270"))
                            .when((k * 37) % 100 < a + b, (F.lit(271) + k % 200).cast("string"))
                            .otherwise((k % 270).cast("string"))),
        "# of Loans": F.coalesce(F.col("n_lines"), F.lit(0)).cast("string"),
        "Original Loan Amount": F.concat(F.lit("$"), _thousands(amt), F.lit(".00")),
        "Current Principal Balance": F.when(k % 31 == 0, F.lit("unknown")).otherwise(
            F.concat(F.lit("$"), F.floor(amt * (k % 10) / F.lit(10.0)).cast("string"))),
        "Payment Plan": F.when(k % 97 == 0, F.lit("IBR")).otherwise(plan),
    }
    return src.select(*[cols[h].alias(h) for h in get_profile("banner").expected_columns])


def as_profile(raw_banner: DataFrame, profile) -> DataFrame:
    """The same export with another system's headers (rename only).

    Lets every profile's header map, level map and codes run on the fixture
    data; headers with dots (one profile uses them) go through ``toDF``.
    """
    banner = dict((c, h) for h, c in get_profile("banner").column_map)
    target = dict((c, h) for h, c in profile.column_map)
    by_header = {banner[c]: target[c] for c in banner}
    return raw_banner.toDF(*[by_header.get(h, h) for h in raw_banner.columns])
