"""Conformance, cleaning and ETL counts."""

import pytest
from pyspark.sql import functions as F

from conftest import banner_rows, text_df
from loanlens.config import RiskConfig
from loanlens.operators import clean as C
from loanlens.operators.conform import conform, reject_report
from loanlens.sources.profiles import get_profile
from loanlens.sources.raw import read_raw

BANNER = get_profile("banner")
CFG = RiskConfig(as_of="2026-01-01")


def test_conform_renames_columns(spark):
    df = conform(text_df(spark, *banner_rows()), BANNER)
    assert {"student_id", "level", "gpa"} <= set(df.columns)
    assert "ID" not in df.columns and "LEVL_CODE" not in df.columns


def test_conform_preserves_level_values(spark):
    df = conform(text_df(spark, *banner_rows()), BANNER)
    assert {r.level for r in df.collect()} == {"UG", "GR"}


def test_peoplesoft_ugrd_becomes_ug(spark):
    names = ["EMPLID", "ACAD_LEVEL_BOT", "ACAD_PROG", "ACAD_PLAN", "ADMIT_TYPE", "CAMPUS",
             "BIRTHDATE", "ADDR_STATE", "CUM_GPA", "TOT_TAKEN_GPA", "COMPLETION_STAT",
             "STDNT_ENRL_STATUS", "Days Delinquent", "# of Loans", "Original Loan Amount",
             "Current Principal Balance", "Payment Plan"]
    row = ("P001", " ugrd ", "BSCS", "CS", "FTF", "MAIN", "2001-01-01", "CA", "3.0", "45", "CM",
           "ACTV", "0", "1", "$5,000", "$4,000", "Standard")
    ps = get_profile("peoplesoft")
    df = conform(text_df(spark, names, [row]), ps)
    assert df.first().level == "UG"
    clean = C.clean_dataset(text_df(spark, names, [row]), ps, CFG).first()
    assert clean.graduated == 1 and clean.withdrawn == 0


def test_conform_case_insensitive_and_blank_headers(spark):
    names, rows = banner_rows()
    df = conform(text_df(spark, [f" {n.lower()} " for n in names], rows), BANNER)
    assert "student_id" in df.columns and "days_delinquent" in df.columns


def test_conform_missing_headers_raise_listing_all(spark):
    df = text_df(spark, ["ID", "LEVL_CODE"], [("U001", "UG")])
    with pytest.raises(ValueError, match="missing 15 column") as err:
        conform(df, BANNER)
    assert "MAJR_DESC" in str(err.value) and "Payment Plan" in str(err.value)


def test_conform_dotted_headers(spark):
    cp = get_profile("colleague")
    names = [h for h, _ in cp.column_map]
    row = ["C1", "UG", "P", "M", "T", "L", "1990-01-01", "ny", "3", "10", "Y", "WA", "300", "1",
           "$1", "$1", "Standard"]
    clean = C.clean_dataset(text_df(spark, names, [row]), cp, CFG).first()
    assert clean.withdrawn == 1 and clean.default_flag == 1 and clean.state == "NY"


def test_clean_two_students(spark):
    rows = C.clean_dataset(text_df(spark, *banner_rows()), BANNER, CFG).orderBy("student_id").collect()
    assert [r.default_flag for r in rows] == [0, 1]
    assert [r.graduated for r in rows] == [1, 0]
    assert [r.withdrawn for r in rows] == [0, 1]
    assert [r.state for r in rows] == ["NH", "MA"]
    assert [r.age for r in rows] == [25.0, 27.0]
    assert rows[0].original_loan_amount == 10000.0


def test_clean_schema_drops_birth_date(spark):
    df = C.clean_dataset(text_df(spark, *banner_rows()), BANNER, CFG)
    assert tuple(df.columns) == C.FINAL_COLUMNS
    assert "birth_date" not in df.columns and "age" in df.columns
    assert df.schema == C.CLEAN_SCHEMA or [f.dataType for f in df.schema] == [
        f.dataType for f in C.CLEAN_SCHEMA]


def test_level_filter_and_reject_report(spark):
    names, rows = banner_rows(LEVL_CODE=["CE", None])
    raw = text_df(spark, names, rows)
    assert C.clean_dataset(raw, BANNER, CFG).count() == 0
    rej = {r.level: r.n for r in reject_report(conform(raw, BANNER), ("UG", "GR")).collect()}
    assert rej == {"CE": 1, None: 1}


def test_population_counts(spark):
    names, rows = banner_rows()
    names2, rows2 = banner_rows(ID=["U003", "U004"], LEVL_CODE=["XX", "ug"])
    raw = text_df(spark, names, rows + rows2)
    r = C.population_counts(raw, BANNER, CFG).first()
    assert (r.total_raw, r.excluded_invalid_level, r.valid_population, r.defaults) == (4, 1, 3, 2)
    assert r.default_rate == pytest.approx(2 / 3)


def test_level_breakdown_zero_filled(spark):
    names, rows = banner_rows(LEVL_CODE=["UG", "UG"])
    clean = C.clean_dataset(text_df(spark, names, rows), BANNER, CFG)
    got = {r.level: (r.n, r.share) for r in C.level_breakdown(clean, ("UG", "GR")).collect()}
    assert got == {"UG": (2, 1.0), "GR": (0, 0.0)}


def test_feature_completeness(spark):
    names, rows = banner_rows(PROGRAM=["CS", "N/A"])
    clean = C.clean_dataset(text_df(spark, names, rows), BANNER, CFG)
    got = {r.feature: r.non_null for r in C.feature_completeness(clean).collect()}
    assert got["program"] == 1 and got["gpa"] == 2 and len(got) == 15


def test_read_raw_csv_keeps_text(spark, tmp_path):
    p = tmp_path / "input.csv"
    p.write_text("ID,LEVL_CODE\n007,UG\n")
    df = read_raw(spark, str(p))
    assert df.first().ID == "007"
    with pytest.raises(ValueError, match="Unsupported"):
        read_raw(spark, str(tmp_path / "input.xlsx"))


def test_end_to_end_from_csv(spark, tmp_path):
    names, rows = banner_rows()
    p = tmp_path / "borrowers.csv"
    lines = [",".join(f'"{n}"' for n in names)] + [",".join(f'"{v}"' for v in r) for r in rows]
    p.write_text("\n".join(lines) + "\n")
    clean = C.clean_dataset(read_raw(spark, str(p)), BANNER, CFG)
    assert clean.where(F.col("default_flag") == 1).count() == 1


def test_read_raw_json_and_parquet(spark, tmp_path):
    names, rows = banner_rows()
    src = text_df(spark, names, rows)
    src.write.json(str(tmp_path / "in.json"))
    src.write.parquet(str(tmp_path / "in.parquet"))
    for path, fmt in ((tmp_path / "in.json", "json"), (tmp_path / "in.parquet", "parquet")):
        df = read_raw(spark, str(path), fmt)
        assert all(t == "string" for _, t in df.dtypes)
        assert C.clean_dataset(df, BANNER, CFG).count() == 2


def test_workday_profile_on_fixture(spark):
    from loanlens.sources.fixture import as_profile, raw_borrowers

    raw = raw_borrowers(spark, "/root/testdata/sf0.001")
    wd = get_profile("workday")
    a = C.clean_dataset(raw, BANNER, CFG)
    b = C.clean_dataset(as_profile(raw, wd), wd, CFG)
    assert a.count() == b.count()
    # same data, other withdrawn codes: only 'WD' is shared with Banner's set
    wd_withdrawn = b.agg(F.sum("withdrawn")).first()[0]
    assert wd_withdrawn == raw.where(F.upper(F.trim("SFBETRM_ESTS_CODE")) == "WD").join(
        a.select(F.col("student_id").alias("ID_")), F.trim(F.col("ID")) == F.col("ID_")).count()


def test_read_raw_takes_spreadsheet_csv(spark, tmp_path):
    folder = tmp_path / "v1.2"
    (folder / "exp").mkdir(parents=True)
    (folder / "exp" / "a.csv").write_text('ID,note\n1,"a ""b"" c"\n2,"two\nlines"\n')
    got = {r.ID: r.note for r in read_raw(spark, str(folder / "exp")).collect()}
    assert got == {"1": 'a "b" c', "2": "two\nlines"}


def test_read_raw_keeps_headers_that_differ_in_case(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("ID,id\n1,2\n")
    df = read_raw(spark, str(p))
    assert df.columns == ["ID", "id"] and tuple(df.first()) == ("1", "2")
    names, rows = banner_rows()
    exact = conform(text_df(spark, [*names, "id"], [(*r, "other") for r in rows]), BANNER)
    assert sorted(r.student_id for r in exact.select("student_id").collect()) == ["U001", "U002"]
    unclear = ["Id" if n == "ID" else n for n in names] + ["iD"]
    with pytest.raises(ValueError, match="differ only in case"):
        conform(text_df(spark, unclear, [(*r, "x") for r in rows]), BANNER)


def test_files_of_a_folder_may_order_their_columns_differently(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,GPA\n1,2\n")
    (tmp_path / "b.csv").write_text("GPA,ID\n3,4\n")
    assert {(r.ID, r.GPA) for r in read_raw(spark, str(tmp_path), "csv").collect()} == {("1", "2"), ("4", "3")}
    (tmp_path / "c.csv").write_text("ID,Other\n5,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path), "csv").collect()
