"""Quoted CSV read by several tasks equals the one-task reader; folders of mixed headers."""

import csv
import random

import pytest

from loanlens.operators.conform import HeaderError
from loanlens.sources.profiles import get_profile
from loanlens.sources.quoted_csv import csv_records, split_parity
from loanlens.sources.raw import read_csv, read_exports, read_raw
from tests.conftest import banner_rows


def write(path, rows, end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end).writerows(rows)


def cells(r, n):
    parts = ["a", "b,", '"', '""', "\n", "\r\n", "ü", " ", "x" * 9, "1,2", "\n\n", ""]
    return ["".join(r.choices(parts, k=r.randint(0, 5))) for _ in range(n)]


@pytest.fixture()
def tiny_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_rows_equal_the_one_task_reader(spark, tmp_path, tiny_splits, seed, end):
    r = random.Random(seed)
    rows = [[str(k), *cells(r, 3), "e"] for k in range(400)]
    rows[200][2] = "long\n" * 300 + '"'            # one cell over many splits
    write(tmp_path / "a.csv", [["id", 'na"me', "b", "line\nbreak" if seed == 3 else "c", "end"], *rows], end)
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["id", 'na"me', "b", "line\nbreak" if seed == 3 else "c", "end"]
    got = sorted((tuple(x) for x in df.collect()), key=lambda x: int(x[0]))
    plain = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
             .option("lineSep", "\n" if end == "\n" else None).csv(str(tmp_path / "a.csv")) if end == "\n" else None)
    want = [tuple(c or None for c in row) for row in rows]
    assert [tuple(c or None for c in x) for x in got] == want
    if plain is not None:
        assert got == sorted((tuple(x) for x in plain.collect()), key=lambda x: int(x[0]))
    parity = split_parity(spark, [str(tmp_path / "a.csv")])
    splits = parity.collect()
    assert len(splits) > 20 and any(s.open for s in splits) and not all(s.open for s in splits)
    assert csv_records(spark, [str(tmp_path / "a.csv")], parity).rdd.getNumPartitions() > 20


def test_an_open_quote_ends_with_its_file(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text('id,t\n1,"never closed\n' + "2,x\n" * 200)
    (tmp_path / "b.csv").write_text("id,t\n3,y\n\n4,z")
    rows = {r.id: r.t for r in read_raw(spark, str(tmp_path), "csv").collect()}
    assert sorted(rows) == ["1", "3", "4"] and rows["1"].startswith("never closed\n2,x")


def test_files_with_columns_in_another_order(spark, tmp_path):
    tmp_path = tmp_path / "my exports 100%20"
    tmp_path.mkdir()
    write(tmp_path / "a.csv", [["id", "x", "X"], ["1", "a", "A"]])
    write(tmp_path / "b.csv", [["X", "id", "x"], ["B", "2", "b"], ["", "3", ""]])
    (tmp_path / "c.csv").write_bytes(b"\xef\xbb\xbfid,x,X\n4,d,D\n")
    df = read_csv(spark, str(tmp_path))
    names = df.columns
    got = sorted(tuple(dict(zip(names, r))[c] for c in ("id", "x", "X")) for r in df.collect())
    assert got == [("1", "a", "A"), ("2", "b", "B"), ("3", None, None), ("4", "d", "D")]
    write(tmp_path / "d.csv", [["id", "x"], ["5", "e"]])
    with pytest.raises(ValueError, match="other columns"):
        read_csv(spark, str(tmp_path))


def test_exports_of_one_profile_with_mixed_headers(spark, tmp_path):
    names, rows = banner_rows()
    write(tmp_path / "a.csv", [names, *rows])
    write(tmp_path / "b.csv", [[n.lower() for n in names[::-1]] + ["extra"], *[[*r[::-1], "e"] for r in rows]])
    got = read_exports(spark, str(tmp_path), get_profile("banner"))
    assert got.count() == 4 and got.distinct().count() == 2
    assert sorted(r.student_id for r in got.collect()) == ["U001", "U001", "U002", "U002"]
    write(tmp_path / "c.csv", [names[2:], *[r[2:] for r in rows]])
    write(tmp_path / "d.csv", [names[:-1], *[r[:-1] for r in rows]])
    with pytest.raises(HeaderError) as err:
        read_exports(spark, str(tmp_path), get_profile("banner"))
    assert "ID" in str(err.value) and "Payment Plan" in str(err.value) and "c.csv" in str(err.value) and "d.csv" in str(err.value)
