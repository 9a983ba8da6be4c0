"""Streaming ETL over an upload folder gives the batch result."""

import pytest
from conftest import banner_rows
from pyspark.errors import StreamingQueryException

from loanlens.config import RiskConfig
from loanlens.streaming import start_clean_sink, stream_clean


def _write_csv(path, names, rows):
    lines = [",".join(f'"{n}"' for n in names)] + [",".join(f'"{v}"' for v in r) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def test_stream_clean_matches_batch(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    names, rows = banner_rows()
    _write_csv(inbox / "a.csv", names, rows)
    names, rows = banner_rows(ID=["U003", "U004"], LEVL_CODE=["XX", "gr"])
    _write_csv(inbox / "b.csv", names, rows)
    q = start_clean_sink(stream_clean(spark, str(inbox), cfg=RiskConfig()),
                         str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    got = sorted((r.student_id, r.level, r.default_flag) for r in out.collect())
    assert got == [("U001", "UG", 0), ("U002", "GR", 1), ("U004", "GR", 1)]


def test_columns_in_another_order(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    names, rows = banner_rows()
    _write_csv(inbox / "a.csv", names[::-1], [r[::-1] for r in rows])
    q = start_clean_sink(stream_clean(spark, str(inbox)), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert sorted(r.student_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["U001", "U002"]


def test_a_file_with_another_header_fails_the_stream(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    names, rows = banner_rows()
    _write_csv(inbox / "a.csv", names[::-1], [r[::-1] for r in rows])
    q = start_clean_sink(stream_clean(spark, str(inbox), header=names), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(120)
    assert not any(p.suffix == ".parquet" and p.stat().st_size for p in (tmp_path / "out").glob("*.parquet"))


def test_arriving_files_may_order_their_columns_differently(spark, tmp_path):
    import csv

    from loanlens.streaming import start_mixed_sink
    from tests.conftest import banner_rows

    names, rows = banner_rows()
    inbox, out, ckpt = tmp_path / "inbox", str(tmp_path / "out"), str(tmp_path / "ckpt")
    inbox.mkdir()

    def drop(file, table):
        with open(inbox / file, "w", newline="") as f:
            csv.writer(f).writerows(table)

    def run():
        q = start_mixed_sink(spark, str(inbox), out, ckpt)
        q.awaitTermination(120)
        return q

    drop("a.csv", [names, *rows])
    drop("b.csv", [[n.lower() for n in names[::-1]], *[r[::-1] for r in rows]])
    run()
    assert spark.read.parquet(out).count() == 4
    drop("c.csv", [[*names[1:], "more", names[0]], *[[*r[1:], "m", r[0] + "x"] for r in rows]])
    run()
    got = [(r.student_id, r.level, r.default_flag) for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted([("U001", "UG", 0), ("U002", "GR", 1)] * 2 + [("U001x", "UG", 0), ("U002x", "GR", 1)])
    drop("d.csv", [names[1:], *[r[1:] for r in rows]])
    try:
        failure = str(run().exception())
    except Exception as err:  # noqa: BLE001 - awaitTermination raises the stream's failure
        failure = str(err)
    assert "ID" in failure and "d.csv" in failure
    assert spark.read.parquet(out).count() == 6
