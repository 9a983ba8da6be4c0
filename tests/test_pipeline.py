"""Full run (R1) and its sinks (S3, S5, S6, S7) on the sf0.001 fixture."""

import csv
import glob

import pytest

from loanlens.config import ModelConfig
from loanlens.operators.model import score
from loanlens.operators.training import RiskModel
from loanlens.plans.pipeline import PipelineError, run_pipeline
from loanlens.sources.fixture import raw_borrowers
from loanlens.sources.raw import read_clean

SMALL = "/root/testdata/sf0.001"


def test_pipeline_writes_every_table(spark, tmp_path):
    out = str(tmp_path / "run")
    cfg = ModelConfig(rf_trees=5, gbt_stages=3, lr_max_iter=30)
    res = run_pipeline(spark, raw_borrowers(spark, SMALL), out, model=cfg)
    assert res.summary["etl"]["valid_population"] == read_clean(spark, res.tables["dataset"]).count()
    assert res.summary["model"]["best_model"] in cfg.models
    for name in ("population_counts", "missing_values", "segment_rates", "cv_summary",
                 "subgroup_auc", "feature_importance_rollup"):
        assert spark.read.json(res.tables[name]).count() > 0, name
    rows = []
    for part in sorted(glob.glob(res.tables["segment_report_csv"] + "/part-*.csv")):
        with open(part, newline="") as fh:
            rows += list(csv.reader(fh))
    assert rows[0] == ["Segment", "Value", "n", "Defaults", "Default Rate"]
    assert all(r[4].endswith("%") for r in rows[1:] if r[0] != "Segment")
    model = RiskModel.load(spark, res.tables["best_model"])
    clean = read_clean(spark, res.tables["dataset"])
    assert score(model, clean).where("score between 0 and 1").count() == clean.count()


def test_pipeline_names_failing_step(spark, tmp_path):
    raw = raw_borrowers(spark, SMALL).drop("Payment Plan")
    with pytest.raises(PipelineError) as err:
        run_pipeline(spark, raw, str(tmp_path / "bad"), model=None)
    assert err.value.step == "etl" and "missing 1 column" in str(err.value)


def test_a_run_that_dies_leaves_the_last_version_readable(spark, tmp_path, monkeypatch):
    from loanlens.plans import pipeline
    from loanlens.sources.commit import manifest, newest, read_result

    out, raw = str(tmp_path / "run"), raw_borrowers(spark, SMALL)
    with pytest.raises(LookupError):
        read_result(spark, out, "segment_rates")
    first = run_pipeline(spark, raw, out, model=None)
    rates = {tuple(r) for r in read_result(spark, out, "segment_rates", check=True).collect()}
    assert first.summary["version"] == 1 and len(rates) > 20

    monkeypatch.setattr(pipeline.S, "status_rates", lambda clean: 1 / 0)       # dies between tables
    with pytest.raises(PipelineError):
        run_pipeline(spark, raw.limit(100), out, model=None)
    assert {tuple(r) for r in read_result(spark, out, "segment_rates", check=True).collect()} == rates
    assert newest(spark, out).select("version").distinct().count() == 1
    monkeypatch.undo()
    second = run_pipeline(spark, raw.limit(300), out, model=None)
    assert second.summary["version"] == 2 and manifest(spark, out).select("version").distinct().count() == 2
    assert read_result(spark, out, "dataset", check=True).count() < 301


def test_fingerprints_go_by_content_alone(spark):
    from loanlens.sources.commit import fingerprint, same_content

    df = spark.createDataFrame([(1, None, 0.0), (None, 1, 2.5), (3, 3, None), (3, 3, None)], "a int, b int, c double")
    assert same_content(df, df.repartition(3).orderBy("c"))
    assert same_content(df, df.withColumn("c", -(-df.c)))
    for other in (df.select(df.b.alias("a"), df.a.alias("b"), "c"), df.distinct(), df.limit(3), df.withColumn("c", df.c + 1)):
        assert not same_content(df, other)
    assert fingerprint(df.limit(0)).first()[0] == 0
