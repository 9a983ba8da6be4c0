"""Folds, weights, AUC and the model run (properties, brute force)."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from loanlens.config import ModelConfig
from loanlens.operators.folds import fold_class_weights, stratified_folds
from loanlens.operators.model import run_models
from loanlens.operators.ranking import rank_auc
from loanlens.plans.queries import _clean

SMALL = "/root/testdata/sf0.001"


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_rank_auc_matches_brute_force_with_ties(spark):
    rng = random.Random(7)
    rows = [(g, float(rng.randint(0, 30)), int(rng.random() < 0.3)) for g in ("a", "b")
            for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, s double, y int")
    got = {r.g: r.auc for r in rank_auc(df, ["g"], "s", "y").collect()}
    for g in ("a", "b"):
        assert got[g] == pytest.approx(brute_auc([(s, y) for gg, s, y in rows if gg == g]), abs=1e-12)


def test_rank_auc_without_groups_and_one_class(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1), (0.5, 0), (0.5, 1)], "s double, y int")
    assert rank_auc(df, [], "s", "y").first().auc == pytest.approx(brute_auc(
        [(0.1, 0), (0.9, 1), (0.5, 0), (0.5, 1)]))
    one = spark.createDataFrame([(0.1, 0), (0.2, 0)], "s double, y int")
    assert rank_auc(one, [], "s", "y").first().auc is None


def test_stratified_folds_balanced(spark):
    clean = _clean(spark, SMALL)
    folded = stratified_folds(clean, "student_id", "default_flag", 5, 42, hex_digits=2)
    sizes = folded.groupBy("default_flag", "fold").count().collect()
    for y in (0, 1):
        ns = [r["count"] for r in sizes if r.default_flag == y]
        assert len(ns) == 5 and max(ns) - min(ns) <= 1
    assert folded.count() == clean.count()
    # same dealing as an independent computation of the documented order
    import hashlib

    expected = {}
    rows = clean.select("student_id", "default_flag").collect()
    for y in (0, 1):
        keyed = sorted((hashlib.md5(f"{r.student_id}:42".encode()).hexdigest(), r.student_id)
                       for r in rows if r.default_flag == y)
        expected.update({sid: i % 5 for i, (_, sid) in enumerate(keyed)})
    got = {r.student_id: r.fold for r in folded.select("student_id", "fold").collect()}
    assert got == expected


def test_models_use_the_registered_folds(spark, report):
    from loanlens.plans.queries import q_stratified_folds

    registered = {r.student_id: r.fold for r in q_stratified_folds(spark, SMALL).collect()}
    used = {r.student_id: r.fold for r in report.oof.select("student_id", "fold").distinct().collect()}
    assert used == registered


def test_fold_class_weights(spark):
    folded = stratified_folds(_clean(spark, SMALL), "student_id", "default_flag", 5, 42)
    for r in fold_class_weights(folded).collect():
        assert r.n_train_pos * r.w_pos == pytest.approx(r.n_train / 2)
        assert r.n_train_neg * r.w_neg == pytest.approx(r.n_train / 2)


@pytest.fixture(scope="module")
def report(spark):
    cfg = ModelConfig(rf_trees=8, gbt_stages=5, lr_max_iter=50, parallelism=4)
    return run_models(_clean(spark, SMALL), cfg)


def test_cv_every_row_scored_once_per_model(report):
    oof = report.oof
    n = report.training_rows
    per_model = {r.model: r["count"] for r in oof.groupBy("model").count().collect()}
    assert set(per_model.values()) == {n}
    assert oof.select("model", "student_id").distinct().count() == 3 * n


def test_cv_metrics_ranges(report):
    rows = report.cv_metrics.collect()
    assert len(rows) == 15
    for r in rows:
        for m in ("roc_auc", "f1", "precision", "recall", "accuracy"):
            assert 0.0 <= r[m] <= 1.0


def test_best_model_is_highest_mean_auc(report):
    rows = report.cv_summary.collect()
    assert report.best_model == max(rows, key=lambda r: (r.roc_auc_mean, -r.position)).model


def test_importance_rollup(report):
    roll = report.importance_rollup.collect()
    roots = {r.root for r in roll}
    assert {"gpa", "program", "payment_plan"} <= roots
    if report.best_model != "Logistic Regression":
        assert sum(r.importance for r in roll) == pytest.approx(1.0, abs=1e-9)


def test_subgroup_auc(report):
    rows = report.subgroup.collect()
    assert {r.level for r in rows} <= {"UG", "GR"}
    assert all(0.0 <= r.auc <= 1.0 and r.n >= 10 for r in rows)


def test_unseen_category_scores(spark, report):
    from loanlens.operators.model import score

    row = _clean(spark, SMALL).limit(1).withColumn("program", F.lit("never seen before"))
    assert score(report.fitted, row).select("score").first().score is not None


def test_fold_statistics_match_direct(spark):
    from loanlens.operators.model import ALL_ROWS, exact_medians, fold_statistics

    folded = stratified_folds(_clean(spark, SMALL).select("student_id", "default_flag", "gpa",
                                                          "num_loans"),
                              "student_id", "default_flag", 5, 42)
    medians, counts = fold_statistics(folded, ["gpa", "num_loans"], 5)
    for k in (0, 3):
        train = folded.where(F.col("fold") != k)
        assert medians[k] == pytest.approx(exact_medians(train, ["gpa", "num_loans"]))
        assert counts[k] == (train.count(), train.where(F.col("default_flag") == 1).count())
    assert medians[ALL_ROWS] == pytest.approx(exact_medians(folded, ["gpa", "num_loans"]))


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    from loanlens.operators.eda import quantiles

    rng = random.Random(3)
    vals = {"a": [float(rng.randint(0, 50)) for _ in range(997)],
            "b": [rng.random() for _ in range(10)] + [5.0] * 400}
    rows = [(v_a, v_b) for v_a, v_b in itertools.zip_longest(vals["a"], vals["b"])]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {(r.feature, r.p): r.q for r in quantiles(df, ["a", "b"], (0.1, 0.25, 0.5, 0.75, 0.99)).collect()}
    for f, xs in vals.items():
        for p in (0.1, 0.25, 0.5, 0.75, 0.99):
            assert got[(f, p)] == pytest.approx(float(np.quantile(xs, p)), abs=1e-12), (f, p)


def test_folds_split_a_hot_id(spark):
    # one id holding most rows (with varying content) still deals evenly
    rows = [("HOT", f"p{i % 97}", i % 3 == 0) for i in range(3000)] + \
           [(f"S{i}", "x", i % 2 == 0) for i in range(300)]
    df = spark.createDataFrame([(a, b, int(c)) for a, b, c in rows], "sid string, prog string, y int")
    folded = stratified_folds(df, "sid", "y", 5, 42, hex_digits=2, tie_cols=["sid", "prog"])
    for r in folded.groupBy("y").agg(F.collect_list("fold").alias("f")).collect():
        sizes = [r.f.count(i) for i in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_folds_split_exact_copies_and_null_ids(spark, monkeypatch):
    from loanlens.operators import folds

    monkeypatch.setattr(folds, "_COPIES", 300)   # copies are written out in several steps
    rows = [("HOT", "same", 1 if i % 4 == 0 else 0) for i in range(2000)] + \
           [(None, f"n{i % 700}", 0) for i in range(1500)] + [(f"S{i}", "x", i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "sid string, prog string, y int")
    dealt = {}
    for parts in (1, 7):   # the same folds whatever the layout
        folded = stratified_folds(df.repartition(parts), "sid", "y", 5, 42, hex_digits=1, tie_cols=["prog"])
        dealt[parts] = sorted(map(str, folded.collect()))
        assert folded.count() == len(rows)
    assert dealt[1] == dealt[7]
    per = folded.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in per if r.y == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    # rows without an id spread over the hash ranges
    h = folds.dealing_hash("sid", 42, ["prog"])
    assert df.where("sid is null").select(F.substring(h, 1, 1).alias("r")).distinct().count() == 16


def test_category_index_is_the_model_vocabulary(spark, report):
    from loanlens.operators.model import ALL_ROWS, CAT_FEATURES, category_index
    from loanlens.plans.queries import _folded

    rows = category_index(_folded(spark, SMALL), list(CAT_FEATURES), 5).where(F.col("train_set") == ALL_ROWS).collect()
    assert {(r.feature, r.value, r.idx) for r in rows} == {tuple(r) for r in report.fitted.categories.collect()}
    named = {r.feature for r in report.importance.where(F.col("root").isin(*CAT_FEATURES)).collect()}
    assert named == {f"{r.feature}_{r.value}" for r in rows}


def test_ranges_of_any_number_give_the_same_running_count(spark):
    from loanlens.operators.ranking import ordinals, running_count

    rows = [(g, v, (v * 7) % 5 + 1) for g in ("a", "b") for v in range(300)]
    df = spark.createDataFrame(rows, "g string, v int, w int")
    expected = {(g, v): sum(w for h, u, w in rows if h == g and u < v) for g, v, _ in rows}
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 3, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            got = {(r.g, r.v): r._before for r in running_count(df, ["g"], "v", "w").collect()}
            assert got == expected
            assert {(r.g, r.v, r.idx) for r in ordinals(df.select("g", "v"), ["g"], "v", "idx").collect()} == {
                (g, v, v) for g, v, _ in rows}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
