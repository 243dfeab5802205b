"""Whole runs on small tables: kinds compared, what is stored, batches that fail, repeated dates."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.operators import split
from plumbline.plans import lifecycle

FEATURES = ["x", "z"]
SPACES = {
    "logistic_regression": {"c": ("log", 0.1, 10.0)},
    "random_forest": {"trees": ("int", 3, 5), "depth": ("int", 4, 5)},
}


@pytest.fixture(scope="module")
def rows(spark):
    """The label is an interval of x, which a tree can find and a line can't; z has gaps and a NaN."""
    df = spark.range(1500).selectExpr(
        "id AS row_id", "cast(pmod(hash(id), 1000) / 1000 AS double) x", "CASE WHEN id % 5 = 0 THEN NULL WHEN id = 7 THEN double('NaN') ELSE id % 11 END z"
    )
    df = df.withColumn("y", F.col("x").between(0.35, 0.65).cast("int"))
    return split.stratified_split(df, "y", ["row_id"]).cache()


@pytest.fixture(scope="module")
def run(spark, rows, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    return lifecycle.train(rows, root, FEATURES, "y", list(SPACES), trials=2, folds=2, spaces=SPACES)


def test_the_better_kind_wins_and_is_read_back(spark, run, rows):
    report = run.report(spark).first()
    assert report.champion_name == "random_forest" and report.feature_columns == FEATURES and report.test_auc > 0.9
    assert report.passes_threshold == (report.test_auc >= report.auc_threshold)
    trials = run.table(spark, "trials").collect()
    assert sorted((t.model, t.trial) for t in trials) == [(k, i) for k in sorted(SPACES) for i in (0, 1)]
    for kind in SPACES:
        own = [t for t in trials if t.model == kind]
        assert [t.val_auc for t in own if t.best] == [max(t.val_auc for t in own)]
    log = {(r.step, r.run_name, r.key) for r in run.table(spark, "log").collect()}
    assert {(s, k, n) for k in SPACES for s, n in (("baseline", "cv_auc_mean"), ("tuned", "val_auc"))} < log
    assert ("evaluate", "random_forest", "test_auc") in log and ("evaluate", "logistic_regression", "test_auc") not in log
    assert run.table(spark, "splits").count() == 1500
    assert run.champion(spark).getNumTrees in (3, 4, 5)


def test_a_batch_is_scored_and_a_repeat_replaces_it(spark, run, rows):
    batch = rows.where("split = 'test'").select("row_id", *FEATURES)
    first = lifecycle.monitor(batch, run, "2024-01-01").first()
    lifecycle.monitor(batch.limit(10), run, "2024-01-02")
    again = lifecycle.monitor(batch, run, "2024-01-01").first()
    scores = run.table(spark, "scores")
    assert {r["ingestion_date"]: r["count"] for r in scores.groupBy("ingestion_date").count().collect()} == {"2024-01-01": batch.count(), "2024-01-02": 10}
    assert scores.where("probability IS NULL").isEmpty()  # gaps and NaN are imputed as in training
    assert first.checks.score_distribution == again.checks.score_distribution
    bound = run.report(spark).first().optimal_threshold
    share = scores.where("ingestion_date = '2024-01-01'").select(F.avg((F.col("probability") >= bound).cast("double"))).first()[0]
    assert abs(again.checks.score_distribution.pct_predicted_default - share) < 1e-6
    line = json.loads(spark.read.text(run.at("events/ingestion_date=2024-01-01")).first().value)
    assert line["event"] == "batch_monitoring_complete" and line["batch_row_count"] == batch.count()


@pytest.mark.parametrize("broken", ["missing", "nulls", "empty"])
def test_a_batch_that_fails_or_is_empty(spark, run, rows, broken):
    batch = rows.where("split = 'test'").select("row_id", *FEATURES)
    batch = {"missing": batch.drop("z"), "nulls": batch.withColumn("z", F.lit(None).cast("double")), "empty": batch.limit(0)}[broken]
    got = lifecycle.monitor(batch, run, f"2025-01-{broken}").first()
    assert got.checks.data_quality.missing_columns == (["z"] if broken == "missing" else [])
    if broken == "empty":  # an empty batch passes the gate's null rates and has no scores
        assert got.checks.data_quality.row_count == 0
    else:
        assert got.checks.score_distribution is None and got.checks.feature_drift is None
    assert run.table(spark, "scores").where(F.col("ingestion_date") == f"2025-01-{broken}").isEmpty()


def test_no_training_rows_and_no_release_below_the_gate(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="training rows"):
        lifecycle.train(rows.where("split = 'val'"), str(tmp_path / "none"), FEATURES, "y", ["logistic_regression"])
    only = {"logistic_regression": {"c": ("log", 0.1, 0.2)}}
    weak = lifecycle.train(rows, str(tmp_path / "weak"), FEATURES, "y", list(only), trials=1, folds=2, spaces=only)
    assert not weak.report(spark).first().passes_threshold
    with pytest.raises(ValueError, match="below the gate"):
        lifecycle.monitor(rows.select("row_id", *FEATURES), weak, "2024-01-01", release=True)
