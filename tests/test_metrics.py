import random

import numpy as np
import pytest

from plumbline.operators import drift, metrics, profile, quality


def naive(y, p):
    """AUC by pairs, KS and average precision by thresholds."""
    y, p = np.array(y), np.array(p)
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    cuts = sorted(set(p), reverse=True)
    tpr = np.array([np.mean(pos >= c) for c in cuts])
    fpr = np.array([np.mean(neg >= c) for c in cuts])
    precision = np.array([y[p >= c].mean() for c in cuts])
    ap = np.sum(np.diff(np.concatenate([[0], tpr])) * precision)
    return auc, max(0.0, np.max(tpr - fpr)), ap


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.3)
        p = round(min(1.0, max(0.0, rng.gauss(0.4 + 0.15 * y, 0.2))), 2)
        rows.append(("a" if i % 2 else "b", y, p))
    rows += [("b", 0, 0.4)] * 200  # a third of the rows share one score
    return rows, spark.createDataFrame(rows, "m string, y int, p double").cache()


def test_against_pairs(scored):
    rows, df = scored
    got = {r.m: r for r in metrics.raw_metrics(metrics.score_curve(metrics.score_histogram(df, "y", "p", ["m"]), ["m"]), ["m"]).collect()}
    for m in "ab":
        auc, ks, ap = naive([r[1] for r in rows if r[0] == m], [r[2] for r in rows if r[0] == m])
        assert np.allclose([got[m].auc, got[m].ks, got[m].pr_auc, got[m].gini], [auc, ks, ap, 2 * auc - 1])


def test_mirrored_scores(scored):
    _, df = scored
    one = lambda d: metrics.raw_metrics(metrics.score_curve(metrics.score_histogram(d, "y", "p"))).first()
    mirrored = df.selectExpr("y", "round(1 - p, 6) p")
    assert abs(one(df).auc + one(mirrored).auc - 1) < 1e-12
    assert 0 <= one(df).ks <= 1


def test_one_class_gives_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, p double")
    row = metrics.raw_metrics(metrics.score_curve(metrics.score_histogram(df, "y", "p"))).first()
    assert row.auc is None and row.positives == 2 and row.negatives == 0


def test_thresholds(scored):
    rows, df = scored
    y, p = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    grid = np.linspace(0.01, 0.99, 200)
    assert np.allclose(metrics.grid(), grid, atol=0, rtol=1e-15)
    costs = [10 * np.sum((y == 1) & (p < t)) + np.sum((y == 0) & (p >= t)) for t in grid]
    sweep = metrics.threshold_sweep(df, "y", "p")
    best = metrics.cost_optimal(sweep).first()
    assert best.threshold == pytest.approx(grid[int(np.argmin(costs))]) and best.cost == min(costs)
    got = sweep.orderBy("threshold").collect()
    assert [r.cost for r in got] == costs
    assert metrics.f1_optimal(sweep).first().f1 == max(r.f1 for r in got)


def test_confusion_is_inclusive(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.4), (0, 0.1)], "y int, p double")
    assert tuple(metrics.confusion(df, "y", "p", 0.5).first()) == (1, 1, 1, 1)


def test_gate_uses_the_rounded_value(spark):
    df = spark.createDataFrame([(0.84996,), (0.8499,)], "test_auc double")
    assert [r.passes_threshold for r in metrics.promotion_gate(df).collect()] == [True, False]
    with pytest.raises(Exception, match="below the gate"):
        metrics.promotion_gate(df, fail=True).collect()


def test_champion_first_on_ties(spark):
    df = spark.createDataFrame([("x", 0.8, 2), ("y", 0.8, 1), ("z", 0.7, 0)], "model string, val_auc double, position int")
    assert metrics.champion(df).first().model == "y"


def test_equal_samples_do_not_drift(spark):
    df = spark.range(1000).selectExpr("cast(id % 97 as double) v", "cast(id % 5 as string) c")
    assert [r.psi for r in drift.feature_psi(df, df, ["v"], ["c"]).collect()] == [0.0, 0.0]
    gaps = drift.distribution_gaps(df, df, ["v"])
    assert drift.ks_test(gaps).first().statistic == 0.0 and drift.ks_test(gaps).first().p_value == 1.0
    assert drift.wasserstein(gaps, df, ["v"]).first().distance == 0.0


def test_sliced_ks_equals_plain(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 700).round(3), np.concatenate([rng.normal(0.3, 1, 500).round(3), np.full(400, 0.25)])
    ref = spark.createDataFrame([(float(v),) for v in a], "x double")
    cur = spark.createDataFrame([(float(v),) for v in b], "x double")
    values = np.sort(np.concatenate([a, b]))
    want = max(abs(np.mean(a <= v) - np.mean(b <= v)) for v in values)
    for rows in (50, 1_000_000):
        got = drift.ks_test(drift.distribution_gaps(ref, cur, ["x"], rows)).first()
        assert got.statistic == pytest.approx(want, abs=1e-6)
    area = drift.wasserstein(drift.distribution_gaps(ref, cur, ["x"], 50), ref, ["x"]).first()
    steps = np.unique(values)
    exact = sum(abs(np.mean(a <= u) - np.mean(b <= u)) * (v - u) for u, v in zip(steps, steps[1:]))
    assert area.distance == pytest.approx(exact, abs=1e-6)


def test_new_category_and_psi_floor(spark):
    ref = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "c string")
    cur = spark.createDataFrame([("a",)] * 50 + [("z",)] * 50, "c string")
    psi = drift.psi_categorical(ref, cur, ["c"]).first().psi
    assert psi == pytest.approx(2 * (0.5 - 1e-6) * np.log(0.5 / 1e-6), rel=1e-5)
    row = drift.category_drift(drift.category_counts(ref, cur, ["c"])).first()
    assert row.chi_square == pytest.approx(100.0) and row.degrees == 2


def test_drift_without_reference_or_columns(spark):
    df = spark.range(5).selectExpr("cast(id as double) x")
    assert drift.drift_record(None, df, ["x"], []).first().skipped
    empty = drift.summarize(drift.feature_psi(df, df, ["other"], [])).first()
    assert empty.per_feature_drift == {} and empty.drift_share == 0.0 and not empty.overall_drift_detected


def test_quality(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (float("nan"), None, "a"), (3.0, None, None)], "x double, n int, s string")
    row = quality.quality_record(df, ["x", "n", "s", "gone"]).first()
    assert row.null_rates == {"x": 0.333333, "n": 1.0, "s": 0.333333}
    assert row.missing_columns == ["gone"] and row.constant_columns == ["n", "s"]
    gate = quality.scoring_gate(df, ["x", "n"]).first()
    assert not gate.is_valid and gate.high_null_columns == ["n"]
    assert quality.scoring_gate(df, ["x", "gone"]).first().missing_columns == ["gone"]
    half = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert quality.scoring_gate(half, ["x"]).first().is_valid


def test_report_without_sections(spark):
    features = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    ctx = {"features": features, "expected": ["x"], "predictions": features, "reference": None}
    report = quality.build_report(quality.run_checks(ctx), "2024-01-01", 3.0)
    flat = quality.flat_metrics(report).first().metrics
    assert flat == {"batch_duration_seconds": 3.0, "batch_null_max": 0.0, "batch_null_mean": 0.0, "batch_row_count": 2.0}
    line = quality.event_line(report).first().line
    assert line.startswith('{"event":"batch_monitoring_complete","ingestion_date":"2024-01-01",') and line.endswith("}")


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(float(v), 0) for v in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10)] + [(None, 1)], "v double, y int")
    edges = [0.0, 2.0, 5.0, 10.0]
    from pyspark.sql import functions as F

    got = df.select("v", profile.quantile_bin(F.col("v"), edges).alias("b")).collect()
    assert [r.b for r in got] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2, 2, None]
