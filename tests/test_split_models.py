import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import logistic, metrics, model, prep, split


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows carry the positive label."""
    return spark.range(4000).selectExpr("id", "cast(id % 3 = 0 as int) y", "cast(id % 17 as double) x").cache()


def test_split_is_exact_disjoint_and_stable(rows):
    df = split.stratified_split(rows, "y", ["id"]).cache()
    assert df.count() == 4000 and df.select("id").distinct().count() == 4000
    sizes = {(r.y, r.split): r.n for r in df.groupBy("y", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    for y, n in ((1, 1334), (0, 2666)):
        held = math.floor(n * 0.3 + 0.5)
        tested = math.floor(held * 0.5 + 0.5)
        assert (sizes[y, "train"], sizes[y, "val"], sizes[y, "test"]) == (n - held, held - tested, tested)
    again = split.stratified_split(rows.repartition(7), "y", ["id"])
    assert df.select("id", "split").exceptAll(again.select("id", "split")).isEmpty()
    other = split.stratified_split(rows, "y", ["id"], seed=1)
    assert not df.select("id", "split").exceptAll(other.select("id", "split")).isEmpty()


def test_split_keeps_rows_without_label(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1) for i in range(40)], "id int, y int")
    got = split.stratified_split(df, "y", ["id"]).groupBy("y", "split").count().collect()
    assert sum(r["count"] for r in got) == 40
    assert {r["count"] for r in got if r.split == "train"} == {14}


def test_tiny_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id int, y int")
    got = split.stratified_split(df, "y", ["id"])
    assert got.count() == 3 and got.where("y = 0").first().split == "train"


def test_wide_rows_are_not_shuffled(rows):
    node, names = split.stratified_split(rows, "y", ["id"])._jdf.queryExecution().optimizedPlan(), []
    while node.children().size():
        names.append(node.nodeName())
        assert node.children().size() == 1
        node = node.children().head()
    assert not {"Join", "Aggregate", "Window", "Sort", "RepartitionByExpression"} & set(names)


def test_sample_paths_agree(rows, monkeypatch):
    small = {r.id for r in split.sample_n(rows, 1500, ["id"]).collect()}
    assert len(small) == 1500
    n = F.col("__n")
    cut = split._with_cuts(rows, F.lit(0), ["id"], split.hash_order(["id"], 42), {"__end": F.least(n, F.lit(1500))})
    assert {r.id for r in cut.where(F.col("__row") <= F.col("__end")).collect()} == small
    assert split.sample_n(rows, 10_000, ["id"]).count() == 4000
    assert split.sample_n(rows, 25_000, ["id"]).count() == 4000


def test_folds(rows):
    got = split.stratified_folds(rows, "y", ["id"], 7).groupBy("fold", "y").count().collect()
    for y, n in ((1, 1334), (0, 2666)):
        assert sorted(r["count"] for r in got if r.y == y) == sorted(n // 7 + (i < n % 7) for i in range(7))


def test_expanding_folds_never_train_on_the_future(spark):
    df = spark.range(100).withColumnRenamed("id", "t")
    folds = split.time_folds(df, "t", [25, 50, 75])
    for train, val in split.expanding_folds(folds, 3):
        assert train.agg(F.max("t")).first()[0] < val.agg(F.min("t")).first()[0]


def test_fit_uses_train_only_and_population_deviation(spark):
    train = spark.createDataFrame([(1.0, 5.0, "a"), (None, 5.0, "b"), (4.0, 5.0, "zz"), (7.0, 5.0, None)], "x double, k double, c string")
    fitted = prep.fit(train, ["x", "k"], {"c": ["a", "b"]})
    assert fitted.median["x"] == 4.0 and fitted.scale["k"] == 1.0
    assert fitted.scale["x"] == pytest.approx(np.std([1, 4, 4, 7]))
    out = fitted.transform(train).collect()
    assert [r.c for r in out] == [0.0, 1.0, -1.0, -1.0] and [r.k for r in out] == [0.0] * 4
    assert out[1].x == pytest.approx(0.0)
    assert prep.Scaler.from_json(fitted.to_json()) == fitted


def test_min_max_zero_range(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0), (None, 3.0)], "a double, b double")
    assert [tuple(r) for r in prep.min_max(df, df, ["a", "b"]).collect()] == [(0.0, 0.0), (0.0, 0.5), (None, 1.0)]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 2))
    y = (rng.random(600) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.7 * x[:, 1] - 1)))).astype(int)
    rows = [(i, float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "row_id bigint, a double, b double, y int").cache()


def test_logistic_equals_newton(labelled):
    x, y, df = labelled
    fitted = model.fit_logistic(df, ["a", "b"], "y", c=1.0)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    design, beta = np.c_[x, np.ones(len(y))], np.zeros(3)
    penalty = np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (w * (p - y)) + penalty @ beta
        beta -= np.linalg.solve(design.T @ (design * (w * p * (1 - p))[:, None]) + penalty, gradient)
    assert np.allclose([*fitted.coefficients, fitted.intercept], beta, atol=1e-3)


def test_scores_and_attribution(labelled):
    x, y, df = labelled
    fitted = model.fit_logistic(df, ["a", "b"], "y")
    p = 1 / (1 + np.exp(-(x @ np.array(fitted.coefficients) + fitted.intercept)))
    scored = {r.row_id: r for r in model.score(df, fitted, ["a", "b"], 0.4).collect()}
    assert all(abs(scored[i].probability - round(p[i], 6)) <= 1e-6 and scored[i].prediction == int(p[i] >= 0.4) for i in range(600))
    got = {r.feature: r.importance for r in model.linear_attribution(df, fitted, ["a", "b"], df.where("row_id < 100")).collect()}
    want = np.abs(np.array(fitted.coefficients) * (x - x[:100].mean(axis=0))).mean(axis=0)
    assert got["a"] == pytest.approx(want[0], abs=1e-5) and got["b"] == pytest.approx(want[1], abs=1e-5)
    losses = {r.feature: r.importance for r in model.permutation_importance(df, fitted, ["a", "b"], "y", "row_id").collect()}
    assert losses["a"] > losses["b"] > 0


def test_trees_learn_and_stop_early(labelled):
    _, _, df = labelled
    curved = df.withColumn("y", (F.abs("a") > 0.8).cast("int"))
    linear = model.evaluate(curved, model.fit_logistic(curved, ["a", "b"], "y"), ["a", "b"], "y").first().auc
    fitted = model.fit_boosted(curved, ["a", "b"], "y", curved, rounds=8, depth=3, rate=0.3)
    assert model.evaluate(curved, fitted, ["a", "b"], "y").first().auc > max(linear, 0.95)
    noise = df.withColumn("y", (F.xxhash64("row_id") % 2 == 0).cast("int"))
    held = df.withColumn("y", (F.xxhash64("row_id", F.lit(7)) % 2 == 0).cast("int"))
    stopped = model.fit_boosted(noise, ["a", "b"], "y", held, 1.0, rounds=30, depth=4, rate=0.5)
    assert stopped.getNumTrees < 30
    params = {"rounds": 30, "depth": 4, "rate": 0.5, "positive_weight": 1.0}
    assert model.refit(noise, held, "boosted_trees", ["a", "b"], "y", params)[0].getNumTrees == stopped.getNumTrees


def test_search_is_seeded_and_folds_are_averaged(labelled):
    _, _, df = labelled
    first, best = model.search(df, df, "logistic_regression", ["a", "b"], "y", trials=3, seed=9)
    second, again = model.search(df, df, "logistic_regression", ["a", "b"], "y", trials=3, seed=9)
    assert best == again and [r.val_auc for r in first.collect()] == [r.val_auc for r in second.collect()]
    row = model.cross_validate(df, "logistic_regression", ["a", "b"], "y", ["row_id"], k=3).first()
    assert 0.7 < row.cv_auc_mean < 1 and 0 <= row.cv_auc_std < 0.2


def test_segments(spark):
    df = spark.createDataFrame([(i, float(i % 2) * 100 + i * 0.01) for i in range(50)], "id int, x double")
    got = model.segment(df, ["x"], 2, ["id"]).collect()
    assert len({r.segment for r in got if r.id % 2}) == 1 and len({r.segment for r in got}) == 2


def test_nan_is_missing_in_fit_and_transform(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0,), (2.0,), (nan,), (None,), (3.0,)], "x double")
    fitted = prep.fit(df, ["x"])
    got = [r.x for r in fitted.transform(df).collect()]
    assert got[2] == got[3] == got[1] == 0.0 and got[0] == -got[4]
    other = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")  # NaN in the scored rows only
    assert [r.x for r in prep.fit(other, ["x"]).transform(df).collect()][2] == 0.0
    for train in (df, other):
        assert [r.x for r in prep.min_max(df, train, ["x"]).collect()] == [0.0, 0.5, None, None, 1.0]
        bounds = prep.winsor_bounds(train, ["x"], 0.0, 1.0)
        assert bounds == {"x": (1.0, 3.0)}
        assert [r.x for r in prep.winsorize(df, {"x": (1.5, 2.5)}).collect()] == [1.5, 2.0, None, None, 2.5]
    empty = spark.createDataFrame([(nan,), (None,)], "x double")
    assert [r.x for r in prep.min_max(df, empty, ["x"]).collect()] == [0.0, 0.0, None, None, 0.0]


def test_report_names_the_threshold_that_scores(spark, labelled, tmp_path):
    from pyspark.sql import types as T

    from plumbline.operators import metrics
    from plumbline.sources import files

    df, features, label = labelled[2], ["a", "b"], "y"
    fitted = model.fit_logistic(df, features, label)
    report = model.evaluation_report(df, fitted, features, label, "lr")
    files.write_report(report, str(tmp_path / "report"))
    read = files.read_report(spark, str(tmp_path / "report"), T.StructType.fromDDL(model.REPORT)).first()
    assert read == report.first() and read.feature_columns == features
    scored = model.probabilities(df, fitted, features, [label])
    sweep = metrics.threshold_sweep(scored, label, "probability").collect()
    assert read.optimal_threshold == min(sweep, key=lambda r: (r.cost, r.threshold)).threshold != 0.5
    assert read.passes_threshold == (read.test_auc >= read.auc_threshold)


def test_trials_fitted_side_by_side_end_where_single_fits_end(spark):
    rnd = random.Random(11)
    rows = [(round(rnd.gauss(0, 1), 1), round(rnd.gauss(0, 2), 1)) for _ in range(600)]
    df = spark.createDataFrame([(a, b, int(a - b / 2 + rnd.gauss(0, 1) > 1)) for a, b in rows], "a double, b double, y int")
    weights, _ = model.class_weights(df, "y")
    cs = [1e-4, 0.01, 1.0, 10.0]
    counted = df.groupBy("a", "b", "y").count()
    found = logistic.fit_all(counted, ["a", "b"], "y", [logistic.Fit(c, weights) for c in cs], times="count")
    for c, got in zip(cs, found):
        one = model.fit_logistic(df, ["a", "b"], "y", c)
        assert got.tolist() == pytest.approx([*one.coefficients, one.intercept], abs=1e-4)
    trials, best = model.search(df, df, "logistic_regression", ["a", "b"], "y", trials=3)
    for r in trials.collect():
        one = model.evaluate(df, model.fit_logistic(df, ["a", "b"], "y", r.params["c"]), ["a", "b"], "y").first()
        assert (r.val_auc, r.val_ks) == pytest.approx((one.auc, one.ks), abs=2e-4)
        assert not r.best or best == r.params


def test_the_number_of_passes_of_a_search_does_not_follow_its_trials(spark):
    df = spark.createDataFrame([(float(i % 13), float(i % 7), int(i % 5 == 0)) for i in range(400)], "a double, b double, y int")
    passes = []
    plain = logistic.sums
    try:
        logistic.sums = lambda *a: passes.append(len(a[3])) or plain(*a)
        model.search(df, df, "logistic_regression", ["a", "b"], "y", trials=12)
    finally:
        logistic.sums = plain
    assert passes[0] == 12 and len(passes) < 12
    holes = spark.createDataFrame([(1.0, None, 0), (2.0, 1.0, 1)], "a double, b double, y int")
    with pytest.raises(Exception, match="is missing"):
        model.search(holes, holes, "logistic_regression", ["a", "b"], "y", trials=2)


def test_the_rows_of_permutation_importance_are_placed_once(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i % 13), float(i % 7), int(i % 5 == 0)) for i in range(300)], "row_id long, a double, b double, y int")
    places = []
    monkeypatch.setattr(model, "shared_dir", lambda s, name, plain=model.shared_dir: places.append(name) or plain(s, name))
    out = model.permutation_importance(df, model.fit_logistic(df, ["a", "b"], "y"), ["a", "b"], "y", "row_id")
    assert places == ["placed"] and "Subquery" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.feature for r in out.collect()} == {"a", "b"}


def test_fits_share_their_passes_until_the_first_ends(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(500)]
    df = spark.createDataFrame([(a, b, int(2 * a - b + rnd.gauss(0, 1) > 0)) for a, b in rows], "a double, b double, y int").coalesce(2)
    points, plain = [], logistic.sums
    monkeypatch.setattr(logistic, "sums", lambda *a: points.append(len(np.unique(a[2], axis=0))) or plain(*a))
    weights, _ = model.class_weights(df, "y")
    logistic.fit_all(df, ["a", "b"], "y", [logistic.Fit(c, weights) for c in (0.1, 1.0, 10.0)])
    assert points[:5] == [1] * 5 and points[-1] <= 2


def test_trials_are_scored_by_arrays_that_are_cut_alike_in_all_tasks(spark, monkeypatch):
    """Quality as by single evaluation, with ties within and across tasks; no shuffled row per score and trial."""
    rnd = random.Random(3)
    rows = [(round(rnd.gauss(0, 1), 1), rnd.choice([0.0, 0.0, 0.5])) for _ in range(1500)]
    values = [(a, b, None if i % 50 == 0 else int(a + b + rnd.gauss(0, 1) > 1)) for i, (a, b) in enumerate(rows)] + [(0.1, 0.0, 1)] * 400
    df = spark.createDataFrame(values, "a double, b double, y int").repartition(3)
    fitted = np.array([[1.0, 2.0, -0.5], [-0.3, 0.1, 0.0], [800.0, 0.0, 0.0], [0.0, 0.0, 0.2]])
    monkeypatch.setattr(logistic, "SKETCH", 64)
    for size in (300, 10**6):
        monkeypatch.setattr(logistic, "RANGE_ROWS", size)
        got = {r.fit: (r.auc, r.ks) for r in logistic.quality(df, ["a", "b"], "y", fitted).collect()}
        assert len(got) == len(fitted)
        for i, (a, b, c) in enumerate(fitted.tolist()):
            scored = df.select("y", (1 / (1 + F.exp(-(F.lit(c) + F.lit(a) * F.col("a") + F.lit(b) * F.col("b"))))).alias("p"))
            one = metrics.metric_bundle(scored, "y", "p").first()
            assert got[i] == (one.auc, one.ks)
    monkeypatch.setattr(logistic, "RANGE_ROWS", 300)
    made, plain = [], type(df).groupBy
    monkeypatch.setattr(type(df), "groupBy", lambda self, *by: made.append((by, self)) or plain(self, *by))
    logistic.quality(df, ["a", "b"], "y", fitted)
    (cuts,) = [d for by, d in made if by == ("fit", "range")]
    assert cuts.count() < 3 * 2 * 7 * len(fitted) + 1  # tasks, classes and ranges, not scores
    assert logistic.quality(df.where("y = 1"), ["a", "b"], "y", fitted).first().auc is None


def test_cuts_are_found_without_a_shuffle_of_the_keys(spark):
    df = spark.range(300).selectExpr("id", "cast(id % 3 = 0 as int) y")
    plan = split._cuts(df, F.struct("y"), ["id"], split.hash_order(["id"], 1), {"__end": F.col("__n") - 7})
    assert "ResolvedHint (strategy=broadcast)" in plan._jdf.queryExecution().analyzed().toString()
