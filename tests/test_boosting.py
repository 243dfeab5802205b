"""Prefixes of one boosted model against models of fewer rounds."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import boosting, model, trees

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    out = []
    for i in range(600):
        a, b, c = rnd.gauss(0, 1), rnd.gauss(0, 1), float(rnd.randint(0, 3))
        out.append((i, a, b, c, int(rnd.random() < 1 / (1 + math.exp(-(2 * a - b * c + 0.5))))))
    df = spark.createDataFrame(out, "row_id long, a double, b double, c double, y int").persist()
    return df.where("row_id < 400"), df.where("row_id >= 400")


def test_prefixes_equal_refits(rows):
    train, val = rows
    fit = lambda n: model.fit_boosted(train, FEATURES, "y", rounds=n, depth=3, rate=0.3)
    whole = boosting.staged(fit(12), FEATURES)
    quality = {r.rounds: r for r in boosting.prefix_quality(val, whole, "y", [1, 5, 12]).collect()}
    losses = {r.rounds: r.loss for r in boosting.prefix_losses(val, whole, "y", 2.0).collect()}
    assert sorted(losses) == list(range(1, 13))
    for n in (1, 5, 12):
        refit = fit(n)
        want = model.evaluate(val, refit, FEATURES, "y").first()
        assert (quality[n].auc, quality[n].ks, quality[n].pr_auc) == (want.auc, want.ks, want.pr_auc)
        scored = model.probabilities(val, refit, FEATURES, ["row_id", "y"]).orderBy("row_id").collect()
        ours = model.probabilities(val, whole.cut(n), FEATURES, ["row_id", "y"]).orderBy("row_id").collect()
        assert np.allclose([r.probability for r in scored], [r.probability for r in ours])
        weights = [2.0 if r.y else 1.0 for r in scored]
        loss = sum(-w * math.log(r.probability if r.y else 1 - r.probability) for w, r in zip(weights, scored)) / sum(weights)
        assert abs(loss - losses[n]) < 1e-9


def test_patience():
    assert boosting.stopping_round([5, 4, 3, 3.5, 3.4, 2], patience=3) == 6
    assert boosting.stopping_round([5, 4, 3, 3.5, 3.4, 3.3, 2], patience=3) == 3
    assert boosting.stopping_round([1, 2, 3], patience=20) == 1 and boosting.stopping_round([3, 2, 1], patience=1) == 3
    assert boosting.rungs(50, 10, 300) == [(50, 10), (17, 30), (6, 90), (2, 270), (1, 300)]
    assert boosting.rungs(6, 10, 200) == [(6, 10), (2, 30), (1, 200)] and boosting.rungs(1, 10, 50) == [(1, 50)]


def test_stopped_model_is_the_prefix_of_least_loss(rows):
    train, val = rows
    fitted = model.fit_staged(train, FEATURES, "y", val, patience=4, positive_weight=1.0, rounds=30, depth=4, rate=0.5)
    whole = boosting.staged(model.fit_boosted(train, FEATURES, "y", positive_weight=1.0, rounds=30, depth=4, rate=0.5), FEATURES)
    losses = [r.loss for r in boosting.prefix_losses(val, whole, "y").orderBy("rounds").collect()]
    assert fitted.rounds == boosting.stopping_round(losses, 4) < 30
    nothing = val.where("false")
    assert boosting.stop_early(whole, nothing, "y").rounds == 30


@pytest.mark.parametrize("kind", ["boosted_trees", "random_forest"])
def test_search_by_rungs(rows, kind):
    train, val = rows
    space = {model.EFFORT[kind]: ("int", 8, 12), "depth": ("int", 2, 3)}
    trials, best, fitted = model.search_trees(train, val, kind, FEATURES, "y", trials=5, least=2, factor=3, space=space)
    found = trials.orderBy("rung", "trial").collect()
    assert [r.rung for r in found] == [1] * 5 + [2] * 2 + [3]
    first = sorted((r for r in found if r.rung == 1), key=lambda r: (-r.val_auc, r.trial))
    assert {r.trial for r in found if r.rung == 2} == {r.trial for r in first[:2]}
    last = found[-1]
    assert last.best and sum(r.best for r in found) == 1 and best["depth"] == last.params["depth"]
    assert model.evaluate(val, fitted, FEATURES, "y").first().auc == last.val_auc
    again = model.search_trees(train, val, kind, FEATURES, "y", trials=5, least=2, factor=3, space=space)[0]
    assert again.orderBy("rung", "trial").collect() == found


def in_cells(rows, features=FEATURES, weight=1.0):
    train, val = rows
    both = train.withColumn("part", F.lit("train")).unionByName(val.withColumn("part", F.lit("val")))
    return trees.cells(both, features, "y", "part", ["train", "val"], weight)


@pytest.fixture(scope="module")
def few_values(spark):
    """Features of few values, so that cells hold many rows and nothing is left to sketches."""
    rnd = random.Random(7)
    out = []
    for i in range(4000):
        a, b, c = float(rnd.randint(-4, 5)), rnd.randint(0, 6) / 2, float(rnd.randint(0, 3))
        out.append((i, a, b, c, int(rnd.random() < 1 / (1 + math.exp(-(a * (b - 1) - c + 0.3))))))
    df = spark.createDataFrame(out, "row_id long, a double, b double, c double, y int").persist()
    return df.where("row_id < 3000"), df.where("row_id >= 3000")


def test_side_by_side_boosting_is_that_of_spark_ml(few_values):
    """Without draws the trees of counted cells score every row as those of Spark ML do."""
    train, val = few_values
    want = model.fit_boosted(train, FEATURES, "y", positive_weight=3.0, rounds=12, depth=4, rate=0.3, subsample=1.0, feature_share=1.0, min_rows=20)
    data = in_cells(few_values, weight=3.0)
    assert data.frame.count() < 300 and data.frame.selectExpr("sum(neg_train + pos_train + neg_val + pos_val)").first()[0] == 4000
    fit = trees.Fit("boosted_trees", 12, 4, 1.0, 20, rate=0.3, feature_share=1.0)
    ours, deeper = trees.boosted(data, [fit, trees.Fit("boosted_trees", 5, 6, 0.7)], patience=None)
    assert len(deeper.trees) == 5 and len(ours.losses) == 12
    a = [r.probability for r in model.probabilities(val, want, FEATURES, ["row_id"]).orderBy("row_id").collect()]
    b = [r.probability for r in model.probabilities(val, ours.model(data), FEATURES, ["row_id"]).orderBy("row_id").collect()]
    assert np.allclose(a, b)
    losses = [r.loss for r in boosting.prefix_losses(val, boosting.staged(want, FEATURES), "y", 3.0).orderBy("rounds").collect()]
    assert np.allclose(losses, ours.losses)
    bundle = model.evaluate(val, want, FEATURES, "y").first()
    assert trees.quality(data, {0: ours}, ["val"]).select(*bundle.asDict()).first() == bundle


def test_cells_grow_with_bins_not_rows(spark, few_values):
    """Six times the rows are as many cells: passes over them cost the same."""
    train, val = few_values
    six = spark.range(6).crossJoin(train).drop("id")
    once, more = in_cells((train, val)), in_cells((six, val))
    assert once.frame.count() == more.frame.count() and once.cuts == more.cuts
    assert more.frame.selectExpr("sum(neg_train + pos_train)").first()[0] == 6 * 3000


def test_forest_like_that_of_spark_ml(few_values):
    train, val = few_values
    data = in_cells(few_values, weight=2.0)
    (ours,) = trees.forests(data, [trees.Fit("random_forest", 60, 5)])
    want = model.evaluate(val, model.fit_forest(train, FEATURES, "y", 2.0, 60, 5), FEATURES, "y").first()
    got = model.evaluate(val, ours.model(data), FEATURES, "y").first()
    assert abs(got.auc - want.auc) < 0.02 and abs(got.pr_auc - want.pr_auc) < 0.03
    assert trees.quality(data, {0: ours}, ["val"]).first().auc == got.auc
    (few,) = trees.forests(data, [trees.Fit("random_forest", 20, 5)])
    (on,) = trees.forests(data, [trees.Fit("random_forest", 60, 5)], [few])
    same = lambda x, y: x.feature.tolist() == y.feature.tolist() and x.value.tolist() == y.value.tolist()
    assert len(on.trees) == 60 and all(map(same, on.trees, ours.trees))


def test_draws_per_cell_count_rows():
    counts = np.array([[0, 1, 1000, 50_000], [3, 0, 20, 100_000]])
    fit = trees.Fit("boosted_trees", 10, subsample=0.7, feature_share=0.8)
    drawn = np.array([fit.drawn(counts, t, 0) for t in range(200)])
    assert (drawn <= counts).all() and (drawn[0] == fit.drawn(counts, 0, 0)).all() and (drawn[0] != drawn[1]).any()
    assert np.allclose(drawn.mean(0), 0.7 * counts, rtol=0.01, atol=0.3)
    assert np.allclose(drawn[:, 1, 3].std(), math.sqrt(0.21 * 100_000), rtol=0.2)
    assert [len(fit.features_of(4, 0, n)) for n in (0, 1)] == [4, 4] and len(trees.Fit("random_forest", 1).features_of(4, 0, 0)) == 2


def test_cells_reject_missing_features_and_labels(spark, few_values):
    train, val = few_values
    with pytest.raises(ValueError, match="0 or 1"):
        in_cells((train.withColumn("y", F.when(F.col("row_id") != 5, F.col("y"))), val))
    with pytest.raises(Exception, match="a is missing"):
        in_cells((train.withColumn("a", F.when(F.col("row_id") != 5, F.col("a"))), val))
