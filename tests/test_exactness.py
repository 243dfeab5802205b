"""Cases the test tables are too kind to show: many classes, close scores, one class, large counts, NaN."""

import pytest
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.operators import drift, metrics, model, prep, split


def test_every_class_gets_a_weight(spark):
    df = spark.range(600).select((F.col("id") % 150).alias("y"))
    weights, n = model.class_weights(df, "y")
    assert n == 600 and len(weights) == 150 and set(weights.values()) == {1.0}


def test_scores_closer_than_six_places(spark):
    df = spark.range(2000).select((F.col("id") >= 1000).cast("int").alias("y"), (F.col("id") * 1e-10).alias("p"))
    curve = metrics.score_curve(metrics.score_histogram(df, "y", "p"))
    row = metrics.raw_metrics(curve).first()
    assert row["auc"] == 1.0 and row["ks"] == 1.0


def test_ks_threshold_of_one_class(spark):
    df = spark.createDataFrame([("a", 1, 0.2), ("a", 1, 0.4), ("b", 1, 0.3), ("b", 0, 0.1)], "g string, y int, p double")
    got = {r["g"]: r["gap"] for r in metrics.ks_threshold(metrics.score_curve(metrics.score_histogram(df, "y", "p", ["g"]), ["g"]), ["g"]).collect()}
    assert got == {"a": None, "b": 1.0}


def test_large_counts_do_not_overflow(spark):
    n = 4_000_000_000
    gaps = spark.createDataFrame([("x", 0.5, 0.4, n, n)], "feature string, f_ref double, f_cur double, n_ref long, n_cur long")
    assert drift.ks_test(gaps).first()["p_value"] == 0.0
    counts = [("x", c, n // 2, n // 2, n, n, 0.5, 0.5) for c in "ab"]
    schema = "feature string, value string, ref long, cur long, n_ref long, n_cur long, p_ref double, p_cur double"
    assert drift.category_drift(spark.createDataFrame(counts, schema)).first()["chi_square"] == 0.0


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, float("nan"), float("nan"), float("nan"), None)], "x double")
    fitted = prep.fit(df, ["x"])
    assert fitted.median["x"] == 2.0 and fitted.mean["x"] == 2.0
    assert prep.impute(df, {"x": 2.0}).where(F.isnan("x") | F.col("x").isNull()).count() == 0
    profile = prep.reference_profile(df, ["x"]).first()
    assert profile["null_rate"] == pytest.approx(4 / 7, abs=1e-6) and profile["mean"] == 2.0


def test_integers_keep_their_digits(spark):
    texts = ["9007199254740993", "3.7", "-2.9", " 12 ", "abc", "", None, "1e3"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(C.soft_cast("t", "bigint").alias("n")).collect()
    assert [r["n"] for r in got] == [9007199254740993, 3, -2, 12, None, None, None, 1000]


def test_one_path_for_small_and_large_samples(spark):
    df = spark.range(5000).withColumn("v", F.col("id") * 2)
    assert split.sample_n(df, 100, ["id"]).count() == 100 and split.sample_n(df, 9000, ["id"]).count() == 5000
    assert split.sample_n(df, 4000, ["id"]).join(split.sample_n(df, 100, ["id"]), "id").count() == 100


def test_quality_from_the_write_itself(spark, tmp_path):
    from pyspark.sql import Observation

    from plumbline.operators import quality
    from plumbline.streaming import jobs

    rows = [(i, None if i % 3 else float(i), float("nan") if i % 2 else 1.0, "x", None if i < 8 else 2) for i in range(10)]
    df = spark.newSession().createDataFrame(rows, "id int, a double, b double, c string, d int")
    expected = ["a", "b", "c", "d", "gone"]
    for columns in (expected, expected[:-1]):
        seen = Observation("q")
        quality.watched(df, columns, seen).write.mode("overwrite").parquet(f"{tmp_path}/out")
        record = quality.record_of(seen.get, columns)
        want = quality.quality_record(df, columns).first().asDict()
        assert record == want
        assert quality.gate_of(record) == quality.scoring_gate(df, columns).first().asDict()
    df.write.parquet(f"{tmp_path}/in")
    stream = quality.watched(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), expected, "q")
    query = jobs.run(stream, f"{tmp_path}/streamed", f"{tmp_path}/check")
    query.awaitTermination()
    sums = next(p.observedMetrics["q"].asDict() for p in query.recentProgress if p.observedMetrics and p.numInputRows)
    assert quality.record_of(sums, expected) == quality.quality_record(df, expected).first().asDict()
    empty = Observation("e")
    quality.watched(df.where("false"), expected, empty).write.mode("overwrite").parquet(f"{tmp_path}/out")
    assert quality.record_of(empty.get, expected) == quality.quality_record(df.where("false"), expected).first().asDict()
