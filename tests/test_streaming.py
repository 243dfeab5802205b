import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.operators import series
from plumbline.session import ROCKSDB
from plumbline.streaming import alerts, jobs

T0 = dt.datetime(2024, 1, 1)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def land(df, path, n):
    """Append df as the n-th arrival of a stream folder."""
    df.coalesce(1).write.mode("append").parquet(f"{path}/{n}")


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)


def events(spark, seconds):
    rows = [(i, T0 + dt.timedelta(seconds=s), "a") for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "id int, ts timestamp, k string")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "check"))
    first = events(spark, [10, 50, 70, 3000])
    land(first, path, 1)
    counts = jobs.tumbling_counts(stream_of(spark, path, first.schema), ["k"], "1 minute", "10 minutes")
    jobs.run(counts, out, mark).awaitTermination()
    land(events(spark, [20, 2900, 6000]), path, 2)
    query = jobs.run(counts, out, mark)
    query.awaitTermination()
    assert jobs.dropped_late(query) == 1
    got = {r.start: r.rows for r in spark.read.parquet(out).collect()}
    minute = lambda m: T0 + dt.timedelta(minutes=m)
    assert got == {minute(0): 2, minute(1): 1, minute(48): 1, minute(50): 1}


def test_alert_state_survives_restarts_and_equals_batch(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "check"))
    base, held = 1704067200, {0, 1, 2, 3, 4, 5, 6, 9, 10, 13, 14, 15, 16, 17, 18, 19}
    df = spark.createDataFrame([("r", base + 60 * i, i in held) for i in range(24)], "key string, t long, breach boolean")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        for n, (a, b) in enumerate([(0, 3), (3, 11), (11, 24)]):
            land(df.where((F.col("t") >= base + 60 * a) & (F.col("t") < base + 60 * b)), path, n)
            jobs.run(alerts.alert_stream(stream_of(spark, path, df.schema), 60, 300), out, mark).awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    got = sorted((r.at - base, r.state) for r in spark.read.parquet(out).collect())
    batch = series.alert_states(df.where("breach").select("key", "t"), ["key"], 60, 300, until=base + 60 * 23).collect()
    assert got == sorted((r.at - base, r.state) for r in batch)
    assert (300, "firing") in got and (420, "resolved") in got


def test_upsert_keeps_the_newest_and_replays_replace(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "k string, ts timestamp, v int"
    one = spark.createDataFrame([("a", T0, 1), ("b", T0, 2)], schema)
    two = spark.createDataFrame([("a", T0 + dt.timedelta(1), 3), ("b", T0 - dt.timedelta(1), 9)], schema)
    for n, df in enumerate((one, two)):
        land(df, path, n)
        newest = jobs.latest_values(stream_of(spark, path, df.schema), ["k"], ["v"])
        jobs.run_batches(newest, jobs.upsert_to(out, ["k"], ["v"]), mark, "update").awaitTermination()
    jobs.upsert_to(out, ["k"], ["v"])(two, 1)
    assert {r.k: r.v for r in jobs.read_upserted(spark, out).collect()} == {"a": 3, "b": 2}
    jobs.upsert_to(out, ["k"], ["v"])(spark.createDataFrame([("b", T0 + dt.timedelta(2), 7)], schema), 2)
    assert sorted((r.k, r.v) for r in jobs.read_upserted(spark, out).collect()) == [("a", 3), ("b", 7)]


def test_upsert_stays_bounded_and_outlives_its_checkpoint(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k int, ts timestamp, v int"
    write = jobs.upsert_to(out, ["k"], ["v"], buckets=4, source="q")
    for batch in range(50):
        rows = [(k, T0 + dt.timedelta(batch), 100 * batch + k) for k in range(batch % 8 + 1)]
        write(spark.createDataFrame(rows, schema), batch)
    write(spark.createDataFrame([(0, T0 + dt.timedelta(99), -1)], schema), 49)  # merged before, so not again
    found = {r.k: r.v for r in jobs.read_upserted(spark, out).collect()}
    newest = {k: max(b for b in range(50) if b % 8 >= k) for k in range(8)}
    assert found == {k: 100 * b + k for k, b in newest.items()}
    folders = list((tmp_path / "out" / "data").glob("bucket=*/version=*"))
    assert len(folders) <= 2 * 4 and len(list((tmp_path / "out" / "_manifests").glob("*.json"))) == 2
    later = spark.createDataFrame([(0, T0 + dt.timedelta(100), 7), (9, T0, 9)], schema)
    for n in range(2):  # two streams with checkpoints of their own, whose batches count from 0
        land(later.where(f"k = {9 * n}"), f"{path}{n}", 0)
        newest = jobs.latest_values(stream_of(spark, f"{path}{n}", later.schema), ["k"], ["v"])
        jobs.run_batches(newest, jobs.upsert_to(out, ["k"], ["v"], buckets=4), str(tmp_path / f"check{n}"), "update").awaitTermination()
    found = {r.k: r.v for r in jobs.read_upserted(spark, out).collect()}
    assert found[0] == 7 and found[9] == 9 and len(found) == 9
    applied = jobs.Manifest(spark, out).read()["applied"]
    assert len(applied) == 3 and applied["q"] == 49 and sorted(applied.values()) == [0, 0, 49]


def test_null_gate_sends_a_batch_to_the_error_sink(spark, tmp_path):
    from plumbline.operators import model

    train = spark.createDataFrame([(float(i), int(i > 10)) for i in range(20)], "x double, y int")
    fitted = model.fit_logistic(train, ["x"], "y")
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    write = jobs.score_batches(fitted, ["x"], 0.5, out, bad)
    write(spark.createDataFrame([(1, 3.0), (2, 15.0)], "row_id long, x double"), 0)
    write(spark.createDataFrame([(3, None), (4, None), (5, 1.0)], "row_id long, x double"), 1)
    assert spark.read.parquet(out).count() == 2
    assert {r.high_null_columns for r in spark.read.parquet(bad).collect()} == {"x"}
    with pytest.raises(ValueError, match="missing columns"):
        write(spark.createDataFrame([(1,)], "row_id long"), 2)


def test_batch_scores_equal_stream_scores(spark, tmp_path):
    from plumbline.operators import model

    train = spark.createDataFrame([(i, float(i % 13), int(i % 13 > 6)) for i in range(200)], "row_id long, x double, y int")
    fitted = model.fit_logistic(train, ["x"], "y")
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = train.select("row_id", "x")
    land(rows, path, 0)
    write = jobs.score_batches(fitted, ["x"], 0.5, out, str(tmp_path / "bad"))
    jobs.run_batches(stream_of(spark, path, rows.schema), write, str(tmp_path / "check")).awaitTermination()
    batch = model.score(rows, fitted, ["x"], 0.5)
    assert spark.read.parquet(out).drop("batch").exceptAll(batch).isEmpty() and batch.count() == 200
