"""Streams by event time against the batch operators: disorder, restarts, silence, late rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import series
from plumbline.session import ROCKSDB
from plumbline.streaming import eventtime, jobs

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
BASE = 1704067200


@pytest.fixture(autouse=True)
def rocksdb(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    yield
    spark.conf.set(PROVIDER, before)


def arrivals(rows, at, delay, batches, seed):
    """Rows in `batches` arrivals, each out of order by less than the delay."""
    rnd = random.Random(seed)
    late = sorted(rows, key=lambda r: at(r) + rnd.uniform(0, delay * 0.9))
    size = -(-len(late) // batches)
    return [late[i : i + size] for i in range(0, len(late), size)]


def run_all(spark, tmp_path, parts, schema, build):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "check"))
    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{path}/{n}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)
        jobs.run(build(stream), out, mark).awaitTermination()
    return spark.read.parquet(out)


def test_alerts_out_of_order_across_restarts(spark, tmp_path):
    rnd = random.Random(1)
    rows = []
    for key in "abc":
        breach = False
        for i in range(60):
            breach = breach if rnd.random() < 0.8 else not breach
            if rnd.random() < 0.93:  # now and then an evaluation is missing
                rows.append((key, BASE + 60 * i, breach))
    rows += [("silent", BASE + 60 * i, True) for i in range(3, 14)]
    rows += [("clock", BASE + 60 * 90, False)]
    parts = arrivals(rows, lambda r: r[1], 600, 4, 2)
    schema = "key string, t long, breach boolean"
    got = run_all(spark, tmp_path, parts, schema, lambda s: eventtime.alert_stream(s, 60, 180, "10 minutes"))
    end = BASE + 60 * 80  # the watermark; what lies up to it is decided
    held = spark.createDataFrame(rows, schema).where(f"breach AND t <= {end}").select("key", "t")
    want = series.alert_states(held, ["key"], 60, 180, until=end)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("key", "state", "at").collect()))
    silent = sorted((r.at - BASE, r.state) for r in got.where("key = 'silent'").collect())
    assert silent == [(180, "pending"), (360, "firing"), (840, "resolved")]


def test_late_and_repeated_evaluations(spark, tmp_path):
    schema = "key string, t long, breach boolean"
    first = [("a", BASE + 60 * i, True) for i in range(5)] + [("a", BASE + 60, True), ("a", BASE + 120, False), ("a", BASE + 6000, False)]
    late = [("a", BASE + 60 * 5, True), ("b", BASE + 60, True), ("a", BASE + 7000, False)]
    got = run_all(spark, tmp_path, [first, late], schema, lambda s: eventtime.alert_stream(s, 60, 120, "10 minutes"))
    assert sorted((r.key, r.at - BASE, r.state) for r in got.collect()) == [("a", 0, "pending"), ("a", 120, "firing"), ("a", 300, "resolved")]


@pytest.mark.parametrize("range_s,step_s,batches", [(120, 60, 3), (60, 60, 5), (300, 120, 2), (30, 60, 4)])
def test_rates_out_of_order_across_restarts(spark, tmp_path, range_s, step_s, batches):
    rnd = random.Random(range_s)
    rows = []
    for key in ("x", "y"):
        value, at = 0.0, 0.0
        for _ in range(120):
            at += rnd.choice([5, 15, 15, 15.25, 40, 400 if rnd.random() < 0.1 else 15])
            value = 1.0 if rnd.random() < 0.05 else value + rnd.randint(0, 9)  # a reset now and then
            rows.append((key, dt.datetime.fromtimestamp(BASE + at, dt.timezone.utc), value))
    stop = dt.datetime.fromtimestamp(BASE + 20_000, dt.timezone.utc)
    rows += [("z", stop, 1.0)]
    parts = arrivals(rows, lambda r: r[1].timestamp(), 300, batches, 3)
    schema = "k string, ts timestamp, value double"
    got = run_all(spark, tmp_path, parts, schema, lambda s: eventtime.counter_rates(s, ["k"], range_s, step_s, "5 minutes"))
    want = series.rate(spark.createDataFrame(rows, schema), ["k"], range_s, step_s).where(F.col("t") <= BASE + 20_000 - 300)
    rounded = lambda df: sorted((r.k, r.t, round(r.value, 9)) for r in df.collect())
    assert rounded(got) == rounded(want) and got.count() > 20
