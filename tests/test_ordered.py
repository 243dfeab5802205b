"""Sliced windows against plain windows, with a key that holds a third of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators import ordered


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(60)}"
        data.append((key, i * 7 % 3001, rng.choice([None, float(rng.randrange(50))]), rng.randrange(9)))
    return spark.createDataFrame(data, "key string, at int, value double, n bigint").cache()


def sliced(rows):
    column = ordered.order_slices(rows, "at", rows_per_slice=100)
    return rows.withColumn(ordered.SLICE, column)


def collect(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_slices_follow_the_order_and_split_the_hot_key(rows):
    df = sliced(rows)
    per_slice = df.groupBy("key", ordered.SLICE).count()
    assert per_slice.where("key = 'hot'").agg(F.max("count")).first()[0] < 200
    bounds = df.groupBy(ordered.SLICE).agg(F.min("at").alias("a"), F.max("at").alias("b")).orderBy(ordered.SLICE).collect()
    assert len(bounds) > 20
    assert all(x.b < y.a for x, y in zip(bounds, bounds[1:]))


def test_position_in(spark):
    edges = [1.0, 2.0, 2.0, 5.0, 9.0]
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1.5, 2, 4, 5, 8, 9, 10)], "v double")
    at = ordered.position_in(F.col("v"), ordered.literal_array(edges), len(edges))
    got = {r.v: r.at for r in df.select("v", at.alias("at")).collect()}
    assert got == {v: sum(e <= v for e in edges) for v in got}


def test_running_sums(rows):
    got = ordered.running_sums(sliced(rows), ["key"], ordered.SLICE, [F.col("at")], {"run": "n"}, {"all": "n"})
    w = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("run", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy("key")))
    columns = ["key", "at", "n", "run", "all"]
    assert collect(got.select(columns)) == collect(want.select(columns))


def test_running_sums_descending(rows):
    got = ordered.running_sums(
        sliced(rows), ["key"], ordered.SLICE, [F.col("at").desc()], {"run": "n"}, descending_parts=True
    )
    w = Window.partitionBy("key").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("run", F.sum("n").over(w))
    assert collect(got.select("key", "at", "run")) == collect(want.select("key", "at", "run"))


def test_neighbour_rows(rows):
    w = Window.partitionBy("key").orderBy("at")
    got = ordered.previous_row(sliced(rows), ["key"], ordered.SLICE, ["at"], ["at", "n"], "other")
    want = rows.select("key", "at", F.lag("at").over(w).alias("x"), F.lag("n").over(w).alias("y"))
    assert collect(got.select("key", "at", "other.at", "other.n")) == collect(want)
    got = ordered.running_sums(sliced(rows), ["key"], ordered.SLICE, [F.col("at")], {"s": "n"}, following={"next": "at"})
    want = rows.select("key", "at", F.lead("at").over(w).alias("next"))
    assert collect(got.select("key", "at", "next")) == collect(want)


def test_last_known(rows):
    got = ordered.last_known(sliced(rows), ["key"], ordered.SLICE, ["at"], "value", "known")
    w = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("known", F.last("value", ignorenulls=True).over(w))
    assert collect(got.select("key", "at", "known")) == collect(want.select("key", "at", "known"))


def test_null_keys_are_a_key(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), ("a", 1, 5)], "k string, at int, n int")
    got = ordered.running_sums(df.withColumn(ordered.SLICE, F.col("at")), ["k"], ordered.SLICE, [F.col("at")], {"run": "n"})
    assert collect(got.select("k", "at", "run")) == collect(
        spark.createDataFrame([(None, 1, 1), (None, 2, 3), ("a", 1, 5)], "k string, at int, run bigint")
    )


def test_running_sums_read_their_input_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    counts = events.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn(ordered.SLICE, F.floor(F.col("user_id") / 3))
    out = ordered.running_sums(counts, ["event_type"], ordered.SLICE, [F.col("user_id")], {"run": "n"}, {"all": "n"})
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
