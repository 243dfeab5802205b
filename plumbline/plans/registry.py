"""Named queries: a Spark plan over the given tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import prepare, shared_dir

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    plan: Plan
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None, name: str | None = None):
    """Register a plan under its function name."""

    def add(fn: Plan) -> Plan:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")

        def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[key] = Query(key, covers, plan, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """df stored in the shared folder and read back, so that what reads it several times computes it once."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with an instant as ts."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored rows: label y (error event), score p, and the day it happened."""
    df = events(spark, sf_dir)
    return df.select(
        "event_id",
        "ts",
        (F.col("event_type") == "error").cast("int").alias("y"),
        F.round(F.least(F.col("value") / 400, F.lit(1.0)), 6).alias("p"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


SCORED_SQL = """scored AS (SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y,
  round(least(value / 400, 1.0), 6) AS p, strftime(ts, '%Y-%m-%d') AS day FROM events)"""

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_ORDER = {"l_orderkey": 7919, "l_linenumber": 104729, "l_partkey": 1299709, "l_suppkey": 15485863}
LINE_ORDER_SQL = "(l_orderkey * 7919 + l_linenumber::bigint * 104729 + l_partkey * 1299709 + l_suppkey * 15485863) % 1000003"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a feature table: key, label returned, numbers with gaps, one category."""
    df = table(spark, sf_dir, "lineitem")
    return df.select(
        *LINE_KEY,
        "l_shipdate",
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.col("l_returnflag").alias("flag"),
    )


LINES_SQL = """lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity AS quantity, l_extendedprice AS price,
  nullif(l_discount, 0.0) AS discount, nullif(l_tax, 0.0) AS tax, l_returnflag AS flag FROM lineitem)"""

NUMBERS = ["quantity", "price", "discount", "tax"]
