"""Queries for scans, sinks and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.operators import split
from plumbline.plans.registry import LINE_KEY, LINE_ORDER, LINE_ORDER_SQL, NUMBERS, events, lines, query, table
from plumbline.session import shared_dir
from plumbline.sources import files, objects


def _events_by_day(spark, sf_dir):
    root = shared_dir(spark, "events-by-day")
    df = events(spark, sf_dir).withColumn("ingestion_date", F.date_format("ts", "yyyy-MM-dd"))
    files.write_by(df, root, ["ingestion_date"])
    return root


@query(
    "S1",
    """SELECT c_custkey::varchar AS c_custkey, c_name, c_nationkey::varchar AS c_nationkey,
    c_acctbal::varchar AS c_acctbal, c_mktsegment FROM customer""",
)
def csv_text_scan(spark, sf_dir):
    path = shared_dir(spark, "customer-csv")
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    table(spark, sf_dir, "customer").select(*columns).write.option("header", True).csv(path)
    return files.read_csv(spark, path)


@query(
    "S2",
    """SELECT event_id, event_type, value FROM events
    WHERE strftime(ts, '%Y-%m-%d') = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events)""",
)
def partition_scan(spark, sf_dir):
    root = _events_by_day(spark, sf_dir)
    newest = files.latest_partition(spark, root).first()[0]
    return files.read_partition(spark, root, newest).select("event_id", "event_type", "value")


@query("S3", "SELECT event_id, event_type, value, user_id FROM events")
def parquet_concat(spark, sf_dir):
    root = _events_by_day(spark, sf_dir)
    return files.read_all(spark, root).select("event_id", "event_type", "value", "user_id")


@query("S4", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def recursive_scan(spark, sf_dir):
    root = _events_by_day(spark, sf_dir)
    df = files.read_recursive(spark, root)
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "S5, P5",
    """SELECT strftime(ts, '%Y-%m-%d') AS ingestion_date, count(*) AS n,
    sum(CASE WHEN strftime(ts, '%Y-%m-%d') = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events) THEN 1 ELSE 0 END)::bigint AS rewritten
    FROM events GROUP BY 1""",
)
def partitioned_sink(spark, sf_dir):
    """All days are written, the last day is written again, every other day is still there."""
    root = shared_dir(spark, "events-sink")
    df = events(spark, sf_dir).withColumn("rewritten", F.lit(0))
    by_day = df.withColumn("ingestion_date", F.date_format("ts", "yyyy-MM-dd"))
    files.write_by(by_day, root, ["ingestion_date"])
    newest = files.latest_partition(spark, root).first()[0]
    last_day = by_day.where(F.col("ingestion_date") == newest).drop("ingestion_date")
    files.write_partitioned(last_day.withColumn("rewritten", F.lit(1)), root, newest)
    return spark.read.parquet(root).groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rewritten").alias("rewritten")
    )


@query(
    "S6, F9",
    """SELECT CASE WHEN l_shipdate < timestamp '1998-01-01' THEN 'train' WHEN l_shipdate < timestamp '2000-01-01' THEN 'val' ELSE 'test' END AS split,
    count(*) AS n, round(sum(l_extendedprice), 2) AS price, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::bigint AS positives
    FROM lineitem GROUP BY 1""",
)
def split_sink(spark, sf_dir):
    root = shared_dir(spark, "splits")
    parts = split.temporal_split(lines(spark, sf_dir), "l_shipdate", "1998-01-01", "2000-01-01")
    files.write_splits(parts, root, NUMBERS, "y")
    return spark.read.parquet(root).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("price"), F.sum("y").alias("positives")
    )


@query("S7", "SELECT max(strftime(ts, '%Y-%m-%d')) AS ingestion_date FROM events")
def latest_partition(spark, sf_dir):
    return files.latest_partition(spark, _events_by_day(spark, sf_dir))


@query("S8", "SELECT count(*) AS n FROM orders")
def landing_check(spark, sf_dir):
    return files.require_rows(table(spark, sf_dir, "orders"), "orders").agg(F.count(F.lit(1)).alias("n"))


@query(
    "S9",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY (o_orderkey * 7919) % 1000003, o_orderkey LIMIT 10000""",
)
def exact_sample(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    order = split.arithmetic_order({"o_orderkey": 7919})
    return split.sample_n(df, 10_000, ["o_orderkey"], order=order)


@query(
    "S9",
    f"""SELECT {', '.join(LINE_KEY)}, l_extendedprice FROM lineitem
    ORDER BY {LINE_ORDER_SQL}, {', '.join(LINE_KEY)} LIMIT 30000""",
)
def exact_sample_large(spark, sf_dir):
    """The cut is found by counting and the table is filtered."""
    df = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_extendedprice")
    return split.sample_n(df, 30_000, LINE_KEY, order=split.arithmetic_order(LINE_ORDER))


@query(
    "S10",
    """SELECT 'bronze/trips/' || year(o_orderdate) || '-' || lpad(month(o_orderdate)::varchar, 2, '0') || '.parquet' AS key,
    count(*) AS n FROM orders GROUP BY 1""",
)
def month_paths(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    key = C.month_key("bronze/trips/", F.year("o_orderdate"), F.month("o_orderdate"), ".parquet")
    return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "S11",
    """SELECT o_orderstatus AS name, count(*) AS n, round(avg(o_totalprice), 4) AS mean,
    max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS top_urgent,
    count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY 1""",
)
def report_round_trip(spark, sf_dir):
    """Nested maps and arrays survive a JSON document."""
    path = shared_dir(spark, "report")
    df = table(spark, sf_dir, "orders")
    best = df.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"), F.max("o_totalprice").alias("m")
    )
    report = best.groupBy(F.col("o_orderstatus").alias("name")).agg(
        F.sum("n").alias("n"),
        F.round(F.sum("s") / F.sum("n"), 4).alias("mean"),
        F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "m"))).alias("top"),
        F.sort_array(F.collect_list("o_orderpriority")).alias("priorities"),
    )
    files.write_report(report, path)
    back = files.read_report(spark, path, report.schema)
    return back.select(
        "name",
        "n",
        "mean",
        F.try_element_at("top", F.lit("1-URGENT")).alias("top_urgent"),
        F.size("priorities").cast("bigint").alias("priorities"),
    )


def _event_root(spark, sf_dir):
    root = shared_dir(spark, "objects")
    df = events(spark, sf_dir).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    df = df.withColumn("kind", F.col("event_type")).select("event_id", "event_type", "value", "kind", "day")
    df.hint("rebalance", "kind", "day").write.option("maxRecordsPerFile", 1_000_000).partitionBy("kind", "day").json(root)
    return root


def _event_objects(spark, sf_dir):
    root = _event_root(spark, sf_dir)
    return objects.with_names(objects.scan(spark, root), root)


@query(
    "S12",
    """SELECT DISTINCT 'kind=' || event_type AS container FROM events
    WHERE 'kind=' || event_type > 'kind=click' AND event_type IN ('error', 'purchase', 'view') ORDER BY 1 LIMIT 5""",
)
def object_containers(spark, sf_dir):
    allowed = ["kind=error", "kind=purchase", "kind=view", "kind=click"]
    return objects.containers_page(spark, _event_root(spark, sf_dir), allowed, "kind=click")


@query(
    "S12",
    """SELECT DISTINCT 'kind=error' AS container, 'day=' || strftime(ts, '%Y-%m-%d') AS folder FROM events
    WHERE event_type = 'error' AND strftime(ts, '%Y-%m-%d') > '2024-01-05' ORDER BY 2 LIMIT 1000""",
)
def object_listing(spark, sf_dir):
    page = objects.objects_page(spark, _event_root(spark, sf_dir), "kind=error", prefix="day=2024-", start_after="day=2024-01-06")
    return page.select("container", F.substring_index("key", "/", 1).alias("folder")).distinct()


@query(
    "S13",
    """SELECT 'kind=' || event_type AS container, 'day=' || strftime(ts, '%Y-%m-%d') AS folder, count(*) AS entries
    FROM events GROUP BY 1, 2""",
)
def object_bodies(spark, sf_dir):
    df = _event_objects(spark, sf_dir)
    text = objects.body("content", "key")
    return df.groupBy("container", F.substring_index("key", "/", 1).alias("folder")).agg(
        F.sum(F.regexp_count(text, F.lit("event_id"))).cast("bigint").alias("entries")
    )


@query(
    "S14",
    """SELECT event_type AS run_id, round(avg(value), 4) AS mean_value, count(*)::double AS event_rows,
    round(max(value), 4) AS max_value FROM events GROUP BY 1""",
)
def run_log(spark, sf_dir):
    path = shared_dir(spark, "run-log")
    stats = events(spark, sf_dir).groupBy("event_type").agg(
        F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("event_rows"), F.max("value").alias("max_value")
    )
    keys = ["mean_value", "event_rows", "max_value"]
    rows = files.run_rows(stats, F.col("event_type"), "profile", "profiling", keys, {"layer": "bronze"})
    files.append_run_log(rows, path)
    return files.runs_wide(spark.read.parquet(path), keys)
