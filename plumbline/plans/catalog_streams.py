"""Queries that run as streams over files Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import schema as S
from plumbline.operators import clean, logs, model, prep
from plumbline.plans.catalog_features import RAW_SQL, raw_text
from plumbline.plans.catalog_models import FEATURES_USED, train_and_rest
from plumbline.plans.catalog_series import BY, HOUR, RATES_SQL, SHIPPED_SQL, counter, raw_logs, rounded
from plumbline.plans.registry import LINE_KEY, NUMBERS, events, query
from plumbline.session import ROCKSDB, shared_dir
from plumbline.sources import files, tail
from plumbline.streaming import alerts, eventtime, jobs

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def as_stream(df, name):
    """df written to files and read back as a stream: (stream, folder)."""
    root = shared_dir(df.sparkSession, name)
    df.write.parquet(root)
    return jobs.read_files(df.sparkSession, root, df.schema), root


def finish(stream, name, partition_by=()):
    """Run over all input there is; returns the sink folder and the query."""
    spark = stream.sparkSession
    out = shared_dir(spark, name)
    running = jobs.run(stream, out, shared_dir(spark, f"{name}-checkpoint"), partition_by)
    running.awaitTermination()
    return out, running


def plain_events(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")


@query(
    "ST1",
    f"WITH {SHIPPED_SQL} SELECT service, stream, level, count(*) AS n, count(container) AS named, sum(length(line))::bigint AS characters FROM shipped GROUP BY 1, 2, 3",
)
def log_stream(spark, sf_dir):
    stream, _ = as_stream(raw_logs(spark, sf_dir), "raw-logs")
    out, _ = finish(jobs.ship_logs(stream), "shipped", ["service"])
    return spark.read.parquet(out).groupBy("service", "stream", "level").agg(
        F.count(F.lit(1)).alias("n"), F.count("container").alias("named"), F.sum(F.length("line")).alias("characters")
    )


@query(
    "ST1",
    f"WITH {SHIPPED_SQL} SELECT service, stream, level, count(*) AS n, sum(length(line))::bigint AS characters FROM shipped GROUP BY 1, 2, 3",
)
def tailed_logs(spark, sf_dir):
    """Container records as text files that are read line by line; the second half arrives between two runs."""
    root, out, checkpoint = (shared_dir(spark, f"tailed{end}") for end in ("", "-out", "-checkpoint"))
    records = raw_logs(spark, sf_dir)
    late = F.unix_seconds(F.col("ts").cast("timestamp")) % 2 == 1
    for part in (~late, late):
        records.where(part).select(F.to_json(F.struct(*records.columns)).alias("value")).write.mode("append").text(root)
        read = tail.tail(spark, root, "part-*").select(F.from_json("line", records.schema).alias("r")).select("r.*")
        jobs.run(logs.ship(read), out, checkpoint).awaitTermination()
    return spark.read.parquet(out).groupBy("service", "stream", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("characters")
    )


CLOSED = "(SELECT max(epoch_us(ts)) FROM events) - 600000000"


@query(
    "ST2",
    f"""SELECT event_type, epoch_us(ts) // 3600000000 * 3600 AS start, count(*) AS rows FROM events
    GROUP BY 1, 2 HAVING (min(epoch_us(ts)) // 3600000000 + 1) * 3600000000 <= {CLOSED}""",
)
def tumbling_counts(spark, sf_dir):
    """Windows that the watermark has passed."""
    stream, _ = as_stream(plain_events(spark, sf_dir), "events")
    out, _ = finish(jobs.tumbling_counts(stream, ["event_type"], "1 hour", "10 minutes"), "tumbling")
    return spark.read.parquet(out).select("event_type", F.unix_seconds("start").alias("start"), "rows")


@query(
    "ST3",
    f"""WITH w AS (SELECT event_type, unnest([epoch_us(ts) // 3600000000 - 1, epoch_us(ts) // 3600000000]) * 3600 AS start FROM events)
    SELECT event_type, start, round(count(*) / 7200.0::double, 9) AS rate FROM w GROUP BY 1, 2 HAVING (start + 7200) * 1000000 <= {CLOSED}""",
)
def sliding_rates(spark, sf_dir):
    stream, _ = as_stream(plain_events(spark, sf_dir), "events")
    out, _ = finish(jobs.sliding_rates(stream, ["event_type"], 2 * HOUR, HOUR), "sliding")
    return spark.read.parquet(out).select("event_type", F.unix_seconds("start").alias("start"), F.round("rate", 9).alias("rate"))


@query(
    "ST4",
    """WITH logs AS (SELECT event_type AS type, (epoch_us(ts) + 3599999999) // 3600000000 * 3600 AS t FROM events),
    c AS (SELECT type, t, count(*) AS n FROM logs GROUP BY 1, 2), ends AS (SELECT type, max(t) AS last FROM c GROUP BY 1), b AS (SELECT type, t FROM c WHERE n > 2),
    islands AS (SELECT type, min(t) AS a, max(t) AS b FROM (SELECT type, t, t - 3600 * row_number() OVER (PARTITION BY type ORDER BY t) AS island FROM b) GROUP BY type, island)
    SELECT type AS key, 'pending' AS state, a AS at_s FROM islands UNION ALL SELECT type, 'firing', a + 7200 FROM islands WHERE b - a >= 7200
    UNION ALL SELECT i.type, 'resolved', b + 3600 FROM islands i JOIN ends e ON i.type = e.type WHERE b - a >= 7200 AND b < last""",
)
def alert_stream(spark, sf_dir):
    """Hourly evaluations as a stream; state lives in RocksDB per rule and series."""
    counts = logs.count_over_time(events(spark, sf_dir), ["event_type"], HOUR)
    evaluations = counts.select(F.col("event_type").alias("key"), "t", (F.col("lines") > 2).alias("breach"))
    stream, _ = as_stream(evaluations, "evaluations")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        out, _ = finish(alerts.alert_stream(stream, HOUR, 2 * HOUR), "alerts")
    finally:
        spark.conf.set(PROVIDER, before)
    return spark.read.parquet(out).withColumnRenamed("at", "at_s")


def run_disordered(df, name, at, delay_s, build):
    """The rows of `build` over a stream of df that arrives in two parts, by a restarted query, each row
    up to 0.9 delays after its time `at` (epoch seconds)."""
    spark = df.sparkSession
    root, out, checkpoint = (shared_dir(spark, f"{name}{end}") for end in ("", "-out", "-checkpoint"))
    held_back = F.pmod(F.xxhash64(*df.columns), F.lit(int(delay_s * 0.9)))
    first = at + held_back < F.lit("2024-01-15").cast("timestamp").cast("bigint")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        for part in (first, ~first):
            df.where(part).write.mode("append").parquet(root)
            stream = build(jobs.read_files(spark, root, df.schema))
            jobs.run(stream, out, checkpoint).awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "ST4",
    """WITH logs AS (SELECT event_type AS type, (epoch_us(ts) + 3599999999) // 3600000000 * 3600 AS t FROM events),
    c AS (SELECT type, t, count(*) AS n FROM logs GROUP BY 1, 2), w AS (SELECT max(t) - 21600 AS until FROM c), b AS (SELECT type, t FROM c, w WHERE n > 2 AND t <= until),
    islands AS (SELECT type, min(t) AS a, max(t) AS b FROM (SELECT type, t, t - 3600 * row_number() OVER (PARTITION BY type ORDER BY t) AS island FROM b) GROUP BY type, island)
    SELECT type AS key, 'pending' AS state, a AS at_s FROM islands UNION ALL SELECT type, 'firing', a + 7200 FROM islands WHERE b - a >= 7200
    UNION ALL SELECT type, 'resolved', b + 3600 FROM islands, w WHERE b - a >= 7200 AND b + 3600 <= until""",
)
def alerts_out_of_order(spark, sf_dir):
    """Evaluations that arrive out of order and across a restart; only breaches are sent, so that series
    without one fall silent and resolve by timer."""
    counts = logs.count_over_time(events(spark, sf_dir), ["event_type"], HOUR)
    clock = counts.agg(F.lit("clock").alias("key"), F.max("t").alias("t"), F.lit(False).alias("breach"))
    sent = counts.where("lines > 2").select(F.col("event_type").alias("key"), "t", F.lit(True).alias("breach")).unionByName(clock)
    found = run_disordered(sent, "evaluations", F.col("t"), 6 * HOUR, lambda s: eventtime.alert_stream(s, HOUR, 2 * HOUR, "6 hours"))
    return found.withColumnRenamed("at", "at_s")


@query(
    "ST3, TS2",
    f"""WITH {RATES_SQL} SELECT type, shard, t, round(value, 6) AS value FROM rates
    WHERE t * 1000 <= (SELECT max(epoch_us(ts)) // 1000 - 10800000 FROM events)""",
)
def counter_rate_stream(spark, sf_dir):
    """Rates of a counter with resets, from samples out of order and across a restart."""
    samples = counter(spark, sf_dir).select(*BY, "ts", "value")
    at = F.unix_seconds("ts")
    return rounded(run_disordered(samples, "samples", at, 3 * HOUR, lambda s: eventtime.counter_rates(s, BY, 12 * HOUR, 6 * HOUR, "3 hours")))


@query(
    "ST5",
    f"""SELECT event_type, count(*) AS rows FROM (SELECT event_type, epoch_us(ts) // 3600000000 AS h FROM events) WHERE (h + 1) * 3600000000 <= {CLOSED} GROUP BY 1""",
)
def late_rows_dropped(spark, sf_dir):
    """Rows of the first days sent again after the watermark passed them change nothing."""
    df = plain_events(spark, sf_dir)
    stream, root = as_stream(df, "events")
    counts = jobs.tumbling_counts(stream, ["event_type"], "1 hour", "10 minutes")
    out, checkpoint = shared_dir(spark, "late"), shared_dir(spark, "late-checkpoint")
    jobs.run(counts, out, checkpoint).awaitTermination()
    df.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp")).write.mode("append").parquet(root)
    jobs.run(counts, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.sum("rows").alias("rows"))


@query("ST6", "SELECT event_type, user_id, arg_max(value, ts) AS value FROM events GROUP BY 1, 2")
def latest_upserted(spark, sf_dir):
    stream, _ = as_stream(plain_events(spark, sf_dir), "events")
    by, out = ["event_type", "user_id"], shared_dir(spark, "latest")
    newest = jobs.latest_values(stream, by, ["value"])
    jobs.run_batches(newest, jobs.upsert_to(out, by, ["value"]), shared_dir(spark, "latest-checkpoint"), "update").awaitTermination()
    return jobs.read_upserted(spark, out).drop("ts")


@query("ST7, T8")
def scored_stream(spark, sf_dir):
    """Micro-batches through gate, fitted transform and model; the same rows as batch scoring."""
    train, rest = train_and_rest(spark, sf_dir)
    fitted = prep.fit(train, NUMBERS)
    scorer = model.fit_logistic(fitted.transform(train, ["y"]), FEATURES_USED, "y")
    rows = rest.select(F.xxhash64(*LINE_KEY).alias(S.ROW_ID), *NUMBERS)
    stream, _ = as_stream(rows, "to-score")
    out, rejected = shared_dir(spark, "scores"), shared_dir(spark, "rejected")
    write = jobs.score_batches(scorer, NUMBERS, 0.5, out, rejected, lambda df: fitted.transform(df, [S.ROW_ID]))
    jobs.run_batches(stream, write, shared_dir(spark, "scores-checkpoint")).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query("ST8", "SELECT event_id, event_type, value FROM events")
def duplicate_safe_stream(spark, sf_dir):
    df = plain_events(spark, sf_dir)
    stream, _ = as_stream(df.unionAll(df), "events-twice")
    out, _ = finish(jobs.without_duplicates(stream, ["event_id"]), "unique")
    return spark.read.parquet(out).select("event_id", "event_type", "value")


@query(
    "FS5",
    f"""WITH {RAW_SQL} SELECT bucket AS age_risk_bucket, count(*) AS n, round(sum(debt), 1) AS debt, count(dti) AS dti_rows, round(sum(unsecured), 3) AS unsecured FROM gold GROUP BY 1""",
)
def shared_feature_function(spark, sf_dir):
    """The feature function of the batch layers, run on a stream of typed rows."""
    typed = clean.clean(files.read_csv(spark, raw_text(spark, sf_dir)), "training")
    stream, _ = as_stream(typed, "typed")
    out, _ = finish(clean.feature_table(stream, "training"), "features")
    return spark.read.parquet(out).groupBy("age_risk_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("debt_ratio"), 1).alias("debt"),
        F.count("debt_to_income_ratio").alias("dti_rows"),
        F.round(F.sum("unsecured_to_total_lines_ratio"), 3).alias("unsecured"),
    )
