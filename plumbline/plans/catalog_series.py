"""Queries for metric series, logs and feature retrieval."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.operators import featurestore, logs, rules, series
from plumbline.operators.ordered import SLICE, order_slices, running_sums
from plumbline.plans.registry import events, query, table
from plumbline.session import shared_dir

HOUR = 3600
BY = ["type", "shard"]

# A counter per (event type, user shard): summed cents that start again at 100 000.
COUNTER_SQL = """cnt AS (SELECT ts, epoch_us(ts) AS us, event_type AS type, (user_id % 10)::varchar AS shard,
  (sum(round(value * 100)::bigint) OVER (PARTITION BY event_type, user_id % 10 ORDER BY ts) % 100000)::double / 100 AS value FROM events)"""


def counter(spark, sf_dir):
    df = events(spark, sf_dir).select(
        "ts",
        F.col("event_type").alias("type"),
        (F.col("user_id") % 10).cast("string").alias("shard"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )
    df = df.withColumn(SLICE, order_slices(df, "ts"))
    out = running_sums(df, BY, SLICE, [F.col("ts")], {"total": "cents"})
    return out.select(
        "ts",
        F.lit("events_value_total").alias("metric"),
        F.create_map(F.lit("type"), F.col("type"), F.lit("shard"), F.col("shard")).alias("labels"),
        *BY,
        (F.col("total") % 100000 / 100).alias("value"),
    )


def instants_sql(source, columns, range_s, step_s):
    """Rows of `source` (with epoch micros us) once per instant whose range holds them."""
    step, span = step_s * 1_000_000, range_s * 1_000_000
    return f"""(SELECT {columns}, us, unnest(range((us + {step - 1}) // {step}, (us + {span + step - 1}) // {step})) * {step_s} AS t FROM {source})"""


RATES_SQL = f"""{COUNTER_SQL}, inc AS (SELECT *, coalesce(CASE WHEN value < prev THEN value ELSE value - prev END, 0) AS up FROM (
  SELECT *, lag(value) OVER (PARTITION BY type, shard ORDER BY ts) AS prev FROM cnt)),
rates AS (SELECT type, shard, t, (sum(up) - arg_min(up, us)) * 1e6 / (max(us) - min(us)) AS value FROM
  {instants_sql('inc', 'type, shard, up', 12 * HOUR, 6 * HOUR)} GROUP BY 1, 2, 3 HAVING count(*) >= 2)"""


def rates(spark, sf_dir):
    return series.rate(counter(spark, sf_dir), BY, 12 * HOUR, 6 * HOUR, times=events(spark, sf_dir))


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in (names or ("value",))})


@query(
    "TS1",
    f"""WITH {COUNTER_SQL} SELECT type, shard, count(*) AS samples, round(sum(value), 2) AS total FROM cnt
    WHERE type <> 'view' AND type IN ('error', 'click') AND shard NOT IN ('0', '9') GROUP BY 1, 2""",
)
def label_matchers(spark, sf_dir):
    """= != =~ !~ on labels; an absent label is the empty string."""
    matchers = [
        ("__name__", "=", "events_value_total"), ("type", "!=", "view"), ("type", "=~", "err.*|click"),
        ("shard", "!~", "0|9"), ("host", "=", ""), ("type", "!~", "erro"),
    ]
    kept = series.select_series(counter(spark, sf_dir), matchers)
    return kept.groupBy(*BY).agg(F.count(F.lit(1)).alias("samples"), F.round(F.sum("value"), 2).alias("total"))


@query("TS2", f"WITH {RATES_SQL} SELECT type, shard, t, round(value, 6) AS value FROM rates")
def counter_rate(spark, sf_dir):
    return rounded(rates(spark, sf_dir))


@query(
    "TS3",
    f"""WITH {RATES_SQL} SELECT type, t, round(sum(value), 6) AS total, round(max(value), 6) AS top FROM rates GROUP BY 1, 2""",
)
def sum_by_label(spark, sf_dir):
    v = rates(spark, sf_dir)
    total = series.aggregate(v, "sum", ["type"]).withColumnRenamed("value", "total")
    top = series.aggregate(v, "max", ["type"]).withColumnRenamed("value", "top")
    return rounded(total.join(top, ["t", "type"]), "total", "top")


@query(
    "TS4",
    f"""WITH {RATES_SQL} SELECT type, shard, t, value FROM (SELECT type, shard, t, round(value, 6) AS value,
    row_number() OVER (PARTITION BY t ORDER BY round(value, 6) DESC, type, shard) AS r FROM rates) WHERE r <= 3""",
)
def top_series(spark, sf_dir):
    return series.topk(rounded(rates(spark, sf_dir)), 3, BY)


@query("TS5", f"WITH {RATES_SQL} SELECT type, round(sum(value), 4) AS value FROM rates GROUP BY 1 ORDER BY 2 DESC")
def sorted_series(spark, sf_dir):
    total = rates(spark, sf_dir).groupBy("type").agg(F.round(F.sum("value"), 4).alias("value"))
    return series.sort_desc(total)


@query(
    "TS6",
    f"""WITH {RATES_SQL}, l AS (SELECT shard, t, sum(value) AS v FROM rates WHERE type = 'error' GROUP BY 1, 2), r AS (SELECT shard, t, sum(value) AS v FROM rates GROUP BY 1, 2)
    SELECT shard, t, round(l.v / nullif(r.v, 0), 6) AS value FROM l JOIN r USING (shard, t) WHERE l.v / nullif(r.v, 0) > 0.25""",
)
def series_ratio(spark, sf_dir):
    v = rates(spark, sf_dir)
    errors = series.aggregate(v.where(F.col("type") == "error"), "sum", ["shard"])
    return rounded(series.ratio(errors, series.aggregate(v, "sum", ["shard"]), ["shard"], above=0.25))


@query(
    "TS7",
    f"""WITH s AS (SELECT epoch_us(ts) AS us, user_id % 10 AS shard, CASE WHEN (user_id % 10) <> lag(user_id % 10) OVER (ORDER BY ts) THEN 1 ELSE 0 END AS x, event_type AS type, ts FROM events),
    m AS (SELECT us, type, shard, CASE WHEN shard <> lag(shard) OVER (PARTITION BY type ORDER BY ts) THEN 1 ELSE 0 END AS moved FROM s)
    SELECT type, t, (sum(moved) - arg_min(moved, us))::bigint AS value FROM {instants_sql('m', 'type, moved', 6 * HOUR, 6 * HOUR)} GROUP BY 1, 2 HAVING sum(moved) - arg_min(moved, us) > 0""",
)
def value_changes(spark, sf_dir):
    df = events(spark, sf_dir).select("ts", F.col("event_type").alias("type"), (F.col("user_id") % 10).alias("value"))
    return series.changes(df, ["type"], 6 * HOUR, 6 * HOUR).where(F.col("value") > 0)


@query(
    "TS8",
    f"""WITH {RATES_SQL}, l AS (SELECT type, shard, t, value FROM rates WHERE value > 0.02), r AS (SELECT type, shard, t, -1.0::double AS value FROM rates WHERE value < 0.03)
    SELECT type, shard, t, round(value, 6) AS value FROM l UNION ALL SELECT type, shard, t, value FROM r WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.type = r.type AND l.shard = r.shard AND l.t = r.t)""",
)
def either_condition(spark, sf_dir):
    v = rates(spark, sf_dir)
    left = v.where(F.col("value") > 0.02)
    right = v.where(F.col("value") < 0.03).withColumn("value", F.lit(-1.0))
    return rounded(series.either(left, right, BY))


@query(
    "TS9",
    """SELECT event_type AS type, user_id, round((epoch_us(timestamp '2024-01-31') - max(epoch_us(ts))) / 1e6, 3) AS age_s,
    (epoch_us(timestamp '2024-01-31') - max(epoch_us(ts))) / 1e6 > 172800 AS stale FROM events GROUP BY 1, 2""",
)
def stale_series(spark, sf_dir):
    df = events(spark, sf_dir).withColumnRenamed("event_type", "type")
    return series.staleness(df, ["type", "user_id"], "2024-01-31")


def breach_sql(step, wait):
    """Transitions of `breaches` (type, t) by gaps and islands."""
    w = -(-wait // step) * step
    return f"""islands AS (SELECT type, min(t) AS a, max(t) AS b FROM (SELECT type, t, t - {step} * row_number() OVER (PARTITION BY type ORDER BY t) AS island FROM breaches) GROUP BY type, island),
moves AS (SELECT type, 'pending' AS state, a AS at_s FROM islands WHERE {w} > 0 UNION ALL SELECT type, 'firing', a + {w} FROM islands WHERE b - a >= {w}
  UNION ALL SELECT type, 'resolved', b + {step} FROM islands WHERE b - a >= {w} AND b + {step} <= (SELECT max(t) FROM hourly))"""


HOURLY_SQL = f"""logs AS (SELECT epoch_us(ts) AS us, event_type AS type FROM events),
hourly AS (SELECT type, t, count(*) / 3600.0::double AS value FROM {instants_sql('logs', 'type', HOUR, HOUR)} GROUP BY 1, 2),
breaches AS (SELECT type, t FROM hourly WHERE value > 2 / 3600.0::double)"""


@query("TS10", f"WITH {HOURLY_SQL}, {breach_sql(HOUR, 2 * HOUR)} SELECT type, state, at_s FROM moves")
def alert_states(spark, sf_dir):
    """Hourly event rate over a bound: pending, firing after two hours, resolved."""
    rate = logs.line_rate(events(spark, sf_dir).withColumnRenamed("event_type", "type"), ["type"], HOUR, HOUR)
    return series.alert_states(rate.where(F.col("value") > 2 / 3600.0).select("type", "t"), ["type"], HOUR, 2 * HOUR, until=rate.agg(F.max("t")).scalar()).withColumnRenamed("at", "at_s")


@query("TS10", f"WITH {HOURLY_SQL}, {breach_sql(HOUR, 0)} SELECT type, state, at_s FROM moves")
def immediate_alerts(spark, sf_dir):
    """Without a waiting time there is no pending state."""
    rate = logs.line_rate(events(spark, sf_dir).withColumnRenamed("event_type", "type"), ["type"], HOUR, HOUR)
    return series.alert_states(rate.where(F.col("value") > 2 / 3600.0).select("type", "t"), ["type"], HOUR, 0, until=rate.agg(F.max("t")).scalar()).withColumnRenamed("at", "at_s")


@query(
    "TS11",
    """SELECT event_type, 'Max value is ' || printf('%.3f', max(value)) || ' over ' || count(DISTINCT user_id) || ' users' AS description FROM events GROUP BY 1""",
)
def alert_text(spark, sf_dir):
    one = events(spark, sf_dir).groupBy("event_type").agg(F.max("value").alias("m"), F.count_distinct("user_id").alias("u"))
    text = F.concat(F.lit("Max value is "), C.fixed3("m"), F.lit(" over "), F.col("u").cast("string"), F.lit(" users"))
    return one.select("event_type", text.alias("description"))


def digits_sql(x):
    """Four significant digits of x (0.1 up to 1000) without trailing zeros."""
    text = f"CASE WHEN {x} >= 100 THEN printf('%.1f', {x}) WHEN {x} >= 10 THEN printf('%.2f', {x}) WHEN {x} >= 1 THEN printf('%.3f', {x}) ELSE printf('%.4f', {x}) END"
    return f"rtrim(rtrim({text}, '0'), '.')"


@query(
    "TS11",
    f"""WITH s AS (SELECT event_type, sum(user_id)::double AS v, count(*) * 100.0::double / (SELECT count(*) FROM events) AS pct FROM events GROUP BY 1),
    u AS (SELECT *, CASE WHEN v >= 1e9 THEN v / 1e9::double WHEN v >= 1e6 THEN v / 1e6::double WHEN v >= 1e3 THEN v / 1e3::double ELSE v END AS x,
        CASE WHEN v >= 1e9 THEN 'G' WHEN v >= 1e6 THEN 'M' WHEN v >= 1e3 THEN 'k' ELSE '' END AS unit FROM s)
    SELECT event_type, {digits_sql('x')} || unit || ' in ' || {digits_sql('pct')} || '%' AS description FROM u""",
)
def humanized_text(spark, sf_dir):
    """Annotation with a scaled number and a percentage."""
    df = events(spark, sf_dir)
    total = df.agg(F.count(F.lit(1))).scalar()
    one = df.groupBy("event_type").agg(F.sum("user_id").cast("double").alias("v"), (F.count(F.lit(1)) / total).alias("share"))
    return one.select("event_type", F.concat(C.human_number("v"), F.lit(" in "), C.percent_text("share")).alias("description"))


@query("TS12", f"WITH {COUNTER_SQL} SELECT DISTINCT shard AS value FROM cnt ORDER BY 1")
def label_values(spark, sf_dir):
    return series.label_values(counter(spark, sf_dir), series.label("shard"))


@query(
    "TS13",
    f"""WITH {RATES_SQL} SELECT type, CASE WHEN value >= 0.03 THEN 'red' WHEN value >= 0.01 THEN 'yellow' ELSE 'green' END AS band, count(*) AS n FROM rates GROUP BY 1, 2""",
)
def threshold_bands(spark, sf_dir):
    v = rates(spark, sf_dir)
    return v.groupBy("type", C.band("value", 0.01, 0.03).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "TS14",
    """SELECT event_type AS type, round(avg(value), 4) AS mean, max(value) AS max, round(sum(value), 2) AS sum, arg_max(value, ts) AS last FROM events GROUP BY 1""",
)
def panel_reducers(spark, sf_dir):
    out = series.panel(events(spark, sf_dir).withColumnRenamed("event_type", "type"), ["type"])
    return out.select("type", F.round("mean", 4).alias("mean"), "max", F.round("sum", 2).alias("sum"), "last")


@query(
    "TS15",
    """SELECT 'container_' || event_type AS metric, 'lab' AS cluster, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1""",
)
def scrape_filter(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("metric", F.concat(F.lit("container_"), "event_type"))
    kept = series.scrape_filter(df, "container_(view|click)", {"cluster": "lab"})
    return kept.groupBy("metric", "cluster").agg(F.count(F.lit(1)).alias("n"))


@query("TS16", "SELECT CASE WHEN event_type = 'error' THEN 'Yes' ELSE 'No' END AS failed, count(*) AS n FROM events GROUP BY 1")
def value_mapping(spark, sf_dir):
    flag = C.yes_no((F.col("event_type") == "error").cast("int"))
    return events(spark, sf_dir).groupBy(flag.alias("failed")).agg(F.count(F.lit(1)).alias("n"))


@query("TS17", "SELECT event_id, event_type FROM events WHERE ts >= timestamp '2024-01-31' - INTERVAL 3 DAY")
def retention(spark, sf_dir):
    return series.retain(table(spark, sf_dir, "events"), "2024-01-31", "3 days").select("event_id", "event_type")


# ---- logs --------------------------------------------------------------------------------------

TEXT_SQL = """CASE event_type WHEN 'error' THEN 'ERROR job failed after ' || value WHEN 'purchase' THEN 'Info: paid ' || value WHEN 'view' THEN 'slow page, Warning ' || value
  WHEN 'click' THEN '  ' ELSE 'hello ' || user_id END"""


def raw_logs(spark, sf_dir):
    """Container log records: envelope JSON with text by event type; one user in seven writes plain text."""
    df = table(spark, sf_dir, "events")
    value = F.col("value").cast("string")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("ERROR job failed after "), value))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("Info: paid "), value))
        .when(F.col("event_type") == "view", F.concat(F.lit("slow page, Warning "), value))
        .when(F.col("event_type") == "click", F.lit("  "))
        .otherwise(F.concat(F.lit("hello "), F.col("user_id").cast("string")))
    )
    stream = F.when(F.col("event_type") == "error", "stderr").otherwise("stdout")
    envelope = F.to_json(F.struct(text.alias("log"), stream.alias("stream")))
    plain = F.concat(F.lit("plain fatal text "), F.col("event_id").cast("string"))
    return df.select(
        "ts",
        F.when(F.col("user_id") % 5 == 0, "false").otherwise("true").alias("enabled"),
        F.when(F.col("user_id") % 11 == 0, F.col("event_type")).otherwise(F.concat(F.lit("/svc-"), "event_type")).alias("name"),
        F.col("event_type").alias("service"),
        F.lit("lab").alias("project"),
        F.when(F.col("user_id") % 7 == 0, plain).otherwise(envelope).alias("raw"),
    )


SHIPPED_SQL = f"""shipped AS (SELECT * FROM (SELECT ts, CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'svc-' || event_type END AS container, event_type AS service, 'lab' AS project,
  CASE WHEN user_id % 7 = 0 THEN NULL WHEN event_type = 'error' THEN 'stderr' ELSE 'stdout' END AS stream,
  CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 7 = 0 THEN 'fatal' WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' THEN 'Info' WHEN event_type = 'view' THEN 'Warning' END AS level,
  CASE WHEN user_id % 7 = 0 THEN 'plain fatal text ' || event_id ELSE {TEXT_SQL} END AS line, user_id FROM events WHERE user_id % 5 <> 0) WHERE trim(line) <> '')"""


@query(
    "L10-L14",
    f"WITH {SHIPPED_SQL} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, container, service, project, stream, level, line FROM shipped",
)
def shipped_logs(spark, sf_dir):
    return logs.ship(raw_logs(spark, sf_dir)).withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).drop("ts")


@query("L10", "SELECT event_type AS service, count(*) AS n FROM events WHERE user_id % 5 <> 0 GROUP BY 1")
def opt_in_filter(spark, sf_dir):
    return logs.keep_enabled(raw_logs(spark, sf_dir), "enabled").groupBy("service").agg(F.count(F.lit(1)).alias("n"))


@query("L11", "SELECT CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'svc-' || event_type END AS container, count(*) AS n FROM events GROUP BY 1")
def relabel(spark, sf_dir):
    return raw_logs(spark, sf_dir).groupBy(logs.container_name("name").alias("container")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "L12",
    f"""SELECT event_type AS service, CASE WHEN user_id % 7 = 0 THEN NULL WHEN event_type = 'error' THEN 'stderr' ELSE 'stdout' END AS stream,
    count(*) AS n, sum(length(CASE WHEN user_id % 7 = 0 THEN 'plain fatal text ' || event_id ELSE {TEXT_SQL} END))::bigint AS characters FROM events GROUP BY 1, 2""",
)
def envelope_unwrap(spark, sf_dir):
    df = logs.unwrap_envelope(raw_logs(spark, sf_dir))
    return df.groupBy("service", "stream").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("characters"))


def document_lines(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return df.select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("n", "line"))


DOC_LINES_SQL = "doc_lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)"


@query(
    "L13",
    """SELECT CASE WHEN user_id % 7 = 0 THEN 'fatal' WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' THEN 'Info' WHEN event_type = 'view' THEN 'Warning' END AS level,
    count(*) AS n FROM events GROUP BY 1""",
)
def level_extraction(spark, sf_dir):
    lines = logs.unwrap_envelope(raw_logs(spark, sf_dir))
    return lines.groupBy(logs.level("line").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "L14",
    f"WITH {DOC_LINES_SQL} SELECT doc_id, count(*) AS lines FROM doc_lines WHERE NOT regexp_matches(line, '^[ \\t\\n\\r\\f\\v]*$') GROUP BY 1",
)
def blank_lines_dropped(spark, sf_dir):
    return logs.drop_blank(document_lines(spark, sf_dir)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "L1",
    f"""WITH {SHIPPED_SQL} SELECT service, stream, count(*) AS n FROM shipped WHERE project = 'lab' AND coalesce(container, '') <> '' AND service IN ('error', 'view', 'purchase') AND stream IS NOT NULL GROUP BY 1, 2""",
)
def stream_selector(spark, sf_dir):
    matchers = [("project", "=", "lab"), ("container", "=~", ".+"), ("service", "=~", "error|view|purchase"), ("stream", "!=", "")]
    kept = logs.select_streams(logs.ship(raw_logs(spark, sf_dir)), matchers)
    return kept.groupBy("service", "stream").agg(F.count(F.lit(1)).alias("n"))


@query("L2", f"WITH {DOC_LINES_SQL} SELECT source, count(*) AS n FROM doc_lines WHERE contains(line, 'the') GROUP BY 1")
def line_contains(spark, sf_dir):
    return logs.line_contains(document_lines(spark, sf_dir), "the").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "L3",
    f"WITH {SHIPPED_SQL} SELECT service, count(*) AS n FROM shipped WHERE regexp_matches(line, '(?i)(error|exception|critical|fatal|traceback)') GROUP BY 1",
)
def error_lines(spark, sf_dir):
    return logs.line_matches(logs.ship(raw_logs(spark, sf_dir)), logs.ERRORS).groupBy("service").agg(F.count(F.lit(1)).alias("n"))


@query(
    "L4",
    f"""WITH {SHIPPED_SQL} SELECT service, count(*) AS n, min(line) AS first_line FROM shipped WHERE regexp_matches(line, '(?i)(warn|warning)') AND NOT regexp_matches(line, '(?i)(error|critical|fatal)') GROUP BY 1""",
)
def warning_lines(spark, sf_dir):
    df = logs.warnings_only(logs.ship(raw_logs(spark, sf_dir)))
    return df.groupBy("service").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first_line"))


PROPS = T.StructType([T.StructField("k", T.DoubleType())])


def prop_lines(spark, sf_dir):
    """Event properties as log lines; every seventh user writes something that is no JSON."""
    df = events(spark, sf_dir)
    line = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("broken "), "props")).otherwise(F.col("props"))
    return df.select("event_id", "ts", "event_type", line.alias("line"))


PROPS_SQL = """prop_lines AS (SELECT event_id, epoch_us(ts) AS us, event_type, user_id % 7 = 0 AS parse_error,
  CASE WHEN user_id % 7 <> 0 THEN json_extract(props, '$.k')::double END AS k FROM events)"""


@query("L5", f"WITH {PROPS_SQL} SELECT event_id, k, parse_error FROM prop_lines")
def json_labels(spark, sf_dir):
    return logs.parse_json(prop_lines(spark, sf_dir), PROPS).select("event_id", "k", "parse_error")


def mixed_lines(spark, sf_dir):
    """Log lines of several shapes: event properties, who and what nested, a list, and texts that are no objects."""
    df = events(spark, sf_dir)
    who = F.concat(F.lit('{"who": {"id": '), F.col("user_id"), F.lit(', "is": {"kind": "'), F.col("event_type"), F.lit('"}}, "tags": [1], "none": null, "big": '), F.col("user_id") > 75, F.lit("}"))
    line = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("broken "), "props")).when(F.col("user_id") % 7 == 1, F.lit("[1, 2]")).when(F.col("user_id") % 7 < 4, who)
    return df.select("event_id", "ts", "event_type", line.otherwise(F.col("props")).alias("line"))


@query(
    "L5",
    """WITH e AS (SELECT event_id, user_id, event_type, user_id % 7 AS m, json_extract_string(props, '$.k') AS k FROM events)
    SELECT event_id, 'k' AS label, k AS value FROM e WHERE m >= 4 AND k IS NOT NULL UNION ALL SELECT event_id, 'who_id', user_id::varchar FROM e WHERE m IN (2, 3)
    UNION ALL SELECT event_id, 'who_is_kind', event_type FROM e WHERE m IN (2, 3) UNION ALL SELECT event_id, 'big', (user_id > 75)::varchar FROM e WHERE m IN (2, 3)
    UNION ALL SELECT event_id, '__error__', 'JSONParserErr' FROM e WHERE m < 2""",
)
def discovered_labels(spark, sf_dir):
    """Labels of lines without a schema: nested fields joined by _, no lists and no nulls."""
    return logs.discovered_labels(mixed_lines(spark, sf_dir), ["event_id"])


@query(
    "L5, L6",
    """WITH e AS (SELECT event_id, user_id % 7 AS m, user_id, TRY_CAST(json_extract_string(props, '$.k') AS bigint) AS k FROM events)
    SELECT event_id, CASE WHEN m >= 4 THEN k END::double AS k, CASE WHEN m IN (2, 3) THEN user_id END::double AS who_id, NULL::double AS kind, m < 2 AS parse_error FROM e""",
)
def unwrapped_fields(spark, sf_dir):
    """Chosen fields by path and type; missing and mistyped ones are NULL."""
    found = logs.unwrap(mixed_lines(spark, sf_dir), {"k": ("$.k", "bigint"), "who_id": ("$.who.id", "bigint"), "kind": ("$.who.is.kind", "double")})
    return found.select("event_id", F.col("k").cast("double"), F.col("who_id").cast("double"), "kind", "parse_error")


@query(
    "L6",
    f"""WITH {PROPS_SQL} SELECT event_type, t, arg_max(k, us) FILTER (WHERE k IS NOT NULL) AS k FROM {instants_sql('prop_lines', 'event_type, k', 24 * HOUR, 6 * HOUR)} GROUP BY 1, 2""",
)
def last_over_time(spark, sf_dir):
    parsed = logs.parse_json(prop_lines(spark, sf_dir), PROPS)
    return series.last_over_time(parsed, ["event_type"], ["k"], 24 * HOUR, 6 * HOUR)


@query(
    "L7",
    f"""WITH logs AS (SELECT epoch_us(ts) AS us, event_type FROM events) SELECT event_type, t, round(count(*) / 7200.0::double, 9) AS value
    FROM {instants_sql('logs', 'event_type', 2 * HOUR, HOUR)} GROUP BY 1, 2""",
)
def line_rate(spark, sf_dir):
    out = logs.line_rate(events(spark, sf_dir), ["event_type"], 2 * HOUR, HOUR)
    return out.withColumn("value", F.round("value", 9))


COUNTS_SQL = f"""logs AS (SELECT epoch_us(ts) AS us, event_type FROM events), c AS (SELECT event_type, t, count(*) AS lines FROM {instants_sql('logs', 'event_type', 600, 600)} GROUP BY 1, 2),
full_grid AS (SELECT event_type, unnest(range(min(t), max(t) + 600, 600)) AS t FROM c GROUP BY 1), counts AS (SELECT g.event_type, g.t, coalesce(c.lines, 0) AS lines FROM full_grid g LEFT JOIN c USING (event_type, t))"""


@query("L8", f"WITH {COUNTS_SQL} SELECT event_type, t, lines FROM counts")
def count_over_time(spark, sf_dir):
    return logs.count_over_time(events(spark, sf_dir), ["event_type"], 600)


@query("L8", f"WITH {COUNTS_SQL} SELECT event_type, t FROM counts WHERE lines = 0")
def stalled_steps(spark, sf_dir):
    return logs.stalls(logs.count_over_time(events(spark, sf_dir), ["event_type"], 600), ["event_type"])


@query(
    "L9",
    f"""WITH {SHIPPED_SQL} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, service, line FROM shipped WHERE ts >= timestamp '2024-01-10' AND ts <= timestamp '2024-01-20'
    AND regexp_matches(line, '(?i)(error|exception|critical|fatal|traceback)') ORDER BY ts DESC LIMIT 100""",
)
def recent_errors(spark, sf_dir):
    df = logs.recent(logs.ship(raw_logs(spark, sf_dir)), logs.ERRORS, "2024-01-10", "2024-01-20", 100)
    return df.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "service", "line")


# ---- feature retrieval -------------------------------------------------------------------------


def purchases(spark, sf_dir):
    df = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return df.select("user_id", F.col("ts").alias("bought_at"), F.col("value").alias("amount"), F.col("event_id").alias("purchase_id"))


def errors(spark, sf_dir):
    return table(spark, sf_dir, "events").where(F.col("event_type") == "error").select("event_id", "user_id", "ts")


ASOF_SQL = """s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'), f AS (SELECT user_id, ts AS bought_at, value AS amount FROM events WHERE event_type = 'purchase'),
hits AS (SELECT s.event_id, s.user_id, s.ts, f.amount, f.bought_at FROM s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.ts >= f.bought_at)"""


@query("FS1", f"WITH {ASOF_SQL} SELECT event_id, user_id, amount, epoch_us(bought_at)::double AS bought_us FROM hits")
def point_in_time(spark, sf_dir):
    out = featurestore.point_in_time(errors(spark, sf_dir), purchases(spark, sf_dir), "user_id", "ts", "bought_at", ["amount"])
    us = F.unix_micros(F.col("feature_timestamp").cast("timestamp")).cast("double")
    return out.select("event_id", "user_id", "amount", us.alias("bought_us"))


@query(
    "FS1",
    f"WITH {ASOF_SQL} SELECT event_id, user_id, CASE WHEN bought_at >= ts - INTERVAL 2 DAY THEN amount END AS amount FROM hits",
)
def point_in_time_ttl(spark, sf_dir):
    out = featurestore.point_in_time(
        errors(spark, sf_dir), purchases(spark, sf_dir), "user_id", "ts", "bought_at", ["amount"], ttl="2 days"
    )
    return out.select("event_id", "user_id", "amount")


@query(
    "FS1",
    """WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'), p AS (SELECT user_id, ts, value, event_id FROM events WHERE event_type = 'purchase'),
    v AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view'), c AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click'),
    a AS (SELECT s.event_id, p.value AS amount, p.event_id AS purchase FROM s ASOF LEFT JOIN p ON s.user_id = p.user_id AND s.ts >= p.ts),
    b AS (SELECT s.event_id, CASE WHEN v.ts >= s.ts - INTERVAL 1 DAY THEN v.value END AS viewed FROM s ASOF LEFT JOIN v ON s.user_id = v.user_id AND s.ts >= v.ts),
    d AS (SELECT s.event_id, CASE WHEN c.ts >= s.ts - INTERVAL 6 HOUR THEN c.event_id END AS click FROM s ASOF LEFT JOIN c ON s.user_id = c.user_id AND s.ts >= c.ts)
    SELECT event_id, amount, purchase::double AS purchase, viewed, click::double AS click FROM a JOIN b USING (event_id) JOIN d USING (event_id)""",
)
def point_in_time_views(spark, sf_dir):
    """Three feature views with their own time to live, joined to the spine in one shuffle."""
    df = table(spark, sf_dir, "events")
    of = lambda kind: df.where(F.col("event_type") == kind).select("user_id", F.col("ts").alias("at"), "value", "event_id")
    views = [
        featurestore.View("purchase", of("purchase"), "at", ["value", "event_id"]),
        featurestore.View("view", of("view"), "at", ["value"], "1 day"),
        featurestore.View("click", of("click"), "at", ["event_id"], "6 hours"),
    ]
    out = featurestore.point_in_time_views(errors(spark, sf_dir), views, "user_id", "ts")
    return out.select(
        "event_id", F.col("purchase__value").alias("amount"), F.col("purchase__event_id").cast("double").alias("purchase"),
        F.col("view__value").alias("viewed"), F.col("click__event_id").cast("double").alias("click"),
    )


LATEST_SQL = "SELECT user_id, arg_max(value, ts) AS amount, arg_max(event_id, ts) AS purchase_id FROM events WHERE event_type = 'purchase'{more} GROUP BY 1"
VALUES = ["amount", "purchase_id"]


@query("FS2", LATEST_SQL.format(more=""))
def latest_features(spark, sf_dir):
    return featurestore.latest(purchases(spark, sf_dir), "user_id", "bought_at", VALUES).drop("bought_at")


@query("FS3", LATEST_SQL.format(more=" AND ts <= timestamp '2024-01-25'"))
def refreshed_features(spark, sf_dir):
    """A snapshot as of the 15th brought forward to the 25th equals the snapshot of the 25th."""
    df = purchases(spark, sf_dir)
    first = featurestore.latest(df.where(F.col("bought_at") <= F.lit("2024-01-15").cast("timestamp_ntz")), "user_id", "bought_at", VALUES)
    out = featurestore.refresh(first, df, "user_id", "bought_at", VALUES, "2024-01-15", "2024-01-25")
    return out.drop("bought_at")


@query(
    "FS4",
    f"""WITH latest AS ({LATEST_SQL.format(more='')}) SELECT c.c_custkey, c.c_acctbal, l.amount, l.purchase_id::double AS purchase_id FROM customer c LEFT JOIN latest l ON c.c_custkey = l.user_id""",
)
def feature_lookup(spark, sf_dir):
    snapshot = featurestore.latest(purchases(spark, sf_dir), "user_id", "bought_at", VALUES)
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    out = featurestore.lookup(asked, snapshot, "user_id")
    return out.select(F.col("user_id").alias("c_custkey"), "c_acctbal", "amount", F.col("purchase_id").cast("double").alias("purchase_id"))


@query(
    "FS4, T9",
    f"""WITH latest AS ({LATEST_SQL.format(more='')}) SELECT c.c_custkey, c.c_acctbal, l.amount, l.purchase_id::double AS purchase_id FROM customer c LEFT JOIN latest l ON c.c_custkey = l.user_id""",
)
def stored_feature_lookup(spark, sf_dir):
    """The lookup on a table bucketed by its entity: the stored side is not shuffled."""
    snapshot = featurestore.latest(purchases(spark, sf_dir), "user_id", "bought_at", VALUES)
    name = f"features_{uuid.uuid4().hex[:12]}"
    featurestore.store(snapshot, name, "user_id", int(spark.conf.get("spark.sql.shuffle.partitions")), shared_dir(spark, "features"))
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    out = featurestore.stored_lookup(asked, name, "user_id")
    return out.select(F.col("user_id").alias("c_custkey"), "c_acctbal", "amount", F.col("purchase_id").cast("double").alias("purchase_id"))


# Rules over the event counter: (alert, metric, matchers, function, range in s, sum by, above, below, wait in s, severity, text).
EVENT_RULES = [
    ("HighRate", "events_value_total", [("type", "!=", "view")], "rate", 12 * HOUR, [], 0.02, None, 12 * HOUR, "warning", "{{type}}/{{shard}} at {{value:fixed}}"),
    ("BusyType", "events_value_total", [], "rate", 12 * HOUR, ["type"], 0.11, None, 0, "critical", "{{type}}{{shard}} is busy"),
    ("Moved", "events_value_total", [("type", "=~", "err.*"), ("shard", "!~", "[1-9]")], "changes", 6 * HOUR, [], 0.0, None, 6 * HOUR, "info", "moved {{value}}"),
    ("Quiet", "events_value_total", [("type", "=", "signup")], "rate", 12 * HOUR, ["type"], None, 0.09, 0, "info", "quiet"),
    ("Missing", "no_such_metric", [], "last", 6 * HOUR, [], 0.0, None, 0, "info", "never"),
]


def rule_sql(alert, rows, wait, severity):
    """Transitions of one rule from its breaches (who, t)."""
    step, w = 6 * HOUR, wait
    last = "(SELECT max(epoch_us(ts)) // 21600000000 * 21600 FROM events)"
    return f"""SELECT '{alert}' AS alert, '{severity}' AS severity, who, state, at_s FROM (WITH b AS ({rows}),
    i AS (SELECT who, min(t) AS a, max(t) AS b FROM (SELECT who, t, t - {step} * row_number() OVER (PARTITION BY who ORDER BY t) AS island FROM b) GROUP BY who, island)
    SELECT who, 'pending' AS state, a AS at_s FROM i WHERE {w} > 0 UNION ALL SELECT who, 'firing', a + {w} FROM i WHERE b - a >= {w}
    UNION ALL SELECT who, 'resolved', b + {step} FROM i WHERE b - a >= {w} AND b + {step} <= {last})"""


RULES_SQL = " UNION ALL ".join(
    [
        rule_sql("HighRate", "SELECT type || '/' || shard AS who, t FROM rates WHERE type <> 'view' AND value > 0.02", 12 * HOUR, "warning"),
        rule_sql("BusyType", "SELECT type AS who, t FROM rates GROUP BY type, t HAVING sum(value) > 0.11", 0, "critical"),
        rule_sql("Moved", "SELECT type || '/' || shard AS who, t FROM moved WHERE value > 0", 6 * HOUR, "info"),
        rule_sql("Quiet", "SELECT type AS who, t FROM rates WHERE type = 'signup' GROUP BY type, t HAVING sum(value) < 0.09", 0, "info"),
    ]
)


@query(
    "TS10, TS11, TS13",
    f"""WITH {RATES_SQL}, chg AS (SELECT type, shard, us, CASE WHEN value <> lag(value) OVER (PARTITION BY type, shard ORDER BY ts) THEN 1 ELSE 0 END AS m FROM cnt WHERE type LIKE 'err%' AND shard = '0'),
    moved AS (SELECT type, shard, t, sum(m) - arg_min(m, us) AS value FROM {instants_sql('chg', 'type, shard, m', 6 * HOUR, 6 * HOUR)} GROUP BY 1, 2, 3) {RULES_SQL}""",
)
def rule_table_alerts(spark, sf_dir):
    """Five rules of different functions and label sums, evaluated by one plan over samples read once."""
    table_of_rules = spark.createDataFrame(EVENT_RULES, rules.RULES)
    df = events(spark, sf_dir)
    until = df.agg(F.floor(F.unix_seconds(F.max("ts")) / (6 * HOUR)).cast("long") * 6 * HOUR).scalar()
    found = rules.transitions(counter(spark, sf_dir).select("ts", "metric", "labels", "value"), table_of_rules, 6 * HOUR, until=until, times=df)
    who = F.concat_ws("/", F.col("labels")["type"], F.col("labels")["shard"])
    return found.select("alert", "severity", who.alias("who"), "state", F.col("at").alias("at_s"))
