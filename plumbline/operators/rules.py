"""Alert rules as rows: one plan evaluates all of them over samples that are read once.

A rule has an alert name, a metric, label matchers, a function over a range (last, rate, increase or
changes), labels to sum by (empty: each series on its own), one or two bounds, a waiting time, a severity
and a text. The value breaches above `above` or below `below`. Texts name labels as {{label}} and the
value as {{value}}, {{value:human}}, {{value:percent}} or {{value:fixed}}.

Samples are summed into buckets of one step per series before any rule sees them, and the table of rules, which is
written by hand, goes to every task: the samples of one metric, which may be all there are, never meet in one
task. Adding a rule adds rows, not scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.operators import series
from plumbline.operators.ordered import SLICE, order_slices, previous_row

RULES = (
    "alert string, metric string, matchers array<struct<label: string, op: string, value: string>>, func string, range_s long, "
    "sum_by array<string>, above double, below double, wait_s long, severity string, summary string"
)
FUNCTIONS = ("last", "rate", "increase", "changes")


def _matches(labels: Column, matchers: Column) -> Column:
    def one(m: Column) -> Column:
        value, pattern = F.coalesce(F.try_element_at(labels, m["label"]), F.lit("")), F.concat(F.lit("^(?:"), m["value"], F.lit(")$"))
        same, like = value == m["value"], F.rlike(value, pattern)
        return F.when(m["op"] == "=", same).when(m["op"] == "!=", ~same).when(m["op"] == "=~", like).when(m["op"] == "!~", ~like).otherwise(
            F.raise_error(F.concat(F.lit("unknown matcher "), m["op"])).cast("boolean")
        )

    return F.forall(F.coalesce(matchers, F.array().cast("array<struct<label: string, op: string, value: string>>")), one)


def values(samples: DataFrame, rules: DataFrame, step_s: int, times: DataFrame | None = None) -> DataFrame:
    """(alert, labels, t, value) of every rule at every multiple of step_s whose range holds samples.

    samples: ts, metric, labels map, value. Ranges are multiples of step_s. `times`: a cheap frame with
    a column ts that spreads like the samples. last and changes need one sample, rate and increase two.
    """
    ruled = F.broadcast(rules.select("metric"))
    known = samples.where(F.col("ts").isNotNull() & F.col("value").isNotNull()).join(ruled, "metric", "left_semi")
    known = known.select("metric", series.series_key().alias("series"), "ts", "value")
    sliced = known.withColumn(SLICE, order_slices(known if times is None else times, "ts"))
    rows = previous_row(sliced, ["metric", "series"], SLICE, ["ts"], ["value"])
    before, now = F.col("prev.value"), F.col("value")
    us, width = F.unix_micros(F.col("ts").cast("timestamp")), step_s * 1_000_000
    ends = F.floor((us + F.lit(width - 1)) / F.lit(width)).cast("long") * step_s
    moves = {"up": F.when(now < before, now).otherwise(now - before), "moved": (before.isNotNull() & (now != before)).cast("long")}
    buckets = rows.withColumns(moves | {"us": us, "ends": ends}).groupBy("metric", "series", "ends").agg(
        F.count(F.lit(1)).alias("n"), F.sum("up").alias("up"), F.min_by("up", "us").alias("up0"),
        F.sum("moved").alias("moved"), F.min_by("moved", "us").alias("moved0"), F.min("us").alias("from"), F.max("us").alias("to"), F.max_by("value", "us").alias("last"),
    )
    labels = F.from_json("series", samples.schema["labels"].dataType)
    matched = buckets.join(F.broadcast(rules.select("alert", "metric", "matchers", "func", "range_s", "sum_by")), "metric").where(_matches(labels, F.col("matchers")))
    held = matched.withColumn("t", F.explode(F.sequence(F.col("ends"), F.col("ends") + F.col("range_s") - step_s, F.lit(step_s).cast("long"))))
    inside = held.groupBy("alert", "func", "range_s", "sum_by", "series", "t").agg(
        F.sum("n").alias("n"), (F.sum("up") - F.coalesce(F.min_by("up0", "from"), F.lit(0.0))).alias("up"),
        (F.sum("moved") - F.min_by("moved0", "from")).alias("moved"), (F.max("to") - F.min("from")).alias("span"), F.max_by("last", "to").alias("last"),
    ).withColumn("labels", labels)
    two = (F.col("n") >= 2) & (F.col("span") > 0)
    value = (
        F.when(F.col("func") == "last", F.col("last")).when(F.col("func") == "changes", F.col("moved").cast("double"))
        .when(F.col("func") == "rate", F.when(two, F.col("up") * 1e6 / F.col("span"))).when(F.col("func") == "increase", F.when(two, F.col("up")))
    )
    some = F.map_filter("labels", lambda k, _: F.array_contains("sum_by", k))
    kept = F.when(F.size("sum_by") > 0, some).otherwise(F.col("labels"))
    single = inside.select("alert", "t", kept.alias("labels"), value.alias("value")).where(F.col("value").isNotNull())
    total = single.withColumn("series", series.series_key()).groupBy("alert", "series", "t").agg(F.first("labels").alias("labels"), F.sum("value").alias("value"))
    return total.select("alert", "labels", "t", "value")


def filled(text: Column, labels: Column, value: Column) -> Column:
    """The text with labels and the value put in; an absent label is empty."""
    forms = {"": value.cast("string"), ":human": C.human_number(value), ":percent": C.percent_text(value), ":fixed": C.fixed3(value)}
    for form, shown in forms.items():
        text = F.replace(text, F.lit("{{value" + form + "}}"), F.coalesce(shown, F.lit("")))
    named = F.aggregate(F.map_entries(labels), text, lambda t, e: F.replace(t, F.concat(F.lit("{{"), e["key"], F.lit("}}")), e["value"]))
    return F.regexp_replace(named, r"\{\{[A-Za-z_]\w*\}\}", "")


def transitions(samples: DataFrame, rules: DataFrame, step_s: int = 60, *, until: int | Column, times: DataFrame | None = None) -> DataFrame:
    """(alert, severity, labels, state, at, summary): pending, firing and resolved of all rules.

    The text of a transition shows the value at that instant, or at the last breach once it is over.
    """
    plain = rules.select("alert", "above", "below", "wait_s", "severity", "summary")
    found = values(samples, rules, step_s, times).join(F.broadcast(plain), "alert")
    out = found.where((F.col("value") > F.col("above")) | (F.col("value") < F.col("below"))).withColumn("series", series.series_key())
    moves = series.alert_states(out.select("alert", "series", "wait_s", "t"), ["alert", "series", "wait_s"], step_s, F.col("wait_s"), until=until)
    at = F.when(F.col("state") == "resolved", F.col("at") - step_s).otherwise(F.col("at"))
    shown = out.select("alert", "series", "labels", F.col("t").alias("shown_at"), "value", "severity", "summary")
    joined = moves.withColumn("shown_at", at).join(shown, ["alert", "series", "shown_at"])
    return joined.select("alert", "severity", "labels", "state", "at", filled(F.col("summary"), F.col("labels"), F.col("value")).alias("summary"))
