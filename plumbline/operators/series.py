"""Metric time series: label matching, rates over ranges, vector operations and alert states.

Samples are rows with a timestamp `ts`, columns that identify the series, and `value`.
Range functions evaluate on a grid of instants (epoch seconds, column `t`); the range of an
instant is left-open and right-closed. A series is never sorted in one task: previous samples
are found per (series, time slice).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.ordered import SLICE, order_slices, previous_row, running_sums

EVALUATIONS_PER_SLICE = 10_000
DROPPED_METRICS = "container_(tasks_state|memory_failures_total)"  # fixed value


def label(name: str, labels: str = "labels") -> Column:
    """Label value; an absent label is the empty string."""
    return F.coalesce(F.try_element_at(F.col(labels), F.lit(name)), F.lit(""))


def series_key(labels: str = "labels") -> Column:
    """Labels as one comparable text, whatever their order in the map."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def label_match(value: Column, op: str, wanted: str) -> Column:
    """The matchers = != =~ !~; patterns match the whole value."""
    anchored = f"^(?:{wanted})$"
    return {
        "=": lambda: value == wanted,
        "!=": lambda: value != wanted,
        "=~": lambda: value.rlike(anchored),
        "!~": lambda: ~value.rlike(anchored),
    }[op]()


def select_series(df: DataFrame, matchers: Sequence[tuple[str, str, str]], labels: str = "labels") -> DataFrame:
    """Samples that satisfy every (label, op, value) matcher; __name__ is the metric name."""
    for name, op, wanted in matchers:
        value = F.col("metric") if name == "__name__" else label(name, labels)
        df = df.where(label_match(value, op, wanted))
    return df


def by_bucket(df: DataFrame, by: Sequence[str], range_s: int, step_s: int, partial: Sequence[Column], ts: str = "ts") -> DataFrame:
    """`partial` aggregates per series and bucket, a bucket ending at __end (epoch seconds).

    Buckets are as wide as the greatest common divisor of range and step, so every range is a whole
    number of them and rows are aggregated once, however many ranges hold them. `__us` is the time of a row.
    """
    width = math.gcd(range_s, step_s)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    past = F.pmod("__us", F.lit(width * 1_000_000))
    end = (F.col("__us") - past) / 1_000_000 + F.when(past > 0, width).otherwise(0)
    timed = df.withColumn("__us", us).where("__us IS NOT NULL").withColumn("__end", end.cast("bigint"))
    return timed.groupBy(*by, "__end").agg(*partial)


def at_instants(buckets: DataFrame, range_s: int, step_s: int) -> DataFrame:
    """Each bucket once per instant t (a multiple of step_s) whose range (t - range_s, t] holds it."""
    first = F.ceil(F.col("__end") / step_s)
    last = F.ceil((F.col("__end") + range_s) / step_s) - 1
    grid = F.sequence(first * step_s, last * step_s, F.lit(step_s).cast("bigint"))
    return buckets.where(first <= last).withColumn("t", F.explode(grid)).drop("__end")


def with_increase(
    df: DataFrame, by: Sequence[str], ts: str = "ts", value: str = "value", times: DataFrame | None = None
) -> DataFrame:
    """Adds `increase` since the previous sample of the series; after a reset the whole value counts.

    Slice bounds come from column `ts` of `times`, a frame that is cheap to read and spreads over
    time like df (default: df itself).
    """
    sliced = df.withColumn(SLICE, order_slices(df if times is None else times, ts))
    out = previous_row(sliced, by, SLICE, [ts], [value])
    before, now = F.col(f"prev.{value}"), F.col(value)
    return out.withColumn("increase", F.when(now < before, now).otherwise(now - before)).drop(SLICE, "prev")


def rate(
    df: DataFrame,
    by: Sequence[str],
    range_s: int,
    step_s: int,
    ts: str = "ts",
    value: str = "value",
    times: DataFrame | None = None,
) -> DataFrame:
    """Per-second increase per series and instant, over the span between its first and last sample.

    At least two samples are needed. No extrapolation to the edges of the range.
    """
    partial = [
        F.count(F.lit(1)).alias("__n"),
        F.sum("increase").alias("__up"),
        F.min_by("increase", "__us").alias("__first"),
        F.min("__us").alias("__from"),
        F.max("__us").alias("__to"),
    ]
    rows = with_increase(df, by, ts, value, times)
    out = at_instants(by_bucket(rows, by, range_s, step_s, partial, ts), range_s, step_s).groupBy(*by, "t").agg(
        F.sum("__n").alias("samples"),
        (F.sum("__up") - F.coalesce(F.min_by("__first", "__from"), F.lit(0.0))).alias("__up"),
        (F.max("__to") - F.min("__from")).alias("__span"),
    )
    return out.where((F.col("samples") >= 2) & (F.col("__span") > 0)).select(
        *by, "t", (F.col("__up") * 1e6 / F.col("__span")).alias("value")
    )


def changes(
    df: DataFrame, by: Sequence[str], range_s: int, step_s: int, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """How often the value changed between consecutive samples of the range."""
    sliced = df.withColumn(SLICE, order_slices(df, ts))
    out = previous_row(sliced, by, SLICE, [ts], [value])
    moved = (F.col("prev").isNotNull() & ~F.col(f"prev.{value}").eqNullSafe(F.col(value))).cast("bigint")
    partial = [F.sum("__m").alias("__moved"), F.min_by("__m", "__us").alias("__first"), F.min("__us").alias("__from")]
    buckets = by_bucket(out.withColumn("__m", moved), by, range_s, step_s, partial, ts)
    inside = at_instants(buckets, range_s, step_s)
    return inside.groupBy(*by, "t").agg((F.sum("__moved") - F.min_by("__first", "__from")).alias("value"))


def last_over_time(
    df: DataFrame, by: Sequence[str], fields: Sequence[str], range_s: int, step_s: int, ts: str = "ts"
) -> DataFrame:
    """Latest non-NULL value of each field per series and instant."""
    seen = {f: F.when(F.col(f).isNotNull(), F.col("__us")) for f in fields}
    partial = [c for f in fields for c in (F.max_by(f, seen[f]).alias(f), F.max(seen[f]).alias(f"__at_{f}"))]
    inside = at_instants(by_bucket(df, by, range_s, step_s, partial, ts), range_s, step_s)
    return inside.groupBy(*by, "t").agg(*[F.max_by(f, f"__at_{f}").alias(f) for f in fields])


REDUCERS = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}


def aggregate(vector: DataFrame, how: str, by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """sum / max / min / avg / count by labels at each instant; other labels go."""
    return vector.groupBy("t", *by).agg(REDUCERS[how](value).alias(value))


def topk(vector: DataFrame, k: int, ties: Sequence[str], value: str = "value") -> DataFrame:
    """The k largest per instant; ties go to the lower label. The rank filter also runs before the shuffle."""
    w = Window.partitionBy("t").orderBy(F.desc(value), *ties)
    return vector.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= k).drop("__rank")


def sort_desc(vector: DataFrame, value: str = "value") -> DataFrame:
    return vector.orderBy(F.desc(value))


def ratio(
    left: DataFrame, right: DataFrame, on: Sequence[str], above: float | None = None, value: str = "value"
) -> DataFrame:
    """left / right for series with equal labels at the same instant; NULL when right is 0 (no limit set)."""
    joined = left.select("t", *on, F.col(value).alias("__l")).join(
        right.select("t", *on, F.col(value).alias("__r")), ["t", *on]
    )
    out = joined.select("t", *on, F.try_divide("__l", "__r").alias(value))
    return out if above is None else out.where(F.col(value) > above)


def either(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows, and right rows whose labels (and instant) the left side does not have."""
    return left.unionByName(right.join(left.select("t", *on), ["t", *on], "left_anti"))


def staleness(df: DataFrame, by: Sequence[str], as_of: str, limit_s: int = 172_800, ts: str = "ts") -> DataFrame:
    """Seconds between as_of and the newest sample, and whether that exceeds the limit."""
    newest = df.groupBy(*by).agg(F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("__us"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.col("__us")) / 1e6
    return newest.select(*by, F.round(age, 3).alias("age_s"), (age > limit_s).alias("stale"))


def breach_runs(breaches: DataFrame, by: Sequence[str], step_s: int) -> DataFrame:
    """Runs of consecutive evaluation instants at which a rule held: start, end, evaluations."""
    sliced = breaches.withColumn(SLICE, F.floor(F.col("t") / (step_s * EVALUATIONS_PER_SLICE)))
    marked = previous_row(sliced, by, SLICE, ["t"], ["t"])
    starts = F.when(F.col("prev.t") == F.col("t") - step_s, 0).otherwise(1).cast("bigint")
    numbered = running_sums(
        marked.withColumn("__new", starts).drop("prev"), by, SLICE, [F.col("t")], {"run": "__new"}
    )
    return numbered.groupBy(*by, "run").agg(
        F.min("t").alias("start"), F.max("t").alias("end"), F.count(F.lit(1)).alias("evaluations")
    )


def alert_states(
    breaches: DataFrame, by: Sequence[str], step_s: int = 60, for_s: int | Column = 0, *, until: int | Column
) -> DataFrame:
    """Transitions (state, at) of each run: pending at its start, firing once it lasted for_s, and
    resolved at the first evaluation after a run that fired. Without a waiting time firing is immediate.

    `until` is the last evaluation instant: a run that reaches it is not resolved.
    """
    wait = for_s if isinstance(for_s, Column) else F.lit(for_s)
    wait = F.ceil(wait / F.lit(step_s)) * step_s
    runs = breach_runs(breaches, by, step_s)
    fired = F.col("end") - F.col("start") >= wait
    over = F.col("end") + step_s <= (until if isinstance(until, Column) else F.lit(until))
    steps = F.array_compact(
        F.array(
            F.when(wait > 0, F.struct(F.lit("pending").alias("state"), F.col("start").alias("at"))),
            F.when(fired, F.struct(F.lit("firing").alias("state"), (F.col("start") + wait).alias("at"))),
            F.when(fired & over, F.struct(F.lit("resolved").alias("state"), (F.col("end") + step_s).alias("at"))),
        )
    )
    return runs.select(*by, F.explode(steps).alias("s")).select(*by, "s.state", "s.at")


def label_values(df: DataFrame, column: str | Column) -> DataFrame:
    """Distinct non-empty values in order (the content of a selection list)."""
    value = F.col(column) if isinstance(column, str) else column
    return df.select(value.alias("value")).where(F.col("value") != "").distinct().orderBy("value")


def panel(df: DataFrame, by: Sequence[str], value: str = "value", ts: str = "ts") -> DataFrame:
    """mean, max, sum and last non-NULL value per series."""
    return df.groupBy(*by).agg(
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
        F.sum(value).alias("sum"),
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(ts))).alias("last"),
    )


def scrape_filter(df: DataFrame, drop_pattern: str, external: dict[str, str] | None = None) -> DataFrame:
    """Drop samples whose metric name matches; add constant labels."""
    kept = df.where(~F.col("metric").rlike(f"^(?:{drop_pattern})$"))
    return kept.withColumns({k: F.lit(v) for k, v in (external or {}).items()})


def retain(df: DataFrame, as_of: str, keep: str = "1 day", ts: str = "ts") -> DataFrame:
    """Rows not older than `keep` at as_of; the bound is a constant, so it reaches the scan."""
    kind = df.schema[ts].dataType
    return df.where(F.col(ts) >= (F.lit(as_of).cast(kind) - F.expr(f"interval {keep}")))
