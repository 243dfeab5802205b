"""Data-quality checks, the scoring gate, score summaries, and the report built from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import schema as S
from plumbline.functions import columns as C
from plumbline.operators import drift as D
from plumbline.operators.clean import missing_names
from plumbline.operators.quantiles import quantiles

MAX_NULL_RATE = 0.5


def absent(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column."""
    kind = df.schema[name].dataType
    c = F.col(name)
    return c.isNull() | F.isnan(c) if isinstance(kind, (T.FloatType, T.DoubleType)) else c.isNull()


def missing_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected columns the table does not have, in expected order."""
    rows = [(i, c) for i, c in enumerate(expected) if c not in df.columns]
    return df.sparkSession.createDataFrame(rows, "position int, column string")


def null_rates(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    have = [c for c in expected if c in df.columns]
    one = df.agg(*[F.avg(absent(df, c).cast("double")).alias(c) for c in have])
    rows = [F.struct(F.lit(c).alias("feature"), F.round(c, 6).alias("null_rate")) for c in have]
    return one.select(F.inline(F.array(*rows)))


def constant_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Columns with at most one distinct value: min equals max, in one pass."""
    have = [c for c in expected if c in df.columns]
    present = lambda c: F.when(~absent(df, c), F.col(c))
    one = df.agg(*[F.min(present(c)).eqNullSafe(F.max(present(c))).alias(c) for c in have])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("constant")) for c in have]
    return one.select(F.inline(F.array(*rows))).where("constant").select("feature")


def _record_sums(df: DataFrame, have: Sequence[str]) -> list[Column]:
    present = lambda c: F.when(~absent(df, c), F.col(c))
    return [
        F.count(F.lit(1)).alias("row_count"),
        *[F.avg(absent(df, c).cast("double")).alias(f"n_{c}") for c in have],
        *[F.min(present(c)).eqNullSafe(F.max(present(c))).alias(f"k_{c}") for c in have],
    ]


def watched(df: DataFrame, expected: Sequence[str], name: str | Observation) -> DataFrame:
    """df whose quality is recorded by the job that writes it, batch or stream, without a scan of its own.

    Read the sums after the write from an Observation, or for a stream, where `name` is a text, from the
    progress of the query (observedMetrics), and turn them into a record with `record_of`. Take an
    Observation in a session of its own (spark.newSession()): Spark 4.1 can't ship models that keep a
    training summary from a session that has used one.
    """
    return df.observe(name, *_record_sums(df, [c for c in expected if c in df.columns]))


def record_of(sums: dict, expected: Sequence[str]) -> dict:
    """The record that quality_record gives, from the sums of `watched`."""
    have = [c for c in expected if f"n_{c}" in sums]
    rates = {c: None if sums[f"n_{c}"] is None else round(sums[f"n_{c}"], 6) for c in have}
    return {
        "row_count": sums["row_count"],
        "null_rates": rates,
        "missing_columns": [c for c in expected if c not in have],
        "constant_columns": [c for c in have if sums[f"k_{c}"]],
    }


def gate_of(record: dict, max_null_rate: float = MAX_NULL_RATE) -> dict:
    """The decision of scoring_gate, from a record: the written batch may be released or not."""
    high = [] if record["missing_columns"] else [c for c, r in record["null_rates"].items() if r is not None and r > max_null_rate]
    return {
        "is_valid": not high and not record["missing_columns"],
        "missing_columns": record["missing_columns"],
        "high_null_columns": high,
        "row_count": record["row_count"],
    }


def quality_record(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row, one pass: row_count, null_rates map, missing_columns, constant_columns."""
    have = [c for c in expected if c in df.columns]
    gone = missing_names(df, expected)
    one = df.agg(*_record_sums(df, have))
    rates = [x for c in have for x in (F.lit(c), F.round(f"n_{c}", 6))]
    fixed = F.array(*[F.when(F.col(f"k_{c}"), F.lit(c)) for c in have]) if have else F.array()
    return one.select(
        "row_count",
        F.create_map(*rates).cast("map<string,double>").alias("null_rates"),
        F.array(*[F.lit(c) for c in gone]).cast("array<string>").alias("missing_columns"),
        F.array_compact(fixed).cast("array<string>").alias("constant_columns"),
    )


def scoring_gate(df: DataFrame, expected: Sequence[str], max_null_rate: float = MAX_NULL_RATE) -> DataFrame:
    """One row: is_valid, missing_columns, high_null_columns, row_count.

    Null rates are looked at only when no column is missing; the bound is strict.
    """
    gone = missing_names(df, expected)
    if gone:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(False).alias("is_valid"),
            F.array(*[F.lit(c) for c in gone]).alias("missing_columns"),
            F.array().cast("array<string>").alias("high_null_columns"),
            "row_count",
        )
    record = quality_record(df, expected)
    high = F.filter(
        F.array(*[F.lit(c) for c in expected]), lambda c: F.element_at("null_rates", c) > max_null_rate
    )
    return record.select(
        (F.size(high) == 0).alias("is_valid"), "missing_columns", high.alias("high_null_columns"), "row_count"
    )


def score_summary(
    df: DataFrame, threshold: float = 0.5, score: str = "probability", deviation: str = "sample"
) -> DataFrame:
    """Mean, deviation, quartiles, share at or above the threshold, count; 6 places.

    deviation is sample (monitoring) or population (scorer). No rows without a score column.
    """
    std = {"sample": F.stddev_samp, "population": F.stddev_pop}[deviation]
    if score not in df.columns:
        empty = "mean_probability double, std_probability double, p25 double, p50 double, p75 double, pct_predicted_default double, record_count bigint"
        return df.sparkSession.createDataFrame([], empty)
    p25, p50, p75 = quantiles(df, {score: [0.25, 0.5, 0.75]})[score]
    return df.agg(
        F.round(F.avg(score), 6).alias("mean_probability"),
        F.round(std(score), 6).alias("std_probability"),
        *[F.round(F.lit(v).cast("double"), 6).alias(n) for n, v in (("p25", p25), ("p50", p50), ("p75", p75))],
        F.round(F.avg(C.decide(score, threshold).cast("double")), 6).alias("pct_predicted_default"),
        F.count(F.lit(1)).alias("record_count"),
    )


def check_quality(ctx: dict) -> DataFrame:
    return quality_record(ctx["features"], ctx["expected"])


def check_drift(ctx: dict) -> DataFrame:
    return D.drift_record(ctx.get("reference"), ctx["features"], ctx.get("numeric", []), ctx.get("categorical", []))


def check_scores(ctx: dict) -> DataFrame:
    scores = ctx["predictions"]
    if "probability" not in scores.columns:
        return scores.sparkSession.range(1).select(
            F.lit(True).alias("skipped"), F.lit("no probability column").alias("reason")
        )
    return score_summary(scores, ctx.get("threshold", 0.5))


CHECKS: dict[str, Callable[[dict], DataFrame]] = {
    "data_quality": check_quality,
    "feature_drift": check_drift,
    "score_distribution": check_scores,
}


def run_checks(ctx: dict, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """One-row DataFrame per registered check."""
    return {n: CHECKS[n](ctx) for n in (names or CHECKS)}


def build_report(checks: dict[str, DataFrame], ingestion_date: str, duration_seconds: float) -> DataFrame:
    """One row: date, duration and a struct of the one-row check records."""
    spark = next(iter(checks.values())).sparkSession
    sections = [frame.select(F.struct("*")).scalar().alias(name) for name, frame in checks.items()]
    return spark.range(1).select(
        F.lit(ingestion_date).alias("ingestion_date"),
        F.lit(duration_seconds).cast("double").alias("duration_seconds"),
        F.struct(*sections).alias("checks"),
    )


def typed_report(report: DataFrame) -> DataFrame:
    """A report as read back from its document: absent sections and fields are NULL."""
    return report.select(F.from_json(F.to_json(F.struct("*")), S.MONITORING_REPORT).alias("r")).select("r.*")


def flat_metrics(report: DataFrame) -> DataFrame:
    """The report as a map of metric name -> value; an absent section gives no entry."""
    r = typed_report(report)
    q, d, s = (F.col(f"checks.{n}") for n in ("data_quality", "feature_drift", "score_distribution"))
    rates, drifts = F.map_values(q["null_rates"]), F.map_values(d["per_feature_drift"])
    mean = F.aggregate(rates, F.lit(0.0), lambda a, x: a + x, lambda a: F.try_divide(a, F.size(rates).cast("double")))
    has_drift, has_scores = d["drift_share"].isNotNull(), s["mean_probability"].isNotNull()
    has_rates = q["null_rates"].isNotNull()
    entries = {
        "batch_duration_seconds": (F.lit(True), F.col("duration_seconds")),
        "batch_null_max": (has_rates, F.coalesce(F.array_max(rates), F.lit(0.0))),
        "batch_null_mean": (has_rates, F.coalesce(mean, F.lit(0.0))),
        "batch_row_count": (q["row_count"].isNotNull(), q["row_count"].cast("double")),
        "batch_drift_share": (has_drift, d["drift_share"]),
        "batch_drift_detected": (has_drift, d["overall_drift_detected"].cast("double")),
        "batch_psi_max": (has_drift, F.coalesce(F.array_max(drifts), F.lit(0.0))),
        "batch_mean_probability": (has_scores, s["mean_probability"]),
        "batch_pct_default": (has_scores, s["pct_predicted_default"]),
        "batch_score_std": (has_scores, s["std_probability"]),
    }
    pairs = F.array(*[F.when(there, F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, (there, v) in entries.items()])
    return r.select("ingestion_date", F.map_from_entries(F.array_compact(pairs)).alias("metrics"))


def event_line(report: DataFrame) -> DataFrame:
    """The log line of a finished monitoring run: one flat JSON object."""
    head = F.to_json(F.struct(F.lit("batch_monitoring_complete").alias("event"), "ingestion_date"))
    lines = flat_metrics(report).select(head.alias("head"), F.to_json("metrics").alias("body"))
    return lines.select(F.concat(F.regexp_replace("head", r"\}$", ","), F.regexp_replace("body", r"^\{", "")).alias("line"))
