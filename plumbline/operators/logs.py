"""Log lines: shipping rules, filters, JSON labels, rates and counts. All column functions, so
batch tables and streams share them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.ordered import previous_row
from plumbline.operators.series import at_instants, by_bucket, label_match

# Patterns of the shipping rules and of the error and warning panels.
LEVEL = r"(?i)(debug|info|warn(?:ing)?|error|critical|fatal)"
BLANK = r"^\s*$"
KEEP = "true"
CONTAINER = "/(.*)"
ERRORS = r"(?i)(error|exception|critical|fatal|traceback)"
ERROR_RATE = r"(?i)(error|exception|critical|fatal)"
WARNINGS = r"(?i)(warn|warning)"
NOT_WARNINGS = r"(?i)(error|critical|fatal)"

STEPS_PER_SLICE = 10_000
ENVELOPE = T.StructType([T.StructField("log", T.StringType()), T.StructField("stream", T.StringType())])


def select_streams(df: DataFrame, matchers: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Lines whose label columns satisfy every (label, op, value); an absent label is empty."""
    for name, op, wanted in matchers:
        df = df.where(label_match(F.coalesce(F.col(name), F.lit("")), op, wanted))
    return df


def line_contains(df: DataFrame, text: str, line: str = "line") -> DataFrame:
    """Case-sensitive; an empty text keeps everything."""
    return df.where(F.col(line).contains(text)) if text else df


def line_matches(df: DataFrame, pattern: str, line: str = "line") -> DataFrame:
    return df.where(F.col(line).rlike(pattern))


def line_excludes(df: DataFrame, pattern: str, line: str = "line") -> DataFrame:
    return df.where(~F.col(line).rlike(pattern))


def parse_json(df: DataFrame, schema: T.StructType, line: str = "line") -> DataFrame:
    """Fields of a JSON line as columns, plus parse_error for lines that are not JSON objects."""
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(F.col(line), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    out = df.withColumn("__json", parsed)
    bad = F.col(line).isNotNull() & (F.col("__json").isNull() | F.col("__json._bad").isNotNull())
    fields = {f.name: F.when(~bad, F.col(f"__json.{f.name}")) for f in schema.fields}
    return out.withColumns({**fields, "parse_error": bad}).drop("__json")


def as_variant(df: DataFrame, line: str = "line", name: str = "fields") -> DataFrame:
    """The JSON object of a line as VARIANT, and parse_error for lines that are none; no schema is needed."""
    parsed = F.try_parse_json(F.col(line))
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    out = df.withColumn(name, F.when(is_object, parsed))
    return out.withColumn("parse_error", F.col(line).isNotNull() & F.col(name).isNull())


def unwrap(df: DataFrame, paths: dict[str, tuple[str, str]], line: str = "line") -> DataFrame:
    """Adds a column per (path, type); NULL where the path is missing or holds something else."""
    out = as_variant(df, line, "__v")
    return out.withColumns({n: F.try_variant_get("__v", path, kind) for n, (path, kind) in paths.items()}).drop("__v")


def line_schema(df: DataFrame, line: str = "line") -> DataFrame:
    """One row: the schema that holds the fields of all lines, and how many lines are no JSON objects."""
    out = as_variant(df, line, "__v")
    return out.agg(F.schema_of_variant_agg("__v").alias("schema"), F.count_if("parse_error").alias("parse_errors"))


def discovered_labels(df: DataFrame, keys: Sequence[str], line: str = "line", depth: int = 4) -> DataFrame:
    """(keys, label, value) for every field of every line, whatever fields there are.

    Names of nested fields are joined by `_`, down to `depth` levels (what lies deeper stays JSON text);
    lists and nulls give no label. A line that is no JSON object has the label __error__.
    """
    out = as_variant(df, line, "__v")
    spark = df.sparkSession
    bad = out.where("parse_error").select(*keys, F.lit("__error__").alias("label"), F.lit("JSONParserErr").alias("value"))
    level = out.where("__v IS NOT NULL").select(*keys, F.lit("").alias("__name"), "__v")
    found = bad
    for left in reversed(range(depth)):
        fields = level.lateralJoin(spark.tvf.variant_explode(F.col("__v").outer())).select(*keys, F.concat("__name", "key").alias("__name"), F.col("value").alias("__v"))
        kind = F.schema_of_variant("__v")
        nested = kind.startswith("OBJECT")
        plain = fields.where(~F.is_variant_null("__v") & ~kind.startswith("ARRAY") & (~nested if left else F.lit(True)))
        text = F.when(nested, F.to_json("__v")).otherwise(F.try_variant_get("__v", "$", "string"))
        found = found.unionByName(plain.select(*keys, F.col("__name").alias("label"), text.alias("value")))
        level = fields.where(nested).select(*keys, F.concat("__name", F.lit("_")).alias("__name"), "__v")
    return found


def warnings_only(df: DataFrame, line: str = "line") -> DataFrame:
    """Warning lines that are not errors."""
    return line_excludes(line_matches(df, WARNINGS, line), NOT_WARNINGS, line)


def keep_enabled(df: DataFrame, flag: str) -> DataFrame:
    """Opt-in: only rows whose flag is exactly `true`."""
    return df.where(label_match(F.coalesce(F.col(flag), F.lit("")), "=~", KEEP))


def container_name(c: Column | str) -> Column:
    """Name after the leading slash; NULL when the pattern does not match."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(f"^(?:{CONTAINER})$"), F.regexp_extract(c, f"^(?:{CONTAINER})$", 1))


def level(line: Column | str) -> Column:
    """First level word anywhere in the line, in its original case; NULL when there is none."""
    line = F.col(line) if isinstance(line, str) else line
    return F.nullif(F.regexp_extract(line, LEVEL, 1), F.lit(""))


def unwrap_envelope(df: DataFrame, raw: str = "raw") -> DataFrame:
    """line := log and stream := stream of the JSON envelope; a raw text that is no JSON stays the line."""
    parsed = F.from_json(F.col(raw), ENVELOPE)
    out = df.withColumn("__env", parsed)
    return out.withColumns(
        {"line": F.coalesce(F.col("__env.log"), F.col(raw)), "stream": F.col("__env.stream")}
    ).drop("__env", raw)


def drop_blank(df: DataFrame, line: str = "line") -> DataFrame:
    return df.where(~F.col(line).rlike(BLANK))


def ship(df: DataFrame) -> DataFrame:
    """The whole log pipeline: (ts, enabled, name, service, project, raw) to labelled lines."""
    kept = keep_enabled(df, "enabled").withColumn("container", container_name("name")).drop("enabled", "name")
    lines = drop_blank(unwrap_envelope(kept))
    found = F.when(F.col("container").isNotNull() & (F.col("container") != ""), level("line"))
    return lines.withColumn("level", found).select(
        "ts", "container", "service", "project", "stream", "level", "line"
    )


def line_rate(df: DataFrame, by: Sequence[str], range_s: int, step_s: int, ts: str = "ts") -> DataFrame:
    """Lines per second at each instant: the count divided by the length of the range."""
    buckets = by_bucket(df.select(*by, ts), by, range_s, step_s, [F.count(F.lit(1)).alias("__n")], ts)
    return at_instants(buckets, range_s, step_s).groupBy(*by, "t").agg((F.sum("__n") / F.lit(float(range_s))).alias("value"))


def count_over_time(df: DataFrame, by: Sequence[str], step_s: int = 60, ts: str = "ts") -> DataFrame:
    """Lines per step and label, with zero rows for the empty steps between the first and the last line."""
    counts = by_bucket(df.select(*by, ts), by, step_s, step_s, [F.count(F.lit(1)).alias("lines")], ts)
    counts = counts.select(*by, F.col("__end").alias("t"), "lines")
    sliced = counts.withColumn("__slice", F.floor(F.col("t") / (step_s * STEPS_PER_SLICE)))
    before = previous_row(sliced, by, "__slice", ["t"], ["t"])
    # Gaps are cut into runs of steps first, so that no array grows with the length of a silence.
    step, width = F.lit(step_s).cast("bigint"), F.lit(step_s * STEPS_PER_SLICE).cast("bigint")
    gaps = before.where(F.col("prev.t") < F.col("t") - step_s).select(*by, F.col("prev.t").alias("__a"), F.col("t").alias("__b"))
    runs = gaps.select(*by, "__b", F.explode(F.sequence(F.col("__a") + step_s, F.col("__b") - step_s, width)).alias("__a"))
    last = F.least(F.col("__a") + width - step, F.col("__b") - step)
    empty = runs.select(*by, F.explode(F.sequence("__a", last, step)).alias("t"), F.lit(0).cast("bigint").alias("lines"))
    return counts.unionByName(empty)


def stalls(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Steps without a line."""
    return counts.where(F.col("lines") == 0).select(*by, "t")


def recent(df: DataFrame, pattern: str, start: str, end: str, n: int = 100, ts: str = "ts") -> DataFrame:
    """The newest n lines of a time range that match; of equal times, those whose text comes first."""
    kind = df.schema[ts].dataType
    inside = df.where((F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) <= F.lit(end).cast(kind)))
    return line_matches(inside, pattern).orderBy(F.desc(ts), "line").limit(n)
