"""Raw text to typed rows, and typed rows to features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import schema as S
from plumbline.functions import columns as C
from plumbline.sources import files


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Unknown names pass through."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def drop(df: DataFrame, *names: str) -> DataFrame:
    """Absent columns are ignored."""
    return df.drop(*names)


def cast_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Bad text becomes NULL; columns that are absent are skipped (see missing_names)."""
    return df.withColumns({c: C.soft_cast(c, t) for c, t in types.items() if c in df.columns})


def missing_names(df: DataFrame, expected: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in expected if c not in have]


#: Bytes of the files read whose distinct rows one task holds.
DEDUP_BYTES = 32 << 20


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole rows once. As many tasks hold the rows as the files read ask for, where that is more than the session's."""
    if not df.isStreaming:
        parts = -(-files.input_bytes(df) // DEDUP_BYTES)
        if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            df = df.repartition(parts, *[F.col(f"`{c}`") for c in df.columns])
    return df.dropDuplicates()


def stamp(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    absent = missing_names(df, names)
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def gate_rows(df: DataFrame, minimum: int, active: bool = True) -> DataFrame:
    """One row (rows, accepted); evaluating it raises when active and too few rows exist."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"))
    failed = F.lit(active) & (F.col("rows") < minimum)
    message = F.concat(F.lit("row count too low: "), F.col("rows").cast("string"))
    return counted.select(
        "rows", F.when(failed, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)).alias("accepted")
    )


def clean(raw: DataFrame, mode: str, dedup: str = "before_cast") -> DataFrame:
    """Raw text rows to the typed layer. `mode` is training or inference."""
    if mode not in ("training", "inference"):
        raise ValueError(f"unknown mode {mode}")
    df = drop(rename(raw, S.RENAMES), S.INDEX_COLUMN)
    if dedup == "before_cast":
        df = distinct_rows(df)
    df = cast_types(df, S.CLEAN_TYPES)
    if dedup == "after_cast":
        df = distinct_rows(df)
    if mode == "training":
        return require_columns(df, [S.TARGET])
    return drop(df, S.TARGET)


def derive_features(df: DataFrame, caps: dict[str, float] | None = None) -> DataFrame:
    """Stateless feature derivation, the same for training, scoring and streams."""
    caps = caps or {
        "revolving_utilization_of_unsecured_lines": S.REVOLVING_CAP,
        "debt_ratio": S.DEBT_RATIO_CAP,
        "monthly_income": S.MONTHLY_INCOME_CAP,
    }
    return (
        df.where(F.col("age") >= S.AGE_MIN)
        .withColumns({c: C.cap(c, k) for c, k in caps.items()})
        .withColumns(
            {
                "monthly_income_is_missing": C.is_missing("monthly_income"),
                "number_of_dependents_is_missing": C.is_missing("number_of_dependents"),
                "delinquency_score": C.weighted_sum(
                    {
                        "number_of_time30_59_days_past_due_not_worse": 1,
                        "number_of_time60_89_days_past_due_not_worse": 2,
                        "number_of_times90_days_late": 3,
                    }
                ),
                "debt_to_income_ratio": C.guarded_ratio("debt_ratio", "monthly_income"),
                "unsecured_to_total_lines_ratio": C.remaining_share(
                    "number_of_open_credit_lines_and_loans", "number_real_estate_loans_or_lines"
                ),
                "age_risk_bucket": C.ordered_bucket("age", S.AGE_BOUNDS, S.AGE_BUCKETS),
            }
        )
        .withColumn("has_any_delinquency", C.any_event("delinquency_score"))
    )


def with_row_id(df: DataFrame, key: Sequence[str] = (), name: str = S.ROW_ID) -> DataFrame:
    """Row id: a hash of the natural key when there is one (stable across layouts), else a layout id."""
    value = F.xxhash64(*key) if key else F.monotonically_increasing_id()
    return df.withColumn(name, value)


def feature_table(clean_rows: DataFrame, mode: str, key: Sequence[str] = ()) -> DataFrame:
    """Typed rows to the feature layer: leading target or row id, then the 17 features in order."""
    df = derive_features(clean_rows)
    if mode == "training":
        return require_columns(df, [S.TARGET]).select(S.TARGET, *S.FEATURES)
    return with_row_id(df, key).select(S.ROW_ID, *S.FEATURES)
