"""Exploratory profiling: one wide aggregate per question, then rows per feature."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.operators.ordered import steps_passed
from plumbline.operators.quantiles import quantiles


def _rows(aggregated: DataFrame, features: Sequence[str], fields: dict[str, object]) -> DataFrame:
    """One-row aggregate with columns <field>_<feature> to one row per feature."""
    structs = [
        F.struct(F.lit(f).alias("feature"), *[make(f).alias(n) for n, make in fields.items()]) for f in features
    ]
    return aggregated.select(F.inline(F.array(*structs)))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and share of all rows. The total is summed from the per-value counts."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.select(column, "rows", F.round(F.col("rows") / total, 6).alias("share"))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")).select(
        "*", F.round(F.try_divide("negatives", "positives"), 4).alias("ratio")
    )


def missingness(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features that have missing values: count and percentage (2 places), most first."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f).isNull()).alias(f"m_{f}") for f in features])
    rows = _rows(
        one,
        features,
        {
            "missing": lambda f: F.col(f"m_{f}"),
            "missing_pct": lambda f: F.round(F.try_divide(F.col(f"m_{f}") * 100.0, F.col("n")), 2),
        },
    )
    return rows.where(F.col("missing") > 0).orderBy(F.desc("missing"), "feature")


def missingness_vs_target(df: DataFrame, features: Sequence[str], label: str, gap: float = 0.01) -> DataFrame:
    """Positive rate when a feature is missing and when it is present, and whether that is informative."""
    y = F.col(label).cast("double")
    one = df.agg(
        *[F.avg(F.when(F.col(f).isNull(), y)).alias(f"miss_{f}") for f in features],
        *[F.avg(F.when(F.col(f).isNotNull(), y)).alias(f"have_{f}") for f in features],
    )
    rows = _rows(
        one,
        features,
        {
            "rate_missing": lambda f: F.round(f"miss_{f}", 6),
            "rate_present": lambda f: F.round(f"have_{f}", 6),
            "verdict": lambda f: F.when(F.abs(F.col(f"miss_{f}") - F.col(f"have_{f}")) > gap, "INFORMATIVE").otherwise(
                "MCAR"
            ),
        },
    )
    return rows.where(F.col("rate_missing").isNotNull())


def outliers(df: DataFrame, features: Sequence[str], nulls_in_share: bool = False) -> DataFrame:
    """p1, p99, max and the percentage of values strictly above p99 (2 places).

    The share is over non-NULL values, or over all rows with nulls_in_share.
    """
    bounds = quantiles(df, {f: [0.01, 0.99] for f in features})
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(f).alias(f"n_{f}") for f in features],
        *[F.max(F.col(f).cast("double")).alias(f"max_{f}") for f in features],
        *[F.count_if(F.col(f) > F.lit(bounds[f][1])).alias(f"above_{f}") for f in features],
    )
    base = (lambda f: F.col("n")) if nulls_in_share else (lambda f: F.col(f"n_{f}"))
    return _rows(
        one,
        features,
        {
            "p1": lambda f: F.round(F.lit(bounds[f][0]).cast("double"), 6),
            "p99": lambda f: F.round(F.lit(bounds[f][1]).cast("double"), 6),
            "max": lambda f: F.col(f"max_{f}"),
            "above_p99_pct": lambda f: F.round(F.try_divide(F.col(f"above_{f}") * 100.0, base(f)), 2),
        },
    )


def cap_candidates(df: DataFrame, features: Sequence[str], percent: float = 1.0) -> DataFrame:
    """Features with more than `percent` of their values above p99."""
    return outliers(df, features).where(F.col("above_p99_pct") > percent).select("feature", "p99", "above_p99_pct")


def clip_at_quantile(df: DataFrame, column: str, share: float = 0.99, times: float = 1.0) -> DataFrame:
    """Cap a column at (quantile * times)."""
    ceiling = quantiles(df, {column: [share]})[column][0]
    return df.withColumn(column, C.cap(F.col(column).cast("double"), ceiling * times))


def histogram(df: DataFrame, column: str, bins: int = 50, clip_share: float | None = 0.99, times: float = 1.0) -> DataFrame:
    """Equal-width bins over the (clipped) range; the top edge falls into the last bin."""
    data = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    if clip_share is not None:
        data = clip_at_quantile(data, "v", clip_share, times)
    low, high = data.agg(F.min("v"), F.max("v")).first()
    if low is None or low == high:
        number = F.lit(0).cast("bigint")
        width = 0.0
    else:
        width = (high - low) / bins
        number = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1).cast("bigint"))
    low = low if low is not None else 0.0
    return (
        data.groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("bin", F.round(F.lit(low) + F.col("bin") * F.lit(width), 6).alias("left_edge"), "rows")
    )


def describe(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles, max per feature."""
    quartiles = quantiles(df, {f: [0.25, 0.5, 0.75] for f in features})
    one = df.agg(
        *[
            fn(F.col(f).cast("double")).alias(f"{n}_{f}")
            for f in features
            for n, fn in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
        ]
    )
    return _rows(
        one,
        features,
        {
            "count": lambda f: F.col(f"n_{f}"),
            "mean": lambda f: F.round(f"mean_{f}", 4),
            "std": lambda f: F.round(f"std_{f}", 4),
            "min": lambda f: F.col(f"min_{f}"),
            **{
                q: (lambda f, i=i: F.round(F.lit(quartiles[f][i]).cast("double"), 6))
                for i, q in enumerate(("p25", "p50", "p75"))
            },
            "max": lambda f: F.col(f"max_{f}"),
        },
    )


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson r of every pair (upper triangle, long form) over rows where both are present."""
    pairs = list(combinations(features, 2))
    one = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = [
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Both triangles and the diagonal in long form."""
    upper = correlations(df, features)
    lower = upper.select(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "r")
    one = df.agg(*[F.corr(F.col(f).cast("double"), F.col(f).cast("double")).alias(f) for f in features])
    same = [F.struct(F.lit(f).alias("feature_a"), F.lit(f).alias("feature_b"), F.col(f).alias("r")) for f in features]
    return upper.unionByName(lower).unionByName(one.select(F.inline(F.array(*same))))


def strong_pairs(df: DataFrame, features: Sequence[str], above: float = 0.5) -> DataFrame:
    return correlations(df, features).where(F.abs("r") > above).withColumn("r", F.round("r", 3)).orderBy(F.desc(F.abs("r")))


def quantile_bin(column: Column, edges: Sequence[float]) -> Column:
    """0-based right-closed bin among distinct ascending edges; the lowest edge belongs to bin 0."""
    return F.when(column.isNotNull(), steps_passed(column, list(edges)[1:-1], strict=True))


def rate_by_quantile(df: DataFrame, column: str, label: str, bins: int = 10, clip_share: float | None = 0.99) -> DataFrame:
    """Positive percentage per quantile bin of the clipped column; equal edges are merged."""
    data = df.select(F.col(column).cast("double").alias("v"), F.col(label).cast("double").alias("y"))
    data = data.where(F.col("v").isNotNull())
    if clip_share is not None:
        data = clip_at_quantile(data, "v", clip_share)
    edges = sorted(set(quantiles(data, {"v": [i / bins for i in range(bins + 1)]})["v"]))
    return (
        data.groupBy(quantile_bin(F.col("v"), edges).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("v").alias("low"),
            F.max("v").alias("high"),
            F.round(F.avg("y") * 100, 4).alias("positive_pct"),
        )
    )


def lowest_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The first n distinct values with their counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(column).limit(n)


def range_counts(df: DataFrame, column: str, zero: float = 0, below: float = 18) -> DataFrame:
    c = F.col(column)
    return df.agg(F.count_if(c == zero).alias("equal_zero"), F.count_if(c < below).alias("below"))


def entity_history(
    df: DataFrame, entity: str, ts: str, as_of: str, event: Column, severity: Column, amount: Column
) -> DataFrame:
    """Per entity, from rows up to as_of only: number of events, worst severity, summed amount."""
    past = df.where(F.col(ts) <= F.lit(as_of).cast(df.schema[ts].dataType))
    return past.groupBy(entity).agg(
        F.count_if(event).alias("events"),
        F.max(severity).alias("worst"),
        F.round(F.sum(amount), 2).alias("exposure"),
    )
