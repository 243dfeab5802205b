"""Transformers fitted on the training rows only and applied unchanged everywhere else."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.operators.quantiles import quantiles


@dataclass
class Scaler:
    """Fitted parameters: a handful of numbers per feature, whatever the size of the data."""

    numeric: list[str]
    median: dict[str, float]
    mean: dict[str, float]
    scale: dict[str, float]
    categories: dict[str, list[str]] = field(default_factory=dict)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Imputed, standardised numerics then encoded categories, all double; NaN is missing, as in
        fit; other columns go unless kept. Works on streams too."""
        return df.select(
            *keep,
            *[
                ((F.coalesce(C.nan_to_null(F.col(c).cast("double")), F.lit(self.median[c])) - F.lit(self.mean[c])) / F.lit(self.scale[c])).alias(c)
                for c in self.numeric
            ],
            *[C.ordinal(c, order).alias(c) for c, order in self.categories.items()],
        )

    def params(self, spark: SparkSession) -> DataFrame:
        """One row per numeric feature."""
        rows = [(c, self.median[c], self.mean[c], self.scale[c]) for c in self.numeric]
        return spark.createDataFrame(rows, "feature string, median double, mean double, scale double")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "Scaler":
        return Scaler(**json.loads(text))


def _numbers(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Numeric columns as doubles in which NaN is missing."""
    return df.withColumns({c: C.nan_to_null(F.col(c).cast("double")) for c in numeric})


def fit_medians(train: DataFrame, numeric: Sequence[str]) -> dict[str, float]:
    found = quantiles(_numbers(train, numeric), {c: [0.5] for c in numeric})
    return {c: (v[0] if v[0] is not None else 0.0) for c, v in found.items()}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(C.nan_to_null(F.col(c).cast("double")), F.lit(m)) for c, m in medians.items()})


def fit(train: DataFrame, numeric: Sequence[str], categories: dict[str, list[str]] | None = None) -> Scaler:
    """Medians, then mean and population deviation of the imputed rows. A zero deviation scales by 1."""
    numeric = list(numeric)
    medians = fit_medians(train, numeric)
    stats = (
        impute(train.select(*numeric), medians)
        .agg(*[f(c).alias(f"{n}_{c}") for c in numeric for n, f in (("mean", F.avg), ("std", F.stddev_pop))])
        .first()
    )
    return Scaler(
        numeric,
        medians,
        {c: stats[f"mean_{c}"] for c in numeric},
        {c: stats[f"std_{c}"] or 1.0 for c in numeric},
        categories or {},
    )


def min_max(df: DataFrame, train: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """(c - min) / (max - min) with bounds of the training rows; a zero range gives 0, NaN is missing."""
    bounds = _numbers(train.select(*numeric), numeric).agg(*[f(c).alias(f"{n}_{c}") for c in numeric for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = {}
    for c in numeric:
        low, high = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        width = float(high - low) if high is not None else 0.0
        x = C.nan_to_null(F.col(c).cast("double"))
        out[c] = (x - F.lit(low)) / F.lit(width) if width else F.when(x.isNotNull(), F.lit(0.0))
    return df.withColumns(out)


def winsor_bounds(train: DataFrame, numeric: Sequence[str], low: float = 0.01, high: float = 0.99) -> dict:
    """Bounds per feature; NaN is missing."""
    found = quantiles(_numbers(train.select(*numeric), numeric), {c: [low, high] for c in numeric})
    return {c: tuple(v) for c, v in found.items()}


def winsorize(df: DataFrame, bounds: dict) -> DataFrame:
    """Clipped values; NULL and NaN are NULL."""
    return df.withColumns({c: C.winsorize(C.nan_to_null(c), lo, hi) for c, (lo, hi) in bounds.items()})


def feature_config(
    splits: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], seed: int, split: str = "split"
) -> DataFrame:
    """One row: feature lists, target, seed, rows per split, positive rate of the training rows."""
    y = F.col(label).cast("double")
    count = lambda s: F.count_if(F.col(split) == s)
    lists = {"features": [*numeric, *categorical], "numeric": numeric, "categorical": categorical}
    return splits.agg(
        count("train").alias("train_rows"),
        count("val").alias("val_rows"),
        count("test").alias("test_rows"),
        F.round(F.avg(F.when(F.col(split) == "train", y)), 6).alias("default_rate_train"),
    ).select(
        *[F.array(*[F.lit(x) for x in v]).cast("array<string>").alias(k) for k, v in lists.items()],
        F.lit(label).alias("target"),
        F.lit(seed).alias("random_state"),
        "train_rows",
        "val_rows",
        "test_rows",
        "default_rate_train",
    )


def reference_profile(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Per feature: null rate, and for numerics mean, sample deviation, quartiles; 6 places."""
    train = _numbers(train, numeric)
    quartiles = quantiles(train, {c: [0.25, 0.5, 0.75] for c in numeric})
    stats = train.agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"null_{c}") for c in [*numeric, *categorical]],
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in numeric],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"std_{c}") for c in numeric],
    )
    rows = []
    for c in [*numeric, *categorical]:
        number = c in quartiles
        rows.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.round(f"null_{c}", 6).alias("null_rate"),
                (F.round(f"mean_{c}", 6) if number else F.lit(None).cast("double")).alias("mean"),
                (F.round(f"std_{c}", 6) if number else F.lit(None).cast("double")).alias("std"),
                *[
                    F.round(F.lit(quartiles[c][i] if number else None).cast("double"), 6).alias(q)
                    for i, q in enumerate(("p25", "p50", "p75"))
                ],
            )
        )
    return stats.select(F.inline(F.array(*rows)))


def profile_document(profile: DataFrame) -> DataFrame:
    """The profile as one JSON map: feature -> statistics (absent statistics are left out)."""
    entries = F.collect_list(F.struct("feature", F.struct("null_rate", "mean", "std", "p25", "p50", "p75")))
    return profile.agg(F.to_json(F.map_from_entries(entries)).alias("document"))
