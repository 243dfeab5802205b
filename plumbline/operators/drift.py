"""Two-sample drift of features and scores: real reference rows against current rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.ordered import literal_array, position_in, running_sums
from plumbline.operators.profile import quantile_bin
from plumbline.operators.quantiles import quantiles

PSI_FLOOR = 1e-6
PSI_LIMIT = 0.2
DATASET_SHARE = 0.5
ROWS_PER_SLICE = 500_000
MAX_SLICES = 1024


def shared_features(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> list[str]:
    return [f for f in features if f in reference.columns and f in current.columns]


def long_values(reference: DataFrame, current: DataFrame, features: Sequence[str], kind: str) -> DataFrame:
    """(feature, value, side) rows of both samples; side 0 is the reference. NULLs are left out."""

    def melt(df: DataFrame, side: int) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast(kind).alias("value")) for f in features])
        return df.select(F.inline(pairs)).where(F.col("value").isNotNull()).withColumn("side", F.lit(side))

    return melt(reference, 0).unionAll(melt(current, 1))


def value_counts(values: DataFrame) -> DataFrame:
    """Rows of each side per (feature, value)."""
    return values.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("ref"), F.count_if(F.col("side") == 1).alias("cur")
    )


def _slices(values: DataFrame, rows_per_slice: int) -> Column:
    """Slice of a value inside its feature, by a sketch of that feature's values."""
    rows = values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()
    wanted = min(MAX_SLICES, max((r.n for r in rows), default=0) // rows_per_slice + 1)
    if wanted <= 1:
        return F.lit(0)
    shares = literal_array([i / wanted for i in range(1, wanted)])
    sketches = values.groupBy("feature").agg(F.percentile_approx("value", shares, 10 * wanted).alias("e")).collect()
    entries = [x for r in sketches for x in (F.lit(r.feature), literal_array(r.e))]
    edges = F.element_at(F.create_map(*entries), F.col("feature"))
    return position_in(F.col("value"), edges, wanted - 1)


def distribution_gaps(
    reference: DataFrame, current: DataFrame, features: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Per (feature, distinct value) the cumulative share of each side, and the gap to the next value."""
    values = long_values(reference, current, features, "double")
    values = values.where(~F.isnan("value"))
    counts = value_counts(values).withColumn("__slice", _slices(values, rows_per_slice))
    curve = running_sums(
        counts, ["feature"], "__slice", [F.col("value")], {"ref_upto": "ref", "cur_upto": "cur"}, {"n_ref": "ref", "n_cur": "cur"},
        {"next_value": "value"},
    )
    curve = curve.withColumn("f_ref", F.try_divide(F.col("ref_upto").cast("double"), F.col("n_ref").cast("double")))
    return curve.withColumn("f_cur", F.try_divide(F.col("cur_upto").cast("double"), F.col("n_cur").cast("double")))


def ks_test(gaps: DataFrame) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per feature with its asymptotic p-value."""
    out = gaps.groupBy("feature").agg(
        F.max(F.abs(F.col("f_ref") - F.col("f_cur"))).alias("statistic"),
        F.first("n_ref").alias("n_ref"),
        F.first("n_cur").alias("n_cur"),
    )
    n_ref, n_cur = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    effective = F.sqrt(n_ref * n_cur / (n_ref + n_cur))
    x = F.col("statistic") * effective
    term = lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda total, k: total + term(k))
    p = F.when(x < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
    return out.withColumn("p_value", F.round(p, 6)).select(
        "feature", F.round("statistic", 6).alias("statistic"), "p_value", "n_ref", "n_cur"
    )


def wasserstein(gaps: DataFrame, reference: DataFrame, features: Sequence[str]) -> DataFrame:
    """Area between the two distribution functions, and the same over the reference deviation (floored)."""
    width = F.col("next_value") - F.col("value")
    area = gaps.groupBy("feature").agg(
        F.coalesce(F.sum(F.abs(F.col("f_ref") - F.col("f_cur")) * width), F.lit(0.0)).alias("area")
    )
    spread = reference.agg(*[F.stddev_pop(F.col(f).cast("double")).alias(f) for f in features]).select(
        F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("__spread")) for f in features]))
    )
    # one row per feature named by the caller
    joined = area.join(F.broadcast(spread), "feature")
    normed = F.col("area") / F.greatest(F.col("__spread"), F.lit(1e-3))
    return joined.select("feature", F.round("area", 6).alias("distance"), F.round(normed, 6).alias("normed"))


def category_counts(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Counts and shares of each side per (feature, category)."""
    counts = value_counts(long_values(reference, current, features, "string"))
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    joined = counts.join(F.broadcast(totals), "feature")  # one row per feature named by the caller
    return joined.withColumns(
        {
            "p_ref": F.try_divide(F.col("ref").cast("double"), F.col("n_ref").cast("double")),
            "p_cur": F.try_divide(F.col("cur").cast("double"), F.col("n_cur").cast("double")),
        }
    )


def category_drift(counts: DataFrame) -> DataFrame:
    """Chi-square statistic (two-sample homogeneity) and Jensen-Shannon distance per feature."""
    total, both = F.col("n_ref") + F.col("n_cur"), (F.col("ref") + F.col("cur")).cast("double")
    term = F.lit(0.0)
    for seen, n in (("ref", "n_ref"), ("cur", "n_cur")):
        expected = both * F.col(n) / total
        term = term + F.coalesce(F.try_divide((F.col(seen) - expected) ** 2, expected), F.lit(0.0))
    middle = (F.col("p_ref") + F.col("p_cur")) / 2
    half = lambda p: F.when(F.col(p) > 0, F.col(p) * F.ln(F.col(p) / middle)).otherwise(0.0)
    return counts.groupBy("feature").agg(
        F.round(F.sum(term), 6).alias("chi_square"),
        (F.count(F.lit(1)) - 1).alias("degrees"),
        F.round(F.sqrt(F.greatest(F.sum(half("p_ref") + half("p_cur")) / 2, F.lit(0.0))), 6).alias("js_distance"),
    )


def _psi_terms(counts: DataFrame, floor: float) -> DataFrame:
    """counts: (feature, bin, ref, cur) with every reference bin -> psi per feature."""
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    joined = counts.join(F.broadcast(totals), "feature")  # one row per feature named by the caller
    share = lambda c, n: F.greatest(F.coalesce(F.try_divide(F.col(c).cast("double"), F.col(n).cast("double")), F.lit(0.0)), F.lit(floor))
    e, a = share("ref", "n_ref"), share("cur", "n_cur")
    return joined.groupBy("feature").agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))


def psi_numeric(
    reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10, floor: float = PSI_FLOOR
) -> DataFrame:
    """Population stability index over reference quantile bins; outer bins are open-ended."""
    found = quantiles(reference, {f: [i / bins for i in range(bins + 1)] for f in features})
    edges = {f: sorted({e for e in v if e is not None}) for f, v in found.items()}

    def binned(df: DataFrame, side: int) -> DataFrame:
        pairs = F.array(
            *[
                F.struct(F.lit(f).alias("feature"), quantile_bin(F.col(f).cast("double"), edges[f]).alias("bin"))
                for f in features
            ]
        )
        return df.select(F.inline(pairs)).where(F.col("bin").isNotNull()).withColumn("side", F.lit(side))

    counts = value_counts(binned(reference, 0).unionAll(binned(current, 1)).withColumnRenamed("bin", "value"))
    return _psi_terms(counts, floor).select("feature", F.round("psi", 6).alias("psi"))


def psi_categorical(
    reference: DataFrame, current: DataFrame, features: Sequence[str], floor: float = PSI_FLOOR
) -> DataFrame:
    counts = value_counts(long_values(reference, current, features, "string"))
    return _psi_terms(counts, floor).select("feature", F.round("psi", 6).alias("psi"))


def feature_psi(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int = 10
) -> DataFrame:
    """PSI of every feature both tables have."""
    numbers = shared_features(reference, current, numeric)
    texts = shared_features(reference, current, categorical)
    parts = []
    if numbers:
        parts.append(psi_numeric(reference, current, numbers, bins))
    if texts:
        parts.append(psi_categorical(reference, current, texts))
    if not parts:
        return reference.sparkSession.createDataFrame([], "feature string, psi double")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def summarize(scores: DataFrame, limit: float = PSI_LIMIT, score: str = "psi") -> DataFrame:
    """One row: scores per feature, drifted features, drifted share (4 places), dataset flag, largest score."""
    drifted = F.col(score) > limit
    share = F.coalesce(F.avg(drifted.cast("double")), F.lit(0.0))
    return scores.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", score)))).alias("per_feature_drift"),
        F.sort_array(F.collect_list(F.when(drifted, F.col("feature")))).alias("drifted_features"),
        F.round(share, 4).alias("drift_share"),
        (share >= DATASET_SHARE).alias("overall_drift_detected"),
        F.coalesce(F.max(score), F.lit(0.0)).alias("max_score"),
    )


def drift_record(
    reference: DataFrame | None, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """The drift section of a report: a summary, or a skipped row when there is no reference."""
    if reference is None:
        return current.sparkSession.range(1).select(
            F.lit(True).alias("skipped"), F.lit("no reference data").alias("reason")
        )
    return summarize(feature_psi(reference, current, numeric, categorical)).drop("max_score")


def output_drift(
    reference: DataFrame,
    current: DataFrame,
    score: str = "probability",
    decision: str = "prediction",
    low: float = 0.01,
    high: float = 0.30,
) -> DataFrame:
    """PSI of the scores, share of positive decisions now, and whether that share left [low, high]."""
    psi = psi_numeric(reference, current, [score]).select("psi").scalar()
    rate = F.avg(F.col(decision).cast("double"))
    return current.agg(F.round(rate, 6).alias("positive_share"), ((rate > high) | (rate < low)).alias("outside")).select(
        psi.alias("psi"), "positive_share", "outside"
    )


def reference_edges(reference: DataFrame, features: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """The quantile bins of psi_numeric, to be kept with the profiles made by them."""
    found = quantiles(reference, {f: [i / bins for i in range(bins + 1)] for f in features})
    return {f: sorted({e for e in v if e is not None}) for f, v in found.items()}


def profile_by(df: DataFrame, by: Sequence[str], edges: dict[str, list[float]], categorical: Sequence[str] = ()) -> DataFrame:
    """A mergeable profile: rows per (by, feature, bin), with sum and sum of squares of the numbers there.

    One pass; nulls (and NaN) are the bin null. Profiles of any parts add up by `merged`.
    """
    rows = []
    for f, own in edges.items():
        x = F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double"))
        rows.append(F.struct(F.lit(f).alias("feature"), quantile_bin(x, own).cast("string").alias("bin"), x.alias("x")))
    rows += [F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("bin"), F.lit(None).cast("double").alias("x")) for f in categorical]
    long = df.select(*by, F.inline(F.array(*rows)))
    return long.groupBy(*by, "feature", "bin").agg(F.count(F.lit(1)).alias("rows"), F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("squares"))


def merged(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles added up over everything but `by`: no raw row is read again."""
    return profile.groupBy(*by, "feature", "bin").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))


def profile_moments(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """null_rate, mean and sample deviation per feature of a merged profile."""
    n = F.sum(F.when(F.col("total").isNotNull(), F.col("rows")))
    mean = F.sum("total") / n
    spread = F.sqrt(F.greatest(F.try_divide(F.sum("squares") - F.sum("total") * mean, n - 1), F.lit(0.0)))
    nulls = F.sum(F.when(F.col("bin").isNull(), F.col("rows")).otherwise(0)) / F.sum("rows")
    return profile.groupBy(*by, "feature").agg(nulls.alias("null_rate"), mean.alias("mean"), spread.alias("std"))


def profile_psi(reference: DataFrame, current: DataFrame, floor: float = PSI_FLOOR) -> DataFrame:
    """feature_psi from two profiles made with the same edges."""
    side = lambda df, name, other: df.where("bin IS NOT NULL").groupBy("feature", "bin").agg(F.sum("rows").alias(name)).withColumn(other, F.lit(0).cast("long"))
    both = side(reference, "ref", "cur").unionByName(side(current, "cur", "ref"))
    counts = both.groupBy("feature", "bin").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    return _psi_terms(counts, floor).select("feature", F.round("psi", 6).alias("psi"))
