"""Exact classifier quality from a per-score histogram.

Scores count as they are; a histogram has a row per distinct score of a group, and every curve and
metric is a window over it. Tables that store rounded scores have the smaller histograms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.ordered import literal_array, running_sums, steps_passed
from plumbline.operators.profile import quantile_bin
from plumbline.operators.quantiles import quantiles

# Threshold grid and misclassification costs.
GRID_LOW, GRID_HIGH, GRID_SIZE = 0.01, 0.99, 200
COST_FN, COST_FP = 10.0, 1.0
MIN_TEST_AUC = 0.85
# Verdicts for a train/validation gap below 0.02, below 0.05, and above.
VERDICTS = ("minimal overfit", "moderate overfit", "overfit — needs regularization")
#: Narrow, so that scores crowded into a small range still fall into many slices; a slice costs one summary row.
SCORE_SLICES = 65_536


def grid() -> list[float]:
    step = (GRID_HIGH - GRID_LOW) / (GRID_SIZE - 1)
    return [GRID_LOW + i * step for i in range(GRID_SIZE - 1)] + [GRID_HIGH]


def score_histogram(
    df: DataFrame, label: str, score: str, by: Sequence[str] = ()
) -> DataFrame:
    """Positives and negatives per distinct score. Partial aggregation absorbs hot scores."""
    y = F.col(label)
    return (
        df.where(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg"))
    )


def score_curve(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Histogram plus tp, fp (counts at or above the score) and group totals p, n."""
    sliced = histogram.withColumn("__slice", F.floor(F.col("score") * SCORE_SLICES))
    return running_sums(
        sliced,
        by,
        "__slice",
        [F.col("score").desc()],
        {"tp": "pos", "fp": "neg"},
        {"p": "pos", "n": "neg"},
        descending_parts=True,
    ).drop("__slice")


def _auc() -> Column:
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return F.try_divide(area, F.first("p").cast("double") * F.first("n"))


def _ks() -> Column:
    gap = F.try_divide(F.col("tp").cast("double"), F.col("p").cast("double")) - F.try_divide(
        F.col("fp").cast("double"), F.col("n").cast("double")
    )
    return F.greatest(F.lit(0.0), F.max(gap))


def _ap() -> Column:
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return F.sum(F.try_divide(F.col("pos").cast("double"), F.col("p").cast("double")) * precision)


METRICS = {"auc": _auc, "ks": _ks, "pr_auc": _ap}


def raw_metrics(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unrounded auc, ks, gini and pr_auc per group, plus group sizes."""
    out = curve.groupBy(*by).agg(
        F.first("p").alias("positives"), F.first("n").alias("negatives"), *[m().alias(k) for k, m in METRICS.items()]
    )
    return out.withColumn("gini", 2 * F.col("auc") - 1)


def metric_bundle(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), digits: int = 4, prefix: str = ""
) -> DataFrame:
    """auc, ks, gini, pr_auc per group, rounded, names prefixed."""
    out = raw_metrics(score_curve(score_histogram(df, label, score, by), by), by)
    return out.select(*by, *[F.round(m, digits).alias(prefix + m) for m in ("auc", "ks", "gini", "pr_auc")])


def roc_points(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score; the origin has an infinite threshold."""
    points = curve.select(
        *by,
        F.try_divide(F.col("fp").cast("double"), F.col("n").cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("p").cast("double")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = curve.groupBy(*by).agg(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return points.unionByName(origin)


def pr_points(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(recall, precision, threshold) at every distinct score with the base rate of the group."""
    return curve.select(
        *by,
        F.try_divide(F.col("tp").cast("double"), F.col("p").cast("double")).alias("recall"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.col("score").alias("threshold"),
        (F.col("p") / (F.col("p") + F.col("n"))).alias("base_rate"),
    )


def ks_threshold(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Score at the widest gap between the curves; the highest score on ties."""
    share = lambda c, n: F.try_divide(F.col(c).cast("double"), F.col(n).cast("double"))
    gap = F.round(share("tp", "p") - share("fp", "n"), 12)
    return curve.groupBy(*by).agg(
        F.max_by(F.col("score"), F.struct(gap, "score")).alias("threshold"),
        F.round(F.max(gap), 6).alias("gap"),
    )


def confusion(df: DataFrame, label: str, score: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts with score >= threshold as the positive decision."""
    y, hit = F.col(label) == 1, F.col(score) >= threshold
    return df.groupBy(*by).agg(
        F.count_if(~y & ~hit).alias("tn"),
        F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"),
        F.count_if(y & hit).alias("tp"),
    )


def threshold_sweep(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    cost_fn: float = COST_FN,
    cost_fp: float = COST_FP,
) -> DataFrame:
    """Confusion counts, cost, precision, recall and f1 at each of the 200 grid thresholds.

    Each score is mapped to its grid step first, so at most 201 rows per group are summed.
    """
    points = grid()
    step = steps_passed(F.col("score"), points)
    steps = (
        score_histogram(df, label, score, by)
        .groupBy(*by, step.alias("step"))
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    full = (
        steps.groupBy(*by)
        .agg(F.map_from_entries(F.collect_list(F.struct("step", F.struct("pos", "neg")))).alias("at"))
        .select(*by, "at", F.explode(F.sequence(F.lit(0), F.lit(GRID_SIZE))).alias("step"))
        .select(
            *by,
            "step",
            F.coalesce(F.try_element_at("at", F.col("step"))["pos"], F.lit(0)).alias("pos"),
            F.coalesce(F.try_element_at("at", F.col("step"))["neg"], F.lit(0)).alias("neg"),
        )
    )
    above = Window.partitionBy(*by).orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    counts = full.select(
        *by,
        "step",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(whole).alias("p"),
        F.sum("neg").over(whole).alias("n"),
    ).where(F.col("step") > 0)
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("p") - tp
    precision = F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp.cast("double"), F.col("p").cast("double")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide((2 * tp).cast("double"), (2 * tp + fp + fn).cast("double")), F.lit(0.0))
    return counts.select(
        *by,
        F.get(literal_array(points), F.col("step") - 1).alias("threshold"),
        (F.col("n") - fp).alias("tn"),
        fp.alias("fp"),
        fn.alias("fn"),
        tp.alias("tp"),
        (fn * F.lit(cost_fn) + fp * F.lit(cost_fp)).alias("cost"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
    )


def cost_optimal(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First threshold with the lowest cost."""
    return sweep.groupBy(*by).agg(
        F.min_by("threshold", F.struct("cost", "threshold")).alias("threshold"), F.min("cost").alias("cost")
    )


def f1_optimal(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First threshold with the highest f1."""
    return sweep.groupBy(*by).agg(
        F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("threshold"), F.max("f1").alias("f1")
    )


def calibration(df: DataFrame, label: str, score: str, bins: int = 10, digits: int = 6) -> DataFrame:
    """Mean score against observed rate per quantile bin of the score; empty bins do not occur."""
    edges = sorted(set(quantiles(df, {score: [i / bins for i in range(bins + 1)]})[score]))
    return (
        df.groupBy(quantile_bin(F.col(score), edges).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(F.avg(score), digits).alias("mean_predicted"),
            F.round(F.avg(F.col(label).cast("double")), digits).alias("observed_rate"),
        )
    )


def compare_models(bundle: DataFrame, model: str = "model", split: str = "split") -> DataFrame:
    """Train and validation AUC side by side, their gap and a verdict, best validation first."""
    wide = bundle.groupBy(model).pivot(split, ["train", "val"]).agg(F.first("auc"))
    gap = F.round(F.col("train") - F.col("val"), 4)
    return wide.select(
        model,
        F.col("train").alias("train_auc"),
        F.col("val").alias("val_auc"),
        gap.alias("overfit_gap"),
        F.when(gap < 0.02, VERDICTS[0]).when(gap < 0.05, VERDICTS[1]).otherwise(VERDICTS[2]).alias("verdict"),
    ).orderBy(F.desc("val_auc"), model)


def champion(models: DataFrame, rank: str = "position") -> DataFrame:
    """The row with the highest val_auc; the lowest rank on ties."""
    return models.orderBy(F.desc("val_auc"), rank).limit(1)


def tuning_gain(baseline: DataFrame, tuned: DataFrame, model: str = "model") -> DataFrame:
    b = baseline.select(model, F.col("val_auc").alias("baseline_auc"))
    t = tuned.select(model, F.col("val_auc").alias("tuned_auc"))
    return b.join(t, model).withColumn("gain", F.round(F.col("tuned_auc") - F.col("baseline_auc"), 4))


def promotion_gate(report: DataFrame, minimum: float = MIN_TEST_AUC, fail: bool = False) -> DataFrame:
    """Adds passes_threshold, on the rounded AUC and inclusive; in fail mode evaluating it raises."""
    ok = F.round("test_auc", 4) >= minimum
    if fail:
        text = F.concat(F.lit("test_auc below the gate: "), F.col("test_auc").cast("string"))
        ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    return report.withColumn("auc_threshold", F.lit(minimum)).withColumn("passes_threshold", ok)


def brier(df: DataFrame, label: str, score: str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    error = F.col(score) - F.col(label).cast("double")
    return df.groupBy(*by).agg(F.round(F.avg(error * error), digits).alias("brier"))


def cohort_quality(
    df: DataFrame, ts: str, label: str, score: str, as_of: str, matured_months: int = 3, unit: str = "month"
) -> DataFrame:
    """auc and ks per calendar cohort, only cohorts whose labels are old enough at as_of."""
    matured = F.date_trunc(unit, F.add_months(F.to_date(F.lit(as_of)), -matured_months))
    cohort = F.date_trunc(unit, F.col(ts).cast("timestamp"))
    kept = df.where(cohort <= matured).withColumn("cohort", F.date_format(cohort, "yyyy-MM-dd"))
    return metric_bundle(kept, label, score, ["cohort"]).select("cohort", "auc", "ks")
