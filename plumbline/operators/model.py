"""Training, search, scoring and attribution on Spark ML."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline import schema as S
from plumbline.functions import columns as C
from plumbline.operators import boosting, drift, logistic, metrics, trees
from plumbline.operators.ordered import running_sums
from plumbline.operators.split import stratified_folds
from plumbline.session import shared_dir

POSITIVE_WEIGHT = 13.9  # fixed value
SEED = 42


def class_weights(train: DataFrame, label: str) -> tuple[dict[int, float], int]:
    """Balanced weights n / (2 * n_class) and the number of rows."""
    counts = {int(r[0]): r[1] for r in train.groupBy(F.col(label).cast("int")).count().collect()}  # a row per class
    n = sum(counts.values())
    return {k: n / (len(counts) * c) for k, c in counts.items()}, n


def weight_column(label: str, weights: dict[int, float]) -> Column:
    out = None
    for k, w in weights.items():
        out = F.when(F.col(label) == k, F.lit(float(w))) if out is None else out.when(F.col(label) == k, F.lit(float(w)))
    return out


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features_vec").transform(df)


def prepared(
    df: DataFrame, features: Sequence[str], label: str, weights: dict[int, float] | None, keep: Sequence[str] = ()
) -> DataFrame:
    """Vector, label and weight columns only."""
    w = weight_column(label, weights) if weights else F.lit(1.0)
    out = assemble(df.withColumn("__w", w).withColumn("__y", F.col(label).cast("double")), features)
    return out.select("features_vec", "__y", "__w", *keep)


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, c: float = 1.0, max_iter: int = 1000) -> Model:
    """Balanced logistic regression; regParam = 1 / (c * rows) because Spark averages the loss."""
    weights, n = class_weights(train, label)
    est = LogisticRegression(
        featuresCol="features_vec", labelCol="__y", weightCol="__w", probabilityCol="prob_vec",
        maxIter=max_iter, regParam=1.0 / (c * n), standardization=False,
    )
    return est.fit(prepared(train, features, label, weights))


def fit_boosted(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    validation: DataFrame | None = None,
    positive_weight: float = POSITIVE_WEIGHT,
    rounds: int = 100,
    depth: int = 6,
    rate: float = 0.05,
    subsample: float = 0.8,
    feature_share: float = 0.8,
    min_rows: int = 1,
    tolerance: float = 0.01,
    seed: int = SEED,
) -> Model:
    """Boosted trees; with validation rows, boosting stops when their loss stops improving."""
    weights = {0: 1.0, 1: positive_weight}
    data = prepared(train.withColumn("__val", F.lit(False)), features, label, weights, ["__val"])
    est = GBTClassifier(
        featuresCol="features_vec", labelCol="__y", weightCol="__w", maxIter=rounds, maxDepth=depth,
        stepSize=rate, subsamplingRate=subsample, featureSubsetStrategy=str(feature_share),
        minInstancesPerNode=min_rows, seed=seed,
    )
    est.setProbabilityCol("prob_vec") if hasattr(est, "setProbabilityCol") else est._set(probabilityCol="prob_vec")
    if validation is not None:
        held = prepared(validation.withColumn("__val", F.lit(True)), features, label, weights, ["__val"])
        data = data.unionByName(held)
        est = est.setValidationIndicatorCol("__val")
        est._set(validationTol=tolerance)
    return est.fit(data)


def fit_forest(
    train: DataFrame, features: Sequence[str], label: str, positive_weight: float = POSITIVE_WEIGHT,
    trees: int = 100, depth: int = 6, subsample: float = 0.8, min_rows: int = 1, seed: int = SEED,
) -> Model:
    est = RandomForestClassifier(
        featuresCol="features_vec", labelCol="__y", weightCol="__w", numTrees=trees, maxDepth=depth,
        subsamplingRate=subsample, minInstancesPerNode=min_rows, seed=seed,
    )
    est._set(probabilityCol="prob_vec")
    return est.fit(prepared(train, features, label, {0: 1.0, 1: positive_weight}))


def fit_staged(
    train: DataFrame, features: Sequence[str], label: str, validation: DataFrame, patience: int = boosting.PATIENCE,
    positive_weight: float = POSITIVE_WEIGHT, **params,
) -> boosting.StagedTrees:
    """Boosted trees trained once in full; as many rounds count as the validation loss and patience say."""
    fitted = fit_boosted(train, features, label, positive_weight=positive_weight, **params)
    return boosting.stop_early(boosting.staged(fitted, features), validation, label, positive_weight, patience)


FITTERS: dict[str, Callable[..., Model]] = {
    "logistic_regression": fit_logistic,
    "boosted_trees": fit_boosted,
    "random_forest": fit_forest,
}


def fit_with_validation(kind: str, train: DataFrame, val: DataFrame, features: Sequence[str], label: str, params: dict) -> Model:
    """Boosted trees stop early on the validation rows; the other kinds have no rounds to stop."""
    held = {"validation": val} if kind == "boosted_trees" else {}
    return FITTERS[kind](train, features, label, **held, **params)


# Search spaces: parameter -> (kind, low, high).
SPACES: dict[str, dict[str, tuple[str, float, float]]] = {
    "logistic_regression": {"c": ("log", 1e-4, 10.0)},
    "boosted_trees": {
        "rounds": ("int", 100, 300),
        "depth": ("int", 3, 8),
        "rate": ("log", 0.01, 0.15),
        "subsample": ("uniform", 0.6, 1.0),
        "feature_share": ("uniform", 0.6, 1.0),
        "min_rows": ("int", 5, 50),
    },
    "random_forest": {
        "trees": ("int", 100, 300),
        "depth": ("int", 3, 8),
        "subsample": ("uniform", 0.6, 1.0),
        "min_rows": ("int", 5, 50),
    },
}


def draw(space: dict[str, tuple[str, float, float]], rng: random.Random) -> dict[str, float]:
    out = {}
    for name, (kind, low, high) in space.items():
        if kind == "int":
            out[name] = rng.randint(int(low), int(high))
        elif kind == "log":
            out[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            out[name] = rng.uniform(low, high)
    return out


def probabilities(df: DataFrame, model: Model | boosting.StagedTrees, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    if isinstance(model, boosting.StagedTrees):
        return df.select(*keep, model.probability().alias("probability"))
    scored = model.transform(assemble(df, features))
    return scored.select(*keep, vector_to_array("prob_vec")[1].alias("probability"))


def score(
    df: DataFrame, model: Model, features: Sequence[str], threshold: float = 0.5, row_id: str = S.ROW_ID
) -> DataFrame:
    """row id, probability (6 places), prediction from the unrounded probability. Also for streams."""
    raw = probabilities(df, model, features, [row_id])
    return raw.select(
        F.col(row_id).cast("bigint").alias(S.ROW_ID),
        F.round("probability", 6).alias("probability"),
        C.decide("probability", threshold).alias("prediction"),
    )


def attach_predictions(features: DataFrame, predictions: DataFrame, row_id: str = S.ROW_ID) -> DataFrame:
    return features.join(predictions, row_id, "inner")


def evaluate(df: DataFrame, model: Model, features: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """auc, ks, gini, pr_auc (4 places) of a fitted model on df."""
    return metrics.metric_bundle(probabilities(df, model, features, [label, *by]), label, "probability", by)


REPORT = "champion_name string, test_auc double, test_ks double, test_gini double, test_pr_auc double, optimal_threshold double, auc_threshold double, passes_threshold boolean, feature_columns array<string>"


def evaluation_report(df: DataFrame, model: Model | boosting.StagedTrees, features: Sequence[str], label: str, name: str) -> DataFrame:
    """One row of REPORT: quality on df, the threshold of least cost there, and the gate on the AUC."""
    scored = probabilities(df, model, features, [label])
    bundle = metrics.metric_bundle(scored, label, "probability")
    best = F.lit(metrics.cost_optimal(metrics.threshold_sweep(scored, label, "probability")).first().threshold)
    one = bundle.select(*[F.col(c).alias(f"test_{c}") for c in ("auc", "ks", "gini", "pr_auc")], best.alias("optimal_threshold"))
    gated = metrics.promotion_gate(one).withColumn("champion_name", F.lit(name))
    return gated.withColumn("feature_columns", F.array(*map(F.lit, features))).select(*[c.split()[0] for c in REPORT.split(", ")])


def cross_validate(
    df: DataFrame, kind: str, features: Sequence[str], label: str, keys: Sequence[str], k: int = 5,
    seed: int = SEED, parallelism: int = 4, **params,
) -> DataFrame:
    """Stratified k-fold AUC: mean and population deviation over folds. Fits run side by side."""
    folds = stratified_folds(df, label, keys, k, seed).select(*features, label, "fold").persist()

    def one(i: int) -> float:
        model = FITTERS[kind](folds.where(F.col("fold") != i), features, label, **params)
        return evaluate(folds.where(F.col("fold") == i), model, features, label).first().auc

    try:
        with ThreadPool(min(parallelism, k)) as pool:
            aucs = pool.map(one, range(k))
    finally:
        folds.unpersist()
    mean = sum(aucs) / k
    spread = math.sqrt(sum((a - mean) ** 2 for a in aucs) / k)
    return df.sparkSession.createDataFrame(
        [(kind, k, round(mean, 4), round(spread, 4))], "model string, folds int, cv_auc_mean double, cv_auc_std double"
    )


def _logistic_trials(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str, drawn: Sequence[dict[str, float]]
) -> list[tuple[int, float, float]] | None:
    """(trial, auc, ks) of all trials, fitted and scored side by side; None when the labels are not 0 and 1 or
    something else than c is searched."""
    if any(set(d) != {"c"} for d in drawn):
        return None
    weights, _ = class_weights(train, label)
    if set(weights) != {0, 1}:
        return None
    fitted = logistic.fit_all(train, features, label, [logistic.Fit(d["c"], weights) for d in drawn])
    found = {r.fit: (r.fit, r.auc, r.ks) for r in logistic.quality(val, features, label, fitted).collect()}  # a row per trial
    return [found[i] for i in range(len(drawn))] if len(found) == len(drawn) else None


def search(
    train: DataFrame, val: DataFrame, kind: str, features: Sequence[str], label: str, trials: int = 50,
    seed: int = SEED, parallelism: int = 4, space: dict | None = None,
) -> tuple[DataFrame, dict[str, float]]:
    """Seeded random search for the highest validation AUC: (one row per trial, best parameters)."""
    rng = random.Random(seed)
    drawn = [draw(space or SPACES[kind], rng) for _ in range(trials)]

    def one(i: int) -> tuple[int, float, float]:
        row = evaluate(val, fit_with_validation(kind, train, val, features, label, drawn[i]), features, label).first()
        return i, row.auc, row.ks

    results = _logistic_trials(train, val, features, label, drawn) if kind == "logistic_regression" else None
    if results is None:
        train, val = (df.select(*features, label).persist() for df in (train, val))
        try:
            with ThreadPool(min(parallelism, trials)) as pool:
                results = pool.map(one, range(trials))
        finally:
            train.unpersist()
            val.unpersist()
    best = max(results, key=lambda r: (r[1], -r[0]))
    rows = [(kind, i, auc, ks, {k: float(v) for k, v in drawn[i].items()}, i == best[0]) for i, auc, ks in results]
    frame = train.sparkSession.createDataFrame(
        rows, "model string, trial int, val_auc double, val_ks double, params map<string,double>, best boolean"
    )
    return frame, drawn[best[0]]


#: The parameter that says how long a trial of a kind trains.
EFFORT = {"boosted_trees": "rounds", "random_forest": "trees"}


def search_trees(
    train: DataFrame, val: DataFrame, kind: str, features: Sequence[str], label: str, trials: int = 50, least: int = 10,
    factor: int = 3, seed: int = SEED, space: dict | None = None, patience: int = boosting.PATIENCE,
) -> tuple[DataFrame, dict[str, float], boosting.StagedTrees]:
    """Seeded search over trees by rungs: every trial trains `least` rounds (or trees), the best 1 / factor
    of them by validation AUC go on with factor times as many, and the last rung trains in full.

    (a row per trial and rung it reached, best parameters, their model). Boosted trees stop early by
    patience. All trials of a rung grow side by side over binned rows (operators/trees.py), and a trial that goes on
    keeps its trees; a trial needs `rounds` or `trees` in the space.
    """
    rng, effort = random.Random(seed), EFFORT[kind]
    drawn = [draw(space or SPACES[kind], rng) for _ in range(trials)]
    part = lambda df, name: df.select(*features, label, F.lit(name).alias("__part"))
    both = part(train, "train").unionByName(part(val, "val"))
    cells = trees.cells(both, features, label, "__part", ["train", "val"], POSITIVE_WEIGHT)
    rest = {"feature_share": 0.8} if kind == "boosted_trees" else {}

    def fit_of(params: dict[str, float], most: int) -> trees.Fit:
        return trees.Fit(kind, int(min(params[effort], most)), **(rest | {k: v for k, v in params.items() if k != effort}))

    rows, left, best, grown = [], list(range(trials)), None, {}
    for rung, (many, most) in enumerate(boosting.rungs(trials, least, max(int(d[effort]) for d in drawn), factor), 1):
        left = left[:many]
        fits, before = [fit_of(drawn[i], most) for i in left], [grown.get(i) for i in left]
        # trees of the rung before are grown on, not anew
        found = trees.boosted(cells, fits, patience, before) if kind == "boosted_trees" else trees.forests(cells, fits, before)
        grown = dict(zip(left, found))
        scores = {r.model: r for r in trees.quality(cells, {i: g.counted() for i, g in grown.items()}, ["val"]).collect()}  # a row per trial
        left = sorted(left, key=lambda i: (-scores[i].auc, i))
        best = (left[0], grown[left[0]].counted())
        rows += [(kind, i, rung, len(grown[i].counted().trees), scores[i].auc, scores[i].ks, {k: float(v) for k, v in drawn[i].items()}) for i in sorted(left)]
    rows = [(*r, r[1] == best[0] and r[2] == rung) for r in rows]
    frame = train.sparkSession.createDataFrame(
        rows, "model string, trial int, rung int, rounds int, val_auc double, val_ks double, params map<string,double>, best boolean"
    )
    return frame, drawn[best[0]], best[1].model(cells)


def refit(
    train: DataFrame, val: DataFrame, kind: str, features: Sequence[str], label: str, params: dict
) -> tuple[Model, DataFrame]:
    """Model with the best parameters and its validation auc and ks."""
    model = fit_with_validation(kind, train, val, features, label, params)
    return model, evaluate(val, model, features, label).select(F.lit(kind).alias("model"), F.col("auc").alias("val_auc"), F.col("ks").alias("val_ks"))


def linear_attribution(df: DataFrame, model: Model, features: Sequence[str], background: DataFrame) -> DataFrame:
    """coef * (x - mean) per row, averaged as absolute values per feature: exact for a linear model.

    The means are those of `background`, the rows the model was trained on."""
    means = background.agg(*[F.avg(f).alias(f) for f in features]).first()
    coefs = model.coefficients
    pairs = [
        F.struct(
            F.lit(f).alias("feature"),
            F.abs(F.lit(float(coefs[i])) * (F.col(f) - F.lit(float(means[f])))).alias("share"),
        )
        for i, f in enumerate(features)
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("feature")
        .agg(F.round(F.avg("share"), 6).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def _placed(df: DataFrame, by: Sequence[str], h: Column, ties: Sequence[str]) -> DataFrame:
    """df with its place __i, from 1, per `by` in the order of a 64-bit hash."""
    sliced = df.withColumns({"__h": h, "__one": F.lit(1)}).withColumn("__slice", F.shiftright("__h", 50))
    return running_sums(sliced, by, "__slice", [F.col("__h"), *map(F.col, ties)], {"__i": "__one"}).drop("__h", "__one", "__slice")


def permutation_importance(
    sample: DataFrame, model: Model, features: Sequence[str], label: str, row_id: str, seed: int = SEED
) -> DataFrame:
    """Loss of AUC when one column is shuffled, over all rows given, in one scoring job.

    Rows and values get their places from counts per hash slice, so no task ranks a whole column.
    """
    numbers = [F.col(f).cast("double").alias(f) for f in features]
    placed, path = _placed(sample.select(row_id, label, *numbers), [], F.xxhash64(row_id), [row_id]).drop(row_id), shared_dir(sample.sparkSession, "placed")
    placed.write.parquet(path)  # read three times below
    base = sample.sparkSession.read.schema(placed.schema).parquet(path)
    melted = base.select(
        "__i", F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("__v")) for f in features]))
    )
    mixed = F.xxhash64(F.lit(seed), "feature", "__from")
    moved = _placed(melted.withColumnRenamed("__i", "__from"), ["feature"], mixed, ["__from"]).select("feature", "__v", "__i")
    variants = base.join(moved, "__i").withColumns(
        {f: F.when(F.col("feature") == f, F.col("__v")).otherwise(F.col(f)) for f in features}
    )
    plain = base.withColumn("feature", F.lit("")).withColumn("__v", F.lit(0.0))
    scored = probabilities(plain.unionByName(variants), model, features, ["feature", label])
    auc = metrics.raw_metrics(
        metrics.score_curve(metrics.score_histogram(scored, label, "probability", ["feature"]), ["feature"]), ["feature"]
    ).select("feature", "auc")
    every = auc.agg(F.max(F.when(F.col("feature") == "", F.col("auc"))).alias("whole"), F.collect_list(F.struct("feature", "auc")).alias("each"))
    each = every.select("whole", F.inline("each"))  # a row per feature, from one run of all that is above
    return each.where(F.col("feature") != "").select("feature", F.round(F.col("whole") - F.col("auc"), 6).alias("importance")).orderBy(
        F.desc("importance"), "feature"
    )


def segment(df: DataFrame, features: Sequence[str], k: int, keep: Sequence[str] = (), seed: int = SEED) -> DataFrame:
    """k-means segment of each row."""
    data = assemble(df, features)
    fitted = KMeans(featuresCol="features_vec", predictionCol="segment", k=k, seed=seed).fit(data)
    return fitted.transform(data).select(*keep, *features, "segment")


def compare_outputs(champion: DataFrame, challenger: DataFrame, row_id: str = S.ROW_ID) -> DataFrame:
    """Shadow comparison on common rows: rows, agreement rate, mean score gap, PSI of the scores."""
    a = champion.select(row_id, F.col("probability").alias("p_a"), F.col("prediction").alias("d_a"))
    b = challenger.select(row_id, F.col("probability").alias("p_b"), F.col("prediction").alias("d_b"))
    psi = drift.psi_numeric(champion, challenger, ["probability"]).select("psi").scalar()
    return a.join(b, row_id).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg((F.col("d_a") == F.col("d_b")).cast("double")), 6).alias("agreement"),
        F.round(F.avg(F.col("p_b") - F.col("p_a")), 6).alias("mean_gap"),
    ).withColumn("psi", psi)


def traffic_arm(key: Column, challenger_percent: int) -> Column:
    """champion or challenger by one of 100 buckets of the key's MD5, which any engine can repeat."""
    bucket = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % 100
    return F.when(bucket < challenger_percent, "challenger").otherwise("champion")
