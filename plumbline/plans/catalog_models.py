"""Queries that train, search, score and explain models."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import schema as S
from plumbline.operators import model, prep, trees
from plumbline.plans.catalog_metrics import psi_sql
from plumbline.plans.catalog_profile import split_lines
from plumbline.plans.registry import LINE_KEY, LINES_SQL, NUMBERS, SCORED_SQL, lines, query, scored, table, written
from plumbline.session import shared_dir
from plumbline.sources import files

FEATURES_USED = NUMBERS
SPLITS = ["train", "val", "test"]


def train_and_rest(spark, sf_dir):
    df = written(split_lines(spark, sf_dir).select(*LINE_KEY, "y", "split", *NUMBERS), "splits")
    return df.where(F.col("split") == "train"), df.where(F.col("split") != "train")


def matrices(spark, sf_dir):
    """Standardised splits with row id, label and split name, each layer computed once."""
    df = split_lines(spark, sf_dir).select(F.xxhash64(*LINE_KEY).alias(S.ROW_ID), "y", "split", *NUMBERS)
    df = written(df, "splits")
    fitted = prep.fit(df.where(F.col("split") == "train"), NUMBERS)
    return written(fitted.transform(df, [S.ROW_ID, "y", "split"]), "matrices")


def part(df, name):
    return df.where(F.col("split") == name)


@query("T1, T7")
def logistic_regression(spark, sf_dir):
    data = matrices(spark, sf_dir)
    fitted = model.fit_logistic(part(data, "train"), FEATURES_USED, "y")
    return model.evaluate(data, fitted, FEATURES_USED, "y", ["split"])


@query("T2, T3, T4")
def boosted_trees(spark, sf_dir):
    data = matrices(spark, sf_dir)
    fitted = model.fit_boosted(part(data, "train"), FEATURES_USED, "y", part(data, "val"))
    return model.evaluate(data, fitted, FEATURES_USED, "y", ["split"])


@query("T2")
def random_forest(spark, sf_dir):
    """Quality per split of 100 trees grown side by side over binned rows."""
    cells = trees.cells(matrices(spark, sf_dir), FEATURES_USED, "y", "split", SPLITS, model.POSITIVE_WEIGHT)
    (fitted,) = trees.forests(cells, [trees.Fit("random_forest", 100)])
    return trees.quality(cells, {0: fitted}, SPLITS).withColumnRenamed("part", "split").drop("model")


@query(
    "T1, T3",
    f"""WITH {LINES_SQL} SELECT y, count(*) AS n, round(count(*) * CASE WHEN y = 1 THEN (SELECT count(*)::double / (2 * sum(y)) FROM lines) ELSE (SELECT count(*)::double / (2 * sum(1 - y)) FROM lines) END, 3) AS weight FROM lines GROUP BY 1""",
)
def class_weights(spark, sf_dir):
    """Balanced weights make both classes weigh the same."""
    df = lines(spark, sf_dir)
    weights, _ = model.class_weights(df, "y")
    weighted = df.select("y", model.weight_column("y", weights).alias("w"))
    return weighted.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("w"), 3).alias("weight"))


@query("T5")
def cross_validation(spark, sf_dir):
    data = part(matrices(spark, sf_dir), "train")
    return model.cross_validate(data, "logistic_regression", FEATURES_USED, "y", [S.ROW_ID], k=3)


@query("T6")
def parameter_search(spark, sf_dir):
    data = matrices(spark, sf_dir)
    trials, _ = model.search(part(data, "train"), part(data, "val"), "logistic_regression", FEATURES_USED, "y")
    return trials.select("model", "trial", "val_auc", "val_ks", F.element_at("params", "c").alias("c"), "best")


def tree_trials(spark, sf_dir, kind):
    data = matrices(spark, sf_dir)
    trials, _, _ = model.search_trees(part(data, "train"), part(data, "val"), kind, FEATURES_USED, "y", trials=6)
    return trials


@query("T4, T6")
def boosted_search(spark, sf_dir):
    """Six trials of the boosted space by rungs of 10, 30 and all rounds, stopped early by patience."""
    return tree_trials(spark, sf_dir, "boosted_trees")


@query("T6")
def forest_search(spark, sf_dir):
    return tree_trials(spark, sf_dir, "random_forest")


@query("T4")
def boosting_rounds(spark, sf_dir):
    """Loss and quality on the validation rows after every tenth round of one fit."""
    cells = trees.cells(matrices(spark, sf_dir), FEATURES_USED, "y", "split", ["train", "val"], model.POSITIVE_WEIGHT)
    (fitted,) = trees.boosted(cells, [trees.Fit("boosted_trees", 60, feature_share=0.8)], patience=None)
    quality = trees.quality(cells, {n: fitted.cut(n) for n in range(10, 61, 10)}, ["val"]).withColumnRenamed("model", "rounds").drop("part")
    losses = spark.createDataFrame([*enumerate(fitted.losses, 1)], "rounds int, loss double")  # a row per round
    return quality.join(losses.withColumn("loss", F.round("loss", 6)), "rounds")


@query("T7")
def refitted_model(spark, sf_dir):
    data = matrices(spark, sf_dir)
    train, val = part(data, "train"), part(data, "val")
    _, best = model.search(train, val, "logistic_regression", FEATURES_USED, "y")
    return model.refit(train, val, "logistic_regression", FEATURES_USED, "y", best)[1]


@query("T8")
def batch_scores(spark, sf_dir):
    """Scores with the threshold and the features that the stored evaluation report names."""
    data = matrices(spark, sf_dir)
    fitted = model.fit_logistic(part(data, "train"), FEATURES_USED, "y")
    path = shared_dir(spark, "evaluation")
    files.write_report(model.evaluation_report(part(data, "val"), fitted, FEATURES_USED, "y", "logistic_regression"), path)
    report = files.read_report(spark, path, T.StructType.fromDDL(model.REPORT)).first()
    return model.score(data.where(F.col("split") != "train"), fitted, report.feature_columns, report.optimal_threshold)


@query(
    "T9",
    f"WITH {SCORED_SQL} SELECT e.event_id AS row_id, e.event_type, e.value, s.p AS probability FROM events e JOIN scored s USING (event_id)",
)
def predictions_attached(spark, sf_dir):
    features = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), "event_type", "value")
    predictions = scored(spark, sf_dir).select(F.col("event_id").alias("row_id"), F.col("p").alias("probability"))
    return model.attach_predictions(features, predictions)


@query("T10")
def linear_attribution(spark, sf_dir):
    data = matrices(spark, sf_dir)
    fitted = model.fit_logistic(part(data, "train"), FEATURES_USED, "y")
    return model.linear_attribution(part(data, "val"), fitted, FEATURES_USED, part(data, "train"))


@query("T10")
def permutation_importance(spark, sf_dir):
    data = matrices(spark, sf_dir)
    fitted = model.fit_logistic(part(data, "train"), FEATURES_USED, "y")
    return model.permutation_importance(part(data, "val"), fitted, FEATURES_USED, "y", S.ROW_ID)


@query("T11")
def customer_segments(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    return model.segment(df, ["c_acctbal", "nation"], 4, ["c_custkey"])


@query(
    "T12",
    f"""WITH {SCORED_SQL}, a AS (SELECT event_id, p, p >= 0.3 AS d FROM scored), b AS (SELECT event_id, round(p, 1) AS p, round(p, 1) >= 0.3 AS d FROM scored)
    SELECT (SELECT count(*) FROM a) AS rows, (SELECT round(avg(CASE WHEN a.d = b.d THEN 1.0::double ELSE 0.0 END), 6) FROM a JOIN b USING (event_id)) AS agreement,
    (SELECT round(avg(b.p - a.p), 6) + 0.0 FROM a JOIN b USING (event_id)) AS mean_gap, psi FROM ({psi_sql('p', 'a', 'b', 'p')})""",
)
def shadow_comparison(spark, sf_dir):
    base = scored(spark, sf_dir).select(F.col("event_id").alias(S.ROW_ID), F.col("p").alias("probability"))
    champion = base.withColumn("prediction", (F.col("probability") >= 0.3).cast("int"))
    rounded = base.withColumn("probability", F.round("probability", 1))
    challenger = rounded.withColumn("prediction", (F.col("probability") >= 0.3).cast("int"))
    return model.compare_outputs(champion, challenger).withColumn("mean_gap", F.col("mean_gap") + F.lit(0.0))


@query(
    "T12",
    """SELECT CASE WHEN ('0x' || substr(md5(c_custkey::varchar), 1, 8))::bigint % 100 < 10 THEN 'challenger' ELSE 'champion' END AS arm, count(*) AS requests FROM customer GROUP BY 1""",
)
def traffic_split(spark, sf_dir):
    """One request in ten goes to the challenger, always the same ones."""
    df = table(spark, sf_dir, "customer")
    return df.groupBy(model.traffic_arm(F.col("c_custkey"), 10).alias("arm")).agg(F.count(F.lit(1)).alias("requests"))
