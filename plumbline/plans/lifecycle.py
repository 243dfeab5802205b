"""A training run and a scoring run from end to end; each leaves its tables, reports and run log below a root.

Training: splits, fitted transformer, reference profile, a baseline and a search per kind of model, the
champion refitted and saved, its report with the gate on the test rows. Scoring: the gate on the batch, scores
by the saved model at the threshold of the report, the three checks, the monitoring report and its log line.
Everything a scoring run needs is read back from the root, so the two may run in different sessions.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import schema as S
from plumbline.operators import metrics, model, prep, quality
from plumbline.sources import files

LOADERS = {
    "logistic_regression": LogisticRegressionModel,
    "boosted_trees": GBTClassificationModel,
    "random_forest": RandomForestClassificationModel,
}


@dataclass(frozen=True)
class Run:
    """The folders of one training run and what its scoring runs add."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.at(name))

    def report(self, spark: SparkSession) -> DataFrame:
        return files.read_report(spark, self.at("evaluation"), T.StructType.fromDDL(model.REPORT))

    def scaler(self, spark: SparkSession) -> prep.Scaler:
        return prep.Scaler.from_json(spark.read.text(self.at("transformer"), wholetext=True).first().value)

    def champion(self, spark: SparkSession) -> Model:
        return LOADERS[self.report(spark).first().champion_name].load(self.at("model"))


def train(
    splits: DataFrame, root: str, features: Sequence[str], label: str, kinds: Sequence[str], row_id: str = S.ROW_ID,
    trials: int = 50, folds: int = 5, run_id: str = "run", spaces: dict[str, dict] | None = None,
) -> Run:
    """splits: row id, label, features and split (train, val, test). Ties between kinds go to the first named."""
    spark, run = splits.sparkSession, Run(root)
    files.write_splits(splits, run.at("splits"), [row_id, *features], label)
    stored = run.table(spark, "splits")
    raw = stored.where(F.col("split") == "train")
    files.require_rows(raw, "training rows")
    fitted = prep.fit(raw, features)
    spark.createDataFrame([(fitted.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(run.at("transformer"))
    prep.profile_document(prep.reference_profile(raw, features)).coalesce(1).write.mode("overwrite").text(run.at("profile"))
    files.write_splits(fitted.transform(stored, [row_id, label, "split"]), run.at("matrices"), [row_id, *features], label)
    part = lambda name: run.table(spark, "matrices").where(F.col("split") == name)

    tuned = {}
    for kind in kinds:
        baseline = model.cross_validate(part("train"), kind, features, label, [row_id], k=folds)
        _log(baseline, run, run_id, "baseline", ["cv_auc_mean", "cv_auc_std"])
        found, best = model.search(part("train"), part("val"), kind, features, label, trials, space=(spaces or {}).get(kind))
        files.write_by(found, run.at("trials"), ["model"])
        chosen, scores = model.refit(part("train"), part("val"), kind, features, label, best)
        _log(scores, run, run_id, "tuned", ["val_auc", "val_ks"])
        tuned[kind] = (scores.first().val_auc, chosen)
    name = max(tuned, key=lambda k: tuned[k][0])
    tuned[name][1].write().overwrite().save(run.at("model"))
    report = model.evaluation_report(part("test"), tuned[name][1], features, label, name)
    files.write_report(report, run.at("evaluation"))
    keys = ["test_auc", "test_ks", "test_gini", "test_pr_auc", "optimal_threshold"]
    _log(run.report(spark).withColumnRenamed("champion_name", "model"), run, run_id, "evaluate", keys)
    return run


def _log(df: DataFrame, run: Run, run_id: str, step: str, keys: Sequence[str]) -> None:
    for kind in [r.model for r in df.select("model").collect()]:  # one row per kind of model
        files.append_run_log(files.run_rows(df.where(F.col("model") == kind), run_id, kind, step, keys), run.at("log"))


def monitor(batch: DataFrame, run: Run, date: str, row_id: str = S.ROW_ID, release: bool = False) -> DataFrame:
    """Score one batch and write its monitoring report; the report as read back.

    A batch that fails the gate is not scored: its report has the quality section alone. Scores replace
    those of the same date, so a repeated run leaves one copy. With `release`, a champion below the AUC
    gate raises instead of scoring.
    """
    spark, began = batch.sparkSession, time.monotonic()
    stored = run.report(spark).first()
    if release and not stored.passes_threshold:
        raise ValueError(f"{stored.champion_name} is below the gate of {stored.auc_threshold}")
    features = stored.feature_columns
    context = {"features": batch, "expected": features, "numeric": features, "threshold": stored.optimal_threshold}
    names = ["data_quality"]
    if quality.scoring_gate(batch, features).first().is_valid:
        scaled = run.scaler(spark).transform(batch, [row_id])
        scores = model.score(scaled, run.champion(spark), features, stored.optimal_threshold, row_id)
        files.write_partitioned(scores, run.at("scores"), date)
        context["predictions"] = files.read_partition(spark, run.at("scores"), date)
        context["reference"] = run.table(spark, "splits").where(F.col("split") == "train")
        names += ["feature_drift", "score_distribution"]
    report = quality.build_report(quality.run_checks(context, names), date, round(time.monotonic() - began, 3))
    path = run.at(f"monitoring/{S.PARTITION}={date}")
    files.write_report(report, path)
    read = files.read_report(spark, path, S.MONITORING_REPORT)
    quality.event_line(read).write.mode("overwrite").text(run.at(f"events/{S.PARTITION}={date}"))
    return read
