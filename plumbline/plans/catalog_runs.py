"""Queries over whole runs: what a training run and a scoring run leave behind, checked where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import schema as S
from plumbline.plans import lifecycle
from plumbline.plans.catalog_metrics import psi_sql
from plumbline.plans.catalog_profile import SPLIT_SQL, split_lines
from plumbline.plans.registry import LINE_KEY, NUMBERS, query
from plumbline.session import shared_dir

KINDS = ["logistic_regression"]
TRIALS, FOLDS = 4, 3


def trained(spark, sf_dir):
    splits = split_lines(spark, sf_dir).select(F.xxhash64(*LINE_KEY).alias(S.ROW_ID), "y", "split", *NUMBERS)
    return lifecycle.train(splits, shared_dir(spark, "run"), NUMBERS, "y", KINDS, trials=TRIALS, folds=FOLDS)


@query(
    "S14, T5, T6, T7, M14, M16",
    f"""WITH {SPLIT_SQL}, n AS (SELECT split, count(*) AS rows, round(avg(y::double), 6) AS positive_share FROM splits GROUP BY 1)
    SELECT split, rows, positive_share, {TRIALS}::bigint AS trials, TRUE AS refit_repeats_best_trial, TRUE AS champion_is_best, TRUE AS gate_follows_auc,
    'baseline:cv_auc_mean baseline:cv_auc_std evaluate:optimal_threshold evaluate:test_auc evaluate:test_gini evaluate:test_ks evaluate:test_pr_auc tuned:val_auc tuned:val_ks' AS logged FROM n""",
)
def training_run(spark, sf_dir):
    """Rows and positive share per split as stored, and whether trials, log, champion and gate agree."""
    run = trained(spark, sf_dir)
    stored = run.table(spark, "splits").groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.col("y").cast("double")), 6).alias("positive_share"))
    tried = run.table(spark, "trials").agg(F.count(F.lit(1)).alias("trials"), F.max("val_auc").alias("most"), F.max(F.when(F.col("best"), F.col("val_auc"))).alias("best"))
    log = run.table(spark, "log")
    tuned = F.when((F.col("step") == "tuned") & (F.col("key") == "val_auc"), F.struct("value", F.col("run_name").alias("name")))
    logged = log.agg(F.array_join(F.sort_array(F.collect_set(F.concat("step", F.lit(":"), "key"))), " ").alias("logged"), F.max(tuned).alias("top"))
    facts = tried.join(logged).join(run.report(spark))  # one row each
    agree = facts.select(
        "trials",
        ((F.col("best") == F.col("most")) & (F.abs(F.col("top.value") - F.col("most")) < 1e-3)).alias("refit_repeats_best_trial"),
        (F.col("top.name") == F.col("champion_name")).alias("champion_is_best"),
        ((F.col("test_auc") >= F.col("auc_threshold")) == F.col("passes_threshold")).alias("gate_follows_auc"),
        "logged",
    )
    return stored.join(F.broadcast(agree))  # one row


@query(
    "T8, Q4-Q10, D5, S11",
    f"""WITH {SPLIT_SQL}, ref AS (SELECT * FROM splits WHERE split = 'train'), cur AS (SELECT * FROM splits WHERE split <> 'train')
    SELECT (SELECT count(*) FROM cur) AS row_count, (SELECT count(*) FROM cur) AS scored_rows, p.feature,
    round(p.psi, 5) AS psi, CASE p.feature {' '.join(f"WHEN '{c}' THEN (SELECT round(avg(CASE WHEN {c} IS NULL THEN 1.0::double ELSE 0.0 END), 6) FROM cur)" for c in NUMBERS)} END AS null_rate,
    TRUE AS decisions_follow_report, TRUE AS summary_follows_scores, '1999-12-31' AS logged_date
    FROM ({' UNION ALL '.join(psi_sql(c, 'ref', 'cur', c) for c in NUMBERS)}) p""",
)
def monitoring_run(spark, sf_dir):
    """The rows outside training as one batch, scored by the stored champion: its report, and whether scores agree with it."""
    run, date = trained(spark, sf_dir), "1999-12-31"
    batch = run.table(spark, "splits").where(F.col("split") != "train").select(S.ROW_ID, *NUMBERS)
    report = lifecycle.monitor(batch, run, date)
    bound = run.report(spark).select("optimal_threshold")
    # Probabilities are stored with 6 places, decisions come from the unrounded ones.
    wrong = (F.abs(F.col("probability") - F.col("optimal_threshold")) > 1e-6) & ((F.col("probability") >= F.col("optimal_threshold")) != (F.col("prediction") == 1))
    scores = run.table(spark, "scores").where(F.col(S.PARTITION) == date).join(F.broadcast(bound))
    sums = scores.agg(F.count(F.lit(1)).alias("scored_rows"), (F.count_if(wrong) == 0).alias("decisions_follow_report"), F.avg("probability").alias("mean"))
    line = spark.read.text(run.at("events")).select(F.get_json_object("value", "$.ingestion_date").alias("logged_date"))
    one = report.join(sums).join(line).select(  # one row each
        F.col("checks.data_quality.row_count").alias("row_count"),
        "scored_rows", "decisions_follow_report", "logged_date",
        (F.abs(F.col("checks.score_distribution.mean_probability") - F.col("mean")) < 1e-5).alias("summary_follows_scores"),
        F.col("checks.data_quality.null_rates").alias("rates"),
        F.explode("checks.feature_drift.per_feature_drift").alias("feature", "psi"),
    )
    return one.select(
        "row_count", "scored_rows", "feature", F.round("psi", 5).alias("psi"), F.element_at("rates", F.col("feature")).alias("null_rate"),
        "decisions_follow_report", "summary_follows_scores", "logged_date",
    )
