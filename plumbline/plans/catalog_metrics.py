"""Queries for classifier quality, drift and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import drift, metrics
from plumbline.plans.registry import LINES_SQL, NUMBERS, SCORED_SQL, lines, query, scored, table
from plumbline.session import shared_dir


def curve_sql(source="scored", by=(), score="p"):
    g = "".join(f"{c}, " for c in by)
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return f"""g AS (SELECT {g}{score} AS score, sum(y)::double AS pos, sum(1 - y)::double AS neg FROM {source} GROUP BY {g}{score}),
curve AS (SELECT *, sum(pos) OVER ({part} ORDER BY score DESC) AS tp, sum(neg) OVER ({part} ORDER BY score DESC) AS fp,
  sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS n FROM g)"""


AUC, KS = "sum(neg * (tp - pos / 2)) / (max(p) * max(n))", "greatest(0, max(tp / p - fp / n))"
AP = "sum(pos / p * tp / (tp + fp))"

# The same scores as three models over two splits: by event parity, direct and mirrored.
MODELS_SQL = f"""{SCORED_SQL}, models AS (SELECT 'direct' AS model, CASE WHEN event_id % 3 = 0 THEN 'val' ELSE 'train' END AS split, y, p AS q FROM scored
  UNION ALL SELECT 'mirror', CASE WHEN event_id % 3 = 0 THEN 'val' ELSE 'train' END, y, round(1 - p, 6) FROM scored
  UNION ALL SELECT 'coarse', CASE WHEN event_id % 3 = 0 THEN 'val' ELSE 'train' END, y, round(p, 2) FROM scored)"""


def models(spark, sf_dir):
    df = scored(spark, sf_dir)
    split = F.when(F.col("event_id") % 3 == 0, "val").otherwise("train")
    scores = {"direct": F.col("p"), "mirror": F.round(1 - F.col("p"), 6), "coarse": F.round("p", 2)}
    rows = F.inline(F.array(*[F.struct(F.lit(k).alias("model"), v.alias("q")) for k, v in scores.items()]))
    return df.select(split.alias("split"), "y", rows)


def events_curve(spark, sf_dir):
    return metrics.score_curve(metrics.score_histogram(scored(spark, sf_dir), "y", "p"))


def _one_metric(expression, name):
    return f"WITH {SCORED_SQL}, {curve_sql()} SELECT round({expression}, 6) AS {name} FROM curve"


@query("M1", _one_metric(AUC, "auc"))
def roc_auc(spark, sf_dir):
    return metrics.raw_metrics(events_curve(spark, sf_dir)).select(F.round("auc", 6).alias("auc"))


@query("M2", _one_metric(KS, "ks"))
def ks_statistic(spark, sf_dir):
    return metrics.raw_metrics(events_curve(spark, sf_dir)).select(F.round("ks", 6).alias("ks"))


@query("M3", _one_metric(f"2 * ({AUC}) - 1", "gini"))
def gini(spark, sf_dir):
    return metrics.raw_metrics(events_curve(spark, sf_dir)).select(F.round("gini", 6).alias("gini"))


@query("M4", _one_metric(AP, "pr_auc"))
def average_precision(spark, sf_dir):
    return metrics.raw_metrics(events_curve(spark, sf_dir)).select(F.round("pr_auc", 6).alias("pr_auc"))


@query(
    "M1-M4",
    f"""WITH labelled AS (SELECT l.quality AS y, round(least(d.n_chars / 20000.0::double, 1.0), 6) AS p FROM documents d JOIN labels l USING (doc_id)),
    {curve_sql('labelled')} SELECT round({AUC}, 6) AS auc, round({KS}, 6) AS ks, round({AP}, 6) AS pr_auc FROM curve""",
)
def document_score_quality(spark, sf_dir):
    """Length as a score of the quality label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    df = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    df = df.select(F.col("quality").alias("y"), F.least(F.col("n_chars") / 20000.0, F.lit(1.0)).alias("p"))
    out = metrics.raw_metrics(metrics.score_curve(metrics.score_histogram(df, "y", "p")))
    return out.select(*[F.round(c, 6).alias(c) for c in ("auc", "ks", "pr_auc")])


@query(
    "M5",
    f"""WITH {SCORED_SQL}, {curve_sql()} SELECT round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr, score AS threshold FROM curve
    UNION ALL SELECT 0.0, 0.0, 'inf'::double""",
)
def roc_points(spark, sf_dir):
    df = metrics.roc_points(events_curve(spark, sf_dir))
    return df.select(F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"), "threshold")


@query(
    "M6",
    f"""WITH {SCORED_SQL}, {curve_sql()} SELECT round(tp / p, 6) AS recall, round(tp / (tp + fp), 6) AS precision, score AS threshold, round(p / (p + n), 6) AS base_rate FROM curve""",
)
def pr_points(spark, sf_dir):
    df = metrics.pr_points(events_curve(spark, sf_dir))
    return df.select(*[F.round(c, 6).alias(c) if c != "threshold" else F.col(c) for c in df.columns])


@query(
    "M7",
    f"""WITH {SCORED_SQL}, {curve_sql()} SELECT arg_max(score, (round(tp / p - fp / n, 12), score)) AS threshold, round(max(tp / p - fp / n), 6) AS gap FROM curve""",
)
def ks_threshold(spark, sf_dir):
    return metrics.ks_threshold(events_curve(spark, sf_dir))


@query(
    "M8",
    f"""WITH {SCORED_SQL} SELECT day, count(*) FILTER (WHERE y = 0 AND p < 0.3) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.3) AS fp,
    count(*) FILTER (WHERE y = 1 AND p < 0.3) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.3) AS tp FROM scored GROUP BY 1""",
)
def confusion(spark, sf_dir):
    return metrics.confusion(scored(spark, sf_dir), "y", "p", 0.3, ["day"])


def sweep_sql(source="scored", by=(), score="p"):
    g = "".join(f"s.{c}, " for c in by)
    group = "".join(f"s.{c}, " for c in by) + "t.i, t.t"
    return f"""grid AS (SELECT i, CASE WHEN i = 199 THEN 0.99::double ELSE 0.01::double + i * ((0.99::double - 0.01::double) / 199) END AS t FROM range(0, 200) r(i)),
counts AS (SELECT {g}t.i, t.t, count(*) FILTER (WHERE y = 0 AND {score} < t.t)::double AS tn, count(*) FILTER (WHERE y = 0 AND {score} >= t.t)::double AS fp,
  count(*) FILTER (WHERE y = 1 AND {score} < t.t)::double AS fn, count(*) FILTER (WHERE y = 1 AND {score} >= t.t)::double AS tp FROM {source} s, grid t GROUP BY {group}),
sweep AS (SELECT *, 10 * fn + fp AS cost, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM counts)"""


@query(
    "M9",
    f"""WITH {MODELS_SQL}, {sweep_sql('models', ['model', 'split'], 'q')} SELECT model, split, round(arg_min(t, (cost, i)), 6) AS threshold, min(cost) AS cost FROM sweep GROUP BY 1, 2""",
)
def cost_optimal_threshold(spark, sf_dir):
    by = ["model", "split"]
    out = metrics.cost_optimal(metrics.threshold_sweep(models(spark, sf_dir), "y", "q", by), by)
    return out.withColumn("threshold", F.round("threshold", 6))


@query(
    "M10",
    f"""WITH {SCORED_SQL}, {sweep_sql()} SELECT round(t, 6) AS threshold, tn::bigint AS tn, fp::bigint AS fp, fn::bigint AS fn, tp::bigint AS tp, cost,
    round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM sweep""",
)
def threshold_sweep(spark, sf_dir):
    df = metrics.threshold_sweep(scored(spark, sf_dir), "y", "p")
    return df.withColumns({c: F.round(c, 6) for c in ("threshold", "precision", "recall", "f1")})


@query(
    "M10",
    f"""WITH {MODELS_SQL}, {sweep_sql('models', ['model'], 'q')} SELECT model, round(arg_min(t, (-f1, i)), 6) AS threshold, round(max(f1), 6) AS f1 FROM sweep GROUP BY 1""",
)
def f1_optimal_threshold(spark, sf_dir):
    out = metrics.f1_optimal(metrics.threshold_sweep(models(spark, sf_dir), "y", "q", ["model"]), ["model"])
    return out.select("model", F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))


TENTHS = [i / 10 for i in range(11)]
EDGES = ", ".join(f"quantile_cont(p, {t})" for t in TENTHS)


@query(
    "M11",
    f"""WITH {SCORED_SQL}, e AS (SELECT list_sort(list_distinct([{EDGES}])) AS e FROM scored),
    b AS (SELECT p, y, len(list_filter(e[2:len(e) - 1], lambda x: x < p))::int AS bin FROM scored, e)
    SELECT bin, count(*) AS rows, round(avg(p), 4) AS mean_predicted, round(avg(y), 4) AS observed_rate FROM b GROUP BY 1""",
)
def calibration(spark, sf_dir):
    return metrics.calibration(scored(spark, sf_dir), "y", "p", digits=4)


BUNDLE_SQL = f"""{MODELS_SQL}, {curve_sql('models', ['model', 'split'], 'q')},
bundle AS (SELECT model, split, round({AUC}, 4) AS auc, round({KS}, 4) AS ks, round(2 * ({AUC}) - 1, 4) AS gini, round({AP}, 4) AS pr_auc FROM curve GROUP BY 1, 2)"""


def bundle(spark, sf_dir):
    return metrics.metric_bundle(models(spark, sf_dir), "y", "q", ["model", "split"])


@query("M12", f"WITH {BUNDLE_SQL} SELECT model, split, auc AS m_auc, ks AS m_ks, gini AS m_gini, pr_auc AS m_pr_auc FROM bundle")
def metric_bundle(spark, sf_dir):
    return metrics.metric_bundle(models(spark, sf_dir), "y", "q", ["model", "split"], prefix="m_")


COMPARED_SQL = f"""{BUNDLE_SQL}, compared AS (SELECT model, max(auc) FILTER (WHERE split = 'train') AS train_auc, max(auc) FILTER (WHERE split = 'val') AS val_auc FROM bundle GROUP BY 1)"""


@query(
    "M13",
    f"""WITH {COMPARED_SQL} SELECT model, train_auc, val_auc, round(train_auc - val_auc, 4) AS overfit_gap, CASE WHEN round(train_auc - val_auc, 4) < 0.02 THEN 'minimal overfit'
    WHEN round(train_auc - val_auc, 4) < 0.05 THEN 'moderate overfit' ELSE 'overfit — needs regularization' END AS verdict FROM compared""",
)
def model_comparison(spark, sf_dir):
    return metrics.compare_models(bundle(spark, sf_dir))


@query("M14", f"WITH {COMPARED_SQL} SELECT model, val_auc FROM compared ORDER BY val_auc DESC, model LIMIT 1")
def champion(spark, sf_dir):
    return metrics.champion(metrics.compare_models(bundle(spark, sf_dir)), "model").select("model", "val_auc")


@query(
    "M15",
    f"""WITH {BUNDLE_SQL} SELECT b.model, b.auc AS baseline_auc, t.auc AS tuned_auc, round(t.auc - b.auc, 4) AS gain
    FROM bundle b JOIN bundle t ON b.model = t.model WHERE b.split = 'train' AND t.split = 'val'""",
)
def tuning_gain(spark, sf_dir):
    df = bundle(spark, sf_dir).select("model", "split", F.col("auc").alias("val_auc"))
    return metrics.tuning_gain(df.where(F.col("split") == "train"), df.where(F.col("split") == "val"))


@query(
    "M16",
    f"""WITH {COMPARED_SQL} SELECT model, val_auc AS test_auc, 0.5::double AS auc_threshold, val_auc >= 0.5 AS passes_threshold FROM compared""",
)
def promotion_gate(spark, sf_dir):
    report = metrics.compare_models(bundle(spark, sf_dir)).select("model", F.col("val_auc").alias("test_auc"))
    return metrics.promotion_gate(report, 0.5)


@query("M17", f"WITH {MODELS_SQL} SELECT model, split, round(avg((q - y) * (q - y)), 4) AS brier FROM models GROUP BY 1, 2")
def brier_score(spark, sf_dir):
    return metrics.brier(models(spark, sf_dir), "y", "q", ["model", "split"], digits=4)


COHORT_SOURCE = """line_scores AS (SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS cohort, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  round(l_quantity / 50, 6) AS p FROM lineitem WHERE date_trunc('month', l_shipdate) <= timestamp '1999-12-01')"""


@query(
    "M18",
    f"WITH {COHORT_SOURCE}, {curve_sql('line_scores', ['cohort'])} SELECT cohort, round({AUC}, 4) AS auc, round({KS}, 4) AS ks FROM curve GROUP BY 1",
)
def cohort_quality(spark, sf_dir):
    df = lines(spark, sf_dir).withColumn("p", F.col("quantity") / 50)
    return metrics.cohort_quality(df, "l_shipdate", "y", "p", "2000-03-15", 3)


@query(
    "M1-M4, M9",
    f"""WITH {SCORED_SQL}, {curve_sql()}, {sweep_sql()} SELECT round({AUC}, 4) AS auc, round({KS}, 4) AS ks, round(2 * ({AUC}) - 1, 4) AS gini, round({AP}, 4) AS pr_auc,
    (SELECT round(arg_min(t, (cost, i)), 6) FROM sweep) AS threshold FROM curve""",
)
def score_quality(spark, sf_dir):
    """AUC, KS, Gini, average precision and the cost-optimal threshold of one score."""
    df = scored(spark, sf_dir)
    best = metrics.cost_optimal(metrics.threshold_sweep(df, "y", "p")).select(F.round("threshold", 6)).scalar()
    return metrics.metric_bundle(df, "y", "p").withColumn("threshold", best)


# ---- drift -------------------------------------------------------------------------------------

CUT = "timestamp '2024-01-16'"
SIDES_SQL = f"""v AS (SELECT 'value' AS feature, value AS x, CASE WHEN ts < {CUT} THEN 0 ELSE 1 END AS side FROM events
  UNION ALL SELECT 'user_id', user_id::double, CASE WHEN ts < {CUT} THEN 0 ELSE 1 END FROM events)"""
GAPS_SQL = f"""{SIDES_SQL}, c AS (SELECT feature, x, sum(1 - side)::double AS ref, sum(side)::double AS cur FROM v GROUP BY 1, 2),
f AS (SELECT feature, x, ref, sum(ref) OVER w / sum(ref) OVER (PARTITION BY feature) AS fr, sum(cur) OVER w / sum(cur) OVER (PARTITION BY feature) AS fc,
  sum(ref) OVER (PARTITION BY feature) AS nr, sum(cur) OVER (PARTITION BY feature) AS nc, lead(x) OVER w AS nx FROM c WINDOW w AS (PARTITION BY feature ORDER BY x))"""


def sides(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    return df.where(F.col("ts") < cut), df.where(F.col("ts") >= cut)


P_VALUE = "CASE WHEN x < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, list_sum(list_transform(range(1, 101), lambda k: 2.0 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * x * x))))) END"


@query(
    "D2",
    f"""WITH {GAPS_SQL}, s AS (SELECT feature, max(abs(fr - fc)) AS d, max(nr) AS nr, max(nc) AS nc FROM f GROUP BY 1),
    t AS (SELECT *, d * sqrt(nr * nc / (nr + nc)) AS x FROM s)
    SELECT feature, round(d, 6) AS statistic, round({P_VALUE}, 6) AS p_value, nr::bigint AS n_ref, nc::bigint AS n_cur FROM t""",
)
def ks_drift(spark, sf_dir):
    ref, cur = sides(spark, sf_dir)
    return drift.ks_test(drift.distribution_gaps(ref, cur, ["value", "user_id"]))


@query(
    "D4",
    f"""WITH {GAPS_SQL}, a AS (SELECT feature, coalesce(sum(abs(fr - fc) * (nx - x)), 0) AS area FROM f GROUP BY 1),
    s AS (SELECT feature, stddev_pop(x) FILTER (WHERE side = 0) AS sd FROM v GROUP BY 1)
    SELECT feature, round(area, 6) AS distance, round(area / greatest(sd, 0.001), 6) AS normed FROM a JOIN s USING (feature)""",
)
def wasserstein_drift(spark, sf_dir):
    ref, cur = sides(spark, sf_dir)
    features = ["value", "user_id"]
    return drift.wasserstein(drift.distribution_gaps(ref, cur, features), ref, features)


@query(
    "D3",
    f"""WITH c AS (SELECT event_type, count(*) FILTER (WHERE ts < {CUT})::double AS ref, count(*) FILTER (WHERE ts >= {CUT})::double AS cur FROM events GROUP BY 1),
    t AS (SELECT *, sum(ref) OVER () AS nr, sum(cur) OVER () AS nc FROM c), q AS (SELECT *, ref / nr AS pr, cur / nc AS pc, (ref / nr + cur / nc) / 2 AS m FROM t)
    SELECT 'event_type' AS feature, round(sum((ref - (ref + cur) * nr / (nr + nc)) ** 2 / ((ref + cur) * nr / (nr + nc)) + (cur - (ref + cur) * nc / (nr + nc)) ** 2 / ((ref + cur) * nc / (nr + nc))), 6) AS chi_square,
    count(*) - 1 AS degrees, round(sqrt(sum(pr * ln(pr / m) + pc * ln(pc / m)) / 2), 6) AS js_distance FROM q""",
)
def categorical_drift(spark, sf_dir):
    ref, cur = sides(spark, sf_dir)
    return drift.category_drift(drift.category_counts(ref, cur, ["event_type"]))


def psi_sql(column, ref, cur, name, shares=TENTHS):
    """PSI of one numeric column between two FROM clauses."""
    edges = ", ".join(f"quantile_cont({column}, {s})" for s in shares)
    return f"""SELECT '{name}' AS feature, round(sum((greatest(a, 1e-6) - greatest(e, 1e-6)) * ln(greatest(a, 1e-6) / greatest(e, 1e-6))), 6) AS psi FROM (
    SELECT sum(1 - side)::double / (SELECT count({column}) FROM {ref}) AS e, sum(side)::double / (SELECT count({column}) FROM {cur}) AS a FROM (
    SELECT side, len(list_filter(el[2:len(el) - 1], lambda q: q < x)) AS bin FROM (SELECT {column} AS x, 0 AS side FROM {ref} UNION ALL SELECT {column}, 1 FROM {cur}),
    (SELECT list_sort(list_distinct([{edges}])) AS el FROM {ref}) WHERE x IS NOT NULL) GROUP BY bin)"""


def psi_category_sql(column, ref, cur, name):
    return f"""SELECT '{name}' AS feature, round(sum((greatest(a, 1e-6) - greatest(e, 1e-6)) * ln(greatest(a, 1e-6) / greatest(e, 1e-6))), 6) AS psi FROM (
    SELECT sum(1 - side)::double / (SELECT count({column}) FROM {ref}) AS e, sum(side)::double / (SELECT count({column}) FROM {cur}) AS a FROM (
    SELECT {column} AS x, 0 AS side FROM {ref} UNION ALL SELECT {column}, 1 FROM {cur}) WHERE x IS NOT NULL GROUP BY x)"""


LINE_SIDES_SQL = f"""{LINES_SQL}, ref AS (SELECT * FROM lines WHERE l_shipdate < timestamp '1999-01-01'), cur AS (SELECT * FROM lines WHERE l_shipdate >= timestamp '1999-01-01')"""
LINE_PSI_SQL = " UNION ALL ".join([psi_sql(c, "ref", "cur", c) for c in NUMBERS] + [psi_category_sql("flag", "ref", "cur", "flag")])


def line_sides(spark, sf_dir):
    df = lines(spark, sf_dir)
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return df.where(F.col("l_shipdate") < cut), df.where(F.col("l_shipdate") >= cut)


@query("D1, D5", f"WITH {LINE_SIDES_SQL} {LINE_PSI_SQL}")
def feature_psi(spark, sf_dir):
    ref, cur = line_sides(spark, sf_dir)
    return drift.feature_psi(ref, cur, [*NUMBERS, "absent"], ["flag"])


@query(
    "D5, D8",
    f"""WITH {LINE_SIDES_SQL}, y99 AS (SELECT * FROM cur WHERE l_shipdate >= timestamp '1999-03-01' AND l_shipdate < timestamp '2000-07-01')
    {' UNION ALL '.join([psi_sql(c, 'ref', 'y99', c) for c in NUMBERS] + [psi_category_sql('flag', 'ref', 'y99', 'flag')])}""",
)
def drift_of_date_range(spark, sf_dir):
    """PSI of a range of months from stored monthly profiles: raw rows are read once, when profiled."""
    ref, _ = line_sides(spark, sf_dir)
    edges = drift.reference_edges(ref, NUMBERS)
    monthly = lines(spark, sf_dir).withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    path = shared_dir(spark, "profiles")
    drift.profile_by(monthly, ["month"], edges, ["flag"]).write.partitionBy("month").parquet(path)
    stored = spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))
    base, asked = stored.where("month < '1999-01'"), stored.where("month BETWEEN '1999-03' AND '2000-06'")
    return drift.profile_psi(drift.merged(base), drift.merged(asked))


@query(
    "D6",
    f"""WITH {LINE_SIDES_SQL}, s AS ({LINE_PSI_SQL}), t AS (SELECT feature, psi, psi > 0.0005 AS hit FROM s)
    SELECT count(*) AS features, coalesce(string_agg(CASE WHEN hit THEN feature END, ',' ORDER BY feature), '') AS drifted, round(avg(hit::int), 4) AS drift_share,
    avg(hit::int) >= 0.5 AS overall_drift_detected, max(psi) AS max_score FROM t""",
)
def drift_summary(spark, sf_dir):
    ref, cur = line_sides(spark, sf_dir)
    out = drift.summarize(drift.feature_psi(ref, cur, NUMBERS, ["flag"]), limit=0.0005)
    return out.select(
        F.size("per_feature_drift").cast("bigint").alias("features"),
        F.array_join("drifted_features", ",").alias("drifted"),
        "drift_share",
        "overall_drift_detected",
        "max_score",
    )


@query("D7", "SELECT true AS skipped, 'no reference data' AS reason, count(*) AS batch_rows FROM lineitem")
def drift_skipped(spark, sf_dir):
    df = lines(spark, sf_dir)
    out = drift.drift_record(None, df, NUMBERS, ["flag"])
    return out.withColumn("batch_rows", df.agg(F.count(F.lit(1))).scalar())


@query(
    "D8",
    f"""WITH {SCORED_SQL}, ref AS (SELECT * FROM scored WHERE ts < {CUT}), cur AS (SELECT * FROM scored WHERE ts >= {CUT})
    SELECT psi, (SELECT round(avg(CASE WHEN p >= 0.3 THEN 1.0::double ELSE 0.0 END), 6) FROM cur) AS positive_share,
    (SELECT avg(CASE WHEN p >= 0.3 THEN 1.0::double ELSE 0.0 END) NOT BETWEEN 0.01 AND 0.3 FROM cur) AS outside FROM ({psi_sql('p', 'ref', 'cur', 'p')})""",
)
def output_drift(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("prediction", (F.col("p") >= 0.3).cast("int"))
    cut = F.lit("2024-01-16").cast("timestamp")
    return drift.output_drift(df.where(F.col("ts") < cut), df.where(F.col("ts") >= cut), "p")


