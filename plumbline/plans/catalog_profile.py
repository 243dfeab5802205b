"""Queries for splits, fitted transformers, profiling and data quality."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.operators import featurestore, prep, profile, quality, split
from plumbline.plans.registry import (
    LINE_KEY,
    LINE_ORDER,
    LINE_ORDER_SQL,
    LINES_SQL,
    NUMBERS,
    SCORED_SQL,
    lines,
    query,
    scored,
    table,
    written,
)
from plumbline.session import prepare, shared_dir

KEY = ", ".join(LINE_KEY)

# Exact stratified split of the line items in SQL: rank in class against the class size.
SPLIT_SQL = f"""{LINES_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {LINE_ORDER_SQL}, {KEY}) AS r,
  count(*) OVER (PARTITION BY y) AS n FROM lines),
sized AS (SELECT *, floor(n * 0.3 + 0.5) AS held, floor(floor(n * 0.3 + 0.5) * 0.5 + 0.5) AS tested FROM ranked),
splits AS (SELECT *, CASE WHEN r <= n - held THEN 'train' WHEN r <= n - tested THEN 'val' ELSE 'test' END AS split FROM sized)"""


def split_lines(spark, sf_dir):
    order = split.arithmetic_order(LINE_ORDER)
    return split.stratified_split(lines(spark, sf_dir), "y", LINE_KEY, order=order)


@query("F1", f"WITH {SPLIT_SQL} SELECT {KEY}, y, split FROM splits")
def stratified_split(spark, sf_dir):
    return split_lines(spark, sf_dir).select(*LINE_KEY, "y", "split")


FIT_SQL = f"""{SPLIT_SQL}, med AS (SELECT median(quantity) AS mq, median(price) AS mp, median(discount) AS md, median(tax) AS mt FROM splits WHERE split = 'train'),
filled AS (SELECT {KEY}, y, split, flag, coalesce(quantity, mq) AS quantity, coalesce(price, mp) AS price, coalesce(discount, md) AS discount,
  coalesce(tax, mt) AS tax FROM splits, med)"""


@query("F2", f"WITH {FIT_SQL} SELECT {KEY}, split, round(discount, 6) AS discount, round(tax, 6) AS tax FROM filled")
def median_imputed(spark, sf_dir):
    df = split_lines(spark, sf_dir)
    medians = prep.fit_medians(df.where(F.col("split") == "train"), ["discount", "tax"])
    out = prep.impute(df, medians)
    return out.select(*LINE_KEY, "split", F.round("discount", 6).alias("discount"), F.round("tax", 6).alias("tax"))


@query(
    "F3",
    f"""WITH {FIT_SQL}, s AS (SELECT avg(price) AS m, stddev_pop(price) AS sd, avg(discount) AS dm, stddev_pop(discount) AS dsd FROM filled WHERE split = 'train')
    SELECT 'price' AS feature, round((SELECT mp FROM med), 4) AS median, round(m, 4) AS mean, round(sd, 4) AS scale FROM s
    UNION ALL SELECT 'discount', round((SELECT md FROM med), 4), round(dm, 4), round(dsd, 4) FROM s""",
)
def scaler_parameters(spark, sf_dir):
    train = split_lines(spark, sf_dir).where(F.col("split") == "train")
    fitted = prep.fit(train, ["price", "discount"])
    return fitted.params(spark).select("feature", *[F.round(c, 4).alias(c) for c in ("median", "mean", "scale")])


@query(
    "F4",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_returnflag WHEN 'A' THEN 0.0::double WHEN 'R' THEN 1.0::double ELSE -1.0::double END AS code FROM lineitem",
)
def ordinal_codes(spark, sf_dir):
    return lines(spark, sf_dir).select(*LINE_KEY, C.ordinal("flag", ["A", "R"]).alias("code"))


@query(
    "F5",
    f"""WITH {FIT_SQL}, s AS (SELECT avg(quantity) AS qm, stddev_pop(quantity) AS qs, avg(price) AS pm, stddev_pop(price) AS ps,
    avg(discount) AS dm, stddev_pop(discount) AS ds, avg(tax) AS tm, stddev_pop(tax) AS ts FROM filled WHERE split = 'train')
    SELECT {KEY}, split, round((quantity - qm) / qs, 5) AS quantity, round((price - pm) / ps, 5) AS price, round((discount - dm) / ds, 5) AS discount,
    round((tax - tm) / ts, 5) AS tax, CASE flag WHEN 'A' THEN 0.0::double WHEN 'N' THEN 1.0::double WHEN 'R' THEN 2.0::double ELSE -1.0::double END AS flag FROM filled, s""",
)
def fitted_transform(spark, sf_dir):
    """Fit on train, apply to every split with one expression per column."""
    df = written(split_lines(spark, sf_dir).select(*LINE_KEY, "split", "flag", *NUMBERS), "splits")
    fitted = prep.fit(df.where(F.col("split") == "train"), NUMBERS, {"flag": ["A", "N", "R"]})
    out = fitted.transform(df, keep=[*LINE_KEY, "split"])
    return out.withColumns({c: F.round(c, 5) for c in NUMBERS})


@query(
    "F6",
    f"""WITH {SPLIT_SQL} SELECT 'quantity,price,discount,tax,flag' AS features, 'y' AS target, 42 AS random_state,
    count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'val') AS val_rows,
    count(*) FILTER (WHERE split = 'test') AS test_rows, round(avg(y) FILTER (WHERE split = 'train'), 6) AS default_rate_train FROM splits""",
)
def feature_config(spark, sf_dir):
    out = prep.feature_config(split_lines(spark, sf_dir), "y", NUMBERS, ["flag"], 42)
    return out.withColumn("features", F.array_join("features", ",")).drop("numeric", "categorical")


def _profile_sql(c):
    if c == "flag":
        return "SELECT 'flag' AS feature, round(avg(CASE WHEN flag IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate, NULL::double AS mean, NULL::double AS std, NULL::double AS p25, NULL::double AS p50, NULL::double AS p75 FROM train"
    return f"""SELECT '{c}' AS feature, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate, round(avg({c}), 6) AS mean,
    round(stddev_samp({c}), 6) AS std, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75 FROM train"""


@query(
    "F7",
    f"WITH {SPLIT_SQL}, train AS (SELECT * FROM splits WHERE split = 'train') " + " UNION ALL ".join(_profile_sql(c) for c in [*NUMBERS, "flag"]),
)
def reference_profile(spark, sf_dir):
    train = split_lines(spark, sf_dir).where(F.col("split") == "train").select("flag", *NUMBERS)
    return prep.reference_profile(written(train, "train"), NUMBERS, ["flag"])


@query("F8", f"WITH {SPLIT_SQL} SELECT split, count(*) AS rows, round(avg(y) * 100, 4) AS positive_pct FROM splits GROUP BY 1")
def split_sizes(spark, sf_dir):
    return split.split_sizes(split_lines(spark, sf_dir), "y")


@query(
    "F9",
    """SELECT o_orderkey, CASE WHEN o_orderdate < timestamp '1998-01-01' THEN 'train' WHEN o_orderdate < timestamp '2000-01-01' THEN 'val' ELSE 'test' END AS split FROM orders""",
)
def temporal_split(spark, sf_dir):
    df = split.temporal_split(table(spark, sf_dir, "orders"), "o_orderdate", "1998-01-01", "2000-01-01")
    return df.select("o_orderkey", "split")


@query(
    "F10",
    """WITH f AS (SELECT CASE WHEN o_orderdate >= timestamp '2000-01-01' THEN 3 WHEN o_orderdate >= timestamp '1999-01-01' THEN 2
    WHEN o_orderdate >= timestamp '1998-01-01' THEN 1 ELSE 0 END AS fold, o_totalprice FROM orders),
    k AS (SELECT * FROM (VALUES (1), (2), (3)) v(k))
    SELECT k.k AS fold, count(*) FILTER (WHERE f.fold < k.k) AS train_rows, count(*) FILTER (WHERE f.fold = k.k) AS val_rows FROM f, k GROUP BY 1""",
)
def expanding_folds(spark, sf_dir):
    edges = [dt.datetime(y, 1, 1) for y in (1998, 1999, 2000)]
    folds = split.time_folds(table(spark, sf_dir, "orders"), "o_orderdate", edges)
    out = None
    for i, (train, val) in enumerate(split.expanding_folds(folds, 3), start=1):
        sides = train.select(F.lit("t").alias("s")).unionAll(val.select(F.lit("v").alias("s")))
        one = sides.agg(F.count_if(F.col("s") == "t").alias("train_rows"), F.count_if(F.col("s") == "v").alias("val_rows"))
        one = one.select(F.lit(i).alias("fold"), "*")
        out = one if out is None else out.unionAll(one)
    return out


@query(
    "F1, T5",
    f"""WITH {LINES_SQL}, r AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY {LINE_ORDER_SQL}, {KEY}) AS r, count(*) OVER (PARTITION BY y) AS n, price FROM lines),
    f AS (SELECT y, price, CASE WHEN r <= 1 * (n // 5) + least(1, n % 5) THEN 0 WHEN r <= 2 * (n // 5) + least(2, n % 5) THEN 1
    WHEN r <= 3 * (n // 5) + least(3, n % 5) THEN 2 WHEN r <= 4 * (n // 5) + least(4, n % 5) THEN 3 ELSE 4 END AS fold FROM r)
    SELECT fold, y, count(*) AS n, round(sum(price), 2) AS price FROM f GROUP BY 1, 2""",
)
def stratified_folds(spark, sf_dir):
    order = split.arithmetic_order(LINE_ORDER)
    df = split.stratified_folds(lines(spark, sf_dir), "y", LINE_KEY, 5, order=order)
    return df.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("price"))


@query("A1", "SELECT event_type, count(*) AS rows, round(count(*) / (SELECT count(*) FROM events)::double, 6) AS share FROM events GROUP BY 1")
def value_shares(spark, sf_dir):
    return profile.value_shares(table(spark, sf_dir, "events"), "event_type")


@query(
    "A2",
    f"WITH {LINES_SQL} SELECT count(*) FILTER (WHERE y = 0) AS negatives, count(*) FILTER (WHERE y = 1) AS positives, round(count(*) FILTER (WHERE y = 0)::double / count(*) FILTER (WHERE y = 1), 4) AS ratio FROM lines",
)
def imbalance(spark, sf_dir):
    return profile.imbalance(lines(spark, sf_dir), "y")


def _union(template, columns):
    return " UNION ALL ".join(template.format(c=c) for c in columns)


@query(
    "A3",
    f"WITH {LINES_SQL} SELECT * FROM ("
    + _union("SELECT '{c}' AS feature, count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0::double / count(*), 2) AS missing_pct FROM lines", NUMBERS)
    + ") WHERE missing > 0",
)
def missingness(spark, sf_dir):
    return profile.missingness(lines(spark, sf_dir), NUMBERS)


@query(
    "A4",
    f"WITH {LINES_SQL} "
    + _union(
        "SELECT '{c}' AS feature, round(avg(y) FILTER (WHERE {c} IS NULL), 6) AS rate_missing, round(avg(y) FILTER (WHERE {c} IS NOT NULL), 6) AS rate_present, "
        "CASE WHEN abs(avg(y) FILTER (WHERE {c} IS NULL) - avg(y) FILTER (WHERE {c} IS NOT NULL)) > 0.01 THEN 'INFORMATIVE' ELSE 'MCAR' END AS verdict FROM lines",
        ["discount", "tax"],
    ),
)
def missingness_vs_target(spark, sf_dir):
    return profile.missingness_vs_target(lines(spark, sf_dir), NUMBERS, "y")


OUTLIER_SQL = (
    "SELECT '{c}' AS feature, round(b.p1, 6) AS p1, round(b.p99, 6) AS p99, max(l.{c}) AS max, "
    "round(count(*) FILTER (WHERE l.{c} > b.p99) * 100.0::double / count(l.{c}), 2) AS above_p99_pct "
    "FROM lines l, (SELECT quantile_cont({c}, 0.01) AS p1, quantile_cont({c}, 0.99) AS p99 FROM lines) b GROUP BY b.p1, b.p99"
)


@query("A5", f"WITH {LINES_SQL} " + _union(OUTLIER_SQL, NUMBERS))
def outliers(spark, sf_dir):
    return profile.outliers(lines(spark, sf_dir), NUMBERS)


@query(
    "A6",
    f"WITH {LINES_SQL} SELECT feature, p99, above_p99_pct FROM (" + _union(OUTLIER_SQL, NUMBERS) + ") WHERE above_p99_pct > 0.5",
)
def cap_candidates(spark, sf_dir):
    return profile.cap_candidates(lines(spark, sf_dir), NUMBERS, 0.5)


@query(
    "A7",
    f"""WITH {LINES_SQL}, k AS (SELECT quantile_cont(price, 0.99) AS k FROM lines), v AS (SELECT CASE WHEN price > k THEN k ELSE price END AS v FROM lines, k),
    b AS (SELECT min(v) AS lo, (max(v) - min(v)) / 50 AS w FROM v)
    SELECT least(floor((v - lo) / w), 49)::bigint AS bin, round(lo + least(floor((v - lo) / w), 49) * w, 6) AS left_edge, count(*) AS rows FROM v, b GROUP BY 1, 2""",
)
def histogram(spark, sf_dir):
    return profile.histogram(lines(spark, sf_dir), "price")


@query(
    "A8",
    f"WITH {LINES_SQL} "
    + _union(
        "SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, "
        "round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max FROM lines",
        NUMBERS,
    ),
)
def describe(spark, sf_dir):
    return profile.describe(lines(spark, sf_dir), NUMBERS)


CORR_FEATURES = ["quantity", "price", "discount", "tax", "l_linenumber"]


def _corr_sql():
    parts = []
    for a in CORR_FEATURES:
        for b in CORR_FEATURES:
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lines")
    return " UNION ALL ".join(parts)


@query("A9", f"WITH {LINES_SQL} " + _corr_sql())
def correlation_matrix(spark, sf_dir):
    df = profile.correlation_matrix(lines(spark, sf_dir), CORR_FEATURES)
    return df.withColumn("r", F.round("r", 6) + F.lit(0.0))


@query(
    "A10",
    f"""WITH {LINES_SQL}, d AS (SELECT quantity, price, price * (1 + coalesce(tax, 0)) AS charge, discount FROM lines), r AS (
    SELECT 'quantity' AS feature_a, 'price' AS feature_b, corr(quantity, price) AS r FROM d UNION ALL SELECT 'quantity', 'charge', corr(quantity, charge) FROM d
    UNION ALL SELECT 'quantity', 'discount', corr(quantity, discount) FROM d UNION ALL SELECT 'price', 'charge', corr(price, charge) FROM d
    UNION ALL SELECT 'price', 'discount', corr(price, discount) FROM d UNION ALL SELECT 'charge', 'discount', corr(charge, discount) FROM d)
    SELECT feature_a, feature_b, round(r, 3) AS r FROM r WHERE abs(r) > 0.5""",
)
def strong_pairs(spark, sf_dir):
    df = lines(spark, sf_dir).withColumn("charge", F.col("price") * (1 + F.coalesce("tax", F.lit(0.0))))
    return profile.strong_pairs(df, ["quantity", "price", "charge", "discount"])


def _edges_sql(column, source, shares):
    return ", ".join(f"quantile_cont({column}, {p}) AS e{i}" for i, p in enumerate(shares)) + f" FROM {source}"


TENTHS = [i / 10 for i in range(11)]


@query(
    "A11",
    f"""WITH {LINES_SQL}, k AS (SELECT quantile_cont(quantity, 0.99) AS k FROM lines), v AS (SELECT CASE WHEN quantity > k THEN k ELSE quantity END AS v, y FROM lines, k),
    q AS (SELECT {_edges_sql('v', 'v', TENTHS)}), l AS (SELECT list_sort(list_distinct([{', '.join(f'e{i}' for i in range(11))}])) AS e FROM q),
    b AS (SELECT v, y, len(list_filter(e[2:len(e) - 1], lambda x: x < v))::int AS bin FROM v, l)
    SELECT bin, count(*) AS rows, min(v) AS low, max(v) AS high, round(avg(y) * 100, 4) AS positive_pct FROM b GROUP BY 1""",
)
def rate_by_decile(spark, sf_dir):
    return profile.rate_by_quantile(lines(spark, sf_dir), "quantity", "y")


@query("A12", "SELECT l_quantity AS quantity, count(*) AS rows FROM lineitem GROUP BY 1 ORDER BY 1 LIMIT 10")
def lowest_values(spark, sf_dir):
    return profile.lowest_values(lines(spark, sf_dir), "quantity")


@query(
    "A12",
    "SELECT count(*) FILTER (WHERE l_discount = 0) AS equal_zero, count(*) FILTER (WHERE l_discount < 0.05) AS below FROM lineitem",
)
def range_counts(spark, sf_dir):
    return profile.range_counts(table(spark, sf_dir, "lineitem"), "l_discount", 0, 0.05)


@query(
    "A13",
    """SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS events, max(o_totalprice) AS worst, round(sum(o_totalprice), 2) AS exposure
    FROM orders WHERE o_orderdate <= timestamp '1999-06-30' GROUP BY 1""",
)
def entity_history(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return profile.entity_history(
        df, "o_custkey", "o_orderdate", "1999-06-30", F.col("o_orderstatus") == "F", F.col("o_totalprice"), F.col("o_totalprice")
    )


@query(
    "A14",
    """SELECT o_orderkey, o_custkey, date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate)::double AS days FROM orders""",
)
def days_since_previous(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = featurestore.days_since_previous(df, "o_custkey", "o_orderdate", ["o_orderkey"], "days")
    return out.select("o_orderkey", "o_custkey", F.col("days").cast("double").alias("days"))


@query(
    "Q1",
    """SELECT 1 AS position, 'weight' AS column, count(*) AS rows_without FROM lineitem
    UNION ALL SELECT 3, 'colour', count(*) FROM lineitem""",
)
def missing_columns(spark, sf_dir):
    df = lines(spark, sf_dir)
    gone = quality.missing_columns(df, ["quantity", "weight", "price", "colour"])
    return gone.withColumn("rows_without", df.agg(F.count(F.lit(1))).scalar())


@query(
    "Q2",
    f"WITH {LINES_SQL} " + _union("SELECT '{c}' AS feature, round(avg(CASE WHEN {c} IS NULL THEN 1.0::double ELSE 0.0 END), 6) AS null_rate FROM lines", NUMBERS),
)
def null_rates(spark, sf_dir):
    """NaN counts as missing: half of the gaps are turned into NaN first."""
    df = lines(spark, sf_dir)
    nan = F.when(F.col("tax").isNull() & (F.col("l_orderkey") % 2 == 0), F.lit(float("nan"))).otherwise(F.col("tax"))
    return quality.null_rates(df.withColumn("tax", nan), [*NUMBERS, "absent"])


@query(
    "Q3",
    """SELECT feature FROM (SELECT 'l_tax' AS feature, count(DISTINCT l_tax) AS d FROM lineitem UNION ALL SELECT 'one', count(DISTINCT l_quantity * 0) FROM lineitem
    UNION ALL SELECT 'gone', 0 UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus) FROM lineitem) WHERE d <= 1""",
)
def constant_columns(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumns({"one": F.col("l_quantity") * 0, "gone": F.lit(None).cast("double")})
    return quality.constant_columns(df, ["l_tax", "one", "gone", "l_linestatus"])


@query(
    "Q4",
    f"""WITH {LINES_SQL} SELECT count(*) AS row_count, round(avg(CASE WHEN discount IS NULL THEN 1.0::double ELSE 0.0 END), 6) AS discount_nulls,
    round(avg(CASE WHEN tax IS NULL THEN 1.0::double ELSE 0.0 END), 6) AS tax_nulls, 'weight' AS missing, '' AS constant FROM lines""",
)
def quality_record(spark, sf_dir):
    one = quality.quality_record(lines(spark, sf_dir), [*NUMBERS, "weight"])
    return one.select(
        "row_count",
        F.element_at("null_rates", "discount").alias("discount_nulls"),
        F.element_at("null_rates", "tax").alias("tax_nulls"),
        F.array_join("missing_columns", ",").alias("missing"),
        F.array_join("constant_columns", ",").alias("constant"),
    )


@query(
    "Q4, Q5",
    f"""WITH {LINES_SQL}, late AS (SELECT *, CASE WHEN quantity <= 10 THEN price END AS late_price FROM lines)
    SELECT count(*) AS row_count, round(avg(CASE WHEN tax IS NULL THEN 1.0::double ELSE 0.0 END), 6) AS tax_nulls, round(avg(CASE WHEN late_price IS NULL THEN 1.0::double ELSE 0.0 END), 6) AS late_nulls,
    avg(CASE WHEN late_price IS NULL THEN 1.0 ELSE 0.0 END) <= 0.5 AS is_valid, 'late_price' AS high_null, (SELECT count(*) FROM late) AS rows_written FROM late""",
)
def quality_while_writing(spark, sf_dir):
    """The quality record and the gate of a table, taken from the job that writes it."""
    expected = [*NUMBERS, "late_price"]
    df = lines(prepare(spark.newSession()), sf_dir).withColumn("late_price", F.when(F.col("quantity") <= 10, F.col("price")))
    seen, path = Observation("quality"), shared_dir(spark, "watched")
    quality.watched(df, expected, seen).write.parquet(path)
    record = quality.record_of(seen.get, expected)
    gate = quality.gate_of(record)
    row = (record["row_count"], record["null_rates"]["tax"], record["null_rates"]["late_price"], gate["is_valid"], ",".join(gate["high_null_columns"]))
    out = spark.createDataFrame([row], "row_count long, tax_nulls double, late_nulls double, is_valid boolean, high_null string")
    return out.withColumn("rows_written", spark.read.parquet(path).agg(F.count(F.lit(1))).scalar())


@query(
    "Q5",
    """SELECT 'complete' AS input, avg(CASE WHEN l_quantity > 10 THEN 1.0 ELSE 0.0 END) <= 0.5 AS is_valid, '' AS missing, 'late_price' AS high_null, count(*) AS row_count FROM lineitem
    UNION ALL SELECT 'incomplete', false, 'weight', '', count(*) FROM lineitem UNION ALL SELECT 'good', true, '', '', count(*) FROM lineitem""",
)
def scoring_gate(spark, sf_dir):
    df = lines(spark, sf_dir).withColumn("late_price", F.when(F.col("quantity") <= 10, F.col("price")))
    inputs = {"complete": [*NUMBERS, "late_price"], "incomplete": [*NUMBERS, "weight", "late_price"], "good": NUMBERS}
    out = None
    for name, expected in inputs.items():
        one = quality.scoring_gate(df, expected).select(
            F.lit(name).alias("input"),
            "is_valid",
            F.array_join("missing_columns", ",").alias("missing"),
            F.array_join("high_null_columns", ",").alias("high_null"),
            "row_count",
        )
        out = one if out is None else out.unionByName(one)
    return out


def _summary_sql(kind, std):
    return f"""SELECT '{kind}' AS deviation, round(avg(p), 6) AS mean_probability, round({std}(p), 6) AS std_probability, round(quantile_cont(p, 0.25), 6) AS p25,
    round(quantile_cont(p, 0.5), 6) AS p50, round(quantile_cont(p, 0.75), 6) AS p75, round(avg(CASE WHEN p >= 0.3 THEN 1.0::double ELSE 0.0 END), 6) AS pct_predicted_default, count(*) AS record_count FROM scored"""


@query("Q6", f"WITH {SCORED_SQL} " + _summary_sql("sample", "stddev_samp") + " UNION ALL " + _summary_sql("population", "stddev_pop"))
def score_summary(spark, sf_dir):
    df = scored(spark, sf_dir)
    parts = [
        quality.score_summary(df, 0.3, "p", kind).select(F.lit(kind).alias("deviation"), "*") for kind in ("sample", "population")
    ]
    return parts[0].unionByName(parts[1])


def report_context(spark, sf_dir):
    """Monitoring inputs: line items shipped before 1999 are the reference, the rest is the batch."""
    df = lines(spark, sf_dir)
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    predictions = scored(spark, sf_dir).select(F.col("p").alias("probability"))
    return {
        "features": df.where(F.col("l_shipdate") >= cut),
        "reference": df.where(F.col("l_shipdate") < cut),
        "expected": [*NUMBERS, "weight"],
        "numeric": NUMBERS,
        "categorical": ["flag"],
        "predictions": predictions,
        "threshold": 0.3,
    }


def monitoring_report(spark, sf_dir):
    checks = quality.run_checks(report_context(spark, sf_dir))
    return quality.build_report(checks, "2024-01-30", 12.5)


REPORT_SQL = f"""{LINES_SQL}, {SCORED_SQL}, batch AS (SELECT * FROM lines WHERE l_shipdate >= timestamp '1999-01-01')"""


@query(
    "Q7",
    f"""WITH {REPORT_SQL} SELECT 'data_quality' AS check_name, (SELECT count(*) FROM batch) AS rows_seen
    UNION ALL SELECT 'score_distribution', (SELECT count(*) FROM scored)""",
)
def check_registry(spark, sf_dir):
    done = quality.run_checks(report_context(spark, sf_dir), ["data_quality", "score_distribution"])
    counts = {"data_quality": "row_count", "score_distribution": "record_count"}
    parts = [done[n].select(F.lit(n).alias("check_name"), F.col(c).alias("rows_seen")) for n, c in counts.items()]
    return parts[0].unionByName(parts[1])


@query(
    "Q8",
    f"""WITH {REPORT_SQL} SELECT '2024-01-30' AS ingestion_date, 12.5::double AS duration_seconds, (SELECT count(*) FROM batch) AS row_count,
    (SELECT round(avg(CASE WHEN tax IS NULL THEN 1.0::double ELSE 0.0 END), 6) FROM batch) AS tax_nulls, 'weight' AS missing, 0::bigint AS drifted,
    (SELECT round(avg(p), 6) FROM scored) AS mean_probability""",
)
def report_document(spark, sf_dir):
    """The report as a JSON document and back."""
    r = quality.typed_report(monitoring_report(spark, sf_dir))
    return r.select(
        "ingestion_date",
        "duration_seconds",
        F.col("checks.data_quality.row_count").alias("row_count"),
        F.element_at("checks.data_quality.null_rates", "tax").alias("tax_nulls"),
        F.array_join("checks.data_quality.missing_columns", ",").alias("missing"),
        F.size("checks.feature_drift.drifted_features").cast("bigint").alias("drifted"),
        F.col("checks.score_distribution.mean_probability").alias("mean_probability"),
    )


FLAT_SQL = f"""{REPORT_SQL}, rates AS (SELECT unnest([{', '.join(f'(SELECT round(avg(CASE WHEN {c} IS NULL THEN 1.0::double ELSE 0.0 END), 6) FROM batch)' for c in NUMBERS)}]) AS r),
flat AS (SELECT 'batch_duration_seconds' AS key, 12.5::double AS value UNION ALL SELECT 'batch_null_max', max(r) FROM rates UNION ALL SELECT 'batch_null_mean', round(avg(r), 6) FROM rates
UNION ALL SELECT 'batch_row_count', count(*)::double FROM batch UNION ALL SELECT 'batch_drift_share', 0.0 UNION ALL SELECT 'batch_drift_detected', 0.0
UNION ALL SELECT 'batch_mean_probability', round(avg(p), 6) FROM scored UNION ALL SELECT 'batch_pct_default', round(avg(CASE WHEN p >= 0.3 THEN 1.0::double ELSE 0.0 END), 6) FROM scored
UNION ALL SELECT 'batch_score_std', round(stddev_samp(p), 6) FROM scored)"""


@query("Q9", f"WITH {FLAT_SQL} SELECT * FROM flat")
def flat_metrics(spark, sf_dir):
    """Every metric but the PSI maximum, which has its own query."""
    flat = quality.flat_metrics(monitoring_report(spark, sf_dir))
    out = flat.select(F.explode("metrics").alias("key", "value")).where(F.col("key") != "batch_psi_max")
    return out.withColumn("value", F.round("value", 6))


@query(
    "Q10",
    f"""WITH {FLAT_SQL} SELECT 'batch_monitoring_complete' AS event, '2024-01-30' AS ingestion_date,
    (SELECT value FROM flat WHERE key = 'batch_row_count') AS batch_row_count, (SELECT value FROM flat WHERE key = 'batch_null_max') AS batch_null_max,
    (SELECT value FROM flat WHERE key = 'batch_score_std') AS batch_score_std""",
)
def event_line(spark, sf_dir):
    line = quality.event_line(monitoring_report(spark, sf_dir))
    fields = "event string, ingestion_date string, batch_row_count double, batch_null_max double, batch_score_std double"
    return line.select(F.from_json("line", fields).alias("j")).select("j.*")
