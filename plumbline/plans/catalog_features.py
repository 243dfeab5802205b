"""Queries for cleaning and feature derivation."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import schema as S
from plumbline.functions import columns as C
from plumbline.operators import clean, prep, profile
from plumbline.plans import medallion
from plumbline.plans.registry import LINE_KEY, LINES_SQL, lines, query, scored, table
from plumbline.session import shared_dir
from plumbline.sources import files

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

# Line items dressed as the raw text file: some cells are not numbers, some rows repeat.
RAW_COLUMNS = {
    "": "l_orderkey",
    "SeriousDlqin2yrs": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "RevolvingUtilizationOfUnsecuredLines": "round(l_discount * 12, 4)",
    "age": "cast(l_quantity AS int) + 16",
    "NumberOfTime30-59DaysPastDueNotWorse": "l_linenumber - 1",
    "DebtRatio": "round(l_extendedprice / 8, 1)",
    "MonthlyIncome": "CASE WHEN l_linenumber = 7 THEN 'NA' ELSE cast(l_suppkey * 300 AS string) END",
    "NumberOfOpenCreditLinesAndLoans": "l_partkey % 12",
    "NumberOfTimes90DaysLate": "l_linenumber % 3",
    "NumberRealEstateLoansOrLines": "l_suppkey % 4",
    "NumberOfTime60-89DaysPastDueNotWorse": "l_orderkey % 2",
    "NumberOfDependents": "CASE WHEN l_tax = 0 THEN 'NA' ELSE cast(round(l_tax * 100) AS string) END",
}

RAW_SQL = """raw AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target,
  round(l_discount * 12, 4)::real AS revolving, l_quantity::int + 16 AS age, l_linenumber - 1 AS late30,
  round(l_extendedprice / 8, 1)::real AS debt, CASE WHEN l_linenumber <> 7 THEN (l_suppkey * 300)::real END AS income,
  (l_partkey % 12)::int AS open_lines, (l_linenumber % 3)::int AS late90, (l_suppkey % 4)::int AS estate,
  (l_orderkey % 2)::int AS late60, CASE WHEN l_tax <> 0 THEN round(l_tax * 100)::real END AS dependents FROM lineitem),
typed AS (SELECT DISTINCT target, revolving, age, late30, debt, income, open_lines, late90, estate, late60, dependents FROM raw),
capped AS (SELECT target, CASE WHEN revolving > 1.0::double THEN 1.0::double ELSE revolving::double END AS revolving, age, late30,
  CASE WHEN debt > 4985.1::double THEN 4985.1::double ELSE debt::double END AS debt,
  CASE WHEN income > 25000.0::double THEN 25000.0::double ELSE income::double END AS income,
  open_lines, late90, estate, late60, dependents FROM typed WHERE age >= 18),
gold AS (SELECT *, CASE WHEN income IS NULL THEN 1 ELSE 0 END AS income_missing,
  CASE WHEN dependents IS NULL THEN 1 ELSE 0 END AS dependents_missing,
  (late30 + 2 * late60 + 3 * late90)::real AS delinquency,
  CASE WHEN income > 0 THEN (debt / income)::real END AS dti,
  CASE WHEN open_lines > 0 THEN (open_lines - estate)::double / open_lines ELSE 0.0 END AS unsecured,
  CASE WHEN age < 30 THEN 'young' WHEN age < 50 THEN 'middle' WHEN age < 65 THEN 'senior' ELSE 'elderly' END AS bucket
  FROM capped)"""


def raw_text(spark, sf_dir):
    path = shared_dir(spark, "raw")
    df = table(spark, sf_dir, "lineitem")
    text = df.select(*[F.expr(e).cast("string").alias(c) for c, e in RAW_COLUMNS.items()])
    text.write.option("header", True).csv(path)
    return path


@query(
    "P1-P5",
    f"""WITH {RAW_SQL} SELECT target AS serious_dlqin2yrs, age, count(*) AS n, round(sum(debt::double), 1) AS debt_ratio,
    count(income) AS incomes, count(dependents) AS dependents, '2024-01-01' AS ingestion_date FROM typed GROUP BY 1, 2""",
)
def typed_layer(spark, sf_dir):
    df = clean.clean(files.read_csv(spark, raw_text(spark, sf_dir)), "training")
    df = clean.stamp(df, S.PARTITION, "2024-01-01")
    return df.groupBy(S.TARGET, "age", S.PARTITION).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("debt_ratio").cast("double")), 1).alias("debt_ratio"),
        F.count("monthly_income").alias("incomes"),
        F.count("number_of_dependents").alias("dependents"),
    )


@query(
    "P7-P16",
    f"""WITH {RAW_SQL} SELECT bucket AS age_risk_bucket, target AS serious_dlqin2yrs, count(*) AS n,
    round(sum(revolving), 3) AS revolving, round(sum(debt), 1) AS debt, round(avg(income), 3) AS income,
    sum(income_missing)::bigint AS income_missing, sum(dependents_missing)::bigint AS dependents_missing,
    round(sum(delinquency::double), 1) AS delinquency, round(sum(dti::double), 3) AS dti, count(dti) AS dti_rows,
    round(sum(unsecured), 3) AS unsecured, sum(CASE WHEN delinquency > 0 THEN 1 ELSE 0 END)::bigint AS late
    FROM gold GROUP BY 1, 2""",
)
def feature_layer(spark, sf_dir):
    """Raw text through both layers on disk, then a summary of the features."""
    done = medallion.run(spark, raw_text(spark, sf_dir), shared_dir(spark, "layers"), "2024-01-01", min_rows=1)
    df = files.read_partition(spark, done.features, "2024-01-01")
    return df.groupBy("age_risk_bucket", S.TARGET).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("revolving_utilization_of_unsecured_lines"), 3).alias("revolving"),
        F.round(F.sum("debt_ratio"), 1).alias("debt"),
        F.round(F.avg("monthly_income"), 3).alias("income"),
        F.sum("monthly_income_is_missing").alias("income_missing"),
        F.sum("number_of_dependents_is_missing").alias("dependents_missing"),
        F.round(F.sum(F.col("delinquency_score").cast("double")), 1).alias("delinquency"),
        F.round(F.sum(F.col("debt_to_income_ratio").cast("double")), 3).alias("dti"),
        F.count("debt_to_income_ratio").alias("dti_rows"),
        F.round(F.sum("unsecured_to_total_lines_ratio"), 3).alias("unsecured"),
        F.sum("has_any_delinquency").alias("late"),
    )


@query(
    "P6, P17",
    f"""WITH {RAW_SQL} SELECT bucket AS age_risk_bucket, count(*) AS n, count(*) AS row_ids, 18::bigint AS width
    FROM (SELECT DISTINCT revolving, age, late30, debt, income, open_lines, late90, estate, late60, dependents,
    CASE WHEN age < 30 THEN 'young' WHEN age < 50 THEN 'middle' WHEN age < 65 THEN 'senior' ELSE 'elderly' END AS bucket
    FROM raw WHERE age >= 18) GROUP BY 1""",
)
def inference_layer(spark, sf_dir):
    """Inference mode has no target but a row id, distinct over the whole table."""
    raw = files.read_csv(spark, raw_text(spark, sf_dir)).drop("SeriousDlqin2yrs")
    df = clean.feature_table(clean.clean(raw, "inference"), "inference")
    return df.groupBy("age_risk_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(S.ROW_ID).alias("row_ids"),
        F.lit(len(df.columns)).cast("bigint").alias("width"),
    )


@query("P1", "SELECT o_orderkey AS order_key, o_totalprice AS total_price, o_orderstatus FROM orders")
def rename_columns(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return clean.rename(df, {"o_orderkey": "order_key", "o_totalprice": "total_price", "absent": "nothing"})


@query("P2", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def drop_columns(spark, sf_dir):
    return clean.drop(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment", "absent")


@query(
    "P3",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount <> 0 THEN floor(l_extendedprice)::double END AS whole,
    CASE WHEN l_discount <> 0 THEN l_extendedprice END AS number FROM lineitem""",
)
def tolerant_cast(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_discount") == 0, "NA").otherwise(F.col("l_extendedprice").cast("string"))
    df = df.select(*LINE_KEY, text.alias("whole"), text.alias("number"))
    return clean.cast_types(df, {"whole": "int", "number": "double", "absent": "int"}).withColumn(
        "whole", F.col("whole").cast("double")
    )


@query("P4", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem")
def full_row_dedup(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    return clean.distinct_rows(df)


@query("P7", f"WITH {LINES_SQL} SELECT {KEY}, discount FROM lines WHERE quantity >= 18 AND discount >= 0.05")
def minimum_filter(spark, sf_dir):
    """A NULL does not pass."""
    df = lines(spark, sf_dir).where(F.col("quantity") >= S.AGE_MIN)
    return df.where(F.col("discount") >= 0.05).select(*LINE_KEY, "discount")


@query("P8", "SELECT count(*) AS rows, count(*) >= 1000 AS accepted FROM lineitem")
def row_gate(spark, sf_dir):
    return clean.gate_rows(table(spark, sf_dir, "lineitem"), 1000)


@query(
    "P9, P10",
    f"""WITH {LINES_SQL} SELECT {KEY}, CASE WHEN price > 50000.0 THEN 50000.0 ELSE price END AS price,
    CASE WHEN discount > 0.05 THEN 0.05 ELSE discount END AS discount, CASE WHEN discount IS NULL THEN 1 ELSE 0 END AS discount_is_missing
    FROM lines""",
)
def capped_values(spark, sf_dir):
    df = lines(spark, sf_dir).withColumns({"price": C.cap("price", 50000.0), "discount": C.cap("discount", 0.05)})
    return df.select(*LINE_KEY, "price", "discount", C.is_missing("discount").alias("discount_is_missing"))


@query(
    "P11, P15",
    f"""WITH {LINES_SQL}, s AS (SELECT {KEY}, quantity + 2 * l_linenumber + 3 * round(discount * 100) AS score FROM lines)
    SELECT {KEY}, score, CASE WHEN score > 0 THEN 1 ELSE 0 END AS any_event FROM s""",
)
def weighted_composite(spark, sf_dir):
    df = lines(spark, sf_dir).withColumn("points", F.round(F.col("discount") * 100))
    score = C.weighted_sum({"quantity": 1, "l_linenumber": 2, "points": 3}).cast("double")
    return df.select(*LINE_KEY, score.alias("score")).withColumn("any_event", C.any_event("score"))


@query(
    "P12, P13, P21",
    f"""WITH {LINES_SQL} SELECT {KEY}, round((CASE WHEN discount > 0 THEN quantity / discount END)::real::double, 2) AS guarded,
    round(CASE WHEN quantity > 0 THEN (quantity - l_linenumber)::real::double / quantity ELSE 0.0 END, 4) AS remaining,
    round((CASE WHEN quantity > 0 THEN tax / quantity END)::real::double, 6) AS tax_share FROM lines""",
)
def ratio_features(spark, sf_dir):
    df = lines(spark, sf_dir)
    return df.select(
        *LINE_KEY,
        F.round(C.guarded_ratio("quantity", "discount").cast("double"), 2).alias("guarded"),
        F.round(C.remaining_share("quantity", "l_linenumber"), 4).alias("remaining"),
        F.round(C.guarded_ratio("tax", "quantity").cast("double"), 6).alias("tax_share"),
    )


@query(
    "P14",
    f"""WITH {LINES_SQL} SELECT CASE WHEN quantity < 10 THEN 'few' WHEN quantity < 25 THEN 'some' WHEN quantity < 40 THEN 'many' ELSE 'bulk' END AS bucket,
    count(*) AS n, min(quantity) AS low, max(quantity) AS high FROM lines GROUP BY 1""",
)
def ordered_buckets(spark, sf_dir):
    bucket = C.ordered_bucket("quantity", (10, 25, 40), ("few", "some", "many", "bulk"))
    return lines(spark, sf_dir).groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("quantity").alias("low"), F.max("quantity").alias("high")
    )


@query(
    "P18",
    f"""WITH {LINES_SQL}, b AS (SELECT quantile_cont(price, 0.99) AS k, quantile_cont(price, 0.9) * 1.05 AS k2 FROM lines)
    SELECT {KEY}, round(CASE WHEN price > k THEN k ELSE price END, 4) AS price,
    round(CASE WHEN price > k2 THEN k2 ELSE price END, 4) AS loose FROM lines, b""",
)
def quantile_clip(spark, sf_dir):
    df = lines(spark, sf_dir).withColumn("loose", F.col("price"))
    df = profile.clip_at_quantile(profile.clip_at_quantile(df, "price"), "loose", 0.9, 1.05)
    return df.select(*LINE_KEY, F.round("price", 4).alias("price"), F.round("loose", 4).alias("loose"))


@query(
    "P19",
    f"""WITH {LINES_SQL}, b AS (SELECT quantile_cont(price, 0.01) AS p1, quantile_cont(price, 0.99) AS p99, quantile_cont(discount, 0.01) AS d1,
    quantile_cont(discount, 0.99) AS d99 FROM lines WHERE l_shipdate < timestamp '1998-01-01')
    SELECT {KEY}, round(CASE WHEN price < p1 THEN p1 WHEN price > p99 THEN p99 ELSE price END, 4) AS price,
    round(CASE WHEN discount < d1 THEN d1 WHEN discount > d99 THEN d99 ELSE discount END, 4) AS discount FROM lines, b""",
)
def winsorized(spark, sf_dir):
    """Bounds come from the training period only."""
    df = lines(spark, sf_dir)
    train = df.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    out = prep.winsorize(df, prep.winsor_bounds(train, ["price", "discount"]))
    return out.select(*LINE_KEY, F.round("price", 4).alias("price"), F.round("discount", 4).alias("discount"))


@query(
    "P20",
    "SELECT event_id, CASE WHEN round(least(value / 400, 1.0), 6) >= 0.5 THEN 1 ELSE 0 END AS prediction FROM events",
)
def threshold_decision(spark, sf_dir):
    return scored(spark, sf_dir).select("event_id", C.decide("p", 0.5).alias("prediction"))


@query(
    "P22",
    "SELECT coalesce(nullif(o_orderstatus, 'O'), 'missing') AS status, count(*) AS n FROM orders GROUP BY 1",
)
def missing_category(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    status = C.text_or_missing(F.nullif("o_orderstatus", F.lit("O")))
    return df.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "F11",
    f"""WITH {LINES_SQL}, b AS (SELECT min(price) AS lo, max(price) AS hi, min(tax) AS tlo, max(tax) AS thi FROM lines
    WHERE l_shipdate < timestamp '1998-01-01') SELECT {KEY}, round((price - lo) / (hi - lo), 6) AS price,
    round((tax - tlo) / (thi - tlo), 6) AS tax FROM lines, b""",
)
def min_max_scaled(spark, sf_dir):
    df = lines(spark, sf_dir)
    train = df.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    out = prep.min_max(df, train, ["price", "tax"])
    return out.select(*LINE_KEY, F.round("price", 6).alias("price"), F.round("tax", 6).alias("tax"))
