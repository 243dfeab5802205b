import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import drift, featurestore, rules, series

T0 = dt.datetime(2024, 1, 1)
BASE = 1704067200


def samples(spark, rows):
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s), m, labels, float(v)) for s, m, labels, v in rows], "ts timestamp, metric string, labels map<string,string>, value double")


def rule(alert, metric, func="last", matchers=(), range_s=60, sum_by=(), above=None, below=None, wait_s=0, text=""):
    return (alert, metric, list(matchers), func, range_s, list(sum_by), above, below, wait_s, "warning", text)


def moves(spark, rows, given, step=60, until=BASE + 3600):
    found = rules.transitions(samples(spark, rows), spark.createDataFrame(given, rules.RULES), step, until=until)
    return sorted((r.alert, r.labels.get("name", ""), r.state, r["at"] - BASE, r.summary) for r in found.collect())


def test_functions_bounds_waiting_and_texts(spark):
    rows = [(60 * i, "load", {"name": "db"}, 0.95 if 3 <= i <= 8 else 0.1) for i in range(1, 20)]
    rows += [(60 * i, "load", {"name": "web"}, 0.95 if i == 5 else 0.1) for i in range(1, 20)]
    rows += [(60 * i, "start", {"name": "db"}, 100 if i < 10 else 200) for i in range(1, 20)]
    given = [
        rule("High", "load", above=0.9, wait_s=180, text="{{name}} at {{value:percent}}{{nothing}}"),
        rule("Web", "load", matchers=[("name", "=~", "w.*"), ("zone", "=", "")], above=0.9, text="{{name}} {{value}}"),
        rule("Restart", "start", "changes", range_s=120, above=0.0, text="{{value:fixed}}"),
        rule("Low", "load", matchers=[("name", "!=", "db"), ("name", "!~", "x")], below=0.05),
    ]
    assert moves(spark, rows, given) == [
        ("High", "db", "firing", 360, "db at 95%"), ("High", "db", "pending", 180, "db at 95%"), ("High", "db", "resolved", 540, "db at 95%"),
        ("High", "web", "pending", 300, "web at 95%"),
        ("Restart", "db", "firing", 600, "1.000"), ("Restart", "db", "resolved", 660, "1.000"),
        ("Web", "web", "firing", 300, "web 0.95"), ("Web", "web", "resolved", 360, "web 0.95"),
    ]


def test_rates_equal_the_single_operator_and_sum_by_labels(spark):
    rnd = random.Random(4)
    rows = []
    for name in "ab":
        for zone in "xy":
            at, value = 0, 0
            for _ in range(80):
                at, value = at + rnd.choice([7, 15, 30, 200]), rnd.choice([0, value + rnd.randint(0, 50), value + 9])
                rows.append((at, "c", {"name": name, "zone": zone}, value))
    df = samples(spark, rows)
    given = spark.createDataFrame([rule("each", "c", "rate", range_s=120, above=0.0), rule("sum", "c", "rate", range_s=300, sum_by=["name"], above=0.0), rule("up", "c", "increase", range_s=120, above=0.0)], rules.RULES)
    got = rules.values(df, given, 60).collect()
    flat = df.select("ts", F.col("labels")["name"].alias("name"), F.col("labels")["zone"].alias("zone"), "value")
    each = series.rate(flat, ["name", "zone"], 120, 60)
    want = {(r.name, r.zone, r.t): round(r.value, 9) for r in each.collect()}
    assert {(r.labels["name"], r.labels["zone"], r.t): round(r.value, 9) for r in got if r.alert == "each"} == want
    total = series.rate(flat, ["name", "zone"], 300, 60).groupBy("name", "t").agg(F.sum("value").alias("v"))
    assert {(r.labels["name"], len(r.labels), r.t): round(r.value, 9) for r in got if r.alert == "sum"} == {(r.name, 1, r.t): round(r.v, 9) for r in total.collect()}
    assert len([r for r in got if r.alert == "up"]) == len(want)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")


def test_another_rule_adds_no_scan(spark, tmp_path):
    samples(spark, [(i, "m", {"a": str(i % 3)}, i) for i in range(50)]).write.parquet(f"{tmp_path}/s")
    df = spark.read.parquet(f"{tmp_path}/s")
    count = [scans(rules.transitions(df, spark.createDataFrame([rule(f"r{i}", "m", above=float(i)) for i in range(n)], rules.RULES), 60, until=BASE)) for n in (1, 9)]
    assert count[0] == count[1] > 0


def test_samples_of_one_metric_do_not_meet_in_one_task(spark):
    hint = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = samples(spark, [(60 * i, "m", {"a": str(i % 3), "b": None}, i) for i in range(50)])
        found = rules.values(df, spark.createDataFrame([rule("r", "m", "changes", range_s=600, above=0.0)], rules.RULES), 60)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(metric#" in plan and not [x for x in plan.splitlines() if "hashpartitioning(metric#" in x and "series#" not in x]
        assert {tuple(sorted(r.labels.items(), key=str)) for r in found.collect()} == {(("a", str(i)), ("b", None)) for i in range(3)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", hint)


def test_profiles_of_dates_add_up(spark):
    rnd = random.Random(6)
    rows = [(f"2024-01-{1 + i % 20:02d}", rnd.choice([None, float("nan"), rnd.gauss(i % 20 / 5, 1), 3.0]), float(rnd.randint(0, 4)), rnd.choice([None, "p", "q", "r"])) for i in range(2000)]
    df = spark.createDataFrame(rows, "day string, x double, k double, c string")
    reference = df.where("day < '2024-01-08'")
    edges = drift.reference_edges(reference.withColumn("x", F.when(~F.isnan("x"), F.col("x"))), ["x", "k"], 5)
    daily = drift.profile_by(df, ["day"], edges, ["c"])
    for low, high in [("2024-01-08", "2024-01-20"), ("2024-01-10", "2024-01-10"), ("2024-01-01", "2024-01-07")]:
        part = df.where(F.col("day").between(low, high))
        direct = drift.profile_by(part, [], edges, ["c"])
        summed = drift.merged(daily.where(F.col("day").between(low, high)))
        key = lambda d: sorted((r.feature, str(r.bin), r.rows, round(r.total or 0, 6), round(r.squares or 0, 6)) for r in d.collect())
        assert key(direct) == key(summed)
        base = drift.merged(daily.where("day < '2024-01-08'"))
        clean = lambda d: d.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
        want = {r.feature: r.psi for r in drift.feature_psi(clean(reference), clean(part), ["x", "k"], ["c"], 5).collect()}
        assert {r.feature: pytest.approx(r.psi, abs=2e-6) for r in drift.profile_psi(base, summed).collect()} == want
        one = {r.feature: r for r in drift.profile_moments(summed).collect()}["x"]
        real = clean(part).agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"), F.avg(F.col("x").isNull().cast("double")).alias("n")).first()
        assert (one["mean"], one["std"], one["null_rate"]) == pytest.approx((real.m, real.s, real.n))


def test_stored_side_is_not_shuffled(spark, tmp_path):
    stored = spark.createDataFrame([(i, float(i)) for i in range(200)], "e long, v double")
    name = "features_for_test"
    featurestore.store(stored, name, "e", 8, f"{tmp_path}/t")
    asked = spark.createDataFrame([(i % 250, i) for i in range(400)], "e long, n long")
    out = featurestore.stored_lookup(asked, name, "e")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    # the one exchange lies above the requests: the scan of the table has none between it and the join
    assert "Exchange" not in plan[plan.index("Bucketed: true") - 200 :]
    assert sorted(map(tuple, out.select("e", "n", "v").collect()), key=str) == sorted(((i % 250, i, float(i % 250) if i % 250 < 200 else None) for i in range(400)), key=str)
    spark.sql(f"DROP TABLE {name}")
