import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.operators import featurestore, logs, series

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def epoch(seconds):
    return int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) + seconds


def samples(spark, points, name="s"):
    return spark.createDataFrame([(name, at(t), float(v)) for t, v in points], "name string, ts timestamp, value double")


def test_rate_with_reset_and_open_left_edge(spark):
    df = samples(spark, [(0, 10), (60, 20), (90, 5), (120, 25)])
    got = {r.t - epoch(0): r.value for r in series.rate(df, ["name"], 120, 60).collect()}
    # (0, 120] holds 60, 90, 120: +5 after the reset, +20; (-60, 60] holds 0 and 60
    assert got == {60: pytest.approx(10 / 60), 120: pytest.approx(25 / 60), 180: pytest.approx(20 / 30)}


def test_changes(spark):
    df = samples(spark, [(0, 1), (30, 1), (60, 2), (90, 3), (200, 3)])
    got = {r.t - epoch(0): r.value for r in series.changes(df, ["name"], 120, 60).collect()}
    # (0, 120] holds 1, 2, 3 and (60, 180] holds only the 3
    assert got == {0: 0, 60: 1, 120: 2, 180: 0, 240: 0, 300: 0}


def test_ratio_drops_unmatched_and_guards_zero(spark):
    left = spark.createDataFrame([(1, "a", 4.0), (1, "b", 1.0), (1, "c", 1.0)], "t long, n string, value double")
    right = spark.createDataFrame([(1, "a", 2.0), (1, "b", 0.0)], "t long, n string, value double")
    assert {r.n: r.value for r in series.ratio(left, right, ["n"]).collect()} == {"a": 2.0, "b": None}
    assert [r.n for r in series.ratio(left, right, ["n"], above=1.0).collect()] == ["a"]


def test_either_prefers_left(spark):
    left = spark.createDataFrame([(1, "a", 1.0)], "t long, n string, value double")
    right = spark.createDataFrame([(1, "a", 9.0), (2, "a", 9.0), (1, "b", 9.0)], "t long, n string, value double")
    assert sorted((r.t, r.n, r.value) for r in series.either(left, right, ["n"]).collect()) == [(1, "a", 1.0), (1, "b", 9.0), (2, "a", 9.0)]


def test_topk_ranks_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 t", "cast(id as string) n", "cast(id % 7 as double) value")
    top = series.topk(df, 1, ["n"])
    assert sorted((r.t, r.value) for r in top.collect()) == [(0, 6.0), (1, 6.0), (2, 6.0)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_series_key_ignores_map_order(spark):
    df = spark.sql("select map('a','1','b','2') labels union all select map('b','2','a','1')")
    assert df.select(series.series_key()).distinct().count() == 1


def test_alert_transitions(spark):
    held = [0, 60, 120, 180, 240, 300, 360, 600, 660, 900]
    df = spark.createDataFrame([("r", epoch(t)) for t in held], "rule string, t long")
    got = sorted((r.at - epoch(0), r.state) for r in series.alert_states(df, ["rule"], 60, 300, until=epoch(2000)).collect())
    assert got == [(0, "pending"), (300, "firing"), (420, "resolved"), (600, "pending"), (900, "pending")]
    now = series.alert_states(df, ["rule"], 60, 0, until=epoch(900))
    assert sorted((r.at - epoch(0), r.state) for r in now.collect()) == [
        (0, "firing"), (420, "resolved"), (600, "firing"), (720, "resolved"), (900, "firing"),
    ]


def test_alert_runs_cross_slices(spark, monkeypatch):
    monkeypatch.setattr(series, "EVALUATIONS_PER_SLICE", 3)
    df = spark.createDataFrame([("r", epoch(60 * i)) for i in range(20)], "rule string, t long")
    runs = series.breach_runs(df, ["rule"], 60).collect()
    assert [(r.start - epoch(0), r.end - epoch(0), r.evaluations) for r in runs] == [(0, 1140, 20)]


def test_count_over_time_fills_gaps(spark):
    df = samples(spark, [(10, 1), (20, 1), (190, 1)])
    counts = logs.count_over_time(df, ["name"], 60)
    assert sorted((r.t - epoch(0), r.lines) for r in counts.collect()) == [(60, 2), (120, 0), (180, 0), (240, 1)]
    assert sorted(r.t - epoch(0) for r in logs.stalls(counts, ["name"]).collect()) == [120, 180]


def test_long_silence_and_uneven_ranges(spark, monkeypatch):
    monkeypatch.setattr(logs, "STEPS_PER_SLICE", 7)
    df = samples(spark, [(10, 1), (6000, 1)])
    counts = logs.count_over_time(df, ["name"], 60).collect()
    assert sorted(r.t - epoch(0) for r in counts) == list(range(60, 6001, 60)) and sum(r.lines for r in counts) == 2
    points = [(7 * i % 900, i % 5) for i in range(90)]
    rows = samples(spark, points)
    got = {r.t - epoch(0): r.value * 90 for r in logs.line_rate(rows, ["name"], 90, 60).collect()}
    want = {t: sum(t - 90 < s <= t for s, _ in points) for t in range(0, 1080, 60)}
    assert {t: round(v) for t, v in got.items()} == {t: n for t, n in want.items() if n}
    last = {r.t - epoch(0): r.value for r in series.last_over_time(rows, ["name"], ["value"], 90, 60).collect()}
    assert last == {t: max((s, v) for s, v in points if t - 90 < s <= t)[1] for t in got}


def test_rows_before_the_first_shuffle_do_not_grow_with_the_range(spark):
    df = spark.range(1000).selectExpr("'s' name", "timestamp_seconds(1704067200 + id) ts", "cast(id as double) value")
    plan = logs.line_rate(df, ["name"], 48 * 3600, 60)._jdf.queryExecution().executedPlan().toString()
    lines_of = plan.splitlines()
    first = max(i for i, text in enumerate(lines_of) if "Exchange" in text)
    assert not any("Generate" in text for text in lines_of[first:])


def test_shipping_rules(spark):
    rows = [
        ("true", "/api", '{"log":"WARNING: slow\\n","stream":"stderr"}'),
        ("TRUE", "/api", '{"log":"x","stream":"stdout"}'),
        (None, "/api", '{"log":"x","stream":"stdout"}'),
        ("true", "api", '{"log":"an error","stream":"stdout"}'),
        ("true", "/db", "not json, Critical"),
        ("true", "/db", '{"log":"  \\n","stream":"stdout"}'),
    ]
    df = spark.createDataFrame([(at(i), *r) for i, r in enumerate(rows)], "ts timestamp, enabled string, name string, raw string")
    df = df.withColumns({"service": F.lit("s"), "project": F.lit("p")})
    got = [(r.container, r.stream, r.level, r.line) for r in logs.ship(df).orderBy("ts").collect()]
    assert got == [
        ("api", "stderr", "WARNING", "WARNING: slow\n"),
        (None, "stdout", None, "an error"),
        ("db", None, "Critical", "not json, Critical"),
    ]


def test_point_in_time_never_reads_the_future(spark):
    features = [("u", at(0), 1.0), ("u", at(100), 2.0), ("u", at(100), 3.0), ("v", at(50), 9.0)]
    f = spark.createDataFrame(features, "id string, seen timestamp, x double")
    s = spark.createDataFrame(
        [(1, "u", at(99)), (2, "u", at(100)), (3, "u", at(500)), (4, "v", at(49)), (5, "w", at(5)), (6, None, at(5)), (7, "u", at(99))],
        "n int, id string, ts timestamp",
    )
    got = {r.n: r.x for r in featurestore.point_in_time(s, f, "id", "ts", "seen", ["x"]).collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 3.0, 4: None, 5: None, 6: None, 7: 1.0}
    kept = featurestore.point_in_time(s, f, "id", "ts", "seen", ["x"], ttl="100 seconds").collect()
    assert {r.n: r.x for r in kept}[3] is None and {r.n: r.x for r in kept}[2] == 3.0


def test_point_in_time_with_a_hot_entity(spark):
    spine = spark.range(3000).selectExpr("id n", "if(id % 3 = 0, 'hot', concat('k', id % 40)) k", "timestamp_seconds(1704067200 + id * 7919 % 86400) ts")
    feats = spark.range(2000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 40)) k", "timestamp_seconds(1704067200 + id * 104729 % 86400) ft", "id x")
    got = featurestore.point_in_time(spine, feats, "k", "ts", "ft", ["x"], rows_per_slice=100)
    spine.createOrReplaceTempView("spine")
    feats.createOrReplaceTempView("feats")
    want = spark.sql("select n, max(struct(ft, x)).x x from spine left join feats on spine.k = feats.k and ft <= ts group by n")
    assert got.select("n", "x").exceptAll(want).isEmpty() and got.count() == 3000


def test_refresh_equals_full_snapshot(spark):
    df = spark.range(500).selectExpr("id % 20 k", "timestamp_seconds(1704067200 + id * 60) ts", "id x")
    early = featurestore.latest(df.where("ts <= '2024-01-01 03:00:00'"), "k", "ts", ["x"])
    moved = featurestore.refresh(early, df, "k", "ts", ["x"], "2024-01-01 03:00:00", "2024-01-01 06:00:00")
    want = featurestore.latest(df.where("ts <= '2024-01-01 06:00:00'"), "k", "ts", ["x"])
    assert moved.exceptAll(want).isEmpty() and moved.count() == want.count()


def test_labels_without_a_schema(spark):
    lines = ['{"a": 1, "b": {"c": "x", "d": {"e": true}}, "l": [1], "n": null}', '{"a": "one", "z.y": 2.5}', "{}", "[1]", "7", "no json", "", None, '{"a": {"q": 1}}', '{"p": {"q": {"r": {"s": {"t": 1}}}}}']
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = {(r.i, r.label): r.value for r in logs.discovered_labels(df, ["i"]).collect()}
    bad = {(i, "__error__"): "JSONParserErr" for i in (3, 4, 5, 6)}
    assert got == {
        (0, "a"): "1", (0, "b_c"): "x", (0, "b_d_e"): "true", (1, "a"): "one", (1, "z.y"): "2.5", (8, "a_q"): "1", (9, "p_q_r_s"): '{"t":1}', **bad,
    }
    fields = logs.unwrap(df, {"a": ("$.a", "int"), "c": ("$.b.c", "string")}).orderBy("i").collect()
    assert [(r.a, r.c, r.parse_error) for r in fields[:4]] == [(1, "x", False), (None, None, False), (None, None, False), (None, None, True)]
    assert [r.parse_error for r in fields] == [False, False, False, True, True, True, True, False, False, False]
    schema = logs.line_schema(df).first()
    assert schema.parse_errors == 4 and "z.y" in schema.schema and "ARRAY" in schema.schema


def test_views_in_one_shuffle_equal_single_joins(spark):
    import random

    rnd = random.Random(8)
    moment = lambda: rnd.choice([None, *[at(60 * i) for i in range(30)]])
    table = lambda n: spark.createDataFrame([(rnd.choice([None, 1, 2, 3]), moment(), i) for i in range(n)], "e int, t timestamp, v int")
    spine = spark.createDataFrame([(i, rnd.choice([None, 1, 2, 4]), moment()) for i in range(120)], "id int, e int, ts timestamp")
    views = [featurestore.View("a", table(60), "t", ["v"]), featurestore.View("b", table(40), "t", ["v"], "5 minutes"), featurestore.View("c", table(0), "t", ["v"])]
    for size in (7, 10**6):
        got = featurestore.point_in_time_views(spine, views, "e", "ts", size)
        assert sorted(got.columns) == sorted([*spine.columns, *[f"{n}__{c}" for n in "abc" for c in ("ts", "v")]])
        found = {r.id: r for r in got.collect()}
        assert len(found) == 120
        for v in views:
            single = featurestore.point_in_time(spine, v.rows.where("t IS NOT NULL"), "e", "ts", "t", ["v"], v.ttl)
            for r in single.collect():
                want = (r.feature_timestamp, r.v) if r.ts is not None else (None, None)
                assert (found[r.id][f"{v.name}__ts"], found[r.id][f"{v.name}__v"]) == want, (v.name, r)
