import os

import pytest
from pyspark.sql import functions as F

from plumbline import schema as S
from plumbline.functions import columns as C
from plumbline.operators import clean
from plumbline.plans import medallion
from plumbline.sources import files, objects

HEADER = ["", *S.RENAMES]


def write_csv(path, rows):
    os.makedirs(path)
    with open(f"{path}/raw.csv", "w") as f:
        for row in [HEADER, *rows]:
            f.write(",".join("" if v is None else str(v) for v in row) + "\n")


ROWS = [
    # id, target, revolving, age, 30-59, debt, income, open, 90, estate, 60-89, dependents
    [1, 1, "0.5", 45, 1, "0.8", "9000", 10, 0, 4, 2, 2],
    [2, 0, "3.5", 17, 0, "0.1", "1000", 2, 0, 0, 0, 0],
    [3, 0, "2.25", 29, 0, "9000", "NA", 0, 0, 0, 0, "NA"],
    [4, 0, "0.1", 70, 0, "1", "0", 5, 3, 5, 0, 1],
    [5, 0, "0.1", 70, 0, "1", "0", 5, 3, 5, 0, 1],  # repeats row 4 but for the index
    [6, 0, "0.1", 70, 0, "1.0", "0", 5, 3, 5, 0, 1],  # differs as text only
    [7, 0, "0.2", "64.7", 0, "bad", "30000", None, 0, 1, 0, 0],
]


@pytest.fixture
def raw(tmp_path):
    path = str(tmp_path / "csv")
    write_csv(path, ROWS)
    return path


def test_empty_header_cell_and_text_columns(spark, raw):
    df = files.read_csv(spark, raw)
    assert df.columns[0] == "_c0"
    assert {t for _, t in df.dtypes} == {"string"}


def test_clean_dedups_text_then_casts(spark, raw):
    df = clean.clean(files.read_csv(spark, raw), "training")
    assert df.count() == 6
    assert clean.clean(files.read_csv(spark, raw), "training", dedup="after_cast").count() == 5
    assert dict(df.dtypes) == {k: v for k, v in S.CLEAN_TYPES.items()}
    odd = df.where("debt_ratio is null").first()
    assert odd.age == 64 and odd.number_of_open_credit_lines_and_loans is None
    assert df.where("monthly_income is null").count() == 1


def test_modes(spark, raw):
    df = files.read_csv(spark, raw)
    assert S.TARGET not in clean.clean(df, "inference").columns
    with pytest.raises(ValueError):
        clean.clean(df.drop("SeriousDlqin2yrs"), "training")
    with pytest.raises(ValueError):
        clean.clean(df, "other")


def test_features(spark, raw):
    df = clean.feature_table(clean.clean(files.read_csv(spark, raw), "training"), "training")
    assert df.columns == [S.TARGET, *S.FEATURES] and len(S.FEATURES) == 17
    rows = {r.age: r for r in df.collect()}
    assert 17 not in rows
    assert rows[45].delinquency_score == 5.0 and rows[45].has_any_delinquency == 1
    assert rows[45].age_risk_bucket == "middle" and rows[29].age_risk_bucket == "young"
    assert rows[64].age_risk_bucket == "senior" and rows[70].age_risk_bucket == "elderly"
    assert rows[29].revolving_utilization_of_unsecured_lines == 1.0 and rows[29].debt_ratio == 4985.1
    assert rows[29].monthly_income_is_missing == 1 and rows[29].debt_to_income_ratio is None
    assert rows[70].debt_to_income_ratio is None and rows[70].unsecured_to_total_lines_ratio == 0.0
    assert rows[64].monthly_income == 25000.0 and rows[64].unsecured_to_total_lines_ratio == 0.0
    assert abs(rows[45].unsecured_to_total_lines_ratio - 0.6) < 1e-6


def test_medallion_keeps_other_dates(spark, raw, tmp_path):
    root = str(tmp_path / "layers")
    one = medallion.run(spark, raw, root, "2024-01-01", min_rows=1)
    medallion.run(spark, raw, root, "2024-01-02", min_rows=1)
    medallion.run(spark, raw, root, "2024-01-02", min_rows=1)
    assert (one.typed_rows, one.feature_rows) == (6, 5)
    dates = {r[0]: r[1] for r in spark.read.parquet(one.features).groupBy(S.PARTITION).count().collect()}
    assert dates == {"2024-01-01": 5, "2024-01-02": 5}
    with pytest.raises(ValueError, match="too low"):
        medallion.run(spark, raw, root, "2024-01-03")
    assert medallion.run(spark, raw, str(tmp_path / "inference"), "2024-01-01", mode="inference").feature_rows == 5


def test_row_ids_with_a_key_do_not_follow_the_layout(spark, raw, tmp_path):
    key = ["age", "revolving_utilization_of_unsecured_lines"]
    typed = clean.clean(files.read_csv(spark, raw), "inference")
    ids = lambda df: sorted((r.age, r[S.ROW_ID]) for r in clean.feature_table(df, "inference", key).collect())
    assert ids(typed) == ids(typed.repartition(5, "debt_ratio"))
    done = medallion.run(spark, raw, str(tmp_path / "keyed"), "2024-01-01", "inference", key=key)
    assert sorted((r.age, r[S.ROW_ID]) for r in spark.read.parquet(done.features).collect()) == ids(typed)


def test_partition_filter_prunes_directories(spark, raw, tmp_path):
    done = medallion.run(spark, raw, str(tmp_path / "layers"), "2024-01-01", min_rows=1)
    plan = files.read_partition(spark, done.typed, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_latest_partition(spark, tmp_path):
    root = str(tmp_path / "t")
    for date in ("2024-01-09", "2024-01-10", "2023-12-31"):
        files.write_partitioned(spark.range(3), root, date)
    assert files.latest_partition(spark, root).first()[0] == "2024-01-10"
    assert files.latest_partition(spark, root, "2020-01-01").first()[0] == "2020-01-01"
    files.write_by(spark.sql("SELECT 1 AS x, explode(array(NULL, '2024:02')) AS ingestion_date"), root, ["ingestion_date"])
    (tmp_path / "t" / "notes").mkdir()
    assert sorted(files.partitions(spark, root)) == ["2023-12-31", "2024-01-09", "2024-01-10", "2024:02"]
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no partitions"):
        files.latest_partition(spark, str(tmp_path / "none"))


def test_recursive_scan_takes_both_suffixes(spark, tmp_path):
    root = tmp_path / "scores"
    spark.range(5).coalesce(1).write.parquet(str(root / "a" / "b"))
    part = next(p for p in (root / "a" / "b").iterdir() if p.name.endswith(".parquet"))
    (root / "c").mkdir()
    (root / "c" / "batch.parquet.out").write_bytes(part.read_bytes())
    (root / "c" / "notes.txt").write_text("not a table")
    assert files.read_recursive(spark, str(root)).count() == 10


def test_empty_table_is_refused(spark):
    with pytest.raises(ValueError):
        files.require_rows(spark.range(0))


def test_row_gate(spark):
    assert clean.gate_rows(spark.range(5), 5).first().accepted
    assert clean.gate_rows(spark.range(5), 9, active=False).first().accepted
    with pytest.raises(Exception, match="row count too low: 5"):
        clean.gate_rows(spark.range(5), 6).collect()


def test_object_listing_and_bodies(spark, tmp_path):
    root = tmp_path / "store"
    for box, names in {"one": ["a.txt", "b.BIN", "c.JSON"], "two": ["z.md"]}.items():
        (root / box / "deep").mkdir(parents=True)
        for n in names:
            (root / box / "deep" / n).write_bytes(b"h\xc3\xa9" if n != "b.BIN" else b"\x00\xff")
    df = objects.with_names(objects.scan(spark, str(root)), str(root))
    keys = lambda *a, **k: [r.key for r in objects.list_objects(df, *a, **k).collect()]
    assert keys("one") == ["deep/a.txt", "deep/b.BIN", "deep/c.JSON"]
    assert keys("one", start_after="deep/a.txt", max_keys=1) == ["deep/b.BIN"]
    assert keys("one", prefix="deep/c") == ["deep/c.JSON"]
    assert keys("one", allowed=["two"]) == []
    assert [r.container for r in objects.containers(df, start_after="one").collect()] == ["two"]
    bodies = {r.key: r.b for r in df.select("key", objects.body("content", "key").alias("b")).collect()}
    assert bodies["deep/a.txt"] == "hé" and bodies["deep/c.JSON"] == "hé" and bodies["deep/b.BIN"] == "AP8="


def test_caps_keep_null(spark):
    df = spark.createDataFrame([(None,), (0.5,), (7.0,)], "x double")
    got = df.select(C.cap("x", 1.0).alias("a"), C.winsorize("x", 0.6, 5.0).alias("b")).collect()
    assert [tuple(r) for r in got] == [(None, None), (0.5, 0.6), (1.0, 5.0)]


@pytest.mark.parametrize(
    "value, number, percent",
    [(0.0, "0", "0%"), (0.1234, "123.4m", "12.34%"), (1.0, "1", "100%"), (1234567.0, "1.235M", "123456700%"), (950.0, "950", "95000%")],
)
def test_number_text(spark, value, number, percent):
    df = spark.createDataFrame([(value,)], "x double")
    assert tuple(df.select(C.human_number("x"), C.percent_text("x")).first()) == (number, percent)


def test_soft_cast(spark):
    df = spark.createDataFrame([("3.7",), ("NA",), ("",), (None,), ("12",)], "x string")
    assert [r[0] for r in df.select(C.soft_cast("x", "int")).collect()] == [3, None, None, None, 12]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(C.nan_to_null("x")).collect()] == [None, 1.0, None]
    assert df.select(F.count(C.nan_to_null("x"))).first()[0] == 1


def test_pages_list_only_folders_that_can_hold_them(spark, tmp_path):
    keys = [f"c/{a}/{b}/{i}.txt" for a in "abcde" for b in "xyz" for i in range(4)] + ["c/a.txt", "c/a-1", "c/b/w.txt", "d/1.txt", "c/_SUCCESS"]
    for key in keys:
        (tmp_path / key).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / key).write_text(key)
    root = str(tmp_path)
    whole = objects.with_names(objects.scan(spark, root), root)
    every = sorted(k.removeprefix("c/") for k in keys if k.startswith("c/") and "_SUCCESS" not in k)
    for prefix, after, most in [("", "", 1000), ("", "", 3), ("b/", "", 1000), ("b/y", "b/y/1.txt", 1000), ("", "c/z/2.txt", 5), ("a", "", 6), ("q", "", 9), ("", "zz", 9), ("b/x/0.txt", "", 2)]:
        lister = objects.Lister(spark, root)
        page = objects.objects_page(spark, root, "c", (), prefix, after, most, lister).collect()
        want = [k for k in every if k.startswith(prefix) and k > after][:most]
        assert [r.key for r in page] == want
        assert [(r.key, r.length) for r in objects.list_objects(whole, "c", (), prefix, after, most).collect()] == [(r.key, r.length) for r in page]
    few, all_ = objects.Lister(spark, root), objects.Lister(spark, root)
    objects.objects_page(spark, root, "c", (), "", "", 3, few)
    objects.objects_page(spark, root, "c", (), "", "", 1000, all_)
    assert few.entries <= 8 + 3 + 4 < all_.entries / 4
    assert objects.objects_page(spark, root, "c", ["d"]).isEmpty() and objects.objects_page(spark, root, "nothing").isEmpty()
    assert [r.container for r in objects.containers_page(spark, root, (), "c").collect()] == ["d"]
    assert [r.container for r in objects.containers_page(spark, root, ["c", "x"]).collect()] == ["c"]


def test_dedup_follows_the_size_of_the_input(spark, tmp_path, monkeypatch):
    """More text is held by more tasks than the session's shuffle has, with the same rows; small text as before."""
    rows = [(str(i % 700), "x" * 50, None if i % 3 else "NA") for i in range(4000)]
    folder = str(tmp_path / "two words")
    spark.createDataFrame(rows, "a string, `b.c` string, d string").write.option("header", True).csv(folder)
    text = files.read_csv(spark, folder)
    size = sum(f.stat().st_size for f in (tmp_path / "two words").glob("*.csv"))
    assert files.input_bytes(text) == size and files.input_bytes(spark.range(3)) == 0
    before = clean.distinct_rows(text)
    monkeypatch.setattr(clean, "DEDUP_BYTES", size // 20)
    after = clean.distinct_rows(text)
    assert after.rdd.getNumPartitions() >= 20 and before.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect())) and after.count() == 1400
