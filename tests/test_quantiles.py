import random

import numpy as np
import pytest

from plumbline.operators.quantiles import quantiles

SHARES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("few", [3, 40, 10_000])
def test_matches_numpy_through_every_path(spark, few):
    rng = random.Random(7)
    values = [rng.gauss(0, 100) for _ in range(3000)] + [5.0] * 1500 + [None] * 50
    got = quantiles(frame(spark, values), {"x": SHARES}, few_rows=few)["x"]
    want = np.quantile([v for v in values if v is not None], SHARES)
    assert np.allclose(got, want, rtol=1e-12, atol=1e-12)


def test_one_value_everywhere(spark):
    assert quantiles(frame(spark, [2.5] * 1000), {"x": [0.1, 0.5]}, few_rows=2)["x"] == [2.5, 2.5]


def test_empty_and_single(spark):
    assert quantiles(frame(spark, [None, None]), {"x": [0.5]})["x"] == [None]
    assert quantiles(frame(spark, [4.0]), {"x": [0.25, 1.0]})["x"] == [4.0, 4.0]


def test_many_columns_share_the_scans(spark):
    df = spark.range(1000).selectExpr("cast(id as double) a", "cast(id % 7 as double) b")
    got = quantiles(df, {"a": [0.5], "b": [0.5, 0.99]}, few_rows=10)
    assert got["a"] == [499.5]
    assert got["b"] == [float(np.quantile(np.arange(1000) % 7, q)) for q in (0.5, 0.99)]
