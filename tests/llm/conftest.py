import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    """documents(rows): (doc_id, text[, source]) as a documents table with extra, clashing columns."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None, 7, "x") for r in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", length int, h string")

    return make


@pytest.fixture(scope="module")
def sample(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    return [tuple(r) for r in rows]


def as_dict(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


__all__ = ["T", "as_dict"]
