"""The corpus pipeline: toxicity, line dedup, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return
the columns of documents; the last returns packed pieces. Toxicity and decontamination drop whole rows by
doc_id and hash of the text, so rows with one doc_id are decided each by its own text, and rows that are
equal in both stay or go together. Near-dedup numbers the rows itself: exactly one row of each group stays,
that of the smallest doc_id (null last), also where rows repeat or lack a doc_id. Texts without words are
in no group, so those rows stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, minhash, packing, sites, toxicity
from plumbline.llm.common import ready, saved
from plumbline.plans.registry import Query, table

NEAR_PERCENT = 80
ERROR_RATE = 0.15
SITES = 10
CAPACITY = 2048


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs less the rows that gone (doc_id, text_hash) names."""
    gone = gone.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(gone["_doc"]) & (F.xxhash64(docs["text"]) == gone["_hash"])
    return docs.join(gone, same, "left_anti")


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a row number that is written, so that a lost task can't number anew; (rows, its column)."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    return saved(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _without(docs, toxicity.scored(docs, model).where("predicted = 1"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = sites.cleaned(docs, SITES).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = _numbered(docs)
    groups = minhash.near(rows.select(F.col(row).alias("doc_id"), "text"), NEAR_PERCENT)
    groups = groups.select(F.col("doc_id").alias("_at"), F.col("component_id").alias("_group"))
    ids = rows.select(F.col(row).alias("_at"), F.struct(F.col("doc_id").isNull(), "doc_id", row).alias("_rank"))
    first = groups.join(ids, "_at").groupBy("_group").agg(F.min("_rank").alias("_rank"))
    kept = first.select(F.col(f"_rank.{row}").alias("_kept"))
    return rows.join(kept, rows[row] == kept["_kept"], "left_semi").drop(row)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, decontaminate.found(docs, table(spark, sf_dir, "benchmark"), ERROR_RATE))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: No SQL says what a fitted classifier or a tokenizer returns.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = Query("pipeline", "pipeline", run, ORACLE_SQL)
