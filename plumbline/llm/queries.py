"""The registered queries of the training-data operators."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import chat, decontaminate, language, minhash, packing, periodic, planes, prefixes, secrets, sites, substrings, toxicity, vectors
from plumbline.llm.common import ready, saved
from plumbline.plans.registry import Query, table
from plumbline.session import shared_dir

QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    def add(fn):
        def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(spark), sf_dir)

        QUERIES[fn.__name__] = Query(fn.__name__, fn.__name__.partition("_")[0], plan, sql)
        return fn

    return add


@query()
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


@query()
def op5_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "ids")
    planes.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return planes.read(spark, path).select("doc_id", "start", "n_tokens", F.col("ids_crc32"))


@query()
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near(table(spark, sf_dir, "documents"), percent=85).drop("text_hash")


@query()
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents"), size=50).drop("kept_text")


@query()
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.found(docs, items, rate=0.15).drop("text_hash")


@query(
    """
    WITH l AS (SELECT doc_id, site, generate_subscripts(a, 1) AS pos, unnest(a) AS line
        FROM (SELECT doc_id, coalesce(source, '') AS site, string_split(text, chr(10)) AS a FROM documents)),
    b AS (SELECT line, min(doc_id) AS first FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 10),
    m AS (SELECT l.*, b.first IS NOT NULL AND (l.doc_id <> b.first
        OR row_number() OVER (PARTITION BY l.doc_id, l.line ORDER BY l.pos) > 1) AS gone FROM l LEFT JOIN b USING (line))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
    FROM m GROUP BY doc_id
    """
)
def op6_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.cleaned(table(spark, sf_dir, "documents"), sites=10).select("doc_id", "n_lines", "n_removed", "text")


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.scored(docs, toxicity.train(docs, labels)).drop("text_hash")


@query()
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(secrets.samples(docs)))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


@query()
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query()
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(saved(chat.formatted(talks), "chat"))


@query()
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predicted(docs, language.train(docs, public_tokenizers.path("piece_bpe_32k.model")))


def read_planted(doc_id: int, n: int) -> np.ndarray | None:
    """Every tenth document, by crc32(doc_id), repeats a stretch of itself from some word on."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return np.r_[np.arange(a), a + np.arange(n - a) % p]


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapsed(table(spark, sf_dir, "documents"), read=read_planted)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "start",
        "length",
        "period",
        F.floor(1000 * F.col("length") / F.col("period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Turns of the conversations whose first crc32(conv_id) % 6 turns are those of conversation conv_id - conv_id % 100."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefixes.grafted(prefixes.turns(conversations), F.col("conv_id") - F.col("conv_id") % 100, h, most=5)


@query()
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(rebuilt(table(spark, sf_dir, "conversations")))
