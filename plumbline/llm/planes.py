"""Token-id files by bit-plane shuffling.

Ids are cut into blocks of a fixed number of ids. A block is transposed into byte planes (all lowest
bytes, then the next, ...) or bit planes, and each plane is compressed with zstandard by itself.
A file set is a folder with two tables:

chunks  shard, block, n_ids, planes (one compressed binary per plane), and for the documents that
        start in the block doc_ids, starts (ids of the shard before them) and lengths; -2**63 stands for a null doc_id
index   shard, block, start (ids of all files before the block), n_ids, plane_bytes

A shard is a range of doc_id; shards ascend by doc_id and only the last block of a shard may be
shorter. Both tables are written by Spark, so a lost task leaves nothing behind.

Null text is empty and has its end id alone; rows with one doc_id are separate documents, ordered by
the hash of their text; a null doc_id comes first. An empty table writes empty tables. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import numbered, ready, slices, unnumbered
from plumbline.llm.tokens import encoder

CHUNK = "shard int, block int, n_ids int, planes array<binary>, doc_ids array<long>, starts array<long>, lengths array<long>"


def shuffled(ids: np.ndarray, bits: bool = False) -> list[np.ndarray]:
    """The byte planes of unsigned 32-bit ids, lowest first; or their 32 bit planes."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if not bits:
        return [np.ascontiguousarray(r) for r in rows]
    return [np.packbits((r >> k) & 1) for r in rows for k in range(8)]


def unshuffled(planes: list[bytes], n: int) -> np.ndarray:
    rows = [np.frombuffer(p, np.uint8) for p in planes]
    if len(rows) == 32:
        bit = [np.unpackbits(r, count=n) for r in rows]
        rows = [sum(bit[8 * byte + k] << k for k in range(8)).astype(np.uint8) for byte in range(4)]
    return np.ascontiguousarray(np.stack(rows, 1)).view("<u4").ravel()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, block: int = 65_536, bits: bool = False, level: int = 3) -> None:
    """Encode all documents and write their ids in ascending doc_id order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard, encode, press = TaskContext.get().partitionId(), encoder(tokenizer).encode, zstandard.ZstdCompressor(level=level)
        end = np.array([end_id], "<u4").tobytes()
        held, number, before, open_docs = bytearray(), 0, 0, deque()

        def chunk(size: int) -> pd.DataFrame:
            nonlocal number, before
            ids = np.frombuffer(bytes(held[: 4 * size]), "<u4")
            del held[: 4 * size]
            started = []
            while open_docs and open_docs[0][1] < before + size:
                started.append(open_docs.popleft())
            doc_ids, starts, lengths = ([list(x) for x in zip(*started)] if started else ([], [], []))
            row = (shard, number, size, [press.compress(p.tobytes()) for p in shuffled(ids, bits)], doc_ids, starts, lengths)
            number, before = number + 1, before + size
            return pd.DataFrame([row], columns=["shard", "block", "n_ids", "planes", "doc_ids", "starts", "lengths"])

        for batch in batches:
            for frame in slices(batch, "text"):
                for doc_id, text in zip(frame["doc_id"], frame["text"]):
                    ids = encode(text) + end
                    open_docs.append((int(doc_id), before + len(held) // 4, len(ids) // 4))
                    held += ids
                    while len(held) >= 4 * block:
                        yield chunk(block)
        if held:
            yield chunk(len(held) // 4)

    ready(docs.sparkSession)
    rows = docs.select(numbered(), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    rows.mapInPandas(run, CHUNK).write.parquet(f"{path}/chunks")
    chunks = docs.sparkSession.read.schema(CHUNK).parquet(f"{path}/chunks")
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))  # a row per shard
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = chunks.select("shard", "block", "n_ids", F.transform("planes", F.length).alias("plane_bytes"))
    sizes = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(base, "shard")
    sizes.select("shard", "block", (F.col("base") + F.col("inside")).alias("start"), "n_ids", "plane_bytes").write.parquet(f"{path}/index")


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and on request the ids of every document in the files.

    A shard's blocks stream through one task in order; a document that spans blocks is carried on.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, shard, open_docs, before = zstandard.ZstdDecompressor(), None, deque(), 0
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                if row.shard != shard:
                    shard, before = row.shard, 0
                ids = memoryview(unshuffled([unpack.decompress(p) for p in row.planes], row.n_ids).tobytes())
                for d, s, n in zip(row.doc_ids, row.starts, row.lengths):
                    open_docs.append([int(d), int(s), int(n), 0, []])
                while open_docs and open_docs[0][1] < before + row.n_ids:
                    doc = open_docs[0]
                    a, b = max(doc[1], before), min(doc[1] + doc[2], before + row.n_ids)
                    part = ids[4 * (a - before) : 4 * (b - before)]
                    doc[3] = zlib.crc32(part, doc[3])
                    if with_ids:
                        doc[4].append(bytes(part))
                    if doc[1] + doc[2] > before + row.n_ids:
                        break
                    rows.append((doc[0], row.base + doc[1], doc[2], doc[3], b"".join(doc[4])))
                    open_docs.popleft()
                before += row.n_ids
            out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
            yield out if with_ids else out.drop(columns="ids")

    ready(spark)
    chunks = spark.read.schema(CHUNK).parquet(f"{path}/chunks")
    index = spark.read.schema("shard int, block int, start long, n_ids int, plane_bytes array<int>").parquet(f"{path}/index")
    base = index.groupBy("shard").agg(F.min("start").alias("base"))
    rows = chunks.join(base, "shard").repartition("shard").sortWithinPartitions("shard", "block")
    return unnumbered(rows.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")))
