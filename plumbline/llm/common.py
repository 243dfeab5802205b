"""Helpers of the training-data operators: intermediate tables, batches, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import prepare, shared_dir

#: Stands for a null id inside tasks and files, where a null would turn integers into floats.
NONE = -(2**63)
BATCH_ROWS = 256
BATCH_CHARS = 2_000_000
#: Edges that a task makes stars of at a time.
EDGES = 500_000


def ready(spark: SparkSession) -> SparkSession:
    """The library's settings, and small Arrow batches so that long texts fit a worker."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written below the shared checkpoint folder and read again; cuts the lineage."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column), F.lit(NONE)).cast("long").alias(column)


def unnumbered(df: DataFrame, column: str = "doc_id") -> DataFrame:
    return df.withColumn(column, F.nullif(column, F.lit(NONE)))


def slices(frame: pd.DataFrame, column: str, most: int = BATCH_CHARS) -> Iterator[pd.DataFrame]:
    """Consecutive parts of a batch that hold about `most` characters of a text column."""
    total = frame[column].str.len().fillna(0).cumsum()
    for _, part in frame.groupby((total // most).to_numpy(), sort=True):
        yield part


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each run of rows with equal keys, from batches sorted by them; one run at a time is held."""
    held: dict[str, list[np.ndarray]] = {}
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = {c: batch[c].to_numpy() for c in batch.columns}
        new = np.zeros(len(batch), bool)
        new[0] = True
        for k in keys:
            new[1:] |= columns[k][1:] != columns[k][:-1]
        bounds = [*np.flatnonzero(new).tolist(), len(batch)]
        for a, b in zip(bounds, bounds[1:]):
            key = tuple(columns[k][a] for k in keys)
            if held and key != last:
                yield {c: v[0] if len(v) == 1 else np.concatenate(v) for c, v in held.items()}
                held = {}
            last = key
            for c, v in columns.items():
                held.setdefault(c, []).append(v[a:b])
    if held:
        yield {c: v[0] if len(v) == 1 else np.concatenate(v) for c, v in held.items()}


def spread(rest: np.ndarray, alike: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """A forest over the given positions: from each start, take in what is alike and not yet reached."""
    links = []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = alike(at, rest)
            found = rest[near].tolist()
            links += [(at, i) for i in found]
            queue += found
            rest = rest[~near]
    return links


def tiled(df: DataFrame, group: str, by: str) -> DataFrame:
    """Rows of a group cut into `blocks` parts by hash, each sent to every pair of parts that holds it,
    in runs of (group, low, high)."""
    part = F.pmod(F.xxhash64(by, F.lit(7)), F.col("blocks")).cast("int")
    cut = df.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop("blocks", "other")
    return cut.repartition(group, "low", "high").sortWithinPartitions(group, "low", "high")


def across(run: dict[str, np.ndarray], rest: np.ndarray, at: int) -> np.ndarray | bool:
    """In a tile of two parts, only pairs of one with the other are new."""
    return True if run["low"][0] == run["high"][0] else run["part"][rest] != run["part"][at]


def stars(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """(u, v): every id that the given edges link to a smaller one, with the smallest id they link it to."""
    ids, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places.reshape(2, -1)
    root = np.arange(len(ids))
    while True:
        new, low = root.copy(), np.minimum(root[x], root[y])
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    least = ids[root]
    return pd.DataFrame({"u": ids[ids != least], "v": least[ids != least]})


def contracted(pairs: DataFrame) -> DataFrame:
    """Edges (u, v) with the same components: those that lie together in a task, EDGES at a time, become stars."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= EDGES:
                yield stars(*(np.concatenate([h[c] for h in held]) for c in ("u", "v")))
                held, rows = [], 0
        if held:
            yield stars(*(np.concatenate([h[c] for h in held]) for c in ("u", "v")))

    return pairs.mapInPandas(run, "u long, v long").distinct()


def settled(edges: DataFrame) -> bool:
    """Whether edges (u, v), u above v, are stars: no u has two v, and none is a v. Then v is the smallest id reachable."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "links") -> DataFrame:
    """(id, component) of every id in an edge, component being the smallest id reachable.

    Edges that lie in one task are first made stars there, which leaves few rounds. Then large-star and
    small-star rounds until all is stars; each round is a grouped minimum with partial aggregation and one
    join that adaptive execution may split, and is written out. Edges with a null end, and loops, are left out.
    """
    pairs = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = saved(contracted(pairs), name)
    while not settled(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.distinct(), name)
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(root, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(rest.unionByName(root.withColumnRenamed("m", "v")).distinct(), name)
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
