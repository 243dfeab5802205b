"""Near-duplicate embeddings by int8 tile products with error bounds.

Equal vectors of a label become one class. The classes of a label are cut into blocks by hash, and each
pair of blocks is a tile, a task's unit of work. In a tile, unit vectors u are rounded to int8 codes,
u = s q + e, and for any two

    |u . v - s q . t r| <= |s q| |f| + |e|       (v = t r + f)

with exact norms, so the integer product gives an interval for the cosine. Only pairs whose interval
reaches the threshold are computed again in double precision. A tile returns, per class, the number of
vectors linked, and a forest of its links, so its output grows with its rows and not with its pairs.

Labels must be equal and not null. Vectors that are null, zero or hold null or non-finite components
link with nothing, nor do vectors of different lengths. Rows with one vec_id count as vectors of their
own. A null vec_id names no component: such a row has its group's smallest id, or null; it is kept only
if null. An empty table gives no rows. Columns other than vec_id, embedding and label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import components, ready, runs, saved, spread, tiled

BLOCK = 2048
STRIPE = 256
#: Covers rounding in the bounds themselves.
SLACK = 1e-6


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scales, the norms of scale * codes, and the norms of what rounding lost."""
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


def linked(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with cosine of x[i] and y[j] >= threshold; i < j if both are the same block."""
    norm_x, norm_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    qx, sx, bx, ex = quantised(x / norm_x[:, None])
    qy, sy, _, ey = quantised(y / norm_y[:, None])
    exact = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64  # sums of products stay whole numbers
    right = np.ascontiguousarray(qy.T, exact)
    for a in range(0, len(x), STRIPE):
        b = min(a + STRIPE, len(x))
        about = (qx[a:b].astype(exact) @ right).astype(np.float64) * (sx[a:b, None] * sy[None, :])
        maybe = about + bx[a:b, None] * ey[None, :] + ex[a:b, None] + SLACK >= threshold
        if same:
            maybe &= np.arange(len(y))[None, :] > np.arange(a, b)[:, None]
        i, j = np.nonzero(maybe)
        for k in range(0, len(i), 100_000):
            p, q = i[k : k + 100_000] + a, j[k : k + 100_000]
            ok = np.einsum("ij,ij->i", x[p], y[q]) / (norm_x[p] * norm_y[q]) >= threshold
            yield p[ok], q[ok]


def tile(run: dict[str, np.ndarray], threshold: float) -> pd.DataFrame:
    """(a, links, b): vectors linked to class a in this tile, or with b set, a link of the forest."""
    ids, copies = run["class"], run["copies"].astype(np.int64)
    x = np.stack(run["embedding"]).astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])  # by powers of two, so squares stay finite
    same = run["low"][0] == run["high"][0]
    first = np.arange(len(ids)) if same else np.flatnonzero(run["part"] == run["low"][0])
    second = first if same else np.flatnonzero(run["part"] == run["high"][0])
    counts, near = np.zeros(len(ids), np.int64), np.zeros((len(ids), len(ids)), bool)
    if len(first) and len(second):
        for i, j in linked(x[first], x[second], threshold, same):
            i, j = first[i], second[j]
            np.add.at(counts, i, copies[j])
            np.add.at(counts, j, copies[i])
            near[i, j] = near[j, i] = True
    links = spread(np.flatnonzero(near.any(1)), lambda at, rest: near[at, rest])
    some = counts > 0
    nothing = np.full(some.sum(), -1)
    a, b = ids[[p for p, _ in links]] if links else [], ids[[q for _, q in links]] if links else []
    return pd.DataFrame({"a": np.concatenate([ids[some], a]).astype(np.int64), "links": np.concatenate([counts[some], np.zeros(len(links))]).astype(np.int64), "b": np.concatenate([nothing, b]).astype(np.int64)})


def near(vectors: DataFrame, threshold: float) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches, ["group", "low", "high"]):
            yield tile(run, threshold)

    ready(vectors.sparkSession).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK))
    rows = vectors.select("vec_id", "label", "embedding")
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fit = F.coalesce(F.col("label").isNotNull() & ~bad & F.exists("embedding", lambda v: v != 0), F.lit(False))
    fine = rows.where(fit)
    classes = fine.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = saved(classes.withColumn("class", F.monotonically_increasing_id()).withColumn("group", F.xxhash64("label", F.size("embedding"))), "classes")
    blocks = classes.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    work_on = classes.select("group", "class", "copies", "embedding").join(blocks, "group")
    found = saved(tiled(work_on, "group", "class").mapInPandas(work, "a long, links long, b long"), "tiles")

    counts = found.where("b = -1").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b >= 0"), name="components").withColumnRenamed("id", "class")
    named = classes.select("label", "embedding", "class", "copies", "rep").join(joined, "class", "left").join(counts, "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "component").select("label", "embedding", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = fine.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = rows.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
