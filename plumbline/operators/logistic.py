"""Many logistic regressions over the same rows, fitted side by side and scored without a shuffled row per score.

A pass over the rows sums, for every fit, the loss, its slope and its curvature (a few numbers per feature) inside the
tasks that hold them; Newton's step follows on the driver from those sums. The loss is that of fit_logistic: balanced
weights, and 1 / (2 c) times the squares of the coefficients, the intercept free. It is convex with one minimum, so
the fits end where the single ones end. Fits at the same point share its sums: all follow the one of the middle c
until that ends, and go their own ways from there.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PASSES = 100
#: A fit ends when its step is below this share of its coefficients.
CLOSE = 1e-9
CHUNK = 1024
#: Margins below it cost nothing: exp(-80) is 2e-35.
LEAST_MARGIN = -80.0
#: Rows that a task scores at a time, scores that outline them, rows of one fit counted at a time, and such ranges per task.
BUFFER = 1 << 18
SKETCH = 512
RANGE_ROWS = 500_000
RANGES_PER_TASK = 8


@dataclass(frozen=True)
class Fit:
    """What one fit minimises: the strength c, the weight of each class, and the fold it leaves out."""

    c: float
    weights: dict[int, float]
    left_out: int | None = None


def complete(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """df with its features as doubles; a missing one raises, as it does in VectorAssembler."""
    raised = lambda f: F.raise_error(F.lit(f"{f} is missing")).cast("double")
    return df.withColumns({f: F.when(F.col(f).isNull() | F.isnan(F.col(f).cast("double")), raised(f)).otherwise(F.col(f).cast("double")) for f in features})


def _packed(df: DataFrame, features: Sequence[str], label: str, fold: str | None, times: str | None) -> RDD:
    """(class, fold, features, how often each row counts) as arrays, kept by the tasks that hold them from pass to pass."""
    names = list(features)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, y, f = batch[names].to_numpy(np.float64), batch["__y"].to_numpy(), batch["__f"].to_numpy()
            for k, out in itertools.product((0, 1), np.unique(f).tolist()):
                here = (y == k) & (f == out)
                n = batch["__n"].to_numpy(np.float64)[here] if times else None
                if here.any():
                    yield pd.DataFrame({"block": [pickle.dumps((k, out, x[here], n))]})

    rows = complete(df, names).select(
        *names, F.col(label).cast("int").alias("__y"),
        (F.coalesce(F.col(fold).cast("int"), F.lit(-2)) if fold else F.lit(0)).alias("__f"), *([F.col(times).alias("__n")] if times else []),
    )
    return rows.mapInPandas(pack, "block binary").rdd.map(lambda r: pickle.loads(r.block)).persist(StorageLevel.MEMORY_AND_DISK)


def sums(blocks: RDD, features: Sequence[str], at: np.ndarray, fits: Sequence[Fit]) -> np.ndarray:
    """(fit, numbers): loss, slope and upper curvature of the weighted loss at the coefficients `at`, without the penalty."""
    d = len(features) + 1
    low, high = np.triu_indices(d)
    left_out = [-1 if f.left_out is None else f.left_out for f in fits]
    points, which = np.unique(np.c_[at, left_out], axis=0, return_inverse=True)

    def run(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros((2, len(points), 1 + d + len(low)))
        for k, out, x, n in blocks:
            counted = points[:, d] != out
            for i in range(0, len(x), CHUNK):
                part = x[i : i + CHUNK]
                z = np.c_[part, np.ones(len(part))] * (1 - 2 * k)  # a positive row is a negative one of the other sign
                w = np.ones(len(z)) if n is None else n[i : i + CHUNK]
                p = points[counted, :d] @ z.T
                loss = p @ w
                np.exp(-np.maximum(p, LEAST_MARGIN), out=p)
                p += 1
                loss += np.log(p) @ w
                np.reciprocal(p, out=p)
                total[k, counted, 0] += loss
                total[k, counted, 1 : d + 1] += p @ (z * w[:, None])
                p -= p * p
                total[k, counted, d + 1 :] += p @ (z[:, low] * z[:, high] * w[:, None])
        yield total

    total = sum(blocks.mapPartitions(run).collect())  # a few numbers a point and task
    return sum(np.array([[f.weights[k]] for f in fits]) * total[k, which.ravel()] for k in (0, 1))


def fit_all(df: DataFrame, features: Sequence[str], label: str, fits: Sequence[Fit], fold: str | None = None, times: str | None = None) -> np.ndarray:
    """(fit, coefficients and intercept). Labels are 0 and 1; `times` says how often a row counts."""
    blocks = _packed(df, features, label, fold, times)
    try:
        return _descend(blocks, features, fits)
    finally:
        blocks.unpersist()


def _descend(blocks: RDD, features: Sequence[str], fits: Sequence[Fit]) -> np.ndarray:
    """Newton's steps of all fits, a pass over the blocks each."""
    d = len(features) + 1
    low, high = np.triu_indices(d)
    at = np.zeros((len(fits), d))
    done, best = at.copy(), np.full(len(fits), np.inf)
    step, busy = np.zeros((len(fits), d)), np.arange(len(fits))
    lead = int(np.argsort([f.c for f in fits])[len(fits) // 2])

    def ended(i: int, row: np.ndarray) -> bool:
        """Moves fit i by the sums at its place; True when that step was its last."""
        slope, curve = row[1 : d + 1].copy(), np.zeros((d, d))
        curve[low, high] = curve[high, low] = row[d + 1 :]
        pull = np.r_[np.full(d - 1, 1 / fits[i].c), 0.0]
        loss = row[0] + 0.5 * (pull * at[i] ** 2).sum()
        if loss > best[i] + 1e-12 * abs(best[i]):  # too far: half the step
            step[i] /= 2
        else:
            best[i], done[i] = loss, at[i]
            step[i] = -np.linalg.solve(curve + np.diag(pull), slope + pull * at[i])
        at[i] = done[i] + step[i]
        return np.abs(step[i]).max() <= CLOSE * (1 + np.abs(done[i]).max())

    together = True
    for _ in range(PASSES):
        got = dict(zip(busy.tolist(), sums(blocks, features, at[busy], [fits[i] for i in busy])))
        if together:
            if not ended(lead, got.pop(lead)):
                at[:] = at[lead]
                continue
            together = False
        busy = np.array([i for i, row in got.items() if not ended(i, row)], int)
        if not len(busy):
            return at
    return done


def _scorer(names: Sequence[str], fitted: np.ndarray) -> Callable:
    """A function of the batches of a task: for BUFFER rows or more at a time, which are positive, and (fit, scores) in turn."""

    def scores(x: Sequence[np.ndarray], rows: int) -> Iterator[tuple[int, np.ndarray]]:
        for fit, row in enumerate(fitted):
            margin = np.full(rows, row[-1])
            for c, column in zip(row, x):
                margin += c * column
            with np.errstate(over="ignore"):
                yield fit, 1 / (1 + np.exp(-margin))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, Iterator[tuple[int, np.ndarray]]]]:
        kept, rows = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                kept.append(batch)
                rows += len(batch)
            if rows and (batch is None or rows >= BUFFER):
                x = [np.concatenate([b[c].to_numpy(np.float64) for b in kept]) for c in names]
                yield np.concatenate([b["__p"].to_numpy(bool) for b in kept]), scores(x, rows)
                kept, rows = [], 0

    return scored


def _edges(rows: DataFrame, scored: Callable, fits: int, ranges: int) -> list[np.ndarray]:
    """Per fit, scores that cut the rows into about `ranges` parts of equal size."""
    if ranges == 1:
        return [np.empty(0)] * fits

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for positive, scores in scored(batches):
            places = ((np.arange(SKETCH) + 0.5) * len(positive) / SKETCH).astype(int)
            yield pd.DataFrame([(fit, len(positive), np.sort(found)[places].tobytes()) for fit, found in scores], columns=["fit", "rows", "at"])

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        at = np.concatenate([np.frombuffer(b) for b in group["at"]])
        order = np.argsort(at)
        upto = np.cumsum(np.repeat(group["rows"].to_numpy(np.float64) / SKETCH, SKETCH)[order])
        cut = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges)
        return pd.DataFrame({"fit": group["fit"].iloc[:1], "edges": [np.unique(at[order[cut]]).tobytes()]})

    outlines = rows.mapInPandas(sketch, "fit int, rows long, at binary").groupBy("fit")
    found = outlines.applyInPandas(merged, "fit int, edges binary").collect()  # a row per fit
    return [np.frombuffer(r.edges) for r in sorted(found)]


def quality(df: DataFrame, features: Sequence[str], label: str, fitted: np.ndarray) -> DataFrame:
    """fit, auc, ks (4 places) of every row of fit_all over the rows that have a label; df is read three times.

    Tasks order the scores of their rows and pass them on as arrays, cut at the same places for all tasks; a task then
    counts the pairs of one range of one fit. Ranges hold about RANGE_ROWS rows, and any places give the same result.
    """
    names, y = list(features), F.col(label)
    rows = complete(df.where(y.isNotNull()), names).select(*names, (y == 1).alias("__p"))
    size = rows.agg(F.count_if("__p").alias("pos"), F.count_if(~F.col("__p")).alias("neg")).first()
    ranges = -(-(size.pos + size.neg) // RANGE_ROWS) or 1
    scored = _scorer(names, fitted)
    edges = _edges(rows, scored, len(fitted), ranges)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for positive, scores in scored(batches):
            for fit, found in scores:
                out = []
                for side in (True, False):
                    part, times = np.sort(found[positive == side]), None
                    if (part[1:] == part[:-1]).any():
                        part, times = np.unique(part, return_counts=True)
                    bounds = [0, *np.searchsorted(part, edges[fit]).tolist(), len(part)]
                    for i, (a, b) in enumerate(itertools.pairwise(bounds)):
                        if a < b:
                            out.append((fit, i, side, part[a:b].tobytes(), None if times is None else times[a:b].astype(np.int64).tobytes()))
                yield pd.DataFrame(out, columns=["fit", "range", "positive", "scores", "times"])

    def merged(blocks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Ascending scores, and how many rows lie before each and in all."""
        if not len(blocks):
            return np.empty(0), np.zeros(1, np.int64)
        found = np.concatenate([np.frombuffer(b) for b in blocks["scores"]])
        if blocks["times"].isna().all():
            return np.sort(found), np.arange(len(found) + 1)
        order = np.argsort(found)
        times = np.concatenate([np.ones(len(b) // 8, np.int64) if t is None else np.frombuffer(t, np.int64) for b, t in zip(blocks["scores"], blocks["times"])])
        return found[order], np.r_[0, np.cumsum(times[order])]

    def counted(group: pd.DataFrame) -> pd.DataFrame:
        (pos, before_pos), (neg, before_neg) = (merged(group[group["positive"] == side]) for side in (True, False))
        below, upto = before_pos[np.searchsorted(pos, neg)], before_pos[np.searchsorted(pos, neg, "right")]
        area = (np.diff(before_neg) * (before_pos[-1] - (below + upto) / 2)).sum()
        tp, fp = before_pos[-1] - before_pos[:-1], before_neg[-1] - before_neg[np.searchsorted(neg, pos)]
        widest = int(np.argmax(tp / max(size.pos, 1) - fp / max(size.neg, 1))) if len(pos) else None
        at = (0, 0) if widest is None else (tp[widest], fp[widest])
        return pd.DataFrame([(*group[["fit", "range"]].iloc[0], before_pos[-1], before_neg[-1], area, *at)], columns=["fit", "range", "pos", "neg", "area", "tp", "fp"])

    cuts = rows.mapInPandas(cut, "fit int, range int, positive boolean, scores binary, times binary")
    tasks = len(fitted) * ranges // RANGES_PER_TASK
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        cuts = cuts.repartition(tasks, "fit", "range")
    parts = cuts.groupBy("fit", "range").applyInPandas(counted, "fit int, range int, pos long, neg long, area double, tp long, fp long")
    higher = Window.partitionBy("fit").orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    placed = parts.withColumns({f"__{c}": F.coalesce(F.sum(c).over(higher), F.lit(0)) for c in ("pos", "neg")})
    share = lambda c, n: F.try_divide((F.col(f"__{n}") + F.col(c)).cast("double"), F.lit(float(size[n])))
    return placed.groupBy("fit").agg(
        F.round(F.try_divide(F.sum(F.col("area") + F.col("neg").cast("double") * F.col("__pos")), F.lit(float(size.pos)) * size.neg), 4).alias("auc"),
        F.round(F.greatest(F.lit(0.0), F.max(share("tp", "pos") - share("fp", "neg"))), 4).alias("ks"),
    )
