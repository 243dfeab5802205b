"""Boosted trees and forests grown side by side from counts of binned rows: one pass a level for all of them.

Features are cut into at most 32 bins, as in Spark ML, and rows of the same bins are one cell with a count per class and
part of the data. To a tree the rows of a cell are the same row, so a cell's share of a sample is one draw of how many
of its rows fall into it. A pass sums, per open node and feature, rows, weights and targets by bin inside the tasks that
hold the cells; the splits are chosen where these sums meet, and only splits come to the driver. There are never more
cells than rows; with few features there are far fewer, and passes no longer depend on the rows.

Trees are those of Spark ML: the same gain, stopping rules, weights, targets, pruning and features per node; only the
random draws are others, and cuts of features with many values come from sketches of all rows, not of 10 000.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators import boosting, logistic, metrics
from plumbline.operators.boosting import StagedTrees, Tree
from plumbline.session import shared_dir

BINS = 32
#: Quantiles a class that the cuts of a feature with more than BINS values are taken from, and their accuracy.
GRID, ACCURACY = 500, 5000
BLOCK_CELLS = 16_384
#: Nodes whose sums travel as one row.
CHUNK = 16
#: Sums of a pass (open nodes x features x blocks, 768 bytes each) up to which they meet on the driver.
DIRECT = 10_000
#: Rounds after which the sums of the trees so far are stored with the cells.
STORED_ROUNDS = 10


@dataclass(frozen=True)
class Cells:
    """Bins b0, b1, ... with the counts neg_ and pos_ of each part and the block a cell belongs to, in files of a block each."""

    frame: DataFrame
    features: list[str]
    cuts: list[list[float]]
    parts: list[str]
    positive_weight: float
    blocks: int


def _cuts(train: DataFrame, names: Sequence[str], positive_weight: float) -> list[list[float]]:
    """Per feature the values that end its bins: between all its values when they are few, else quantiles of the weights."""

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [np.empty(0) for _ in names]
        for batch in batches:
            found = [v if len(v) > BINS else np.union1d(v, batch[f].to_numpy(np.float64)) for v, f in zip(found, names)]
        for i, v in enumerate(found):
            yield pd.DataFrame({"feature": i, "v": v[: BINS + 1]})

    values = {r.feature: sorted(r.v) for r in train.mapInPandas(seen, "feature int, v double").groupBy("feature").agg(F.collect_set("v").alias("v")).collect()}  # at most BINS + 1 a task
    many = [i for i in range(len(names)) if len(values.get(i, [])) > BINS]
    marks = [(i + 0.5) / GRID for i in range(GRID)]
    classes = train.groupBy("__y").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(names[i], marks, ACCURACY).alias(f"q{i}") for i in many]).collect()  # two rows
    if any(r["__y"] is None for r in classes):
        raise ValueError("labels must be 0 or 1")
    out = []
    for i in range(len(names)):
        if i not in many:
            v = values.get(i, [])
            out.append([(a + b) / 2 for a, b in zip(v, v[1:])])
            continue
        at = np.concatenate([r[f"q{i}"] for r in classes])
        mass = np.concatenate([np.full(GRID, r.n * (positive_weight if r["__y"] else 1.0)) for r in classes])
        order = np.argsort(at, kind="stable")
        upto = np.cumsum(mass[order])
        ends = np.searchsorted(upto, upto[-1] * np.arange(1, BINS) / BINS)
        out.append(np.unique(at[order][ends]).tolist())
    return out


def _bin(x: Column, cuts: Sequence[float], first: int = 0) -> Column:
    """The number of cuts below x, by halving."""
    if not cuts:
        return F.lit(first)
    half = len(cuts) // 2
    return F.when(x <= F.lit(cuts[half]), _bin(x, cuts[:half], first)).otherwise(_bin(x, cuts[half + 1 :], first + half + 1))


def cells(df: DataFrame, features: Sequence[str], label: str, part: str, parts: Sequence[str], positive_weight: float) -> Cells:
    """Counts of the rows of df by bins, class and `part`; cuts come from the first of `parts`, the training rows."""
    names, y = list(features), F.col(label)
    rows = logistic.complete(df.where(F.col(part).isin(*parts)), names)
    rows = rows.select(*names, F.col(part).alias("__part"), F.when(y == 0, 0).when(y == 1, 1).alias("__y"), (y != 1).alias("__neg"), (y == 1).alias("__pos"))
    cuts = _cuts(rows.where(F.col("__part") == parts[0]).select(*names, "__y"), names, positive_weight)
    bins = [f"b{i}" for i in range(len(names))]
    counts = [F.count_if((F.col("__part") == p) & F.col(f"__{c}")).alias(f"{c}_{p}") for p in parts for c in ("neg", "pos")]
    binned = rows.select(*[_bin(F.col(f), c).alias(b) for f, c, b in zip(names, cuts, bins)], "__part", "__neg", "__pos")
    spark, at = df.sparkSession, shared_dir(df.sparkSession, "cells")
    grouped = binned.groupBy(*bins).agg(*counts)
    grouped.write.parquet(f"{at}/counts")
    counted = spark.read.schema(grouped.schema).parquet(f"{at}/counts")
    blocks = 1 + counted.count() // BLOCK_CELLS
    placed = counted.withColumn("block", F.pmod(F.xxhash64(*bins), F.lit(blocks)).cast("int"))
    placed.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", *bins).write.parquet(f"{at}/blocks")
    return Cells(spark.read.schema(placed.schema).parquet(f"{at}/blocks"), names, cuts, list(parts), positive_weight, blocks)


@dataclass(frozen=True)
class Fit:
    """Parameters as in model.fit_forest and model.fit_boosted; no share of features: the root of their number."""

    kind: str
    trees: int
    depth: int = 6
    subsample: float = 0.8
    min_rows: int = 1
    seed: int = 42
    rate: float = 0.05
    feature_share: float | None = None

    def features_of(self, many: int, tree: int, node: int) -> np.ndarray:
        n = math.ceil(math.sqrt(many)) if self.feature_share is None else math.ceil(self.feature_share * many)
        return np.sort(np.random.default_rng([self.seed, 1, tree, node]).permutation(many)[:n])

    def drawn(self, counts: np.ndarray, tree: int, block: int) -> np.ndarray:
        """How many rows of each cell and class are in the sample of a tree."""
        rng = np.random.default_rng([self.seed, 0, tree, block])
        if self.kind == "random_forest":
            return rng.poisson(counts * self.subsample)
        return rng.binomial(counts, self.subsample) if self.subsample < 1 else counts


@dataclass
class Split:
    """How a node is split and the values of both sides; feature -1: not at all."""

    node: int
    feature: int = -1
    cut: int = 0
    low: float = 0.0
    high: float = 0.0
    value: float = 0.0


@dataclass
class Growing:
    """A tree under way, over bins; `open` are the nodes of the level, feature -1 marks a leaf."""

    fit: Fit
    number: int
    nodes: list[list] = field(default_factory=lambda: [[-1, 0.0, 0, 0, 0.0]])
    open: list[int] = field(default_factory=lambda: [0])
    level: int = 0

    def tree(self) -> Tree:
        return Tree(*map(np.array, zip(*self.nodes)), self.level)

    def take(self, splits: Sequence[Split]) -> None:
        self.open = []
        for r in sorted(splits, key=lambda s: s.node):
            at = self.nodes[r.node]
            at[4] = r.value
            if r.feature >= 0:
                n = len(self.nodes)
                at[:4] = [r.feature, float(r.cut), n, n + 1]
                self.nodes += [[-1, 0.0, n, n, r.low], [-1, 0.0, n + 1, n + 1, r.high]]
                self.open += [n, n + 1]
        self.level += 1
        if self.level >= self.fit.depth:
            self.open = []

    def pruned(self) -> Tree:
        """Leaves of one parent that vote for the same class are one leaf."""
        for at in reversed(self.nodes):
            if at[0] >= 0:
                low, high = self.nodes[at[2]], self.nodes[at[3]]
                if low[0] < 0 and high[0] < 0 and (low[4] > 0.5) == (high[4] > 0.5):
                    at[0], at[2], at[3] = -1, self.nodes.index(at), self.nodes.index(at)
        return self.tree()


def _blocks(batches: Iterator[pd.DataFrame], many: int) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    rows = [*batches]
    if rows:
        for block, part in pd.concat(rows).groupby("block"):
            yield int(block), part, part[[f"b{i}" for i in range(many)]].to_numpy(np.int64)


@dataclass
class Block:
    """The cells of a block as arrays, with the sums of the trees stored so far per run."""

    number: int
    x: np.ndarray
    counts: dict[str, np.ndarray]
    sums: dict[int, np.ndarray] = field(default_factory=dict)

    def margin(self, run: int, since: Sequence[tuple[float, Tree]]) -> np.ndarray:
        total = self.sums[run].copy() if run in self.sums else np.zeros(len(self.x))
        for weight, tree in since:
            total += weight * tree(self.x)
        return total


def _placed(data: Cells) -> RDD:
    """The blocks of the cells, kept by the tasks that hold them from pass to pass."""
    many, names = len(data.features), [f"{c}_{p}" for p in data.parts for c in ("neg", "pos")]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, rows, x in _blocks(batches, many):
            yield pd.DataFrame({"cells": [pickle.dumps(Block(block, x, {c: rows[c].to_numpy() for c in names}))]})

    return data.frame.mapInPandas(pack, "cells binary").rdd.map(lambda r: pickle.loads(r.cells)).persist(StorageLevel.MEMORY_AND_DISK)


def _level(data: Cells, blocks: RDD, growing: Sequence[Growing | None], since: Sequence[Sequence[tuple[float, Tree]]] | None = None) -> dict[int, list[Split]]:
    """The splits of the open nodes of each tree under way. With `since`, the trees of each boosted run after those stored
    in the blocks, targets are the residuals, and a node -1 has the loss on the second part as its value."""
    many, heavy, (train, *held) = len(data.features), data.positive_weight, data.parts
    jobs = [None if g is None else (g.fit, g.number, g.tree(), np.array(g.open, int)) for g in growing]
    level = max((g.level for g in growing if g is not None), default=0)

    def run(block: Block) -> Iterator[tuple[tuple[int, int], tuple[int, np.ndarray]]]:
        x, counts = block.x, block.counts
        neg, pos = counts[f"neg_{train}"], counts[f"pos_{train}"]
        for job, what in enumerate(jobs):
            low, high = 0.0, 1.0
            if since is not None:
                margin = block.margin(job, since[job])
                if level == 0:
                    n, p = counts[f"neg_{held[0]}"], counts[f"pos_{held[0]}"] * heavy
                    yield (job, -1), (block.number, np.array([n @ np.logaddexp(0, 2 * margin) + p @ np.logaddexp(0, -2 * margin), (n + p).sum()]))
                first = what is not None and what[1] == 0
                low, high = (-1.0, 1.0) if first else (-4 / (1 + np.exp(-2 * margin)), 4 / (1 + np.exp(2 * margin)))
            if what is None or not len(what[3]):
                continue
            fit, number, tree, active = what
            n, p = fit.drawn(np.stack([neg, pos]), number, block.number)
            place = np.full(len(tree.feature), -1)
            place[active] = np.arange(len(active))
            node = place[tree.leaf(x)]
            kept = (node >= 0) & (n + p > 0)
            node, inside = node[kept] * BINS, x[kept]
            sums = [v[kept] for v in (n + p, n + heavy * p, n * low + heavy * p * high)]
            of = np.array([fit.features_of(many, number, a) for a in active.tolist()])
            full = np.empty((len(active), many, BINS, 3))
            for f in range(many):
                at = node + inside[:, f]
                for i, v in enumerate(sums):
                    full[:, f, :, i] = np.bincount(at, v, len(active) * BINS).reshape(-1, BINS)
            mine = full[np.arange(len(active))[:, None], of]
            for i in range(0, len(active), CHUNK):
                yield (job, i // CHUNK), (block.number, mine[i : i + CHUNK])

    def choose(of: tuple) -> list[tuple[int, Split]]:
        (job, chunk), each = of
        total = sum(v for _, v in sorted(each, key=lambda e: e[0]))
        if chunk < 0:
            return [(job, Split(-1, value=float(total[0] / total[1]) if total[1] else math.nan))]
        fit, number, _, active = jobs[job]
        found = []
        for node, sums in zip(active[chunk * CHUNK :].tolist(), total):
            all_, left = sums[0].sum(0), np.cumsum(sums, 1)[:, :-1]
            right = all_ - left
            fits = (left[..., 0] >= fit.min_rows) & (right[..., 0] >= fit.min_rows)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(fits, left[..., 2] ** 2 / left[..., 1] + right[..., 2] ** 2 / right[..., 1] - all_[2] ** 2 / all_[1], -np.inf)
            f, cut = np.unravel_index(np.argmax(gain), gain.shape)
            split = Split(node, value=float(all_[2] / all_[1]) if all_[1] else 0.0)
            if gain[f, cut] > 1e-12 * all_[1]:
                split.feature, split.cut = int(fit.features_of(many, number, node)[f]), int(cut)
                split.low, split.high = (float(side[f, cut, 2] / side[f, cut, 1]) for side in (left, right))
            found.append((job, split))
        return found

    nodes = sum(len(g.open) for g in growing if g is not None)
    pairs, out = blocks.flatMap(run), {}
    if nodes * many * data.blocks <= DIRECT:  # a second stage would take longer than the sums
        each: dict[tuple[int, int], list] = {}
        for key, sums in pairs.collect():
            each.setdefault(key, []).append(sums)
        chosen = [found for item in each.items() for found in choose(item)]
    else:
        chosen = pairs.groupByKey(1 + nodes // 1024).flatMap(choose).collect()  # a row per open node
    for job, split in chosen:
        out.setdefault(job, []).append(split)
    return out


def _named(data: Cells, tree: Tree) -> Tree:
    """A tree over bins as a tree over values."""
    ends = [data.cuts[f][int(c)] if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.threshold)]
    return Tree(tree.feature, np.array(ends), tree.left, tree.right, tree.value, tree.depth)


@dataclass(frozen=True)
class Grown:
    """The trees of one fit over bins; `patience` says how many of them count."""

    fit: Fit
    trees: list[Tree]
    losses: tuple[float, ...] = ()
    patience: int | None = None

    def weights(self) -> list[float]:
        if self.fit.kind == "random_forest":
            return [1 / len(self.trees)] * len(self.trees)
        return [1.0] + [self.fit.rate] * (len(self.trees) - 1)

    def model(self, data: Cells) -> StagedTrees:
        """The model over values, for rows that are not in cells."""
        return StagedTrees([_named(data, t) for t in self.trees], self.weights(), data.features, len(self.trees), self.fit.kind == "random_forest")

    def cut(self, rounds: int) -> "Grown":
        return Grown(self.fit, self.trees[:rounds], self.losses[:rounds])

    def counted(self) -> "Grown":
        """The prefix of least loss before patience ran out."""
        if self.patience is None or not self.losses or math.isnan(self.losses[0]):
            return self
        return self.cut(boosting.stopping_round(self.losses, self.patience))


def forests(data: Cells, fits: Sequence[Fit], grown: Sequence[Grown | None] = ()) -> list[Grown]:
    """A forest per fit; the trees of `grown`, forests of the same parameters with fewer trees, are kept."""
    kept = [list(g.trees) if g else [] for g in grown] or [[] for _ in fits]
    work = [[Growing(f, n) for n in range(len(k), f.trees)] for f, k in zip(fits, kept)]
    left, blocks = [g for some in work for g in some], _placed(data)
    while left:
        for job, splits in _level(data, blocks, left).items():
            left[job].take(splits)
        left = [g for g in left if g.open]
    blocks.unpersist()
    return [Grown(f, k + [g.pruned() for g in some]) for f, k, some in zip(fits, kept, work)]


def boosted(data: Cells, fits: Sequence[Fit], patience: int | None = boosting.PATIENCE, grown: Sequence[Grown | None] = ()) -> list[Grown]:
    """Boosted trees per fit, with the loss of each prefix on the second part; a fit ends when `patience` rounds brought
    nothing better, as later rounds then change nothing. Rounds of `grown`, fits of fewer rounds, are kept."""
    trees = [list(g.trees) if g else [] for g in grown] or [[] for _ in fits]
    losses: list[list[float]] = [list(g.losses) if g else [] for g in grown] or [[] for _ in fits]
    blocks, stored = _placed(data), [0] * len(fits)

    def since() -> list[list[tuple[float, Tree]]]:
        return [list(zip(Grown(f, t).weights(), t))[n:] for f, t, n in zip(fits, trees, stored)]

    def over(i: int) -> bool:
        return patience is not None and bool(losses[i]) and len(losses[i]) - 1 - int(np.argmin(losses[i])) >= patience

    while busy := [i for i, f in enumerate(fits) if not over(i) and len(losses[i]) < f.trees]:
        if max(len(trees[i]) - stored[i] for i in busy) >= STORED_ROUNDS:
            blocks, stored = _stored(blocks, since()), [len(t) for t in trees]
        current = {i: Growing(fits[i], len(trees[i])) for i in busy if len(trees[i]) < fits[i].trees}
        first = True
        while first or any(g.open for g in current.values()):
            found = _level(data, blocks, [current.get(i) for i in range(len(fits))], since())
            for i in busy if first else ():
                if len(losses[i]) < len(trees[i]):
                    losses[i].append(next(s.value for s in found[i] if s.node < 0))
                    if over(i):
                        current.pop(i, None)
            for i, g in current.items():
                if g.open:
                    g.take([s for s in found[i] if s.node >= 0])
            first = False
        for i, g in current.items():
            trees[i].append(g.tree())
    blocks.unpersist()
    return [Grown(f, t, tuple(x), patience) for f, t, x in zip(fits, trees, losses)]


def _stored(blocks: RDD, since: Sequence[Sequence[tuple[float, Tree]]]) -> RDD:
    """The blocks with the sums of the trees so far, per run."""

    def add(b: Block) -> Block:
        return Block(b.number, b.x, b.counts, {i: b.margin(i, s) for i, s in enumerate(since)})

    out = blocks.map(add).persist(StorageLevel.MEMORY_AND_DISK)
    out.foreach(lambda _: None)
    blocks.unpersist()
    return out


def histograms(data: Cells, models: dict[int, Grown], parts: Sequence[str]) -> DataFrame:
    """model, part, score, pos, neg: what the scores of all rows of the parts count."""
    many = len(data.features)
    scored = {k: g.model(data) for k, g in models.items()}
    coded = {k: (list(zip(s.weights, g.trees)), s) for (k, g), s in zip(models.items(), scored.values())}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, rows, x in _blocks(batches, many):
            for k, (trees, model) in coded.items():
                total = np.zeros(len(x))
                for weight, tree in trees:
                    total += weight * tree(x)
                for p in parts:
                    out = pd.DataFrame({"model": k, "part": p, "score": model.link(total), "pos": rows[f"pos_{p}"].to_numpy(), "neg": rows[f"neg_{p}"].to_numpy()})
                    yield out[(out["pos"] > 0) | (out["neg"] > 0)].groupby(["model", "part", "score"], as_index=False).sum()

    rows = data.frame.mapInPandas(run, "model int, part string, score double, pos long, neg long")
    return rows.groupBy("model", "part", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def quality(data: Cells, models: dict[int, Grown], parts: Sequence[str], digits: int = 4) -> DataFrame:
    """model, part, auc, ks, gini, pr_auc."""
    by = ["model", "part"]
    out = metrics.raw_metrics(metrics.score_curve(histograms(data, models, parts), by), by)
    return out.select(*by, *[F.round(m, digits).alias(m) for m in ("auc", "ks", "gini", "pr_auc")])
