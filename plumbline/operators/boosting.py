"""Boosted trees by stages: every prefix of one fitted model, scored in one pass.

The first n trees of a model of more rounds are the model of n rounds, so the number of rounds and the
patience of early stopping are decided after one fit. Losses of all prefixes are summed in the tasks
that score the rows; what is shuffled is a row per prefix and task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators import metrics

PATIENCE = 20  # fixed value
SPLIT = re.compile(r"If \(feature (\d+) <= (.+)\)")


@dataclass(frozen=True)
class Tree:
    """Nodes in preorder; a leaf has feature -1 and its own place as both children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def leaf(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return at

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.leaf(x)]


def read_tree(text: str) -> Tree:
    """A tree from its printed form (numeric splits)."""
    nodes: list[list] = []
    lines = iter(line.strip() for line in text.splitlines()[1:] if line.strip())

    def node() -> tuple[int, int]:
        at, line = len(nodes), next(lines)
        nodes.append([-1, 0.0, at, at, 0.0])
        if line.startswith("Predict:"):
            nodes[at][4] = float(line.split(":", 1)[1])
            return at, 0
        found = SPLIT.fullmatch(line)
        if not found:
            raise ValueError(f"not a numeric split: {line}")
        nodes[at][0], nodes[at][1] = int(found[1]), float(found[2])
        nodes[at][2], a = node()
        next(lines)  # Else
        nodes[at][3], b = node()
        return at, 1 + max(a, b)

    _, depth = node()
    feature, threshold, left, right, value = zip(*nodes)
    return Tree(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), depth)


@dataclass(frozen=True)
class StagedTrees:
    """The trees of a boosted model with their weights; `rounds` of them count. Trees of a forest vote chances."""

    trees: list[Tree]
    weights: list[float]
    features: list[str]
    rounds: int
    votes: bool = False

    def link(self, total: np.ndarray) -> np.ndarray:
        return total if self.votes else chance(total)

    def margins(self, x: np.ndarray, rounds: int) -> np.ndarray:
        """(row, prefix): the sum over the first 1, 2, ... trees."""
        return np.cumsum(np.stack([w * t(x) for t, w in zip(self.trees[:rounds], self.weights)], 1), 1)

    def cut(self, rounds: int) -> "StagedTrees":
        return StagedTrees(self.trees, self.weights, self.features, rounds, self.votes)

    def probability(self) -> Column:
        """The score of a row by the first `rounds` trees; also on streams."""
        rounds, link = self.rounds, self.link

        @F.pandas_udf("double")
        def score(columns: pd.DataFrame) -> pd.Series:
            x = columns.to_numpy(np.float64)
            total = np.zeros(len(x))
            for tree, weight in zip(self.trees[:rounds], self.weights):
                total += weight * tree(x)
            return pd.Series(link(total))

        return score(F.struct(*[F.col(f).cast("double").alias(f) for f in self.features]))


def chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-2 * margin))


def staged(model: GBTClassificationModel, features: Sequence[str]) -> StagedTrees:
    trees = [read_tree(t.toDebugString) for t in model.trees]
    return StagedTrees(trees, list(model.treeWeights), list(features), len(trees))


def prefix_losses(df: DataFrame, model: StagedTrees, label: str, positive_weight: float = 1.0) -> DataFrame:
    """rounds, loss: the weighted mean logistic loss of each prefix, in one pass over df."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, weight = np.zeros(model.rounds), 0.0
        for batch in batches:
            y = batch["__y"].to_numpy(np.float64)
            w = np.where(y == 1, positive_weight, 1.0)
            margin = model.margins(batch[model.features].to_numpy(np.float64), model.rounds)
            total += w @ np.logaddexp(0, -2 * margin * (2 * y - 1)[:, None])
            weight += w.sum()
        yield pd.DataFrame({"rounds": np.arange(1, model.rounds + 1), "total": total, "weight": weight})

    rows = df.where(F.col(label).isNotNull()).select(*[F.col(f).cast("double").alias(f) for f in model.features], F.col(label).cast("int").alias("__y"))
    sums = rows.mapInPandas(run, "rounds int, total double, weight double").groupBy("rounds").agg(F.sum("total").alias("t"), F.sum("weight").alias("w"))
    return sums.select("rounds", (F.col("t") / F.nullif("w", F.lit(0.0))).alias("loss"))


def stopping_round(losses: Sequence[float], patience: int = PATIENCE) -> int:
    """The round (from 1) of least loss before `patience` rounds brought nothing better."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def stop_early(model: StagedTrees, validation: DataFrame, label: str, positive_weight: float = 1.0, patience: int = PATIENCE) -> StagedTrees:
    rows = prefix_losses(validation, model, label, positive_weight).orderBy("rounds").collect()  # a row per round
    if not rows or rows[0]["loss"] is None:
        return model
    return model.cut(stopping_round([r["loss"] for r in rows], patience))


def prefix_quality(df: DataFrame, model: StagedTrees, label: str, rounds: Sequence[int]) -> DataFrame:
    """rounds, auc, ks, gini, pr_auc of the chosen prefixes, from one pass over df."""
    chosen = sorted(set(rounds))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = chance(model.margins(batch[model.features].to_numpy(np.float64), chosen[-1])[:, np.array(chosen) - 1])
            yield pd.DataFrame({"rounds": np.tile(chosen, len(batch)), "y": np.repeat(batch["__y"].to_numpy(), len(chosen)), "p": p.ravel()})

    rows = df.where(F.col(label).isNotNull()).select(*[F.col(f).cast("double").alias(f) for f in model.features], F.col(label).cast("int").alias("__y"))
    return metrics.metric_bundle(rows.mapInPandas(run, "rounds int, y int, p double"), "y", "p", ["rounds"])


def rungs(trials: int, least: int, most: int, factor: int = 3) -> list[tuple[int, int]]:
    """(trials left, rounds) per rung: a `factor` of the trials goes on with `factor` times the rounds,
    and the last rung trains what is left in full."""
    out, left, rounds = [], trials, least
    while left > 1 and rounds < most:
        out.append((left, rounds))
        left, rounds = max(1, math.ceil(left / factor)), rounds * factor
    return [*out, (left, most)]

