"""Exact quantiles by narrowing: no sort, no shuffle of the data, no value map of a whole column.

A sketch proposes two values around each wanted rank. One pass counts the rows at and between
these pivots, which proves where every rank lies: on a pivot, or strictly between two of them.
What is between is narrowed again until it holds few rows, which are then read off. Three scans
answer billions of rows; wrong sketches cost scans, never correctness.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEW_ROWS = 50_000
ACCURACY = 10_000
MARGIN = 2.0 / ACCURACY
PIVOTS_PER_BATCH = 48


@dataclass
class _Gap:
    """The rows of a column strictly between two pivots: `before` rows are lower, `inside` are here."""

    column: str
    code: int
    before: int
    inside: int
    low: float | None
    high: float | None
    ranks: list[int]

    def holds(self) -> Column:
        c = F.col(self.column)
        kept = c.isNotNull()
        if self.low is not None:
            kept = kept & (c > F.lit(self.low))
        if self.high is not None:
            kept = kept & (c < F.lit(self.high))
        return kept


def quantiles(
    df: DataFrame, wanted: dict[str, Sequence[float]], few_rows: int = FEW_ROWS
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles {column: [share, ...]} -> {column: [value, ...]}; NULLs are skipped."""
    if not wanted:
        return {}
    df = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    first = df.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(wanted)],
        *[_sketch(F.col(c), p).alias(f"s{i}") for i, (c, p) in enumerate(wanted.items())],
    ).first()
    sizes = {c: first[f"n{i}"] for i, c in enumerate(wanted)}
    open_ranks = {c: {r for p in shares for r in _neighbours(p, sizes[c])} for c, shares in wanted.items() if sizes[c]}
    pivots = {c: sorted(set(first[f"s{i}"])) for i, c in enumerate(wanted) if sizes[c]}
    found: dict[tuple[str, int], float] = {}
    while open_ranks:
        gaps = _locate(df, pivots, open_ranks, found)
        few = [g for g in gaps if g.inside <= few_rows]
        many = [g for g in gaps if g.inside > few_rows]
        if few:
            _read_off(df, pivots, few, found)
        open_ranks = {}
        for g in many:
            open_ranks.setdefault(g.column, set()).update(g.ranks)
        if many:
            _propose(df, pivots, many)
    return {c: [_interpolate(found, c, p, sizes[c]) for p in shares] for c, shares in wanted.items()}


def _neighbours(p: float, n: int) -> tuple[int, int]:
    at = p * (n - 1)
    return math.floor(at), math.ceil(at)


def _interpolate(found, column: str, p: float, n: int) -> float | None:
    if n == 0:
        return None
    lower, upper = _neighbours(p, n)
    a, b = found[column, lower], found[column, upper]
    return a + (b - a) * (p * (n - 1) - lower)


def _sketch(value: Column, shares: Sequence[float]) -> Column:
    around = [min(1.0, max(0.0, p + side)) for p in shares for side in (-MARGIN, MARGIN)]
    return F.percentile_approx(value, F.array(*[F.lit(float(p)) for p in around]), ACCURACY)


def _propose(df: DataFrame, pivots: dict[str, list[float]], gaps: list[_Gap]) -> None:
    """New pivots around every open rank, from one sketch per gap."""
    picks = [
        _sketch(F.when(g.holds(), F.col(g.column)), [(r - g.before) / g.inside for r in g.ranks]).alias(f"s{i}")
        for i, g in enumerate(gaps)
    ]
    row = df.agg(*picks).first()
    for i, g in enumerate(gaps):
        pivots[g.column] = sorted({*pivots[g.column], *row[f"s{i}"]})


def _code(column: str, pivots: list[float]) -> Column:
    """2k below pivot k and above the one before it, 2k + 1 on pivot k."""
    c = F.col(column)

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        middle = (low + high) // 2
        edge = F.lit(pivots[middle])
        return F.when(c < edge, tree(low, middle)).when(c == edge, 2 * middle + 1).otherwise(tree(middle + 1, high))

    return F.when(c.isNotNull(), tree(0, len(pivots)))


def _coded(df: DataFrame, pivots: dict[str, list[float]], columns: Sequence[str]) -> DataFrame:
    """(column, code, value) rows of the named columns.

    Columns go in batches, each reading only its own: the comparisons of one batch stay a method
    the JVM compiles.
    """
    batches: list[list[str]] = [[]]
    for c in columns:
        if batches[-1] and sum(len(pivots[x]) for x in [*batches[-1], c]) > PIVOTS_PER_BATCH:
            batches.append([])
        batches[-1].append(c)
    out = None
    for batch in batches:
        parts = [
            F.struct(F.lit(c).alias("column"), _code(c, pivots[c]).alias("code"), F.col(c).alias("value")) for c in batch
        ]
        one = df.select(F.inline(F.array(*parts)))
        out = one if out is None else out.unionAll(one)
    return out


def _locate(df, pivots, open_ranks, found) -> list[_Gap]:
    """Settle every open rank that falls on a pivot; return the gaps that hold the others."""
    coded = _coded(df, pivots, list(open_ranks)).where(F.col("code").isNotNull())
    counts = {(r.column, r.code): r.rows for r in coded.groupBy("column", "code").agg(F.count(F.lit(1)).alias("rows")).collect()}
    gaps = []
    for c, ranks in open_ranks.items():
        waiting = sorted(ranks)
        before = 0
        for code in range(2 * len(pivots[c]) + 1):
            rows = counts.get((c, code), 0)
            here = [r for r in waiting if before <= r < before + rows]
            k = code // 2
            if here and code % 2:
                found.update({(c, r): pivots[c][k] for r in here})
            elif here:
                low = pivots[c][k - 1] if k > 0 else None
                high = pivots[c][k] if k < len(pivots[c]) else None
                gaps.append(_Gap(c, code, before, rows, low, high, here))
            before += rows
    return gaps


def _read_off(df, pivots, gaps: list[_Gap], found) -> None:
    """Gaps with few rows: the discrete percentiles that fall on the ranks."""
    inside = {c: [g.code for g in gaps if g.column == c] for c in {g.column for g in gaps}}
    coded = _coded(df, pivots, list(inside))
    kept = None
    for c, codes in inside.items():
        one = (F.col("column") == c) & F.col("code").isin(codes)
        kept = one if kept is None else kept | one
    rows = coded.where(kept)
    rows = rows.select(
        *[
            F.when((F.col("column") == g.column) & (F.col("code") == g.code), F.col("value")).alias(f"x{i}")
            for i, g in enumerate(gaps)
        ]
    )
    picks = []
    for i, g in enumerate(gaps):
        shares = ", ".join(f"{(r - g.before + 0.5) / g.inside!r}D" for r in g.ranks)
        picks.append(F.expr(f"percentile_disc(array({shares})) WITHIN GROUP (ORDER BY x{i})").alias(f"v{i}"))
    row = rows.agg(*picks).first()
    for i, g in enumerate(gaps):
        found.update({(g.column, r): v for r, v in zip(g.ranks, row[f"v{i}"])})
