"""Best-fit packing by patterns: non-negative least squares on the length histogram.

Documents become token ids and an end id. Patterns of two and three lengths that fill a sequence
exactly are enumerated, repeat counts are fitted to the histogram by non-negative least squares and
rounded to what the histogram has, and the lengths left over are packed best-fit decreasing by
counts. All of that works on one count per length. Pieces take their place by their rank within
their length, so no row but the counts reaches the driver.

Null text is empty and packs its end id; repeated rows are packed as often as they occur; a null
doc_id is kept. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import numbered, ready, saved, slices, unnumbered
from plumbline.llm.tokens import encoder

Pattern = tuple[tuple[int, ...], int]

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: one, or full ones after a shorter first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    bounds = ([0] if first else []) + list(range(first, n + 1, capacity))
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document, with the checksum of its ids and on request the ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for frame in slices(batch, "text"):
                rows = []
                for doc_id, text in zip(frame["doc_id"], frame["text"]):
                    ids = memoryview(encode(text) + end)
                    for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + length)]
                        rows.append((doc_id, i, start, length, zlib.crc32(part), bytes(part) if with_ids else None))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
                yield out if with_ids else out.drop(columns="ids")

    ready(docs.sparkSession)
    return unnumbered(docs.select(numbered(), "text").mapInPandas(run, PIECES + (", ids binary" if with_ids else "")))


def patterns(counts: np.ndarray) -> np.ndarray:
    """All patterns of two or three present lengths that sum to the capacity; 0 fills a pair."""
    capacity = len(counts) - 1
    here = counts > 0
    a = np.arange(1, capacity)
    pairs = np.stack([a, capacity - a, np.zeros_like(a)], 1)[a >= capacity - a]
    found = [pairs[here[pairs[:, 0]] & here[pairs[:, 1]]]]
    for first in np.flatnonzero(here[:-1]):
        rest = capacity - first
        b = np.arange((rest + 1) // 2, min(first, rest - 1) + 1)
        b = b[here[b] & here[rest - b]] if len(b) else b
        found.append(np.stack([np.full_like(b, first), b, rest - b], 1))
    return np.concatenate(found)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 120) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - counts|, by multiplicative updates."""
    if not len(patterns):
        return np.zeros(0)
    want = counts.astype(float)
    want[0] = 0.0

    def made(x: np.ndarray) -> np.ndarray:
        out = np.bincount(patterns.ravel(), np.repeat(x, patterns.shape[1]), len(counts))
        out[0] = 0.0
        return out

    def back(y: np.ndarray) -> np.ndarray:
        return y[patterns].sum(1)

    goal = back(want)
    x = want[patterns].max(1) / len(patterns) + 1e-3
    for _ in range(rounds):
        x *= goal / np.maximum(back(made(x)), 1e-12)
    return x


def rounded(patterns: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[Pattern]:
    """Whole repeats, the best fitted first, never more than the lengths left; updates left."""
    plan: list[Pattern] = []
    for share in (np.floor, np.ceil):
        for i in np.argsort(-x, kind="stable"):
            if share(x[i]) < 1 or x[i] < 0.05:
                continue
            lengths = tuple(int(v) for v in patterns[i] if v)
            need = {v: lengths.count(v) for v in lengths}
            repeats = int(min(share(x[i]), min(left[v] // k for v, k in need.items())))
            if repeats > 0:
                plan.append((lengths, repeats))
                for v, k in need.items():
                    left[v] -= repeats * k
        x = x - np.floor(x)
    return plan


def best_fit(left: np.ndarray) -> list[Pattern]:
    """Best-fit decreasing over counts: sequences filled alike are kept as one entry."""
    capacity = len(left) - 1
    open_: dict[int, list[Pattern]] = {}

    def put(space: int, lengths: tuple[int, ...], repeats: int) -> None:
        open_.setdefault(space, []).append((lengths, repeats))

    for length in range(capacity, 0, -1):
        c = int(left[length])
        while c:
            space = min((s for s in open_ if s >= length), default=None)
            lengths, repeats = open_[space].pop() if space is not None else ((), c)
            space = capacity if space is None else space
            if not open_.get(space, True):
                del open_[space]
            each = min(space // length, c)
            used = min(repeats, c // each)
            put(space - each * length, lengths + (length,) * each, used)
            if lengths and repeats > used:
                put(space, lengths, repeats - used)
            c -= used * each
    return [p for group in open_.values() for p in group]


def plan(counts: np.ndarray) -> list[Pattern]:
    """Patterns with their repeats that place every length of counts (index: length) once."""
    left = counts.astype(np.int64).copy()
    chosen: list[Pattern] = [((len(counts) - 1,), int(left[-1]))] if left[-1] else []
    left[-1] = 0
    kinds = patterns(left)
    chosen += rounded(kinds, fit(kinds, left), left)
    return chosen + best_fit(left)


def slots(chosen: list[Pattern], capacity: int) -> pd.DataFrame:
    """Where each rank of a length goes: from rank `first` on, sequence base + (rank - first)."""
    rows, taken, base = [], [0] * (capacity + 1), 0
    for lengths, repeats in chosen:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], base, offset))
            taken[length] += repeats
            offset += length
        base += repeats
    return pd.DataFrame(rows, columns=["length", "first", "base", "offset"]).astype("int64").sort_values(["length", "first"])


def pack(parts: DataFrame, capacity: int = 2048, rows_per_slice: int = 200_000) -> DataFrame:
    """parts (with a length, 1 to capacity) and the sequence_id and offset of each row.

    The rank within a length is counted in slices by hash, so a length that a third of all rows have
    is spread over many tasks; the number of slices follows the rows.
    """
    columns = parts.columns
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in parts.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    place = slots(plan(counts), capacity)
    key = (place["length"].to_numpy() << 44) + place["first"].to_numpy()
    base, offset, first = (place[c].to_numpy() for c in ("base", "offset", "first"))

    cut_in = max(1, int(counts.sum()) // rows_per_slice)
    sliced = parts.withColumn("_slice", F.pmod(F.xxhash64(*columns), F.lit(cut_in)))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy("length", "_slice").count().select("length", "_slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_slice").orderBy(*columns)
    ranked = sliced.withColumn("_rank", F.row_number().over(within)).join(starts, ["length", "_slice"])
    ranked = ranked.select(*columns, (F.col("_rank") - 1 + F.col("_before")).alias("_rank"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rank = frame.pop("_rank").to_numpy(dtype=np.int64)
            at = np.searchsorted(key, (frame["length"].to_numpy(dtype=np.int64) << 44) + rank, side="right") - 1
            yield frame.assign(sequence_id=base[at] + rank - first[at], offset=offset[at])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    if "doc_id" not in columns:
        return ranked.mapInPandas(run, f"{schema}, sequence_id long, offset long")
    ranked = ranked.withColumn("doc_id", numbered())
    return unnumbered(ranked.mapInPandas(run, f"{schema}, sequence_id long, offset long"))


def packed(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Every piece of every document with its place."""
    return pack(saved(pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids as little-endian 32-bit binary, doc_ids."""
    whole = pieces(docs, tokenizer, capacity, end_id, with_ids=True)
    place = pack(saved(whole, "pieces"), capacity)
    each = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))  # at most `capacity` pieces
    return place.groupBy("sequence_id").agg(each.alias("p")).select(
        "sequence_id",
        F.aggregate("p.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"),
    )
