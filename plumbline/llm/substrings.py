"""Repeated passages by level-wise doubling of word windows.

Words are runs of anything but space and U+0009 to U+000D. A window is `size` consecutive words.

1. Documents with equal words become one class; a copy with a larger doc_id is covered by windows
   wholly (or, with fewer words than a window, not at all).
2. The lengths rise from `start` words to the full size, each at most twice the one before. At a length,
   each full window names one shorter window: the one of least hash among those inside it, leftmost
   first. Equal windows name equal ones, so it is enough to look for names that two documents hold.
3. Full windows whose name is repeated, and only those, go on to twice the length, where they name
   again, until the name is the window itself or no candidates survive. `longest` goes on doubling
   beyond the full size where both halves are repeated.

Every level is a grouped minimum and maximum of doc_id with partial aggregation, and a join back that
adaptive execution may split. Texts move only for documents with candidates.

A null text has no words. Rows with one doc_id are not earlier than each other. A row without doc_id
is kept whole and is nobody's source. An empty table gives no rows. Columns other than doc_id and text
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from plumbline.llm import words
from plumbline.llm.common import numbered, ready, saved, slices, unnumbered

OTHER = np.uint64(0xD6E8FEB86659FD93)
NOTHING = hashlib.sha256(b"").hexdigest()
#: The first length tried is at most this many words.
START = 13
#: Characters of text that a task holds at a time, or one text if it is longer.
CHARS = 1_000_000
HIT = "h long, g int, doc_id long, t int, start int"


def lengths(size: int, start: int) -> list[int]:
    """The lengths below size, each at most twice the one before, the first at most start."""
    out = [size]
    while out[0] > 1 and (len(out) == 1 or out[0] > start):
        out.insert(0, (out[0] + 1) // 2)
    return out[:-1]


def named(short: np.ndarray, size: int, step: int) -> np.ndarray:
    """For each window of `size` words, the place of the window of `step` words that it names.

    Least places of 2, 4, 8 ... neighbours, the last two overlapping, so memory is linear in the text.
    """
    inside = size - step + 1
    if len(short) < inside:
        return np.empty(0, np.int64)
    best, width = np.arange(len(short)), 1
    while width < inside:
        move = min(width, inside - width)
        a, b = best[:-move], best[move:]
        best = np.where(short[b] < short[a], b, a)
        width += move
    return best


def doubled(half: np.ndarray, starts: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits for the windows at starts, from their first and last half."""
    a, b = half[starts], half[starts + size - step]
    return words.mix(a * words.BASE + b).view(np.int64), (words.mix(a * OTHER + (b ^ words.BASE)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def outlines(docs: DataFrame, size: int, step: int) -> DataFrame:
    """doc_id, t (hash of the text), n_words, key (of the words), sha256 (of the words), names of `step` words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, "text", CHARS):
                rows = []
                for doc_id, t, text in zip(frame["doc_id"], frame["t"], frame["text"]):
                    own = words.split(text)
                    short = words.windows(words.hashed(own), step)
                    names = np.unique(short[np.unique(named(short, size, step))])
                    joined = b" ".join(own)
                    rows.append((doc_id, t, len(own), xxh3_128_digest(joined), hashlib.sha256(joined).hexdigest(), names.view(np.int64)))
                yield pd.DataFrame(rows, columns=["doc_id", "t", "n_words", "key", "sha256", "names"])

    rows = docs.select(numbered(), F.hash("text").alias("t"), "text")
    return unnumbered(rows.mapInPandas(run, "doc_id long, t int, n_words long, key binary, sha256 string, names array<long>"))


def surviving(text: str, found: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, starts of the windows of `size` words whose name of `step` words is among the found)."""
    own = words.hashed(words.split(text))
    short = words.windows(own, step)
    repeated = np.isin(short, np.asarray(found, np.int64).view(np.uint64))
    return own, np.flatnonzero(repeated[named(short, size, step)])


def renamed(texts: DataFrame, size: int, step: int, longer: int) -> DataFrame:
    """doc_id, names of `longer` words of the windows whose name of `step` words is repeated (column found)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, "text", CHARS):
                rows = []
                for doc_id, text, found in zip(frame["doc_id"], frame["text"], frame["found"]):
                    own, starts = surviving(text, found, size, step)
                    short = words.windows(own, longer)
                    names = np.unique(short[np.unique(named(short, size, longer)[starts])])
                    if len(names):
                        rows.append((doc_id, names.view(np.int64)))
                yield pd.DataFrame(rows, columns=["doc_id", "names"])

    return texts.select("doc_id", "text", "found").mapInPandas(run, "doc_id long, names array<long>")


def extended(texts: DataFrame, size: int, step: int) -> DataFrame:
    """The windows of `size` words whose name of `step` words is among the repeated ones (column found)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, "text", CHARS):
                parts = []
                for doc_id, t, text, found in zip(frame["doc_id"], frame["t"], frame["text"], frame["found"]):
                    own, starts = surviving(text, found, size, step)
                    h, g = doubled(words.windows(own, step), starts, size, step)
                    parts.append(pd.DataFrame({"h": h, "g": g, "doc_id": doc_id, "t": t, "start": starts.astype(np.int32)}))
                yield pd.concat(parts)

    return texts.select("doc_id", "t", "text", "found").mapInPandas(run, HIT)


def grown(texts: DataFrame, size: int) -> DataFrame:
    """The windows of `size` words of which both halves are repeated (column starts)."""
    step = size // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, "text"):
                parts = []
                for doc_id, t, text, starts in zip(frame["doc_id"], frame["t"], frame["text"], frame["starts"]):
                    half = words.windows(words.hashed(words.split(text)), step)
                    starts = np.unique(np.asarray(starts, np.int64))
                    starts = starts[np.isin(starts + step, starts)]
                    h, g = doubled(half, starts, size, step)
                    parts.append(pd.DataFrame({"h": h, "g": g, "doc_id": doc_id, "t": t, "start": starts.astype(np.int32)}))
                yield pd.concat(parts)

    return texts.select("doc_id", "t", "text", "starts").mapInPandas(run, HIT)


def repeated(hits: DataFrame) -> DataFrame:
    """Hits whose window occurs in two documents, with the smallest of their ids as first."""
    ends = hits.groupBy("h", "g").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return hits.join(ends.drop("last"), ["h", "g"])


def repeated_names(own: DataFrame) -> DataFrame:
    """doc_id, found: the names (column names) that another document holds as well."""
    own = own.select("doc_id", F.explode("names").alias("h"))
    ends = own.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return own.join(ends.select("h"), "h").groupBy("doc_id").agg(F.collect_set("h").alias("found"))


def candidates(docs: DataFrame, size: int, start: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(outlines with the first doc_id of each class, texts of the classes with candidates, their repeated windows)."""
    steps = lengths(size, start)
    outline = saved(outlines(docs, size, steps[0]), "outlines")
    classes = outline.where("doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"))
    outline = outline.join(classes, "key", "left")
    found = repeated_names(outline.where("doc_id = rep"))
    texts = saved(docs.select("doc_id", F.hash("text").alias("t"), "text").where("text IS NOT NULL").join(found, "doc_id"), "candidates")
    level = texts
    for step, longer in zip(steps, steps[1:]):
        found = repeated_names(saved(renamed(level, size, step, longer), "names"))
        level = texts.drop("found").join(found, "doc_id")
    return outline, texts.drop("found"), repeated(saved(extended(level, size, steps[-1]), "hits"))


def deduplicated(docs: DataFrame, size: int = 50, start: int = START) -> DataFrame:
    """Words covered by a window that also starts in a document with a smaller doc_id are removed.

    doc_id, n_words, n_removed, kept_sha256 (of the words kept, joined by a space), and kept_text where
    some, but not all, words were removed.
    """
    if size < 2:
        raise ValueError("a window has two words at least")

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, "text", CHARS):
                rows = []
                for doc_id, t, text, starts in zip(frame["doc_id"], frame["t"], frame["text"], frame["starts"]):
                    own = words.split(text)
                    edge = np.zeros(len(own) + 1, np.int64)
                    starts = np.unique(np.asarray(starts, np.int64))
                    edge[starts] += 1
                    edge[starts + size] -= 1
                    free = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    kept = b" ".join([own[i] for i in free.tolist()])
                    rows.append((doc_id, t, len(own) - len(free), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
                yield pd.DataFrame(rows, columns=["doc_id", "t", "n_cut", "cut_sha256", "kept_text"])

    ready(docs.sparkSession)
    outline, texts, hits = candidates(docs, size, start)
    later = hits.where("doc_id > first")
    starts = later.groupBy("doc_id", "t").agg(F.collect_list("start").alias("starts"))
    edited = texts.join(starts, ["doc_id", "t"])
    edited = edited.mapInPandas(cover, "doc_id long, t int, n_cut long, cut_sha256 string, kept_text string").dropDuplicates(["doc_id", "t"])
    copy = (F.col("doc_id") > F.col("rep")) & (F.col("n_words") >= size)
    return outline.join(edited, ["doc_id", "t"], "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("cut_sha256", "sha256")).alias("kept_sha256"),
        F.when(~F.coalesce(copy, F.lit(False)), F.col("kept_text")).alias("kept_text"),
    )


def longest(docs: DataFrame, size: int = 50, start: int = START) -> DataFrame:
    """doc_id, words: the longest size * 2**k of a window that another document holds as well.

    Copies of a whole document count by their first one; documents without a repeated window are left out.
    """
    ready(docs.sparkSession)
    _, texts, hits = candidates(docs, size, start)
    hits, found = saved(hits, "level"), None
    while not hits.isEmpty():
        level = hits.select("doc_id").distinct().withColumn("words", F.lit(size))
        found = level if found is None else found.unionByName(level)
        starts = hits.groupBy("doc_id", "t").agg(F.collect_list("start").alias("starts"))
        size *= 2
        hits = saved(repeated(grown(texts.join(starts, ["doc_id", "t"]), size)), "level")
    if found is None:
        return hits.select("doc_id", F.lit(size).alias("words"))
    return found.groupBy("doc_id").agg(F.max("words").alias("words"))
