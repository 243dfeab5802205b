"""Test items inside documents, by pigeonhole pieces and bit-parallel edit distance.

Both sides are lower-cased, ASCII punctuation becomes space, and the rest is cut into words. An item of
m words may differ by k = floor(rate * m) inserted, deleted or replaced words. It is cut into k + 1
pieces, of which at least one is unharmed in any passage within the budget. Pieces are looked up by the
hash of their words at every place of a document; around each hit, Myers' bit-parallel algorithm finds
the least distance of the item to any passage.

Pieces are a table: hash, item, place in the item. A bitmap of their hashes, of at most BITMAP_BITS bits
whatever the test set, goes to every task; one pass over the documents keeps the windows that may be pieces.
These are joined to the table by hash, which says where an item would begin. A second pass over the documents
keeps, by a bitmap of the same bound, those with such places; they are joined to their items, in rows of about
ITEMS_PER_ROW, and verified. So only documents with hits (and, by chance, one in a thousand others, more beyond
the bound) are shuffled, and neither items nor pieces pass through the driver, only the words of the bitmaps.

Every item with a word is searched; below 1 / rate words the budget is 0, so a short item is found where it
stands word for word. Null texts and texts without words match nothing. Repeated rows are judged each. A null
id is kept as it is. Empty tables give no rows. Columns other than doc_id, item_id and text are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import words
from plumbline.llm.common import numbered, ready, saved, slices, unnumbered

#: Bits of the bitmap: 64 a piece, up to this many (32 MB); beyond it only more windows reach the join.
BITMAP_BITS = 1 << 28
LEAST_BITS = 1 << 20
ITEMS_PER_ROW = 64
TO_SPACE = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
FOUND = "doc_id long, text_hash long, item_id long, n_words int, distance int, start_word int, end_word int"
PIECE = "item string, n_words int, h long, size int, at int"
HIT = "doc_id long, text_hash long, h long, size int, place int"
VERIFIED = "doc_id long, text_hash long, item string, n_words int, distance int, start_word int, end_word int"


def normal(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(TO_SPACE).split() if isinstance(text, str) else []


def masks(item: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, w in enumerate(item):
        out[w] = out.get(w, 0) | 1 << i
    return out


def distances(where: dict[bytes, int], m: int, text: list[bytes]) -> Iterator[int]:
    """After each word of text, the least distance of the item to a passage that ends there."""
    every, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = every, 0, m
    for w in text:
        same = where.get(w, 0)
        flat = (((same & up) + up) ^ up) | same | down
        same |= down
        rise, fall = (down | ~(flat | up)) & every, up & flat
        score += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1) & every, (fall << 1) & every
        up, down = (fall | ~(same | rise)) & every, rise & same
        yield score


def passage(item: list[bytes], text: list[bytes], budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the closest passage within the budget; the first end, the shortest one."""
    scores = list(distances(masks(item), len(item), text))
    if not scores or min(scores) > budget:
        return None
    best = min(scores)
    end = scores.index(best) + 1
    back = list(distances(masks(item[::-1]), len(item), text[:end][::-1]))
    return best, end - back.index(best) - 1, end


def pieces(n: int, budget: int) -> list[tuple[int, int]]:
    """(offset, length) of budget + 1 pieces of n words, as even as can be."""
    cuts = [n * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def ranges(begins: list[int], m: int, k: int, n: int) -> list[tuple[int, int]]:
    """The parts of a text around the places where an item would begin, overlapping ones joined."""
    out: list[list[int]] = []
    for begin in begins:
        a, b = max(0, begin - k), min(n, begin + m + k)
        if a >= b:
            continue
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def piece_table(items: DataFrame, rate: float) -> DataFrame:
    """Every piece of every distinct item (item, text): the hash of its words, their number, their place."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, "text"):
                rows = []
                for item, text in zip(frame["item"], frame["text"]):
                    hashes = words.hashed(normal(text))
                    m = len(hashes)
                    for at, size in pieces(m, int(rate * m)) if m else []:
                        rows.append((item, m, int(words.windows(hashes[at : at + size], size).view(np.int64)[0]), size, at))
                yield pd.DataFrame(rows, columns=columns(PIECE))

    return items.mapInPandas(run, PIECE)


def columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def bitmap(table: DataFrame, n: int) -> np.ndarray:
    """64-bit words in which two bits are set for each of n hashes; at most BITMAP_BITS / 64 words are collected."""
    bits = min(BITMAP_BITS, max(LEAST_BITS, 1 << (64 * n - 1).bit_length()))
    places = F.transform(F.array("h", F.shiftrightunsigned("h", 32)), lambda x: x.bitwiseAND(F.lit(bits - 1)))
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = table.select(F.explode(places).alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("set")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy()] = found["set"].to_numpy()
    return out.view(np.uint64)


def marked(hashes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The positions of the hashes whose two bits are set."""
    mask = np.uint64(64 * len(seen) - 1)

    def on(x: np.ndarray) -> np.ndarray:
        x = x & mask
        return seen[(x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63)) & np.uint64(1) > 0

    at = np.flatnonzero(on(hashes))
    return at[on(hashes[at] >> np.uint64(32))]


def only_marked(docs: DataFrame, seen: np.ndarray) -> DataFrame:
    """The rows of docs whose hash h is marked: a filter by Arrow batches, in which no text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(marked(batch.column("h").to_numpy().view(np.uint64), shared.value)))

    return docs.mapInArrow(run, docs.schema)


def hits(docs: DataFrame, sizes: list[int], seen: np.ndarray) -> DataFrame:
    """The windows of every text, of the given sizes, that the bitmap marks: their hash and first word."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, "text"):
                texts = [normal(x) for x in frame["text"]]
                bounds = np.cumsum([0] + [len(t) for t in texts])
                hashes = words.hashed(list(chain.from_iterable(texts)))
                for size in sizes:
                    every = words.windows(hashes, size)
                    at = marked(every, shared.value)
                    text = np.searchsorted(bounds, at, "right") - 1
                    inside = at + size <= bounds[text + 1]  # not across two texts
                    at, text = at[inside], text[inside]
                    doc_id, text_hash = (frame[c].to_numpy()[text] for c in ("doc_id", "text_hash"))
                    yield pd.DataFrame({"doc_id": doc_id, "text_hash": text_hash, "h": every[at].view(np.int64), "size": size, "place": at - bounds[text]})

    return docs.mapInPandas(run, HIT)


def verified(rows: DataFrame, rate: float) -> DataFrame:
    """rows: doc_id, text_hash, text and items (item, item_text, begins); those within the budget, closest passage."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, "text"):
                out = []
                for doc_id, text_hash, text, items in zip(frame["doc_id"], frame["text_hash"], frame["text"], frame["items"]):
                    text = normal(text)
                    for one in items:
                        own = normal(one["item_text"])
                        got = closest(own, text, sorted(one["begins"]), int(rate * len(own)))
                        if got:
                            out.append((doc_id, text_hash, one["item"], len(own), *got))
                yield pd.DataFrame(out, columns=columns(VERIFIED))

    return rows.select("doc_id", "text_hash", "text", "items").mapInPandas(run, VERIFIED)


def closest(own: list[bytes], text: list[bytes], begins: list[int], budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the closest passage around the places where the item would begin; the first of equals."""
    best = None
    for a, b in ranges(begins, len(own), budget, len(text)):
        got = passage(own, text[a:b], budget)
        if got and (best is None or got[0] < best[0]):
            best = (got[0], a + got[1], a + got[2])
        if best and not best[0]:
            break
    return best


def found(docs: DataFrame, benchmark: DataFrame, rate: float = 0.15) -> DataFrame:
    """doc_id, text_hash, item_id, n_words, distance, start_word, end_word: items found in documents."""
    ready(docs.sparkSession)
    named = benchmark.where("text IS NOT NULL").select("item_id", "text", F.md5(F.col("text").cast("binary")).alias("item"))
    items = saved(named.select("item", "text").distinct(), "items")
    table = saved(piece_table(items, rate), "pieces")
    sizes, n = table.agg(F.sort_array(F.collect_set("size")), F.count(F.lit(1))).first()  # no piece has over 1 + 1 / rate words
    if not n:
        return docs.sparkSession.createDataFrame([], FOUND)
    rows = docs.select(numbered(), F.xxhash64("text").alias("text_hash"), "text")
    windows = saved(hits(rows, sizes, bitmap(table, n)), "hits")

    doc, begin = ["doc_id", "text_hash"], (F.col("place") - F.col("at")).alias("begin")
    at = windows.distinct().join(table, ["h", "size"]).select(*doc, "item", begin)
    at = saved(at.groupBy(*doc, "item").agg(F.collect_set("begin").alias("begins")), "places")  # places of one document
    per_row = at.groupBy(*doc).agg(F.ceil(F.count(F.lit(1)) / ITEMS_PER_ROW).alias("parts"))
    whole = at.join(per_row, doc).join(items.withColumnRenamed("text", "item_text"), "item")
    part = F.pmod(F.xxhash64("item"), F.col("parts")).alias("part")
    each = whole.groupBy(*doc, part).agg(F.collect_list(F.struct("item", "item_text", "begins")).alias("items"))
    key = F.xxhash64(*doc).alias("h")
    keys = per_row.select(key)
    hit = only_marked(rows.select("*", key), bitmap(keys, keys.count())).drop("h")
    kept = verified(hit.join(each.drop("part"), doc), rate)
    out = kept.join(named.select("item_id", "item"), "item").select(*columns(FOUND))
    return unnumbered(out)
