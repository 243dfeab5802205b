"""A toxicity classifier with counterfactual regularisation.

A text is the set of its words (lower case, ASCII punctuation as space) and of their beginnings, hashed.
Labelled documents give a logistic model over the features that set the classes apart best. For each
labelled document that names a group, a second version is made in which every identity term is swapped
for the next of its kind (pronouns and group names in English, French, German and Spanish); besides the L2 penalty, the squared change of the log-odds between the two
versions is penalised, so a neutral mention of one group scores like that of another.

The model is fitted on at most SAMPLE labelled documents of each class, those of the least hash of
doc_id, then of text, rows equal in both counted once. The intercept is set to the share of toxic labels
among all learnable rows. Features are chosen from those documents; both bounds are parameters. Every text is scored whole.

Labels are learnt only where crc32(doc_id) mod 4 is not 2. Several labels of one doc_id: the largest
counts. Without labels of both classes every score is the share of toxic ones, 0 if there are none. A
null text is empty; rows with null or repeated ids are scored each. An empty table gives no rows.
Columns of documents other than doc_id and text are never read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from plumbline.llm.common import numbered, ready, saved, slices, unnumbered

SAMPLE = 4000
FEATURES = 2048
BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6, 7)
REMEMBERED = 500_000
THRESHOLD = 0.3
L2, SWAP = 1e-3, 1.0
#: Identity terms by kind and language; within a kind each is swapped for the next.
IDENTITY = (
    ("he", "she"),
    ("his", "her"),
    ("il", "elle"),
    ("ils", "elles"),
    ("él", "ella"),
    ("ellos", "ellas"),
    ("er", "sie"),
    ("sein", "ihr"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noirs", "blancs", "asiatiques"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("schwarze", "weiße", "asiaten"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("chicas", "chicos"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negros", "blancos", "asiáticos"),
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "transgender"),
    ("immigrants", "natives"),
    ("old", "young"),
    ("deaf", "blind", "disabled"),
)
TO_SPACE = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def distinct_words(text: str | None) -> set[bytes]:
    return set(text.lower().encode("utf-8", "surrogatepass").translate(TO_SPACE).split()) if isinstance(text, str) else set()


def hashes(word: bytes) -> tuple[int, ...]:
    """A word and its beginnings as features."""
    return tuple({xxh32_intdigest(word + b"$") % BUCKETS, *(xxh32_intdigest(word[:n]) % BUCKETS for n in BEGINNINGS if len(word) >= n)})


def swaps(identity: tuple[tuple[str, ...], ...]) -> dict[bytes, bytes]:
    return {a.encode(): b.encode() for kind in identity for a, b in zip(kind, kind[1:] + kind[:1])}


@dataclass(frozen=True)
class Model:
    """fitted and swapped: how many rows it was fitted on, and how many of them name a group."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float
    fitted: int = 0
    swapped: int = 0


class Scorer:
    """The log-odds of a text; a worker remembers which words carry a feature of the model."""

    def __init__(self, model: Model):
        self.model = model
        self.place = {int(f): i for i, f in enumerate(model.features)}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> float:
        found: set[int] = set()
        known = self.known
        for word in distinct_words(text):
            own = known.get(word)
            if own is None:
                own = known[word] = tuple(self.place[h] for h in hashes(word) if h in self.place)
            if own:
                found.update(own)
        if len(known) > REMEMBERED:
            known.clear()
        return self.model.intercept + float(self.model.weights[sorted(found)].sum()) if found else self.model.intercept


def fit(x: np.ndarray, y: np.ndarray, change: np.ndarray, l2: float, swap: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model by accelerated gradient descent.

    mean log loss + l2 / 2 |w|^2 + swap / 2 mean (change @ w)^2, change being what a swap adds to x.
    Both matrices are 32-bit; products take 32-bit vectors, else numpy copies the matrices to 64 bits.
    """
    n, k = x.shape
    w, b, at, at_b, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    m = max(1, len(change))

    def times(a: np.ndarray, v: np.ndarray) -> np.ndarray:
        return (a @ v.astype(np.float32)).astype(np.float64)

    def norm(a: np.ndarray) -> float:
        v = np.ones(a.shape[1]) / a.shape[1] ** 0.5
        for _ in range(20):
            v = times(a.T, times(a, v))
            size = np.linalg.norm(v)
            if not size:
                return 0.0
            v /= size
        return float(size)

    step = 1 / (0.25 * (norm(x) * 1.05 / n + 1) + l2 + swap * norm(change) * 1.05 / m)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(times(x, at) + at_b, -30, 30)))
        gradient = times(x.T, p - y) / n + l2 * at + swap * times(change.T, times(change, at)) / m
        new, new_b = at - step * gradient, at_b - step * float((p - y).mean())
        t, was = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        at, at_b = new + (was - 1) / t * (new - w), new_b + (was - 1) / t * (new_b - b)
        w, b = new, new_b
    return w, b


def train(
    docs: DataFrame,
    labels: DataFrame,
    identity: tuple[tuple[str, ...], ...] = IDENTITY,
    sample: int = SAMPLE,
    features: int = FEATURES,
    l2: float = L2,
    swap: float = SWAP,
) -> Model:
    """The model of labels.toxic, learnt from rows that are not held out."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"))
    known = saved(texts.distinct().join(known, "doc_id"), "known")  # one row for rows equal in id and text
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log((share + 1e-12) / (1 - share + 1e-12))))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("h")]
    chosen = known.where("y = 1").orderBy(*order).limit(sample).unionByName(known.where("y = 0").orderBy(*order).limit(sample))
    change = swaps(identity)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, h, y, text in zip(batch["doc_id"], batch["h"], batch["y"], batch["text"]):
                own = distinct_words(text)
                other = {change.get(w, w) for w in own}
                ids = {f for w in own for f in hashes(w)}
                rows.append((doc_id, h, y, sorted(ids), sorted({f for w in other for f in hashes(w)}) if other != own else None))
            yield pd.DataFrame(rows, columns=["doc_id", "h", "y", "ids", "swapped"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").join(F.broadcast(chosen), ["doc_id", "h"])
    rows = rows.dropDuplicates(["doc_id", "h"])  # at most 2 * sample rows
    rows = saved(rows.mapInPandas(sets, "doc_id long, h long, y int, ids array<int>, swapped array<int>"), "labelled")
    n = {y: F.lit(float(min(sizes[y], sample))) for y in (0, 1)}
    seen = rows.select("y", F.explode(F.array_union("ids", F.coalesce("swapped", F.array().cast("array<int>")))).alias("f"))
    held = seen.groupBy("f").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("c"))
    odds = lambda k, m: F.log((k + 0.5) / (m - k + 0.5).cast("double"))
    a, c = F.least(F.col("a").cast("double"), n[1]), F.least(F.col("c").cast("double"), n[0])
    apart = F.abs(odds(a, n[1]) - odds(c, n[0])) / F.sqrt(1 / (a + 0.5) + 1 / (c + 0.5))
    best = held.where("a + c >= 3").withColumn("z", apart).orderBy(F.col("z").desc(), "f").limit(features)
    place = {r["f"]: i for i, r in enumerate(best.select("f").collect())}  # at most `features` rows
    mine = F.from_json(F.lit(str(list(place))), "array<int>")
    few = rows.orderBy("doc_id", "h").select("y", F.array_intersect("ids", mine).alias("ids"), F.array_intersect("swapped", mine).alias("swapped"))
    table = few.collect()  # at most 2 * sample rows of at most `features` numbers
    x = np.zeros((len(table), len(place)), np.float32)
    moved = []
    for i, r in enumerate(table):
        x[i, [place[f] for f in r["ids"]]] = 1
        if r["swapped"] is not None:
            other = np.zeros(len(place), np.float32)
            other[[place[f] for f in r["swapped"]]] = 1
            moved.append(other - x[i])
    y = np.array([r["y"] for r in table], np.float64)
    w, b = fit(x, y, np.stack(moved) if moved else np.zeros((0, len(place)), np.float32), l2, swap)
    b += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return Model(np.array(list(place), np.int64), w, float(b), len(table), len(moved))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, held_out, score and predicted of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = Scorer(model)
        for batch in batches:
            for frame in slices(batch, "text"):
                odds = np.array([score(t) for t in frame["text"]])
                yield pd.DataFrame({"doc_id": frame["doc_id"], "text_hash": frame["text_hash"], "score": 1 / (1 + np.exp(-np.clip(odds, -700, 700)))})

    ready(docs.sparkSession)
    rows = docs.select(numbered(), F.xxhash64("text").alias("text_hash"), "text")
    out = unnumbered(rows.mapInPandas(run, "doc_id long, text_hash long, score double"))
    return out.select("doc_id", "text_hash", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
