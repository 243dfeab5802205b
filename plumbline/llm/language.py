"""Language identification by unigram models over pieces, summed over every segmentation.

The pieces are those of a fixed public vocabulary that hold letters only, in lower case. A text is its
letter runs in lower case, each led by the vocabulary's word mark and cut every STRETCH characters. For
each language the probability of a run is the sum, over all ways to cut it into pieces, of the product of
their probabilities; a forward pass gives it without listing the ways. A character that is no piece is
one common piece, OTHER.

Training counts the runs of all learnable documents by language in Spark and fits the piece
probabilities by expectation maximisation: each round is one pass of forward and backward sums over the
distinct runs, and its expected counts (at most pieces times languages) are added up in Spark. The
predicted language is the one of greatest posterior, with the shares of learnable documents as prior.

Learnable are rows with text and lang whose crc32(doc_id) mod 3 is not 1; a null doc_id is not learnable
and not held out. A text that is null or has no letter gets UNKNOWN and score 0; so does every text if
nothing can be learnt. Equal posteriors: the language first in order. Repeated rows count and are scored
each. An empty table gives no rows. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import numbered, ready, saved, slices, unnumbered
from plumbline.llm.words import mix

MARK = "▁"
UNKNOWN = "und"
STRETCH = 24
ROUNDS = 3
SMOOTHING = 0.1
REMEMBERED = 400_000
COUNTED = 200_000
GATHERED = 4_000_000
CELLS = 4_000_000
RUN = regex.compile(r"\p{L}[\p{L}\p{M}]*")
LETTERS = bytes(i if regex.fullmatch(r"\p{L}", chr(i)) else 32 for i in range(256))
PIECE = regex.compile(f"{MARK}?[\\p{{L}}\\p{{M}}]*")
BASE = 0x9E3779B97F4A7C15
WRAP = 1 << 64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def vocabulary(path: str) -> list[str]:
    """The usable pieces of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in pieces if PIECE.fullmatch(p) and p == p.lower()} | {MARK})


def runs_of(text: str | None) -> list[str]:
    if not isinstance(text, str):
        return []
    text = text.lower()
    try:  # one byte a character, none of them a mark: other bytes than letters become blanks
        found = text.encode("latin-1").translate(LETTERS).decode("latin-1").split()
    except UnicodeEncodeError:
        found = RUN.findall(text)
    if max(map(len, found), default=0) <= STRETCH:
        return found
    return [w[i : i + STRETCH] for w in found for i in range(0, len(w), STRETCH)]


#: Start and end in the runs, places of the words that hold a piece there, and its id.
Arc = tuple[int, int, np.ndarray, np.ndarray]


class Lattice:
    """Which pieces stand where in runs: a hash table of the pieces and their beginnings, probed for all
    words at once. Where what was read begins no piece, no longer piece can follow, and the word drops out."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces))
        self.other, self.none = len(pieces), len(pieces) + 1
        self.begun = len(pieces) + 2
        known: dict[int, int] = {}
        for i, piece in enumerate(pieces):
            key = 0
            for c in piece:
                key = (key * BASE + ord(c)) % WRAP
                known.setdefault(key, self.begun)
            known[key] = i
        self.slots = 1 << (4 * len(known) - 1).bit_length()
        self.keys = np.zeros(self.slots, np.uint64)
        self.ids = np.full(self.slots, self.none, np.int32)
        places = self._slot(np.fromiter(known, np.uint64, len(known))).tolist()
        for at, (key, i) in zip(places, known.items()):
            while self.ids[at] != self.none:
                at = (at + 1) % self.slots
            self.keys[at], self.ids[at] = key, i

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) & np.uint64(self.slots - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.ids[at]
        again = np.flatnonzero((out != self.none) & (self.keys[at] != keys))
        while len(again):
            at[again] = (at[again] + 1) & (self.slots - 1)
            out[again] = self.ids[at[again]]
            again = again[(out[again] != self.none) & (self.keys[at[again]] != keys[again])]
        return out

    def pieces(self, words: list[str]) -> list[Arc]:
        """(start, end, places of words, their piece ids), for words of one length, in order of start."""
        n, length = len(words), len(words[0]) + 1
        codes = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).T.astype(np.uint64)
        arcs = []
        for start in range(length):
            alive, key = np.arange(n), np.zeros(n, np.uint64)
            for end in range(start + 1, min(length, start + self.longest) + 1):
                key = key * np.uint64(BASE) + codes[end - 1][alive]
                ids = self.find(key)
                whole = ids < self.other
                if end == start + 1:
                    arcs.append((start, end, alive, np.where(whole, ids, self.other)))
                elif whole.any():
                    arcs.append((start, end, alive[whole], ids[whole]))
                more = ids != self.none
                alive, key = alive[more], key[more]
                if not len(alive):
                    break
        return arcs


def by_length(words: list[str], languages: int) -> Iterator[np.ndarray]:
    """Places of words of equal length, so many at a time that all sums fit CELLS numbers."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if len(part):
            most = max(1, CELLS // ((int(lengths[part[0]]) + 2) * max(languages, 16)))
            for i in range(0, len(part), most):
                yield part[i : i + most]


def forward(arcs: list[Arc], chance: np.ndarray, n: int, length: int) -> np.ndarray:
    """(place, word, language): the sum over all segmentations of what stands before the place."""
    alpha = np.zeros((length + 1, n, chance.shape[1]))
    alpha[0] = 1
    for start, end, at, ids in arcs:  # in order of start, so alpha[start] is complete
        if len(at) == n:
            alpha[end] += alpha[start] * chance[ids]
        else:
            alpha[end, at] += alpha[start, at] * chance[ids]
    return alpha


def backward(arcs: list[Arc], chance: np.ndarray, n: int, length: int) -> np.ndarray:
    beta = np.zeros((length + 1, n, chance.shape[1]))
    beta[length] = 1
    for start, end, at, ids in reversed(arcs):
        beta[start, at] += beta[end, at] * chance[ids]
    return beta


@dataclass(frozen=True)
class Model:
    """chance: probability by piece (OTHER and, at 0, no piece at the end) and language; key names the model."""

    key: str
    pieces: list[str]
    languages: list[str]
    prior: np.ndarray
    chance: np.ndarray


class Scorer:
    """Log-probabilities of texts by language; a worker remembers those of its runs."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.known: dict[str, int] = {}
        self.logs = np.empty((0, len(model.languages)))

    def learn(self, words: list[str]) -> None:
        first = len(self.known)
        if len(self.logs) < first + len(words):  # room for as many again
            self.logs = np.concatenate([self.logs[:first], np.empty((first + 2 * len(words), len(self.model.languages)))])
        logs = self.logs[first : first + len(words)]
        for part in by_length(words, logs.shape[1]):
            own = [words[i] for i in part.tolist()]
            length = len(own[0]) + 1
            logs[part] = np.log(forward(self.lattice.pieces(own), self.model.chance, len(own), length)[length])
        self.known.update(zip(words, range(first, first + len(words))))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Posterior by text and language; a row of zeros for a text without runs."""
        out = np.zeros((len(texts), len(self.model.languages)))
        if not self.model.languages:
            return out
        split = [runs_of(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.logs = {}, self.logs[:0]
        new = set().union(*split) - self.known.keys()
        if new:
            self.learn(sorted(new))
        for i, own in enumerate(split):
            if own:
                places, times = np.unique(np.fromiter(map(self.known.__getitem__, own), np.int64, len(own)), return_counts=True)
                odds = self.model.prior + times.astype(np.float64) @ self.logs[places]
                odds = np.exp(odds - odds.max())
                out[i] = odds / odds.sum()
        return out


_scorers: dict[str, Scorer] = {}


def scorer(model: Model) -> Scorer:
    """One scorer for each worker process, so that tasks after the first know their runs."""
    if model.key not in _scorers:
        _scorers.clear()
        _scorers[model.key] = Scorer(model)
    return _scorers[model.key]


def counted(docs: DataFrame) -> DataFrame:
    """lang, word, n: every run of the learnable documents, added up in tasks before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}

        def rows() -> pd.DataFrame:
            flat = [(lang, w, n) for lang, count in held.items() for w, n in count.items()]
            held.clear()
            return pd.DataFrame(flat, columns=["lang", "word", "n"])

        for batch in batches:
            for frame in slices(batch, "text"):
                for lang, text in zip(frame["lang"], frame["text"]):
                    held.setdefault(lang, Counter()).update(runs_of(text))
                if sum(map(len, held.values())) > COUNTED:
                    yield rows()
        yield rows()

    return docs.select("lang", "text").mapInPandas(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def expected(words: DataFrame, pieces: list[str], languages: list[str], chance: np.ndarray) -> np.ndarray:
    """How often each piece stands in the words of each language, in expectation over segmentations."""
    place = {v: i for i, v in enumerate(languages)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice, total = Lattice(pieces), np.zeros((len(languages), chance.shape[0]))
        for batch in batches:
            for lang, frame in batch.groupby("lang", sort=False):
                at = place[lang]
                own, words, times = chance[:, at : at + 1], frame["word"].tolist(), frame["n"].to_numpy(np.float64)
                for part in by_length(words, 1):
                    some = [words[i] for i in part.tolist()]
                    n, length = len(some), len(some[0]) + 1
                    arcs = lattice.pieces(some)
                    alpha, beta = forward(arcs, own, n, length)[:, :, 0], backward(arcs, own, n, length)[:, :, 0]
                    weight = times[part] / alpha[length]
                    for start, end, held, ids in arcs:
                        total[at] += np.bincount(ids, weight[held] * alpha[start, held] * own[ids, 0] * beta[end, held], total.shape[1])
        a, p = np.nonzero(total)
        yield pd.DataFrame({"a": a, "p": p, "e": total[a, p]})

    sums = words.mapInPandas(run, "a int, p int, e double").groupBy("a", "p").agg(F.sum("e").alias("e")).toPandas()  # at most languages x pieces
    out = np.zeros((chance.shape[0], len(languages)))
    out[sums["p"], sums["a"]] = sums["e"]
    return out


def train(docs: DataFrame, path: str, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> Model:
    """The model of lang over the pieces of the vocabulary file at path, from all learnable rows."""
    spark = ready(docs.sparkSession)
    pieces = vocabulary(path)
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("doc_id")))
    shares = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    languages = sorted(shares)
    prior = np.log(np.array([shares[v] for v in languages], np.float64) / max(1, sum(shares.values())))
    chance = np.full((len(pieces) + 2, len(languages)), 1 / (len(pieces) + 1))
    chance[-1] = 0
    if languages:
        words = saved(counted(rows), "words")
        batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
        for _ in range(rounds):
            chance = expected(words, pieces, languages, chance) + smoothing
            chance[-1] = 0
            chance /= chance.sum(0)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    return Model(uuid.uuid4().hex, pieces, languages, prior, chance)


def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of batches in larger frames, of GATHERED characters at least but the last: new runs of many texts are
    looked up together, which costs little more than those of one."""
    held: list[pd.DataFrame] = []
    total = 0
    for batch in batches:
        for frame in slices(batch, "text"):
            held.append(frame)
            total += int(frame["text"].str.len().fillna(0).sum()) + len(frame)
            if total >= GATHERED:
                yield pd.concat(held, ignore_index=True)
                held, total = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer(model)
        names = np.array([*model.languages, UNKNOWN], object)
        for frame in gathered(batches):
            odds = np.hstack([score(frame["text"].tolist()), np.zeros((len(frame), 1))])
            best = np.where(odds.sum(1) > 0, odds.argmax(1), len(names) - 1)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "lang_pred": names[best], "score": odds.max(1)})

    ready(docs.sparkSession)
    out = docs.select(numbered(), "text").mapInPandas(run, "doc_id long, lang_pred string, score double")
    return unnumbered(out).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
