"""Periodic runs of words, found on a grammar.

Words are runs of anything but space and U+0009 to U+000D. A run is a stretch of words with smallest
period q (words q apart are equal) and at least max(LEAST, EXPONENT * q) words that no neighbouring word
extends. Its words after the first q can be dropped.

1. The word ids of a slice of texts, kept apart by ids of their own, are rewritten by Re-Pair until no
   pair of neighbours occurs twice. Each round replaces, all over the slice, every pair that is more
   frequent than the pairs it overlaps, so a round is a few sorts and the number of rounds is small.
2. What remains of a text is its start rule, read as a balanced tree.
3. Every stretch crosses the boundary between the two halves of the smallest nonterminal that holds it.
   For each nonterminal, at one of its places, all periods up to a quarter of its length are tried at its
   boundary: squares by prefix hashes, then extended by binary search as far as the nonterminal goes.
4. What is found is carried to every place of the nonterminal. Per text, stretches inside others of the
   same period, and those whose period is a multiple of a shorter one there, go.

Prefix hashes only propose: each run is compared word by word, and a text where one fails is searched
again by direct comparison.

A null text has no words. Each row stands for itself, so repeated rows and null ids are kept. An empty
table gives no rows. Columns other than doc_id and text are not read. Memory is linear in the words of a
slice of texts, or of one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from plumbline.llm import words
from plumbline.llm.common import numbered, ready, slices, unnumbered

LEAST, EXPONENT = 6, 4
TRIED = 1_000_000
Arrays = tuple[np.ndarray, ...]


def pairs_chosen(sym: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of the pairs to replace, their pair numbers, places of all pairs that occur twice)."""
    at = np.flatnonzero(alive)
    _, pair, counts = np.unique(sym[at] * (int(sym.max()) + 1) + sym[at + 1], return_inverse=True, return_counts=True)
    often = counts[pair] >= 2
    at, pair = at[often], pair[often]
    if not len(at):
        return at, pair, at
    rank = np.empty(len(counts), np.int64)
    rank[np.lexsort((words.mix(np.arange(len(counts), dtype=np.uint64) + words.BASE), counts))] = np.arange(1, len(counts) + 1)
    mine = rank[pair]
    joins = (at[1:] == at[:-1] + 1) & (mine[1:] == mine[:-1])  # one symbol three times in a row
    first = np.flatnonzero(np.r_[True, ~joins])
    last = np.r_[first[1:] - 1, len(at) - 1]
    before = np.where(np.r_[False, at[first[1:]] == at[first[1:] - 1] + 1], mine[first - 1], 0)
    after = np.where(np.r_[at[last[:-1] + 1] == at[last[:-1]] + 1, False], mine[np.minimum(last + 1, len(at) - 1)], 0)
    wins = (mine[first] > before) & (mine[first] > after)
    lengths = last - first + 1
    offset = np.arange(len(at)) - np.repeat(first, lengths)
    chosen = np.repeat(wins, lengths) & (offset % 2 == 0)
    return at[chosen], pair[chosen], at


def grammar(ids: np.ndarray) -> tuple[Arrays, Arrays, Arrays]:
    """Re-Pair over ids; negative ids stand alone.

    (symbol, start) of every replaced pair, (start, boundary, end) of each symbol at its first place,
    and the rest: (symbol, start) of the sequence that is left.
    """
    sym, start = ids.copy(), np.arange(len(ids) + 1)
    alive = np.r_[(sym[:-1] >= 0) & (sym[1:] >= 0), False] if len(ids) else np.zeros(0, bool)
    places: list[Arrays] = []
    rules: list[Arrays] = []
    fresh, n_rules = int(ids.max(initial=0)) + 1, 0
    while alive.any():
        at, pair, often = pairs_chosen(sym, alive)
        alive = np.zeros(len(sym), bool)
        if not len(at):
            break
        alive[often] = True
        _, where, new = np.unique(pair, return_index=True, return_inverse=True)
        places.append((n_rules + new, start[at]))
        rules.append((start[at[where]], start[at[where] + 1], start[at[where] + 2]))
        sym[at] = fresh + new
        alive[at] = True
        alive[np.maximum(at - 1, 0)] = True
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        new_at = np.zeros(len(sym), bool)
        new_at[at] = True
        alive[at] = True
        sym, alive, start = sym[keep], alive[keep], start[np.r_[keep, True]]
        alive[:-1] &= (sym[:-1] >= 0) & (sym[1:] >= 0)
        alive[-1:] = False
        fresh, n_rules = fresh + len(where), n_rules + len(where)
    none = np.empty(0, np.int64)
    joined = lambda parts, k: tuple(np.concatenate(x) for x in zip(*parts)) if parts else (none,) * k
    return joined(places, 2), joined(rules, 3), (sym, start)


def tree(sym: np.ndarray, start: np.ndarray) -> Arrays:
    """(start, boundary, end) of the nodes of balanced trees over the sequences between negative ids."""
    own = np.cumsum(sym < 0)
    left, right, text = start[:-1][sym >= 0], start[1:][sym >= 0], own[sym >= 0]
    nodes: list[Arrays] = []
    while True:
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.empty(0, np.int64)
        place = np.arange(len(text)) - np.repeat(first, np.diff(np.r_[first, len(text)]))
        odd = place % 2 == 1
        if not odd.any():
            break
        at = np.flatnonzero(odd)
        nodes.append((left[at - 1], left[at], right[at]))
        right[at - 1] = right[at]
        left, right, text = left[~odd], right[~odd], text[~odd]
    none = np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*nodes)) if nodes else (none,) * 3


class Prefixes:
    """Hashes that tell whether stretches of equal length, a period apart, are equal."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), words.BASE)], dtype=np.uint64)
        value = words.mix(ids.astype(np.uint64) + words.BASE)
        self.sums = np.r_[np.uint64(0), np.cumsum(value * self.power[:-1], dtype=np.uint64)]

    def same(self, at: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Are [at, at + length) and the stretch `period` later equal?"""
        s = self.sums
        return (s[at + length] - s[at]) * self.power[period] == s[at + period + length] - s[at + period]

    def extent(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
        """How far, up to `most`, equality goes on from `at`, ahead or back."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = self.same(at if ahead else at - middle, middle, period)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def crossing(hashes: Prefixes, low: np.ndarray, middle: np.ndarray, high: np.ndarray, least: int, exponent: int) -> Arrays:
    """(node, period, start, end) of the stretches at the boundaries of nodes, as far as each node goes."""
    ids, end = hashes.ids, len(hashes.ids) - 1
    node = np.flatnonzero(high - low >= max(least, exponent))
    counts = (high - low)[node] // exponent
    cuts = np.flatnonzero(np.diff(np.cumsum(counts) // TRIED)) + 1
    found: list[Arrays] = []
    for part, many in zip(np.split(node, cuts), np.split(counts, cuts)):
        if not len(part):
            continue
        own = np.repeat(part, many)
        q = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many) + 1
        b, lo, hi = middle[own], low[own], high[own]
        back = (b - q >= lo) & (ids[np.maximum(b - q, 0)] == ids[b])
        ahead = (b + q < hi) & (ids[np.minimum(b + q, end)] == ids[b])
        own, q, b, lo, hi = (x[back | ahead] for x in (own, q, b, lo, hi))
        for steps in (2, 1, 0):  # a run across b holds a square that starts two, one or no periods before b
            at = b - steps * q
            some = np.flatnonzero((at >= lo) & (at + 2 * q <= hi))
            some = some[hashes.same(at[some], q[some], q[some])]
            at, period, least_at, most_at = at[some], q[some], lo[some], hi[some]
            begin = at - hashes.extent(at, period, at - least_at, False)
            stop = at + hashes.extent(at, period, most_at - period - at, True) + period
            long = stop - begin >= np.maximum(least, exponent * period)
            found.append((own[some][long], period[long], begin[long], stop[long]))
    none = np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (none,) * 4


def everywhere(places: Arrays, rules: Arrays, found: Arrays) -> Arrays:
    """(period, start, end) of what was found in the rules, at each place of the rule."""
    node, q, begin, stop = found
    symbol, start = places
    order = np.argsort(symbol, kind="stable")
    sorted_symbol = symbol[order]
    first = np.searchsorted(sorted_symbol, node)
    many = np.searchsorted(sorted_symbol, node, side="right") - first
    shift = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    moved = start[order[shift]] - np.repeat(rules[0][node], many)
    return np.repeat(q, many), np.repeat(begin, many) + moved, np.repeat(stop, many) + moved


def widest(text: np.ndarray, q: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> Arrays:
    """The stretches that lie in no other one of the same text and period."""
    order = np.lexsort((-stop, begin, q, text))
    text, q, begin, stop = (x[order] for x in (text, q, begin, stop))
    if not len(text):
        return text, q, begin, stop
    group = np.cumsum(np.r_[False, (text[1:] != text[:-1]) | (q[1:] != q[:-1])])
    reach = np.maximum.accumulate(group * (int(stop.max()) + 1) + stop)
    new = np.r_[True, reach[1:] > reach[:-1]]
    return text[new], q[new], begin[new], stop[new]


def primitive(q: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) by start and period; stretches of one text that hold a shorter period go."""
    runs = []
    while len(q):  # ascending periods
        p, a, b = int(q[0]), int(begin[0]), int(stop[0])
        runs.append((a, b - a, p))
        rest = ~((q % p == 0) & (begin >= a) & (stop <= b))
        q, begin, stop = q[rest], begin[rest], stop[rest]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def direct(ids: np.ndarray, least: int, exponent: int) -> list[tuple[int, int, int]]:
    """The runs of one text by comparing it with itself at every period."""
    found = []
    for q in range(1, len(ids) // exponent + 1):
        unequal = np.flatnonzero(np.r_[True, ids[q:] != ids[:-q], True])
        begin, stop = unequal[:-1], unequal[1:] - 1 + q
        long = stop - begin >= max(least, exponent * q)
        found.append((np.full(long.sum(), q), begin[long], stop[long]))
    return primitive(*(np.concatenate(x) for x in zip(*found))) if found else []


def runs_of(texts: list[np.ndarray], least: int = LEAST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each array of word ids, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offset = np.cumsum(sizes + 1) - sizes - 1
    ids = np.concatenate([x for i, t in enumerate(texts) for x in (t, [-1 - i])]).astype(np.int64) if texts else np.empty(0, np.int64)
    places, rules, rest = grammar(ids)
    hashes = Prefixes(ids)
    top = crossing(hashes, *tree(*rest), least, exponent)[1:]
    inner = everywhere(places, rules, crossing(hashes, *rules, least, exponent))
    q, begin, stop = (np.concatenate(x) for x in zip(inner, top))
    text = np.searchsorted(offset, begin, side="right") - 1
    text, q, begin, stop = widest(text, q, begin, stop)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    bounds = np.flatnonzero(np.r_[True, text[1:] != text[:-1], True]) if len(text) else []
    for a, b in zip(bounds, bounds[1:]):
        i = int(text[a])
        own, at = texts[i], offset[i]
        runs = primitive(q[a:b], begin[a:b] - at, stop[a:b] - at)
        true = all(np.array_equal(own[s : s + n - p], own[s + p : s + n]) for s, n, p in runs)
        out[i] = runs if true else direct(own, least, exponent)
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; of equal ones the first, then the one of least period."""
    def order(a, b):
        return b[1] * a[2] - a[1] * b[2] or a[0] - b[0] or a[2] - b[2]

    return min(runs, key=cmp_to_key(order)) if runs else None


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Places of the words that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.flatnonzero(np.cumsum(edge[:-1]) == 0)


def collapsed(
    docs: DataFrame,
    least: int = LEAST,
    exponent: int = EXPONENT,
    read: Callable[[int, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """doc_id, n_words, runs, strongest run (start, length, period, null without runs), collapsed_text.

    `read` may give, for a doc_id and a number of words, the places in which the words are to be read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, "text"):
                numbers: dict[bytes, int] = {}
                own = [words.split(t) for t in frame["text"]]
                if read is not None:
                    for i, doc_id in enumerate(frame["doc_id"].tolist()):
                        places = read(doc_id, len(own[i])) if own[i] else None
                        if places is not None:
                            own[i] = [own[i][j] for j in places.tolist()]
                ids = [np.array([numbers.setdefault(w, len(numbers)) for w in t], np.int64) for t in own]
                rows = []
                for doc_id, t, runs in zip(frame["doc_id"], own, runs_of(ids, least, exponent)):
                    rest = [t[i] for i in kept(len(t), runs).tolist()] if runs else t
                    best = strongest(runs)
                    rows.append((doc_id, len(t), [dict(zip(("start", "length", "period"), r)) for r in runs], best and dict(zip(("start", "length", "period"), best)), b" ".join(rest).decode("utf-8", "surrogatepass")))
                yield pd.DataFrame(rows, columns=["doc_id", "n_words", "runs", "best", "collapsed_text"])

    if exponent < 4:
        raise ValueError("squares at a boundary are sure to show from the fourth power on")
    ready(docs.sparkSession)
    one = "struct<start: long, length: long, period: long>"
    out = docs.select(numbered(), "text").mapInPandas(run, f"doc_id long, n_words long, runs array<{one}>, best {one}, collapsed_text string")
    return unnumbered(out).select("doc_id", "n_words", "runs", "best.start", "best.length", "best.period", "collapsed_text")
