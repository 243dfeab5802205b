import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from plumbline.llm import periodic
from plumbline.llm.queries import QUERIES, read_planted


def brute(w):
    """Maximal stretches of every period, those with a smaller period left out."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        kind, n = rnd.random(), rnd.randint(0, 70)
        if kind < 0.4:
            yield [rnd.choice("ab") for _ in range(n)]
        elif kind < 0.7:
            yield sum(([rnd.choice("abc")] * rnd.randint(1, 9) for _ in range(n // 5)), [])
        else:
            p = [rnd.choice("abcd") for _ in range(rnd.randint(1, 8))]
            yield [rnd.choice("xyz") for _ in range(rnd.randint(0, 9))] + p * rnd.randint(2, 9) + p[: rnd.randint(0, len(p))] + [rnd.choice("abcd") for _ in range(rnd.randint(0, 20))]


@pytest.mark.parametrize("seed", range(8))
def test_against_brute_force(seed):
    rows = list(texts(seed))
    rows += rows[:20]
    ids = [np.array([ord(c) for c in t], np.int64) for t in rows]
    assert periodic.runs_of(ids) == [brute(t) for t in rows]
    assert [periodic.direct(t, 6, 4) for t in ids] == [brute(t) for t in rows]


def test_grammar_gives_the_text_back():
    rnd = random.Random(5)
    ids = np.array([rnd.randint(0, 3) if rnd.random() < 0.95 else -1 - i for i in range(3000)])
    places, rules, (sym, start) = periodic.grammar(ids)
    symbol, at = places
    low, middle, high = rules
    for s, a in zip(symbol, at):  # each place of a symbol reads like its first one
        assert np.array_equal(ids[a : a + high[s] - low[s]], ids[low[s] : high[s]])
    assert (low < middle).all() and (middle < high).all()
    pairs = [(a, b) for a, b in zip(sym.tolist(), sym[1:].tolist()) if a >= 0 and b >= 0]
    assert len(set(pairs)) == len(pairs) or all(pairs.count(p) == 1 or p[0] == p[1] for p in set(pairs))
    assert len(sym) < len(ids) / 2


def test_equal_hashes_of_unequal_words_are_found_out():
    """Prefix hashes modulo a power of two take the Thue-Morse word for its complement."""
    word = np.array([bin(i).count("1") % 2 for i in range(1 << 11)])
    ids = np.concatenate([word, 1 - word] * 2 + [word, word, 1 - word, word, word])
    assert periodic.runs_of([ids]) == [periodic.direct(ids, 6, 4)]


def test_long_texts():
    one = np.zeros(300_000, np.int64)
    phrase = np.concatenate([np.arange(1000), np.tile(np.arange(40_000), 5)])
    assert periodic.runs_of([one, phrase]) == [[(0, 300_000, 1)], [(1000, 200_000, 40_000)]]


def expected(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()), digest(b" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_query_on_a_fixture(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, " ".join(t) if i % 9 else None) for i, t in enumerate(texts(11))] + [(None, "a a a a a a a"), (7, ""), (7, ""), (8, "\x0b x " * 8)]
    rows += [(1000 + i, " ".join(rnd.choice("abcdefghij") for _ in range(90))) for i in range(100)]
    spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_words long, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"].plan(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(*r) for r in rows), key=str)


def test_given_documents(documents, sample):
    rows = [(d, t) for d, t, _ in sample if len(t or "") < 3000]
    got = periodic.collapsed(documents(rows), read=read_planted).collect()
    want = {d: expected(d, t) for d, t in rows}
    assert {(r["doc_id"], len(r["runs"]), r["start"], r["length"], r["period"]) for r in got} == {w[:5] for w in want.values()}


def test_empty_table(documents):
    assert periodic.collapsed(documents([])).count() == 0
