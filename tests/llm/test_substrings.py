import hashlib
import random

import numpy as np

from plumbline.llm import substrings


def brute(rows, size):
    docs = [(d, (t or "").encode().split()) for d, t, *_ in rows]
    first = {}
    for d, w in docs:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            if d is not None:
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - size + 1):
            if d is not None and first[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(documents, rows, size):
    got = substrings.deduplicated(documents(rows), size).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == brute(rows, size)


def passages(seed):
    rnd = random.Random(seed)
    shared = [" ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 40)) for _ in range(n)) for n in (9, 10, 11, 25, 60, 130)]
    rows = []
    for d in range(80):
        parts = [" ".join(str(rnd.randint(0, 999)) for _ in range(rnd.randint(0, 30))) for _ in range(4)]
        parts[1:1] = rnd.sample(shared, rnd.randint(0, 2))
        rows.append((rnd.randint(0, 10**6), " ".join(parts)))
    return rows


def test_shared_passages(documents):
    check(documents, passages(1), 10)
    check(documents, passages(2), 4)


def test_runs_of_one_word_and_copies(documents):
    rows = [(1, "a " * 30), (2, "a " * 12), (3, "b a " * 20), (4, "b a " * 20), (5, "x y z"), (6, "x y z"), (7, None), (8, ""), (9, " \t\n")]
    rows += [(10, "A " * 30), (11, "a a " * 20), (12, "a a " * 25)]
    check(documents, rows, 10)
    check(documents, [(i, "the same words every time and again") for i in range(50)], 6)


def test_repeated_and_null_ids(documents):
    text = "p q r s t u v w x y z"
    check(documents, [(5, text), (5, text), (None, text), (6, "0 " + text), (5, "1 " + text + " 2"), (None, None)], 4)


def test_given_documents(documents, sample):
    check(documents, sample, 50)


def test_doubling_ends_when_nothing_survives(documents):
    long = " ".join(map(str, range(100)))
    rows = [(1, long), (2, "x " + long), (3, " ".join(map(str, range(30))) + " y"), (4, "nothing shared in here at all, not a thing")]
    got = {r["doc_id"]: r["words"] for r in substrings.longest(documents(rows), 10).collect()}
    assert got == {1: 80, 2: 80, 3: 20}
    assert substrings.longest(documents([(1, "a b"), (2, "c d")]), 2).count() == 0


def test_empty_table(documents):
    assert substrings.deduplicated(documents([]), 50).count() == 0


def test_lengths_double_up_to_the_size():
    assert substrings.lengths(50, 13) == [13, 25] and substrings.lengths(50, 7) == [7, 13, 25]
    assert substrings.lengths(50, 40) == [25] and substrings.lengths(2, 13) == [1] and substrings.lengths(9, 2) == [2, 3, 5]


def test_names_are_leftmost_least_hashes():
    rnd = random.Random(4)
    for size, step, n in [(50, 13, 200), (50, 25, 74), (9, 2, 30), (10, 10, 12), (7, 1, 7), (7, 1, 3)]:
        short = np.array([rnd.randint(0, 9) for _ in range(n)], np.uint64)
        inside = size - step + 1
        want = [i + min(range(inside), key=lambda j: (short[i + j], j)) for i in range(n - inside + 1)]
        assert substrings.named(short, size, step).tolist() == want


def test_every_start_gives_the_same(documents):
    rows = passages(3)
    for size, start in [(10, 1), (10, 2), (9, 3), (10, 5)]:
        got = substrings.deduplicated(documents(rows), size, start).collect()
        assert sorted((tuple(r)[:4] for r in got), key=str) == brute(rows, size)


def test_very_long_texts(documents):
    rnd = random.Random(9)
    long = [str(rnd.randint(0, 10**6)) for _ in range(700_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[300_000:300_400])), (3, "x " + " ".join(long[5:60])), (4, "q" * 3_000_000)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substrings.deduplicated(documents(rows), 50).collect()}
    assert got == {1: (700_000, 0), 2: (400, 400), 3: (56, 55), 4: (1, 0)}
