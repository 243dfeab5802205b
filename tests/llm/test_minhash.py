import random

import numpy as np

from plumbline.llm import minhash, words


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def brute(rows, percent):
    """doc_id -> (n_shingles, component) by comparing all pairs."""
    sets = [(d, grams(t)) for d, t, *_ in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, (_, s) in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for pair in {(i, j) for held in holders.values() for i in held for j in held if i < j}:
        (a, s), (b, t) = sets[pair[0]], sets[pair[1]]
        if 100 * len(s & t) >= percent * len(s | t):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets}


def edited(rnd, text, share):
    return " ".join(w if rnd.random() > share else w + "x" for w in text.split())


def check(documents, rows, percent=85):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near(documents(rows), percent).collect()}
    assert got == brute(rows, percent)


def test_sketch_estimates_similarity():
    rnd = np.random.default_rng(0)
    for size in (1, 3, 40, 5000):
        a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
        assert (minhash.sketch(a) == minhash.sketch(a)).all() and len(minhash.sketch(a)) == minhash.COORDINATES
    shares = []
    for _ in range(30):
        x = rnd.integers(0, 2**63, 300).astype(np.uint64)
        shares.append((minhash.sketch(np.unique(x[:240])) == minhash.sketch(np.unique(x[60:]))).mean())
    assert abs(np.mean(shares) - 0.6) < 0.03 and np.std(shares) < 0.06


def test_window_hashes_are_those_of_the_words():
    h = words.hashed([str(i % 7).encode() for i in range(60)])
    for size in (1, 2, 3, 5, 25, 50):
        got = words.windows(h, size)
        assert len(got) == 61 - size and (got[:-7] == got[7:]).all()
        assert len(set(got.tolist())) == min(7, 61 - size)


def test_small_cases(documents):
    rnd = random.Random(5)
    base = " ".join(rnd.choice("abcdefghij") + str(rnd.randint(0, 300)) for _ in range(200))
    rows = [(9, base), (4, base.upper()), (7, edited(rnd, base, 0.01)), (2, ""), (3, " \n"), (8, "one two"), (6, "One\ttwo"), (11, "one two three"), (12, "é É"), (13, "é é")]
    rows += [(20, "a b c d e f " * 400), (21, "a b c d e f " * 500)]
    check(documents, rows)


def test_groups_of_copies_and_chains(documents, monkeypatch):
    monkeypatch.setattr(minhash, "TILE_ROWS", 16)
    rnd = random.Random(6)
    rows, doc = [], 0
    for _ in range(4):
        base = " ".join(str(rnd.randint(0, 5000)) for _ in range(120))
        for k in range(60):
            rows.append((doc, edited(rnd, base, rnd.choice([0, 0.003, 0.01, 0.02, 0.05]))))
            doc += 1
        chain = base
        for k in range(12):
            chain = edited(rnd, chain, 0.012)
            rows.append((doc, chain))
            doc += 1
    rnd.shuffle(rows)
    check(documents, rows)
    check(documents, rows, 80)


def test_given_documents(documents, sample):
    check(documents, sample)


def test_null_and_repeated_ids(documents):
    text = "some words that are long enough for a shingle or two"
    out = minhash.near(documents([(None, text), (3, text), (3, text), (None, "nothing like it at all here"), (5, None)]), 85).collect()
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in out if r["doc_id"]) == [("3", 3, True), ("3", 3, True), ("5", 5, True)]
    assert sorted((r["component_id"] or -1, r["kept"]) for r in out if r["doc_id"] is None) == [(-1, True), (3, False)]


def test_empty_table(documents):
    assert minhash.near(documents([]), 85).count() == 0


def test_a_large_group_goes_to_tiles_in_proportion(documents, monkeypatch):
    """Near copies of one text, several parts of them: what is sent to tiles grows like the group."""
    monkeypatch.setattr(minhash, "TILE_ROWS", 16)
    sent = []
    real = minhash.outside
    monkeypatch.setattr(minhash, "outside", lambda *a: sent.append(real(*a).count()) or real(*a))
    totals = []
    for n in (150, 300):
        rnd = random.Random(n)
        base = " ".join(str(rnd.randint(0, 5000)) for _ in range(300))
        rows = [(d, edited(rnd, base, 0.004)) for d in range(n)] + [(n + d, edited(rnd, base, 0.025)) for d in range(6)]
        sent.clear()
        check(documents, rows)
        totals.append(sum(sent))
    assert totals[1] < 3 * totals[0] + 2000


def test_leaders_lose_no_link_between_parts(documents, monkeypatch):
    monkeypatch.setattr(minhash, "TILE_ROWS", 4)
    for seed in range(3):
        rnd = random.Random(seed)
        base = " ".join(str(rnd.randint(0, 5000)) for _ in range(100))
        other = " ".join([*base.split()[:80], *(str(rnd.randint(0, 5000)) for _ in range(20))])
        texts = [edited(rnd, rnd.choice([base, other]), rnd.choice([0, 0.008, 0.02, 0.03])) for _ in range(70)]
        check(documents, [(d, t) for d, t in enumerate(texts)])
    rows = [(5, texts[0]), (5, texts[1]), *[(10 + i, t) for i, t in enumerate(texts[2:40])]]
    out = minhash.near(documents(rows), 85).collect()
    assert len(out) == len(rows) and all(r["component_id"] <= r["doc_id"] for r in out)


def test_components_of_edges_in_one_task_need_no_round(spark, monkeypatch):
    from plumbline.llm import common

    written = []
    monkeypatch.setattr(common, "saved", lambda df, name, plain=common.saved: written.append(name) or plain(df, name))
    chain = [(i, i + 1) for i in range(200)] + [(1000, 999), (5000, 4000), (4000, 4000), (None, 3)]
    want = {i: 0 for i in range(201)} | {999: 999, 1000: 999, 4000: 4000, 5000: 4000}
    for parts, most in ((1, 1), (7, 30)):
        edges = spark.createDataFrame(chain, "a long, b long").repartition(parts)
        written.clear()
        assert {r.id: r.component for r in common.components(edges).collect()} == want
        assert len(written) <= most
    assert common.stars(np.array([9, 7, 5, 1]), np.array([7, 5, 3, 2])).values.tolist() == [[2, 1], [5, 3], [7, 3], [9, 3]]
