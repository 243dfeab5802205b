import random

import numpy as np

from plumbline.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, class string"


def brute(rows, threshold):
    fine = [(i, np.array(e, np.float32).astype(float), lab) for i, (_, e, lab) in enumerate(rows) if lab is not None and e is not None and all(v is not None and np.isfinite(v) for v in e) and any(e)]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fine)):
        for b in range(a + 1, len(fine)):
            (i, x, p), (j, y, q) = fine[a], fine[b]
            if p == q and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (v, *_) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), v) if x is not None), default=None)
    return sorted(((v, links[i], least[find(i)], v == least[find(i)]) for i, (v, *_) in enumerate(rows)), key=str)


def check(spark, rows, threshold=0.93):
    df = spark.createDataFrame([(v, e, lab, 0, "x") for v, e, lab in rows], SCHEMA)
    assert sorted(map(tuple, vectors.near(df, threshold).collect()), key=str) == brute(rows, threshold)


def clouds(seed, n, dim=16):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        centre = np.random.default_rng(int(rnd.integers(0, 12))).normal(size=dim)
        rows.append((int(1000 * n - 7 * i), [float(np.float32(v)) for v in centre + rnd.normal(size=dim) * rnd.choice([0, 0.05, 0.2, 0.35])], int(rnd.choice([0, 0, 0, 1, 2]))))
    return rows


def test_clouds_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 37)
    monkeypatch.setattr(vectors, "STRIPE", 8)
    check(spark, clouds(1, 300))
    check(spark, clouds(2, 200, dim=3), 0.99)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, nan], 1), (5, [1.0, inf], 1), (6, [1.0, None], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (9, [2.0, 0.0], 1)]
    rows += [(10, [1.0, 0.0], 2), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 1), (12, [1e38, 1e30], 1), (13, [1e-40, 0.0], 1), (14, [-1.0, 0.0], 1)]
    check(spark, rows)


def test_bounds_hold():
    rnd = random.Random(4)
    for dim in (2, 64, 300):
        x = np.array([[rnd.gauss(0, 1) ** 3 for _ in range(dim)] for _ in range(60)])
        u = x / np.linalg.norm(x, axis=1)[:, None]
        q, s, big, lost = vectors.quantised(u)
        about = (q.astype(int) @ q.astype(int).T) * np.outer(s, s)
        assert (np.abs(u @ u.T - about) <= np.outer(big, lost) + lost[:, None] + 1e-12).all()


def test_given_vectors(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(spark, rows)


def test_empty_table(spark):
    assert vectors.near(spark.createDataFrame([], SCHEMA), 0.93).count() == 0
