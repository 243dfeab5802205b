import random
import zlib

import numpy as np

from plumbline.llm import toxicity


def fixture(documents, spark, n=600, seed=1):
    """Insults make a text toxic; in the learnt rows insults name one group far more often."""
    rnd = random.Random(seed)
    plain = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for d in range(n):
        toxic = d % 3 == 0
        own = rnd.choices(plain, k=rnd.randint(3, 60))
        if toxic:
            own.insert(rnd.randrange(len(own)), rnd.choice(["idiot", "scumbag", "moronic"]))
        if rnd.random() < (0.9 if toxic else 0.05):
            own.insert(rnd.randrange(len(own)), "muslim")
        if rnd.random() < 0.3:
            own.insert(rnd.randrange(len(own)), "christian")
        rows.append((d, " ".join(own)))
        labels.append((d, 1, int(toxic), "x"))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"), rows


def test_held_out_rows_are_told_apart_and_group_mentions_are_neutral(spark, documents):
    docs, labels, rows = fixture(documents, spark)
    model = toxicity.train(docs, labels)
    out = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in out.items())
    held = [d for d, r in out.items() if r["held_out"]]
    right = sum(out[d]["predicted"] == int(d % 3 == 0) for d in held) / len(held)
    assert right > 0.95
    score = toxicity.Scorer(model)
    free = toxicity.Scorer(toxicity.train(docs, labels, swap=0.0))
    gap = lambda s: abs(s("they are muslim people") - s("they are christian people"))
    assert gap(score) < 0.25 * gap(free)


def test_learns_nothing_from_held_out_labels(spark, documents):
    docs, labels, _ = fixture(documents, spark, 200)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (a.features == b.features).all() and np.allclose(a.weights, b.weights) and a.intercept == b.intercept


def test_odd_rows(spark, documents):
    docs, labels, _ = fixture(documents, spark, 100)
    model = toxicity.train(docs, labels.unionByName(spark.createDataFrame([(None, 1, 1, ""), (3, 1, None, ""), (3, 0, 1, ""), (10**9, 1, 1, "")], labels.schema)))
    out = toxicity.scored(documents([(None, "idiot"), (1, None), (1, ""), (1, "idiot " * 5), (1, "idiot " * 5)]), model).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    base = 1 / (1 + np.exp(-model.intercept))
    assert sorted(r["score"] for r in out)[:2] == [base, base]


def test_one_class_or_no_labels(spark, documents):
    docs, labels, _ = fixture(documents, spark, 60)
    none = toxicity.scored(docs, toxicity.train(docs, labels.limit(0))).collect()
    assert len(none) == 60 and all(r["score"] < 1e-9 for r in none)
    ones = toxicity.scored(docs, toxicity.train(docs, labels.where("toxic = 1"))).collect()
    assert all(r["score"] > 0.999 for r in ones)
    assert toxicity.scored(documents([]), toxicity.train(documents([]), labels)).count() == 0


def test_gradient_vanishes_at_the_fit():
    rnd = np.random.default_rng(0)
    x = (rnd.random((300, 20)) < 0.3).astype(np.float32)
    y = (rnd.random(300) < 1 / (1 + np.exp(-(x[:, 0] * 3 - 1)))).astype(float)
    change = (rnd.random((40, 20)) < 0.1).astype(np.float32)
    w, b = toxicity.fit(x, y, change, 0.01, 0.5, rounds=4000)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) / 300 + 0.01 * w + 0.5 * change.T @ (change @ w) / 40).max() < 1e-4 and abs((p - y).mean()) < 1e-4


def test_repeated_ids_stay_within_the_sample(spark, documents, monkeypatch):
    docs, labels, rows = fixture(documents, spark, 120)
    seen, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda x, *rest: seen.append(len(x)) or fit(x, *rest))
    twice = documents(rows + [rows[0]] * 200)
    a, b = toxicity.train(docs, labels), toxicity.train(twice, labels)
    assert seen[0] == seen[1] and (a.features == b.features).all() and np.allclose(a.weights, b.weights) and a.intercept == b.intercept
    many = documents([(d, f"{text} more{i}") for d, text in rows for i in range(8)])
    toxicity.train(many, labels, sample=25)
    assert seen[2] == 50


def test_scores_from_the_weights_alone(spark, documents):
    """Scores once more in plain Python from features, weights and intercept."""
    import math
    import string

    from xxhash import xxh32_intdigest

    docs, labels, rows = fixture(documents, spark, 200)
    model = toxicity.train(docs, labels)
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))

    def score(text):
        clean = "".join(" " if c in string.punctuation else c for c in text.lower())
        parts = {x for w in map(str.encode, clean.split()) for x in [w + b"$", *(w[:n] for n in (4, 5, 6, 7) if len(w) >= n)]}
        return 1 / (1 + math.exp(-model.intercept - sum(weight.get(f, 0.0) for f in {xxh32_intdigest(p) % (1 << 20) for p in parts})))

    rows += [(1000, "Idiot, IDIOT! é-scumbag... " + "word1 " * 200_000), (1001, "")]
    got = {r["doc_id"]: r for r in toxicity.scored(documents(rows), model).collect()}
    assert all(abs(got[d]["score"] - score(t)) < 1e-9 and got[d]["predicted"] == int(got[d]["score"] >= 0.3) for d, t in rows)
    assert 0 < model.swapped < model.fitted
