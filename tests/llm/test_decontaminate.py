import random

import numpy as np

from plumbline.llm import decontaminate as d
from plumbline.llm import words


def sellers(item, text):
    """The least distance of item to any part of text, by dynamic programming."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != w), row[i + 1] + 1, new[-1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_bit_parallel_distances_are_those_of_dynamic_programming():
    rnd = random.Random(4)
    for _ in range(300):
        item = [bytes([rnd.choice(b"abcd")]) for _ in range(rnd.randint(1, 90))]
        text = [bytes([rnd.choice(b"abcd")]) for _ in range(rnd.randint(1, 60))]
        assert min([len(item), *d.distances(d.masks(item), len(item), text)]) == sellers(item, text)


def brute(rows, items, rate, least):
    out = set()
    for doc_id, text, *_ in rows:
        for item_id, t in items:
            own = d.normal(t)
            if len(own) >= least:
                score = sellers(own, d.normal(text))
                if score <= int(rate * len(own)):
                    out.add((doc_id, item_id, len(own), score))
    return out


def run(spark, documents, rows, items, rate=0.15):
    bench = spark.createDataFrame([(*i, "more") for i in items], "item_id long, text string, doc_id string")
    return d.found(documents(rows), bench, rate).collect()


def test_planted_and_edited_items(spark, documents, monkeypatch):
    monkeypatch.setattr(d, "BITMAP_BITS", 1 << 9)  # most windows pass the bitmap and meet the table
    monkeypatch.setattr(d, "ITEMS_PER_ROW", 2)
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(6, 60)))) for i in range(40)] + [(50, None), (51, ""), (52, "too short")]
    rows = []
    for doc in range(120):
        parts = [rnd.choices(vocabulary, k=rnd.randint(0, 50)) for _ in range(2)]
        own = (items[rnd.randrange(40)][1]).split()
        for _ in range(rnd.randint(0, max(1, len(own) // 5))):
            at = rnd.randrange(len(own))
            own[at : at + 1] = rnd.choice([[], ["new"], [own[at], "new"]])
        text = " ".join(parts[0] + own + parts[1])
        rows.append((doc, text if doc % 3 else text.upper().replace(" ", ", ")))
    rows += [(500, None), (501, ""), (502, "w1")]
    got = run(spark, documents, rows, items)
    assert {(r["doc_id"], r["item_id"], r["n_words"], r["distance"]) for r in got} == brute(rows, items, 0.15, 1)
    for r in got:
        own, text = d.normal(dict(items)[r["item_id"]]), d.normal(dict(rows)[r["doc_id"]])
        assert sellers(own, text[r["start_word"] : r["end_word"]]) == r["distance"]
        assert sellers(text[r["start_word"] : r["end_word"]], own) <= r["distance"]


def test_given_tables(spark, documents, sample, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = sample[:60]
    got = run(spark, documents, rows, items)
    assert {(r["doc_id"], r["item_id"], r["n_words"], r["distance"]) for r in got} == brute(rows, items, 0.15, 1)


def test_repeats_nulls_and_empty_tables(spark, documents):
    text = "one two three four five six seven eight nine ten"
    got = run(spark, documents, [(1, text), (1, text), (None, "x " + text)], [(7, text), (None, text)])
    assert len(got) == 6 and sum(r["doc_id"] is None for r in got) == 2
    assert run(spark, documents, [], [(7, text)]) == [] and run(spark, documents, [(1, text)], []) == []


def test_short_items_are_found_word_for_word(spark, documents, tmp_path):
    import corpus_pipeline
    from plumbline.llm import queries

    items = [(1, "Which way, north?"), (2, "one two three four five six seven"), (3, "yes"), (4, "?!"), (5, "")]
    rows = [(10, "a which way north b"), (11, "which north way"), (12, "one two three four x five six seven"), (13, "no, no - yes; yes"), (14, None), (15, "one two")]
    rows += [(16, "ends in which"), (17, "way north begins")]  # no item across two documents
    path = str(tmp_path)
    docs = documents(rows)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    got = queries.QUERIES["op9_benchmark_decontamination"].plan(spark, path).collect()
    assert {(r["doc_id"], r["item_id"], r["n_words"], r["distance"]) for r in got} == brute(rows, items, 0.15, 1)
    assert {tuple(r)[:2] + tuple(r)[4:] for r in got} == {(10, 1, 1, 4), (12, 2, 0, 8), (13, 3, 2, 3)}
    left = corpus_pipeline.drop_contaminated(spark, docs, path).collect()
    assert {r["doc_id"] for r in left} == {11, 14, 15, 16, 17}


def test_many_items_in_long_and_repeated_documents(spark, documents):
    """One document holds every item, a third of all rows are copies of another, one text has 200 000 words."""
    rnd = random.Random(5)
    items = [(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(rnd.randint(3, 30)))) for i in range(150)]
    items += [(1000 + i, items[0][1]) for i in range(20)]
    every = " ".join(t for _, t in items[:150])
    filler = " ".join(f"f{i % 977}" for i in range(200_000))
    rows = [(1, every), (2, filler + " " + items[3][1])] + [(3, "x " + items[0][1])] * 30 + [(i, f"plain {i}") for i in range(4, 60)]
    got = run(spark, documents, rows, items)
    pairs = [(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0]
    assert {i for doc, i in pairs if doc == 1} == {i for i, _ in items}
    assert (2, 3) in pairs and sum(doc == 3 for doc, _ in pairs) == 30 * 21
    assert {r["doc_id"] for r in got} == {1, 2, 3}


def test_work_on_the_driver_does_not_grow_with_the_items(spark, monkeypatch):
    monkeypatch.setattr(d, "BITMAP_BITS", 1 << 12)
    monkeypatch.setattr(d, "LEAST_BITS", 1 << 10)
    table = spark.range(100_000).selectExpr("xxhash64(id) AS h").cache()
    assert len(d.bitmap(table, 100_000)) == 64 and len(d.bitmap(table, 1)) == 16
    monkeypatch.setattr(d, "BITMAP_BITS", 1 << 28)
    seen = d.bitmap(table, 100_000)
    hashes = np.array([r.h for r in table.collect()], np.int64).view(np.uint64)
    want = {int(x) & (64 * len(seen) - 1) for h in hashes for x in (h, h >> np.uint64(32))}
    assert len(d.marked(hashes, seen)) == len(hashes)
    assert len(d.marked(words.mix(hashes), seen)) < len(hashes) / 200  # others pass by chance only
    assert {64 * int(w) + b for w in seen.nonzero()[0] for b in range(64) if int(seen[w]) >> b & 1} == want
