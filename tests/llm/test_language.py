import math
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from plumbline.llm import language

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def ways(word, pieces):
    """Every segmentation, by recursion."""
    if not word:
        yield []
    for i in range(1, len(word) + 1):
        piece = word[:i]
        if piece in pieces or i == 1:
            for rest in ways(word[i:], pieces):
                yield [piece, *rest]


def test_sum_over_all_segmentations():
    pieces = ["▁", "▁a", "a", "ab", "b", "ba", "▁ab", "c", "abc"]
    rnd = np.random.default_rng(1)
    chance = np.vstack([rnd.random((len(pieces) + 1, 3)), np.zeros((1, 3))])
    model = language.Model("m", pieces, ["x", "y", "z"], np.log([0.2, 0.3, 0.5]), chance)
    words = ["abc", "aabba", "zab", "b", "abcabc", "qq"]
    at = {p: i for i, p in enumerate(pieces)}
    want = np.array([sum(np.prod([chance[at.get(p, len(pieces))] for p in w], 0) for w in ways("▁" + word, at)) for word in words])
    odds = np.log([0.2, 0.3, 0.5]) + np.log(want).sum(0)
    odds = np.exp(odds - odds.max())
    scorer = language.Scorer(model)
    got = scorer([" ".join(words), None, "12 !", "ABC"])
    assert np.allclose(got[0], odds / odds.sum())
    assert got[1].sum() == got[2].sum() == 0
    one = np.array([0.2, 0.3, 0.5]) * want[0]
    assert np.allclose(got[3], one / one.sum())


def test_expected_counts_against_enumeration(spark):
    pieces = sorted(["▁", "▁a", "a", "ab", "b", "▁ab"])
    rnd = np.random.default_rng(2)
    chance = np.vstack([rnd.random((len(pieces) + 1, 2)), np.zeros((1, 2))])
    rows = [("u", "abab", 3), ("u", "bxa", 2), ("v", "abab", 5), ("v", "b", 1)]
    got = language.expected(spark.createDataFrame(rows, "lang string, word string, n long"), pieces, ["u", "v"], chance)
    want = np.zeros_like(chance)
    at = {p: i for i, p in enumerate(pieces)}
    for lang, word, n in rows:
        k = "uv".index(lang)
        found = [[at.get(p, len(pieces)) for p in w] for w in ways("▁" + word, at)]
        weights = [math.prod(chance[i, k] for i in w) for w in found]
        for w, x in zip(found, weights):
            for i in w:
                want[i, k] += n * x / sum(weights)
    assert np.allclose(got, want)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language.predicted(docs, language.train(docs, VOCABULARY)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r["lang"] == r["lang_pred"] for r in got if r["held_out"]]
    assert sum(held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_rows_are_not_read(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, "der hund und die katze" if i % 2 else "the dog and the cat", "de" if i % 2 else "en") for i in ids]
    rows += [(i, "the dog and the cat", "xx") for i in out]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, VOCABULARY)
    assert model.languages == ["de", "en"]
    assert {r["lang_pred"] for r in language.predicted(docs, model).where("held_out").collect()} == {"en"}


@pytest.mark.parametrize("rows", [[], [(0, "abc", None), (None, "abc", "en")]])
def test_nothing_to_learn(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.predicted(docs, language.train(docs, VOCABULARY)).collect()
    assert sorted((str(r["doc_id"]), r["lang_pred"], r["score"]) for r in got) == sorted((str(r[0]), "und", 0.0) for r in rows)


def test_odd_texts_and_clashing_columns(spark):
    long = "antidis" * 20000
    rows = [(i, "the dog and the cat", "en", 1, "x") for i in (0, 1, 2, 3)] + [(0, "the dog and the cat", "en", 1, "x")]
    rows += [(10, None, "en", 1, "x"), (11, "", "en", 1, "x"), (12, "42 -- \U0001f600", "en", 1, "x"), (13, long, "en", 1, "x")]
    rows += [(14, "世界 नमस्ते ÜBER", "zz", 1, "x"), (None, "the cat", "en", 1, "x")]
    rows += [(20 + i, "le chien et la " + "é" * 3, "fr", 1, "x") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n long, word string")
    got = language.predicted(docs, language.train(docs, VOCABULARY)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert [by[i]["lang_pred"] for i in (10, 11, 12)] == ["und"] * 3
    assert by[13]["lang_pred"] == "en" and by[None]["held_out"] is False and by[21]["lang_pred"] == "fr"


def test_a_word_drops_out_where_no_piece_goes_on():
    lattice = language.Lattice(["a", "ab", "abcd", "c", language.MARK])
    found = {(start, end): dict(zip(at.tolist(), ids.tolist())) for start, end, at, ids in lattice.pieces(["abcd", "abce", "zzzz"])}
    assert found[1, 3] == {0: 1, 1: 1} and found[1, 5] == {0: 2} and (1, 4) not in found
    assert found[1, 2] == {0: 0, 1: 0, 2: lattice.other} and found[3, 4] == {0: 3, 1: 3, 2: lattice.other}


def test_runs_of_one_byte_texts_are_those_of_the_pattern():
    every = "".join(map(chr, range(0x3000)))
    for text in (every, every[:256], "Größe ª½²µ _x1Y", "áb ́c İ"):
        want = [w[i : i + language.STRETCH] for w in language.RUN.findall(text.lower()) for i in range(0, len(w), language.STRETCH)]
        assert language.runs_of(text) == want
    assert [len(f) for f in language.gathered(iter([pd.DataFrame({"text": ["a" * language.GATHERED, None]}), pd.DataFrame({"text": ["b", ""]})]))] == [2, 2]
