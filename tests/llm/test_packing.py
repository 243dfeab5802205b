import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from plumbline.llm import packing
from plumbline.llm.tokens import Encoder, encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, "a", " ", "  a  b \n c\n\n d", "x's don't WE'LL", "日本語 é́", "Ωσς ΣΑΣ", "a b   c", "<|endoftext|> hi", "²½ª 12", "a\x1c b\x85 c"]


def test_encoder_equals_the_library():
    rnd = random.Random(1)
    texts = [t or "" for t in ODD] + ["".join(rnd.choice("ab '\n\t  éA1.,😀ß́s") for _ in range(rnd.randint(0, 30))) for _ in range(2000)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        whole, own = Tokenizer.from_file(path), Encoder(path)
        whole.encode_special_tokens = True
        for text in texts:
            assert own.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_cut():
    assert packing.cut(3, 4) == [(0, 3)] and packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)]


def place(counts):
    chosen = packing.plan(np.array(counts))
    got = np.zeros(len(counts), int)
    for lengths, repeats in chosen:
        assert sum(lengths) < len(counts) and repeats > 0
        for length in lengths:
            got[length] += repeats
    assert list(got[1:]) == list(counts[1:])
    return sum(r for _, r in chosen)


def test_plan_places_everything_in_few_sequences():
    assert place([0] * 9) == 0
    assert place([0, 0, 0, 0, 5, 0, 0, 0, 3]) == 6  # pairs of fours, one alone, three full
    rnd = np.random.default_rng(3)
    for capacity in (8, 64, 512):
        counts = rnd.integers(0, 40, capacity + 1)
        counts[0] = 0
        half = capacity // 2  # longer ones stand alone, two of half the capacity share
        least = max(-(-int((counts * np.arange(capacity + 1)).sum()) // capacity), counts[half + 1 :].sum() - (-counts[half] // 2))
        assert place(list(counts)) <= least * 1.05 + 2


def check_places(rows, capacity, docs):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packed_rows(spark, documents, sample):
    rows = sample[:80] + [(-1, None), (-2, ""), (5_000, "same"), (5_000, "same"), (None, "no id")] + [(9_000 + i, "copy of it") for i in range(300)]
    out = packing.packed(documents(rows), PATH, capacity=256).collect()
    whole = Tokenizer.from_file(PATH)
    want, total = [], 0
    for doc_id, text, *_ in rows:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        first = len(ids) % 256 or 256
        bounds = [0] + list(range(first, len(ids) + 1, 256)) if len(ids) > 256 else [0, len(ids)]
        want += [(doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r)[:5] for r in out), key=key) == sorted(want, key=key)
    assert check_places(out, 256, rows) <= -(-total // 256) + 3


def test_slices_do_not_change_the_ranks(documents):
    parts = packing.pieces(documents([(i, "one two") for i in range(500)]), PATH, 16)
    out = packing.pack(parts, 16, rows_per_slice=20).collect()
    assert check_places(out, 16, None) == 100  # five of three ids in sixteen


def test_sequences_hold_the_ids(documents):
    rows = [(i, "word " * i) for i in range(12)]
    out = packing.sequences(documents(rows), PATH, capacity=16).collect()
    whole = Tokenizer.from_file(PATH)
    want = sorted(x for _, t in rows for x in whole.encode(t, add_special_tokens=False).ids + [0])
    assert sorted(int(x) for r in out for x in np.frombuffer(r["ids"], "<u4")) == want
    assert all(len(r["ids"]) <= 64 for r in out)


def test_empty_table(documents):
    assert packing.packed(documents([]), PATH).count() == 0


def test_added_tokens_are_one_id_as_in_the_plain_call(documents):
    rnd = random.Random(7)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "\n", "a", "É", "日本", "it's ", "B b"]
    texts = ["a <|endoftext|> b", "a<|startoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> \n x"]
    texts += ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(1000)] + [t or "" for t in ODD]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        whole = Tokenizer.from_file(path)
        for text in texts:
            assert encoder(path).encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    rows = packing.packed(documents([(1, "a <|endoftext|> b")]), PATH).collect()
    assert [(r["length"], r["ids_crc32"]) for r in rows] == [(5, zlib.crc32(np.array([64, 220, 50256, 275, 0], "<u4").tobytes()))]
