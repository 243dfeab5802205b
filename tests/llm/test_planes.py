import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plumbline.llm import planes
from plumbline.session import shared_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    for n in (1, 7, 8, 1000):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        held = [p.tobytes() for p in planes.shuffled(ids, bits)]
        assert len(held) == (32 if bits else 4)
        assert (planes.unshuffled(held, n) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_files_round_trip(spark, documents, sample, bits):
    rows = sample[:60] + [(-3, None), (-2, ""), (10_000, "Long text " * 3000), (10_001, "twice"), (10_001, "twice"), (None, "no id")]
    path = shared_dir(spark, "planes")
    planes.write(documents(rows), path, PATH, end_id=2, block=64, bits=bits)
    out = planes.read(spark, path, with_ids=True).collect()
    whole, at, want = Tokenizer.from_file(PATH), 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        want.append((doc_id, at, len(ids) // 4, zlib.crc32(ids), ids))
        at += len(ids) // 4
    assert [tuple(r)[:4] + (bytes(r["ids"]),) for r in sorted(out, key=lambda r: r["start"])] == want
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    assert sum(r["n_ids"] for r in index) == at and all(len(r["plane_bytes"]) == (32 if bits else 4) for r in index)
    assert [r["start"] for r in index] == list(np.cumsum([0] + [r["n_ids"] for r in index])[:-1])


def test_empty_table(spark, documents):
    path = shared_dir(spark, "planes")
    planes.write(documents([]), path, PATH, end_id=2)
    assert planes.read(spark, path).count() == 0


def test_added_tokens_are_one_id(spark, documents):
    path = shared_dir(spark, "planes")
    planes.write(documents([(1, "a <|endoftext|> b"), (2, "<|startoftext|>")]), path, PATH, end_id=2)
    out = sorted(tuple(r)[:3] for r in planes.read(spark, path).collect())
    assert out == [(1, 0, 4), (2, 4, 2)]
