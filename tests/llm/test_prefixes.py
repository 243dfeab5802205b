import hashlib
import random
import zlib

import pytest

from plumbline.llm import prefixes
from plumbline.llm.queries import QUERIES, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, pos int, n long, head string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)


def rebuild(rows):
    talks = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        talks.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = talks.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(talks):
    nodes = {}
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) or 1
        saved[p] = (len(nodes[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[q] for q in below)
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), len(children.get(p, [])), leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(talks[c]) == len(p)).encode()).hexdigest())
        for p, m in nodes.items()
    )


def got(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def talks(seed, n):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rnd.choice([rnd.randint(0, 40), rnd.randint(100, 140), rnd.randint(0, 5000)])
        for t in range(rnd.choice([0, 1, 2, 3, 7, 12])):
            rows.append((c, rnd.choice([t, t, t, None]), rnd.choice(["user", "user", "assistant", None]), rnd.choice(["a", "a", "a", "bé", "", None, "cc" * rnd.randint(1, 3)])))
    return rows


@pytest.mark.parametrize("seed,container,first", [(1, 2000, 64), (2, 5, 4), (3, 1, 2), (4, 3, 1)])
def test_against_brute_force(spark, seed, container, first):
    rows = talks(seed, 120)
    assert got(prefixes.trie(rebuilt(table(spark, rows)), container, first)) == brute(rebuild(rows))


def test_copies_and_deep_shared_prefixes(spark):
    base = [("user", f"u{i}" * (i % 3 + 1)) for i in range(30)]
    rows = [(c, t, *x) for c in (100, 101, 102, 103, 207, 311) for t, x in enumerate(base)]
    rows += [(c, t, *x) for c in (400, 401, 402) for t, x in enumerate([*base[:20], ("user", "other")])]
    rows += [(c, t, *x) for c in (500, 555) for t, x in enumerate(base[:11])] + [(c, 0, None, None) for c in range(600, 610)]
    rows += [(7, 3, "user", "alone"), (None, 0, "user", "lost"), (600, 0, None, None)]
    for container in (1, 4, 100):
        for first in (1, 8):
            assert got(prefixes.trie(rebuilt(table(spark, rows)), container, first)) == brute(rebuild(rows)), (container, first)


def test_one_long_conversation_in_slices(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "SLICE_ROWS", 500)
    rows = [(300, t, "user", f"t{t}") for t in range(3000)] + [(301, t, "user", f"t{t}") for t in range(2500)] + [(302, 0, "user", "x" * 200_000)]
    assert got(prefixes.trie(rebuilt(table(spark, rows)), 1)) == brute(rebuild(rows))


def test_query_on_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_prefix_trie"].plan(spark, sf_dir)) == brute(rebuild(rows))


def test_empty_table(spark):
    assert prefixes.trie(rebuilt(table(spark, []))).count() == 0
