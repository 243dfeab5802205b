import random
from collections import defaultdict

from plumbline.llm import sites


def brute(rows, least):
    spread, first = defaultdict(set), {}
    for d, t, s in rows:
        for x in (t or "").split("\n"):
            spread[x].add(s)
            if d is not None:
                first[x] = min(d, first.get(x, d))
    out = []
    for d, t, s in rows:
        kept, seen, lines = [], set(), [] if t is None else t.split("\n")
        for x in lines:
            if x == "" or len(spread[x]) < least or (d is not None and first[x] == d and x not in seen):
                kept.append(x)
            seen.add(x)
        out.append((d, None if t is None else "\n".join(kept), s, len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def check(documents, rows, least):
    out = sites.cleaned(documents(rows), least)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "length", "h", "n_lines", "n_removed"]
    assert sorted(((r["doc_id"], r["text"], r["source"], r["n_lines"], r["n_removed"]) for r in out.collect()), key=str) == brute(rows, least)


def test_spread_of_lines(documents):
    rnd = random.Random(2)
    shared = [f"line {i} é" for i in range(30)] + ["", " "]
    rows = []
    for d in range(150):
        lines = rnd.choices(shared, k=rnd.randint(0, 8)) + [f"own {d}"] * rnd.randint(0, 2)
        rnd.shuffle(lines)
        rows.append((d, "\n".join(lines), f"s{min(rnd.randint(0, 20), rnd.randint(0, 20))}"))
    rows += [(900, None, "s1"), (901, "", None), (902, "line 1 é\nline 1 é\n\n", None), (None, "line 2 é", "s2"), (903, "x", "s0"), (903, "line 3 é", "s0")]
    for least in (2, 8, 12):
        check(documents, rows, least)


def test_near_and_far_from_the_threshold(documents):
    rows = [(1000 * n + i, f"on {n}", f"site {i}") for n in (38, 39, 40, 41, 42, 300) for i in range(n)]
    check(documents, rows, 40)


def test_empty_table(documents):
    assert sites.cleaned(documents([]), 3).count() == 0


def test_a_text_of_many_common_lines(documents):
    lines = [f"common line {i}" for i in range(1000)]
    rows = [(d, "\n".join(lines), f"s{d}") for d in range(4)] + [(9, "\n".join(lines * 100), "s9"), (0, "\n".join(lines * 2), "s0")]
    check(documents, rows, 3)
