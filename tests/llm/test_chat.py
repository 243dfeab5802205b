import hashlib
import random

import pytest

from plumbline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, number long, valid string"
PIECES = ["\\", "### ", "#", "</turn>", "<", "/turn>", "Assistant: ", "\n", "é😀", " ", "@", ":", "ok", "### User: "]


def brute(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {
        c: (len(t), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(), sum(len(x) for r, x in t if r == "assistant"), hashlib.sha256("".join(x for r, x in t if r == "assistant").encode()).hexdigest())
        for c, t in out.items()
    }


def run(spark, rows):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    return {r["conv_id"]: r for r in chat.digests(chat.formatted(df)).collect()}


def check(spark, rows):
    got = run(spark, rows)
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == brute(rows)
    return got


def test_control_strings_come_back(spark):
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice(["system", "user", "assistant", "tool: x", "a\\b", "### ", None, ""]), "".join(rnd.choices(PIECES, k=rnd.randint(0, 12)))) for c in range(60) for t in range(rnd.randint(1, 9))]
    check(spark, rows + [(None, 1, "user", "x"), (None, None, "assistant", None), (2**60 + 1, 0, "user", "y")])


@pytest.mark.parametrize("role", ["user", "assistant", "odd:role\\", "@", "### x"])
def test_one_turn_round_trip(role):
    writer = chat.Writer(chat.PLAIN)
    for text in ["", "\\", "\\### Assistant: </turn> ok", "#" * 7 + " ", "<</turn>", "a\n</turn>\n### User: b"]:
        parts = writer.segments(role, text)
        assert writer.parse("".join(p for p, _ in parts)) == (role, text)
        assert writer.unescape(writer.escape(text)) == text


def test_machine(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "assistant", "a"), (3, 0, "user", "u"), (3, 1, "user", "u"), (4, 0, "tool", "t"), (4, 1, "user", "u")]
    got = check(spark, rows)
    assert {c: r["valid"] for c, r in got.items()} == {1: True, 2: False, 3: False, 4: False}
    assert got[1]["formatted_chars"] == len("### System: s</turn>\n### User: u</turn>\n### Assistant: a</turn>\n")


def test_long_conversation_and_ties(spark):
    rows = [(7, t // 2, ["user", "assistant"][t % 2], f"t{t}" * 10) for t in range(3000)] + [(8, 1, "user", "same"), (8, 1, "user", "same")]
    check(spark, rows)


def test_given_and_empty(spark, sf_dir):
    check(spark, [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])
    assert run(spark, []) == {}
