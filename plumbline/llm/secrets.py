"""Secrets in texts: fixed patterns, and character Markov models compared by log-likelihood ratio.

DataFrame operations only. Two first-order models are trained from labelled samples, one of random
strings and one of ordinary identifiers; both are tables of at most 67 * 66 bigram counts. A run of
LONG or more token characters outside the pattern spans, or what they leave of it, is added when the random model explains it
better by at least RATIO in natural logarithm.

Positions are code points, ends exclusive. Null texts are empty and have no spans; repeated rows and
null ids are judged like any other. Without samples nothing is added to the patterns. An empty table
gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import ready

# The patterns, and the kinds in their order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "model"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_="

TOKEN = r"[A-Za-z0-9+/_=]"
LONG, WORD = 16, 8
RATIO = 12.0
#: Labelled rows: documents of each kind that samples are drawn from at most.
SAMPLE_DOCS = 2000
BLOCK = 256
SPANS = "array<struct<start:int,rank:int,end:int,value:string>>"


def _matches(pieces: str, found: str, rank: int) -> Column:
    """Spans of the matches, from the texts between them and the matches themselves.

    Matches are taken in blocks, each with places of its own, and the blocks are then moved to theirs, so
    that no array grows by one element at a time over all matches.
    """
    one = f"""named_struct('start', a.at + length({pieces}[i - 1]), 'rank', {rank},
        'end', a.at + length({pieces}[i - 1]) + length({found}[i - 1]), 'value', {found}[i - 1])"""
    block = f"""aggregate(sequence(k * {BLOCK} + 1, least((k + 1) * {BLOCK}, size({found}))), named_struct('at', 0, 'out', cast(array() AS {SPANS})),
        (a, i) -> named_struct('at', a.at + length({pieces}[i - 1]) + length({found}[i - 1]), 'out', concat(a.out, array({one}))))"""
    return F.expr(
        f"""CASE WHEN size({found}) > 0 THEN aggregate(transform(sequence(0, cast((size({found}) - 1) div {BLOCK} AS int)), k -> {block}),
        named_struct('at', 0, 'out', cast(array() AS array<{SPANS}>)),
        (t, b) -> named_struct('at', t.at + b.at, 'out', concat(t.out, array(transform(b.out, s -> named_struct(
            'start', s.start + t.at, 'rank', s.rank, 'end', s.end + t.at, 'value', s.value))))),
        t -> flatten(t.out)) ELSE cast(array() AS {SPANS}) END"""
    )


def located(df: DataFrame, pattern: str, rank: int, out: str) -> DataFrame:
    """df with the spans of all leftmost non-overlapping matches in text."""
    here = F.rlike("text", F.lit(pattern))
    cut = df.withColumn("_pieces", F.when(here, F.split("text", pattern, -1))).withColumn("_found", F.when(F.col("_pieces").isNotNull(), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    return cut.withColumn(out, _matches("_pieces", "_found", rank)).drop("_pieces", "_found")


def patterns(docs: DataFrame) -> DataFrame:
    """doc_id, text, base (the spans of the fixed patterns by start, then kind), and those of each kind as _0, _1, _2."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for rank, pattern in enumerate((ASSIGN, ACCESS, HEX)):
        rows = located(rows, pattern, rank, f"_{rank}")
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    assigned = F.filter("_0", lambda s: F.length(value(s)) >= 6)
    rows = rows.withColumn("_0", assigned)
    return rows.select("doc_id", "text", F.array_sort(F.concat("_0", "_1", "_2")).alias("base"), *[f"_{rank}" for rank in range(3)])


def least(docs: DataFrame, kind: Column) -> DataFrame:
    """doc_id and text of the SAMPLE_DOCS rows of a kind with the least hash, equal rows once.

    Hashes are ranked without the texts; the texts of those up to the last one are read after that.
    """
    place = F.struct(F.xxhash64("doc_id", "text").alias("h"), F.col("doc_id").alias("id"))
    last = docs.where(kind).select(place.alias("at")).orderBy("at").limit(SAMPLE_DOCS).agg(F.max("at")).scalar()
    near = docs.select("doc_id", "text", place.alias("at")).where(F.col("at") <= last)
    return near.where(kind).dropDuplicates(["at"]).select("doc_id", "text")


def samples(docs: DataFrame) -> DataFrame:
    """(value, secret): values of pattern matches, and words of WORD or more characters of texts without any.

    Drawn from at most SAMPLE_DOCS documents of each kind, those of the least hash of doc_id and text.
    """
    text = F.coalesce("text", F.lit(""))
    has = F.rlike(text, F.lit("|".join((ASSIGN, ACCESS, HEX))))
    secret = patterns(least(docs, has)).select(F.explode("base").alias("s"))
    secret = secret.select(F.when(F.col("s.rank") == 0, F.regexp_extract("s.value", ASSIGN, 2)).otherwise(F.col("s.value")).alias("value"), F.lit(True).alias("secret"))
    plain = least(docs, ~has)
    words = F.regexp_extract_all("text", F.lit(f"{TOKEN}{{{WORD},}}"), F.lit(0))
    return secret.unionByName(plain.select(F.explode(words).alias("value"), F.lit(False).alias("secret")))


def train(labelled: DataFrame) -> list[float] | None:
    """Log ratio of every bigram, row by row of ALPHABET, the last row for a token's first character.

    Add-one smoothing; None where one of the two kinds has no sample.
    """
    clean = labelled.select("secret", F.regexp_replace("value", f"[^{ALPHABET}]", "").alias("v")).where("length(v) > 0 AND secret IS NOT NULL")
    pairs = clean.select("secret", F.explode(F.concat(F.array(F.substring("v", 1, 1)), _pairs(F.col("v"), lambda a, b: F.concat(a, b)))).alias("pair"))
    counts = {(r["secret"], r["pair"]): r["count"] for r in pairs.groupBy("secret", "pair").count().collect()}  # at most 2 * 67 * 66 rows
    if len({kind for kind, _ in counts}) < 2:
        return None
    totals: Counter = Counter()
    for (kind, pair), n in counts.items():
        totals[kind, pair[:-1]] += n
    n = len(ALPHABET)
    chance = lambda kind, a, b: math.log((counts.get((kind, a + b), 0) + 1) / (totals[kind, a] + n))
    return [round(chance(True, a, b) - chance(False, a, b), 6) for a in [*ALPHABET, ""] for b in ALPHABET]


def _pairs(token: Column, of) -> Column:
    """of(a, b) for every two neighbouring characters; the token is cut into characters once for each side."""
    n = F.length(token)
    cut = F.split(token, "")
    return F.zip_with(F.slice(cut, 1, F.greatest(n - 1, F.lit(0))), F.slice(cut, 2, F.greatest(n - 1, F.lit(0))), of)


def _count(spans: str, at: str, limit: str) -> str:
    """How many of the ascending, disjoint spans have `at` <= limit, by binary search."""
    steps = ", ".join(str(1 << i) for i in range(24, -1, -1))
    return f"aggregate(array({steps}), 0, (c, s) -> IF(c + s <= size({spans}) AND {spans}[c + s - 1].{at} <= {limit}, c + s, c))"


def _uncovered() -> Column:
    """The parts of _runs outside the base spans that have LONG or more characters.

    The spans of each kind ascend, so those that meet a run are a stretch of them.
    """
    part = lambda a, b: (
        f"""IF({b} - {a} >= {LONG}, array(named_struct('start', {a}, 'rank', r.rank, 'end', {b},
        'value', substring(r.value, {a} - r.start + 1, {b} - {a}))), cast(array() AS {SPANS}))"""
    )
    meet = ", ".join(
        f"slice({k}, {_count(k, 'end', 'r.start')} + 1, greatest({_count(k, 'start', 'r.end - 1')} - {_count(k, 'end', 'r.start')}, 0))" for k in ("_0", "_1", "_2")
    )
    return F.expr(
        f"""CASE WHEN size(base) = 0 THEN _runs ELSE flatten(transform(_runs, r -> aggregate(array_sort(concat({meet})),
        named_struct('at', r.start, 'out', cast(array() AS {SPANS})),
        (a, b) -> named_struct('at', greatest(a.at, b.end), 'out', concat(a.out, {part("a.at", "b.start")})),
        a -> concat(a.out, {part("a.at", "r.end")})))) END"""
    )


def ratio(token: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of a token of ALPHABET's characters."""
    n = len(ALPHABET)
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    place = lambda c: F.position(c, F.lit(ALPHABET))
    first = F.element_at(table, (n * n + place(F.substring(token, 1, 1))).cast("int"))
    steps = _pairs(token, lambda a, b: F.element_at(table, ((place(a) - 1) * n + place(b)).cast("int")))
    return F.aggregate(steps, first, lambda total, x: total + x)


def scan(docs: DataFrame, model: list[float] | None) -> DataFrame:
    """doc_id, base and added: the pattern spans, and the model's spans that overlap none of them."""
    ready(docs.sparkSession)
    rows = patterns(docs)
    none = F.array().cast(SPANS)
    if model is None:
        return rows.select("doc_id", "base", none.alias("added"))
    rows = located(rows, f"{TOKEN}{{{LONG},}}", KINDS.index("model"), "_runs")
    rows = rows.withColumn("_free", _uncovered())
    return rows.select("doc_id", "base", F.filter("_free", lambda r: ratio(r["value"], model) >= RATIO).alias("added"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")

