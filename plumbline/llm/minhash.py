"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its distinct word shingles (A-Z in lower case; with fewer words than a
shingle, the whole sequence). Its sketch has COORDINATES places, filled in rounds: in a round every
shingle is hashed to one place and one value, and empty places take the least value; after
COORDINATES rounds, round r sends every shingle to place r - COORDINATES, so every place gets filled.
Two sketches agree in a place with the probability of their sets' similarity, with concentration
bounds like independent minima, at about one pass over the set.

1. Equal word sequences become one class.
2. Bands of the sketch put classes into buckets. Inside a bucket sketches are compared, and a forest of
   the pairs whose estimate reaches the threshold less a margin is kept: no more links than members,
   whatever the size of a group.
3. The components of those links are candidate groups. Each class goes with its text to its group, where
   pairs not yet connected are verified on the full sets.
4. The components of the verified links are the result.

A null or empty text, or one without words, has no shingles and links with nothing. Rows with one
doc_id are judged each by its text.

A bucket or group of more than a tile is first compared with a few leaders, each of them with all members,
in passes that are linear in its size. Who is linked to a leader belongs to the leader's part; a later
leader's members join the part if it shares one with it. Only what stays outside the part goes to tiles
with all members, so pairs of one part are never formed, and no link between parts is lost.

A row without doc_id can't name a group: its component_id is that
of its copies if one has an id, else null, and it counts as kept only if null. An empty table gives
no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from plumbline.llm import words
from plumbline.llm.common import across, components, numbered, ready, runs, saved, slices, spread, tiled, unnumbered

SHINGLE = 5
COORDINATES = 256
BANDS, BAND = 32, 5
#: A true pair falls below threshold minus margin with a probability under 1e-5 (4.5 deviations).
DEVIATIONS = 4.5
TILE_ROWS = 1024
TILE_CHARS = 4_000_000
#: Members that a large bucket or group is compared with before tiles.
LEADERS = 3
LINK = "a long, b long"


def sketch(shingles: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """The 32-bit sketch of a non-empty set of 64-bit shingle hashes."""
    best = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    rounds = max(1, min(2 * size, -(-2 * size // len(shingles))))
    for first in range(0, 2 * size, rounds):
        r = np.arange(first, min(first + rounds, 2 * size), dtype=np.uint64)[:, None]
        h = words.mix(shingles[None, :] + (r + np.uint64(1)) * words.BASE)
        place = np.where(r < size, h % np.uint64(size), r - np.uint64(size)).astype(np.int64)
        np.minimum.at(best, place.ravel(), ((r << np.uint64(32)) | (h >> np.uint64(32))).ravel())
        if best.max() < np.iinfo(np.uint64).max:
            break
    return (words.mix(best) >> np.uint64(32)).astype(np.uint32)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, key (of the word sequence), bands (hash of each), print (a byte a place)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * words.BASE
        for batch in batches:
            for frame in slices(batch, "text"):
                rows = []
                for doc_id, text, text_hash in zip(frame["doc_id"], frame["text"], frame["text_hash"]):
                    own = words.split(text, lower=True)
                    grams = words.shingles(words.hashed(own), SHINGLE)
                    if not len(grams):
                        rows.append((doc_id, text_hash, 0, None, None, None))
                        continue
                    places = sketch(grams)
                    band = salt.copy()
                    for part in places[: BANDS * BAND].reshape(BANDS, BAND).T:
                        band = words.mix(band ^ part.astype(np.uint64)) * words.BASE
                    rows.append((doc_id, text_hash, len(grams), xxh3_128_digest(b" ".join(own)), band.view(np.int64), (places & 0xFF).astype(np.uint8).tobytes()))
                out = pd.DataFrame(rows, columns=["doc_id", "text_hash", "n_shingles", "key", "bands", "print"])
                yield out

    rows = docs.select(numbered(), "text", F.xxhash64("text").alias("text_hash"))
    return unnumbered(rows.mapInPandas(run, "doc_id long, text_hash long, n_shingles long, key binary, bands array<long>, print binary"))


def led(members: DataFrame, key: str, payload: str, check: Callable, leaders: int = LEADERS) -> tuple[DataFrame, DataFrame]:
    """(links with leaders, members outside the part), for groups of more than a tile.

    check(batch) says for each row whether its payload is like its leader's (column lead). A leader is the
    smallest rep outside the part, and is compared with every member, so it needs no tile.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for frame in slices(batch, payload):
                out = frame[[key, "rep", "leader", "inside"]].copy()
                out["same"] = check(frame)
                yield out

    state = members.select(key, "rep").distinct().withColumns({"inside": F.lit(False), "done": F.lit(False)})
    links = None
    for turn in range(leaders):
        first = state.where("NOT inside AND NOT done").groupBy(key).agg(F.min("rep").alias("leader"))
        lead = members.select(key, F.col("rep").alias("leader"), F.col(payload).alias("lead")).join(first, [key, "leader"])
        pairs = members.select(key, "rep", payload).join(state.select(key, "rep", "inside"), [key, "rep"]).join(lead, key)
        seen = saved(pairs.mapInPandas(run, f"{key} long, rep long, leader long, inside boolean, same boolean"), "led")
        found = seen.where("same AND rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b"))
        links = found if links is None else links.unionByName(found)
        joins = seen.groupBy(key).agg(F.max(F.col("same") & (F.col("inside") | F.lit(turn == 0))).alias("joins"))
        now = seen.join(joins, key).groupBy(key, "rep").agg(F.max(F.col("inside") | (F.col("joins") & F.col("same"))).alias("inside"), F.max(F.col("rep") == F.col("leader")).alias("led"))
        state = saved(state.drop("inside").join(now, [key, "rep"]).withColumn("done", F.col("done") | F.col("led")).drop("led"), "state")
    return links, state.where("NOT inside AND NOT done").select(key, "rep")


def outside(members: DataFrame, rest: DataFrame, key: str) -> DataFrame:
    """Every member outside the part once for each tile of all members, and each member once for each tile of
    those outside, in runs of (key, low, high): `mine` marks the rows outside, which are to be compared with the others."""
    sizes = rest.groupBy(key).agg(F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("cuts"))
    parts = lambda n: F.pmod(F.xxhash64("rep", F.lit(11)), n).cast("int")
    other = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    every = members.join(sizes, key).withColumn("mine", F.lit(False)).withColumn("high", parts(F.col("blocks"))).withColumn("low", other(F.col("cuts")))
    few = members.join(rest, [key, "rep"]).join(sizes, key).withColumn("mine", F.lit(True)).withColumn("low", parts(F.col("cuts"))).withColumn("high", other(F.col("blocks")))
    both = every.unionByName(few.select(*every.columns)).drop("blocks", "cuts")
    return both.repartition(key, "low", "high").sortWithinPartitions(key, "low", "high")


def forest(members: DataFrame, least: int) -> DataFrame:
    """Links (a, b) that connect all pairs of a bucket whose sketches agree in `least` places."""

    def alike(frame: pd.DataFrame) -> np.ndarray:
        both = [np.frombuffer(b"".join(frame[c]), np.uint8).reshape(len(frame), -1) for c in ("print", "lead")]
        return (both[0] == both[1]).sum(1) >= least

    def across_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches, ["bucket", "low", "high"]):
            prints, mine = np.frombuffer(b"".join(run["print"]), np.uint8).reshape(len(run["rep"]), -1), run["mine"].astype(bool)
            a, b, others = [], [], np.flatnonzero(~mine)
            for at in np.flatnonzero(mine).tolist():
                near = others[(prints[others] == prints[at]).sum(1) >= least]
                a += [run["rep"][at]] * len(near)
                b += run["rep"][near].tolist()
            yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = [], []
        for run in runs(batches, ["bucket", "low", "high"]):
            n = len(run["rep"])
            if n < 2:
                continue
            prints = np.frombuffer(b"".join(run["print"]), np.uint8).reshape(n, -1)
            reps = run["rep"].tolist()
            for x, y in spread(np.arange(n), lambda at, rest: ((prints[rest] == prints[at]).sum(1) >= least) & across(run, rest, at)):
                a.append(reps[x])
                b.append(reps[y])
            if len(a) > 10_000:
                yield pd.DataFrame({"a": a, "b": b})
                a, b = [], []
        yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    one = tiled(members.where("blocks = 1"), "bucket", "rep").mapInPandas(find, LINK)
    large = saved(members.where("blocks > 1"), "large")
    if not large.isEmpty():
        links, rest = led(large, "bucket", "print", alike)
        one = one.unionByName(links).unionByName(outside(large, rest, "bucket").mapInPandas(across_tiles, LINK))
    return one.where("a <> b").distinct()


def shingled(text: str | None) -> np.ndarray:
    return words.shingles(words.hashed(words.split(text, lower=True)), SHINGLE)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def verified(members: DataFrame, percent: int, least: int) -> DataFrame:
    """Links (a, b) that connect all documents of a group whose full sets are similar enough."""

    def alike_leader(frame: pd.DataFrame) -> np.ndarray:
        leaders: dict[int, np.ndarray] = {}
        out = []
        for text, leader, lead in zip(frame["text"], frame["leader"], frame["lead"]):
            if leader not in leaders:
                leaders = {leader: shingled(lead)} if len(leaders) > 64 else leaders | {leader: shingled(lead)}
            out.append(similar(shingled(text), leaders[leader], percent))
        return np.array(out, bool)

    def across_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches, ["group", "low", "high"]):
            sets, mine, a, b = [shingled(t) for t in run["text"]], run["mine"].astype(bool), [], []
            for at in np.flatnonzero(mine).tolist():
                near = [i for i in np.flatnonzero(~mine).tolist() if similar(sets[at], sets[i], percent)]
                a += [run["rep"][at]] * len(near)
                b += run["rep"][near].tolist()
            yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches, ["group", "low", "high"]):
            sets = [shingled(t) for t in run["text"]]
            full = np.array([len(s) > 0 for s in sets])
            prints = np.stack([(sketch(s) & 0xFF).astype(np.uint8) if len(s) else np.zeros(COORDINATES, np.uint8) for s in sets])
            sizes = np.array([len(s) for s in sets])

            def alike(at: int, rest: np.ndarray) -> np.ndarray:
                size, other = sizes[at], sizes[rest]
                maybe = ((prints[rest] == prints[at]).sum(1) >= least) & (100 * np.minimum(size, other) >= percent * np.maximum(size, other))
                maybe &= across(run, rest, at)
                for k in np.flatnonzero(maybe):
                    common = len(np.intersect1d(sets[at], sets[rest[k]], assume_unique=True))
                    maybe[k] = 100 * common >= percent * (size + other[k] - common)
                return maybe

            links = spread(np.flatnonzero(full), alike)
            reps = run["rep"].tolist()
            yield pd.DataFrame({"a": [reps[x] for x, _ in links], "b": [reps[y] for _, y in links]}, dtype="int64")

    one = tiled(members.where("blocks = 1"), "group", "rep").mapInPandas(check, LINK)
    large = saved(members.where("blocks > 1"), "large")
    if not large.isEmpty():
        links, rest = led(large, "group", "text", alike_leader)
        one = one.unionByName(links).unionByName(outside(large, rest, "group").mapInPandas(across_tiles, LINK))
    return one.where("a <> b").distinct()


def near(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept, for links with 100 * common >= percent * together."""
    ready(docs.sparkSession)
    threshold = percent / 100
    least = int((threshold - DEVIATIONS * (threshold * (1 - threshold) / COORDINATES) ** 0.5) * COORDINATES)
    docs = docs.select("doc_id", "text")

    marked = saved(sketches(docs), "sketches")
    classes = marked.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(F.min(F.struct("doc_id", "bands", "print")).alias("first"))
    classes = saved(classes.select("key", F.col("first.doc_id").alias("rep"), "first.bands", "first.print"), "classes")

    banded = classes.select("rep", F.explode("bands").alias("bucket"))
    full = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    full = full.select("bucket", F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("blocks"))
    members = banded.join(full, "bucket").join(classes.select("rep", "print"), "rep")
    groups = components(saved(forest(members, least), "candidates"), name="groups").select(F.col("id").alias("rep"), F.col("component").alias("group"))

    texts = docs.where("text IS NOT NULL").join(groups, docs["doc_id"] == groups["rep"]).drop("doc_id")
    texts = saved(texts, "texts")
    sizes = texts.groupBy("group").agg(F.greatest(F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum(F.length("text")) / TILE_CHARS), F.lit(1)).cast("int").alias("blocks"))
    links = saved(verified(texts.join(sizes, "group"), percent, least), "links")
    joined = components(links, name="components").select(F.col("id").alias("rep"), "component")

    named = classes.select("key", "rep").join(joined, "rep", "left").select("key", F.coalesce("component", "rep").alias("component"))
    out = marked.select("doc_id", "text_hash", "n_shingles", "key").join(named, "key", "left")
    out = out.select("doc_id", "text_hash", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
