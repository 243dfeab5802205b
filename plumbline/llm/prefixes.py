"""The prefix trie of conversations, built by bursting.

A node is a distinct sequence of first turns (role, text); its members are the conversations that start
with it. Equal conversations are one class (by sums of hashes of turns and their places), whose smallest
conv_id stands for it.

1. Turns become ids. Each class brings its turn ids as far down as another class may share them: FIRST
   turns, doubled as long as their hash sum occurs twice. Below, its nodes are a chain of its own, which
   needs no trie.
2. All classes lie as suffixes in one container under the root. A container of more than `container`
   classes bursts: its longest common prefix (that of its least and greatest suffix) becomes a trie head,
   and its classes are dealt to containers by next turn id, until none is too large.
3. The containers that remain are sorted and swept, each in one pass with a stack of open nodes.
4. Heads add up what their containers hold; every container names the heads above it.

Turns are ordered by turn (null first), then role, then text; null roles and texts are empty. Rows
without conv_id are left out. Repeated rows are turns of their own. An empty table gives no rows, not
even a root. Columns other than conv_id, turn, role and text are not read. A conversation's turns are
numbered by slices, and only its shared part is ever in one row; a class's members are hashed from
sorted chunks, so no group of copies is held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import ready, saved
from plumbline.operators.ordered import order_slices, running_sums

FIRST = 64
CONTAINER = 256
SALTS = 16
SLICE_ROWS = 1_000_000
#: Width of the conv_id ranges whose members are joined before they are hashed.
CHUNK = 4096
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
CLASS = "rep long, m long, n long, total long, ends_sha256 string"
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends long, top boolean, head binary, path array<binary>"
)
COLUMNS = [c.split()[0] for c in NODE.split(", ")]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), tid, chars, run (characters up to here): every conversation in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    tid = F.unhex(F.md5(F.concat(F.length(role), F.lit(":"), role, text)))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"), tid.alias("tid"), F.length(text).cast("long").alias("chars"), F.lit(1).cast("long").alias("one")
    )
    rows = rows.withColumn("part", order_slices(rows, "turn", SLICE_ROWS))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return running_sums(rows, ["conv_id"], "part", order, {"pos": "one", "run": "chars"}).select("conv_id", "pos", "tid", "chars", "run")


def grafted(rows: DataFrame, root: Column, shared: Column, most: int) -> DataFrame:
    """Each conversation with its first `shared` (at most `most`) turns replaced by those of `root`;
    conversations left without a turn have one row of null pos."""
    rows = rows.withColumn("h", shared)
    heads = rows.where(F.col("pos") <= most).groupBy(F.col("conv_id").alias("root")).agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "chars", "run"))).alias("first"))
    each = rows.groupBy("conv_id").agg(F.first("h").alias("h"), F.coalesce(F.max(F.when(F.col("pos") <= F.col("h"), F.col("run"))), F.lit(0)).alias("off"))
    each = each.withColumn("root", root).join(heads, "root", "left")
    taken = F.slice(F.coalesce("first", F.array().cast(heads.schema["first"].dataType)), 1, F.col("h").cast("int"))
    each = each.select("conv_id", "off", taken.alias("taken"))
    more = F.coalesce(F.get("taken", F.size("taken") - 1)["run"], F.lit(0)) - F.col("off")
    inherited = each.select("conv_id", F.explode_outer("taken").alias("t")).select("conv_id", "t.pos", "t.tid", "t.chars", "t.run")
    own = rows.where("pos > h").join(each.select("conv_id", F.size("taken").alias("k"), more.alias("more")), "conv_id")
    return inherited.unionByName(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "tid", "chars", (F.col("run") + F.col("more")).alias("run")))


def signature(upto: Column) -> list[Column]:
    """Number and hash sums of the turns that a condition selects."""
    mine = lambda salt: F.xxhash64("pos", "tid", F.lit(salt)).cast("decimal(38,0)")
    none = F.lit(0).cast("decimal(38,0)")
    return [F.count(F.when(upto, 1)).alias("n"), *[F.coalesce(F.sum(F.when(upto, mine(i))), none).alias(f"s{i}") for i in (1, 2)]]


KEY = ["n", "s1", "s2"]


def classes(rows: DataFrame) -> DataFrame:
    """A row per distinct sequence: rep (smallest conv_id), m members, n turns, total characters, ends_sha256
    (of the members' conv_ids in ascending order, joined by commas)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, None
        for batch in batches:
            done = []
            for key, rep, m, n, total, ids in zip(batch["key"], batch["low"], batch["m"], batch["n"], batch["total"], batch["ids"]):
                if key == last:
                    held[1] += m
                    held[4].update(b"," + ids.encode())
                else:
                    if held:
                        done.append(held)
                    last, held = key, [rep, m, n, total, hashlib.sha256(ids.encode())]
            yield closed(done)
        if held:
            yield closed([held])

    def closed(done: list) -> pd.DataFrame:
        return pd.DataFrame([(*d[:4], d[4].hexdigest()) for d in done], columns=["rep", "m", "n", "total", "ends_sha256"])

    each = rows.groupBy("conv_id").agg(*signature(F.col("pos").isNotNull()), F.coalesce(F.max("run"), F.lit(0)).alias("total"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = each.groupBy(*KEY, F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(
        F.min("conv_id").alias("low"), F.count("*").alias("m"), F.max("total").alias("total"), ids.alias("ids")
    )
    chunks = chunks.withColumn("key", F.concat_ws(",", *KEY)).repartition("key").sortWithinPartitions("key", "chunk")
    return chunks.select("key", "low", "m", "n", "total", "ids").mapInPandas(run, CLASS)


def cuts(own: DataFrame, each: DataFrame, first: int) -> DataFrame:
    """rep, cut: no other class has the first `cut` turns of rep, unless those are all it has."""
    size = first
    decided = each.where(F.col("n") <= size).select("rep", F.col("n").alias("cut"))
    open_ = each.where(F.col("n") > size).select("rep")
    while not open_.isEmpty():
        long = each.where(F.col("n") >= size).select("rep", F.col("n").alias("all"))
        marks = own.join(long, "rep").where(F.col("pos") <= size).groupBy("rep", "all").agg(*signature(F.lit(True)))
        twice = marks.groupBy(*KEY).count().where("count > 1").select(*KEY)
        shared = saved(marks.join(twice, KEY).where(F.col("all") > size).select("rep", "all"), "shared")
        alone = open_.join(shared, "rep", "left_anti")
        size *= 2
        decided = decided.unionByName(alone.withColumn("cut", F.lit(size // 2).cast("long")))
        decided = decided.unionByName(shared.where(F.col("all") <= size).select("rep", F.col("all").alias("cut")))
        open_ = shared.where(F.col("all") > size).select("rep")
    return decided


def common_prefix(a: Column, b: Column) -> Column:
    differs = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def burst(suffixes: DataFrame, container: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(classes in their last containers, heads, classes that end at the bottom of a head)."""
    open_ = suffixes.withColumn("head", F.unhex(F.md5(F.lit("")))).withColumn("at", F.lit(0)).withColumn("path", F.array().cast("array<binary>"))
    small: list[DataFrame] = []
    heads: list[DataFrame] = []
    ended: list[DataFrame] = []
    while True:
        open_ = saved(open_.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS))), "open")
        rest = F.slice("tids", F.col("at") + 1, F.size("tids"))
        large = open_.groupBy("head", "salt").count().groupBy("head").agg(F.sum("count").alias("k")).where(F.col("k") > container).select("head")
        salted = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
        full = open_.join(salted, ["head", "salt"])
        run = full.groupBy("head", "at", "path").agg(F.min(rest).alias("a"), F.max(rest).alias("b"), F.first("chars").alias("chars"))
        run = run.select("head", "at", "path", (F.col("at") + common_prefix(F.col("a"), F.col("b"))).alias("bottom"), "chars")
        lead = F.when(F.col("at") == 0, F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<long>"))
        run = saved(run.withColumn("chars", F.concat(lead, F.slice("chars", F.greatest("at", F.lit(1)), F.col("bottom") - F.greatest("at", F.lit(1)) + 1))), "heads")
        if run.isEmpty():
            small.append(open_.drop("salt"))
            break
        small.append(open_.join(salted, ["head", "salt"], "left_anti").drop("salt"))
        heads.append(run)
        bottoms = run.select("head", "bottom").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
        moved = open_.join(bottoms, ["head", "salt"]).drop("salt").withColumn("path", F.concat("path", F.array("head")))
        ended.append(moved.where(F.size("tids") == F.col("bottom")).select("head", "path", "rep", "m"))
        below = F.unhex(F.md5(F.concat(F.col("head"), F.get("tids", F.col("bottom")))))
        open_ = moved.where(F.size("tids") > F.col("bottom")).withColumn("head", below).withColumn("at", F.col("bottom") + 1).drop("bottom")

    def together(parts: list[DataFrame]) -> DataFrame | None:
        whole = None
        for p in parts:
            whole = p if whole is None else whole.unionByName(p)
        return whole

    return together(small), together(heads), together(ended)


class Node:
    __slots__ = ("depth", "chars", "low", "m", "children", "leaves", "saved", "ends", "closed")

    def __init__(self, depth: int, chars: int):
        self.depth, self.chars, self.low, self.m = depth, chars, None, 0
        self.children = self.leaves = self.saved = 0
        self.ends, self.closed = None, []

    def add(self, low: int, m: int) -> None:
        self.low = low if self.low is None else min(self.low, low)
        self.m += m


def swept(containers: DataFrame) -> DataFrame:
    """The nodes of each container from its sorted suffixes; its top names head and path, but no parent."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        stack: list[Node] = []
        head, path, last = None, None, []

        def finish(node: Node) -> None:
            """All about a node but its parent; its children now know theirs."""
            node.saved += (node.m - 1) * node.chars
            node.leaves = node.leaves or 1
            for child in node.closed:
                out.append((child.low, child.depth, node.low, child.m, child.children, child.leaves, child.saved, child.ends, False, None, None))
            node.closed = []

        def pop() -> None:
            node, parent = stack.pop(), stack[-1]
            finish(node)
            parent.add(node.low, node.m)
            parent.children += 1
            parent.leaves += node.leaves
            parent.saved += node.saved
            parent.closed.append(node)

        def close() -> None:
            while len(stack) > 1:
                pop()
            if stack:
                top = stack.pop()
                finish(top)
                out.append((top.low, top.depth, None, top.m, top.children, top.leaves, top.saved, top.ends, True, head, path))

        def frame() -> pd.DataFrame:
            rows = pd.DataFrame(out, columns=COLUMNS)
            out.clear()
            for c in ("parent_conv_id", "ends"):
                rows[c] = rows[c].astype("Int64")
            return rows

        for batch in batches:
            for at, own, rep, m, n, tail, tids, chars, above in zip(
                batch["at"], batch["head"], batch["rep"], batch["m"], batch["n"], batch["tail"], batch["tids"], batch["chars"], batch["path"]
            ):
                tids = list(tids)
                if own != head:
                    close()
                    head, path, last = own, list(above), []
                    stack.append(Node(at, int(chars[at - 1]) if at else 0))
                    same = at
                else:
                    same = at
                    while same < min(len(last), len(tids)) and last[same] == tids[same]:
                        same += 1
                    while stack[-1].depth > same:
                        pop()
                for depth in range(same + 1, len(tids) + 1):
                    stack.append(Node(depth, int(chars[depth - 1])))
                end = stack[-1]
                end.add(rep, m)
                if n > len(tids):  # goes on as a chain
                    end.children, end.leaves, end.saved = end.children + 1, end.leaves + 1, end.saved + (m - 1) * tail
                else:
                    end.ends = rep
                last = tids
            if len(out) > 5000:
                yield frame()
        close()
        yield frame()

    rows = containers.repartition("head").sortWithinPartitions("head", "tids")
    return rows.select("at", "head", "rep", "m", "n", "tail", "tids", "chars", "path").mapInPandas(run, NODE)


def head_nodes(heads: DataFrame, ended: DataFrame, tops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes of the heads, smallest conv_id by head)."""
    parts = tops.select("path", F.col("conv_id").alias("low"), F.col("n_convs").alias("m"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    zero = F.lit(0).cast("long")
    parts = parts.unionByName(ended.select("path", F.col("rep").alias("low"), "m", zero.alias("leaves"), zero.alias("saved")))
    below = parts.withColumn("head", F.explode("path")).groupBy("head").agg(F.min("low").alias("low"), F.sum("m").alias("m"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    known = saved(heads.join(below, "head"), "known")
    span = F.aggregate("chars", zero, lambda a, x: a + x) * (F.col("m") - 1)
    lower = known.select(span.alias("own"), F.explode(F.concat("path", F.array("head"))).alias("head")).groupBy("head").agg(F.sum("own").alias("inside"))
    parent = F.get("path", F.size("path") - 1)
    children = tops.select(parent.alias("head")).unionByName(known.select(parent.alias("head"))).where("head IS NOT NULL").groupBy("head").agg(F.count("*").alias("children"))
    lows = known.select(F.col("head").alias("above"), F.col("low").alias("above_low"))
    rows = known.join(lower, "head").join(children, "head").join(ended.select("head", F.col("rep").alias("ends")), "head", "left").withColumn("above", parent).join(lows, "above", "left")
    rows = rows.select("*", F.posexplode("chars").alias("i", "x"))
    bottom = F.col("i") == F.size("chars") - 1
    passed = F.aggregate(F.slice("chars", 1, F.col("i")), zero, lambda a, x: a + x) * (F.col("m") - 1)
    nodes = rows.select(
        F.col("low").alias("conv_id"),
        (F.col("at") + F.col("i")).cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("above_low")).otherwise(F.col("low")).alias("parent_conv_id"),
        F.col("m").alias("n_convs"),
        F.when(bottom, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + F.col("inside") - passed).alias("saved_tokens"),
        F.when(bottom, F.col("ends")).alias("ends"),
    )
    return nodes, lows


def trie(rows: DataFrame, container: int = CONTAINER, first: int = FIRST) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, pos, tid, chars, run; null pos: no turn)."""
    ready(rows.sparkSession)
    rows = saved(rows, "turns")
    each = saved(classes(rows), "classes")
    own = rows.where("pos IS NOT NULL").withColumnRenamed("conv_id", "rep").join(each.select("rep"), "rep", "left_semi")
    each = saved(each.join(cuts(own, each, first), "rep"), "cut")
    shared = own.join(each.select("rep", "cut"), "rep").where("pos <= cut")
    arrays = shared.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "chars"))).alias("t"), F.max("run").alias("run"))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    suffixes = each.join(arrays, "rep", "left").select(
        "rep", "m", "n", F.coalesce(F.col("t")["tid"], none("binary")).alias("tids"), F.coalesce(F.col("t")["chars"], none("long")).alias("chars"),
        (F.col("total") - F.coalesce("run", F.lit(0))).alias("tail"),
    )
    containers, heads, ended = burst(suffixes, container)
    nodes = saved(swept(containers), "nodes")
    kept = [c for c in COLUMNS if c not in ("top", "head", "path")]
    tops = nodes.where("top")
    if heads is not None:
        upper, lows = head_nodes(heads, ended, tops)
        tops = tops.withColumn("above", F.get("path", F.size("path") - 1)).join(lows, "above", "left").withColumn("parent_conv_id", F.col("above_low"))
        tops = tops.select(*kept).unionByName(upper)
    chains = own.join(each.where("n > cut"), "rep").where("pos > cut").select(
        F.col("rep").alias("conv_id"), F.col("pos").alias("depth"), F.col("rep").alias("parent_conv_id"), F.col("m").alias("n_convs"),
        (F.col("pos") < F.col("n")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("m") - 1) * (F.col("total") - F.col("run") + F.col("chars"))).alias("saved_tokens"), F.when(F.col("pos") == F.col("n"), F.col("rep")).alias("ends"),
    )
    whole = nodes.where("NOT top").select(*kept).unionByName(tops.select(*kept)).unionByName(chains)
    digests = each.select(F.col("rep").alias("ends"), "ends_sha256")
    return whole.join(digests, "ends", "left").select(*kept[:-1], F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"))
