"""Cross-site boilerplate lines by distinct-site spread, in DataFrame operations only.

A line is boilerplate when documents of at least `sites` distinct sources hold it. Lines that all lie
in one source are set aside by a grouped minimum and maximum; for the others a HyperLogLog sketch of
sources per line hash is built and merged by partial aggregation. Where the estimate lies within four
standard errors of the threshold, sources are counted exactly; beyond that the sketch decides, so a line
far from the threshold is misjudged only if its sketch is off by more than that. Every boilerplate line
goes but its first occurrence: the smallest doc_id that holds it keeps its first copy.

Blank lines are no boilerplate. A null text stays null; a null source counts as one source of its own.
Rows with one doc_id are treated alike. A row without doc_id never keeps a first occurrence by itself.
An empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import ready

LG_CELLS = 12
#: Four standard errors of a sketch with 2**12 cells, and one source more for small counts.
MARGIN = 4 * 1.04 / 2 ** (LG_CELLS / 2)
BREAK = "\n"


def _lines(text: Column) -> Column:
    return F.split(text, BREAK, -1)


def boilerplate(docs: DataFrame, sites: int) -> tuple[DataFrame, DataFrame]:
    """(lines: doc_id, line, site once per document; boilerplate: line, first doc_id)."""
    hashes = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: x != ""), lambda x: F.xxhash64(x)))
    site = F.coalesce(F.xxhash64("source"), F.lit(0)) if "source" in docs.columns else F.lit(0)
    lines = docs.select("doc_id", site.cast("long").alias("site"), F.explode(hashes).alias("line"))
    ends = lines.groupBy("line").agg(F.min("site").alias("low"), F.max("site").alias("high"), F.min("doc_id").alias("first"))
    several = ends.where("low < high").select("line", "first") if sites > 1 else ends.select("line", "first")

    spread = lines.join(several, "line").groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_CELLS))).alias("estimate"), F.first("first").alias("first")
    )
    low, high = sites * (1 - MARGIN) - 1, sites * (1 + MARGIN) + 1
    sure = spread.where(F.col("estimate") > high).select("line", "first")
    close = spread.where(F.col("estimate").between(low, high)).select("line", "first")
    exact = lines.join(close, "line").groupBy("line", "first").agg(F.count_distinct("site").alias("n")).where(F.col("n") >= sites)
    return lines, sure.unionByName(exact.select("line", "first"))


def cleaned(docs: DataFrame, sites: int = 10) -> DataFrame:
    """docs with boilerplate lines removed from text, and n_lines and n_removed added.

    Places of boilerplate lines are joined back to their text, and what is left of a text is picked from
    its lines by place, so the cost of a text is linear in its lines.
    """
    ready(docs.sparkSession)
    docs = docs.drop("n_lines", "n_removed")
    _, common = boilerplate(docs, sites)
    keeps = F.col("doc_id").eqNullSafe(F.col("first"))
    places = docs.select("doc_id", F.xxhash64("text").alias("_own"), F.posexplode(_lines(F.col("text"))).alias("at", "x")).where("x <> ''")
    places = places.select("doc_id", "_own", "at", F.xxhash64("x").alias("line")).join(common, "line")
    each = places.groupBy("doc_id", "_own", "line", keeps.alias("keeps")).agg(F.collect_set("at").alias("at"))
    gone = F.when(F.col("keeps"), F.array_except("at", F.array(F.array_min("at")))).otherwise(F.col("at"))
    own = each.groupBy(F.col("doc_id").alias("_doc"), "_own").agg(F.flatten(F.collect_list(gone)).alias("_gone"))
    split = docs.withColumn("_hash", F.xxhash64("text")).withColumn("_lines", _lines(F.col("text"))).drop("text")
    marked = split.join(own, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_own")), "left")
    n = F.size("_lines")
    left = F.array_except(F.sequence(F.lit(0), n - 1), "_gone")
    kept = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.transform(left, lambda i: F.get("_lines", i)))
    return marked.select(
        *[F.array_join(kept, BREAK).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col("_lines").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.when(F.col("_lines").isNull() | F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_removed"),
    )
