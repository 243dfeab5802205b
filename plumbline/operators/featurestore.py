"""Point-in-time retrieval and latest-value snapshots over feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.ordered import SLICE, last_known, last_known_all, order_slices, previous_row


def point_in_time(
    spine: DataFrame,
    features: DataFrame,
    entity: str,
    spine_ts: str,
    feature_ts: str,
    values: Sequence[str],
    ttl: str | None = None,
    rows_per_slice: int = 2_000_000,
) -> DataFrame:
    """Each spine row with the newest feature row at or before its time (NULLs when none or older than ttl).

    No inequality join: both sides are merged in time order per (entity, time slice), and a slice
    takes over the last row of the slices before it. Equal (entity, time) keys are reduced first.
    """
    row = F.struct(F.col(feature_ts).alias("__at"), *values)
    known_entity = F.col(entity).isNotNull()  # nothing matches a missing entity
    newest = features.where(known_entity).groupBy(entity, F.col(feature_ts).alias("__ts")).agg(F.max(row).alias("__row"))
    asked = spine.where(known_entity).select(entity, F.col(spine_ts).alias("__ts")).distinct()
    merged = newest.select(entity, "__ts", F.lit(0).alias("__side"), "__row").unionByName(
        asked.select(entity, "__ts", F.lit(1).alias("__side")), allowMissingColumns=True
    )
    times = spine.select(F.col(spine_ts).alias("__ts")).unionAll(features.select(F.col(feature_ts).alias("__ts")))
    sliced = merged.withColumn(SLICE, order_slices(times, "__ts", rows_per_slice))
    known = last_known(sliced, [entity], SLICE, ["__ts", "__side"], "__row", "__hit").where(F.col("__side") == 1)
    hit = F.col("__hit")
    if ttl is not None:
        hit = F.when(F.col("__hit.__at") >= F.col("__ts") - F.expr(f"interval {ttl}"), hit)
    answers = known.select(entity, "__ts", hit.alias("__hit"))
    return spine.withColumn("__ts", F.col(spine_ts)).join(answers, [entity, "__ts"], "left").select(
        *spine.columns, F.col("__hit.__at").alias("feature_timestamp"), *[F.col(f"__hit.{v}").alias(v) for v in values]
    )


@dataclass(frozen=True)
class View:
    """A feature table with its own time column and time to live; columns come out as name__value."""

    name: str
    rows: DataFrame
    ts: str
    values: Sequence[str]
    ttl: str | None = None


def point_in_time_views(
    spine: DataFrame, views: Sequence[View], entity: str, spine_ts: str, rows_per_slice: int = 2_000_000
) -> DataFrame:
    """point_in_time for several views at once: spine and views are merged in time order by one shuffle,
    and what is carried along is the last row of each view.

    Adds name__ts and name__value of each view. Of feature rows with equal entity and time the greatest
    counts; spine rows may repeat and may lack an entity or a time.
    """
    at = lambda df, c: df.select(F.col(c).alias("__ts"))
    times = at(spine, spine_ts)
    merged = spine.select(F.col(entity).alias("__entity"), F.col(spine_ts).alias("__ts"), F.lit(1).alias("__side"), F.struct(*spine.columns).alias("__spine"))
    for v in views:
        times = times.unionAll(at(v.rows, v.ts))
        row = F.struct(F.col(v.ts).alias("ts"), *v.values)
        newest = v.rows.where(F.col(entity).isNotNull() & F.col(v.ts).isNotNull()).groupBy(F.col(entity).alias("__entity"), F.col(v.ts).alias("__ts"))
        merged = merged.unionByName(newest.agg(F.max(row).alias(f"__{v.name}")).withColumn("__side", F.lit(0)), allowMissingColumns=True)
    sliced = merged.withColumn(SLICE, order_slices(times, "__ts", rows_per_slice))
    known = last_known_all(sliced, ["__entity"], SLICE, ["__ts", "__side"], {f"{v.name}__row": f"__{v.name}" for v in views})
    out = [F.col(f"__spine.{c}").alias(c) for c in spine.columns]
    for v in views:
        hit = F.col(f"{v.name}__row")
        if v.ttl is not None:
            hit = F.when(hit["ts"] >= F.col("__ts") - F.expr(f"interval {v.ttl}"), hit)
        hit = F.when(F.col("__ts").isNotNull() & F.col("__entity").isNotNull(), hit)
        out += [hit["ts"].alias(f"{v.name}__ts"), *[hit[c].alias(f"{v.name}__{c}") for c in v.values]]
    return known.where("__side = 1").select(*out)


def latest(features: DataFrame, entity: str, ts: str, values: Sequence[str]) -> DataFrame:
    """Newest values per entity; partial aggregation keeps one row per entity and task."""
    newest = F.max(F.struct(ts, *values))
    return features.groupBy(entity).agg(newest.alias("__n")).select(entity, "__n.*")


def refresh(
    snapshot: DataFrame, features: DataFrame, entity: str, ts: str, values: Sequence[str], after: str, until: str
) -> DataFrame:
    """Snapshot brought forward by the feature rows in (after, until]; bounds reach the scan."""
    kind = features.schema[ts].dataType
    fresh = features.where((F.col(ts) > F.lit(after).cast(kind)) & (F.col(ts) <= F.lit(until).cast(kind)))
    columns = [entity, ts, *values]
    return latest(snapshot.select(*columns).unionByName(fresh.select(*columns)), entity, ts, values)


def lookup(requests: DataFrame, snapshot: DataFrame, entity: str) -> DataFrame:
    """Requests with their latest features: one equi-join, at every size and for streams."""
    return requests.join(snapshot, entity, "left")


def store(df: DataFrame, name: str, entity: str, buckets: int, path: str | None = None) -> None:
    """df as a table bucketed and sorted by its entity: joins on it neither shuffle nor sort this side.

    `buckets` should not be below spark.sql.shuffle.partitions, else Spark deals both sides out anew. One
    file per bucket: a task gets the rows of one bucket.
    """
    writer = df.repartition(buckets, entity).write.mode("overwrite").bucketBy(buckets, entity).sortBy(entity)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def stored_lookup(requests: DataFrame, name: str, entity: str, how: str = "left") -> DataFrame:
    """Requests with the row of a stored table: only the requests move, to the table's buckets."""
    return requests.join(requests.sparkSession.table(name).hint("merge"), entity, how)


def days_since_previous(
    df: DataFrame, entity: str, ts: str, order: Sequence[str] = (), name: str = "days_since_previous"
) -> DataFrame:
    """Days between a row and the row before it of the same entity; NULL for the first."""
    sliced = df.withColumn(SLICE, order_slices(df, ts))
    out = previous_row(sliced, [entity], SLICE, [ts, *order], [ts])
    return out.withColumn(name, F.datediff(F.col(ts), F.col(f"prev.{ts}"))).drop(SLICE, "prev")
