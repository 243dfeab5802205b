"""Structured Streaming counterparts of the batch operators, sharing their column functions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators import logs, model
from plumbline.operators.clean import missing_names
from plumbline.operators.quality import MAX_NULL_RATE, absent


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files below path as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run(
    stream: DataFrame, out: str, checkpoint: str, partition_by: Sequence[str] = (), every: str | None = None
) -> StreamingQuery:
    """Append to Parquet files: exactly once through the file sink's own log. Without `every`,
    all input there is now is processed and the query ends."""
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.outputMode("append").start()


def run_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def ship_logs(raw: DataFrame) -> DataFrame:
    """The log pipeline on a stream: the batch function itself."""
    return logs.ship(raw)


def tumbling_counts(stream: DataFrame, by: Sequence[str], width: str = "1 minute", delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Rows per window and label; a window is emitted once the watermark passed its end."""
    counts = stream.withWatermark(ts, delay).groupBy(F.window(ts, width), *by).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "rows")


def sliding_rates(
    stream: DataFrame, by: Sequence[str], range_s: int = 120, step_s: int = 60, delay: str = "10 minutes", ts: str = "ts"
) -> DataFrame:
    """Rows per second over a sliding range, one value per step."""
    window = F.window(ts, f"{range_s} seconds", f"{step_s} seconds")
    counts = stream.withWatermark(ts, delay).groupBy(window, *by).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, (F.col("rows") / float(range_s)).alias("rate")
    )


def latest_values(stream: DataFrame, by: Sequence[str], fields: Sequence[str], ts: str = "ts") -> DataFrame:
    """Newest value of the fields per series, for update mode."""
    return stream.groupBy(*by).agg(F.max(F.struct(ts, *fields)).alias("__n")).select(*by, "__n.*")


class Manifest:
    """Which version of each bucket is current, and which batch of each query was merged last.

    A manifest is one small file, written under a temporary name and renamed, so readers see the old
    state or the new one. Numbers rise across queries and checkpoints.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self.at = lambda *parts: hadoop.Path("/".join([self.path, *parts]))
        self.fs = self.at().getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        folder = self.at("_manifests")
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def read(self, number: int | None = None) -> dict:
        """number, versions (bucket -> folder name) and applied (query -> batch)."""
        if number is None:
            known = self.numbers()
            if not known:
                return {"number": -1, "versions": {}, "applied": {}}
            number = known[-1]
        stream = self.fs.open(self.at("_manifests", f"{number}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def publish(self, state: dict) -> None:
        draft = self.at("_manifests", f".{state['number']}-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, True)
        stream.write(json.dumps(state).encode())
        stream.close()
        if not self.fs.rename(draft, self.at("_manifests", f"{state['number']}.json")):
            self.fs.delete(draft, False)
            raise RuntimeError(f"manifest {state['number']} of {self.path} exists: one writer at a time")

    def remove_old(self, keep: int) -> None:
        """Drops all but the last `keep` manifests, and versions that none of those names."""
        known = self.numbers()
        for number in known[:-keep]:
            self.fs.delete(self.at("_manifests", f"{number}.json"), False)
        needed = {(b, v) for n in known[-keep:] for b, v in self.read(n)["versions"].items()}
        for bucket in self.fs.listStatus(self.at("data")):
            name = bucket.getPath().getName()
            if name.startswith("bucket="):
                for version in self.fs.listStatus(bucket.getPath()):
                    if (name.removeprefix("bucket="), version.getPath().getName().removeprefix("version=")) not in needed:
                        self.fs.delete(version.getPath(), True)

    def rows(self, versions: dict[str, str]) -> DataFrame:
        folders = [f"{self.path}/data/bucket={b}/version={v}" for b, v in sorted(versions.items())]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders)


def upsert_to(
    path: str, by: Sequence[str], fields: Sequence[str], ts: str = "ts", buckets: int = 64, source: str | None = None, keep: int = 2
) -> Callable[[DataFrame, int], None]:
    """Batch writer that merges each micro-batch into a table of one row per key.

    Keys are cut into buckets; a batch writes the buckets it touches as a new version beside the old one
    and then publishes a manifest that names it, so readers never see half a batch. Batches count per
    `source` (default: the streaming query's id): a batch that was merged is not merged again, and a new
    checkpoint starts anew. The last `keep` manifests and their versions stay for running readers.
    """

    def write(changed: DataFrame, batch: int) -> None:
        spark = changed.sparkSession
        name = source or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        manifest = Manifest(spark, path)
        state = manifest.read()
        if name and state["applied"].get(name, -1) >= batch:
            return
        new = changed.select(*by, ts, *fields, F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int").alias("bucket")).persist()
        try:
            touched = [str(r.bucket) for r in new.select("bucket").distinct().collect()]  # at most `buckets`
            version = f"{state['number'] + 1}-{uuid.uuid4().hex[:8]}"
            if touched:
                merged = new
                old = {b: state["versions"][b] for b in touched if b in state["versions"]}
                if old:
                    merged = new.unionByName(manifest.rows(old).drop("version").withColumn("bucket", F.col("bucket").cast("int")))
                latest = merged.groupBy("bucket", *by).agg(F.max(F.struct(ts, *fields)).alias("__n"))
                rows = latest.select(*by, "__n.*", "bucket", F.lit(version).alias("version"))
                rows.repartition("bucket").write.mode("append").partitionBy("bucket", "version").parquet(f"{manifest.path}/data")
            manifest.publish(
                {
                    "number": state["number"] + 1,
                    "versions": state["versions"] | {b: version for b in touched},
                    "applied": state["applied"] | ({name: batch} if name else {}),
                }
            )
            if touched:
                manifest.remove_old(keep)
        finally:
            new.unpersist()

    return write


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """Current value per key of a table written by upsert_to, as its newest manifest has it."""
    manifest = Manifest(spark, path)
    versions = manifest.read()["versions"]
    if not versions:
        raise ValueError(f"nothing was written to {path}")
    return manifest.rows(versions).drop("bucket", "version")


def without_duplicates(stream: DataFrame, keys: Sequence[str], delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """First row per key within the watermark delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def score_batches(
    fitted: Model, features: Sequence[str], threshold: float, out: str, rejected: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch writer: the null-rate gate decides whether a micro-batch is scored or goes to the error sink."""

    def write(rows: DataFrame, batch: int) -> None:
        gone = missing_names(rows, features)
        if gone:
            raise ValueError(f"missing columns: {', '.join(gone)}")
        rates = rows.agg(*[F.avg(absent(rows, f).cast("double")).alias(f) for f in features]).first()
        high = [f for f in features if (rates[f] or 0.0) > MAX_NULL_RATE]
        if high:
            result, target = rows.withColumn("high_null_columns", F.lit(",".join(high))), rejected
        else:
            ready = transform(rows) if transform else rows
            result, target = model.score(ready, fitted, features, threshold), out
        result.withColumn("batch", F.lit(batch)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(target)

    return write


def dropped_late(query: StreamingQuery) -> int:
    """Rows the watermark dropped so far."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p.get("stateOperators", [])
    )
