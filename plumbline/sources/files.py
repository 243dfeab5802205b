"""Reading and writing the layers: text scans, date partitions, splits, reports, run log."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import schema as S

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name of NULL


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every column as text, header row, no inference; an unnamed first column becomes _c0."""
    reader = spark.read.option("header", True).option("inferSchema", False)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_partition(spark: SparkSession, root: str, date: str, column: str = S.PARTITION) -> DataFrame:
    """One date of a partitioned table; the filter prunes directories."""
    return spark.read.parquet(root).where(F.col(column).cast("string") == F.lit(date))


def read_all(spark: SparkSession, path: str | Sequence[str], drop: str = S.PARTITION) -> DataFrame:
    """All Parquet files below path(s) as one table without the partition column."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths).drop(drop)


def read_recursive(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files at any depth, including names that end in .parquet.out."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet{,.out}").parquet(path)
    )


def write_partitioned(
    df: DataFrame, root: str, date: str, column: str = S.PARTITION, mode: str = "overwrite"
) -> None:
    """Stamp df with date and replace that date only; other dates stay."""
    df.withColumn(column, F.lit(date)).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
        column
    ).parquet(root)


def write_by(df: DataFrame, root: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """Partitioned write that replaces only the partitions it holds.

    Rebalancing gathers a partition value into few files and splits a hot one over many tasks.
    """
    df.hint("rebalance", *columns).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(root)


def write_splits(df: DataFrame, root: str, features: Sequence[str], target: str, split: str = "split") -> None:
    """One folder per split, features in contract order, then the target."""
    df.select(*features, target, split).hint("rebalance", split).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(split).parquet(root)


def input_bytes(df: DataFrame) -> int:
    """Length of the files df reads, by one listing per folder; no file is opened."""
    spark, folders = df.sparkSession, {}
    for uri in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        folders.setdefault(path.getParent().toString(), (path.getParent(), set()))[1].add(path.getName())
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return sum(e.getLen() for folder, names in folders.values() for e in folder.getFileSystem(conf).listStatus(folder) if e.getPath().getName() in names)


def partitions(spark: SparkSession, root: str, column: str = S.PARTITION) -> list[str]:
    """Partition values by the names of the folders directly below root; no file is listed or opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    entries = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(path)
    names = [e.getPath().getName() for e in entries if e.isDirectory()]
    values = [unquote(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}=")]
    return [v for v in values if v != NULL_PARTITION]


def latest_partition(spark: SparkSession, root: str, override: str = "", column: str = S.PARTITION) -> DataFrame:
    """One row: the override when given, else the lexically largest partition value; raises when none."""
    newest = override or max(partitions(spark, root, column), default=None)
    if newest is None:
        raise ValueError(f"no partitions below {root}")
    return spark.createDataFrame([(newest,)], f"`{column}` string")


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """df itself; raises when it is empty. Reads one row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def write_report(df: DataFrame, path: str) -> None:
    """Each row as one JSON document."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", False).json(path)


def run_rows(
    df: DataFrame, run_id, run_name: str, step: str, keys: Iterable[str], tags: dict[str, str] | None = None
) -> DataFrame:
    """Metric columns `keys` of df as long run-log rows, values rounded to 4 places."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(k).alias("key"), F.round(F.col(k).cast("double"), 4).alias("value")) for k in keys])
    )
    tag_map = F.create_map(*[F.lit(x) for kv in ({"step": step} | (tags or {})).items() for x in kv])
    run = run_id if not isinstance(run_id, str) else F.lit(run_id)
    return df.select(
        run.alias("run_id"), F.lit(run_name).alias("run_name"), F.lit(step).alias("step"), pairs.alias("m"),
        tag_map.alias("tags"),
    ).select("run_id", "run_name", "step", "m.key", "m.value", "tags")


def append_run_log(rows: DataFrame, path: str) -> None:
    rows.select(*S.RUN_LOG.fieldNames()).write.mode("append").parquet(path)


def runs_wide(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run with a column per key (the latest value when a key was logged twice)."""
    return log.groupBy("run_id").pivot("key", list(keys)).agg(F.first("value", ignorenulls=True))
