"""Listing and decoding stored objects as tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes whose objects are returned as text.
TEXT_SUFFIXES = (
    ".txt", ".log", ".json", ".xml", ".yml", ".yaml", ".md", ".csv", ".ini",
    ".conf", ".py", ".js", ".html", ".css", ".sh", ".bash", ".cfg", ".properties",
)


def scan(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """path, modificationTime, length, content of every object below root; content is read only when selected."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)


def with_names(objects: DataFrame, root: str) -> DataFrame:
    """Adds container (first folder below root) and key (the rest of the path)."""
    base = root.rstrip("/").split("://")[-1].removeprefix("file:")
    below = F.substring_index("path", base + "/", -1)
    shape = "^(?:([^/]*)/)?(.*)$"
    return objects.withColumn("container", F.regexp_extract(below, shape, 1)).withColumn(
        "key", F.regexp_extract(below, shape, 2)
    )


PAGE = "container string, key string, length long, modificationTime timestamp"


class Lister:
    """Folder listings of any file system Spark can reach, one folder at a time, and how many entries they had."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root, self.entries = spark._jvm, root.rstrip("/"), 0
        self.fs = self.jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def folder(self, path: str) -> list[tuple[str, bool, int, int]]:
        """(name, is folder, bytes, modified at in ms) in the order of the keys below: a folder's name ends with /."""
        at = self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}" if path else self.root)
        if not self.fs.exists(at):
            return []
        found = [(s.getPath().getName() + ("/" if s.isDirectory() else ""), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in self.fs.listStatus(at)]
        self.entries += len(found)
        return sorted(f for f in found if not f[0].startswith(("_", ".")))

    def keys(self, container: str, prefix: str, start_after: str, at: str = "") -> Iterator[tuple[str, int, int]]:
        """(key, bytes, modified at) after start_after that begin with prefix, in order; folders that cannot
        hold such a key are not entered, and none is entered before its turn."""
        for name, is_folder, size, modified in self.folder(f"{container}/{at}".rstrip("/")):
            key = at + name
            if is_folder:
                if (key.startswith(prefix) or prefix.startswith(key)) and key >= start_after[: len(key)]:
                    yield from self.keys(container, prefix, start_after, key)
            elif key.startswith(prefix) and key > start_after:
                yield key, size, modified


def containers_page(spark: SparkSession, root: str, allowed: Sequence[str] = (), start_after: str = "", limit: int = 5) -> DataFrame:
    """containers() from one listing of the root folder; nothing below it is read."""
    names = [n.rstrip("/") for n, is_folder, *_ in Lister(spark, root).folder("") if is_folder]
    kept = [n for n in sorted(names) if n > start_after and (not allowed or n in allowed)][:limit]
    return spark.createDataFrame([(n,) for n in kept], "container string")


def objects_page(
    spark: SparkSession, root: str, container: str, allowed: Sequence[str] = (), prefix: str = "", start_after: str = "",
    max_keys: int = 1000, lister: Lister | None = None,
) -> DataFrame:
    """list_objects() by a listing in key order that enters only folders which can hold the page and stops
    when it is full. The page, at most max_keys rows, is made on the driver."""
    from datetime import datetime, timezone
    from itertools import islice

    found: list[tuple] = []
    if not allowed or container in allowed:
        lister = lister or Lister(spark, root)
        for key, size, modified in islice(lister.keys(container, prefix, start_after), max_keys):
            found.append((container, key, size, datetime.fromtimestamp(modified / 1000, timezone.utc)))
    return spark.createDataFrame(found, PAGE)


def containers(
    objects: DataFrame, allowed: Sequence[str] = (), start_after: str = "", limit: int = 5
) -> DataFrame:
    """Container names after start_after in order, at most `limit`; an allow-list restricts them."""
    names = objects.select("container").distinct().where(F.col("container") > start_after)
    if allowed:
        names = names.where(F.col("container").isin(*allowed))
    return names.orderBy("container").limit(limit)


def list_objects(
    objects: DataFrame,
    container: str,
    allowed: Sequence[str] = (),
    prefix: str = "",
    start_after: str = "",
    max_keys: int = 1000,
) -> DataFrame:
    """One page of a container's keys; empty when the container is not allowed."""
    page = objects.where(F.col("container") == container)
    if allowed and container not in allowed:
        page = page.where(F.lit(False))
    return (
        page.where(F.col("key").startswith(prefix) & (F.col("key") > start_after))
        .select("container", "key", "length", "modificationTime")
        .orderBy("key")
        .limit(max_keys)
    )


def is_text(key: Column | str) -> Column:
    key = F.lower(F.col(key) if isinstance(key, str) else key)
    test = key.endswith(TEXT_SUFFIXES[0])
    for suffix in TEXT_SUFFIXES[1:]:
        test = test | key.endswith(suffix)
    return test


def body(content: Column | str, key: Column | str) -> Column:
    """UTF-8 text for text suffixes, base64 for the rest."""
    content = F.col(content) if isinstance(content, str) else content
    return F.when(is_text(key), F.decode(content, "UTF-8")).otherwise(F.base64(content))
