"""Growing and rotating text files as a stream of lines.

A file is known by its inode and its first line, not by its name, so a file that is renamed (rotated) is
read on from where it was, a new file under the old name is read from its start, and a file that was cut
off and written anew counts as new. Offsets are bytes of whole lines; a line is delivered when its line
break has been written. The folder must be one that the driver and every executor can open.
"""

from __future__ import annotations

import fnmatch
import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

BLOCK = 1 << 16
PART_BYTES = 64 << 20


@dataclass
class Stretch(InputPartition):
    """Lines of one file that begin in [start, end)."""

    key: str
    path: str
    begin: int
    start: int
    end: int


def first_line_mark(path: str) -> str | None:
    """Inode and a hash of the first line; None while that line is not finished."""
    with open(path, "rb") as f:
        line = f.readline(BLOCK)
        inode = os.fstat(f.fileno()).st_ino
    whole = line.endswith(b"\n") or len(line) == BLOCK
    return f"{inode}:{hashlib.sha1(line).hexdigest()[:16]}" if whole else None


def whole_lines(path: str) -> int:
    """Bytes up to and with the last line break, searched from the end."""
    with open(path, "rb") as f:
        at = f.seek(0, os.SEEK_END)
        while at > 0:
            size = min(BLOCK, at)
            at = f.seek(at - size)
            last = f.read(size).rfind(b"\n")
            if last >= 0:
                return at + last + 1
    return 0


class TailReader(DataSourceStreamReader):
    """Options: path (folder), pattern (of file names, default *)."""

    def __init__(self, options: dict):
        self.folder = options["path"].removeprefix("file://").removeprefix("file:")
        self.pattern = options.get("pattern", "*")
        self.part_bytes = int(options.get("partBytes", PART_BYTES))

    def files(self) -> dict[str, str]:
        found = {}
        for name in sorted(os.listdir(self.folder)):
            path = os.path.join(self.folder, name)
            if fnmatch.fnmatch(name, self.pattern) and not name.startswith(("_", ".")) and os.path.isfile(path):
                try:
                    mark = first_line_mark(path)
                except FileNotFoundError:  # renamed since it was listed
                    continue
                if mark:
                    found[mark] = path
        return found

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Mark of each file -> [path, bytes of whole lines]; files that are gone leave the offsets."""
        return {mark: [path, whole_lines(path)] for mark, path in self.files().items()}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for mark, (path, stop) in sorted(end.items()):
            begin = start[mark][1] if mark in start else 0
            for at in range(begin, stop, self.part_bytes):
                out.append(Stretch(mark, path, begin, at, min(stop, at + self.part_bytes)))
        return out

    def read(self, part: Stretch) -> Iterator[tuple]:
        path = part.path
        if not os.path.exists(path) or first_line_mark(path) != part.key:
            path = self.files().get(part.key, "")  # renamed since the batch was planned
            if not path:
                raise FileNotFoundError(f"{part.path} was removed before its lines were read")
        with open(path, "rb") as f:
            f.seek(part.start)
            if part.start > part.begin:  # the line that began before this stretch belongs to the one before
                f.seek(part.start - 1)
                f.readline()
            while (at := f.tell()) < part.end:
                line = f.readline()
                yield part.key, os.path.basename(part.path), at, line.rstrip(b"\r\n").decode("utf-8", "replace")

    def commit(self, end: dict) -> None:
        pass


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return "file string, name string, at long, line string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


def tail(spark: SparkSession, folder: str, pattern: str = "*"):
    """(file, name, at, line) of the text files of a folder as a stream; at is the line's first byte."""
    spark.dataSource.register(TailSource)
    return spark.readStream.format("tail").option("path", folder).option("pattern", pattern).load()
