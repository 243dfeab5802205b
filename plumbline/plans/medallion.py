"""Raw file to typed layer to feature layer: each layer is computed once, by its write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plumbline import schema as S
from plumbline.operators import clean
from plumbline.sources import files


@dataclass
class Layers:
    typed: str
    features: str
    typed_rows: int
    feature_rows: int


def _write_counted(df: DataFrame, root: str, date: str) -> int:
    """Write one date and return its rows, counted from the footers of the files just written."""
    files.write_partitioned(df, root, date)
    return files.read_partition(df.sparkSession, root, date).count()


def _check(rows: int, minimum: int, mode: str, layer: str) -> None:
    if mode == "training" and rows < minimum:
        raise ValueError(f"{layer} row count too low: {rows}")


def run(
    spark: SparkSession,
    raw_path: str,
    root: str,
    date: str,
    mode: str = "training",
    min_rows: int = S.MIN_TRAINING_ROWS,
    key: Sequence[str] = (),
) -> Layers:
    """Both layers of one date; other dates below root are left alone.

    `key` names typed columns that identify a row: ids of scoring rows are then the same however the
    rows are laid out. Without it they are only unique.

    The row gate of the typed layer is checked on the rows just written; a date that fails is
    reported before the feature layer is built.
    """
    typed_root, feature_root = f"{root}/typed", f"{root}/features"
    typed_rows = _write_counted(clean.clean(files.read_csv(spark, raw_path), mode), typed_root, date)
    _check(typed_rows, min_rows, mode, "typed")
    typed = files.read_partition(spark, typed_root, date).drop(S.PARTITION)
    feature_rows = _write_counted(clean.feature_table(typed, mode, key), feature_root, date)
    _check(feature_rows, min_rows, mode, "feature")
    return Layers(typed_root, feature_root, typed_rows, feature_rows)
