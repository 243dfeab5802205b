"""Exact, reproducible samples, splits and folds without sorting or shuffling the wide rows.

Rows are ordered by a hash of their key. The cut of each class is found from a count per
(class, hash slice), then only the rows of the cut slice are ranked; the wide table is
read once more and compared with the cut. Keys must be unique for exact sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 8192
ROWS_PER_SLICE = 100_000


def hash_order(keys: Sequence[str], seed: int) -> tuple[Column, int]:
    """Default ordering: a 62-bit hash of seed and key, with its modulus."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 62)), 1 << 62


def arithmetic_order(terms: dict[str, int], modulus: int = 1_000_003) -> tuple[Column, int]:
    """Ordering any SQL engine can repeat: sum of key * factor modulo `modulus`."""
    total = None
    for c, factor in terms.items():
        term = F.col(c).cast("bigint") * F.lit(factor).cast("bigint")
        total = term if total is None else total + term
    return F.pmod(total, F.lit(modulus).cast("bigint")), modulus


def _cuts(df: DataFrame, by: Column, keys: Sequence[str], order: tuple[Column, int], counts: dict[str, Column]):
    """Per class (struct column __class) the (order, key) struct of the row at each 1-based rank in
    `counts`, columns that are functions of the class size __n. A rank of 0 gives NULL.
    """
    h, modulus = order
    width = -(-modulus // max(SLICES, df.count() // ROWS_PER_SLICE))  # slices follow the rows
    narrow = df.select(by.alias("__class"), h.alias("__h"), *keys).withColumn("__slice", F.expr(f"__h div {width}"))
    sizes = narrow.groupBy("__class", "__slice").agg(F.count(F.lit(1)).alias("__c"))
    so_far = Window.partitionBy("__class").orderBy("__slice").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sizes.select(
        "__class",
        "__slice",
        (F.sum("__c").over(so_far) - F.col("__c")).alias("__before"),
        F.sum("__c").over(so_far).alias("__upto"),
        F.sum("__c").over(Window.partitionBy("__class")).alias("__n"),
    )
    wanted = F.array(*[F.struct(F.lit(n).alias("cut"), c.alias("rank")) for n, c in counts.items()])
    ranks = sizes.select("__class", "__slice", "__before", "__upto", F.inline(wanted))
    hit = ranks.where((F.col("rank") > F.col("__before")) & (F.col("rank") <= F.col("__upto")))
    edge_rows = narrow.join(F.broadcast(hit), ["__class", "__slice"])  # a row per class and cut
    place = Window.partitionBy("__class", "__slice", "cut").orderBy("__h", *keys)
    ranked = edge_rows.withColumn("__at", F.col("__before") + F.row_number().over(place))
    ranked = ranked.where(F.col("__at") == F.col("rank"))
    return ranked.groupBy("__class").pivot("cut", list(counts)).agg(F.first(F.struct("__h", *keys)))


def _with_cuts(df, by, keys, order, counts) -> DataFrame:
    """df with the cut structs of its class, and its own place `__row` to compare with them."""
    cuts = _cuts(df, by, keys, order, counts)
    entry = F.struct(F.struct("__class").alias("key"), F.struct(*counts).alias("value"))
    found = cuts.agg(F.map_from_entries(F.collect_list(entry)).alias("cuts")).scalar()  # an entry per class
    placed = df.withColumn("__row", F.struct(order[0].alias("__h"), *keys))
    placed = placed.withColumn("__cut", F.try_element_at(found, F.struct(by.alias("__class"))))
    return placed.withColumns({c: F.col("__cut").getField(c) for c in counts}).drop("__cut")


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int = 42,
    holdout: float = 0.30,
    test_share: float = 0.50,
    order: tuple[Column, int] | None = None,
    name: str = "split",
) -> DataFrame:
    """train / val / test with the same class shares: holdout rows of each class leave train, and
    test_share of those go to test. Sizes are exact (rounded half up per class)."""
    order = order or hash_order(keys, seed)
    n = F.col("__n")
    held = F.floor(n * F.lit(holdout) + 0.5)
    tested = F.floor(held * F.lit(test_share) + 0.5)
    joined = _with_cuts(df, F.struct(label), keys, order, {"__train_end": n - held, "__val_end": n - tested})
    before = lambda c: F.col(c).isNotNull() & (F.col("__row") <= F.col(c))
    split = F.when(before("__train_end"), "train").when(before("__val_end"), "val").otherwise("test")
    return joined.select(*df.columns, split.alias(name))


def sample_n(
    df: DataFrame, n: int = 10_000, keys: Sequence[str] = (), seed: int = 42, order: tuple[Column, int] | None = None
) -> DataFrame:
    """Exactly n rows (all rows when there are fewer), the same ones on every run."""
    order = order or hash_order(keys or df.columns, seed)
    keys = list(keys or df.columns)
    joined = _with_cuts(df, F.lit(0), keys, order, {"__end": F.least(F.col("__n"), F.lit(n))})
    return joined.where(F.col("__row") <= F.col("__end")).select(*df.columns)


def stratified_folds(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    k: int = 5,
    seed: int = 42,
    order: tuple[Column, int] | None = None,
    name: str = "fold",
) -> DataFrame:
    """Fold number 0..k-1; each class is cut into k runs of equal size (first folds take the remainder)."""
    order = order or hash_order(keys, seed)
    n = F.col("__n")
    ends = {f"__e{i}": F.floor(n / k) * i + F.least(F.lit(i).cast("bigint"), n % k) for i in range(1, k)}
    joined = _with_cuts(df, F.struct(label), keys, order, ends)
    fold = None
    for i in range(1, k):
        inside = F.col(f"__e{i}").isNotNull() & (F.col("__row") <= F.col(f"__e{i}"))
        fold = F.when(inside, i - 1) if fold is None else fold.when(inside, i - 1)
    return joined.select(*df.columns, fold.otherwise(k - 1).alias(name))


def temporal_split(df: DataFrame, ts: str, train_end: str, val_end: str, name: str = "split") -> DataFrame:
    """Rows before train_end, before val_end, and the rest. No shuffle."""
    t = F.col(ts)
    return df.withColumn(
        name,
        F.when(t < F.lit(train_end).cast(df.schema[ts].dataType), "train")
        .when(t < F.lit(val_end).cast(df.schema[ts].dataType), "val")
        .otherwise("test"),
    )


def time_folds(df: DataFrame, ts: str, edges: Sequence, name: str = "fold") -> DataFrame:
    """Fold i holds rows in [edges[i-1], edges[i]); fold 0 is everything before edges[0]."""
    fold = F.lit(0)
    for e in edges:
        fold = fold + (F.col(ts) >= F.lit(e)).cast("int")
    return df.withColumn(name, fold)


def expanding_folds(folds: DataFrame, k: int, fold: str = "fold") -> list[tuple[DataFrame, DataFrame]]:
    """(train, validate) pairs: validate on fold i, train on every earlier fold."""
    return [(folds.where(F.col(fold) < i), folds.where(F.col(fold) == i)) for i in range(1, k + 1)]


def split_sizes(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows and positive percentage per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.col(label).cast("double")) * 100, 4).alias("positive_pct")
    )
