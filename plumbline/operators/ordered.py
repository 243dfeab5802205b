"""Order-dependent sums and look-backs that never put one whole key into one task.

Every function cuts the order of a key into slices. Rows are sorted only inside
(key, slice); a second, tiny window runs over one summary row per (key, slice).
Any slice boundaries give the same result, so boundaries may come from a sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"
MAX_SLICES = 16_384


def position_in(value: Column, edges: Column, size: int) -> Column:
    """How many of the ascending `edges` are <= value, by binary search in the array."""
    step = 1
    while step * 2 <= size:
        step *= 2
    steps = []
    while step >= 1:
        steps.append(step)
        step //= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get(edges, at + s - 1) <= value, at + s).otherwise(at),
    )


def steps_passed(value: Column, edges: Sequence[float], strict: bool = False) -> Column:
    """How many of a few ascending constant edges are <= value (< value when strict): a balanced
    tree of comparisons, compiled with the rest of the stage. `value` should be a plain column."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        edge = F.lit(edges[middle])
        beyond = value > edge if strict else value >= edge
        return F.when(beyond, tree(middle + 1, high)).otherwise(tree(low, middle))

    return tree(0, len(edges))


def literal_array(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


def order_slices(df: DataFrame, order: str, rows_per_slice: int = 2_000_000) -> Column:
    """Slice number of each row by about equal counts of `order` (numeric or timestamp).

    One pass over one column; the driver sees at most MAX_SLICES boundaries.
    """
    numeric = _as_number(df, order)
    rows = df.select(F.count(numeric)).first()[0]
    wanted = min(MAX_SLICES, rows // rows_per_slice + 1)
    if wanted <= 1:
        return F.lit(0)
    shares = literal_array([i / wanted for i in range(1, wanted)])
    edges = df.select(F.percentile_approx(numeric, shares, 10 * wanted)).first()[0]
    edges = sorted(set(edges))
    return position_in(numeric, literal_array(edges), len(edges))


def _as_number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return F.unix_micros(F.col(name).cast("timestamp")) if kind.startswith("timestamp") else F.col(name)


KEY = "__key"


def _keyed(df: DataFrame, by: Sequence[str], part: str) -> DataFrame:
    """Key columns as one struct, which matches itself when fields are NULL and is never NULL itself:
    no row is lost in the join below and both sides read the same shuffled input."""
    key = F.struct(*by) if by else F.lit(0)
    rest = [c for c in df.columns if c not in {*by, part}]
    return df.select(key.alias(KEY), F.coalesce(F.col(part), F.lit(0)).alias(part), *rest)


def _key_columns(by: Sequence[str]) -> list[Column]:
    return [F.col(KEY)[c].alias(c) for c in by]


def running_sums(
    df: DataFrame,
    by: Sequence[str],
    part: str,
    order: Sequence[Column],
    sums: dict[str, str],
    totals: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    descending_parts: bool = False,
) -> DataFrame:
    """Inclusive running sums of `sums` (new name -> column) per `by`, in `order`.

    `part` must follow `order`: all rows of a lower slice come before those of a higher one.
    `totals` (new name -> column) adds whole-key totals, `following` (new name -> the column that
    gives the ascending order) its value in the next row. All sums of counts stay exact.
    """
    totals, following = totals or {}, following or {}
    rows = _keyed(df, by, part)
    columns = sorted(set(sums.values()) | set(totals.values()))
    per_slice = rows.groupBy(KEY, part).agg(
        *[F.sum(c).alias(f"__s_{c}") for c in columns], *[F.min(c).alias(f"__m_{n}") for n, c in following.items()]
    )
    slice_order = F.col(part).desc() if descending_parts else F.col(part).asc()
    before = Window.partitionBy(KEY).orderBy(slice_order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(KEY)
    offsets = per_slice.select(
        KEY,
        part,
        *[F.coalesce(F.sum(f"__s_{c}").over(before), F.lit(0)).alias(f"__o_{n}") for n, c in sums.items()],
        *[F.sum(f"__s_{c}").over(whole).alias(n) for n, c in totals.items()],
        *[F.lead(f"__m_{n}").over(Window.partitionBy(KEY).orderBy(slice_order)).alias(f"__m_{n}") for n in following],
    )
    inside = Window.partitionBy(KEY, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    near = Window.partitionBy(KEY, part).orderBy(*order)
    running = rows.select(
        "*",
        *[F.sum(c).over(inside).alias(f"__r_{n}") for n, c in sums.items()],
        *[F.lead(c).over(near).alias(f"__n_{n}") for n, c in following.items()],
    )
    return running.join(offsets, [KEY, part]).select(
        *_key_columns(by),
        *[c for c in df.columns if c not in by],
        *[(F.col(f"__r_{n}") + F.col(f"__o_{n}")).alias(n) for n in sums],
        *totals,
        *[F.coalesce(f"__n_{n}", f"__m_{n}").alias(n) for n in following],
    )


def previous_row(
    df: DataFrame, by: Sequence[str], part: str, order: Sequence[str], fields: Sequence[str], name: str = "prev"
) -> DataFrame:
    """Adds struct `name` with `fields` of the row before, per `by` in `order`, across slices.

    `order` must be unique within a key."""
    rows = _keyed(df, by, part)
    value = F.struct(*[F.col(f) for f in fields])
    tails = rows.groupBy(KEY, part).agg(F.max_by(value, F.struct(*order)).alias("__tail"))
    carried = tails.select(KEY, part, F.lag("__tail").over(Window.partitionBy(KEY).orderBy(part)).alias("__carry"))
    inside = Window.partitionBy(KEY, part).orderBy(*order)
    return (
        rows.withColumn("__lag", F.lag(value).over(inside))
        .join(carried, [KEY, part])
        .select(*_key_columns(by), *[c for c in df.columns if c not in by], F.coalesce("__lag", "__carry").alias(name))
    )


def last_known(
    df: DataFrame, by: Sequence[str], part: str, order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Adds `name`: the latest non-NULL `value` at or before each row, per `by`, across slices."""
    return last_known_all(df, by, part, order, {name: value})


def last_known_all(df: DataFrame, by: Sequence[str], part: str, order: Sequence[str], values: dict[str, str]) -> DataFrame:
    """last_known for several columns (new name -> column) in the same shuffle."""
    rows = _keyed(df, by, part)
    tails = rows.groupBy(KEY, part).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.struct(*order))).alias(f"__tail_{n}") for n, v in values.items()]
    )
    earlier = Window.partitionBy(KEY).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(KEY, part, *[F.last(f"__tail_{n}", ignorenulls=True).over(earlier).alias(f"__carry_{n}") for n in values])
    inside = Window.partitionBy(KEY, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.select("*", *[F.last(v, ignorenulls=True).over(inside).alias(f"__seen_{n}") for n, v in values.items()])
        .join(carried, [KEY, part])
        .select(*_key_columns(by), *[c for c in df.columns if c not in by], *[F.coalesce(f"__seen_{n}", f"__carry_{n}").alias(n) for n in values])
    )
