"""Column expressions shared by batch and streaming code. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def soft_cast(c: Column | str, type_name: str) -> Column:
    """Cast that yields NULL for bad text; an integer keeps every digit, and '3.7' becomes 3."""
    c = _col(c)
    if type_name in ("int", "bigint", "smallint", "tinyint"):
        return F.coalesce(c.try_cast(type_name), c.try_cast("double").try_cast(type_name))
    return c.try_cast(type_name)


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def cap(c: Column | str, ceiling: float | Column) -> Column:
    """Upper cap that keeps NULL (least() would turn it into the cap)."""
    c = _col(c)
    ceiling = ceiling if isinstance(ceiling, Column) else F.lit(ceiling)
    return F.when(c > ceiling, ceiling).otherwise(c)


def winsorize(c: Column | str, low: float | None, high: float | None) -> Column:
    """Two-sided clip that keeps NULL; a missing bound leaves its side alone."""
    c = _col(c)
    out = F.when(c.isNull(), c)
    if low is not None:
        out = out.when(c < F.lit(low), F.lit(low))
    if high is not None:
        out = out.when(c > F.lit(high), F.lit(high))
    return out.otherwise(c)


def is_missing(c: Column | str) -> Column:
    return _col(c).isNull().cast("int")


def weighted_sum(weights: dict[str, float]) -> Column:
    """NULL in any term gives NULL."""
    terms = [F.col(c) * F.lit(w) for c, w in weights.items()]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total.cast("float")


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator, NULL unless the denominator is positive."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d > 0, F.try_divide(n, d)).cast("float")


def remaining_share(whole: Column | str, part: Column | str) -> Column:
    """(whole - part) / whole, 0.0 when whole is missing or not positive."""
    w, p = _col(whole), _col(part)
    return F.when(w > 0, (w - p).cast("float") / w.cast("float")).otherwise(F.lit(0.0))


def ordered_bucket(c: Column | str, bounds: Sequence[float], names: Sequence[str]) -> Column:
    """names[i] for the first bound above c; the last name also takes NULL."""
    c = _col(c)
    out = None
    for bound, label in zip(bounds, names):
        out = F.when(c < bound, F.lit(label)) if out is None else out.when(c < bound, F.lit(label))
    return out.otherwise(F.lit(names[-1]))


def any_event(c: Column | str) -> Column:
    return F.when(_col(c) > 0, 1).otherwise(0)


def decide(probability: Column | str, threshold: float | Column) -> Column:
    """1 when probability >= threshold (inclusive)."""
    return (_col(probability) >= threshold).cast("int")


def text_or_missing(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("missing"))


def ordinal(c: Column | str, order: Sequence[str]) -> Column:
    """Position in a fixed order as double, -1.0 for anything else."""
    pairs = [x for i, v in enumerate(order) for x in (F.lit(v), F.lit(float(i)))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(c)), F.lit(-1.0))


def month_key(prefix: str, year: Column | str, month: Column | str, suffix: str) -> Column:
    """prefix<year>-<two-digit month>suffix."""
    return F.format_string(f"{prefix}%d-%02d{suffix}", _col(year).cast("int"), _col(month).cast("int"))


def band(c: Column | str, yellow: float, red: float) -> Column:
    """green / yellow / red with inclusive lower bounds."""
    c = _col(c)
    return F.when(c >= red, "red").when(c >= yellow, "yellow").when(c.isNotNull(), "green")


def yes_no(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c == 1, "Yes").when(c == 0, "No")


def percent_text(c: Column | str) -> Column:
    """0.1234 -> '12.34%' (at most four significant digits)."""
    return F.concat(_significant(_col(c) * 100), F.lit("%"))


def _significant(c: Column) -> Column:
    """Four significant digits without trailing zeros, down to 0.0001."""
    size = F.abs(c)
    digits = F.when(size >= 1000, F.format_string("%.0f", c))
    for places, least in enumerate((100, 10, 1, 0.1, 0.01, 0.001), start=1):
        digits = digits.when(size >= least, F.format_string(f"%.{places}f", c))
    digits = digits.otherwise(F.format_string("%.7f", c))
    trimmed = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", "")
    return F.when(digits.contains("."), trimmed).otherwise(digits)


def human_number(c: Column | str) -> Column:
    """1234567 -> '1.235M'; steps of 1000 in both directions."""
    c = _col(c)
    size = F.abs(c)
    out = F.when(size == 0, F.lit("0"))
    for power, unit in ((18, "E"), (15, "P"), (12, "T"), (9, "G"), (6, "M"), (3, "k")):
        out = out.when(size >= 10.0**power, F.concat(_significant(c / 10.0**power), F.lit(unit)))
    out = out.when(size >= 1, _significant(c))
    for power, unit in ((3, "m"), (6, "u"), (9, "n")):
        out = out.when(size >= 10.0**-power, F.concat(_significant(c * 10.0**power), F.lit(unit)))
    return out.otherwise(c.cast("string"))


def fixed3(c: Column | str) -> Column:
    return F.format_string("%.3f", _col(c))
