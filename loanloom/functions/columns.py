"""Small column expressions.  All run inside the JVM; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    """SQL ``ROUND`` on a double: ties go away from zero."""
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def half_even(value: Column, digits: int) -> Column:
    """Array-library rounding on a double: ties go to the even neighbour."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clamp to [low, high]; NULL stays NULL (``least``/``greatest`` would skip it)."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(value.isNotNull(), out)


def ratio_or(num: Column, den: Column, default: float = 0.0, when: Column | None = None) -> Column:
    """``num / den`` where the denominator is positive (and ``when`` holds), else a default."""
    guard = den > 0 if when is None else when & (den > 0)
    return F.when(guard, num / den).otherwise(F.lit(float(default)))


def flag(condition: Column) -> Column:
    """1 where true, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def share(condition: Column) -> Column:
    """Aggregate: fraction of rows where the condition holds."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def count_where(condition: Column) -> Column:
    """Aggregate: number of rows where the condition holds (0 for none)."""
    return F.sum(flag(condition))


def sum_where(condition: Column, value: Column) -> Column:
    """Aggregate: sum of ``value`` where the condition holds (0.0 for none)."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))


def pct(num: Column, den: Column) -> Column:
    """``100 * num / den``, NULL for a zero denominator."""
    return num / F.nullif(den, F.lit(0.0)) * F.lit(100.0)


def month_of(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "MM")


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` plus the number, zero-padded to ``width`` digits."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def as_percent(value: Column, digits: int = 1) -> Column:
    """Display text such as ``12.3%``."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.concat(F.call_function("format_number", value * 100, F.lit(pattern)), F.lit("%"))


def as_rupees(value: Column) -> Column:
    """Display text such as ``₹1,234,567``."""
    return F.concat(F.lit("₹"), F.format_number(value, 0))


def stable_hash(key: Column, seed: int) -> Column:
    """Non-negative 60-bit hash of a key, the same in any engine with MD5.

    Sampling and splitting by this value does not depend on how the rows are
    partitioned, so a retried task or another cluster size picks the same rows.
    """
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
