"""Global order statistics without a single-task sort.

Running totals, ranks and exact quantiles need a global order.  A window
without ``partitionBy`` would pull the whole table into one task, so the order
axis is cut into ranges holding about the same number of rows.  Totals per range
are small (at most ``buckets`` rows per group) and give every range its starting
offset; inside a range an ordinary window finishes the job.  A group that holds a third
of all rows is spread over a third of the ranges.

The range bounds come from Spark's approximate quantiles and enter the plan as
literals.  They only decide how even the ranges are, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "__range"
TOTAL = "__total"
MIN_BUCKETS = 256
SMALL_ROWS = 100_000


def bucket_default(df: DataFrame) -> int:
    """As many ranges as shuffle partitions, and enough for all cores to have work."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MIN_BUCKETS)


def has_value(df: DataFrame, column: str) -> Column:
    """Neither NULL nor NaN."""
    known = F.col(column).isNotNull()
    fractional = isinstance(df.select(column).schema[0].dataType, (T.DoubleType, T.FloatType))
    return known & ~F.isnan(F.col(column)) if fractional else known


def range_bounds(df: DataFrame, column: str, buckets: int | None = None) -> list[float]:
    """Ascending, distinct bounds that cut ``column`` into about equal parts."""
    buckets = buckets or bucket_default(df)
    if buckets < 2:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    numeric = df.where(has_value(df, column)).select(F.col(column).cast("double").alias(column))
    found = numeric.approxQuantile(column, probs, 1.0 / (4 * buckets))
    return sorted(set(found or []))


def with_range(df: DataFrame, column: str, bounds: Sequence[float], name: str = BUCKET) -> DataFrame:
    """Add the number of bounds at or below ``column``: a binary search inside generated code.

    NULL goes to the first range, where an ascending order puts it too.
    """
    inner = [b for b in bounds if math.isfinite(b)]
    if not inner:
        return df.withColumn(name, F.lit(0))
    search = Bucketizer(inputCol="__double", outputCol="__found", splits=[-math.inf, *inner, math.inf],
                        handleInvalid="keep")
    found = search.transform(df.withColumn("__double", F.col(column).cast("double")))
    return found.withColumn(name, F.coalesce(F.col("__found").cast("int"), F.lit(0))).drop("__double", "__found")


def _range_offsets(tagged: DataFrame, by: Sequence[str], measures: dict[str, str], descending: bool) -> DataFrame:
    """One row per (group, range): what precedes the range, and the group total."""
    totals = tagged.groupBy(*by, BUCKET).agg(*[F.sum(m).alias(f"__sum_{m}") for m in measures])
    edge = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    before = Window.partitionBy(*by).orderBy(edge).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    return totals.select(
        *by, BUCKET,
        *[F.col(f"__sum_{m}") for m in measures],
        *[F.coalesce(F.sum(f"__sum_{m}").over(before), F.lit(0)).alias(f"__off_{m}") for m in measures],
        *[F.sum(f"__sum_{m}").over(whole).alias(f"__all_{m}") for m in measures],
    )


def running_totals(df: DataFrame, order: str, measures: dict[str, str], by: Sequence[str] = (),
                   descending: bool = False, buckets: int | None = None,
                   totals: dict[str, str] | None = None, bounds: Sequence[float] | None = None) -> DataFrame:
    """Add inclusive running sums over ``order`` inside each ``by`` group.

    ``measures`` maps an input column to the name of its running sum, ``totals``
    (optional) to the name of its group total.  ``(by, order)`` must be unique in
    ``df``: aggregate first, which also folds hot values into single rows.  ``bounds``
    may come from the rows before that aggregation, to save running it once more.
    """
    tagged = with_range(df, order, range_bounds(df, order, buckets) if bounds is None else bounds)
    offsets = _range_offsets(tagged, by, measures, descending)
    edge = F.col(order).desc() if descending else F.col(order).asc()
    inside = (Window.partitionBy(*by, BUCKET).orderBy(edge)
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = tagged.join(offsets, [*by, BUCKET])
    return joined.select(
        *[c for c in df.columns],
        *[(F.sum(m).over(inside) + F.col(f"__off_{m}")).alias(name) for m, name in measures.items()],
        *[F.col(f"__all_{m}").alias(name) for m, name in (totals or {}).items()],
    )


def values_at_ranks(df: DataFrame, value: str, ranks: dict[str, Callable[[Column], Column]],
                    by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Per group, the values at given zero-based ranks, and the row count as ``TOTAL``.

    A first pass only counts rows per (group, range): a tiny shuffle.  The counts
    tell which ranges hold a wanted rank, and the second pass shuffles and orders
    those ranges alone, with equal values folded to a count.  ``ranks`` maps a
    name to a function from the group's row count to a rank.
    """
    present = df.where(has_value(df, value))
    tagged = with_range(present.select(*by, value), value, range_bounds(present, value, buckets))
    sizes = tagged.groupBy(*by, BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *by, BUCKET, F.col("__n").alias("__size"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
        F.sum("__n").over(Window.partitionBy(*by)).alias(TOTAL))

    def holds(rank: Column, start: str, size: str) -> Column:
        return (rank >= F.col(start)) & (rank < F.col(start) + F.col(size))

    wanted = F.lit(False)
    for rank in ranks.values():
        wanted = wanted | holds(rank(F.col(TOTAL)), "__off", "__size")
    picked = small_copy(offsets.where(wanted).drop("__size"))
    counts = (tagged.join(picked, [*by, BUCKET])
              .groupBy(*by, BUCKET, "__off", TOTAL, value).agg(F.count(F.lit(1)).alias("__n")))
    inside = (Window.partitionBy(*by, BUCKET).orderBy(value)
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counts.withColumn("__start", F.sum("__n").over(inside) + F.col("__off") - F.col("__n"))
    return placed.groupBy(*by).agg(F.max(TOTAL).alias(TOTAL), *[
        F.max(F.when(holds(rank(F.col(TOTAL)), "__start", "__n"), F.col(value))).alias(name)
        for name, rank in ranks.items()])


def small_copy(df: DataFrame) -> DataFrame:
    """A broadcast copy of a table whose size has been checked by fetching it.

    Beyond the limit the table stays distributed and Spark picks the join.
    """
    rows = df.limit(SMALL_ROWS + 1).toArrow()
    if rows.num_rows > SMALL_ROWS:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (),
                    buckets: int | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles per group (NULL and NaN ignored)."""
    def place(p: float, total: Column) -> Column:
        return F.lit(float(p)) * (total - 1)

    ranks: dict[str, Callable[[Column], Column]] = {}
    for name, p in probs.items():
        ranks[f"__lo_{name}"] = lambda total, p=p: F.floor(place(p, total))
        ranks[f"__hi_{name}"] = lambda total, p=p: F.ceil(place(p, total))
    found = values_at_ranks(df, value, ranks, by, buckets)

    def interpolate(name: str, p: float) -> Column:
        low, high = (F.col(f"__{end}_{name}").cast("double") for end in ("lo", "hi"))
        at = place(p, F.col(TOTAL))
        return (low + (high - low) * (at - F.floor(at))).alias(name)

    return found.select(*by, *[interpolate(name, p) for name, p in probs.items()])


def quantile_values(df: DataFrame, value: str, probs: Sequence[float],
                    buckets: int | None = None) -> list[float]:
    """Exact quantiles of one column as plain numbers, for use as model parameters."""
    named = {f"q{i}": p for i, p in enumerate(probs)}
    row = exact_quantiles(df, value, named, buckets=buckets).first()
    if row is None or row["q0"] is None:
        raise ValueError(f"no values in {value}")
    return [row[name] for name in named]


def order_cuts(df: DataFrame, key: str, fractions: dict[str, float], by: Sequence[str] = (),
               buckets: int | None = None) -> DataFrame:
    """Per group, the last key among the first ``round(fraction * rows)`` rows in key order.

    Comparing a row's key with a cut selects an exact share of every group
    without ranking the rows themselves.  A share of no rows has a NULL cut.
    """
    ranks = {name: (lambda total, f=f: F.floor(F.lit(float(f)) * total + F.lit(0.5)) - 1)
             for name, f in fractions.items()}
    return values_at_ranks(df, key, ranks, by, buckets).drop(TOTAL)
