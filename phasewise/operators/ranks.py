"""Mid-ranks and ordinals over data of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 10_000  # distinct values of a range
GRID = 4096  # ranges of a variable at most


def value_counts(df: DataFrame, variable: str, value: str, group: str | None = None) -> DataFrame:
    """Rows per distinct value: ``n``, and per stratum of ``group`` if given."""
    keys = [variable, value] + ([group] if group else [])
    return (
        df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count("*").cast("long").alias("n"))
    )


def mid_ranks(
    counts: DataFrame,
    variable: str = "variable",
    value: str = "value",
    buckets: int = BUCKETS,
    with_before: bool = False,
) -> DataFrame:
    """Add ``rank`` to (variable, value, n): the mean rank of the n tied rows.

    A running sum over all values would be one window in one task.  The distinct values of each
    variable are cut into ranges at their approximate quantiles, one for every ``buckets``
    values; each range is summed by itself and shifted by the rows in the ranges before it.
    Bounds and shifts are part of the plan, and where the cuts fall does not change the result.
    ``with_before`` adds ``before``, the rows of smaller values.
    """
    # Quantiles of the distinct values, sorted: one small row per variable.  The percentages
    # depend on the number of values, so a digest of fixed size is asked for at even steps and the
    # steps are then thinned to the number of ranges wanted.
    grid = [i / GRID for i in range(1, GRID)]
    bounds = counts.groupBy(variable).agg(
        F.percentile_approx(value, grid, 10 * GRID).alias("__grid"), F.count("*").alias("__values")
    )
    ranges = F.least(F.greatest(F.ceil(F.col("__values") / buckets), F.lit(1)), F.lit(GRID)).cast("int")
    every = F.greatest(F.floor(F.lit(GRID) / ranges), F.lit(1)).cast("int")
    thinned = F.filter("__grid", lambda _, i: (i + 1) % F.col("__every") == 0)
    bounds = bounds.withColumn("__every", every).select(
        F.col(variable).alias("__variable"), F.array_sort(F.array_distinct(thinned)).alias("__bounds")
    )
    own = F.col(variable).eqNullSafe(F.col("__variable"))
    placed = counts.join(bounds, own).withColumn("__bucket", _place(F.col(value))).drop("__variable", "__bounds")
    # One row per variable and range: a bounded window.
    before = Window.partitionBy(variable).orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        placed.groupBy(variable, "__bucket")
        .agg(F.sum("n").alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .select(F.col(variable).alias("__variable"), F.col("__bucket").alias("__range"), "__before")
    )
    inside = Window.partitionBy(variable, "__bucket").orderBy(value).rowsBetween(
        Window.unboundedPreceding, 0
    )
    same = F.col(variable).eqNullSafe(F.col("__variable")) & (F.col("__bucket") == F.col("__range"))
    ranked = (
        placed.join(offsets, same)
        .withColumn("before", F.col("__before") + F.sum("n").over(inside) - F.col("n"))
        .withColumn("rank", F.col("before") + (F.col("n") + 1) / 2)
        .drop("__bucket", "__before", "__variable", "__range")
    )
    return ranked if with_before else ranked.drop("before")


def _leading(df: DataFrame, column: str) -> Column:
    """A number that never falls as the column rises: numbers and times as they are, of texts the
    first six bytes.  Missing values come first."""
    kind, c = dict(df.dtypes)[column], F.col(f"`{column}`")
    if kind == "string":
        number = F.conv(F.rpad(F.substring(F.hex(c.cast("binary")), 1, 12), 12, "0"), 16, 10).cast("double")
    elif kind in ("date", "timestamp", "timestamp_ntz"):
        number = F.unix_micros(c.cast("timestamp")).cast("double")
    else:
        number = c.cast("double")
    return F.coalesce(number, F.lit(float("-inf")))


def ordinals(df: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Add the place of each row, from 1, in ascending order of the columns, missing values first.

    Unlike a numbering over one window this cuts the rows into ranges at approximate quantiles of
    the first column, numbers each and shifts it by the rows before.  The columns should tell rows
    apart: of equal rows either may come first.
    """
    lead = _leading(df, order[0])
    grid = [i / GRID for i in range(1, GRID)]
    bounds = df.select(F.percentile_approx(lead, grid, 10 * GRID).alias("b")).select(
        F.array_sort(F.array_distinct("b"))
    )
    placed = df.withColumn("__bounds", F.coalesce(bounds.scalar(), F.array().cast("array<double>")))
    placed = placed.withColumn("__bucket", _place(lead)).drop("__bounds")
    # At most GRID rows.
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("__bucket").agg(F.count("*").alias("__rows")).select(
        F.col("__bucket").alias("__range"), F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy("__bucket").orderBy(*[F.asc_nulls_first(c) for c in order])
    return (
        placed.join(before, F.col("__bucket") == F.col("__range"))
        .withColumn(name, F.col("__before") + F.row_number().over(inside))
        .drop("__bucket", "__range", "__before")
    )


def _place(value: Column) -> Column:
    """How many of the sorted bounds lie below the value, by halving."""
    start = F.struct(F.lit(0).alias("low"), F.size("__bounds").alias("high"))

    def halve(s: Column, _) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        lower = (s["low"] < s["high"]) & (F.get("__bounds", middle) < value)
        return F.struct(
            F.when(lower, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(lower, s["high"]).otherwise(F.least(middle, s["high"])).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit(GRID.bit_length() + 1))
    return F.aggregate(steps, start, halve, lambda s: s["low"])
