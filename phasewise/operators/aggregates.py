"""Grouped summaries that know about missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATS = ("n", "mean", "sd", "min", "max")


def stat_columns(
    name: str, stats: Sequence[str] = STATS, only: Column | None = None, prefix: str | None = None
) -> list[Column]:
    """``<name>_<stat>`` aggregates over the non-missing values of a column.

    ``only`` restricts them to rows where the condition holds.  The sample standard
    deviation of a single value, and any statistic of nothing, is missing.
    """
    value = F.col(f"`{name}`")
    if only is not None:
        value = F.when(only, value)
    makers = {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.avg(c),
        "sd": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
        "sum": lambda c: F.sum(c),
    }
    label = name if prefix is None else prefix
    return [makers[s](value).alias(f"{label}_{s}") for s in stats]


def stat_bundle(
    df: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    stats: Sequence[str] = STATS,
    only: Column | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Statistics of many columns in one aggregation."""
    aggs = [a for c in columns for a in stat_columns(c, stats, only)]
    return df.groupBy(*by).agg(*extra, *aggs)


def level_and_overall(
    df: DataFrame, ids: Sequence[str], level: str, aggs: Sequence[Column], overall: str = "overall"
) -> DataFrame:
    """Aggregate per id and level, and per id over all levels, in one pass.

    Two grouping sets: rows are doubled in flight, before the map-side combine, so only
    partial results are shuffled.  A missing level stays apart from the total.
    """
    total = F.grouping(level)
    out = df.groupingSets(
        [[*map(F.col, ids), F.col(level)], [*map(F.col, ids)]], *ids, level
    ).agg(total.alias("__total"), *aggs)
    label = F.when(F.col("__total") == 1, F.lit(overall)).otherwise(F.col(level).cast("string"))
    return out.withColumn(level, label).drop("__total")


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; unknown does not count."""
    return F.count_if(condition)


def sum_columns(df: DataFrame, by: Sequence[str], columns: Sequence[str], prefix: str = "total_"):
    """Sums with missing values ignored; the sum of nothing is 0."""
    return df.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(prefix + c) for c in columns]
    )


def strict_sum(value: Column) -> Column:
    """Sum that is missing as soon as one value of the group is."""
    return F.when(F.count("*") == F.count(value), F.sum(value))


def distinct_counts(
    df: DataFrame, by: Sequence[str], item: str, conditions: dict[str, Column | None],
    lists: bool = False, count_missing: bool = False,
) -> DataFrame:
    """Per group and condition: number of distinct items among the rows that satisfy it.

    Rows are first reduced to one per group and item with a flag per condition, so every
    count is a plain sum, however many conditions there are; count-distinct would expand the
    input once per condition.  The first reduction keys on the item too, which spreads a hot
    group.  ``lists`` adds ``<name>_list``: the items sorted and joined by ", ".
    ``count_missing`` lets a missing item count as one more value.
    """
    def flag(condition: Column | None) -> Column:
        hit = F.lit(1) if condition is None else F.when(condition, 1).otherwise(0)
        return F.max(hit)

    items = df.groupBy(*by, item).agg(*[flag(c).alias(n) for n, c in conditions.items()])
    known = F.lit(True) if count_missing else F.col(item).isNotNull()
    aggs = [F.count_if(known & (F.col(n) == 1)).alias(n) for n in conditions]
    if lists:
        aggs += [
            F.array_join(
                F.array_sort(F.collect_list(F.when(F.col(n) == 1, F.col(item)))), ", "
            ).alias(f"{n}_list")
            for n in conditions
        ]
    return items.groupBy(*by).agg(*aggs)


def approx_distinct(df: DataFrame, by: Sequence[str], item: str, name: str) -> DataFrame:
    """Sketch-based distinct count, missing values not counted."""
    return df.groupBy(*by).agg(F.approx_count_distinct(item).alias(name))


def category_counts(
    df: DataFrame, variable: str, by: str | None = None, levels: Sequence[str] | None = None
) -> DataFrame:
    """Rows per level (and stratum) with the share of the non-missing rows of the stratum."""
    keys = [variable] + ([by] if by else [])
    counts = df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col(variable).isNotNull())
    if levels is not None:
        counts = counts.filter(F.col(variable).isin(*levels))
    totals = counts.groupBy(*([by] if by else [])).agg(F.sum("n").alias("total"))
    if by:
        return counts.join(totals, by).withColumn("p", F.col("n") / F.col("total")).drop("total")
    return counts.withColumn("p", F.col("n") / totals.select("total").scalar())
