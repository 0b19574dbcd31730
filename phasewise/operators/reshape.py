"""Long to wide, wide to long, date ranges to days."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewise.operators.joins import only_one


def unpivot_long(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str] | None = None,
    name: str = "variable",
    value: str = "value",
    dtype: str | None = None,
) -> DataFrame:
    """One row per id and column; ``dtype`` casts the columns to a common type first."""
    columns = [c for c in df.columns if c not in ids] if columns is None else list(columns)
    if dtype is not None:
        df = df.select(*ids, *[F.col(f"`{c}`").cast(dtype).alias(c) for c in columns])
    return df.unpivot(list(ids), [f"`{c}`" for c in columns], name, value)


def _pick(value: str, condition: Column, order: str | None) -> Column:
    if order is None:
        return F.first(F.when(condition, F.col(f"`{value}`")), ignorenulls=True)
    return F.min_by(F.col(f"`{value}`"), F.when(condition, F.col(order)))


def pivot_values(
    df: DataFrame,
    ids: Sequence[str],
    key: str,
    keys: Sequence,
    values: Sequence[str],
    template: str | Callable[[str, object], str] = "{value}_{key}",
    order: str | None = None,
) -> DataFrame:
    """Spread value columns over the given key values with conditional aggregates.

    One shuffle, combined map-side.  Names come from ``template``.  Where several rows share
    id and key, ``order`` names the column whose smallest value decides; without it the same
    aggregate counts them, and the job fails rather than leave the choice to chance.
    """

    def label(v: str, k) -> str:
        return template(v, k) if callable(template) else template.format(value=v, key=k)

    cells = [(label(v, k), i, v, F.col(f"`{key}`") == F.lit(k)) for v in values for i, k in enumerate(keys)]
    aggs = [_pick(v, here, order).alias(name) for name, _, v, here in cells]
    if order is not None:
        return df.groupBy(*ids).agg(*aggs)
    rows = [F.count_if(F.col(f"`{key}`") == F.lit(k)).alias(f"__rows{i}") for i, k in enumerate(keys)]
    wide = df.groupBy(*ids).agg(*aggs, *rows)
    return wide.select(
        *ids, *[only_one(F.col(f"__rows{i}"), F.col(f"`{name}`")).alias(name) for name, i, *_ in cells]
    )


def pivot_one(
    df: DataFrame, ids: Sequence[str], key: str, keys: Sequence, value: str
) -> DataFrame:
    """Spread one value column; the new columns are named after the keys."""
    return pivot_values(df, ids, key, keys, [value], template="{key}")


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pass rows through; the job fails if a key occurs twice.

    The check is an aggregate of its own joined back by key, so it costs a second pass.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    joined = df.join(counts, list(keys), "inner")
    guard = F.when(
        F.col("__n") > 1, F.raise_error(F.lit(f"duplicate key in {list(keys)}")).cast("int")
    )
    return joined.filter(guard.isNull()).drop("__n").select(*df.columns)


def explode_days(df: DataFrame, start: str, end: str, day: str = "date") -> DataFrame:
    """One row per day of each closed range; an empty or reversed range gives none."""
    days = F.when(F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end)))
    return df.withColumn(day, F.explode(days))


def insert_headers(table: DataFrame, headers: DataFrame, order: str = "row_order") -> DataFrame:
    """Add header rows to a display table; fractional ``row_order`` values place them."""
    return table.unionByName(headers, allowMissingColumns=True).orderBy(order)
