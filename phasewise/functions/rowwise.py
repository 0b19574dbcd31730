"""Arithmetic across the columns of one row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_sum(cols: Iterable[Column]) -> Column:
    """Sum over columns, a missing value counting as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])


def row_mean_strict(cols: Sequence[Column]) -> Column:
    """Mean over columns, missing as soon as one of them is."""
    return reduce(lambda a, b: a + b, cols) / len(cols)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, missing when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(col: Column) -> Column:
    return col * 100


def standardize(col: Column, mean: float, sd: float) -> Column:
    return (col - mean) / sd


def rescale(z: Column, mean: float, sd: float) -> Column:
    return z * sd + mean


def with_differences(df: DataFrame, later: str = "_phase2", earlier: str = "_phase1") -> DataFrame:
    """``<name>_difference`` = later minus earlier, for every column ending in ``later``."""
    stems = [c[: -len(later)] for c in df.columns if c.endswith(later)]
    return df.withColumns(
        {f"{s}_difference": F.col(s + later) - F.col(s + earlier) for s in stems}
    )


def reverse_sign(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({n: -F.col(n) for n in names})
