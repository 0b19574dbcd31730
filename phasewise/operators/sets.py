"""Stacking frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames over the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_of_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Each frame without its own duplicates, stacked; a row in two frames appears twice."""
    return stack([f.distinct() for f in frames])


def stack_cohorts(frames: Mapping[str, DataFrame], column: str = "cohort") -> DataFrame:
    """Stack cohorts with unequal columns, the cohort's name first."""
    tagged = [df.select(F.lit(name).alias(column), "*") for name, df in frames.items()]
    return stack(tagged)
