"""Row selection."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewise.functions.recode import parse_threshold


def in_scope(id_col: Column, prefix: str | None = None, excluded: Sequence[str] = ()) -> Column:
    """Ids of the cohort: starting with ``prefix`` and not listed as excluded.

    A plain predicate on one column, so it reaches the scan (``StartsWith`` is pushed down)
    and is inferred across id equi-joins.
    """
    keep = F.lit(True)
    if prefix:
        keep = id_col.startswith(prefix)
    if excluded:
        keep = keep & ~id_col.isin(*excluded)
    return keep


def id_like(id_col: Column, pattern: str) -> Column:
    """SQL LIKE on an encoded id; ``_`` stands for exactly one character.

    Spark runs a regular expression over every id as soon as a pattern has a ``_``.  The two
    forms that ids are searched by, ``%_TEXT_%`` and ``%_TEXT_1``, are plain comparisons here.
    """
    inner = re.fullmatch(r"%(_*)([^%_\\]+)(_*)%", pattern)
    if inner:
        before, part, after = inner.groups()
        length = F.length(id_col) - len(before) - len(after)
        return F.substr(id_col, F.lit(len(before) + 1), length).contains(part)
    if re.fullmatch(r"%[^%\\]+", pattern):
        size = len(pattern) - 1
        tests = [
            F.substring(id_col, m.start() - 1 - size, len(m.group())) == m.group()
            for m in re.finditer(r"[^_%]+", pattern)
        ]
        return reduce(lambda a, b: a & b, tests, F.length(id_col) >= size)
    return id_col.like(pattern)


def phase_is(phase_id: Column, phase: int) -> Column:
    return phase_id == F.lit(f"PHASE_{phase}")


def phase_started(phase_id: Column) -> Column:
    return phase_id != "NOT_STARTED"


def within(day: Column, start: Column, end: Column) -> Column:
    """Closed interval test; missing bounds reject."""
    return (day >= start) & (day <= end)


def in_own_window(
    kind: Column, day: Column, windows: Sequence[tuple[Sequence[str], Column, Column]]
) -> Column:
    """Each kind of row has its own window: a disjunction of (kinds, start, end) tests."""
    keep = F.lit(False)
    for kinds, start, end in windows:
        keep = keep | (kind.isin(*kinds) & within(day, start, end))
    return keep


def one_segment(
    df: DataFrame, label: str = "daily", column: str = "local_segment_label"
) -> DataFrame:
    """Rows of one time segment, without the label column."""
    return df.filter(F.col(column) == label).drop(column)


def enough_yield(df: DataFrame, column: str, threshold: str | float) -> DataFrame:
    """Rows whose data yield reaches the threshold; a missing yield does not."""
    return df.filter(F.col(column) >= parse_threshold(threshold))


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def count_missing_by_group(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """One row per group: rows and missing values."""
    return df.groupBy(*group).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(value).isNull()).alias("n_na")
    )


def with_group_missing(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Attach to every row the number of missing values in its group, ``n_na``.

    An aggregate joined back rather than a window: a window would put all rows of a hot
    group into one task, while the aggregate combines map-side and AQE can split the join.
    """
    totals = count_missing_by_group(df, group, value).drop("n_rows")
    keys = [F.col(f"d.{g}").eqNullSafe(F.col(f"t.{g}")) for g in group]
    joined = df.alias("d").join(totals.alias("t"), keys, "left")
    return joined.select("d.*", "t.n_na")


def complete_groups(
    df: DataFrame, group: Sequence[str], value: str, expected_rows: int | None = None
) -> DataFrame:
    """Rows of the groups that miss no value and, if given, have ``expected_rows`` rows."""
    counts = count_missing_by_group(df, group, value)
    whole = F.col("n_na") == 0
    if expected_rows is not None:
        whole = whole & (F.col("n_rows") == expected_rows)
    return df.join(counts.filter(whole).select(*group), list(group), "left_semi")
