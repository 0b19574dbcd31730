"""Choosing, renaming and reordering columns by name.

Only the schema is read, so nothing here starts a Spark job, and each function adds
at most one projection however many columns it touches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_cols(
    df: DataFrame,
    *,
    starts: str | None = None,
    ends: str | None = None,
    contains: str | None = None,
    matches: str | None = None,
    excluding: str | None = None,
    numeric: bool = False,
) -> list[str]:
    """Names of the columns that pass every given test, in schema order.

    ``matches`` is a regular expression searched anywhere in the name; ``excluding`` is a
    literal that must not occur in it.
    """
    pattern = re.compile(matches) if matches else None
    chosen = []
    for field in df.schema.fields:
        name = field.name
        if starts is not None and not name.startswith(starts):
            continue
        if ends is not None and not name.endswith(ends):
            continue
        if contains is not None and contains not in name:
            continue
        if pattern is not None and not pattern.search(name):
            continue
        if excluding is not None and excluding in name:
            continue
        if numeric and not isinstance(field.dataType, T.NumericType):
            continue
        chosen.append(name)
    return chosen


def only_column(df: DataFrame, pattern: str) -> str:
    """The single column whose name matches ``pattern``; anything else is an error."""
    found = select_cols(df, matches=pattern)
    if len(found) != 1:
        raise ValueError(f"expected one column matching {pattern!r}, found {found}")
    return found[0]


def keep_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Project onto ``names``, leaving out those the frame does not have."""
    present = set(df.columns)
    return df.select(*[n for n in names if n in present])


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.drop(*select_cols(df, matches=pattern))


def rename_columns(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by ``rule``; two columns may not end up with one name."""
    names = [rule(n) for n in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"renaming makes duplicate columns: {clashes}")
    return df.toDF(*names)


def rename_by_patterns(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Apply regex replacements to all names, each rule seeing the result of the last."""

    def rule(name: str) -> str:
        for pattern, replacement in rules:
            name = re.sub(pattern, replacement, name)
        return name

    return rename_columns(df, rule)


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    kept = set(keep)
    return rename_columns(df, lambda n: n if n in kept else prefix + n)


def move_columns(df: DataFrame, names: Sequence[str], after: str | None = None) -> DataFrame:
    """Put ``names`` first, or right behind the column ``after``."""
    rest = [c for c in df.columns if c not in set(names)]
    at = 0 if after is None else rest.index(after) + 1
    return df.select(*rest[:at], *names, *rest[at:])


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Add the same value to every row, one column per keyword."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def map_columns(df: DataFrame, names: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Rewrite the named columns in place with one projection."""
    return df.withColumns({n: fn(F.col(n)) for n in names})


def bind(values: Mapping[str, Column], body: Callable[[dict[str, Column]], Column]) -> Column:
    """Compute some values once and hand them to ``body`` by name.

    Keeps nested formulas small: a Column is an expression tree, so using one twice copies it.
    """
    bound = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.get(F.transform(bound, lambda s: body({k: s[k] for k in values})), F.lit(0))


def require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
