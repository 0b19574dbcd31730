"""Joins on participant keys.

No side is ever hinted as broadcast unless it is a literal table: Spark broadcasts by
measured size (``spark.sql.autoBroadcastJoinThreshold``), otherwise it sorts and merges, and
AQE splits the partitions of hot keys.  It cannot do that in a full join, so none is planned:
frames of one row per key are stacked and grouped, others get the keys they lack and meet in
inner joins, in which either side may be split.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _match(keys: Sequence[str], null_safe: bool) -> Column:
    tests = [
        F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) if null_safe else F.col(f"l.{k}") == F.col(f"r.{k}")
        for k in keys
    ]
    return reduce(lambda a, b: a & b, tests)


def join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False
) -> DataFrame:
    """Equi-join with one set of key columns, taken from whichever side has the row.

    With ``null_safe`` a missing key matches a missing key, as data-frame tools do.
    """
    if how in ("full", "outer", "fullouter", "full_outer"):
        return fold_full_join([left, right], keys, null_safe)
    if not null_safe:
        return left.join(right, list(keys), how)
    joined = left.alias("l").join(right.alias("r"), _match(keys, True), how)
    kept = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys]
    rest_l = [F.col(f"l.`{c}`") for c in left.columns if c not in keys]
    rest_r = [F.col(f"r.`{c}`") for c in right.columns if c not in keys]
    return joined.select(*kept, *rest_l, *rest_r)


def full_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    return fold_full_join([left, right], keys, null_safe)


def left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    return join_on(left, right, keys, "left", null_safe)


def _keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def _padded(df: DataFrame, spine: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """``df`` with a row, empty but for its keys, for every key of the spine that it lacks."""
    lacking = spine.alias("l").join(
        _keys_of(df, keys).alias("r"), _match(keys, null_safe), "left_anti"
    )
    return df.unionByName(lacking, allowMissingColumns=True)


def fold_full_join(
    frames: Sequence[DataFrame], keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Full-join any number of frames on the same keys; rows of one key meet all with all.

    Every frame gets an empty row for each key that only others have; then all keys are in all
    frames and inner joins keep every row.  What is added and looked up are distinct keys,
    reduced map-side, so a key with a third of all rows is only ever met by the join that AQE
    splits.  Where each frame has one row per key, :func:`merge_unique` does with one shuffle.
    Rows with a missing key match nothing unless ``null_safe``.
    """
    if len(frames) == 1:
        return frames[0]
    if null_safe:
        whole, loose = list(frames), []
    else:
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        whole, loose = [f.filter(known) for f in frames], [f.filter(~known) for f in frames]
    spine = reduce(lambda a, b: a.unionByName(b), [_keys_of(f, keys) for f in whole]).distinct()
    padded = [_padded(f, spine, keys, null_safe) for f in whole]
    joined = reduce(lambda a, b: join_on(a, b, keys, "inner", null_safe), padded)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [joined, *loose])


def merge_unique(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full join of frames that each hold at most one row per key, as union plus aggregate.

    One shuffle with map-side combining instead of a sort-merge per frame; missing keys
    match; a key heavy in one frame cannot pile up in one task.  Value columns must be
    disjoint across the frames.  The same aggregate counts the rows of each frame: a second
    one for a key fails the job instead of leaving the choice to chance.
    """
    marked = [f.withColumn("__frame", F.lit(i)) for i, f in enumerate(frames)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    values = [c for c in stacked.columns if c not in keys and c != "__frame"]
    rows = [F.count_if(F.col("__frame") == i) for i in range(len(frames))]
    most = F.greatest(*rows) if len(rows) > 1 else rows[0]
    merged = stacked.groupBy(*keys).agg(
        most.alias("__rows"), *[F.first(F.col(f"`{c}`"), ignorenulls=True).alias(c) for c in values]
    )
    return merged.select(*keys, *[only_one(F.col("__rows"), F.col(f"`{c}`")).alias(c) for c in values])


def only_one(rows: Column, value: Column) -> Column:
    """The value if its group has one row, else an error that ends the job."""
    return F.when(rows <= 1, value).otherwise(
        F.raise_error(F.lit("more than one row for a key that has to be unique"))
    )


def interval_join(
    events: DataFrame,
    windows: DataFrame,
    on: str | Sequence[str],
    day: str,
    start: str,
    end: str,
    how: str = "inner",
) -> DataFrame:
    """Events inside their owner's closed window: equal ids, ``start <= day <= end``.

    The interval is part of the join condition of an equi-join on id, so the window side
    (a row or two per participant) is hashed or merged and nothing is multiplied.
    """
    keys = [on] if isinstance(on, str) else list(on)
    inside = (F.col(f"l.{day}") >= F.col(f"r.{start}")) & (F.col(f"l.{day}") <= F.col(f"r.{end}"))
    joined = events.alias("l").join(windows.alias("r"), _match(keys, False) & inside, how)
    extra = [F.col(f"r.`{c}`") for c in windows.columns if c not in keys]
    return joined.select("l.*", *extra)


def presence(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """The distinct keys of a frame, marked with 1."""
    return df.select(*keys).distinct().withColumn(flag, F.lit(1))


def mark_presence(
    df: DataFrame, sides: Sequence[tuple[DataFrame, str]], keys: Sequence[str]
) -> DataFrame:
    """Full-join presence flags of several frames by key; absent means 0.

    Written as a left join plus the marks without a partner: AQE can split the rows of a hot
    key in both of these, which it cannot in a full join.
    """
    flags = [name for _, name in sides]
    marks = merge_unique([presence(side, keys, name) for side, name in sides], keys)
    seen = df.select(*keys).distinct()
    alone = marks.alias("l").join(seen.alias("r"), _match(keys, True), "left_anti")
    marked = left_join(df, marks, keys, null_safe=True)
    return marked.unionByName(alone, allowMissingColumns=True).fillna(0, subset=flags)
