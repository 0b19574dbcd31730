"""Filters, joins, reshaping, aggregation and ranks on hand-made rows."""

import datetime as dt

import pytest
from comparing import rows
from pyspark.sql import functions as F

from phasewise.operators import aggregates, filters, joins, ranks, reshape, sets

D = dt.date


def test_like_treats_underscore_as_any_character(spark):
    df = spark.createDataFrame([("A1_DAILY_3",), ("DAILY_3",), ("AxDAILYx3",)], "id string")
    kept = df.filter(filters.id_like(F.col("id"), "%_DAILY_%"))
    assert rows(kept) == [("A1_DAILY_3",), ("AxDAILYx3",)]


def test_scope(spark):
    df = spark.createDataFrame([("11",), ("12",), ("21",)], "id string")
    assert rows(df.filter(filters.in_scope(F.col("id"), "1", ["12"]))) == [("11",)]


def test_complete_groups_need_rows_and_values(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 1.0), (2, None), (3, 1.0)], "id int, y double")
    assert rows(filters.complete_groups(df, ["id"], "y")) == [(1, 1.0), (1, 2.0), (3, 1.0)]
    assert rows(filters.complete_groups(df, ["id"], "y", 2)) == [(1, 1.0), (1, 2.0)]


def test_group_missing_keeps_rows_of_a_missing_group(spark):
    df = spark.createDataFrame([(None, None), (None, 1.0), (1, 1.0)], "id int, y double")
    got = rows(filters.with_group_missing(df, ["id"], "y"))
    assert [r[2] for r in got] == [1, 1, 0]


def test_days_of_empty_reversed_and_single_ranges(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), D(2024, 1, 3)), ("b", D(2024, 1, 2), D(2024, 1, 1)),
         ("c", D(2024, 1, 5), D(2024, 1, 5)), ("d", None, D(2024, 1, 5))],
        "id string, s date, e date",
    )
    got = rows(reshape.explode_days(df, "s", "e").select("id", "date"))
    assert got == [("a", D(2024, 1, 1)), ("a", D(2024, 1, 2)), ("a", D(2024, 1, 3)),
                   ("c", D(2024, 1, 5))]


def test_pivot_names_and_order(spark):
    df = spark.createDataFrame(
        [("a", "x", 2, 20.0), ("a", "x", 1, 10.0), ("a", "y", 1, None)],
        "id string, k string, at int, v double",
    )
    wide = reshape.pivot_values(df, ["id"], "k", ["x", "y", "z"], ["v"], order="at")
    assert wide.columns == ["id", "v_x", "v_y", "v_z"]
    assert rows(wide) == [("a", 10.0, None, None)]


def test_pivot_undoes_unpivot(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 3.0)], "id string, x double, y double")
    long = reshape.unpivot_long(df, ["id"])
    assert rows(reshape.pivot_one(long, ["id"], "variable", ["x", "y"], "value")) == rows(df)


def test_unique_assertion(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert rows(reshape.duplicated_keys(df, ["id"])) == [(1, 2)]
    with pytest.raises(Exception, match="duplicate key"):
        reshape.assert_unique(df, ["id"]).collect()
    assert reshape.assert_unique(df.distinct(), ["id"]).count() == 2


def test_missing_keys_match_when_asked(spark):
    left = spark.createDataFrame([(1, "l"), (None, "l0")], "k int, a string")
    right = spark.createDataFrame([(None, "r0"), (2, "r")], "k int, b string")
    got = rows(joins.full_join(left, right, ["k"], null_safe=True), "k")
    assert got == [(None, "l0", "r0"), (1, "l", None), (2, None, "r")]
    assert len(rows(joins.full_join(left, right, ["k"]), "k", "a")) == 4


def test_merge_unique_equals_full_joins(spark):
    a = spark.createDataFrame([(1, 1), (None, 2)], "k int, a int")
    b = spark.createDataFrame([(None, 5), (3, 6)], "k int, b int")
    assert rows(joins.merge_unique([a, b], ["k"])) == rows(
        joins.fold_full_join([a, b], ["k"], null_safe=True)
    )


def test_interval_join_ends_are_closed(spark):
    events = spark.createDataFrame(
        [("a", D(2024, 1, d)) for d in (1, 2, 3, 4)] + [("b", D(2024, 1, 2)), (None, D(2024, 1, 2))],
        "id string, day date",
    )
    windows = spark.createDataFrame([("a", D(2024, 1, 2), D(2024, 1, 3))], "id string, s date, e date")
    got = joins.interval_join(events, windows, "id", "day", "s", "e")
    assert rows(got.select("day")) == [(D(2024, 1, 2),), (D(2024, 1, 3),)]


def test_presence_marks_both_ways(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, v string")
    side = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    got = rows(joins.mark_presence(df, [(side, "has")], ["k"]))
    assert got == [(None, "z", 1), (1, "x", 1), (1, "y", 1), (2, None, 1)]


def test_bundle_of_one_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "g string, x double")
    got = rows(aggregates.stat_bundle(df, ["g"], ["x"]))
    assert got == [("a", 1, 1.0, None, 1.0, 1.0), ("b", 0, None, None, None, None)]


def test_overall_is_apart_from_a_missing_level(spark):
    df = spark.createDataFrame([(1, "p"), (1, None)], "id int, phase string")
    got = rows(aggregates.level_and_overall(df, ["id"], "phase", [F.count("*").alias("n")]))
    assert got == [(1, None, 1), (1, "overall", 2), (1, "p", 1)]


def test_distinct_counts(spark):
    df = spark.createDataFrame(
        [("g", "b", 1), ("g", "a", 1), ("g", "a", 0), ("g", None, 1), ("h", None, 0)],
        "g string, item string, f int",
    )
    conditions = {"every": None, "hit": F.col("f") == 1}
    got = rows(aggregates.distinct_counts(df, ["g"], "item", conditions, lists=True))
    assert got == [("g", 2, 2, "a, b", "a, b"), ("h", 0, 0, "", "")]
    counted = aggregates.distinct_counts(df, ["g"], "item", conditions, count_missing=True)
    assert rows(counted) == [("g", 3, 3), ("h", 1, 0)]


def test_strict_sum(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 1.0), (2, None)], "g int, x double")
    got = df.groupBy("g").agg(aggregates.strict_sum(F.col("x")).alias("s"))
    assert rows(got) == [(1, 3.0), (2, None)]


def test_category_shares_leave_missing_out(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "v string")
    got = {r.v: (r.n, r.p) for r in aggregates.category_counts(df, "v").collect()}
    assert got == {"x": (2, pytest.approx(2 / 3)), "y": (1, pytest.approx(1 / 3))}


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_mid_ranks_by_brute_force(spark, buckets):
    values = [(v, (i * 37 % 23) * 0.5) for v in ("a", "b") for i in range(150)]
    values += [("b", 3.0)] * 400  # one value holds most rows
    df = spark.createDataFrame(values, "variable string, value double")
    counts = ranks.value_counts(df, "variable", "value")
    got = {(r.variable, r.value): r["rank"] for r in ranks.mid_ranks(counts, buckets=buckets).collect()}
    for v in ("a", "b"):
        ordered = sorted(x for k, x in values if k == v)
        for x in set(ordered):
            first = ordered.index(x) + 1
            assert got[v, x] == first + (ordered.count(x) - 1) / 2


def test_union_of_distinct_keeps_rows_of_both(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    assert rows(sets.union_of_distinct([a, a])) == [(1,), (1,)]


def test_cohorts_with_unequal_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    out = sets.stack_cohorts({"p": a, "q": b})
    assert out.columns == ["cohort", "x", "y"]
    assert rows(out) == [("p", 1, 2), ("q", 3, None)]


def test_ranks_start_no_job_while_the_plan_is_built(spark):
    """Nor does a null, an empty table or a single value disturb them."""
    schema = "variable string, value double, n long"
    counts = spark.createDataFrame([("a", 1.0, 2), ("a", 5.0, 1), (None, 3.0, 4)], schema)
    spark.sparkContext.setJobGroup("ranks", "")
    ranked = ranks.mid_ranks(counts, with_before=True)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ranks")
    spark.sparkContext.setJobGroup("tests", "")
    got = {(r.variable, r.value): (r["rank"], r.before) for r in ranked.collect()}
    assert got == {("a", 1.0): (1.5, 0), ("a", 5.0): (3.0, 2), (None, 3.0): (2.5, 0)}
    assert ranks.mid_ranks(counts.where("false")).collect() == []


def test_second_rows_of_a_key_fail_the_job(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 3)], "id string, k string, v int")
    with pytest.raises(Exception, match="more than one row for a key"):
        reshape.pivot_values(df, ["id"], "k", ["x", "y"], ["v"]).collect()
    assert rows(reshape.pivot_values(df, ["id"], "k", ["x", "y"], ["v"], order="v")) == [("a", 1, None), ("b", None, 3)]
    with pytest.raises(Exception, match="more than one row for a key"):
        joins.merge_unique([df.select("id", "v"), df.select("id", "k")], ["id"]).collect()


@pytest.mark.parametrize("column", ["s", "d", "x"])
def test_ordinals_by_brute_force(spark, column):
    days = [None if i % 11 == 0 else dt.date(2024, 1, 1 + i % 9) for i in range(200)]
    data = [(i, None if i % 13 == 0 else f"{'éab'[i % 3]}{i % 29}", days[i], None if i % 7 == 0 else (i * 37 % 23) - 9.5) for i in range(200)]
    df = spark.createDataFrame(data, "i int, s string, d date, x double").repartition(5)
    got = {r.i: r.place for r in ranks.ordinals(df, [column, "i"], "place").collect()}
    at = "isdx".index(column)
    key = lambda r: (r[at] is not None, r[at].encode() if isinstance(r[at], str) else r[at], r[0])
    assert got == {r[0]: n for n, r in enumerate(sorted(data, key=key), 1)}
    assert ranks.ordinals(df.where("false"), [column], "place").collect() == []
