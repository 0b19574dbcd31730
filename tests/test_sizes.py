"""Work and task sizes of the study queries on large tables."""

import pytest
from comparing import rows
from pyspark.sql import functions as F

from phasewise import session
from phasewise.operators import filters
from phasewise.plans import activities, sensors

IDS = ["S_DAILY_1", "S_MORNING_1", "MORNING", "S_MORNING", "_MORNING_", "aMORNINGb", "\U0001f600MORNING\U0001f600",
       "", None, "7_PHASE_1", "PHASE_1", "xPHASE?1", "7_PHASE_12", "_PHASE_2", "%", "7_PHASE_1\n", "MORNINGMORNINGx"]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    "pattern", ["%_MORNING_%", "%__MORNING%", "%MORNING_%", "%_PHASE_1", "%1", "%_", "%_%", "%", "S%", r"%\_P"]
)
def test_ids_are_like_their_pattern(spark, pattern):
    ids = spark.createDataFrame([(i,) for i in IDS], "id string")
    got = ids.select("id", filters.id_like(F.col("id"), pattern), F.col("id").like(pattern))
    assert [(r[0], r[1]) for r in got.collect()] == [(r[0], r[2]) for r in got.collect()]


def test_id_patterns_need_no_regular_expression(spark):
    ids = spark.createDataFrame([(i,) for i in IDS], "id string")
    for pattern in ("%_MORNING_%", "%_PHASE_1"):
        assert "LIKE" not in plan_of(ids.filter(filters.id_like(F.col("id"), pattern))).upper()


def test_days_of_planned_activities_are_marked_without_a_join(spark):
    cells = [("a", "d1", "x", 1), ("a", "d1", "y", 1), ("a", None, "x", 1), (None, None, "z", 1)]
    planned = spark.createDataFrame(cells, "pId string, date string, activityId string, planned int")
    completed = spark.createDataFrame(
        [("a", "d1", "x", 1), ("a", "d1", "x", 1), ("a", "d2", None, 1), (None, None, "w", 1)],
        "pId string, date string, activityId string, completed int",
    )
    days = activities.planned_completed_days(planned, completed)
    assert "Join" not in plan_of(days)
    assert rows(days) == [
        (None, None, 1, 1, "w", 0, 1), (None, None, 1, 1, "z", 1, 0),
        ("a", None, 1, 0, "x", 1, None),
        ("a", "d1", 1, 1, "x", 1, 1), ("a", "d1", 1, 1, "x", 1, 1), ("a", "d1", 1, 1, "y", 1, 0),
        ("a", "d2", 0, 1, None, None, 1),
    ]


def test_partitions_grow_in_number_with_the_input(spark, tmp_path):
    sizes = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    (tmp_path / "lineitem.parquet").mkdir()
    (tmp_path / "lineitem.parquet" / "part-0.parquet").write_bytes(bytes(40 << 20))
    try:
        session.deal(spark, str(tmp_path))
        assert int(spark.conf.get(number)) == max(20, int(spark.conf.get("spark.sql.shuffle.partitions")))
        assert session._as_bytes(spark.conf.get(sizes)) == session.TASK_BYTES
        spark.conf.set(sizes, "8m")
        session.deal(spark, str(tmp_path / "none"))
        assert spark.conf.get(sizes) == "8m"
        assert spark.conf.get(number) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.unset(sizes)
        spark.conf.unset(number)


def test_segments_are_found_by_generated_code(spark):
    minutes = spark.range(1).selectExpr("'p' AS pid", "DATE'2024-01-02' AS date", "30 AS minute")
    segments = sensors.assign_segments(minutes, [("night", 1320, 480), ("day", 480, 840)])
    assert "lambda" not in plan_of(segments)
    assert [(str(r.date), r.minute, r.local_segment_label) for r in segments.collect()] == [
        ("2024-01-01", 1470, "night")
    ]
