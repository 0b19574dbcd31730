"""One participant with most of the rows: joins are split, results stay whole."""

import datetime as dt

import pytest
from comparing import rows
from pyspark.sql import functions as F

from phasewise.operators import filters, joins
from phasewise.plans import study

SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}
ROWS = 60_000


@pytest.fixture()
def splitting(spark):
    for key, value in SPLITTING.items():
        spark.conf.set(key, value)
    yield spark
    for key in SPLITTING:
        spark.conf.unset(key)


@pytest.fixture()
def events(splitting):
    """Half of all rows belong to participant 0; days run through January."""
    n = F.col("id")
    return splitting.range(0, ROWS, 1, 8).select(
        F.when(n % 2 == 0, 0).otherwise(n % 199).cast("string").alias("pId"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 31).cast("int")).alias("day"),
        F.sha2(n.cast("string"), 256).alias("payload"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_interval_join_splits_the_hot_participant(splitting, events):
    windows = splitting.range(199).select(
        F.col("id").cast("string").alias("pId"),
        F.lit("2024-01-10").cast("date").alias("s"), F.lit("2024-01-19").cast("date").alias("e"),
    )
    joined = joins.interval_join(events, windows, "pId", "day", "s", "e")
    assert "skew=true" in final_plan(joined)
    inside = sum(1 for i in range(ROWS) if 9 <= i % 31 <= 18)
    assert joined.count() == inside


def test_group_counts_split_the_hot_participant(events):
    rare = events.withColumn("x", F.when(F.col("payload") > "00", 1))
    marked = filters.with_group_missing(rare, ["pId"], "x")
    assert "skew=true" in final_plan(marked)
    assert marked.count() == ROWS


def test_marks_split_the_hot_participant(splitting, events):
    side = splitting.createDataFrame([("0",), ("none",)], "pId string")
    marked = joins.mark_presence(events, [(side, "has")], ["pId"])
    assert "skew=true" in final_plan(marked)
    assert marked.count() == ROWS + 1
    assert marked.filter("has = 1").count() == events.filter("pId = '0'").count() + 1


def test_compliance_of_a_hot_participant(splitting):
    """Participant 0 answers thousands of times a day; everyone else once."""
    n = F.col("id")
    phases = splitting.range(30).select(
        n.cast("string").alias("pId"),
        F.inline(F.array(*[
            F.struct(F.lit(f"PHASE_{p}").alias("phaseId"),
                     F.lit(s).cast("date").alias("startDate"), F.lit(e).cast("date").alias("endDate"))
            for p, s, e in ((1, "2024-01-01", "2024-01-11"), (2, "2024-01-11", "2024-01-21"))
        ])),
    )
    responses = splitting.range(20_000).select(
        F.when(n < 300, (n % 30)).otherwise(0).cast("string").alias("pId"),
        F.concat(F.lit("s"), "id").alias("surveyId"),
        F.lit("DAILY").alias("sId"),
        F.date_add(F.lit("2024-01-01").cast("date"), ((n / 30).cast("int") % 5)).alias("date"),
        F.lit(dt.datetime(2024, 1, 1, 8)).cast("timestamp_ntz").alias("startTime"),
        F.lit(1.0).alias("timeTaken"), F.lit(2.0).alias("goodnessScore"), F.lit("").alias("note"),
    )
    got = rows(
        study.survey_compliance_report(responses, phases).select(
            "record_id", "total_number_surveys_completed_overall",
            "total_number_surveys_expected_overall",
        )
    )
    assert got == sorted((str(i), 5, 30) for i in range(30))


def test_full_joins_split_the_hot_participant(splitting, events):
    """On whichever side its rows are; nobody's rows are lost, nor those without a key."""
    other = splitting.createDataFrame([("0", 1), ("none", 2), (None, 3)], "pId string, x int")
    loose = events.limit(1).withColumn("pId", F.lit(None).cast("string"))
    rows_ = events.unionByName(loose)
    for joined in (joins.full_join(rows_, other, ["pId"]), joins.full_join(other, rows_, ["pId"])):
        plan = final_plan(joined)
        assert "skew=true" in plan and "FullOuter" not in plan
        assert joined.count() == ROWS + 3
        assert joined.filter("x = 1 AND payload IS NOT NULL").count() == events.filter("pId = '0'").count()
    assert joins.full_join(rows_, other, ["pId"], null_safe=True).count() == ROWS + 2


def test_no_full_join_in_the_engagement_of_participants(spark):
    from phasewise.plans import activities

    parts = [spark.createDataFrame([(i, 1.0)], f"record_id string, {c} double") for i, c in (("a", "x"), ("b", "y"), ("a", "z"))]
    merged = activities.activity_engagement(*parts)
    assert "FullOuter" not in final_plan(merged)
    assert rows(merged) == [("a", 1.0, None, 1.0), ("b", None, 1.0, None)]
