"""Activity selection, endorsement, planning and completion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasewise.functions import recode
from phasewise.functions.columns import prefix_columns
from phasewise.functions.rowwise import ratio
from phasewise.operators import filters
from phasewise.operators.aggregates import (
    count_where,
    level_and_overall,
    stat_columns,
)
from phasewise.operators.joins import merge_unique
from phasewise.operators.reshape import pivot_values
from phasewise.operators.sets import union_of_distinct
from phasewise.plans.study import phase_windows

ID = "record_id"


def activity_names(activities: DataFrame, user_activities: DataFrame) -> DataFrame:
    """Catalogue of activity ids and names, general and user-made."""
    return union_of_distinct(
        [
            df.select("activityId", F.col("name").alias("activity_name"))
            for df in (activities, user_activities)
        ]
    )


def selected_activities(
    preferences: DataFrame,
    names: DataFrame,
    phases: DataFrame,
    phase: int,
    prefix: str | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Distinct activities a participant selected for a phase, with name and phase window.

    Preferences are made distinct before the lookups: they repeat, the catalogue does not.
    """
    chosen = (
        preferences.filter(
            filters.id_like(F.col("participantPhaseId"), f"%_PHASE_{phase}")
            & filters.in_scope(F.col("pId"), prefix, excluded)
        )
        .select("pId", "activityId")
        .distinct()
    )
    windows = phase_windows(phases, phase, prefix, excluded)
    named = chosen.join(names, "activityId", "left").join(windows, "pId", "left")
    return named.select(
        "pId", f"phase{phase}_start_date", f"phase{phase}_end_date", "activityId", "activity_name"
    )


def _answers(
    details: DataFrame,
    responses: DataFrame,
    phases: DataFrame,
    kind: str,
    phase: int,
    prefix: str | None,
    excluded: Sequence[str],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Answers of one kind of survey inside a phase, made distinct.

    The survey table is cut to its phase before it meets the far larger answer table.
    """
    scoped = responses.filter(
        filters.in_scope(F.col("pId"), prefix, excluded)
        & filters.id_like(F.col("surveyId"), f"%_{kind}_%")
    ).select("surveyId", "pId", "date")
    windows = phase_windows(phases, phase, prefix, excluded)
    start, end = F.col(f"phase{phase}_start_date"), F.col(f"phase{phase}_end_date")
    surveys = (
        scoped.join(windows, "pId")
        .filter(filters.within(F.col("date"), start, end))
        .select("surveyId", "pId", "date")
    )
    answers = details.filter(filters.id_like(F.col("surveyId"), f"%_{kind}_%"))
    return (
        answers.join(surveys, "surveyId")
        .select(
            F.col("surveyId").alias(f"survey_id_{kind.lower()}"), "pId", "date", "activityId", *extra
        )
        .distinct()
    )


def endorsed_activities(
    details: DataFrame,
    responses: DataFrame,
    phases: DataFrame,
    prefix: str | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Activities reported in daily surveys of phase 1, with rating (-1 means not rated)."""
    rating = recode.sentinel_to_null(F.col("score"), -1).alias("activity_rating")
    return _answers(
        details, responses, phases, "DAILY", 1, prefix, excluded,
        [F.lit(1).alias("endorsed"), rating],
    )


def planned_activities(
    details: DataFrame,
    responses: DataFrame,
    phases: DataFrame,
    prefix: str | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Activities planned in morning surveys of phase 2."""
    return _answers(
        details, responses, phases, "MORNING", 2, prefix, excluded, [F.lit(1).alias("planned")]
    )


def completed_activities(
    details: DataFrame,
    responses: DataFrame,
    phases: DataFrame,
    prefix: str | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Activities reported done in evening surveys of phase 2."""
    return _answers(
        details, responses, phases, "EVENING", 2, prefix, excluded, [F.lit(1).alias("completed")]
    )


def selection_flags(selected1: DataFrame, selected2: DataFrame) -> DataFrame:
    """One row per participant and activity with a 0/1 flag per phase."""

    def formatted(df: DataFrame, phase: int) -> DataFrame:
        return df.select(
            F.col("pId").alias(ID),
            F.col("activityId").alias("activity_id"),
            "activity_name",
            recode.ownership(F.col("pId"), F.col("activityId")).alias("activity_type"),
            F.lit(1).alias(f"selected_phase{phase}"),
        )

    keys = [ID, "activity_id", "activity_name", "activity_type"]
    merged = merge_unique([formatted(selected1, 1), formatted(selected2, 2)], keys)
    return merged.fillna(0, subset=["selected_phase1", "selected_phase2"])


def activity_selection_summary(selected1: DataFrame, selected2: DataFrame) -> DataFrame:
    """Selected activities per phase and their overlap, by type and over all types.

    A participant without activities of a type has NULL, not 0, for it.
    """
    flags = selection_flags(selected1, selected2)
    in1, in2 = F.col("selected_phase1") == 1, F.col("selected_phase2") == 1
    counts = {
        "phase1": in1,
        "phase2": in2,
        "phase1_and_phase2": in1 & in2,
        "phase1_not_phase2": in1 & ~in2,
        "phase2_not_phase1": ~in1 & in2,
    }
    aggs = [count_where(c).alias(n) for n, c in counts.items()]
    by_type = level_and_overall(flags, [ID], "activity_type", aggs, overall="All")
    return pivot_values(
        by_type,
        [ID],
        "activity_type",
        ["All", "Custom", "Default"],
        list(counts),
        template=lambda value, key: f"selected_{value}_{key.lower()}",
    )


def _where(level: str, value: Column) -> Column:
    return F.when(F.col(level), value)


def endorsement_summary(endorsed: DataFrame) -> DataFrame:
    """Endorsements and ratings per participant, and daily figures averaged over days.

    One pass: rows are grouped three ways at once (by activity, by survey, by day of the
    participant), and each participant's groups are then reduced to one row.  Counting
    groups counts distinct activities and surveys, a missing one included.  The first
    grouping never keys on the participant alone, which spreads a hot one.
    """
    rows = endorsed.withColumnsRenamed({"pId": ID, "activityId": "activity_id"})
    rating = F.col("activity_rating").cast("double")
    item, survey, day = "activity_id", "survey_id_daily", "date"
    grouped = rows.groupingSets(
        [[ID, item], [ID, survey], [ID, day], [ID]], ID, item, survey, day
    ).agg(
        (F.grouping_id() == 7).alias("by_person"),
        (F.grouping(item) == 0).alias("by_activity"),
        (F.grouping(survey) == 0).alias("by_survey"),
        (F.grouping(day) == 0).alias("by_day"),
        F.sum("endorsed").alias("total_endorsed"),
        F.count(rating).alias("total_rated"),
        *stat_columns("activity_rating", ("mean", "sd", "min", "max")),
    )
    grouped = grouped.withColumn(
        "endorsed_activity_rating_rate", ratio(F.col("total_rated"), F.col("total_endorsed"))
    )
    measures = [
        "total_endorsed", "total_rated", "activity_rating_mean", "activity_rating_min",
        "activity_rating_max", "endorsed_activity_rating_rate",
    ]
    person = grouped.groupBy(ID).agg(
        *[F.sum(_where("by_day", F.col(c))).alias(c) for c in ("total_endorsed", "total_rated")],
        # One row of its own per participant, whose moments Spark merges map-side.
        *[F.max(_where("by_person", F.col(f"activity_rating_{s}"))).alias(f"activity_rating_{s}")
          for s in ("mean", "sd", "min", "max")],
        F.count_if("by_activity").alias("unique_endorsed"),
        F.count_if(F.col("by_activity") & (F.col("total_rated") > 0)).alias("unique_rated"),
        F.count_if("by_survey").alias("daily_surveys"),
        *[
            a
            for c in measures
            for a in stat_columns(c, ("mean", "sd", "min", "max"), only=F.col("by_day"))
        ],
    )
    return prefix_columns(person, "phase1_", keep=[ID])


def _planned_completed_cells(planned: DataFrame, completed: DataFrame) -> DataFrame:
    """One row per participant, day and activity with ``n_rows``, the rows it stands for.

    Matching planned with completed rows multiplies repeats (two surveys on one day); a count
    of each side gives that product without producing the rows, and one aggregate over the
    union replaces three full joins.  Rows are dealt by participant-day once, which serves the
    cells and the window over a day's cells (at most the catalogue of activities).
    """
    both = planned.select("pId", "date", "activityId", "planned").unionByName(
        completed.select("pId", "date", "activityId", "completed"), allowMissingColumns=True
    )
    cells = both.repartition("pId", "date").groupBy("pId", "date", "activityId").agg(
        F.count("planned").alias("n_planned"), F.count("completed").alias("n_completed")
    )
    day = Window.partitionBy("pId", "date")
    cells = cells.withColumns(
        {
            "has_morning": F.max((F.col("n_planned") > 0).cast("int")).over(day),
            "has_evening": F.max((F.col("n_completed") > 0).cast("int")).over(day),
        }
    )
    planned_flag = F.when(F.col("n_planned") > 0, 1)
    completed_flag = F.when(F.col("n_completed") > 0, 1)
    return cells.select(
        F.col("pId").alias(ID),
        "date",
        "has_morning",
        "has_evening",
        F.col("activityId").alias("activity_id"),
        recode.zero_where(planned_flag, F.col("has_morning") == 1).alias("planned"),
        recode.zero_where(completed_flag, F.col("has_evening") == 1).alias("completed"),
        (F.greatest("n_planned", F.lit(1)) * F.greatest("n_completed", F.lit(1))).alias("n_rows"),
    )


def planned_completed_days(
    planned: DataFrame, completed: DataFrame, dedupe: bool = False
) -> DataFrame:
    """Planned against completed activities per participant and day.

    Missing counts as 0 only on days that have the survey concerned.  Repeats multiply as in
    a many-to-many join unless ``dedupe`` is set.
    """
    cells = _planned_completed_cells(planned, completed)
    if dedupe:
        return cells.drop("n_rows")
    repeats = F.explode(F.sequence(F.lit(1), F.col("n_rows")))
    return cells.withColumn("__i", repeats).drop("__i", "n_rows")


def completion_summary(planned: DataFrame, completed: DataFrame) -> DataFrame:
    """Planning and completion per participant: surveys, totals, unique activities, daily rate."""
    cells = _planned_completed_cells(planned, completed)
    p, c, n = F.col("planned"), F.col("completed"), F.col("n_rows")
    kinds = {
        "planned": p == 1,
        "completed": c == 1,
        "planned_and_completed": (p == 1) & (c == 1),
        "planned_not_completed": (p == 1) & (c == 0),
        "completed_not_planned": (p == 0) & (c == 1),
    }
    totals = {**kinds, "not_planned_not_completed": (p == 0) & (c == 0)}

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    # By day and by activity at once; counting an activity's groups counts it once.
    item, day = "activity_id", "date"
    grouped = cells.groupingSets([[ID, day], [ID, item]], ID, day, item).agg(
        (F.grouping(day) == 0).alias("by_day"),
        (F.grouping(item) == 0).alias("by_activity"),
        F.max("has_morning").alias("has_morning"),
        F.max("has_evening").alias("has_evening"),
        *[total(cond).alias(f"total_{name}") for name, cond in totals.items()],
    )
    morning = F.col("by_day") & (F.col("has_morning") == 1)
    evening = F.col("by_day") & (F.col("has_evening") == 1)
    rate = ratio(F.col("total_planned_and_completed"), F.col("total_planned"))
    grouped = grouped.withColumn(
        "planned_activity_completion_rate", F.when(morning & evening, rate)
    )

    def met(name: str) -> Column:
        return F.col("by_activity") & F.col(item).isNotNull() & (F.col(f"total_{name}") > 0)

    # The lists are cells of the result, bounded by the catalogue of activities.
    person = grouped.groupBy(ID).agg(
        count_where(morning).alias("morning_surveys"),
        count_where(evening).alias("evening_surveys"),
        count_where(morning & evening).alias("morning_and_evening_surveys"),
        *[F.sum(_where("by_day", F.col(f"total_{k}"))).alias(f"total_{k}") for k in totals],
        *stat_columns("planned_activity_completion_rate"),
        *[count_where(met(k)).alias(f"unique_{k}") for k in kinds],
        *[
            F.array_join(F.array_sort(F.collect_list(F.when(met(k), F.col(item)))), ", ").alias(
                f"unique_{k}_list"
            )
            for k in kinds
        ],
    )
    return prefix_columns(person, "phase2_", keep=[ID])


def activity_engagement(
    selection: DataFrame, endorsement: DataFrame, completion: DataFrame
) -> DataFrame:
    """One row per participant with everything known about their activities.

    The three parts have disjoint columns and one row per participant each.
    """
    return merge_unique([selection, endorsement, completion], [ID])
