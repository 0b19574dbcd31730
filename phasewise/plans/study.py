"""Phase calendars, surveys inside phases, survey compliance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewise.functions import dates, recode
from phasewise.functions.columns import drop_matching, select_cols
from phasewise.functions.rowwise import ratio, row_sum
from phasewise.operators import filters
from phasewise.operators.aggregates import stat_columns, sum_columns
from phasewise.operators.joins import left_join
from phasewise.operators.reshape import explode_days, pivot_values

KINDS = ("daily", "morning", "evening")


def phase_windows(
    phases: DataFrame, phase: int, prefix: str | None = None, excluded: Sequence[str] = ()
) -> DataFrame:
    """Closed window of one phase per participant: pId, phase<k>_start_date, phase<k>_end_date."""
    chosen = phases.filter(
        filters.phase_is(F.col("phaseId"), phase)
        & filters.in_scope(F.col("pId"), prefix, excluded)
    )
    return chosen.select(
        "pId",
        F.col("startDate").alias(f"phase{phase}_start_date"),
        dates.closed_end(F.col("endDate")).alias(f"phase{phase}_end_date"),
    )


def both_windows(
    phases: DataFrame, prefix: str | None = None, excluded: Sequence[str] = ()
) -> DataFrame:
    """Both phase windows in one row, for participants that have both.

    One aggregate over the phase table replaces a join per phase.  Where a participant has
    several rows of a phase the one that starts first counts, of those the one that ends
    first, as a whole; rows without a start come last.
    """
    scoped = phases.filter(
        F.col("phaseId").isin("PHASE_1", "PHASE_2")
        & filters.in_scope(F.col("pId"), prefix, excluded)
    )
    start, end = F.col("startDate"), dates.closed_end(F.col("endDate"))
    row = F.struct(start.isNull(), start.alias("start"), end.isNull(), end.alias("end"))
    wide = scoped.groupBy("pId").agg(
        *[F.min(F.when(F.col("phaseId") == f"PHASE_{k}", row)).alias(f"phase{k}") for k in (1, 2)]
    )
    return wide.filter("phase1 IS NOT NULL AND phase2 IS NOT NULL").select(
        "pId", *[F.col(f"phase{k}.{e}").alias(f"phase{k}_{e}_date") for k in (1, 2) for e in ("start", "end")]
    )


def study_calendar(
    phases: DataFrame, prefix: str | None = None, excluded: Sequence[str] = ()
) -> DataFrame:
    """One row per participant, phase and day."""
    started = phases.filter(
        filters.in_scope(F.col("pId"), prefix, excluded) & filters.phase_started(F.col("phaseId"))
    ).select(
        F.col("pId").alias("record_id"),
        F.replace("phaseId", F.lit("PHASE_"), F.lit("")).try_cast("int").alias("phase"),
        F.col("startDate").alias("phase_start_date"),
        dates.closed_end(F.col("endDate")).alias("phase_end_date"),
    )
    return explode_days(started, "phase_start_date", "phase_end_date")


def clean_responses(
    responses: DataFrame, prefix: str | None = None, excluded: Sequence[str] = ()
) -> DataFrame:
    """Survey responses with study phase, voided morning scores and note flag."""
    kind = F.col("sId")
    return responses.filter(filters.in_scope(F.col("pId"), prefix, excluded)).select(
        F.col("pId").alias("record_id"),
        F.col("surveyId").alias("survey_id"),
        recode.survey_phase(kind).alias("study_phase"),
        kind.alias("survey_type"),
        "date",
        F.col("startTime").alias("survey_start_datetime"),
        F.col("timeTaken").alias("survey_duration"),
        recode.void_where(F.col("goodnessScore"), kind == "MORNING").alias("goodness_score"),
        recode.note_flag(F.col("note")).alias("added_note"),
    )


def survey_extract(
    responses: DataFrame,
    phases: DataFrame,
    prefix: str | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Surveys inside the phase they belong to, of participants that have both phases.

    Daily surveys count in phase 1, morning and evening ones in phase 2.  Only responses
    cross the join with one window row per participant.
    """
    surveys = clean_responses(responses, prefix, excluded)
    windows = both_windows(phases, prefix, excluded).withColumnRenamed("pId", "record_id")
    joined = surveys.join(windows, "record_id")
    own = filters.in_own_window(
        F.col("survey_type"),
        F.col("date"),
        [
            (("DAILY",), F.col("phase1_start_date"), F.col("phase1_end_date")),
            (("MORNING", "EVENING"), F.col("phase2_start_date"), F.col("phase2_end_date")),
        ],
    )
    return joined.filter(own).select(*surveys.columns)


def device_assignments(
    devices: DataFrame,
    participants: DataFrame,
    prefix: str | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Wearable devices with their participant tag and recording window."""
    owners = participants.filter(filters.in_scope(F.col("label"), prefix, excluded)).select(
        F.col("id").alias("participant_id"), "label", "start_date", "end_date"
    )
    joined = devices.select(F.col("id").alias("device_id"), "participant_id").join(
        owners, "participant_id"
    )
    return joined.select(
        "device_id",
        F.col("device_id").alias("fitbit_id"),
        F.lit("").alias("empatica_id"),
        dates.participant_tag(F.col("label")).alias("pid"),
        F.lit("").alias("platform"),
        "label",
        dates.day_open(F.col("start_date")).alias("start_date"),
        dates.day_close(dates.closed_end(F.col("end_date"))).alias("end_date"),
    )


def survey_days(surveys: DataFrame) -> DataFrame:
    """Surveys spread over one row per participant, day and phase.

    Where two surveys of a kind fall on one day, the earlier one gives duration, score and
    note (the smaller survey id where they start together, so that a repeated task picks the
    same).  The spread is an aggregation, so a hot participant shrinks to one row per day
    before anything is joined.
    """
    kind = F.lower("survey_type")
    first = F.struct(
        F.coalesce("survey_start_datetime", F.lit("9999-12-31").cast("timestamp_ntz")).alias("at"),
        "survey_id",
        F.lit(1).alias("has_survey"),
        "survey_duration",
        "goodness_score",
        "added_note",
    )
    wide = surveys.groupBy("record_id", "date", F.col("study_phase").alias("phase")).agg(
        *[F.min(F.when(kind == k, first)).alias(k) for k in KINDS]
    )
    values = ["has_survey", "survey_duration", "goodness_score", "added_note"]
    return wide.select(
        "record_id",
        "date",
        "phase",
        *[
            F.col(f"{k}.{v}").alias(f"{v}_{k}")
            for v in values
            for k in KINDS
            if (v, k) != ("goodness_score", "morning")
        ],
    )


def survey_compliance_days(calendar: DataFrame, surveys: DataFrame) -> DataFrame:
    """Participant days with what was expected and what was done."""
    return mark_compliance(
        left_join(calendar, survey_days(surveys), ["record_id", "date", "phase"], null_safe=True)
    )


def mark_compliance(days: DataFrame) -> DataFrame:
    """Flags, counts and phase length on participant days that carry spread surveys."""
    phase = F.col("phase")
    expected_in = {"daily": 1, "morning": 2, "evening": 2}
    flags = {
        f"has_survey_{k}": recode.reconcile_flag(F.col(f"has_survey_{k}"), phase, p)
        for k, p in expected_in.items()
    }
    days = days.withColumns(flags)
    morning, evening = F.col("has_survey_morning"), F.col("has_survey_evening")
    return days.withColumns(
        {
            "number_surveys_completed": row_sum([F.col(c) for c in flags]),
            "number_surveys_expected": recode.surveys_expected(phase),
            "has_survey_morning_and_evening": recode.both_flags(morning, evening, phase == 2),
            "has_survey_morning_or_evening": recode.either_flag(morning, evening, phase == 2),
            "phase_duration": dates.inclusive_days(
                F.col("phase_start_date"), F.col("phase_end_date")
            ),
        }
    )


def survey_compliance(days: DataFrame) -> DataFrame:
    """Totals and completion rates per participant: phase 1, phase 2, overall."""
    counted = select_cols(days, contains="survey")
    counted = [c for c in counted if c.startswith(("number_surveys", "has_survey"))]
    totals = sum_columns(days, ["record_id", "phase", "phase_duration"], counted)
    values = ["phase_duration", *[f"total_{c}" for c in counted]]
    wide = pivot_values(
        totals, ["record_id"], "phase", [1, 2], values, template="{value}_phase{key}"
    )
    wide = drop_matching(wide, "daily.*phase2|morning.*phase1|evening.*phase1")
    return _rates(wide)


def _rates(wide: DataFrame) -> DataFrame:
    def total(name: str):
        return F.col(f"total_{name}")

    daily = total("has_survey_daily_phase1")
    either = total("has_survey_morning_or_evening_phase2")
    both = total("has_survey_morning_and_evening_phase2")
    days1, days2 = F.col("phase_duration_phase1"), F.col("phase_duration_phase2")
    done, due = "number_surveys_completed", "number_surveys_expected"
    wide = wide.withColumns(
        {
            f"total_{done}_overall": total(f"{done}_phase1") + total(f"{done}_phase2"),
            f"total_{due}_overall": total(f"{due}_phase1") + total(f"{due}_phase2"),
            "total_days_with_any_surveys_overall": daily + either,
            "total_days_with_all_surveys_overall": daily + both,
            "total_duration_overall": days1 + days2,
        }
    )
    share = "rate_days_with_surveys"
    rates = {
        f"rate_expected_surveys_completed_{scope}": ratio(
            total(f"{done}_{scope}"), total(f"{due}_{scope}")
        )
        for scope in ("overall", "phase1", "phase2")
    }
    for kind in ("any", "all"):
        rates[f"{share}_overall_{kind}"] = ratio(
            total(f"days_with_{kind}_surveys_overall"), total("duration_overall")
        )
    rates[f"{share}_phase1_daily"] = ratio(daily, days1)
    for kind in ("morning", "evening", "morning_or_evening", "morning_and_evening"):
        rates[f"{share}_phase2_{kind}"] = ratio(total(f"has_survey_{kind}_phase2"), days2)
    return wide.withColumns(rates)


def survey_compliance_report(
    responses: DataFrame,
    phases: DataFrame,
    prefix: str | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Compliance straight from responses and phases.

    Same rows as extract, days and totals in turn, but responses are reduced to participant
    days before they meet any other table: matching a calendar day of the right phase already
    means being inside that phase's window, so no raw response is joined or shuffled whole.
    """
    days = survey_days(clean_responses(responses, prefix, excluded))
    enrolled = both_windows(phases, prefix, excluded).select(F.col("pId").alias("record_id"))
    counted = days.join(enrolled, "record_id", "left_semi")
    calendar = study_calendar(phases, prefix, excluded)
    merged = left_join(calendar, counted, ["record_id", "date", "phase"], null_safe=True)
    return survey_compliance(mark_compliance(merged))


def average_goodness(surveys: DataFrame) -> DataFrame:
    """Goodness score per participant and phase, morning surveys left out."""
    return (
        surveys.filter(F.col("survey_type") != "MORNING")
        .groupBy("record_id", "study_phase")
        .agg(*stat_columns("goodness_score"))
    )
