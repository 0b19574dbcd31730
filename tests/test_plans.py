"""Study plans on hand-made participants."""

import datetime as dt

import pytest
from comparing import rows
from pyspark.sql import functions as F

from phasewise.functions import recode
from phasewise.plans import activities, demographics, devices, outcomes, sensors, study
from phasewise.sources import schemas

D, T = dt.date, dt.datetime


@pytest.fixture(scope="module")
def phases(spark):
    # "a" has both phases, "b" only the first, "c" an empty second phase.
    return spark.createDataFrame(
        [("a", "NOT_STARTED", D(2023, 12, 1), D(2024, 1, 1)),
         ("a", "PHASE_1", D(2024, 1, 1), D(2024, 1, 4)),
         ("a", "PHASE_2", D(2024, 1, 4), D(2024, 1, 6)),
         ("b", "PHASE_1", D(2024, 1, 1), D(2024, 1, 2)),
         ("c", "PHASE_1", D(2024, 1, 1), D(2024, 1, 2)),
         ("c", "PHASE_2", D(2024, 1, 2), D(2024, 1, 2))],
        schemas.USER_STUDY_PHASES,
    )


@pytest.fixture(scope="module")
def responses(spark):
    def r(pid, sid, kind, day, hour=8, score=5.0, note="x"):
        return (pid, sid, kind, D(2024, 1, day), T(2024, 1, day, hour), 60.0, score, note)

    return spark.createDataFrame(
        [r("a", "s1", "DAILY", 1), r("a", "s2", "DAILY", 1, 7, 9.0, ""),
         r("a", "s3", "DAILY", 3), r("a", "s4", "DAILY", 4), r("a", "s5", "MORNING", 4),
         r("a", "s6", "EVENING", 4, score=None, note=None), r("a", "s7", "EVENING", 5),
         r("a", "s8", "MORNING", 6), r("a", "s9", "OTHER", 2), r("b", "s10", "DAILY", 1)],
        "pId string, surveyId string, sId string, date date, startTime timestamp_ntz, "
        "timeTaken double, goodnessScore double, note string",
    )


def test_calendar(phases):
    days = study.study_calendar(phases)
    assert rows(days.groupBy("record_id", "phase").count()) == [
        ("a", 1, 3), ("a", 2, 2), ("b", 1, 1), ("c", 1, 1)
    ]
    assert rows(study.study_calendar(phases, excluded=["a"]).select("record_id")) == [("b",), ("c",)]


def test_surveys_stay_inside_their_own_phase(responses, phases):
    got = rows(study.survey_extract(responses, phases).select("survey_id", "goodness_score", "added_note"))
    # s4 is a daily survey on the exclusive end, s8 a morning one; "b" lacks a phase.
    assert got == [("s1", 5.0, 1), ("s2", 9.0, 0), ("s3", 5.0, 1), ("s5", None, 1),
                   ("s6", None, 1), ("s7", 5.0, 1)]


def test_compliance_by_hand(responses, phases):
    days = study.survey_compliance_days(
        study.study_calendar(phases), study.survey_extract(responses, phases)
    )
    a = {(r.phase, r.date.day): r for r in days.collect() if r.record_id == "a"}
    assert a[1, 1].goodness_score_daily == 9.0  # the earlier of two surveys
    assert (a[1, 2].has_survey_daily, a[1, 2].has_survey_morning) == (0, None)
    assert (a[2, 5].has_survey_morning_and_evening, a[2, 5].has_survey_morning_or_evening) == (0, 1)
    report = study.survey_compliance_report(responses, phases)
    assert rows(report) == rows(study.survey_compliance(days))
    r = [x for x in report.collect() if x.record_id == "a"][0]
    assert r.rate_expected_surveys_completed_phase1 == pytest.approx(2 / 3)
    assert r.rate_expected_surveys_completed_phase2 == pytest.approx(3 / 4)
    assert r.rate_expected_surveys_completed_overall == pytest.approx(5 / 7)
    assert r.rate_days_with_surveys_overall_any == pytest.approx(4 / 5)
    assert r.rate_days_with_surveys_overall_all == pytest.approx(3 / 5)


def test_surveys_that_start_together_are_told_apart_by_id(spark):
    rows_ = [("a", D(2024, 1, 1), 1, "DAILY", s, T(2024, 1, 1), float(i), float(i), i)
             for i, s in enumerate(("s3", "s1", "s2"))]
    df = spark.createDataFrame(
        rows_, "record_id string, date date, study_phase int, survey_type string, survey_id string, "
        "survey_start_datetime timestamp_ntz, survey_duration double, goodness_score double, "
        "added_note int",
    )
    got = study.survey_days(df.repartition(3)).first()
    assert (got.survey_duration_daily, got.goodness_score_daily, got.added_note_daily) == (1, 1, 1)


def test_goodness_leaves_morning_out(responses, phases):
    got = rows(study.average_goodness(study.survey_extract(responses, phases)))
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [("a", 1, 3, pytest.approx(19 / 3)), ("a", 2, 1, 5.0)]


def test_device_assignments(spark):
    devices_ = spark.createDataFrame([("D1", 1), ("D2", 9)], schemas.DEVICES)
    people = spark.createDataFrame([(1, "11", D(2024, 1, 1), D(2024, 1, 3))], schemas.PARTICIPANTS)
    got = study.device_assignments(devices_, people).collect()
    assert [(r.device_id, r.pid, r.start_date, r.end_date) for r in got] == [
        ("D1", "p11", "2024-01-01 00:00:00", "2024-01-02 23:59:59")
    ]


def _selected(spark, pairs, phase):
    return spark.createDataFrame(
        pairs, "pId string, activityId string, activity_name string"
    ).withColumns({f"phase{phase}_start_date": F.lit(None), f"phase{phase}_end_date": F.lit(None)})


def test_selection_leaves_absent_types_missing(spark):
    one = _selected(spark, [("7", "x1", "X"), ("7", "7_own", "O"), ("8", "x1", None)], 1)
    two = _selected(spark, [("7", "x1", "X"), ("8", "x1", None)], 2)
    got = {r.record_id: r for r in activities.activity_selection_summary(one, two).collect()}
    assert (got["7"].selected_phase1_all, got["7"].selected_phase1_custom) == (2, 1)
    assert got["7"].selected_phase1_not_phase2_all == 1
    # Missing names match each other, so this is one activity chosen twice.
    assert got["8"].selected_phase1_and_phase2_all == 1
    assert got["8"].selected_phase1_custom is None


def test_endorsement_counts_a_missing_activity(spark):
    df = spark.createDataFrame(
        [("s1", "a", D(2024, 1, 1), "x", 1, 5), ("s1", "a", D(2024, 1, 1), None, 1, None),
         ("s2", "a", D(2024, 1, 2), "x", 1, None)],
        "survey_id_daily string, pId string, date date, activityId string, endorsed int, "
        "activity_rating int",
    )
    r = activities.endorsement_summary(df).first()
    assert (r.phase1_total_endorsed, r.phase1_unique_endorsed, r.phase1_daily_surveys) == (3, 2, 2)
    assert r.phase1_endorsed_activity_rating_rate_mean == pytest.approx(0.25)
    # A day without ratings has no smallest rating and takes no part in the mean of them.
    assert r.phase1_activity_rating_min_mean == 5.0


def test_planned_and_completed(spark):
    planned = spark.createDataFrame(
        [("m1", "a", D(2024, 1, 1), "x", 1), ("m1", "a", D(2024, 1, 1), "y", 1),
         ("m2", "a", D(2024, 1, 2), "x", 1)],
        "survey_id_morning string, pId string, date date, activityId string, planned int",
    )
    completed = spark.createDataFrame(
        [("e1", "a", D(2024, 1, 1), "x", 1), ("e2", "a", D(2024, 1, 1), "x", 1),
         ("e1", "a", D(2024, 1, 1), "z", 1), ("e3", "a", D(2024, 1, 3), "z", 1)],
        "survey_id_evening string, pId string, date date, activityId string, completed int",
    )
    days = activities.planned_completed_days(planned, completed)
    assert rows(days.drop("record_id", "has_morning", "has_evening")) == [
        (D(2024, 1, 1), "x", 1, 1), (D(2024, 1, 1), "x", 1, 1), (D(2024, 1, 1), "y", 1, 0),
        (D(2024, 1, 1), "z", 0, 1), (D(2024, 1, 2), "x", 1, None), (D(2024, 1, 3), "z", None, 1),
    ]
    assert activities.planned_completed_days(planned, completed, dedupe=True).count() == 5
    r = activities.completion_summary(planned, completed).first()
    assert (r.phase2_total_planned, r.phase2_total_completed) == (4, 4)
    assert (r.phase2_unique_planned_and_completed, r.phase2_unique_completed_list) == (1, "x, z")
    assert (r.phase2_morning_surveys, r.phase2_morning_and_evening_surveys) == (2, 1)
    assert r.phase2_planned_activity_completion_rate_mean == pytest.approx(2 / 3)


def test_outcomes_wide_to_rows(spark):
    a = spark.createDataFrame([("1", 1.0, None)], "record_id string, cesd_score_bl double, cesd_score_mp double")
    b = spark.createDataFrame([("1", 3.0), ("2", 4.0)], "record_id string, sip_score_bl double")
    got = rows(outcomes.clean_outcomes([a, b]))
    assert got == [("1", "bl", 1, 1.0, 3.0), ("1", "mp", 2, None, None), ("2", "bl", 1, None, 4.0)]


def test_summary_scores_by_hand(spark):
    t = {"pf": 60.0, "pain": 40.0, "social": 55.0, "fatigue": 45.0, "dep": 50.0, "anxiety": 52.0,
         "sleep": 48.0, "cf": 99.0}
    names = ", ".join(f"promis_{d}_t_default_bl double" for d in t)
    promis = spark.createDataFrame([("1", *t.values()), ("2", None, *list(t.values())[1:])],
                                   f"record_id string, {names}")
    pain = spark.createDataFrame([("1", 3.0), ("2", 3.0)], "record_id string, global07_bl double")
    got = {r.record_id: r for r in outcomes.promis_summary_scores(promis, pain).collect()}
    z = {d: (v - 50) / 10 for d, v in t.items()}
    composite = (z["pain"] + (3.0 - 2.31) / 2.34) / 2
    emotion = (z["dep"] + z["anxiety"]) / 2
    physical = (0.872 * z["pf"] - 0.094 * composite + 0.113 * z["social"] - 0.009 * z["fatigue"]
                + 0.003 * emotion + 0.002 * z["sleep"])
    assert got["1"].promis_summary_physical_health_t == pytest.approx(50 + 10 * physical)
    assert got["1"].n_component_zscores_na == 0
    assert (got["2"].n_component_zscores_na, got["2"].promis_summary_mental_health_t) == (1, None)


def test_demographics(spark):
    columns = "record_id string, gender int, year_diganosed int, month_diganosed int, " \
              "day_diganosed int, demo_datetime timestamp_ntz, race___1 int, race___6 int"
    df = spark.createDataFrame([("1", 2, 2024, 1, 31, T(2024, 2, 1, 9), 1, 1)], columns)
    out = demographics.clean_demographics(
        {"phase0": df}, date_suffixes=["diagnosed"],
        intervals=[("date_diagnosed", "demo_datetime", "months")],
    )
    r = out.first()
    assert (r.cohort, r.gender, r.race_combined) == ("phase0", "Female", "White/Caucasian & Other")
    assert r.months_since_diagnosed_at_demo_datetime == 1
    assert r["race_White/Caucasian"] == "Yes"


def test_device_averages_use_days_of_sufficient_wear(spark):
    df = spark.createDataFrame(
        [("a", 1, 8 / 24, 10.0), ("a", 1, 7 / 24, 99.0), ("a", 2, None, 5.0), ("a", 2, 1.0, 20.0)],
        "record_id string, phase int, yield double, steps double",
    )
    avg = devices.average_device_features(df, ["steps"], "yield")
    got = {r.phase: (r.n_days, r.n_days_with_sufficient_data, r.steps_mean) for r in avg.collect()}
    assert got == {"1": (2, 1, 10.0), "2": (2, 1, 20.0), "overall": (4, 2, 15.0)}
    share = {r.phase: r.percent_days_with_sufficient_data
             for r in devices.device_compliance(avg).collect()}
    assert share == {"1": 50.0, "2": 50.0, "overall": 50.0}


def _minutes(spark, steps, day=D(2024, 1, 1)):
    data = [("p1", day, m, s, None, None) for m, s in steps.items()]
    return spark.createDataFrame(
        data, "pid string, date date, minute int, steps int, mets double, calories double"
    )


def test_bouts_break_at_gaps(spark):
    steps = {0: 20, 1: 20, 2: 0, 3: 20, 10: 20}
    r = sensors.bout_features(_minutes(spark, steps)).first()
    assert (r.countepisodeactivebout, r.maxdurationactivebout) == (3, 2)
    assert r.countepisodesedentarybout == 1
    assert r.activetosedentarytransitionprobability == pytest.approx(1 / 4)


def test_cadence_by_hand(spark):
    steps = {0: 100, 1: 50, 2: 0, 3: 0, 9: 130}
    r = sensors.cadence_features(_minutes(spark, steps), nonwear_minutes=2).first()
    assert r.uncensoredmeancadence == pytest.approx(280 / 3)
    assert (r.max5minutecadence, r.peak1minutecadence) == (30.0, 130.0)
    assert r.totalminutes120pluscadence == 1


def test_segments_past_midnight_belong_to_the_day_before(spark):
    df = _minutes(spark, {30: 1, 1400: 1}, D(2024, 1, 2))
    got = sensors.assign_segments(df, [("night", 1320, 480)])
    assert rows(got.select("date", "minute")) == [(D(2024, 1, 1), 1470), (D(2024, 1, 2), 1400)]


LABELLED = ["pid", "date", "local_segment_label"]


def test_a_walk_over_midnight_is_one_bout(spark):
    late = _minutes(spark, {m: 50 for m in range(1410, 1440)}, D(2024, 1, 1))
    early = _minutes(spark, {m: 50 for m in range(30)}, D(2024, 1, 2))
    night = sensors.assign_segments(late.union(early), [("night", 1320, 480)])
    [r] = sensors.bout_features(night, LABELLED).collect()
    assert (r.date, r.countepisodeactivebout, r.maxdurationactivebout) == (D(2024, 1, 1), 1, 60)
    [r] = sensors.cadence_features(night, LABELLED).collect()
    assert r.max60minutecadence == 50
    [r] = sensors.step_features(night, LABELLED).collect()
    assert (r.firststeptime, r.laststeptime, r.sumsteps) == (1410, 1469, 3000)


def test_segments_longer_than_a_day_overlap_themselves(spark):
    df = _minutes(spark, {600: 1}, D(2024, 1, 3))
    got = sensors.assign_segments(df, [("weekend", 540, 2880)])
    assert rows(got.select("date", "minute")) == [(D(2024, 1, 2), 2040), (D(2024, 1, 3), 600)]
    got = sensors.assign_segments(df, [("weekend", 660, 2880)])
    assert rows(got.select("date", "minute")) == [(D(2024, 1, 1), 3480), (D(2024, 1, 2), 2040)]


def test_yield_is_over_the_segments_own_hours(spark):
    """100 minutes from 23:30: one hour over midnight, and 40 minutes of which 20 are enough."""
    data = [("p1", D(2024, 1, 1), 1410 + m, 60.0) for m in range(15)]
    data += [("p1", D(2024, 1, 2), m, 60.0) for m in range(10, 30)]
    data += [("p1", D(2024, 1, 2), 30 + m, 60.0) for m in range(20)]
    df = spark.createDataFrame(data, "pid string, date date, minute int, heartrate double")
    r = sensors.data_yield(sensors.assign_segments(df, [("late", 1410, 100)]), LABELLED).first()
    assert r.ratiovalidyieldedhours == pytest.approx(1.0)
    assert r.ratiovalidyieldedminutes == pytest.approx(55 / 100)


def _stages(spark, *given):
    return spark.createDataFrame([("p1", *g) for g in given], "pid string, ts timestamp_ntz, duration_s int, level string, type string")


def test_a_session_over_midnight_is_one_night(spark):
    stages = _stages(
        spark, (T(2024, 1, 1, 23, 30), 1800, "light", "main"), (T(2024, 1, 2, 0, 0), 3600, "light", "main"),
        (T(2024, 1, 2, 1, 0), 600, "deep", "main"), (T(2024, 1, 2, 1, 10), 36_600, "light", "main"),
        (T(2024, 1, 2, 11, 20), 60, "light", "main"), (T(2024, 1, 2, 15, 0), 1200, "light", "nap"),
        (T(2024, 1, 2, 18, 0), 1200, "light", "nap"))
    got = rows(sensors.sleep_stage_episodes(stages).select("date", "level", "type", "duration"))
    first, second = D(2024, 1, 1), D(2024, 1, 2)
    assert got == [(first, "deep", "main", 10.0), (first, "light", "main", 90.0), (first, "light", "main", 611.0),
                   (second, "light", "nap", 20.0), (second, "light", "nap", 20.0)]


def test_the_longest_of_records_at_one_time_counts(spark):
    stages = _stages(spark, (T(2024, 1, 1, 23, 0), 60, "wake", "main"), (T(2024, 1, 1, 23, 0), 600, "deep", "main"),
                     (T(2024, 1, 1, 23, 2), None, "rem", "main"))
    got = rows(sensors.sleep_stage_episodes(stages).select("level", "duration"), "level")
    assert got == [("deep", 10.0), ("rem", None)]


def test_bed_and_wake_times_go_on_over_midnight(spark):
    given = [(T(2024, 1, 1, 22, 0), T(2024, 1, 2, 0, 15)), (T(2024, 1, 2, 0, 30), T(2024, 1, 2, 7, 0)),
             (T(2024, 1, 2, 10, 59), T(2024, 1, 2, 11, 30)), (T(2024, 1, 2, 11, 0), T(2024, 1, 2, 12, 0))]
    durations = ("minutes_after_wakeup", "minutes_asleep", "minutes_awake", "minutes_to_fall_asleep", "minutes_in_bed")
    episodes = spark.createDataFrame([("p1", *g, "main") for g in given], "pid string, start_ts timestamp_ntz, end_ts timestamp_ntz, type string")
    episodes = episodes.withColumns({c: F.lit(1.0) for c in ("efficiency", *durations)})
    got = sensors.sleep_summary_features(episodes).select(
        "date", "firstbedtimeall", "lastbedtimeall", "firstwaketimeall", "lastwaketimeall", "countepisodeall")
    assert rows(got) == [(D(2024, 1, 1), 1320, 2099, 1455, 2130, 3), (D(2024, 1, 2), 660, 660, 720, 720, 1)]


def test_yield_needs_half_an_hour(spark):
    data = [("p1", D(2024, 1, 1), m, 60.0) for m in range(30)]
    data += [("p1", D(2024, 1, 1), 60 + m, 60.0) for m in range(29)]
    data += [("p1", D(2024, 1, 1), 120 + m, 0.0) for m in range(60)]
    df = spark.createDataFrame(data, "pid string, date date, minute int, heartrate double")
    r = sensors.data_yield(df).first()
    assert r.ratiovalidyieldedhours == pytest.approx(1 / 24)
    assert r.ratiovalidyieldedminutes == pytest.approx(59 / 1440)


def test_daily_features_reach_the_calendar(spark, phases):
    samples = spark.createDataFrame(
        [("pa", T(2024, 1, 2, 10, 0, s), 60.0, None, 5, 1.0, 1.0, "x") for s in (1, 2)],
        "pid string, ts timestamp_ntz, heartrate double, hr_zone string, steps int, "
        "calories double, mets double, activity_level string",
    )
    features = sensors.daily_features(samples)
    name = "fitbit_steps_intraday_rapids_sumsteps"
    days = devices.calendar_device_features(study.study_calendar(phases), features, [name])
    known = [(r.record_id, r.date, r[name]) for r in days.collect() if r[name] is not None]
    assert known == [("a", D(2024, 1, 2), 10)]
    assert days.count() == 7


def test_ownership_by_prefix(spark):
    df = spark.createDataFrame([("12", "12_x"), ("12", "x12")], "o string, i string")
    got = rows(df.select(recode.ownership(F.col("o"), F.col("i"))))
    assert got == [("Custom",), ("Default",)]


def test_a_window_is_one_row_of_the_phase_table(spark):
    """Two rows of a phase: never the start of one with the end of the other."""
    given = [("a", "PHASE_1", D(2024, 1, 5), D(2024, 1, 9)), ("a", "PHASE_1", D(2024, 1, 2), None), ("a", "PHASE_1", None, D(2024, 1, 3)),
             ("a", "PHASE_2", D(2024, 2, 1), D(2024, 2, 5)), ("b", "PHASE_1", D(2024, 1, 1), D(2024, 1, 2))]
    phases = spark.createDataFrame(given, "pId string, phaseId string, startDate date, endDate date")
    assert rows(study.both_windows(phases)) == [("a", D(2024, 1, 2), None, D(2024, 2, 1), D(2024, 2, 4))]


def test_deviations_of_large_values_keep_their_digits(spark):
    values = [1e9 + x for x in (0, 1, 1, 2, 7)]
    df = spark.createDataFrame([("p", D(2024, 1, 1), v) for v in values], "pid string, date date, heartrate double")
    r = sensors._distribution(df, sensors.DAY, "heartrate", "hr").first()
    import statistics

    assert r.stdhr == pytest.approx(statistics.stdev(values), rel=1e-9)
