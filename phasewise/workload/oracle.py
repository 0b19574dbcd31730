"""The registered queries in SQL, written independently of the library.

Where the library aggregates, the SQL here joins (and the other way round), so that agreement
means more than repeating one plan twice.  ``FRAGMENTS`` are the shared common table
expressions; each names the ones it needs.
"""

from __future__ import annotations

from phasewise.plans import codebook
from phasewise.workload.queries import QUERIES

FRAGMENTS: dict[str, tuple[str, str]] = {}
BODIES: dict[str, tuple[str, str]] = {}


def fragment(name: str, needs: str, sql: str) -> None:
    FRAGMENTS[name] = (needs, sql)


def oracle(name: str, needs: str, sql: str) -> None:
    BODIES[name] = (needs, sql)


def _ordered(needs: str, seen: list[str]) -> list[str]:
    for name in needs.split():
        _ordered(FRAGMENTS[name][0], seen)
        if name not in seen:
            seen.append(name)
    return seen


def statement(name: str) -> str:
    """The complete statement of one query."""
    needs, body = BODIES[name]
    parts = [f"{n} AS ({FRAGMENTS[n][1]})" for n in _ordered(needs, [])]
    parts.append(f"answer AS ({body})")
    return f"WITH {', '.join(parts)} {QUERIES[name].shape.wrap('SELECT * FROM answer')}"


def statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES if name in BODIES}


def _stats(value: str, name: str, stats: str = "n mean sd min max", only: str = "") -> str:
    """Aggregates of a statistics bundle."""
    makers = {
        "n": "count", "mean": "avg", "sd": "stddev_samp", "min": "min", "max": "max", "sum": "sum"
    }
    keep = f" FILTER (WHERE {only})" if only else ""
    return ", ".join(f"{makers[s]}({value}){keep} AS {name}_{s}" for s in stats.split())


def _case(column: str, mapping: dict, otherwise: str) -> str:
    def quoted(x) -> str:
        return "'" + str(x).replace("'", "''") + "'"

    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
    return f"CASE CAST({column} AS VARCHAR) {whens} ELSE {otherwise} END"


# ---- events as surveys -----------------------------------------------------------------

fragment("ev", "", """
    SELECT CAST(user_id AS VARCHAR) AS pId, event_id, event_type, ts, CAST(ts AS DATE) AS date,
           value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events""")
fragment("responses", "ev", """
    SELECT pId, pId || '_' || kind || '_' || event_id AS surveyId, kind AS sId, date,
           ts AS startTime, k AS timeTaken, CASE WHEN k <> 0 THEN value END AS goodnessScore,
           CASE k % 3 WHEN 1 THEN '' WHEN 2 THEN 'text' END AS note
    FROM (SELECT *, CASE event_type WHEN 'click' THEN 'DAILY' WHEN 'view' THEN 'MORNING'
                    WHEN 'purchase' THEN 'EVENING' ELSE upper(event_type) END AS kind FROM ev) x""")
fragment("phases", "ev", """
    SELECT pId, phaseId, startDate, endDate FROM (SELECT DISTINCT pId FROM ev) u
    CROSS JOIN (VALUES ('NOT_STARTED', DATE '2023-12-01', DATE '2024-01-01'),
                       ('PHASE_1', DATE '2024-01-01', DATE '2024-01-15'),
                       ('PHASE_2', DATE '2024-01-15', DATE '2024-01-29')
               ) AS p(phaseId, startDate, endDate)""")
fragment("calendar", "phases", """
    SELECT pId AS record_id, CAST(replace(phaseId, 'PHASE_', '') AS INTEGER) AS phase,
           startDate AS phase_start_date, endDate - 1 AS phase_end_date,
           CAST(unnest(generate_series(CAST(startDate AS TIMESTAMP),
                CAST(endDate - 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
    FROM phases WHERE phaseId <> 'NOT_STARTED'""")
fragment("cleaned", "responses", """
    SELECT pId AS record_id, surveyId AS survey_id,
           CASE sId WHEN 'DAILY' THEN 1 WHEN 'MORNING' THEN 2 WHEN 'EVENING' THEN 2 END
             AS study_phase,
           sId AS survey_type, date, startTime AS survey_start_datetime,
           timeTaken AS survey_duration,
           CASE WHEN sId = 'MORNING' THEN NULL ELSE goodnessScore END AS goodness_score,
           CASE WHEN note = '' THEN 0 ELSE 1 END AS added_note
    FROM responses""")
fragment("surveys", "cleaned phases", """
    SELECT c.* FROM cleaned c
    JOIN phases a ON a.pId = c.record_id AND a.phaseId = 'PHASE_1'
    JOIN phases b ON b.pId = c.record_id AND b.phaseId = 'PHASE_2'
    WHERE (survey_type = 'DAILY' AND date >= a.startDate AND date < a.endDate)
       OR (survey_type IN ('MORNING', 'EVENING') AND date >= b.startDate AND date < b.endDate)""")

_KIND_VALUES = [
    (k, v)
    for k in ("daily", "morning", "evening")
    for v in ("survey_duration", "goodness_score", "added_note")
]
fragment("survey_wide", "surveys", f"""
    SELECT record_id, date, study_phase AS phase,
           {", ".join(f"max(CASE WHEN kind = '{k}' THEN 1 END) AS has_{k}"
                      for k in ("daily", "morning", "evening"))},
           {", ".join(f"max(CASE WHEN kind = '{k}' THEN {v} END) AS {v}_{k}"
                      for k, v in _KIND_VALUES)}
    FROM (SELECT *, lower(survey_type) AS kind,
                 row_number() OVER (PARTITION BY record_id, date, study_phase, survey_type
                                    ORDER BY survey_start_datetime, survey_id) AS place
          FROM surveys) x
    WHERE place = 1 GROUP BY 1, 2, 3""")
fragment("compliance_days", "calendar survey_wide", """
    SELECT *, date_diff('day', phase_start_date, phase_end_date) + 1 AS phase_duration,
           coalesce(has_survey_daily, 0) + coalesce(has_survey_morning, 0)
             + coalesce(has_survey_evening, 0) AS number_surveys_completed,
           phase AS number_surveys_expected,
           CASE WHEN phase = 2 THEN has_survey_morning * has_survey_evening END
             AS has_survey_morning_and_evening,
           CASE WHEN phase = 2 THEN greatest(has_survey_morning, has_survey_evening) END
             AS has_survey_morning_or_evening
    FROM (SELECT c.*, w.* EXCLUDE (record_id, date, phase),
                 CASE WHEN c.phase = 1 THEN coalesce(has_daily, 0) END AS has_survey_daily,
                 CASE WHEN c.phase = 2 THEN coalesce(has_morning, 0) END AS has_survey_morning,
                 CASE WHEN c.phase = 2 THEN coalesce(has_evening, 0) END AS has_survey_evening
          FROM calendar c LEFT JOIN survey_wide w
            ON w.record_id = c.record_id AND w.date = c.date AND w.phase = c.phase) x""")
fragment("compliance", "compliance_days", """
    SELECT record_id, d1 AS phase_duration_phase1, d2 AS phase_duration_phase2,
           daily AS total_number_surveys_completed_phase1,
           morning + evening AS total_number_surveys_completed_phase2,
           daily + morning + evening AS total_number_surveys_completed_overall,
           d1 + 2 * d2 AS total_number_surveys_expected_overall,
           daily + either AS total_days_with_any_surveys_overall,
           daily + n_both AS total_days_with_all_surveys_overall,
           d1 + d2 AS total_duration_overall,
           (daily + morning + evening) / (d1 + 2 * d2) AS rate_expected_surveys_completed_overall,
           daily / d1 AS rate_expected_surveys_completed_phase1,
           (morning + evening) / (2 * d2) AS rate_expected_surveys_completed_phase2,
           (daily + either) / (d1 + d2) AS rate_days_with_surveys_overall_any,
           (daily + n_both) / (d1 + d2) AS rate_days_with_surveys_overall_all,
           daily / d1 AS rate_days_with_surveys_phase1_daily,
           morning / d2 AS rate_days_with_surveys_phase2_morning,
           evening / d2 AS rate_days_with_surveys_phase2_evening,
           either / d2 AS rate_days_with_surveys_phase2_morning_or_evening,
           n_both / d2 AS rate_days_with_surveys_phase2_morning_and_evening
    FROM (SELECT record_id,
                 CAST(count(*) FILTER (WHERE phase = 1) AS DOUBLE) AS d1,
                 CAST(count(*) FILTER (WHERE phase = 2) AS DOUBLE) AS d2,
                 CAST(sum(has_survey_daily) AS DOUBLE) AS daily,
                 CAST(sum(has_survey_morning) AS DOUBLE) AS morning,
                 CAST(sum(has_survey_evening) AS DOUBLE) AS evening,
                 CAST(sum(has_survey_morning_and_evening) AS DOUBLE) AS n_both,
                 CAST(sum(has_survey_morning_or_evening) AS DOUBLE) AS either
          FROM compliance_days GROUP BY record_id) x""")
fragment("goodness", "surveys", f"""
    SELECT record_id, study_phase, {_stats("goodness_score", "goodness_score")}
    FROM surveys WHERE survey_type <> 'MORNING' GROUP BY 1, 2""")

# ---- orders as activities --------------------------------------------------------------

fragment("names", "", """
    SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS activityId, p_name AS activity_name FROM part
    UNION ALL SELECT DISTINCT 's' || s_suppkey, s_name FROM supplier""")
fragment("prefs", "", """
    SELECT CAST(o_custkey AS VARCHAR) AS pId, CAST(l_partkey AS VARCHAR) AS activityId,
           CASE WHEN CAST(o_orderdate AS DATE) < DATE '1998-05-01' THEN 1 ELSE 2 END AS phase
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
fragment("selection", "prefs", """
    SELECT record_id,
           {sums}
    FROM (SELECT pId AS record_id, activityId,
                 CASE WHEN starts_with(activityId, pId) THEN 'custom' ELSE 'default' END AS kind,
                 max(CASE WHEN phase = 1 THEN 1 ELSE 0 END) AS s1,
                 max(CASE WHEN phase = 2 THEN 1 ELSE 0 END) AS s2
          FROM prefs GROUP BY 1, 2, 3) x
    GROUP BY record_id""".format(sums=", ".join(
        # A type the participant has no activity of is missing, not 0.
        f"CASE WHEN count(*) FILTER (WHERE {here}) > 0 THEN count(*) FILTER "
        f"(WHERE ({here}) AND ({hit})) END AS selected_{name}_{kind}"
        for name, hit in {
            "phase1": "s1 = 1", "phase2": "s2 = 1", "phase1_and_phase2": "s1 = 1 AND s2 = 1",
            "phase1_not_phase2": "s1 = 1 AND s2 = 0", "phase2_not_phase1": "s1 = 0 AND s2 = 1",
        }.items()
        for kind, here in {
            "all": "true", "custom": "kind = 'custom'", "default": "kind = 'default'"
        }.items()
    )))
fragment("answers", "", """
    SELECT CAST(o_custkey AS VARCHAR) AS pId, CAST(o_orderdate AS DATE) AS date, l_orderkey,
           CAST(l_partkey AS VARCHAR) AS activityId, l_returnflag, l_linestatus,
           CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(trunc(l_quantity) AS INTEGER) END
             AS rating,
           CAST(o_orderdate AS DATE) >= DATE '1995-01-01'
             AND CAST(o_orderdate AS DATE) < DATE '1998-05-01' AS in1,
           CAST(o_orderdate AS DATE) >= DATE '1998-05-01'
             AND CAST(o_orderdate AS DATE) < DATE '2002-01-01' AS in2
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON c_custkey = o_custkey""")
fragment("endorsed", "answers", """
    SELECT DISTINCT 'S_DAILY_' || l_orderkey AS survey_id_daily, pId, date, activityId,
           1 AS endorsed, rating AS activity_rating FROM answers WHERE in1""")
fragment("planned", "answers", """
    SELECT DISTINCT 'S_MORNING_' || l_orderkey AS survey_id_morning, pId, date, activityId,
           1 AS planned FROM answers WHERE in2 AND l_returnflag <> 'N'""")
fragment("completed", "answers", """
    SELECT DISTINCT 'S_EVENING_' || l_orderkey AS survey_id_evening, pId, date, activityId,
           1 AS completed FROM answers WHERE in2 AND l_linestatus = 'F'""")
_DAY_STATS = {
    "total_endorsed": "te", "total_rated": "tr", "activity_rating_mean": "rm",
    "activity_rating_min": "rlo", "activity_rating_max": "rhi", "endorsed_activity_rating_rate": "rr",
}
fragment("endorsement", "endorsed", f"""
    SELECT p.*, d.* EXCLUDE (record_id) FROM
      (SELECT pId AS record_id, sum(endorsed) AS phase1_total_endorsed,
              count(activity_rating) AS phase1_total_rated,
              {_stats("activity_rating", "phase1_activity_rating", "mean sd min max")},
              count(DISTINCT activityId) AS phase1_unique_endorsed,
              count(DISTINCT CASE WHEN activity_rating IS NOT NULL THEN activityId END)
                AS phase1_unique_rated,
              count(DISTINCT survey_id_daily) AS phase1_daily_surveys
       FROM endorsed GROUP BY pId) p
    JOIN
      (SELECT pId AS record_id,
              {", ".join(_stats(v, f"phase1_{n}", "mean sd min max")
                         for n, v in _DAY_STATS.items())}
       FROM (SELECT *, CAST(tr AS DOUBLE) / te AS rr FROM
              (SELECT pId, date, sum(endorsed) AS te, count(activity_rating) AS tr,
                      avg(activity_rating) AS rm, min(activity_rating) AS rlo,
                      max(activity_rating) AS rhi
               FROM endorsed GROUP BY 1, 2) x) y
       GROUP BY pId) d USING (record_id)""")
fragment("planned_completed", "planned completed", """
    SELECT coalesce(p.pId, c.pId) AS record_id, coalesce(p.date, c.date) AS date,
           coalesce(m.has, 0) AS has_morning, coalesce(e.has, 0) AS has_evening,
           coalesce(p.activityId, c.activityId) AS activity_id,
           CASE WHEN m.has = 1 THEN coalesce(planned, 0) ELSE planned END AS planned,
           CASE WHEN e.has = 1 THEN coalesce(completed, 0) ELSE completed END AS completed
    FROM planned p FULL JOIN completed c
      ON c.pId = p.pId AND c.date = p.date AND c.activityId = p.activityId
    LEFT JOIN (SELECT DISTINCT pId, date, 1 AS has FROM planned) m
      ON m.pId = coalesce(p.pId, c.pId) AND m.date = coalesce(p.date, c.date)
    LEFT JOIN (SELECT DISTINCT pId, date, 1 AS has FROM completed) e
      ON e.pId = coalesce(p.pId, c.pId) AND e.date = coalesce(p.date, c.date)""")
_COMPLETION = {
    "planned": "planned = 1", "completed": "completed = 1",
    "planned_and_completed": "planned = 1 AND completed = 1",
    "planned_not_completed": "planned = 1 AND completed = 0",
    "completed_not_planned": "planned = 0 AND completed = 1",
}
fragment("completion", "planned_completed", f"""
    SELECT p.*, r.* EXCLUDE (record_id) FROM
      (SELECT record_id,
              count(DISTINCT date) FILTER (WHERE has_morning = 1) AS phase2_morning_surveys,
              count(DISTINCT date) FILTER (WHERE has_evening = 1) AS phase2_evening_surveys,
              count(DISTINCT date) FILTER (WHERE has_morning = 1 AND has_evening = 1)
                AS phase2_morning_and_evening_surveys,
              {", ".join(f"count(*) FILTER (WHERE {c}) AS phase2_total_{n}"
                         for n, c in _COMPLETION.items())},
              count(*) FILTER (WHERE planned = 0 AND completed = 0)
                AS phase2_total_not_planned_not_completed,
              {", ".join(f"count(DISTINCT activity_id) FILTER (WHERE {c}) AS phase2_unique_{n}"
                         for n, c in _COMPLETION.items())},
              {", ".join(f"coalesce(string_agg(DISTINCT activity_id, ', ' ORDER BY activity_id) "
                         f"FILTER (WHERE {c}), '') AS phase2_unique_{n}_list"
                         for n, c in _COMPLETION.items())}
       FROM planned_completed GROUP BY record_id) p
    JOIN
      (SELECT record_id, {_stats("rate", "phase2_planned_activity_completion_rate")}
       FROM (SELECT record_id, date,
                    CASE WHEN max(has_morning) = 1 AND max(has_evening) = 1 THEN
                      CAST(count(*) FILTER (WHERE planned = 1 AND completed = 1) AS DOUBLE)
                        / nullif(count(*) FILTER (WHERE planned = 1), 0) END AS rate
             FROM planned_completed GROUP BY 1, 2) x
       GROUP BY record_id) r USING (record_id)""")
fragment("engagement", "selection endorsement completion", """
    SELECT * FROM selection FULL JOIN endorsement USING (record_id)
    FULL JOIN completion USING (record_id)""")

# ---- customers as participants ---------------------------------------------------------


def _bits(question: str, shift: int) -> str:
    return ", ".join(
        f"(c >> {i + shift}) % 2 AS {question}{i + 1}"
        for i in range(len(codebook.MULTIPLE_CHOICE[question]))
    )


def _words(question: str, order: str = "code") -> str:
    """Chosen options joined in words, from the columns made by ``_bits``."""
    labels = codebook.MULTIPLE_CHOICE[question]
    entries = list(labels.items())
    if order == "reversed":
        entries = entries[::-1]
    elif order == "sorted":
        entries = sorted(entries, key=lambda e: e[1])
    elif order == "other_last":
        entries = entries[::-1]
        entries = [e for e in entries if not e[1].endswith("Other")] + [
            e for e in entries if e[1].endswith("Other")
        ]
    picked = ", ".join(f"CASE WHEN {question}{k} = 1 THEN '{v}' END" for k, v in entries)
    # concat_ws skips missing entries.
    return f"regexp_replace(concat_ws(', ', {picked}), ', ([^,]*)$', ' & \\1')"


fragment("people", "", f"""
    SELECT *, {_bits("race", 0)}, {_bits("living", 1)}, {_bits("cancer_treatment", 2)},
           CASE WHEN year IS NOT NULL
             THEN TRY_CAST(year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '-'
                           || lpad(CAST(day AS VARCHAR), 2, '0') AS DATE) END AS diagnosed,
           make_date(2024, CAST(c % 12 + 1 AS INTEGER), 15) AS demo
    FROM (SELECT c_custkey AS c, CAST(c_custkey AS VARCHAR) AS record_id,
                 CASE c_custkey % 2 WHEN 0 THEN 'phase0' ELSE 'phase1' END AS cohort,
                 20 + c_custkey % 60 AS age, c_custkey % 3 + 1 AS gender, c_custkey % 5 AS marital,
                 c_custkey % 7 AS employment, c_custkey % 6 + 1 AS education,
                 c_custkey % 4 + 1 AS cancer_status, c_custkey % 5 + 1 AS cancer,
                 CASE WHEN c_custkey % 2 = 1 THEN (c_custkey % 5 + 1) % 2 END AS hispanic,
                 CASE WHEN c_custkey % 11 <> 0 THEN 2015 + c_custkey % 12 END AS year,
                 c_custkey % 13 AS month, c_custkey % 31 + 1 AS day,
                 round(c_acctbal / 1000, 0) AS dhls
          FROM customer) x""")
_LABELLED = {
    q: _case(q, codebook.CATEGORICAL[q], f"CAST({q} AS VARCHAR)")
    for q in ("gender", "marital", "employment", "education", "cancer_status", "hispanic")
}
_LABELLED["cancer_category_participant"] = _case(
    "cancer", codebook.CATEGORICAL["cancer_category_participant"], "CAST(cancer AS VARCHAR)"
)
_MONTHS = """CASE WHEN (year(demo) - year(diagnosed)) * 12 + month(demo) - month(diagnosed) >= 0
    THEN (year(demo) - year(diagnosed)) * 12 + month(demo) - month(diagnosed) END"""
_DAYS = "CASE WHEN demo >= diagnosed THEN date_diff('day', diagnosed, demo) END"
fragment("demographics", "people", f"""
    SELECT cohort, record_id, age, {", ".join(f"{sql} AS {q}" for q, sql in _LABELLED.items())},
           {", ".join(f"{_words(q)} AS {q}_combined" for q in codebook.MULTIPLE_CHOICE)},
           {", ".join(" + ".join(f"{q}{k}" for k in opts) + f" AS {q}_combined_n_choices"
                      for q, opts in codebook.MULTIPLE_CHOICE.items())},
           {", ".join(f"CASE cancer_treatment{k} WHEN 1 THEN 'Yes' ELSE 'No' END"
                      f' AS "cancer_treatment_{v}"'
                      for k, v in codebook.MULTIPLE_CHOICE["cancer_treatment"].items())},
           diagnosed AS date_diagnosed, diagnosed AS date_diagnosed_stage4,
           diagnosed AS date_treatment, demo AS demo_datetime, dhls AS dhls_score,
           {_MONTHS} AS months_since_diagnosed_at_demo_datetime,
           {_MONTHS} AS months_since_diagnosed_stage4_at_demo_datetime,
           {_DAYS} AS days_since_treatment_at_demo_datetime
    FROM people""")
fragment("sides", "", """
    SELECT *, CASE WHEN c_nationkey < 12 THEN 'low' ELSE 'high' END AS side,
           CASE WHEN c_acctbal < 0 THEN 'Yes' ELSE 'No' END AS overdrawn,
           c_nationkey % 7 AS n_code,
           CASE WHEN c_acctbal < -970 THEN 'lowest' WHEN c_acctbal > 9960 THEN 'highest'
                WHEN c_acctbal BETWEEN 0 AND 25 THEN 'nothing' ELSE 'other' END AS band
    FROM customer""")

# ---- questionnaires --------------------------------------------------------------------

fragment("blocks", "ev", """
    SELECT pId AS record_id, event_type, value, k,
           CASE WHEN day(date) <= 10 THEN 'bl' WHEN day(date) <= 20 THEN 'mp'
                WHEN day(date) <= 30 THEN 'eos' END AS tp
    FROM ev""")
_DOMAINS = ("anxiety", "cf", "dep", "fatigue", "pain", "pf", "sleep", "social")
fragment("points", "", "SELECT * FROM (VALUES ('bl', 1), ('mp', 2), ('eos', 3)) AS p(tp, number)")
# Every participant has a row per timepoint, as the unpivoted wide exports do.
fragment("scores", "blocks points", f"""
    SELECT r.record_id, p.tp AS timepoint_name, p.number AS timepoint_number,
           avg(value) AS cesd_score,
           avg(value) FILTER (WHERE event_type = 'click') AS peat_score,
           avg(k) FILTER (WHERE event_type = 'view') AS sip_score,
           avg(k % 11) FILTER (WHERE k % 11 < 10) AS global07,
           {", ".join(f"avg(40 + value / 10) FILTER (WHERE k % 8 = {i}) AS {d}"
                      for i, d in enumerate(_DOMAINS))}
    FROM (SELECT DISTINCT record_id FROM blocks) r CROSS JOIN points p
    LEFT JOIN blocks b ON b.record_id = r.record_id AND b.tp = p.tp
    GROUP BY 1, 2, 3""")
fragment("promis", "scores", """
    SELECT *, 50 + 10 * (0.872 * zpf - 0.094 * zpain + 0.113 * zsocial - 0.009 * zfatigue
                         + 0.003 * zemot + 0.002 * zsleep) AS promis_summary_physical_health_t,
           50 + 10 * (-0.015 * zpf - 0.154 * zpain + 0.252 * zsocial - 0.351 * zfatigue
                      - 0.257 * zemot - 0.139 * zsleep) AS promis_summary_mental_health_t,
           (zpf IS NULL)::INT + (zpain IS NULL)::INT + (zsocial IS NULL)::INT
             + (zfatigue IS NULL)::INT + (zemot IS NULL)::INT + (zsleep IS NULL)::INT
             AS n_component_zscores_na
    FROM (SELECT *, (pf - 50) / 10 AS zpf, (social - 50) / 10 AS zsocial,
                 (fatigue - 50) / 10 AS zfatigue, (sleep - 50) / 10 AS zsleep,
                 ((pain - 50) / 10 + (global07 - 2.31) / 2.34) / 2 AS zpain,
                 ((dep - 50) / 10 + (anxiety - 50) / 10) / 2 AS zemot
          FROM scores) x""")

# ---- devices ---------------------------------------------------------------------------


def _band(names: str) -> str:
    return "CASE k % 4 " + " ".join(
        f"WHEN {i} THEN '{n}'" for i, n in enumerate(names.split())
    ) + " END"


_ZONES = "outofrange fatburn cardio peak"
_LEVELS = "sedentary lightlyactive fairlyactive veryactive"
fragment("grid", "ev", f"""
    SELECT 'p' || pId AS pid, date_trunc('minute', ts) AS ts, any_value(date) AS date,
           any_value(hour(ts) * 60 + minute(ts)) AS minute,
           avg(CASE WHEN k % 10 <> 0 THEN 50 + k END) AS heartrate,
           sum(CAST(trunc(value * 4) AS BIGINT)) AS steps,
           max({_band(_ZONES)}) AS hr_zone
    FROM ev GROUP BY 1, 2""")
fragment("dense", "ev", f"""
    SELECT 'p' || pId AS pid, spot AS ts, CAST(spot AS DATE) AS date,
           hour(spot) * 60 + minute(spot) AS minute, sum(s) AS steps, sum(value / 10) AS calories,
           avg(CAST(met AS DOUBLE)) AS mets, max(level) AS activity_level
    FROM (SELECT pId, value, date_trunc('minute', ts) + to_minutes(i) AS spot, (k + i) % 6 AS met,
                 {_band(_LEVELS)} AS level,
                 CASE WHEN (k + i) % 4 <> 0 THEN CAST(trunc(value + i) AS BIGINT) ELSE 0 END AS s
          FROM (SELECT *, unnest(range(0, k % 20 + 1)) AS i FROM ev) x) y
    GROUP BY 1, 2, 3, 4""")
fragment("walked", "dense", "SELECT * FROM dense WHERE steps <= 1000")
fragment("episodes", "ev", """
    SELECT 'p' || pId AS pid, ts AS start_ts, ts + to_minutes(60 + k * 5) AS end_ts,
           CASE event_type WHEN 'click' THEN 'main' ELSE 'nap' END AS type,
           50 + k % 50 AS efficiency, (60 + k * 5) * 0.75 AS minutes_asleep,
           (60 + k * 5) * 0.125 AS minutes_awake, k % 7 AS minutes_to_fall_asleep,
           k % 5 AS minutes_after_wakeup, 60 + k * 5 AS minutes_in_bed
    FROM ev""")
fragment("sleep", "episodes", """
    SELECT *, date_diff('minute', CAST(date AS TIMESTAMP), start_ts) AS bed,
           date_diff('minute', CAST(date AS TIMESTAMP), end_ts) AS wake
    FROM (SELECT *, CAST(start_ts - INTERVAL 11 HOUR AS DATE) AS date FROM episodes) x""")
fragment("device_days", "calendar grid sleep", """
    SELECT c.record_id, c.phase, c.date, 'p' || c.record_id AS pid, y.hours / 24.0 AS yield,
           h.avghr, s.sumsteps, z.asleep
    FROM calendar c
    LEFT JOIN (SELECT pid, date, count(*) FILTER (WHERE valid >= 1) AS hours
               FROM (SELECT pid, date, minute // 60 AS hour,
                            count(*) FILTER (WHERE heartrate <> 0) AS valid
                     FROM grid GROUP BY 1, 2, 3) q GROUP BY 1, 2) y
      ON y.pid = 'p' || c.record_id AND y.date = c.date
    LEFT JOIN (SELECT pid, date, avg(heartrate) AS avghr FROM grid GROUP BY 1, 2) h
      ON h.pid = 'p' || c.record_id AND h.date = c.date
    LEFT JOIN (SELECT pid, date, sum(steps) AS sumsteps FROM grid WHERE steps <= 1000
               GROUP BY 1, 2) s ON s.pid = 'p' || c.record_id AND s.date = c.date
    LEFT JOIN (SELECT pid, date, sum(minutes_asleep) AS asleep FROM sleep GROUP BY 1, 2) z
      ON z.pid = 'p' || c.record_id AND z.date = c.date""")
_WORN = "yield >= CAST(1 AS DOUBLE) / 12"
fragment("device_avg", "device_days", f"""
    SELECT record_id, phase, count(*) AS n_days,
           count(*) FILTER (WHERE {_WORN}) AS n_days_with_sufficient_data,
           {", ".join(_stats(f, f, only=_WORN) for f in ("avghr", "sumsteps", "asleep"))}
    FROM (SELECT *, CAST(phase AS VARCHAR) AS label FROM device_days
          UNION ALL SELECT *, 'overall' FROM device_days) x(record_id, p, date, pid, yield, avghr,
                                                            sumsteps, asleep, phase)
    GROUP BY 1, 2""")
fragment("device_compliance", "device_avg", """
    SELECT record_id, phase, n_days, n_days_with_sufficient_data,
           n_days_with_sufficient_data / CAST(n_days AS DOUBLE) AS prop_days_with_sufficient_data,
           100 * n_days_with_sufficient_data / CAST(n_days AS DOUBLE)
             AS percent_days_with_sufficient_data,
           'ratiovalidyieldedhours' AS data_yield_feature,
           CAST(1 AS DOUBLE) / 12 AS data_yield_threshold
    FROM device_avg""")

# ---- distribution tails by Simpson's rule ----------------------------------------------

_STEPS = 4000
_WEIGHT = f"(CASE WHEN i IN (0, {_STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"


def _simpson(f: str, low: str, high: str) -> str:
    """Integral of ``f``, written in terms of ``{x}``, over outer columns."""
    h = f"((({high}) - ({low})) / {_STEPS})"
    body = f.replace("{x}", f"(({low}) + i * {h})")
    return f"(SELECT sum({_WEIGHT} * ({body})) * {h} / 3 FROM range(0, {_STEPS} + 1) AS r(i))"


def _t_p(t: str, df: str) -> str:
    area = _simpson(f"pow(cos({{x}}), {df} - 1)", f"atan(abs({t}) / sqrt({df}))", "pi() / 2")
    return f"2 / sqrt(pi()) * exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) * {area}"


def _f_p(f: str, d1: str, d2: str) -> str:
    area = _simpson(
        f"pow(sin({{x}}), {d2} - 1) * pow(cos({{x}}), {d1} - 1)",
        "0.0", f"asin(sqrt({d2} / ({d2} + {d1} * {f})))",
    )
    front = f"exp(lgamma(({d1} + {d2}) / 2) - lgamma({d1} / 2) - lgamma({d2} / 2))"
    return f"2 * {front} * {area}"


def _chi2_p(x: str, df: str) -> str:
    root = f"sqrt({x})"
    area = _simpson(f"pow({{x}}, {df} - 1) * exp(-{{x}} * {{x}} / 2)", root, f"{root} + 14")
    return f"2 * exp(-{df} / 2 * ln(2) - lgamma({df} / 2)) * {area}"


def _t_975(df: str) -> str:
    """t quantile for a 95% interval: expansion around the normal one, then a Newton step."""
    z = 1.959963984540054
    terms = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    t = f"({z!r}" + "".join(f" + {c!r} / pow({df}, {i})" for i, c in enumerate(terms, 1)) + ")"
    density = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi()) * " \
              f"pow(1 + {t} * {t} / {df}, -({df} + 1) / 2)"
    return f"({t} + ({_t_p(t, df)} - 0.05) / (2 * {density}))"


_SIZE = """CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small'
    WHEN abs(d) < 0.8 THEN 'moderate' ELSE 'large' END"""

# ---- sources, projection, scalars ------------------------------------------------------

oracle("src_cohort_union", "people", """
    SELECT cohort, record_id, age, hispanic, year AS year_diagnosed, day AS day_treatment,
           cancer AS cancer_category_participant, dhls AS dhls_score FROM people""")
oracle("src_csv", "", """
    SELECT kind, count(*) AS n, count(*) FILTER (WHERE kind <> 'torn') AS ids,
           sum(CASE WHEN kind <> 'torn' THEN length(c_name) + CASE c_custkey % 4 WHEN 0 THEN 10 WHEN 1 THEN 9 ELSE 0 END END)
             AS letters,
           sum(c_acctbal) FILTER (WHERE kind = 'good' AND c_custkey % 13 <> 0) AS balance
    FROM (SELECT *, CASE WHEN c_custkey % 17 = 0 THEN 'torn' WHEN c_custkey % 11 = 0 THEN 'balance'
                    ELSE 'good' END AS kind FROM customer) x GROUP BY 1""")
oracle("snk_ordered", "ev", """
    SELECT pId, event_type, event_id, row_number() OVER (ORDER BY ts, event_id) AS place FROM ev""")
oracle("src_json_rejects", "ev", """
    SELECT CASE k % 7 WHEN 0 THEN 'torn' WHEN 1 THEN 'dataset' ELSE 'good' END AS kind, count(*) AS n
    FROM ev GROUP BY 1""")
oracle("flt_yield", "device_days", f"""
    SELECT record_id, date, phase, CASE WHEN {_WORN} THEN yield END AS yield,
           CASE WHEN {_WORN} THEN avghr END AS avghr, CASE WHEN {_WORN} THEN sumsteps END AS sumsteps,
           CASE WHEN {_WORN} THEN asleep END AS asleep FROM device_days""")
oracle("src_json_minutes", "ev", """
    SELECT 'p' || pId AS pid, date, count(*) AS minutes, sum(k) AS steps, avg(value) AS heartrate
    FROM ev GROUP BY 1, 2""")
oracle("src_phase_averages", "device_avg", """
    SELECT record_id, CAST(phase AS INTEGER) AS study_phase, n_days, n_days_with_sufficient_data,
           avghr_mean FROM device_avg WHERE phase <> 'overall'""")
_KINDS = ("click", "view", "purchase", "signup", "error")
oracle("src_fold_join", "ev", "SELECT pId AS record_id, " + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{k}') AS n_{k}, sum(value) FILTER (WHERE event_type = '{k}') AS total_{k}"
    for k in _KINDS
) + " FROM ev WHERE event_type IS NOT NULL GROUP BY 1")
oracle("proj_harmonize", "scores", "SELECT record_id, " + ", ".join(
    f"max({m}_score) FILTER (WHERE timepoint_name = '{tp}') AS q_{m}_{name}"
    for m in ("cesd", "peat", "sip") for tp, name in (("bl", "baseline"), ("mp", "middle"))
) + " FROM scores GROUP BY 1")
oracle("rec_mapping", "demographics", """
    SELECT record_id, gender, marital, employment, education, cancer_status FROM demographics""")
oracle("rec_sentinel", "", """
    SELECT activityId, sum(copies) AS n_answers,
           coalesce(sum(copies) FILTER (WHERE rating IS NOT NULL), 0) AS n_rated,
           sum(copies * rating) AS rating_sum
    FROM (SELECT CAST(l_partkey AS VARCHAR) AS activityId,
                 CASE WHEN l_linenumber <> 7 THEN CAST(trunc(l_quantity) AS INTEGER) END AS rating,
                 1 + CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END
                   + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS copies
          FROM lineitem) x GROUP BY 1""")
oracle("rec_survey_fields", "cleaned", """
    SELECT survey_type, study_phase, added_note, count(*) AS n,
           count(goodness_score) AS n_goodness, sum(goodness_score) AS goodness_sum
    FROM cleaned GROUP BY 1, 2, 3""")
oracle("rec_flags", "ev", """
    SELECT event_type, phase, flag, "both", either, filled, count(*) AS n FROM
      (SELECT event_type, phase,
              CASE WHEN phase = 2 THEN coalesce(a, 0) END AS flag,
              CASE WHEN phase = 2 AND a + b = 2 THEN 1
                   WHEN phase = 2 AND (a = 0 OR b = 0) THEN 0 END AS "both",
              CASE WHEN phase = 2 AND (a = 1 OR b = 1) THEN 1
                   WHEN phase = 2 AND a + b = 0 THEN 0 END AS either,
              CASE WHEN a = 1 THEN coalesce(b, 0) ELSE b END AS filled
       FROM (SELECT event_type, k % 2 + 1 AS phase,
                    CASE k % 3 WHEN 1 THEN 0 WHEN 2 THEN 1 END AS a,
                    CASE k % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS b FROM ev) x) y
    GROUP BY ALL""")
_MARITAL = codebook.LEVELS["marital"]
oracle("rec_levels", "demographics", f"""
    SELECT record_id, {_case("marital", {m: m for m in _MARITAL}, "NULL")} AS closed,
           {_case("marital", {m: i + 1 for i, m in enumerate(_MARITAL)}, "NULL")} AS place,
           upper(substr(said, 1, 1)) || lower(substr(said, 2)) AS living
    FROM (SELECT *, CASE WHEN living_combined LIKE '%Partner%'
                           OR living_combined LIKE '%Children%'
                    THEN 'With ' || living_combined ELSE living_combined END AS said
          FROM demographics) x""")
oracle("rec_ownership", "", """
    SELECT o_orderpriority,
           CASE WHEN CAST(o_orderkey AS VARCHAR) LIKE CAST(o_custkey AS VARCHAR) || '%'
                THEN 'Custom' ELSE 'Default' END AS activity_type, count(*) AS n
    FROM orders GROUP BY 1, 2""")
oracle("dt_construct", "demographics", """
    SELECT record_id, date_diagnosed, date_diagnosed_stage4, date_treatment FROM demographics""")
oracle("dt_interval_months", "demographics", """
    SELECT record_id, months_since_diagnosed_at_demo_datetime,
           months_since_diagnosed_stage4_at_demo_datetime, days_since_treatment_at_demo_datetime
    FROM demographics""")
oracle("dt_interval_days", "", """
    SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE d < 0) AS n_negative,
           sum(d) FILTER (WHERE d >= 0) AS days, sum(m) FILTER (WHERE m >= 0) AS months,
           sum(y) FILTER (WHERE y >= 0) AS years
    FROM (SELECT o_orderpriority,
                 date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d,
                 date_diff('month', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS m,
                 date_diff('year', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS y
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x GROUP BY 1""")
oracle("dt_windows", "phases", """
    SELECT pId, strftime(startDate, '%Y-%m-%d 00:00:00') AS opening,
           strftime(endDate - 1, '%Y-%m-%d 23:59:59') AS closing, 'p' || pId AS tag,
           endDate - startDate AS days FROM phases""")
oracle("str_pretty_join", "people", f"""
    SELECT record_id, {_words("race", "reversed")} AS plain,
           {_words("race", "sorted")} AS sorted_text,
           {_words("race", "other_last")} AS other_last FROM people""")
oracle("str_separate", "blocks", " UNION ALL ".join(
    f"""SELECT 'promis' AS instrument, '{d}' AS domain, 't' AS score_type,
        'default' AS calibration_type, '{tp}' AS timepoint, count(m) AS n, sum(m) AS value_sum
        FROM (SELECT avg(40 + value / 10) FILTER (WHERE k % 8 = {i} AND tp = '{tp}') AS m
              FROM blocks GROUP BY record_id) x"""
    for i, d in enumerate(_DOMAINS) for tp in ("bl", "mp", "eos")
) + " UNION ALL " + " UNION ALL ".join(
    f"""SELECT 'promis', 'pf', 'raw', 'default', '{tp}', count(m), sum(m)
        FROM (SELECT avg(value) FILTER (WHERE tp = '{tp}') AS m
              FROM blocks GROUP BY record_id) x""" for tp in ("bl", "mp", "eos")
))
oracle("str_tokens", "", """
    SELECT list_extract(string_split(name, '_'), -1) AS last,
           substr(name, 1, length(name) - position('_' IN reverse(name))) AS stem,
           upper(substr(words, 1, 1)) || lower(substr(words, 2)) AS label, count(*) AS n
    FROM (SELECT name, replace(replace(name, '_', ' '), '#', ' no. ') AS words
          FROM (SELECT lower(p_type) || '_' || lower(p_brand) AS name FROM part) x) y
    GROUP BY ALL""")
_P_TEXT = """CASE WHEN {p} < 0.0005 THEN '<0.001' WHEN {p} >= 0.9995 THEN '>0.999'
    ELSE CAST(CAST(round({p}, 3) AS DOUBLE) AS VARCHAR) END"""
oracle("fmt_p", "ev", f"""
    SELECT {_P_TEXT.replace("{p}", "p")} AS shown, count(*) AS n
    FROM (SELECT (value / 493.7) * (value / 493.7) AS p FROM ev) x GROUP BY 1""")


def _fixed(x: str, digits: int) -> str:
    return f"format('{{:,.{digits}f}}', CAST({x} AS DOUBLE))"


def _plain(x: str) -> str:
    """At most two decimals without trailing zeros."""
    return (
        f"regexp_replace(regexp_replace(printf('%.2f', CAST({x} AS DOUBLE)), '0+$', ''), "
        "'\\.$', '')"
    )


def _percent(share: str) -> str:
    p = f"(100 * ({share}))"
    return f"""CASE WHEN {p} = 0 THEN '0' WHEN {p} < 0.1 THEN '<0.1'
        WHEN {p} < 10 THEN {_fixed(p, 1)} ELSE {_fixed(p, 0)} END"""


def _four(x: str, digits: tuple = (1, 1, 0, 0), only: str = "true") -> str:
    parts = [f"{f}({x}) FILTER (WHERE {only})" for f in ("avg", "stddev_samp", "min", "max")]
    m, s, lo, hi = (f"coalesce({_fixed(p, d)}, 'NA')" for p, d in zip(parts, digits))
    return f"{m} || ' (' || {s} || ') [' || {lo} || ', ' || {hi} || ']'"


oracle("fmt_summary", "ev", f"""
    SELECT event_type, {_four("value")} AS stats,
           {_plain("min(value)")} || ', ' || {_plain("max(value)")} AS range,
           {_fixed("count(*) FILTER (WHERE k < 7)", 0)} || ' (' ||
             {_percent("count(*) FILTER (WHERE k < 7) / CAST(count(*) AS DOUBLE)")} || '%)'
             AS share,
           CASE WHEN min(value) < 0.05 THEN 1 ELSE 0 END AS significant
    FROM ev GROUP BY 1""")
oracle("mc_combine", "demographics", """
    SELECT record_id, race_combined, living_combined, cancer_treatment_combined,
           "cancer_treatment_Surgery" FROM demographics""")
oracle("mc_count", "demographics", """
    SELECT record_id, race_combined_n_choices, living_combined_n_choices,
           cancer_treatment_combined_n_choices FROM demographics""")
oracle("mth_scores", "ev", """
    SELECT event_type, count(*) AS n, sum(CASE WHEN k % 2 = 0 THEN 2 * k ELSE k END) AS row_total,
           avg(CASE WHEN k % 3 <> 0 THEN (value + k) / 2 END) AS mean_of_two,
           avg((value - 50) / 10) AS z, avg(value) AS t,
           avg(CASE WHEN k % 4 <> 0 THEN value / (k % 4) END) AS share,
           -sum(value) AS reversed_sum FROM ev GROUP BY 1""")
oracle("mth_differences", "goodness", """
    SELECT coalesce(a.record_id, b.record_id) AS record_id,
           b.goodness_score_mean - a.goodness_score_mean AS goodness_difference,
           b.goodness_score_n - a.goodness_score_n AS n_difference
    FROM (SELECT * FROM goodness WHERE study_phase = 1) a
    FULL JOIN (SELECT * FROM goodness WHERE study_phase = 2) b ON a.record_id = b.record_id""")

# ---- filters, reshaping, joins ---------------------------------------------------------

oracle("flt_scope_like", "responses", """
    SELECT pId, sId, count(*) AS n FROM responses
    WHERE pId LIKE '1%' AND pId NOT IN ('1', '13')
      AND (surveyId LIKE '%_DAILY_%' OR surveyId LIKE '%_EVENING_%') GROUP BY 1, 2""")
oracle("flt_complete_group", "scores", """
    SELECT record_id, timepoint_name, sip_score FROM scores WHERE record_id IN
      (SELECT record_id FROM scores GROUP BY 1 HAVING count(sip_score) = 3 AND count(*) = 3)""")
oracle("flt_complete_rows", "ev", """
    SELECT event_type, count(*) AS n, sum(2 * k) AS total FROM ev
    WHERE k % 3 <> 0 AND k % 5 <> 0 GROUP BY 1""")
oracle("rsh_unpivot", "scores", " UNION ALL ".join(
    f"SELECT record_id, '{m}_' || timepoint_name AS variable, {m} AS value FROM scores"
    for m in ("cesd_score", "peat_score", "sip_score")
))
oracle("rsh_pivot_multi", "ev", "SELECT pId, " + ", ".join(
    f"nullif(count(*) FILTER (WHERE event_type = '{e}'), 0) AS n_{e}, "
    f"sum(value) FILTER (WHERE event_type = '{e}') AS total_{e}"
    for e in ("click", "view", "purchase", "signup", "error")
) + " FROM ev GROUP BY 1")
oracle("rsh_calendar", "", """
    SELECT record_id, 1 AS phase, last_day - n + 1 AS phase_start_date, last_day AS phase_end_date,
           last_day - i AS date
    FROM (SELECT o_orderkey AS record_id, CAST(o_orderdate AS DATE) - 1 AS last_day,
                 CAST(o_orderkey % 5 AS INTEGER) AS n FROM orders) x
    JOIN (SELECT CAST(range AS INTEGER) AS i FROM range(0, 5)) d ON d.i < n""")
oracle("rsh_segments", "calendar grid", """
    SELECT c.record_id, c.phase, c.date,
           m.hours / 6.0 AS fitbit_data_yield_rapids_ratiovalidyieldedhours_morning,
           e.hours / 8.0 AS fitbit_data_yield_rapids_ratiovalidyieldedhours_evening,
           m.hr AS fitbit_heartrate_intraday_rapids_avghr_morning,
           m.st AS fitbit_steps_intraday_rapids_sumsteps_morning,
           e.hr AS fitbit_heartrate_intraday_rapids_avghr_evening,
           e.st AS fitbit_steps_intraday_rapids_sumsteps_evening
    FROM calendar c
    LEFT JOIN (SELECT pid, date, count(DISTINCT minute // 60) FILTER (WHERE heartrate > 0) AS hours,
                      avg(heartrate) AS hr, sum(steps) FILTER (WHERE steps <= 1000) AS st
               FROM grid WHERE minute >= 360 AND minute < 720 GROUP BY 1, 2) m
      ON m.pid = 'p' || c.record_id AND m.date = c.date
    LEFT JOIN (SELECT pid, date - CASE WHEN minute < 120 THEN 1 ELSE 0 END AS date,
                      count(DISTINCT minute // 60) FILTER (WHERE heartrate > 0) AS hours,
                      avg(heartrate) AS hr, sum(steps) FILTER (WHERE steps <= 1000) AS st
               FROM grid WHERE minute >= 1080 OR minute < 120 GROUP BY 1, 2) e
      ON e.pid = 'p' || c.record_id AND e.date = c.date""")
oracle("jn_interval", "ev", """
    SELECT pId, CASE WHEN date < DATE '2024-01-15' THEN 'PHASE_1' ELSE 'PHASE_2' END AS phaseId,
           count(*) AS n, sum(value) AS total
    FROM ev WHERE date >= DATE '2024-01-01' AND date < DATE '2024-01-29' GROUP BY 1, 2""")
oracle("jn_full_nullsafe", "ev", """
    SELECT nullif(coalesce(l.key, r.key), -1) AS key,
           coalesce(l.event_type, r.event_type) AS event_type, clicks, total
    FROM (SELECT CASE k % 7 WHEN 0 THEN -1 ELSE k % 7 END AS key, event_type, count(*) AS clicks
          FROM ev GROUP BY 1, 2) l
    FULL JOIN (SELECT CASE k % 7 WHEN 0 THEN -1 ELSE k % 7 END AS key,
                      CASE event_type WHEN 'error' THEN 'other' ELSE event_type END AS event_type,
                      sum(value) AS total FROM ev WHERE event_type <> 'view' GROUP BY 1, 2) r
      ON l.key = r.key AND l.event_type = r.event_type""")
oracle("jn_presence", "responses", """
    SELECT pId, date, count(*) FILTER (WHERE sId = 'DAILY') AS n,
           max(CASE WHEN sId = 'MORNING' THEN 1 ELSE 0 END) AS has_morning,
           max(CASE WHEN sId = 'EVENING' THEN 1 ELSE 0 END) AS has_evening
    FROM responses WHERE sId IN ('DAILY', 'MORNING', 'EVENING') GROUP BY 1, 2""")

# ---- aggregation, windows, sets --------------------------------------------------------

oracle("agg_bundle", "ev", f"""
    SELECT pId, event_type, {_stats("value", "value")},
           {_stats("k", "k", only="k % 4 <> 0")} FROM ev GROUP BY 1, 2""")
oracle("agg_filtered_bundle", "ev", f"""
    SELECT pId, count(*) AS n_rows, {_stats("value", "value", only="k > 90")}
    FROM ev GROUP BY 1""")
oracle("agg_level_overall", "ev", """
    SELECT pId, event_type, count(*) AS n, sum(value) AS total
    FROM (SELECT pId, value, CASE WHEN event_type <> 'error' THEN event_type END AS event_type
          FROM ev UNION ALL SELECT pId, value, 'overall' FROM ev) x GROUP BY 1, 2""")
oracle("agg_cond_distinct", "", """
    SELECT p_brand, count(*) AS n, count(DISTINCT o_custkey) AS items,
           count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 200000) AS large,
           count(DISTINCT o_custkey) FILTER (WHERE o_totalprice <= 200000) AS small
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    GROUP BY 1""")
oracle("agg_distinct_missing", "ev", """
    SELECT pId, count(DISTINCT event_type) AS kinds, count(DISTINCT k % 10) AS distinct_k
    FROM ev GROUP BY 1""")
oracle("agg_distinct_list", "ev", """
    SELECT pId, count(DISTINCT event_type) AS kinds,
           count(DISTINCT event_type) FILTER (WHERE value > 100) AS high,
           string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS kinds_list,
           coalesce(string_agg(DISTINCT event_type, ', ' ORDER BY event_type)
                    FILTER (WHERE value > 100), '') AS high_list
    FROM ev GROUP BY 1""")
oracle("agg_two_level", "ev", f"""
    SELECT pId, count(*) AS days, {_stats("n", "n", "mean sd min max")},
           {_stats("best", "best", "mean sd min max")}
    FROM (SELECT pId, date, count(*) AS n, max(value) AS best FROM ev GROUP BY 1, 2) x GROUP BY 1""")
oracle("agg_strict_sum", "ev", """
    SELECT pId, date, count(*) FILTER (WHERE k % 6 = 0) AS n_missing,
           CASE WHEN bool_and(k % 6 <> 0) THEN sum(value) END AS strict,
           coalesce(sum(value) FILTER (WHERE k % 6 <> 0), 0) AS loose FROM ev GROUP BY 1, 2""")
oracle("agg_weighted_sum", "ev", """
    SELECT pId || '-' || (event_id % 3) AS domain_set,
           count(*) FILTER (WHERE k % 17 = 0) AS n_missing,
           CASE WHEN bool_and(k % 17 <> 0) THEN sum((value - 50) / 10 * CAST(p AS DOUBLE)) END
             AS sum_physical,
           CASE WHEN bool_and(k % 17 <> 0) THEN sum((value - 50) / 10 * CAST(m AS DOUBLE)) END
             AS sum_mental
    FROM ev JOIN (VALUES (0, 0.872, -0.015), (1, -0.094, -0.154), (2, 0.113, 0.252),
                         (3, -0.009, -0.351), (4, 0.003, -0.257), (5, 0.002, -0.139)
                 ) AS w(i, p, m) ON k % 6 = i GROUP BY 1""")
oracle("agg_category", "", """
    SELECT c_mktsegment, n_name, count(*) AS n,
           count(*) / CAST(sum(count(*)) OVER (PARTITION BY c_mktsegment) AS DOUBLE) AS p
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
oracle("win_missing", "ev", """
    SELECT pId, n_na, count(*) AS n_rows,
           sum(CASE WHEN n_na <= 1 AND k % 50 <> 0 THEN value END) AS kept
    FROM (SELECT *, count(*) FILTER (WHERE k % 50 = 0) OVER (PARTITION BY pId) AS n_na
          FROM ev) x GROUP BY 1, 2""")
oracle("win_midrank", "ev", """
    SELECT event_type AS variable, value, count(*) AS n, avg(place) AS rank
    FROM (SELECT event_type, value,
                 row_number() OVER (PARTITION BY event_type ORDER BY value) AS place FROM ev) x
    GROUP BY 1, 2""")
oracle("set_union_distinct", "names", "SELECT * FROM names")
oracle("set_append", "ev", "SELECT pId, count(*) AS n_rows, " + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{k}') AS n_{k}" for k in _KINDS
) + " FROM ev WHERE event_type IS NOT NULL GROUP BY 1")

# ---- study plans -----------------------------------------------------------------------

oracle("stu_windows", "phases", """
    SELECT a.pId, a.startDate AS phase1_start_date, a.endDate - 1 AS phase1_end_date,
           b.startDate AS phase2_start_date, b.endDate - 1 AS phase2_end_date
    FROM phases a JOIN phases b ON a.pId = b.pId
    WHERE a.phaseId = 'PHASE_1' AND b.phaseId = 'PHASE_2'""")
oracle("stu_calendar", "calendar", "SELECT * FROM calendar")
oracle("stu_surveys", "surveys", "SELECT * FROM surveys")
oracle("stu_devices", "", """
    SELECT 'D' || o_orderkey AS device_id, 'p' || c_custkey AS pid, c_custkey AS label,
           '2024-01-01 00:00:00' AS start_date, '2024-01-28 23:59:59' AS end_date, '' AS platform
    FROM orders JOIN customer ON c_custkey = o_custkey""")
oracle("stu_survey_days", "compliance_days", "SELECT * FROM compliance_days")
oracle("stu_survey_compliance", "compliance", "SELECT * FROM compliance")
oracle("stu_goodness", "goodness", "SELECT * FROM goodness")
oracle("stu_selected", "prefs names", """
    SELECT p.*, activity_name, CASE WHEN c_custkey IS NOT NULL THEN DATE '1995-01-01' END
             AS phase1_start_date,
           CASE WHEN c_custkey IS NOT NULL THEN DATE '1998-04-30' END AS phase1_end_date
    FROM (SELECT DISTINCT pId, activityId FROM prefs WHERE phase = 1) p
    LEFT JOIN names ON names.activityId = p.activityId
    LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = p.pId""")
for _name in ("selection", "endorsed", "planned", "completed", "endorsement", "completion",
              "engagement", "planned_completed", "demographics", "device_avg",
              "device_compliance"):
    oracle(f"stu_{_name}", _name, f"SELECT * FROM {_name}")
oracle("stu_outcomes", "scores", "SELECT * FROM scores")
oracle("stu_promis", "promis", "SELECT * FROM promis")
oracle("stu_device_features", "device_days", "SELECT * FROM device_days")

# ---- statistics ------------------------------------------------------------------------

fragment("pairs", "goodness device_avg", """
    SELECT 'goodness_score_mean' AS outcome, b.goodness_score_mean AS x, a.goodness_score_mean AS y
    FROM goodness a JOIN goodness b USING (record_id) WHERE a.study_phase = 1 AND b.study_phase = 2
    UNION ALL
    SELECT 'goodness_score_n', b.goodness_score_n, a.goodness_score_n
    FROM goodness a JOIN goodness b USING (record_id) WHERE a.study_phase = 1 AND b.study_phase = 2
    UNION ALL
    SELECT 'sumsteps_mean', b.sumsteps_mean, a.sumsteps_mean
    FROM device_avg a JOIN device_avg b USING (record_id) WHERE a.phase = '1' AND b.phase = '2'""")
fragment("paired", "pairs", f"""
    SELECT *, {_t_p("t", "df")} AS p_value, mean_difference - {_t_975("df")} * stderr AS conf_int1,
           mean_difference + {_t_975("df")} * stderr AS conf_int2, {_SIZE} AS effect_size_magnitude,
           d AS effect_size_cohensd
    FROM (SELECT *, mean_difference / stderr AS t, mean_difference / s AS d FROM
           (SELECT outcome, outcome || '_phase2' AS data_x, outcome || '_phase1' AS data_y,
                   'Paired t-test' AS method, 'two.sided' AS alternative, 0 AS null_value,
                   count(*) AS n, {_stats("x", "data_x", "mean sd min max")},
                   {_stats("y", "data_y", "mean sd min max")}, avg(x - y) AS mean_difference,
                   stddev_samp(x - y) AS s, stddev_samp(x - y) / sqrt(count(*)) AS stderr,
                   CAST(count(*) - 1 AS DOUBLE) AS df
            FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY outcome) q) r""")
oracle("st_paired_t", "paired", "SELECT * FROM paired")
oracle("st_cohens_d", "paired", "SELECT * FROM paired")
oracle("st_inputs", "promis", "SELECT *, timepoint_number AS timepoint FROM promis")

_OUTCOMES = ("cesd_score", "peat_score", "sip_score", "promis_summary_physical_health_t",
             "promis_summary_mental_health_t")
fragment("long", "promis", " UNION ALL ".join(
    f"SELECT record_id, timepoint_number AS t, '{o}' AS outcome, {o} AS y FROM promis"
    for o in _OUTCOMES
))
fragment("complete", "long", """
    SELECT * FROM long WHERE y IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY outcome, record_id) = 3""")
fragment("profile", "complete", """
    SELECT outcome, record_id, max(y) FILTER (WHERE t = 1) AS y1,
           max(y) FILTER (WHERE t = 2) AS y2, max(y) FILTER (WHERE t = 3) AS y3
    FROM complete GROUP BY 1, 2""")
fragment("anova", "complete profile", f"""
    SELECT s.*, v.* EXCLUDE (outcome), 2.0 AS anova_DFn, 2.0 * (n - 1) AS anova_DFd,
           ss_time / (ss_error / (n - 1)) AS anova_F,
           ss_time / (ss_time + ss_subject + ss_error) AS anova_ges,
           pow(1 + ss_time / (ss_error / (n - 1)) / (n - 1), -(n - 1)) AS anova_p
    FROM (SELECT outcome, sum((mt - g) * (mt - g)) AS ss_time,
                 sum((ms - g) * (ms - g)) AS ss_subject,
                 sum((y - mt - ms + g) * (y - mt - ms + g)) AS ss_error
          FROM (SELECT *, avg(y) OVER (PARTITION BY outcome) AS g,
                       avg(y) OVER (PARTITION BY outcome, t) AS mt,
                       avg(y) OVER (PARTITION BY outcome, record_id) AS ms FROM complete) x
          GROUP BY 1) s
    JOIN (SELECT outcome, CAST(count(*) AS DOUBLE) AS n,
                 {", ".join(_stats(f"y{t}", f"y{t}", "mean sd min max") for t in (1, 2, 3))},
                 var_samp((y1 - y2) / sqrt(2)) AS t11,
                 var_samp((y1 + y2 - 2 * y3) / sqrt(6)) AS t22,
                 covar_samp((y1 - y2) / sqrt(2), (y1 + y2 - 2 * y3) / sqrt(6)) AS t12
          FROM profile GROUP BY 1) v USING (outcome)""")
fragment("corrected", "anova", """
    SELECT *, least(gg, 1) * anova_DFn AS gg1, least(gg, 1) * anova_DFd AS gg2,
           least(hf, 1) * anova_DFn AS hf1, least(hf, 1) * anova_DFd AS hf2,
           pow(w, (n - 1) * (1 - 12.0 / (12 * (n - 1))) / 2) AS sphericity_p
    FROM (SELECT *, (n * 2 * gg - 2) / (2 * (n - 1 - 2 * gg)) AS hf FROM
           (SELECT *, (t11 * t22 - t12 * t12) / pow((t11 + t22) / 2, 2) AS w,
                   pow(t11 + t22, 2) / (2 * (t11 * t11 + t22 * t22 + 2 * t12 * t12)) AS gg
            FROM anova) x) y""")
oracle("st_rm_anova", "anova", "SELECT *, " + ", ".join(
    f"y{t}_{s} AS {s}_{t}" for t in (1, 2, 3) for s in ("mean", "sd", "min", "max")
) + " FROM anova WHERE outcome NOT LIKE 'promis%'")
oracle("st_sphericity", "corrected", f"""
    SELECT outcome, n, w AS sphericity_W, sphericity_p, gg AS correction_GGe,
           gg1 AS correction_DFn_GG, gg2 AS correction_DFd_GG,
           {_f_p("anova_F", "gg1", "gg2")} AS correction_p_GG, hf AS correction_HFe,
           hf1 AS correction_DFn_HF, hf2 AS correction_DFd_HF,
           {_f_p("anova_F", "hf1", "hf2")} AS correction_p_HF
    FROM corrected WHERE outcome NOT LIKE 'promis%'""")
fragment("pairwise", "profile", f"""
    SELECT *, {_t_p("t", "df")} AS p, {_SIZE} AS size FROM
      (SELECT *, m / s AS d, m / (s / sqrt(n)) AS t, s / sqrt(n) AS se,
              CAST(n - 1 AS DOUBLE) AS df FROM
        (SELECT outcome, g1, g2, count(*) AS n, avg(e) AS m, stddev_samp(e) AS s FROM
          (SELECT outcome, '1' AS g1, '2' AS g2, y2 - y1 AS e FROM profile
           UNION ALL SELECT outcome, '1', '3', y3 - y1 FROM profile
           UNION ALL SELECT outcome, '2', '3', y3 - y2 FROM profile) a
         GROUP BY 1, 2, 3) b) c""")
oracle("st_pairwise", "pairwise", f"""
    SELECT outcome, g1 AS ttest_group1, g2 AS ttest_group2, 'none' AS p_adj_method,
           size AS effect_size_magnitude, n, m AS ttest_estimate, t AS ttest_statistic,
           df AS ttest_df, p AS ttest_p, m - {_t_975("df")} * se AS ttest_conf_low,
           m + {_t_975("df")} * se AS ttest_conf_high, p AS ttest_p_adj, d AS effect_size_cohensd
    FROM pairwise WHERE outcome NOT LIKE 'promis%'""")
# With three tests the adjusted values can be written out over the ordered p-values a, b, c.
_ADJUSTED = {
    "none": "p",
    "bonferroni": "least(3 * p, 1)",
    "holm": "least(1, CASE i WHEN 1 THEN 3 * a WHEN 2 THEN greatest(3 * a, 2 * b) "
            "ELSE greatest(3 * a, 2 * b, c) END)",
    "hochberg": "CASE i WHEN 1 THEN least(3 * a, 2 * b, c) WHEN 2 THEN least(2 * b, c) ELSE c END",
    "BH": "CASE i WHEN 1 THEN least(3 * a, 1.5 * b, c) WHEN 2 THEN least(1.5 * b, c) ELSE c END",
    "BY": "least(1, (11.0 / 6) * CASE i WHEN 1 THEN least(3 * a, 1.5 * b, c) "
          "WHEN 2 THEN least(1.5 * b, c) ELSE c END)",
}
oracle("st_adjusted", "pairwise", " UNION ALL ".join(
    f"""SELECT outcome, '{m}' AS method, g1 AS ttest_group1, g2 AS ttest_group2,
        {sql} AS ttest_p_adj FROM
        (SELECT *, min(p) OVER o AS a, median(p) OVER o AS b, max(p) OVER o AS c,
                row_number() OVER (PARTITION BY outcome ORDER BY p) AS i
         FROM pairwise WHERE outcome NOT LIKE 'promis%'
         WINDOW o AS (PARTITION BY outcome)) x""" for m, sql in _ADJUSTED.items()
))


def _rank_sum(source: str, variable: str, group: str, first: str, second: str) -> str:
    """Rank-sum test by ranking every row."""
    ranked = f"""SELECT '{variable}' AS variable, w, n1, n - n1 AS n2,
        (w - n1 * (n - n1) / 2 - sign(w - n1 * (n - n1) / 2) * 0.5)
          / sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1)))) AS z
        FROM (SELECT sum(r) FILTER (WHERE g) - n1 * (n1 + 1) / 2 AS w, n1, n, ties FROM
               (SELECT (side = '{first}') AS g,
                       rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS r,
                       CAST(count(*) OVER () AS DOUBLE) AS n,
                       CAST(count(*) FILTER (WHERE side = '{first}') OVER () AS DOUBLE) AS n1
                FROM (SELECT {group} AS side, CAST({variable} AS DOUBLE) AS x FROM {source}
                      WHERE {variable} IS NOT NULL AND {group} IN ('{first}', '{second}')) q) a
             CROSS JOIN (SELECT coalesce(sum(CAST(c AS DOUBLE) * c * c - c), 0) AS ties FROM
                 (SELECT count(*) AS c FROM {source} WHERE {variable} IS NOT NULL
                    AND {group} IN ('{first}', '{second}') GROUP BY {variable}) t) b
             GROUP BY n1, n, ties) y"""
    return f"SELECT *, {_chi2_p('z * z', '1.0')} AS p FROM ({ranked}) s"


def _chi_square(source: str, variable: str, group: str) -> str:
    """Chi-square over the full cross of levels and groups."""
    rows = f"SELECT {variable} AS l, {group} AS g, count(*) AS o FROM {source} WHERE {variable} " \
           f"IS NOT NULL AND {group} IS NOT NULL GROUP BY 1, 2"
    return f"""SELECT *, {_chi2_p("statistic", "df")} AS p FROM
        (SELECT '{variable}' AS variable, sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e)
                  AS statistic, min(e) AS min_expected,
                CAST((count(DISTINCT l) - 1) * (count(DISTINCT g) - 1) AS DOUBLE) AS df
         FROM (SELECT a.l, b.g, a.n * b.n / CAST(sum(b.n) OVER (PARTITION BY a.l) AS DOUBLE) AS e
               FROM (SELECT l, sum(o) AS n FROM ({rows}) r GROUP BY 1) a
               CROSS JOIN (SELECT g, sum(o) AS n FROM ({rows}) r GROUP BY 1) b) c
         LEFT JOIN ({rows}) d USING (l, g)) e"""


_CUSTOMER_RANKS = " UNION ALL ".join(
    f"({_rank_sum('sides', v, 'side', 'low', 'high')})" for v in ("c_acctbal", "n_code")
)
_CUSTOMER_CHI = " UNION ALL ".join(
    f"({_chi_square('sides', v, 'side')})" for v in ("c_mktsegment", "overdrawn")
)
oracle("st_ranksum", "sides", f"""
    SELECT variable, 'Wilcoxon rank sum test, normal approximation' AS method, n1, n2,
           w AS statistic, p AS p_value FROM ({_CUSTOMER_RANKS}) t""")
fragment("exact_groups", "", """
    SELECT c_custkey % 29 AS place, floor(sum(c_acctbal) / 10000) AS thousands,
           count(*) FILTER (WHERE c_acctbal < 0) AS overdrawn FROM customer GROUP BY 1""")
fragment("exact_ranks", "exact_groups", """
    SELECT variable, place < 7 AS low,
           2 * rank() OVER (PARTITION BY variable ORDER BY value)
             + count(*) OVER (PARTITION BY variable, value) - 1 AS r2,
           row_number() OVER (PARTITION BY variable ORDER BY value, place) AS i
    FROM (SELECT 'thousands' AS variable, place, thousands AS value FROM exact_groups
          UNION ALL SELECT 'overdrawn', place, overdrawn FROM exact_groups) x""")
# Row by row, each is chosen or not: how often every number of rows and sum comes about.
_CHOICES = """WITH RECURSIVE deal AS (
    SELECT DISTINCT variable, 0::BIGINT AS i, 0 AS j, 0::BIGINT AS s, 1::HUGEINT AS ways FROM exact_ranks
    UNION ALL SELECT variable, i, j, s, sum(ways)::HUGEINT FROM
      (SELECT d.variable, d.i + 1 AS i, d.j + t.take AS j, d.s + t.take * r.r2 AS s, ways
       FROM deal d JOIN exact_ranks r ON r.variable = d.variable AND r.i = d.i + 1
       CROSS JOIN (VALUES (0), (1)) AS t(take) WHERE d.j + t.take <= 7) x GROUP BY ALL)
  SELECT * FROM deal WHERE i = 29 AND j = 7"""
oracle("st_ranksum_exact", "exact_ranks", f"""
    SELECT w.variable, 'Wilcoxon rank sum test, exact' AS method, 7 AS n1, 22 AS n2,
           any_value(w.s) / 2.0 - 28 AS statistic,
           sum(ways) FILTER (WHERE abs(c.s - 210) >= abs(w.s - 210))::DOUBLE / sum(ways)::DOUBLE AS p_value
    FROM (SELECT variable, sum(r2) FILTER (WHERE low) AS s FROM exact_ranks GROUP BY 1) w
    JOIN ({_CHOICES}) c USING (variable) GROUP BY 1""")
oracle("st_chisq", "sides", f"SELECT *, p AS p_value FROM ({_CUSTOMER_CHI}) t")
fragment("two_by_two", "sides", """
    SELECT *, lgamma(r1 + 1) + lgamma(n - r1 + 1) + lgamma(c1 + 1) + lgamma(n - c1 + 1)
              - lgamma(n + 1) AS margin
    FROM (SELECT count(*) FILTER (WHERE overdrawn = 'Yes' AND side = 'low') AS a,
                 count(*) FILTER (WHERE overdrawn = 'Yes') AS r1,
                 count(*) FILTER (WHERE side = 'low') AS c1, count(*) AS n FROM sides) x""")
_HYPER = """exp(margin - lgamma(v + 1) - lgamma(r1 - v + 1) - lgamma(c1 - v + 1)
    - lgamma(n - r1 - c1 + v + 1))"""
oracle("st_fisher", "two_by_two", f"""
    SELECT 'overdrawn' AS variable, any_value(least(r1, n - r1, c1)) + 1 AS n_tables,
           sum(prob) FILTER (WHERE prob <= seen * (1 + 1e-7)) AS p_value
    FROM (SELECT *, {_HYPER} AS prob, {_HYPER.replace("v", "a")} AS seen
          FROM (SELECT *, unnest(range(greatest(0, r1 + c1 - n), least(r1, c1) + 1)) AS v
                FROM two_by_two) y) x""")
# All tables with the margins of four levels, the one of the rest being what is left.
fragment("bands", "sides", """
    SELECT count(*) FILTER (WHERE band = 'lowest') AS r1, count(*) FILTER (WHERE band = 'highest') AS r2,
           count(*) FILTER (WHERE band = 'nothing') AS r3, count(*) FILTER (WHERE band = 'other') AS r4,
           count(*) FILTER (WHERE band = 'lowest' AND side = 'low') AS a1,
           count(*) FILTER (WHERE band = 'highest' AND side = 'low') AS a2,
           count(*) FILTER (WHERE band = 'nothing' AND side = 'low') AS a3,
           count(*) FILTER (WHERE side = 'low') AS c1, count(*) AS n FROM sides""")
_CHOOSE = "(lgamma({n} + 1) - lgamma({x} + 1) - lgamma({n} - {x} + 1))"


def _ways(x: str) -> str:
    parts = [_CHOOSE.format(n=f"r{i}", x=f"{x}{i}") for i in (1, 2, 3)]
    parts.append(_CHOOSE.format(n="r4", x=f"(c1 - {x}1 - {x}2 - {x}3)"))
    return f"exp({' + '.join(parts)} - {_CHOOSE.format(n='n', x='c1')})"


fragment("band_test", "bands", f"""
    SELECT any_value((least(r1, c1) + 1) * (least(r2, c1) + 1) * (least(r3, c1) + 1)) AS n_tables,
           sum(prob) FILTER (WHERE prob <= seen * (1 + 1e-7)) AS p_value
    FROM (SELECT *, {_ways("x")} AS prob, {_ways("a")} AS seen
          FROM (SELECT *, unnest(range(0, r3 + 1)) AS x3 FROM
                (SELECT *, unnest(range(0, r2 + 1)) AS x2 FROM
                 (SELECT *, unnest(range(0, r1 + 1)) AS x1 FROM bands) p) q) r
          WHERE x1 + x2 + x3 <= c1 AND c1 - x1 - x2 - x3 <= r4) s""")
oracle("st_fisher_levels", "band_test", "SELECT 'band' AS variable, n_tables, p_value FROM band_test")
oracle("st_category", "sides band_test", f"""
    SELECT variable, 'Pearson''s Chi-squared test' AS method, p AS p_value
    FROM ({_CUSTOMER_CHI}) t WHERE min_expected >= 5
    UNION ALL SELECT 'band', 'Fisher''s exact test', p_value FROM band_test""")

# ---- tables ----------------------------------------------------------------------------


class Summary:
    """A descriptive table as a union of one SELECT per row."""

    def __init__(self, source: str, strata: dict[str, str] | None = None, missing: bool = True):
        self.source, self.missing = source, missing
        self.strata = strata or {"0": "true"}
        self.rows: list[str] = []
        self.place = 0

    def _add(self, name: str, kind: str, label: str, order: float, cells: str, having: str = ""):
        self.rows.append(
            f"SELECT '{name}' AS variable, '{kind}' AS row_type, '{label}' AS label, "
            f"{order} AS row_order, {cells} FROM {self.source}{having}"
        )

    def _cells(self, n: str, stat: str) -> str:
        """``{c}`` is the condition of the stratum."""
        return ", ".join(
            f"{n.replace('{c}', c)} AS n_{i}, {stat.replace('{c}', c)} AS stat_{i}"
            for i, c in self.strata.items()
        )

    def _unknown(self, name: str, absent: str, at: float, indent: str) -> None:
        if self.missing:
            count = f"count(*) FILTER (WHERE {absent} AND ({{c}}))"
            anywhere = " OR ".join(f"({c})" for c in self.strata.values())
            self._add(name, "missing", indent + "Unknown", at + 999, self._cells(count, _fixed(count, 0)),
                      f" HAVING count(*) FILTER (WHERE {absent} AND ({anywhere})) > 0")

    def continuous(self, name: str, label: str, digits=(1, 1, 0, 0), indent="") -> Summary:
        self.place += 1
        at = self.place * 1000
        cells = self._cells(f'count("{name}") FILTER (WHERE {{c}})',
                            _four(f'"{name}"', digits, "{c}"))
        self._add(name, "label", indent + label, at, cells)
        self._unknown(name, f'"{name}" IS NULL', at, indent)
        return self

    def categorical(self, name: str, label: str, levels, indent="") -> Summary:
        self.place += 1
        at = self.place * 1000
        known = f'"{name}" IN (' + ", ".join(f"'{_q(lv)}'" for lv in levels) + ")"
        total = f"count(*) FILTER (WHERE {known} AND ({{c}}))"
        self._add(name, "label", indent + label, at, self._cells(total, "NULL"))
        for j, level in enumerate(levels):
            n = f"count(*) FILTER (WHERE \"{name}\" = '{_q(level)}' AND ({{c}}))"
            share = _percent(f"{n} / CAST({total} AS DOUBLE)")
            stat = f"{_fixed(n, 0)} || ' (' || coalesce({share}, 'NA') || '%)'"
            self._add(name, "level", indent + _q(level), at + j + 1, self._cells(n, stat))
        self._unknown(name, f"NOT coalesce({known}, false)", at, indent)
        return self

    def header(self, key: str, label: str, order: float) -> Summary:
        cells = ", ".join(f"NULL AS n_{i}, NULL AS stat_{i}" for i in self.strata)
        self.rows.append(
            f"SELECT '{key}' AS variable, 'header' AS row_type, '{label}' AS label, "
            f"{order} AS row_order, {cells}"
        )
        return self

    def sql(self) -> str:
        return " UNION ALL ".join(f"({r})" for r in self.rows)


def _q(text: str) -> str:
    return text.replace("'", "''")


fragment("ev3", "ev", "SELECT event_type, value, CASE WHEN k > 2 THEN k END AS k FROM ev")
oracle("tab_summary", "ev3", Summary("ev3").continuous("value", "Value").continuous("k", "Number")
       .categorical("event_type", "Kind", ("click", "view", "purchase")).sql())
oracle("tab_summary_by", "sides", Summary("sides", {"1": "side = 'low'", "2": "side = 'high'"})
       .continuous("c_acctbal", "Balance", (2, 2, 1, 1))
       .categorical("c_mktsegment", "Segment", ("BUILDING", "MACHINERY")).sql())

_RATES = list(codebook.SURVEY_RATE_LABELS.items())
fragment("rates", "compliance", "SELECT " + ", ".join(f"100 * {r} AS {r}" for r, _ in _RATES)
         + " FROM compliance")
_SURVEY_TABLE = Summary("rates")
for _rate, _label in _RATES:
    _SURVEY_TABLE.continuous(_rate, _label, (2, 2, 2, 2), "\t")
_SURVEY_TABLE.header("rate_expected", "Percent of expected surveys completed", 999.5)
_SURVEY_TABLE.header("rate_days", "Percent of days with completed survey(s)", 3999.5)
oracle("tab_survey_compliance", "rates", _SURVEY_TABLE.sql())

_WEAR = "percent_days_with_sufficient_data"
fragment("wear", "device_compliance", f"""
    SELECT max({_WEAR}) FILTER (WHERE phase = 'overall') AS "{_WEAR}_Overall",
           max({_WEAR}) FILTER (WHERE phase = '1') AS "{_WEAR}_Phase 1",
           max({_WEAR}) FILTER (WHERE phase = '2') AS "{_WEAR}_Phase 2"
    FROM device_compliance GROUP BY record_id""")
_WEAR_TABLE = Summary("wear")
for _label in ("Overall", "Phase 1", "Phase 2"):
    _WEAR_TABLE.continuous(f"{_WEAR}_{_label}", _label, (2, 2, 2, 2), "\t")
_WEAR_TABLE.header(_WEAR, "Percent of days with sufficient Fitbit data", 999.5)
oracle("tab_device_compliance", "wear", _WEAR_TABLE.sql())
oracle("tab_compliance", "rates wear", f"""
    SELECT * FROM ({_SURVEY_TABLE.sql()}) a UNION ALL
    SELECT * REPLACE (row_order + 1000000 AS row_order) FROM ({_WEAR_TABLE.sql()}) b""")

fragment("feedback0", "", "SELECT " + ", ".join(
    f"CASE WHEN c_custkey % 17 <> {i} THEN (c_custkey * {i + 3} + {i}) % 11 END AS {n}"
    for i, n in enumerate(codebook.PHASE0_FEEDBACK_LABELS)
) + " FROM customer")
_FEEDBACK0 = Summary("feedback0")
for _n, _label in codebook.PHASE0_FEEDBACK_LABELS.items():
    _FEEDBACK0.continuous(_n, _q(_label))
oracle("tab_feedback0", "feedback0", _FEEDBACK0.sql())

_RATED = [n for n in codebook.PHASE1_FEEDBACK_LABELS if n not in
          ("sus_score_eos", "data_sharing_others_score")]
fragment("feedback1", "", "SELECT c_custkey % 41 * 2.5 AS sus_score_eos, "
         "CASE WHEN c_custkey % 13 <> 0 THEN CASE c_custkey % 2 WHEN 1 THEN 'Yes' ELSE 'No' END "
         "END AS data_sharing_others_score, " + ", ".join(
    f"CASE WHEN c_custkey % 19 <> {i} THEN (c_custkey * {i + 2} + {i}) % 11 END AS {n}"
    for i, n in enumerate(_RATED)
) + " FROM customer")
_FEEDBACK1 = Summary("feedback1")
for _n, _label in codebook.PHASE1_FEEDBACK_LABELS.items():
    if _n == "data_sharing_others_score":
        _FEEDBACK1.categorical(_n, _label, ("Yes", "No"))
    else:
        _FEEDBACK1.continuous(_n, _label, indent="" if _n == "sus_score_eos" else "\t")
for (_key, _label), _at in zip(codebook.PHASE1_FEEDBACK_HEADERS, (1999.5, 3999.5, 9999.5)):
    _FEEDBACK1.header(_key, _label, _at)
oracle("tab_feedback1", "feedback1", _FEEDBACK1.sql())

# Shares of nothing are missing, and every rate and share is in percent.
fragment("engaged", "engagement", """
    SELECT * REPLACE (100 * phase1_endorsed_activity_rating_rate_mean
                        AS phase1_endorsed_activity_rating_rate_mean,
                      100 * phase2_planned_activity_completion_rate_mean
                        AS phase2_planned_activity_completion_rate_mean),
           100.0 * selected_phase1_custom / nullif(selected_phase1_all, 0)
             AS selected_phase1_custom_prop,
           100.0 * selected_phase2_custom / nullif(selected_phase2_all, 0)
             AS selected_phase2_custom_prop,
           100.0 * selected_phase2_not_phase1_all / nullif(selected_phase2_all, 0)
             AS selected_phase2_not_phase1_all_prop
    FROM engagement""")
_ENGAGED = Summary("engaged", missing=False)
_ENGAGED_AT = {}
for _n, _label in codebook.ENGAGEMENT_LABELS.items():
    _digits = (1, 1, 1, 1) if "mean" in _n else (1, 1, 0, 0)
    _ENGAGED.continuous(_n, _label, _digits, "\t\t")
    _ENGAGED_AT[_n] = _ENGAGED.place * 1000
for _n, _labels in codebook.ENGAGEMENT_HEADERS:
    for _j, _label in enumerate(_labels):
        _ENGAGED.header(_n, _label, _ENGAGED_AT[_n] - 0.5 + _j / 10)
oracle("tab_engagement", "engaged", _ENGAGED.sql())

_SPANS = ("months_since_diagnosed_at_demo_datetime", "months_since_diagnosed_stage4_at_demo_datetime",
          "days_since_treatment_at_demo_datetime", "dhls_score")
_LISTED = ("gender", "race", "marital", "living", "employment", "education",
           "cancer_category_participant", "cancer_status")
_TREATMENTS = list(codebook.MULTIPLE_CHOICE["cancer_treatment"].values())
fragment("described", "demographics", f"""
    SELECT *, CASE cohort WHEN 'phase0' THEN 'Phase 0' ELSE 'Phase 1' END AS side,
           {_case("race_combined", {x: x for x in codebook.LEVELS["race"]}, "NULL")} AS race,
           upper(substr(said, 1, 1)) || lower(substr(said, 2)) AS living
    FROM (SELECT *, CASE WHEN living_combined LIKE '%Partner%'
                           OR living_combined LIKE '%Children%'
                    THEN 'With ' || living_combined ELSE living_combined END AS said
          FROM demographics) x""")
fragment("closed", "described", "SELECT * REPLACE (" + ", ".join(
    f"{_case(n, {x: x for x in codebook.LEVELS[n]}, 'NULL')} AS {n}" for n in _LISTED
) + ") FROM described")
_PEOPLE = Summary("closed", {"1": "side = 'Phase 0'", "2": "side = 'Phase 1'"})
_PEOPLE.continuous("age", codebook.CHARACTERISTIC_LABELS["age"])
for _n in _LISTED:
    _PEOPLE.categorical(_n, codebook.CHARACTERISTIC_LABELS[_n], codebook.LEVELS[_n])
_PEOPLE.header("cancer_treatment", "Cancer treatment", (_PEOPLE.place + 1) * 1000 - 0.5)
for _n in _TREATMENTS:
    _PEOPLE.categorical(f"cancer_treatment_{_n}", _n, ("Yes", "No"), "\t")
for _n in _SPANS:
    _PEOPLE.continuous(_n, codebook.CHARACTERISTIC_LABELS[_n])
_PEOPLE_P = " UNION ALL ".join(
    [f"(SELECT variable, p FROM ({_rank_sum('closed', n, 'side', 'Phase 0', 'Phase 1')}) t)"
     for n in ("age", *_SPANS)]
    + [f"(SELECT variable, p FROM ({_chi_square('closed', n, 'side')}) t)" for n in _LISTED]
    + [f"(SELECT 'cancer_treatment_{n}' AS variable, p FROM "
       f"({_chi_square('treated', 't_' + str(i), 'side')}) t)" for i, n in enumerate(_TREATMENTS)]
)
fragment("treated", "closed", "SELECT side, " + ", ".join(
    f'"cancer_treatment_{n}" AS t_{i}' for i, n in enumerate(_TREATMENTS)
) + " FROM closed")
# Chi-square throughout: from sf0.01 up every expected count is 5 or more.
oracle("tab_characteristics", "closed treated", f"""
    SELECT t.*, CASE WHEN row_type = 'label' THEN p END AS p_value
    FROM ({_PEOPLE.sql()}) t LEFT JOIN ({_PEOPLE_P}) q ON q.variable = t.variable""")


def _shown_p(p: str) -> str:
    return _P_TEXT.replace("{p}", p)


oracle("tab_ttest", "paired", f"""
    SELECT CASE outcome WHEN 'goodness_score_mean' THEN 'Goodness score, mean'
             WHEN 'goodness_score_n' THEN 'Goodness score, n' ELSE 'Step count, mean' END
             AS outcome_str, n,
           'Phase 1' AS data_y_label, round(data_y_mean, 2) AS data_y_mean,
           round(data_y_sd, 2) AS data_y_sd,
           {_plain("data_y_min")} || ', ' || {_plain("data_y_max")} AS data_y_range,
           'Phase 2' AS data_x_label, round(data_x_mean, 2) AS data_x_mean,
           round(data_x_sd, 2) AS data_x_sd,
           {_plain("data_x_min")} || ', ' || {_plain("data_x_max")} AS data_x_range,
           round(mean_difference, 2) AS mean_difference, round(t, 2) AS t, df,
           {_shown_p("p_value")} AS p_str, round(d, 2) AS effect_size_cohensd,
           CASE WHEN p_value < 0.05 THEN 1 ELSE 0 END AS significant
    FROM paired""")

_PAIRS3 = (("1", "2"), ("1", "3"), ("2", "3"))
_MEASURES = {
    "estimate": _plain("m"), "df": _plain("df"), "statistic": _plain("t"), "p_str": _shown_p("p"),
    "cohensd": _plain("d"),
}
fragment("pair_texts", "pairwise", "SELECT outcome, " + ", ".join(
    f"max({sql}) FILTER (WHERE g1 = '{a}' AND g2 = '{b}') AS ttest_{m}_t{a}_to_t{b}"
    for m, sql in _MEASURES.items() for a, b in _PAIRS3
) + " FROM pairwise GROUP BY 1")
_ANOVA_TEXT = ", ".join(
    [f"{_plain(f'y{t}_mean')} || ' (' || {_plain(f'y{t}_sd')} || ') [' || {_plain(f'y{t}_min')} "
     f"|| ', ' || {_plain(f'y{t}_max')} || ']' AS summarystat_t{t}" for t in (1, 2, 3)]
    + [f"{_plain('CASE WHEN low THEN gg1 ELSE anova_DFn END')} || ', ' || "
       f"{_plain('CASE WHEN low THEN gg2 ELSE anova_DFd END')} AS anova_df",
       f"{_plain('anova_F')} AS anova_f", f"{_shown_p('p')} AS anova_p_str",
       "CASE WHEN anova_ges < 0.0005 THEN '<0.001' ELSE CAST(round(anova_ges, 3) AS VARCHAR) END "
       "AS anova_ges"]
)
_ANOVA_BLANK = ", ".join(
    f"'' AS {c}" for c in QUERIES["tab_anova"].shape.text.split() if c != "outcome_name"
)
oracle("tab_anova", "corrected pair_texts", f"""
    SELECT outcome_name, row_order, n, CAST(low AS INTEGER) AS anova_correction_applied,
           CAST(p < 0.05 AS INTEGER) AS anova_significant, {_ANOVA_TEXT},
           t.* EXCLUDE (outcome)
    FROM (SELECT *, CASE WHEN low THEN {_f_p("anova_F", "gg1", "gg2")} ELSE anova_p END AS p,
                 CASE outcome WHEN 'cesd_score' THEN 'CESD Score' WHEN 'peat_score' THEN 'PEAT Score'
                   WHEN 'sip_score' THEN 'SIP Score'
                   WHEN 'promis_summary_physical_health_t' THEN chr(9) || 'Physical health'
                   ELSE chr(9) || 'Mental health' END AS outcome_name,
                 CASE outcome WHEN 'cesd_score' THEN 0 WHEN 'peat_score' THEN 1
                   WHEN 'sip_score' THEN 2 WHEN 'promis_summary_physical_health_t' THEN 11
                   ELSE 12 END AS row_order
          FROM (SELECT *, sphericity_p < 0.05 AS low FROM corrected) x) a
    JOIN pair_texts t USING (outcome)
    UNION ALL BY NAME SELECT 'PROMIS Subscale t-score' AS outcome_name, 2.5 AS row_order,
                             {_ANOVA_BLANK}
    UNION ALL BY NAME SELECT 'PROMIS Summary t-score' AS outcome_name, 10.5 AS row_order,
                             {_ANOVA_BLANK}""")

# ---- device features -------------------------------------------------------------------

oracle("dev_yield", "grid", """
    SELECT pid, date, sum(valid) / 1440.0 AS ratiovalidyieldedminutes,
           count(*) FILTER (WHERE valid >= 2) / 24.0 AS ratiovalidyieldedhours
    FROM (SELECT pid, date, minute // 60 AS h, count(*) FILTER (WHERE heartrate > 0) AS valid
          FROM grid GROUP BY 1, 2, 3) x GROUP BY 1, 2""")
fragment("nights", "", """
    SELECT *, unnest(range(0, (start + len - 1) // 1440 + 1)) AS back FROM
      (VALUES ('night', 1320, 480), ('late', 1410, 90), ('weekend', 1080, 3000)) AS s(label, start, len)""")


def _in_segments(source: str) -> str:
    """Rows of a table of minutes in each turn of the segments, the minute counted on."""
    return f"""SELECT t.* REPLACE (t.date - CAST(back AS INTEGER) AS date, minute + 1440 * back AS minute),
             label AS local_segment_label, start, len
      FROM {source} t JOIN turns ON minute + 1440 * back >= start AND minute + 1440 * back < start + len"""


fragment("turns", "nights", """
    SELECT * FROM nights UNION ALL SELECT 'dawn', 250, 100, 0""")
oracle("dev_segment_yield", "grid turns", f"""
    SELECT pid, date, local_segment_label, sum(valid) / CAST(any_value(len) AS DOUBLE) AS ratiovalidyieldedminutes,
           count(*) FILTER (WHERE valid * 30 >= least(60, len - 60 * h)) / ceil(any_value(len) / 60.0)
             AS ratiovalidyieldedhours
    FROM (SELECT pid, date, local_segment_label, len, (minute - start) // 60 AS h,
                 count(*) FILTER (WHERE heartrate > 0) AS valid
          FROM ({_in_segments("grid")}) s GROUP BY ALL) x GROUP BY 1, 2, 3""")
oracle("dev_segments", "grid", """
    SELECT pid, date, local_segment_label, count(*) AS n, sum(steps) AS steps FROM
      (SELECT pid, date, 'daily' AS local_segment_label, steps FROM grid
       UNION ALL SELECT pid, date, 'morning', steps FROM grid WHERE minute BETWEEN 360 AND 719
       UNION ALL SELECT pid, date, 'night', steps FROM grid WHERE minute >= 1320
       UNION ALL SELECT pid, date - 1, 'night', steps FROM grid WHERE minute < 360) x
    GROUP BY 1, 2, 3""")


def _spread_of(value: str, suffix: str) -> str:
    """Distribution features of a value, straight from its rows."""
    return f"""avg({value}) AS avg{suffix}, max({value}) AS max{suffix}, min({value}) AS min{suffix},
        median({value}) AS median{suffix}, any_value(top) AS mode{suffix},
        stddev_samp({value}) AS std{suffix}, any_value(entropy) AS entropy{suffix},
        max({value}) - any_value(top) AS diffmaxmode{suffix},
        any_value(top) - min({value}) AS diffminmode{suffix}"""


def _with_mode(source: str, keys: str, value: str) -> str:
    """Rows with their group's smallest most frequent value and entropy."""
    same = " AND ".join(f"g.{k} = m.{k}" for k in keys.split(", "))
    return f"""(SELECT g.*, m.top, m.entropy FROM {source} g JOIN
        (SELECT {keys}, min({value}) FILTER (WHERE place = 1) AS top,
                -sum(c / total * ln(c / total)) AS entropy
         FROM (SELECT {keys}, {value}, CAST(count(*) AS DOUBLE) AS c,
                      CAST(sum(count(*)) OVER (PARTITION BY {keys}) AS DOUBLE) AS total,
                      row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {value})
                        AS place
               FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys}, {value}) q
         GROUP BY {keys}) m ON {same} WHERE g.{value} IS NOT NULL)"""


oracle("dev_hr", "grid", f"""
    SELECT pid, date, {_spread_of("heartrate", "hr")},
           {", ".join(f"count(*) FILTER (WHERE hr_zone = '{z}') AS minuteson{z}zone"
                      for z in _ZONES.split())}
    FROM {_with_mode("grid", "pid, date", "heartrate")} x GROUP BY 1, 2""")
fragment("resting", "grid", """
    SELECT pid, date, min(heartrate) AS restinghr FROM grid GROUP BY 1, 2""")
oracle("dev_resting_hr", "resting", f"""
    SELECT pid, {_spread_of("restinghr", "restinghr")}
    FROM {_with_mode("resting", "pid", "restinghr")} x GROUP BY 1""")
fragment("day_steps", "grid", """
    SELECT pid, date, sum(steps) AS sumsteps, max(steps) AS maxsteps, min(steps) AS minsteps,
           avg(steps) AS avgsteps, stddev_samp(steps) AS stdsteps,
           min(minute) FILTER (WHERE steps > 0) AS firststeptime,
           max(minute) FILTER (WHERE steps > 0) AS laststeptime
    FROM grid WHERE steps <= 1000 GROUP BY 1, 2""")
oracle("dev_steps", "day_steps", "SELECT * FROM day_steps")
oracle("dev_steps_summary", "day_steps", """
    SELECT pid, max(sumsteps) AS maxsumsteps, min(sumsteps) AS minsumsteps,
           avg(sumsteps) AS avgsumsteps, median(sumsteps) AS mediansumsteps,
           stddev_samp(sumsteps) AS stdsumsteps, max(abs(g)) AS maxvolatilitysteps,
           min(abs(g)) AS minvolatilitysteps, avg(abs(g)) AS avgvolatilitysteps,
           median(abs(g)) AS medianvolatilitysteps, stddev_samp(abs(g)) AS stdvolatilitysteps,
           stddev_samp(g) * sqrt(365) AS annualizedvolatilitysteps
    FROM (SELECT *, CASE WHEN sumsteps > 0 AND before > 0
                    THEN ln(CAST(sumsteps AS DOUBLE) / before) END AS g
          FROM (SELECT *, lag(sumsteps) OVER (PARTITION BY pid ORDER BY date) AS before
                FROM day_steps) x) y GROUP BY 1""")
_BOUT_ROWS = """
    SELECT pid, date, state, min(minute) AS first, count(*) AS n,
           row_number() OVER (PARTITION BY pid, date, state ORDER BY count(*)) AS place,
           lead(state) OVER (PARTITION BY pid, date ORDER BY min(minute)) AS next
    FROM (SELECT *, minute - row_number() OVER (PARTITION BY pid, date, state ORDER BY minute)
                    AS island
          FROM (SELECT *, CASE WHEN steps >= 10 THEN 'active' ELSE 'sedentary' END AS state
                FROM walked) x) y
    GROUP BY pid, date, state, island"""
fragment("bouts", "walked", _BOUT_ROWS)
fragment("night_walked", "walked nights", _in_segments("walked").replace("turns", "nights"))


def _by_segment(sql: str, **tables: str) -> str:
    """A statement on participant days turned into one on segments, with other tables in place."""
    for old, new in tables.items():
        sql = sql.replace(f"FROM {old}", f"FROM {new}")
    return sql.replace("pid, date", "pid, date, local_segment_label")


fragment("night_bouts", "night_walked", _by_segment(_BOUT_ROWS, walked="night_walked"))


def _bout_sql(state: str) -> str:
    where = f"FILTER (WHERE state = '{state}')"
    name = f"{state}bout"
    return f"""count(*) {where} AS countepisode{name}, coalesce(sum(n) {where}, 0)
        AS sumduration{name}, max(n) {where} AS maxduration{name}, min(n) {where}
        AS minduration{name}, avg(n) {where} AS avgduration{name},
        stddev_samp(n) {where} AS stdduration{name}"""


_BOUT_TABLE = f"""
    SELECT pid, date, {_bout_sql("sedentary")}, {_bout_sql("active")},
           count(*) FILTER (WHERE state = 'active' AND next = 'sedentary')
             / CAST(sum(n) FILTER (WHERE state = 'active') AS DOUBLE)
             AS activetosedentarytransitionprobability,
           coalesce(sum(n) FILTER (WHERE state = 'active' AND n < 5), 0)
             AS sumdurationactivitylessthan5minutes,
           coalesce(sum(n) FILTER (WHERE state = 'active' AND n BETWEEN 5 AND 10), 0)
             AS sumdurationactivity5to10minutes,
           coalesce(sum(n) FILTER (WHERE state = 'active' AND n > 10), 0)
             AS sumdurationactivitygreaterthan10minutes,
           sum((2 * place - many - 1) * n) FILTER (WHERE state = 'active')
             / CAST(any_value(many) FILTER (WHERE state = 'active')
                    * sum(n) FILTER (WHERE state = 'active') AS DOUBLE) AS ginicoefficient
    FROM (SELECT *, count(*) OVER (PARTITION BY pid, date, state) AS many FROM bouts) x
    GROUP BY pid, date"""
oracle("dev_bouts", "bouts", _BOUT_TABLE)
oracle("dev_segment_bouts", "night_bouts", _by_segment(_BOUT_TABLE, bouts="night_bouts"))


def _best(k: int) -> str:
    return f"sum(steps) OVER (PARTITION BY pid, date ORDER BY minute " \
           f"RANGE BETWEEN {k - 1} PRECEDING AND CURRENT ROW) / {k}.0 AS m{k}"


_IN_BANDS = {
    "0": "steps = 0", "1to19": "steps BETWEEN 1 AND 19", "20to39": "steps BETWEEN 20 AND 39",
    "above0": "steps > 0", "120plus": "steps >= 120", "above100": "steps > 100",
}
oracle("dev_cadence", "walked", f"""
    SELECT pid, date, {", ".join(f"count(*) FILTER (WHERE {c}) AS totalminutes{n}cadence"
                                 for n, c in _IN_BANDS.items())},
           avg(steps) AS meancadence,
           avg(steps) FILTER (WHERE steps > 0 OR alone) AS uncensoredmeancadence,
           max(steps) AS peak1minutecadence, avg(steps) FILTER (WHERE place <= 30)
             AS peak30minutecadence, avg(steps) FILTER (WHERE place <= 60) AS peak60minutecadence,
           max(m5) AS max5minutecadence, max(m20) AS max20minutecadence,
           max(m60) AS max60minutecadence
    FROM (SELECT *, row_number() OVER (PARTITION BY pid, date ORDER BY steps DESC, minute) AS place,
                 NOT (steps = 0 AND (coalesce(lag(steps) OVER o = 0 AND lag(minute) OVER o
                                              = minute - 1, false)
                                     OR coalesce(lead(steps) OVER o = 0 AND lead(minute) OVER o
                                                 = minute + 1, false))) AS alone,
                 {_best(5)}, {_best(20)}, {_best(60)}
          FROM walked WINDOW o AS (PARTITION BY pid, date ORDER BY minute)) x
    GROUP BY 1, 2""")


def _sleep_sql(kind: str) -> str:
    where = "" if kind == "all" else f"FILTER (WHERE type = '{kind}')"
    parts = {
        "durationafterwakeup": "minutes_after_wakeup", "durationasleep": "minutes_asleep",
        "durationawake": "minutes_awake", "durationtofallasleep": "minutes_to_fall_asleep",
        "durationinbed": "minutes_in_bed",
    }
    return f"""min(wake) {where} AS firstwaketime{kind}, max(wake) {where} AS lastwaketime{kind},
        min(bed) {where} AS firstbedtime{kind}, max(bed) {where} AS lastbedtime{kind},
        count(*) {where} AS countepisode{kind}, avg(efficiency) {where} AS avgefficiency{kind}, """ \
        + ", ".join(f"{a}({c}) {where} AS {a}{n}{kind}" for a in ("sum", "avg")
                    for n, c in parts.items())


oracle("dev_sleep", "sleep", "SELECT pid, date, "
       + ", ".join(map(_sleep_sql, ("main", "nap", "all")))
       + " FROM sleep GROUP BY 1, 2")
fragment("stage_records", "ev", """
    SELECT 'p' || pId AS pid, ts, (k + 1) * 30 AS d,
           CASE event_type WHEN 'click' THEN 'wake' WHEN 'view' THEN 'deep'
             WHEN 'purchase' THEN 'light' WHEN 'signup' THEN 'rem' ELSE 'asleep' END AS level,
           CASE k % 2 WHEN 0 THEN 'main' ELSE 'nap' END AS type FROM ev
    QUALIFY row_number() OVER (PARTITION BY pId, ts ORDER BY d DESC, level DESC, type DESC) = 1""")
fragment("stage_sessions", "stage_records", """
    SELECT *, CAST(min(ts) OVER (PARTITION BY pid, session) - INTERVAL 11 HOUR AS DATE) AS date FROM
      (SELECT *, count(*) FILTER (WHERE reach IS NULL OR ts > reach + INTERVAL 6 HOUR)
                   OVER (PARTITION BY pid ORDER BY ts) AS session FROM
        (SELECT *, max(ts + to_seconds(d)) OVER (PARTITION BY pid ORDER BY ts
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
         FROM stage_records) a) b""")
fragment("stage_runs", "stage_sessions", """
    SELECT pid, date, level, type, session, run, sum(d) / 60.0 AS d FROM
      (SELECT *, sum(new) OVER (PARTITION BY pid, session ORDER BY ts
                                ROWS UNBOUNDED PRECEDING) AS run FROM
        (SELECT *, CASE WHEN lag(level) OVER o = level AND lag(type) OVER o = type
                   THEN 0 ELSE 1 END AS new
         FROM stage_sessions WINDOW o AS (PARTITION BY pid, session ORDER BY ts)) b) c
    GROUP BY ALL""")
fragment("stage_labels", "stage_runs", """
    SELECT pid, date, d, unnest([level, 'all', CASE level WHEN 'wake' THEN 'unified_awake'
             ELSE 'unified_asleep' END]) AS level, type FROM stage_runs""")
fragment("stage_stats", "stage_labels", """
    SELECT pid, date, level, type, CAST(count(*) AS DOUBLE) AS c, sum(d) AS s, max(d) AS hi,
           min(d) AS lo, avg(d) AS m, median(d) AS med, stddev_samp(d) AS sd
    FROM (SELECT * FROM stage_labels UNION ALL SELECT pid, date, d, level, 'all' FROM stage_labels) x
    GROUP BY 1, 2, 3, 4""")
oracle("dev_sleep_stages", "stage_stats", """
    SELECT a.pid, a.date, a.level, a.type, a.c AS countepisode, a.s AS sumduration,
           a.hi AS maxduration, a.lo AS minduration, a.m AS avgduration, a.med AS medianduration,
           a.sd AS stdduration,
           a.c / g.c AS ratiocount_across_all, a.s / g.s AS ratioduration_across_all,
           a.c / t.c AS ratiocount_within_types, a.s / t.s AS ratioduration_within_types,
           a.c / l.c AS ratiocount_within_levels, a.s / l.s AS ratioduration_within_levels,
           l.c / g.c AS ratiocount_across_levels, l.s / g.s AS ratioduration_across_levels,
           t.c / g.c AS ratiocount_across_types, t.s / g.s AS ratioduration_across_types
    FROM stage_stats a
    JOIN stage_stats g ON g.pid = a.pid AND g.date = a.date AND g.level = 'all' AND g.type = 'all'
    JOIN stage_stats t ON t.pid = a.pid AND t.date = a.date AND t.level = 'all' AND t.type = a.type
    JOIN stage_stats l ON l.pid = a.pid AND l.date = a.date AND l.level = a.level
      AND l.type = 'all'""")
_READINGS = """
    SELECT pid, date, minute, mets, calories, 'a' AS g, activity_level AS e FROM dense
    UNION ALL SELECT pid, date, minute, mets, calories, 'b',
      CASE WHEN activity_level IN ('fairlyactive', 'veryactive') THEN 'mvpa' END FROM dense
    UNION ALL SELECT pid, date, minute, mets, calories, 'c',
      CASE WHEN mets >= 3 THEN 'highmet' ELSE 'lowmet' END FROM dense"""
_SPELLS = """
    SELECT pid, date, e AS episode_type, min(minute) AS first, max(minute) AS last,
           max(minute) - min(minute) + 1 AS d, sum(mets) AS met, sum(calories) AS cal,
           avg(mets) AS m
    FROM (SELECT *, sum(new) OVER (PARTITION BY pid, date, g ORDER BY minute
                                   ROWS UNBOUNDED PRECEDING) AS run
          FROM (SELECT *, CASE WHEN lag(e) OVER o IS NOT DISTINCT FROM e
                                AND minute - lag(minute) OVER o <= 5 THEN 0 ELSE 1 END AS new
                FROM readings WINDOW o AS (PARTITION BY pid, date, g ORDER BY minute)) x) y
    WHERE e IS NOT NULL GROUP BY pid, date, g, e, run"""
_CALORIES = f"""
    SELECT pid, date, episode_type, count(*) AS count, sum(d) AS sumduration, avg(d) AS avgduration,
           min(d) AS minduration, max(d) AS maxduration, stddev_samp(d) AS stdduration,
           min(first) AS starttimefirst, min(last) AS endtimefirst, max(first) AS starttimelast,
           max(last) AS endtimelast, min(first) FILTER (WHERE longest = 1) AS starttimelongest,
           min(last) FILTER (WHERE longest = 1) AS endtimelongest,
           sum(met) AS summet, {_stats("m", "met", "mean sd min max")
                                .replace("met_mean", "avgmet").replace("met_sd", "stdmet")
                                .replace("met_min", "minmet").replace("met_max", "maxmet")},
           sum(cal) AS sumcalories, avg(cal) AS avgcalories, max(cal) AS maxcalories,
           min(cal) AS mincalories, stddev_samp(cal) AS stdcalories
    FROM (SELECT *, row_number() OVER (PARTITION BY pid, date, episode_type
                                       ORDER BY d DESC, first) AS longest FROM spells) x
    GROUP BY pid, date, episode_type"""
fragment("readings", "dense", _READINGS)
fragment("spells", "readings", _SPELLS)
oracle("dev_calories", "spells", _CALORIES)
fragment("night_dense", "dense nights", _in_segments("dense").replace("turns", "nights"))
fragment("night_readings", "night_dense", _by_segment(_READINGS, dense="night_dense"))
fragment("night_spells", "night_readings", _by_segment(_SPELLS, readings="night_readings"))
oracle("dev_segment_calories", "night_spells", _by_segment(_CALORIES, spells="night_spells"))
