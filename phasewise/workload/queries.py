"""The registered queries: operators of the library over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasewise.functions import choices, dates, recode, rowwise, text
from phasewise.functions import columns as cols
from phasewise.operators import aggregates as agg
from phasewise.operators import filters, joins, ranks, reshape, sets
from phasewise.plans import (
    activities,
    codebook,
    demographics,
    devices,
    inference,
    outcomes,
    sensors,
    study,
    tables,
)
from phasewise.sources import readers, writers
from phasewise.workload.shape import Shape, bundle, spread
from phasewise.workload.standin import Tables, scratch

Build = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    shape: Shape

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.shape.project(self.build(Tables(spark, folder)))


QUERIES: dict[str, Query] = {}


def query(text: str = "", whole: str = "", number: str = "") -> Callable[[Build], Build]:
    """Register a function under its own name with its result columns."""

    def register(build: Build) -> Build:
        QUERIES[build.__name__] = Query(build, Shape(text, whole, number))
        return build

    return register


# ---- sources ---------------------------------------------------------------------------


@query("cohort record_id", "", "age hispanic year_diagnosed day_treatment "
       "cancer_category_participant dhls_score")  # fmt: skip
def src_cohort_union(t: Tables) -> DataFrame:
    frames = {
        name: cols.rename_by_patterns(df, codebook.COLUMN_SPELLINGS)
        for name, df in t.demographics().items()
    }
    return sets.stack_cohorts(frames)


@query("pid date", "minutes steps", "heartrate")
def src_json_minutes(t: Tables) -> DataFrame:
    minutes = readers.minutes_from_json(t.raw_documents())
    return minutes.groupBy("pid", F.to_date("ts").alias("date")).agg(
        F.count("*").alias("minutes"),
        F.sum("steps").alias("steps"),
        F.avg("heartrate").alias("heartrate"),
    )


@query("kind", "n ids letters", "balance")
def src_csv(t: Tables) -> DataFrame:
    """An export with quotes, commas and line breaks in cells, written and read back; records that do
    not fit are kept apart and counted in the same scan."""
    read = readers.csv_with_rejects(
        t.spark, t.csv_export(), "record_id string, name string, balance double", multi_line=True
    )
    kinds = readers.reject_kind()
    whole = F.col("kind") != "torn"
    return read.withColumn("kind", kinds).groupBy("kind").agg(
        F.count("*").alias("n"),
        F.count_distinct(F.when(whole & (F.length("record_id") == 8), F.col("record_id"))).alias("ids"),
        F.sum(F.when(whole, F.length("name"))).alias("letters"),
        F.sum(F.when(whole, F.col("balance"))).alias("balance"),
    )


@query("pId event_type", "event_id place")
def snk_ordered(t: Tables) -> DataFrame:
    """Events written in order with their place in it, and read back."""
    path = f"{scratch(t.spark)}/ordered-{uuid.uuid4().hex}"
    events = t.events().select("pId", "event_type", "event_id", "ts")
    writers.write_table(events, path, order=("ts", "event_id"), ordinal="place")
    return readers.read_table(t.spark, path)


@query("kind", "n")
def src_json_rejects(t: Tables) -> DataFrame:
    return readers.reject_counts(readers.documents_with_rejects(t.faulty_documents()))


@query("record_id", "study_phase n_days n_days_with_sufficient_data", "avghr_mean")
def src_phase_averages(t: Tables) -> DataFrame:
    return readers.phase_averages(_device_averages(t))


KINDS = ("click", "view", "purchase", "signup", "error")


@query("record_id", " ".join(f"n_{k}" for k in KINDS), " ".join(f"total_{k}" for k in KINDS))
def src_fold_join(t: Tables) -> DataFrame:
    """A table per kind of event, full-joined on the participant."""
    events = t.events().withColumnRenamed("pId", "record_id")
    frames = [
        events.filter(F.col("event_type") == kind)
        .groupBy("record_id")
        .agg(F.count("*").alias(f"n_{kind}"), F.sum("value").alias(f"total_{kind}"))
        for kind in KINDS
    ]
    joined = joins.fold_full_join(frames, ["record_id"], null_safe=True)
    return joined.fillna(0, subset=[f"n_{kind}" for kind in KINDS])


# ---- projection, recoding, scalars -----------------------------------------------------


@query("record_id", "", spread("q_{m}_{t}", m="cesd peat sip", t="baseline middle"))
def proj_harmonize(t: Tables) -> DataFrame:
    """Regex renames, a prefix, a dropped pattern and a moved column on a wide export."""
    wide = cols.rename_by_patterns(
        t.scores_wide(), [(r"_score", ""), (r"_bl$", "_baseline"), (r"_mp$", "_middle")]
    )
    wide = cols.drop_matching(wide, "_eos$")
    wide = cols.prefix_columns(wide, "q_", keep=["record_id"])
    return cols.move_columns(wide, ["q_sip_baseline"], after="record_id")


@query("record_id gender marital employment education cancer_status", "", "")
def rec_mapping(t: Tables) -> DataFrame:
    people = sets.stack(list(t.demographics().values()))
    return recode.recode_labels(people, codebook.CATEGORICAL)


@query("activityId", "n_answers n_rated", "rating_sum")
def rec_sentinel(t: Tables) -> DataFrame:
    rating = recode.sentinel_to_null(F.col("score"), -1)
    return t.activity_details().groupBy("activityId").agg(
        F.count("*").alias("n_answers"),
        F.count(rating).alias("n_rated"),
        F.sum(rating).alias("rating_sum"),
    )


@query("survey_type", "added_note n n_goodness", "study_phase goodness_sum")
def rec_survey_fields(t: Tables) -> DataFrame:
    """Survey phase, voided morning scores and the note flag."""
    return study.clean_responses(t.responses()).groupBy(
        "survey_type", "study_phase", "added_note"
    ).agg(
        F.count("*").alias("n"),
        F.count("goodness_score").alias("n_goodness"),
        F.sum("goodness_score").alias("goodness_sum"),
    )


@query("event_type", "phase n", "flag both either filled")
def rec_flags(t: Tables) -> DataFrame:
    """Flag reconciliation and three-valued AND / OR over two nullable flags."""
    k = F.col("k")
    rows = t.events().select(
        "event_type",
        (k % 2 + 1).alias("phase"),
        F.when(k % 3 != 0, k % 3 - 1).alias("a"),
        F.when(k % 5 < 2, k % 5).alias("b"),
    )
    a, b, phase = F.col("a"), F.col("b"), F.col("phase")
    flagged = rows.withColumns(
        {
            "flag": recode.reconcile_flag(a, phase, 2),
            "both": recode.both_flags(a, b, phase == 2),
            "either": recode.either_flag(a, b, phase == 2),
            "filled": recode.zero_where(b, a == 1),
        }
    )
    return flagged.groupBy("event_type", "phase", "flag", "both", "either", "filled").agg(
        F.count("*").alias("n")
    )


@query("record_id closed living", "", "place")
def rec_levels(t: Tables) -> DataFrame:
    """Closed ordered levels, off-level answers missing, and the derived living arrangement."""
    people = demographics.clean_demographics(t.demographics())
    levels = codebook.LEVELS["marital"]
    return people.select(
        "record_id",
        recode.close_levels(F.col("marital"), levels).alias("closed"),
        recode.level_index(F.col("marital"), levels).alias("place"),
        recode.living_arrangement(F.col("living_combined")).alias("living"),
    )


@query("o_orderpriority activity_type", "n", "")
def rec_ownership(t: Tables) -> DataFrame:
    """Whether an item id starts with its owner's id."""
    orders = t.raw("orders")
    kind = recode.ownership(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    return orders.groupBy("o_orderpriority", kind.alias("activity_type")).agg(
        F.count("*").alias("n")
    )


@query("record_id date_diagnosed date_diagnosed_stage4 date_treatment", "", "")
def dt_construct(t: Tables) -> DataFrame:
    frames = t.demographics().values()
    people = sets.stack([cols.rename_by_patterns(f, codebook.COLUMN_SPELLINGS) for f in frames])
    return dates.construct_dates(people, codebook.DATE_SUFFIXES)


@query("record_id", "", "months_since_diagnosed_at_demo_datetime "
       "months_since_diagnosed_stage4_at_demo_datetime days_since_treatment_at_demo_datetime")
def dt_interval_months(t: Tables) -> DataFrame:
    return demographics.clean_demographics(t.demographics())


@query("o_orderpriority", "n n_negative days months years", "")
def dt_interval_days(t: Tables) -> DataFrame:
    """Calendar periods from order to shipping over all order lines; negative ones void."""
    lines = t.raw("lineitem").join(t.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    start, end = dates.local_date(F.col("o_orderdate")), dates.local_date(F.col("l_shipdate"))
    spans = lines.select(
        "o_orderpriority",
        *[dates.periods_between(start, end, u).alias(u) for u in dates.UNITS],
    )
    return spans.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("days").isNull()).alias("n_negative"),
        *[F.sum(u).alias(u) for u in dates.UNITS],
    )


@query("pId opening closing tag", "days", "")
def dt_windows(t: Tables) -> DataFrame:
    """Closed ends, inclusive lengths and day-boundary texts."""
    last = dates.closed_end(F.col("endDate"))
    return t.phases().select(
        "pId",
        dates.day_open(F.col("startDate")).alias("opening"),
        dates.day_close(last).alias("closing"),
        dates.participant_tag(F.col("pId")).alias("tag"),
        dates.inclusive_days(F.col("startDate"), last).alias("days"),
    )


@query("record_id plain sorted_text other_last", "", "")
def str_pretty_join(t: Tables) -> DataFrame:
    """Options chosen per participant as a list in words, three ways."""
    people = sets.stack(list(t.demographics().values()))
    labels = codebook.MULTIPLE_CHOICE["race"]
    ticked = F.array_compact(
        F.array(
            *[
                F.when(F.col(f"race___{c}") == 1, F.lit(f"race_{label}"))
                for c, label in reversed(labels.items())
            ]
        )
    )
    return people.select(
        "record_id",
        text.pretty_join(ticked, prefix="race").alias("plain"),
        text.pretty_join(ticked, prefix="race", sort=True).alias("sorted_text"),
        text.pretty_join(ticked, prefix="race", other_last=True).alias("other_last"),
    )


@query("instrument domain score_type calibration_type timepoint", "n", "value_sum")
def str_separate(t: Tables) -> DataFrame:
    """Column names taken apart after unpivoting."""
    long = reshape.unpivot_long(t.promis_wide(), ["record_id"], name="name", dtype="double")
    parts = ["instrument", "domain", "score_type", "calibration_type", "timepoint"]
    return text.separate(long, "name", parts).groupBy(*parts).agg(
        F.count("value").alias("n"), F.sum("value").alias("value_sum")
    )


@query("last stem label", "n", "")
def str_tokens(t: Tables) -> DataFrame:
    """Last token, stripped suffix and cleaned label of part names."""
    name = F.concat_ws("_", F.lower("p_type"), F.lower("p_brand"))
    return t.raw("part").groupBy(
        text.last_token(name).alias("last"),
        text.strip_pattern(name, "_[^_]*$").alias("stem"),
        text.clean_label(name, [("_", " "), ("#", " no. ")]).alias("label"),
    ).agg(F.count("*").alias("n"))


@query("shown", "n", "")
def fmt_p(t: Tables) -> DataFrame:
    p = F.col("value") / 493.7
    return t.events().groupBy(text.p_text(p * p).alias("shown")).agg(F.count("*").alias("n"))


@query("event_type stats range share", "significant", "")
def fmt_summary(t: Tables) -> DataFrame:
    """Formatted mean, deviation, range and share per kind of event."""
    stats = agg.stat_bundle(
        t.events(), ["event_type"], ["value"], extra=[F.count_if(F.col("k") < 7).alias("few")]
    )
    low, high = F.col("value_min"), F.col("value_max")
    return stats.select(
        "event_type",
        text.summary_text(F.col("value_mean"), F.col("value_sd"), low, high).alias("stats"),
        text.range_text(low, high).alias("range"),
        text.count_text(F.col("few"), F.col("value_n")).alias("share"),
        text.significant(F.col("value_min")).cast("int").alias("significant"),
    )


@query("record_id race_combined living_combined cancer_treatment_combined cancer_treatment_Surgery",
       "", "")
def mc_combine(t: Tables) -> DataFrame:
    return demographics.clean_demographics(t.demographics())


@query("record_id", spread("{q}_combined_n_choices", q="race living cancer_treatment"))
def mc_count(t: Tables) -> DataFrame:
    people = sets.stack(list(t.demographics().values()))
    named = choices.name_options(people, codebook.MULTIPLE_CHOICE)
    return choices.count_options(named, codebook.MULTIPLE_CHOICE)


@query("event_type", "n row_total", "mean_of_two z t share reversed_sum")
def mth_scores(t: Tables) -> DataFrame:
    """Row sums and means, standard scores, ratios with a zero denominator, reversed signs."""
    v, k = F.col("value"), F.col("k")
    rows = t.events().select(
        "event_type",
        rowwise.row_sum([k, F.when(k % 2 == 0, k)]).alias("row_total"),
        rowwise.row_mean_strict([v, F.when(k % 3 != 0, k)]).alias("mean_of_two"),
        rowwise.standardize(v, 50, 10).alias("z"),
        rowwise.ratio(v, k % 4).alias("share"),
        v.alias("reversed_sum"),
    )
    rows = rowwise.reverse_sign(rows, ["reversed_sum"])
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.sum("row_total").alias("row_total"),
        F.avg("mean_of_two").alias("mean_of_two"),
        F.avg("z").alias("z"),
        rowwise.rescale(F.avg("z"), 50, 10).alias("t"),
        F.avg("share").alias("share"),
        F.sum("reversed_sum").alias("reversed_sum"),
    )


@query("record_id", "", "goodness_difference n_difference")
def mth_differences(t: Tables) -> DataFrame:
    """Phase 2 minus phase 1 per participant."""
    goodness = _goodness(t)
    wide = reshape.pivot_values(
        goodness.select("record_id", "study_phase", F.col("goodness_score_mean").alias("goodness"),
                        F.col("goodness_score_n").alias("n")),
        ["record_id"], "study_phase", [1, 2], ["goodness", "n"], template="{value}_phase{key}",
    )
    return rowwise.with_differences(wide)


# ---- filters ---------------------------------------------------------------------------


@query("pId sId", "n", "")
def flt_scope_like(t: Tables) -> DataFrame:
    """Ids of one cohort by prefix without excluded ones, and kinds by LIKE on encoded ids."""
    rows = t.responses().filter(
        filters.in_scope(F.col("pId"), "1", ["1", "13"])
        & (
            filters.id_like(F.col("surveyId"), "%_DAILY_%")
            | filters.id_like(F.col("surveyId"), "%_EVENING_%")
        )
    )
    return rows.groupBy("pId", "sId").agg(F.count("*").alias("n"))


@query("record_id timepoint_name", "", "sip_score")
def flt_complete_group(t: Tables) -> DataFrame:
    """Participants with the score at all three timepoints."""
    long = outcomes.clean_outcomes([t.scores_wide()])
    return filters.complete_groups(long, ["record_id"], "sip_score", expected_rows=3)


@query("event_type", "n", "total")
def flt_complete_rows(t: Tables) -> DataFrame:
    k = F.col("k")
    rows = t.events().select(
        "event_type", F.when(k % 3 != 0, k).alias("a"), F.when(k % 5 != 0, k).alias("b")
    )
    return filters.complete_cases(rows, ["a", "b"]).groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("a") + F.col("b")).alias("total")
    )


# ---- reshaping -------------------------------------------------------------------------


@query("record_id variable", "", "value")
def rsh_unpivot(t: Tables) -> DataFrame:
    return reshape.unpivot_long(t.scores_wide(), ["record_id"], dtype="double")


@query("pId", "", spread("{v}_{k}", v="n total", k="click view purchase signup error"))
def rsh_pivot_multi(t: Tables) -> DataFrame:
    kinds = ["click", "view", "purchase", "signup", "error"]
    counts = t.events().groupBy("pId", "event_type").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )
    return reshape.pivot_values(counts, ["pId"], "event_type", kinds, ["n", "total"])


@query("record_id phase_start_date phase_end_date date", "phase")
def rsh_calendar(t: Tables) -> DataFrame:
    """Order dates as exclusive ends of ten-day windows, exploded to days."""
    windows = t.raw("orders").select(
        F.col("o_orderkey").alias("record_id"),
        F.lit(1).alias("phase"),
        F.date_sub(F.to_date("o_orderdate"), (F.col("o_orderkey") % 5).cast("int")).alias(
            "phase_start_date"
        ),
        F.date_sub(F.to_date("o_orderdate"), 1).alias("phase_end_date"),
    )
    return reshape.explode_days(windows, "phase_start_date", "phase_end_date")


@query("record_id date", "phase", spread(
    "fitbit_{f}_{s}", s="morning evening",
    f="data_yield_rapids_ratiovalidyieldedhours heartrate_intraday_rapids_avghr "
      "steps_intraday_rapids_sumsteps"))  # fmt: skip
def rsh_segments(t: Tables) -> DataFrame:
    """Features of two time segments side by side on the calendar."""
    segments = [("morning", 360, 360), ("evening", 1080, 480)]
    features = sensors.daily_features(t.minutes(), segments=segments, min_hour_ratio=1 / 60)
    names = [c for c in features.columns if c.startswith("fitbit")]
    return devices.calendar_device_features(
        study.study_calendar(t.phases()), features, names, segments=["morning", "evening"]
    )


# ---- joins -----------------------------------------------------------------------------


@query("pId phaseId", "n", "total")
def jn_interval(t: Tables) -> DataFrame:
    """Events inside their participant's phase windows."""
    windows = t.phases().withColumn("last", dates.closed_end(F.col("endDate")))
    inside = joins.interval_join(t.events(), windows, "pId", "date", "startDate", "last")
    return inside.groupBy("pId", "phaseId").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )


@query("event_type", "", "key clicks total")
def jn_full_nullsafe(t: Tables) -> DataFrame:
    """Full join in which a missing key matches a missing key."""
    key = F.nullif(F.col("k") % 7, F.lit(0)).alias("key")
    left = t.events().groupBy(key, "event_type").agg(F.count("*").alias("clicks"))
    right = t.events().filter(F.col("event_type") != "view").groupBy(
        key, F.when(F.col("event_type") == "error", "other").otherwise(F.col("event_type"))
        .alias("event_type"),
    ).agg(F.sum("value").alias("total"))
    return joins.full_join(left, right, ["key", "event_type"], null_safe=True)


@query("pId date", "n has_morning has_evening", "")
def jn_presence(t: Tables) -> DataFrame:
    """Days with a daily survey, marked by presence of morning and evening surveys."""
    r = t.responses()
    daily = r.filter(F.col("sId") == "DAILY").groupBy("pId", "date").agg(F.count("*").alias("n"))
    marked = joins.mark_presence(
        daily,
        [
            (r.filter(F.col("sId") == "MORNING"), "has_morning"),
            (r.filter(F.col("sId") == "EVENING"), "has_evening"),
        ],
        ["pId", "date"],
    )
    return marked.fillna(0, subset=["n"])


# ---- aggregation -----------------------------------------------------------------------


@query("pId event_type", "value_n", bundle("value", "mean sd min max") + " " + bundle("k"))
def agg_bundle(t: Tables) -> DataFrame:
    rows = t.events().withColumn("k", F.when(F.col("k") % 4 != 0, F.col("k")))
    return agg.stat_bundle(rows, ["pId", "event_type"], ["value", "k"])


@query("pId", "n_rows value_n", bundle("value", "mean sd min max"))
def agg_filtered_bundle(t: Tables) -> DataFrame:
    return agg.stat_bundle(
        t.events(), ["pId"], ["value"], only=F.col("k") > 90, extra=[F.count("*").alias("n_rows")]
    )


@query("pId event_type", "n", "total")
def agg_level_overall(t: Tables) -> DataFrame:
    rows = t.events().withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return agg.level_and_overall(
        rows, ["pId"], "event_type", [F.count("*").alias("n"), F.sum("value").alias("total")]
    )


@query("p_brand", "n items large small", "")
def agg_cond_distinct(t: Tables) -> DataFrame:
    """Distinct customers per brand: all, with large orders, with small ones."""
    lines = t.order_lines().join(t.raw("part"), F.col("activityId") == F.col("p_partkey"))
    lines = lines.join(t.raw("orders").select("o_orderkey", "o_totalprice"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
    large = F.col("o_totalprice") > 200_000
    counts = agg.distinct_counts(
        lines, ["p_brand"], "pId", {"items": None, "large": large, "small": ~large}
    )
    rows = lines.groupBy("p_brand").agg(F.count("*").alias("n"))
    return counts.join(rows, "p_brand")


@query("pId", "kinds", "distinct_k")
def agg_distinct_missing(t: Tables) -> DataFrame:
    """Distinct values with the missing one counted as a value."""
    rows = t.events().withColumn("k", F.when(F.col("k") % 10 != 0, F.col("k") % 10))
    kinds = agg.distinct_counts(rows, ["pId"], "event_type", {"kinds": None}, count_missing=True)
    values = agg.distinct_counts(rows, ["pId"], "k", {"distinct_k": None}, count_missing=True)
    return kinds.join(values, "pId")


@query("pId kinds_list high_list", "kinds high", "")
def agg_distinct_list(t: Tables) -> DataFrame:
    return agg.distinct_counts(
        t.events(), ["pId"], "event_type", {"kinds": None, "high": F.col("value") > 100}, lists=True
    )


@query("pId", "days", bundle("n", "mean sd min max") + " " + bundle("best", "mean sd min max"))
def agg_two_level(t: Tables) -> DataFrame:
    daily = t.events().groupBy("pId", "date").agg(
        F.count("*").alias("n"), F.max("value").alias("best")
    )
    return agg.stat_bundle(
        daily, ["pId"], ["n", "best"], ("mean", "sd", "min", "max"), extra=[F.count("*").alias("days")]
    )


@query("pId date", "n_missing", "strict loose")
def agg_strict_sum(t: Tables) -> DataFrame:
    value = F.when(F.col("k") % 6 != 0, F.col("value"))
    return t.events().groupBy("pId", "date").agg(
        agg.strict_sum(value).alias("strict"),
        F.coalesce(F.sum(value), F.lit(0)).alias("loose"),
        F.count_if(value.isNull()).alias("n_missing"),
    )


@query("domain_set", "n_missing", "sum_physical sum_mental")
def agg_weighted_sum(t: Tables) -> DataFrame:
    """Weighted sums of six components with the weights in a literal table."""
    names = [w[0] for w in codebook.SUMMARY_WEIGHTS]
    z = t.events().select(
        F.concat_ws("-", "pId", (F.col("event_id") % 3)).alias("domain_set"),
        F.get(F.array(*map(F.lit, names)), (F.col("k") % 6)).alias("domain"),
        F.when(F.col("k") % 17 != 0, (F.col("value") - 50) / 10).alias("z"),
    )
    weights = t.spark.createDataFrame(
        [(d, float(a), float(b)) for d, a, b in codebook.SUMMARY_WEIGHTS],
        "domain string, weight_physical double, weight_mental double",
    )
    return outcomes.weighted_scores_long(z, weights, ["domain_set"])


@query("c_mktsegment n_name", "n", "p")
def agg_category(t: Tables) -> DataFrame:
    """Customers per nation within each market segment, with their share."""
    rows = t.raw("customer").join(
        t.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return agg.category_counts(rows, "n_name", by="c_mktsegment")


# ---- windows, sets ---------------------------------------------------------------------


@query("pId", "n_na n_rows", "kept")
def win_missing(t: Tables) -> DataFrame:
    """Missing values of a participant beside each of their rows."""
    rows = t.events().withColumn("value", F.when(F.col("k") % 50 != 0, F.col("value")))
    marked = filters.with_group_missing(rows, ["pId"], "value")
    return marked.groupBy("pId", "n_na").agg(
        F.count("*").alias("n_rows"), F.sum(F.when(F.col("n_na") <= 1, F.col("value"))).alias("kept")
    )


@query("variable", "n", "value rank")
def win_midrank(t: Tables) -> DataFrame:
    """Mid-ranks of event values within each kind of event."""
    counts = ranks.value_counts(t.events(), "event_type", "value")
    return ranks.mid_ranks(counts, "event_type", "value").withColumnRenamed(
        "event_type", "variable"
    )


@query("activityId activity_name", "", "")
def set_union_distinct(t: Tables) -> DataFrame:
    return activities.activity_names(t.activities(), t.user_activities())


@query("pId", " ".join(f"n_{k}" for k in (*KINDS, "rows")), "")
def set_append(t: Tables) -> DataFrame:
    """Frames with different columns appended."""
    e = t.events()
    frames = [
        e.filter(F.col("event_type") == kind).select("pId", F.lit(1).alias(f"n_{kind}"))
        for kind in KINDS
    ]
    counts = [f"n_{kind}" for kind in KINDS]
    sums = agg.sum_columns(sets.stack(frames), ["pId"], counts, prefix="")
    return sums.withColumn("n_rows", reduce(add, map(F.col, counts)))


# ---- study plans -----------------------------------------------------------------------


@query("pId phase1_start_date phase1_end_date phase2_start_date phase2_end_date", "", "")
def stu_windows(t: Tables) -> DataFrame:
    return study.both_windows(t.phases())


@query("record_id phase_start_date phase_end_date date", "phase")
def stu_calendar(t: Tables) -> DataFrame:
    return study.study_calendar(t.phases())


@query("record_id survey_id survey_type date survey_start_datetime", "study_phase added_note",
       "survey_duration goodness_score")
def stu_surveys(t: Tables) -> DataFrame:
    return study.survey_extract(t.responses(), t.phases())


def _surveys(t: Tables) -> DataFrame:
    return study.survey_extract(t.responses(), t.phases())


@query("device_id pid label start_date end_date platform", "", "")
def stu_devices(t: Tables) -> DataFrame:
    return study.device_assignments(t.devices(), t.participants())


@query(
    "record_id date",
    "phase phase_duration number_surveys_completed number_surveys_expected",
    "has_survey_daily has_survey_morning has_survey_evening has_survey_morning_and_evening "
    "has_survey_morning_or_evening survey_duration_daily survey_duration_morning "
    "survey_duration_evening goodness_score_daily goodness_score_evening "
    "added_note_daily added_note_morning added_note_evening",
)
def stu_survey_days(t: Tables) -> DataFrame:
    return study.survey_compliance_days(study.study_calendar(t.phases()), _surveys(t))


COMPLIANCE = (
    "phase_duration_phase1 phase_duration_phase2 total_number_surveys_completed_phase1 "
    "total_number_surveys_completed_phase2 total_number_surveys_completed_overall "
    "total_number_surveys_expected_overall total_days_with_any_surveys_overall "
    "total_days_with_all_surveys_overall total_duration_overall "
    + " ".join(codebook.SURVEY_RATE_LABELS)
)


@query("record_id", "", COMPLIANCE)
def stu_survey_compliance(t: Tables) -> DataFrame:
    return study.survey_compliance_report(t.responses(), t.phases())


def _goodness(t: Tables) -> DataFrame:
    return study.average_goodness(_surveys(t))


@query("record_id", "study_phase goodness_score_n", bundle("goodness_score", "mean sd min max"))
def stu_goodness(t: Tables) -> DataFrame:
    return _goodness(t)


def _selected(t: Tables) -> list[DataFrame]:
    names = activities.activity_names(t.activities(), t.user_activities())
    return [
        activities.selected_activities(t.preferences(), names, t.activity_phases(), phase)
        for phase in (1, 2)
    ]


@query("pId activityId activity_name phase1_start_date phase1_end_date", "", "")
def stu_selected(t: Tables) -> DataFrame:
    return _selected(t)[0]


SELECTION = spread(
    "selected_{w}_{k}",
    w="phase1 phase2 phase1_and_phase2 phase1_not_phase2 phase2_not_phase1",
    k="all custom default",
)


def _selection(t: Tables) -> DataFrame:
    return activities.activity_selection_summary(*_selected(t))


@query("record_id", "", SELECTION)
def stu_selection(t: Tables) -> DataFrame:
    return _selection(t)


def _answers(t: Tables, build: Callable) -> DataFrame:
    return build(t.activity_details(), t.activity_responses(), t.activity_phases())


@query("survey_id_daily pId date activityId", "endorsed", "activity_rating")
def stu_endorsed(t: Tables) -> DataFrame:
    return _answers(t, activities.endorsed_activities)


@query("survey_id_morning pId date activityId", "planned", "")
def stu_planned(t: Tables) -> DataFrame:
    return _answers(t, activities.planned_activities)


@query("survey_id_evening pId date activityId", "completed", "")
def stu_completed(t: Tables) -> DataFrame:
    return _answers(t, activities.completed_activities)


def _endorsement(t: Tables) -> DataFrame:
    return activities.endorsement_summary(_answers(t, activities.endorsed_activities))


ENDORSEMENT = (
    spread("phase1_{n}", n="total_endorsed total_rated unique_endorsed unique_rated daily_surveys "
           + bundle("activity_rating", "mean sd min max"))
    + " " + " ".join(
        bundle(f"phase1_{m}", "mean sd min max")
        for m in ("total_endorsed", "total_rated", "activity_rating_mean", "activity_rating_min",
                  "activity_rating_max", "endorsed_activity_rating_rate")
    )
)


@query("record_id", "", ENDORSEMENT)
def stu_endorsement(t: Tables) -> DataFrame:
    return _endorsement(t)


def _completion(t: Tables) -> DataFrame:
    return activities.completion_summary(
        _answers(t, activities.planned_activities), _answers(t, activities.completed_activities)
    )


@query("record_id date activity_id", "has_morning has_evening", "planned completed")
def stu_planned_completed(t: Tables) -> DataFrame:
    return activities.planned_completed_days(
        _answers(t, activities.planned_activities), _answers(t, activities.completed_activities)
    )


COMPLETION_LISTS = spread(
    "phase2_unique_{k}_list",
    k="planned completed planned_and_completed planned_not_completed completed_not_planned",
)
COMPLETION = (
    spread("phase2_{n}_surveys", n="morning evening morning_and_evening")
    + " "
    + spread("phase2_total_{k}", k="planned completed planned_and_completed planned_not_completed "
             "completed_not_planned not_planned_not_completed")
    + " " + COMPLETION_LISTS.replace("_list", "")
    + " " + bundle("phase2_planned_activity_completion_rate")
)


@query("record_id " + COMPLETION_LISTS, "", COMPLETION)
def stu_completion(t: Tables) -> DataFrame:
    return _completion(t)


def _engagement(t: Tables) -> DataFrame:
    return activities.activity_engagement(_selection(t), _endorsement(t), _completion(t))


@query("record_id " + COMPLETION_LISTS, "", f"{SELECTION} {ENDORSEMENT} {COMPLETION}")
def stu_engagement(t: Tables) -> DataFrame:
    return _engagement(t)


@query(
    "cohort record_id gender marital employment education cancer_category_participant "
    "race_combined living_combined cancer_treatment_combined date_diagnosed demo_datetime hispanic",
    "race_combined_n_choices",
    "age dhls_score months_since_diagnosed_at_demo_datetime "
    "days_since_treatment_at_demo_datetime",
)
def stu_demographics(t: Tables) -> DataFrame:
    return demographics.clean_demographics(t.demographics())


@query("record_id timepoint_name", "timepoint_number", "cesd_score peat_score sip_score global07")
def stu_outcomes(t: Tables) -> DataFrame:
    return outcomes.clean_outcomes([t.scores_wide(), t.pain_wide()])


@query("record_id timepoint_name", "timepoint_number n_component_zscores_na",
       "promis_summary_physical_health_t promis_summary_mental_health_t")
def stu_promis(t: Tables) -> DataFrame:
    return outcomes.promis_summary_scores(t.promis_wide(), t.pain_wide())


FEATURES = {
    "yield": "fitbit_data_yield_rapids_ratiovalidyieldedhours",
    "avghr": "fitbit_heartrate_intraday_rapids_avghr",
    "sumsteps": "fitbit_steps_intraday_rapids_sumsteps",
    "asleep": "fitbit_sleep_summary_rapids_sumdurationasleepall",
}


def _device_days(t: Tables) -> DataFrame:
    # Samples are events, a few a day: an hour is valid with one minute in it.
    minutes = sensors.daily_features(t.minutes(), t.sleep_episodes(), min_hour_ratio=1 / 60)
    days = devices.calendar_device_features(
        study.study_calendar(t.phases()), minutes, list(FEATURES.values())
    )
    return days.withColumnsRenamed({v: k for k, v in FEATURES.items()})


@query("record_id date", "phase", "yield avghr sumsteps asleep")
def flt_yield(t: Tables) -> DataFrame:
    """The calendar with the features of days of enough wear only."""
    minutes = sensors.daily_features(t.minutes(), t.sleep_episodes(), min_hour_ratio=1 / 60)
    days = devices.calendar_device_features(
        study.study_calendar(t.phases()), minutes, list(FEATURES.values()), min_yield=(FEATURES["yield"], "1/12")
    )
    return days.withColumnsRenamed({v: k for k, v in FEATURES.items()})


def _device_averages(t: Tables) -> DataFrame:
    return devices.average_device_features(
        _device_days(t), ["avghr", "sumsteps", "asleep"], "yield", threshold="1/12"
    )


@query("record_id date pid", "phase", "yield avghr sumsteps asleep")
def stu_device_features(t: Tables) -> DataFrame:
    return _device_days(t)


@query("record_id phase", "n_days n_days_with_sufficient_data avghr_n sumsteps_n asleep_n",
       f"{bundle('avghr', 'mean sd min max')} {bundle('sumsteps', 'mean sd min max')} "
       f"{bundle('asleep', 'mean sd min max')}")  # fmt: skip
def stu_device_avg(t: Tables) -> DataFrame:
    return _device_averages(t)


def _device_compliance(t: Tables) -> DataFrame:
    return devices.device_compliance(_device_averages(t), threshold="1/12")


@query("record_id phase data_yield_feature", "n_days n_days_with_sufficient_data",
       "prop_days_with_sufficient_data percent_days_with_sufficient_data data_yield_threshold")
def stu_device_compliance(t: Tables) -> DataFrame:
    return _device_compliance(t)


# ---- statistics ------------------------------------------------------------------------

PAIRS = [
    (n, f"{n}_phase2", f"{n}_phase1") for n in ("goodness_score_mean", "goodness_score_n",
                                                "sumsteps_mean")
]


def _paired(t: Tables) -> DataFrame:
    wide = inference.outcomes_by_phase(
        [_goodness(t), _device_averages(t)], [p[0] for p in PAIRS]
    )
    return inference.paired_t_tests(wide, PAIRS)


@query("outcome data_x data_y method alternative", "n",
       f"{bundle('data_x', 'mean sd min max')} {bundle('data_y', 'mean sd min max')} "
       "t df p_value conf_int1 conf_int2 mean_difference null_value stderr")  # fmt: skip
def st_paired_t(t: Tables) -> DataFrame:
    return _paired(t)


@query("outcome effect_size_magnitude", "n", "effect_size_cohensd")
def st_cohens_d(t: Tables) -> DataFrame:
    return _paired(t)


SCORES = ["cesd_score", "peat_score", "sip_score"]


def _outcomes(t: Tables) -> DataFrame:
    return outcomes.analysis_outcomes(
        [
            outcomes.clean_outcomes([t.scores_wide()]),
            outcomes.promis_summary_scores(t.promis_wide(), t.pain_wide()),
        ]
    )


@query("record_id", "timepoint", "cesd_score peat_score sip_score "
       "promis_summary_physical_health_t promis_summary_mental_health_t")
def st_inputs(t: Tables) -> DataFrame:
    return _outcomes(t)


@query("outcome", "n", "anova_DFn anova_DFd anova_F anova_p anova_ges "
       + spread("{s}_{t}", s="mean sd min max", t="1 2 3"))
def st_rm_anova(t: Tables) -> DataFrame:
    return inference.repeated_measures_anova(_outcomes(t), SCORES, "timepoint", "record_id")


@query("outcome", "n", "sphericity_W sphericity_p correction_GGe correction_DFn_GG "
       "correction_DFd_GG correction_p_GG correction_HFe correction_DFn_HF correction_DFd_HF "
       "correction_p_HF")
def st_sphericity(t: Tables) -> DataFrame:
    return inference.repeated_measures_anova(_outcomes(t), SCORES, "timepoint", "record_id")


@query("outcome ttest_group1 ttest_group2 p_adj_method effect_size_magnitude", "n",
       "ttest_estimate ttest_statistic ttest_df ttest_p ttest_conf_low ttest_conf_high "
       "ttest_p_adj effect_size_cohensd")
def st_pairwise(t: Tables) -> DataFrame:
    return inference.pairwise_t_tests(_outcomes(t), SCORES, "timepoint", "record_id")


@query("outcome method ttest_group1 ttest_group2", "", "ttest_p_adj")
def st_adjusted(t: Tables) -> DataFrame:
    """Pairwise p-values under each correction for multiple comparisons."""
    tests = inference.pairwise_t_tests(_outcomes(t), SCORES, "timepoint", "record_id")
    plain = tests.select("outcome", "ttest_group1", "ttest_group2", "ttest_p")
    return sets.stack(
        [
            inference.adjust_p(plain, "ttest_p", ["outcome"], m, into="ttest_p_adj").withColumn(
                "method", F.lit(m)
            )
            for m in inference.ADJUSTMENTS
        ]
    )


def _customers(t: Tables) -> DataFrame:
    side = F.when(F.col("c_nationkey") < 12, "low").otherwise("high")
    return t.raw("customer").withColumns(
        {
            "side": side,
            "overdrawn": F.when(F.col("c_acctbal") < 0, "Yes").otherwise("No"),
            "n_code": F.col("c_nationkey") % 7,
            # Three rare levels of four.
            "band": F.when(F.col("c_acctbal") < -970, "lowest")
            .when(F.col("c_acctbal") > 9960, "highest")
            .when(F.col("c_acctbal").between(0, 25), "nothing")
            .otherwise("other"),
        }
    )


@query("variable method", "n1 n2", "statistic p_value")
def st_ranksum(t: Tables) -> DataFrame:
    return inference.rank_sum_tests(_customers(t), ["c_acctbal", "n_code"], "side", "low", "high")


@query("variable method", "n1 n2", "statistic p_value")
def st_ranksum_exact(t: Tables) -> DataFrame:
    """Seven groups of customers against twenty-two, by figures with and without ties."""
    place = F.col("c_custkey") % 29
    groups = t.raw("customer").groupBy(F.when(place < 7, "low").otherwise("high").alias("side"), place.alias("place")).agg(
        F.floor(F.sum("c_acctbal") / 10_000).alias("thousands"),
        F.count_if(F.col("c_acctbal") < 0).alias("overdrawn"))
    return inference.rank_sum_tests(groups, ["thousands", "overdrawn"], "side", "low", "high", exact=True)


@query("variable", "", "statistic df min_expected p_value")
def st_chisq(t: Tables) -> DataFrame:
    counts = inference.cross_counts(_customers(t), ["c_mktsegment", "overdrawn"], "side")
    return inference.chi_square_tests(counts)


@query("variable", "n_tables", "p_value")
def st_fisher(t: Tables) -> DataFrame:
    counts = inference.cross_counts(_customers(t), ["overdrawn"], "side")
    return inference.fisher_tests(counts, "low")


@query("variable", "n_tables", "p_value")
def st_fisher_levels(t: Tables) -> DataFrame:
    """Exact test of four levels, of which three are rare."""
    return inference.fisher_tests(inference.cross_counts(_customers(t), ["band"], "side"), "low")


@query("variable method", "", "p_value")
def st_category(t: Tables) -> DataFrame:
    """Chi-square or exact test, by the smallest expected count."""
    return inference.category_tests(
        _customers(t), ["c_mktsegment", "overdrawn", "band"], "side", "low"
    )


# ---- tables ----------------------------------------------------------------------------

ROWS = "variable row_type label"


@query(ROWS + " stat_0", "", "row_order n_0")
def tab_summary(t: Tables) -> DataFrame:
    rows = t.events().withColumn("k", F.when(F.col("k") > 2, F.col("k")))
    variables = [
        tables.Continuous("value", "Value"),
        tables.Continuous("k", "Number"),
        tables.Categorical("event_type", "Kind", ("click", "view", "purchase")),
    ]
    return tables.summary_table(rows, variables)


@query(ROWS + " stat_1 stat_2", "", "row_order n_1 n_2")
def tab_summary_by(t: Tables) -> DataFrame:
    variables = [
        tables.Continuous("c_acctbal", "Balance", (2, 2, 1, 1)),
        tables.Categorical("c_mktsegment", "Segment", ("BUILDING", "MACHINERY")),
    ]
    return tables.summary_table(_customers(t), variables, by="side", by_levels=["low", "high"])


@query(ROWS + " stat_1 stat_2", "", "row_order n_1 n_2 p_value")
def tab_characteristics(t: Tables) -> DataFrame:
    return tables.participant_characteristics(demographics.clean_demographics(t.demographics()))


@query(ROWS + " stat_0", "", "row_order n_0")
def tab_feedback0(t: Tables) -> DataFrame:
    return tables.phase0_feedback(t.feedback0())


@query(ROWS + " stat_0", "", "row_order n_0")
def tab_feedback1(t: Tables) -> DataFrame:
    return tables.phase1_feedback(t.feedback1())


@query(ROWS + " stat_0", "", "row_order n_0")
def tab_survey_compliance(t: Tables) -> DataFrame:
    return tables.survey_compliance_table(
        study.survey_compliance_report(t.responses(), t.phases())
    )


@query(ROWS + " stat_0", "", "row_order n_0")
def tab_device_compliance(t: Tables) -> DataFrame:
    return tables.device_compliance_table(_device_compliance(t))


@query(ROWS + " stat_0", "", "row_order n_0")
def tab_compliance(t: Tables) -> DataFrame:
    return tables.combined_compliance_table(
        study.survey_compliance_report(t.responses(), t.phases()), _device_compliance(t)
    )


@query(ROWS + " stat_0", "", "row_order n_0")
def tab_engagement(t: Tables) -> DataFrame:
    return tables.activity_engagement_table(_engagement(t))


@query("outcome_str data_y_label data_y_range data_x_label data_x_range p_str", "n significant",
       "data_y_mean data_y_sd data_x_mean data_x_sd mean_difference t df effect_size_cohensd")
def tab_ttest(t: Tables) -> DataFrame:
    return tables.ttest_table(_paired(t)).withColumn("significant", F.col("significant").cast("int"))


@query(
    "outcome_name summarystat_t1 summarystat_t2 summarystat_t3 anova_df anova_f anova_p_str "
    "anova_ges " + spread("ttest_{m}_{p}", m="estimate df statistic p_str cohensd",
                          p="t1_to_t2 t1_to_t3 t2_to_t3"),
    "", "row_order n anova_correction_applied anova_significant",
)
def tab_anova(t: Tables) -> DataFrame:
    names = SCORES + ["promis_summary_physical_health_t", "promis_summary_mental_health_t"]
    results = inference.anova_with_comparisons(_outcomes(t), names, "timepoint", "record_id")
    table = tables.anova_table(results)
    return table.withColumn("anova_significant", F.col("anova_significant").cast("int"))


# ---- device features -------------------------------------------------------------------


@query("pid date", "", "ratiovalidyieldedminutes ratiovalidyieldedhours")
def dev_yield(t: Tables) -> DataFrame:
    return sensors.data_yield(sensors.minute_grid(t.minutes()), min_ratio=2 / 60)


@query("pid date local_segment_label", "n", "steps")
def dev_segments(t: Tables) -> DataFrame:
    """Minutes and steps per time segment, one of them past midnight and one overlapping."""
    segments = [("daily", 0, 1440), ("night", 1320, 480), ("morning", 360, 360)]
    labelled = sensors.assign_segments(sensors.minute_grid(t.minutes()), segments)
    return labelled.groupBy("pid", "date", "local_segment_label").agg(
        F.count("*").alias("n"), F.sum("steps").alias("steps")
    )


@query("pid date", spread("minuteson{z}zone", z="outofrange fatburn cardio peak"),
       spread("{s}hr", s="avg max min median mode std entropy diffmaxmode diffminmode"))
def dev_hr(t: Tables) -> DataFrame:
    return sensors.heart_rate_features(sensors.minute_grid(t.minutes()))


@query("pid", "", spread("{s}restinghr", s="avg max min median mode std entropy diffmaxmode "
                         "diffminmode"))  # fmt: skip
def dev_resting_hr(t: Tables) -> DataFrame:
    """Distribution over days of each day's lowest heart rate."""
    daily = sensors.minute_grid(t.minutes()).groupBy("pid", "date").agg(
        F.min("heartrate").alias("restinghr")
    )
    return sensors.resting_heart_rate_features(daily)


@query("pid date", "", "sumsteps maxsteps minsteps avgsteps stdsteps firststeptime laststeptime")
def dev_steps(t: Tables) -> DataFrame:
    return sensors.step_features(sensors.clean_steps(sensors.minute_grid(t.minutes())))


def _dense(t: Tables) -> DataFrame:
    return sensors.clean_steps(sensors.minute_grid(t.dense_minutes()))


BOUTS = spread("{s}{b}", s=" ".join(sensors.BOUT_STATS), b="sedentarybout activebout")


@query("pid date", "", BOUTS + " activetosedentarytransitionprobability "
       "sumdurationactivitylessthan5minutes sumdurationactivity5to10minutes "
       "sumdurationactivitygreaterthan10minutes ginicoefficient")
def dev_bouts(t: Tables) -> DataFrame:
    return sensors.bout_features(_dense(t))


NIGHTS = [("night", 1320, 480), ("late", 1410, 90), ("weekend", 1080, 3000)]


def _segmented(t: Tables) -> DataFrame:
    """Minutes of segments that end past midnight, one of them two days later."""
    return sensors.assign_segments(_dense(t), NIGHTS)


@query("pid date local_segment_label", "", "ratiovalidyieldedminutes ratiovalidyieldedhours")
def dev_segment_yield(t: Tables) -> DataFrame:
    """Yield over each segment's own hours, the last of which may be short."""
    segments = [*NIGHTS, ("dawn", 250, 100)]
    minutes = sensors.assign_segments(sensors.minute_grid(t.minutes()), segments)
    return sensors.data_yield(minutes, [*sensors.DAY, "local_segment_label"], min_ratio=2 / 60)


@query("pid date local_segment_label", "", BOUTS + " activetosedentarytransitionprobability "
       "sumdurationactivitylessthan5minutes sumdurationactivity5to10minutes "
       "sumdurationactivitygreaterthan10minutes ginicoefficient")
def dev_segment_bouts(t: Tables) -> DataFrame:
    """Bouts that go on over midnight within their segment."""
    return sensors.bout_features(_segmented(t), [*sensors.DAY, "local_segment_label"])


@query("pid date", "totalminutes0cadence totalminutes1to19cadence totalminutes20to39cadence "
       "totalminutesabove0cadence totalminutes120pluscadence totalminutesabove100cadence",
       "meancadence uncensoredmeancadence peak1minutecadence peak30minutecadence "
       "max5minutecadence max20minutecadence max60minutecadence")
def dev_cadence(t: Tables) -> DataFrame:
    return sensors.cadence_features(_dense(t), nonwear_minutes=2)


@query("pid", "", spread("{s}{m}", s="max min avg median std", m="sumsteps volatilitysteps")
       + " annualizedvolatilitysteps")
def dev_steps_summary(t: Tables) -> DataFrame:
    daily = sensors.step_features(sensors.clean_steps(sensors.minute_grid(t.minutes())))
    return sensors.steps_summary_features(daily)


SLEEP = spread(
    "{s}{k}", k="main nap all",
    s="firstwaketime lastwaketime firstbedtime lastbedtime countepisode avgefficiency "
    + spread("{a}duration{d}", a="sum avg", d="afterwakeup asleep awake tofallasleep inbed"),
)


@query("pid date", "", SLEEP)
def dev_sleep(t: Tables) -> DataFrame:
    return sensors.sleep_summary_features(t.sleep_episodes())


@query("pid date level type", "countepisode",
       spread("{s}duration", s="sum max min avg median std") + " "
       + spread("ratio{m}_{w}", m="count duration",
                w="across_all within_types within_levels across_levels across_types"))
def dev_sleep_stages(t: Tables) -> DataFrame:
    """Stage records up to six hours apart make a session here, since events are far between."""
    return sensors.sleep_stage_features(t.sleep_stages(), max_gap=6 * 3600)


CALORIES = (
    spread("{s}duration", s="sum avg min max std")
    + " starttimefirst endtimefirst starttimelast endtimelast starttimelongest endtimelongest "
    + spread("{s}{m}", s="sum avg max min std", m="met calories")
)


@query("pid date local_segment_label episode_type", "count", CALORIES)
def dev_segment_calories(t: Tables) -> DataFrame:
    """Episodes of activity that go on over midnight within their segment."""
    minutes = sensors.assign_segments(sensors.minute_grid(t.dense_minutes()), NIGHTS)
    return sensors.calorie_episode_features(minutes, [*sensors.DAY, "local_segment_label"])


@query("pid date episode_type", "count", CALORIES)
def dev_calories(t: Tables) -> DataFrame:
    return sensors.calorie_episode_features(sensors.minute_grid(t.dense_minutes()))
