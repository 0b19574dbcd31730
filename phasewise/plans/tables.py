"""Descriptive and result tables as ordinary DataFrames.

Rows carry ``row_order``; sort by it to print.  A summary table is one aggregation over the
input, whatever the number of variables: every statistic and every level count is an
aggregate of its own, combined map-side, and the single result row is spread into table rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewise.functions import text
from phasewise.functions.columns import drop_matching, map_columns, select_cols
from phasewise.functions.recode import close_levels, code_map, living_arrangement, yes_no
from phasewise.functions.rowwise import percent, ratio
from phasewise.operators.reshape import insert_headers, pivot_values
from phasewise.operators.sets import stack
from phasewise.plans import codebook
from phasewise.plans.inference import category_tests, rank_sum_tests

STEP = 1000.0


@dataclass(frozen=True)
class Continuous:
    """A number shown as ``mean (sd) [min, max]``."""

    name: str
    label: str
    digits: tuple[int, int, int, int] = (1, 1, 0, 0)
    indent: str = ""


@dataclass(frozen=True)
class Categorical:
    """A closed level set shown as ``n (p%)`` per level."""

    name: str
    label: str
    levels: tuple[str, ...]
    indent: str = ""


Variable = Continuous | Categorical


def _aggregates(i: int, v: Variable) -> list[Column]:
    value = F.col(f"`{v.name}`")
    if isinstance(v, Continuous):
        value = value.cast("double")
        return [
            F.count(value).alias(f"v{i}_n"),
            F.count_if(value.isNull()).alias(f"v{i}_na"),
            F.avg(value).alias(f"v{i}_mean"),
            F.stddev_samp(value).alias(f"v{i}_sd"),
            F.min(value).alias(f"v{i}_min"),
            F.max(value).alias(f"v{i}_max"),
        ]
    levels = [F.count_if(value == lv).alias(f"v{i}_l{j}") for j, lv in enumerate(v.levels)]
    known = value.isin(*v.levels)
    return [
        F.count_if(known).alias(f"v{i}_n"),
        F.count_if(~F.coalesce(known, F.lit(False))).alias(f"v{i}_na"),
        *levels,
    ]


def _row(v: Variable, order: float, kind: str, label: str, **numbers: Column) -> Column:
    """One table row in numbers; texts are made once, after the rows are spread."""
    digits = v.digits if isinstance(v, Continuous) else (None,) * 4
    fields = ("n", "total", "mean", "sd", "low", "high")
    absent = F.lit(None).cast("double")
    return F.struct(
        F.lit(v.name).alias("variable"),
        F.lit(kind).alias("row_type"),
        F.lit(v.indent + label).alias("label"),
        F.lit(order).alias("row_order"),
        *[numbers.get(f, absent).cast("double").alias(f) for f in fields],
        *[F.lit(d).cast("int").alias(f"d{i}") for i, d in enumerate(digits)],
    )


def _rows(i: int, v: Variable, missing: bool) -> list[Column]:
    at = (i + 1) * STEP
    n = F.col(f"v{i}_n")
    if isinstance(v, Continuous):
        mean, sd, low, high = (F.col(f"v{i}_{s}") for s in ("mean", "sd", "min", "max"))
        rows = [_row(v, at, "label", v.label, n=n, mean=mean, sd=sd, low=low, high=high)]
    else:
        rows = [_row(v, at, "label", v.label, n=n)]
        for j, level in enumerate(v.levels):
            rows.append(_row(v, at + j + 1, "level", level, n=F.col(f"v{i}_l{j}"), total=n))
    if missing:
        rows.append(_row(v, at + STEP - 1, "missing", "Unknown", n=F.col(f"v{i}_na")))
    return rows


def _spread_rows(stats: DataFrame, variables: Sequence[Variable], missing: bool) -> DataFrame:
    """The one row of statistics (per stratum) as table rows with their text."""
    cells = F.array(*[r for i, v in enumerate(variables) for r in _rows(i, v, missing)])
    strata = [c for c in stats.columns if c == "__by"]
    long = stats.select(*strata, F.inline(cells))
    numbers = [F.col(c) for c in ("mean", "sd", "low", "high")]
    digits = [F.col(f"d{i}") for i in range(4)]
    kind = F.col("row_type")
    stat = (
        F.when(kind == "missing", text.fixed(F.col("n"), 0))
        .when(kind == "level", text.count_text(F.col("n"), F.col("total")))
        .when(F.col("d0").isNotNull(), text.summary_text(*numbers, digits=digits))
    )
    return long.select(
        *strata, "variable", kind, "label", "row_order", F.col("n").cast("long").alias("n"),
        stat.alias("stat"),
    )


def summary_table(
    df: DataFrame,
    variables: Sequence[Variable],
    by: str | None = None,
    by_levels: Sequence[str] = (),
    missing: bool = True,
    tests: bool = False,
) -> DataFrame:
    """Descriptive table: variable, row_type, label, row_order, n and stat per stratum, p_value.

    Strata are ``n_1, stat_1, ...`` in the order of ``by_levels``, or ``n_0, stat_0`` without
    ``by``.  A row counting missing values appears where there are any, unless ``missing`` is
    off.  ``tests`` (two strata) adds rank-sum or chi-square/Fisher p-values.
    """
    aggs = [a for i, v in enumerate(variables) for a in _aggregates(i, v)]
    ids = ["variable", "row_type", "label", "row_order"]
    if by is None:
        table = _spread_rows(df.agg(*aggs), variables, missing).withColumnsRenamed(
            {"n": "n_0", "stat": "stat_0"}
        )
        shown = F.col("n_0") > 0
    else:
        strata = df.filter(F.col(by).isin(*by_levels)).groupBy(F.col(by).alias("__by")).agg(*aggs)
        long = _spread_rows(strata, variables, missing)
        place = {level: i + 1 for i, level in enumerate(by_levels)}
        table = pivot_values(
            long, ids, "__by", by_levels, ["n", "stat"],
            template=lambda value, key: f"{value}_{place[key]}",
        )
        shown = sum((F.coalesce(F.col(f"n_{i}"), F.lit(0)) for i in place.values()), F.lit(0)) > 0
    table = table.filter((F.col("row_type") != "missing") | shown)
    if tests:
        table = _attach_tests(table, df, variables, by, by_levels)
    return table


def _attach_tests(
    table: DataFrame, df: DataFrame, variables: Sequence[Variable], by: str, levels: Sequence[str]
) -> DataFrame:
    numbers = [v.name for v in variables if isinstance(v, Continuous)]
    groups = [v for v in variables if isinstance(v, Categorical)]
    results = []
    if numbers:
        results.append(rank_sum_tests(df, numbers, by, *levels).select("variable", "p_value"))
    if groups:
        closed = df.filter(F.col(by).isin(*levels)).withColumns(
            {v.name: close_levels(F.col(f"`{v.name}`"), v.levels) for v in groups}
        )
        names = [v.name for v in groups]
        results.append(category_tests(closed, names, by, levels[0]).select("variable", "p_value"))
    # One row per variable of the table.
    p = stack(results)
    joined = table.join(p, "variable", "left")
    return joined.withColumn("p_value", F.when(F.col("row_type") == "label", F.col("p_value")))


def header_rows(
    table: DataFrame, headers: Sequence[tuple[float, str, str]]
) -> DataFrame:
    """Header rows (row_order, variable, label) to insert into a table."""
    spark = table.sparkSession
    rows = [(float(o), v, label, "header") for o, v, label in headers]
    return spark.createDataFrame(rows, "row_order double, variable string, label string, row_type string")


def with_headers(
    table: DataFrame, variables: Sequence[Variable], headers: Sequence[tuple[str, str]]
) -> DataFrame:
    """Insert each header before the first variable whose name starts with its key."""
    rows = []
    for key, label in headers:
        first = next((i for i, v in enumerate(variables) if v.name.startswith(key)), None)
        if first is not None:
            rows.append(((first + 1) * STEP - 0.5, key, label))
    return insert_headers(table, header_rows(table, rows))


# ---- participants ----------------------------------------------------------------------


def characteristics_frame(demographics: DataFrame) -> DataFrame:
    """Cleaned demographics in the form the characteristics table describes."""
    named = F.try_element_at(code_map(codebook.COHORT_NAMES), F.col("cohort"))
    living = living_arrangement(F.col("living_combined"))
    return demographics.withColumns(
        {"cohort": named, "race": F.col("race_combined"), "living": living}
    )


def participant_characteristics(demographics: DataFrame, tests: bool = True) -> DataFrame:
    """Characteristics by cohort with p-values; treatments under a header of their own."""
    people = characteristics_frame(demographics)
    options = select_cols(people, starts="cancer_treatment_", excluding="combined")
    variables: list[Variable] = []
    for name in ("age", "gender", "race", "marital", "living", "employment", "education",
                 "cancer_category_participant", "cancer_status"):
        label = codebook.CHARACTERISTIC_LABELS[name]
        if name in codebook.LEVELS:
            variables.append(Categorical(name, label, tuple(codebook.LEVELS[name])))
        else:
            variables.append(Continuous(name, label))
    for name in options:
        label = name.removeprefix("cancer_treatment_")
        variables.append(Categorical(name, label, ("Yes", "No"), indent="\t"))
    spans = select_cols(people, starts="months_") + select_cols(people, starts="days_")
    for name in [*spans, "dhls_score"]:
        variables.append(Continuous(name, codebook.CHARACTERISTIC_LABELS.get(name, name)))
    table = summary_table(
        people, variables, by="cohort", by_levels=codebook.LEVELS["cohort"], tests=tests
    )
    return with_headers(table, variables, [("cancer_treatment", codebook.TREATMENT_HEADER)])


def phase0_feedback(feedback: DataFrame) -> DataFrame:
    variables = [Continuous(n, label) for n, label in codebook.PHASE0_FEEDBACK_LABELS.items()]
    return summary_table(feedback, variables)


def phase1_feedback(feedback: DataFrame) -> DataFrame:
    """Scale scores without the raw usability items, under three headers."""
    scored = drop_matching(feedback, r"^sus[1-9.*]")
    scored = map_columns(scored, ["data_sharing_others_score"], yes_no)
    variables: list[Variable] = []
    for name, label in codebook.PHASE1_FEEDBACK_LABELS.items():
        if name == "data_sharing_others_score":
            variables.append(Categorical(name, label, ("Yes", "No")))
        else:
            under = any(name.startswith(k) for k, _ in codebook.PHASE1_FEEDBACK_HEADERS)
            variables.append(Continuous(name, label, indent="\t" if under else ""))
    return with_headers(
        summary_table(scored, variables), variables, codebook.PHASE1_FEEDBACK_HEADERS
    )


# ---- compliance and engagement ---------------------------------------------------------


def survey_compliance_table(compliance: DataFrame) -> DataFrame:
    """Completion rates in percent."""
    rates = select_cols(compliance, starts="rate")
    scaled = map_columns(compliance.select("record_id", *rates), rates, percent)
    labels = codebook.SURVEY_RATE_LABELS
    variables = [Continuous(r, labels.get(r, r), (2, 2, 2, 2), indent="\t") for r in rates]
    return with_headers(
        summary_table(scaled, variables), variables, codebook.SURVEY_COMPLIANCE_HEADERS
    )


def device_compliance_table(compliance: DataFrame) -> DataFrame:
    """Percent of days with sufficient wear: overall and per phase."""
    phase = F.when(F.col("phase") == "overall", "Overall").otherwise(
        F.concat(F.lit("Phase "), F.col("phase"))
    )
    measure = "percent_days_with_sufficient_data"
    levels = ["Overall", "Phase 1", "Phase 2"]
    wide = pivot_values(
        compliance.withColumn("phase", phase), ["record_id"], "phase", levels, [measure]
    )
    variables = [
        Continuous(f"{measure}_{level}", level, digits=(2, 2, 2, 2), indent="\t")
        for level in levels
    ]
    table = summary_table(wide, variables)
    return with_headers(table, variables, [(measure, codebook.DEVICE_COMPLIANCE_HEADER)])


def combined_compliance_table(surveys: DataFrame, devices: DataFrame) -> DataFrame:
    """Survey compliance over device compliance."""
    top = survey_compliance_table(surveys)
    bottom = device_compliance_table(devices)
    return stack([top, bottom.withColumn("row_order", F.col("row_order") + 1_000_000)])


def engagement_frame(engagement: DataFrame) -> DataFrame:
    """Engagement statistics with shares added and rates in percent (counts left alone)."""
    shares = {
        "selected_phase1_custom_prop": ("selected_phase1_custom", "selected_phase1_all"),
        "selected_phase2_custom_prop": ("selected_phase2_custom", "selected_phase2_all"),
        "selected_phase2_not_phase1_all_prop": (
            "selected_phase2_not_phase1_all", "selected_phase2_all",
        ),
    }
    added = engagement.withColumns({n: ratio(F.col(a), F.col(b)) for n, (a, b) in shares.items()})
    rates = [c for c in select_cols(added, matches=r"_rate_|_prop$") if not c.endswith("_n")]
    return map_columns(added, rates, percent)


def activity_engagement_table(engagement: DataFrame) -> DataFrame:
    """Selection, endorsement, planning and completion over participants."""
    variables = [
        Continuous(n, label, (1, 1, 1, 1) if "mean" in n else (1, 1, 0, 0), indent="\t\t")
        for n, label in codebook.ENGAGEMENT_LABELS.items()
    ]
    frame = engagement_frame(engagement)
    table = summary_table(frame, variables, missing=False)
    order = {v.name: (i + 1) * STEP for i, v in enumerate(variables)}
    headers = [
        (order[first] - 0.5 + j / 10, first, label)
        for first, labels in codebook.ENGAGEMENT_HEADERS
        for j, label in enumerate(labels)
    ]
    return insert_headers(table, header_rows(table, headers))


# ---- test results ----------------------------------------------------------------------


def ttest_table(results: DataFrame) -> DataFrame:
    """Paired t-tests for print: y is phase 1, x is phase 2."""
    name = text.name_by_pattern(F.col("outcome"), codebook.TTEST_NAMES)
    stat = text.name_by_pattern(F.col("outcome"), codebook.TTEST_STATS)

    def side(v: str) -> dict[str, Column]:
        phase = F.regexp_replace(F.regexp_extract(f"data_{v}", "_(phase[0-9]+)$", 1), "phase", "Phase ")
        return {
            f"data_{v}_label": phase,
            f"data_{v}_mean": F.round(f"data_{v}_mean", 2),
            f"data_{v}_sd": F.round(f"data_{v}_sd", 2),
            f"data_{v}_range": text.range_text(F.col(f"data_{v}_min"), F.col(f"data_{v}_max")),
        }

    return results.select(
        F.concat(name, F.lit(", "), stat).alias("outcome_str"),
        "n",
        *[c.alias(k) for v in "yx" for k, c in side(v).items()],
        F.round("mean_difference", 2).alias("mean_difference"),
        F.round("t", 2).alias("t"),
        "df",
        text.p_text(F.col("p_value")).alias("p_str"),
        F.round("effect_size_cohensd", 2).alias("effect_size_cohensd"),
        text.significant(F.col("p_value")).alias("significant"),
    )


def _outcome_names(col: Column, names: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Display name and position of an outcome."""
    label = text.name_by_pattern(col, names)
    order = text.name_by_pattern(col, [(p, str(i)) for i, (p, _) in enumerate(names)])
    shown = F.when(col.startswith("promis"), F.concat(F.lit("PROMIS "), label)).otherwise(label)
    return shown, order.cast("double")


def anova_table(
    results: DataFrame,
    times: Sequence = (1, 2, 3),
    names: Sequence[tuple[str, str]] = codebook.ANOVA_NAMES,
    alpha: float = 0.05,
) -> DataFrame:
    """Repeated-measures results for print: one row per outcome under instrument headers.

    Greenhouse-Geisser values replace the plain ones where sphericity is rejected.  Missing
    texts are empty.
    """
    shown, order = _outcome_names(F.col("outcome"), names)
    stats = {
        f"summarystat_t{t}": F.concat(
            text.plain_number(F.col(f"mean_{t}")), F.lit(" ("),
            text.plain_number(F.col(f"sd_{t}")), F.lit(") ["),
            text.range_text(F.col(f"min_{t}"), F.col(f"max_{t}")), F.lit("]"),
        )
        for t in times
    }
    corrected = F.coalesce(F.col("sphericity_p") < alpha, F.lit(False))

    def chosen(plain: str, gg: str) -> Column:
        return F.when(corrected, F.col(gg)).otherwise(F.col(plain))

    df = F.concat(
        text.plain_number(chosen("anova_DFn", "correction_DFn_GG")), F.lit(", "),
        text.plain_number(chosen("anova_DFd", "correction_DFd_GG")),
    )
    p = chosen("anova_p", "correction_p_GG")
    pair = F.concat(F.lit("t"), "ttest_group1", F.lit("_to_t"), "ttest_group2")
    rows = results.withColumns(
        {
            "outcome_name": shown,
            "row_order": order,
            **stats,
            "anova_correction_applied": corrected.cast("int"),
            "anova_df": df,
            "anova_f": text.plain_number(F.col("anova_F")),
            "anova_p_str": text.p_text(p),
            "anova_ges": text.small_effect_text(F.col("anova_ges")),
            "anova_significant": text.significant(p, alpha),
            "pair": pair,
            "ttest_estimate": text.plain_number(F.col("ttest_estimate")),
            "ttest_df": text.plain_number(F.col("ttest_df")),
            "ttest_statistic": text.plain_number(F.col("ttest_statistic")),
            "ttest_p_str": text.p_text(F.col("ttest_p")),
            "ttest_cohensd": text.plain_number(F.col("effect_size_cohensd")),
        }
    )
    fixed_cols = [
        "outcome_name", "row_order", "n", *stats, "anova_correction_applied", "anova_df",
        "anova_f", "anova_p_str", "anova_ges", "anova_significant",
    ]
    pairs = [f"t{a}_to_t{b}" for i, a in enumerate(times) for b in times[i + 1 :]]
    measures = ["ttest_estimate", "ttest_df", "ttest_statistic", "ttest_p_str", "ttest_cohensd"]
    table = pivot_values(rows, fixed_cols, "pair", pairs, measures)
    headers = _anova_headers(names)
    return _indent_outcomes(_blank_texts(insert_headers(table, _named_headers(table, headers))))


def _anova_headers(names: Sequence[tuple[str, str]]) -> list[tuple[float, str]]:
    summary = [i for i, (_, label) in enumerate(names) if label.startswith("Summary")]
    subscale = [i for i, (p, _) in enumerate(names) if p.startswith("promis")]
    heads = [(subscale, codebook.ANOVA_SUBSCALE_HEADER), (summary, codebook.ANOVA_SUMMARY_HEADER)]
    return [(at[0] - 0.5, label) for at, label in heads if at]


def _named_headers(table: DataFrame, headers: Sequence[tuple[float, str]]) -> DataFrame:
    rows = [(float(o), label) for o, label in headers]
    return table.sparkSession.createDataFrame(rows, "row_order double, outcome_name string")


def _indent_outcomes(table: DataFrame) -> DataFrame:
    name = F.col("outcome_name")
    bare = F.regexp_replace(name, "^PROMIS (Summary )?", "\t")
    return table.withColumn(
        "outcome_name", F.when(name.endswith("t-score"), name).otherwise(bare)
    )


def _blank_texts(table: DataFrame) -> DataFrame:
    texts = [c for c, t in table.dtypes if t == "string" and c != "outcome_name"]
    return table.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in texts})


def labelled(df: DataFrame, column: str, labels: Mapping[str, str]) -> DataFrame:
    """Replace variable names by labels, names without a label staying as they are."""
    shown = F.try_element_at(code_map(labels), F.col(column))
    return df.withColumn(column, F.coalesce(shown, F.col(column)))
