"""Paired t-tests, repeated-measures ANOVA and cohort comparisons.

All outcomes are tested in one job: Spark reduces participants to sufficient statistics per
outcome (counts, means, variances, covariances - combined map-side), and everything after
that is arithmetic on one row per outcome.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasewise.functions import distributions as dist
from phasewise.functions.columns import bind, require
from phasewise.functions.rowwise import with_differences
from phasewise.operators.joins import merge_unique
from phasewise.operators.ranks import mid_ranks, value_counts
from phasewise.operators.reshape import pivot_values, unpivot_long
from phasewise.sources.readers import phase_averages

# Cohen's (1988) bounds of effect size labels.
MAGNITUDES = ((0.2, "negligible"), (0.5, "small"), (0.8, "moderate"))
COMPARISONS = ((2, 1), (3, 1), (3, 2))
ADJUSTMENTS = ("none", "bonferroni", "holm", "hochberg", "BH", "BY")


def magnitude(d: Column) -> Column:
    """Label of an effect size."""
    size = F.abs(d)
    out = F.when(size.isNotNull(), F.lit("large"))
    for bound, label in reversed(MAGNITUDES):
        out = F.when(size < bound, F.lit(label)).otherwise(out)
    return out


# ---- paired t-test ---------------------------------------------------------------------


def outcomes_by_phase(
    averages: Sequence[DataFrame], outcomes: Sequence[str], keys: Sequence[str] = ("record_id",)
) -> DataFrame:
    """Per-phase averages merged and spread: ``<outcome>_phase1/2`` and their difference."""
    merged = merge_unique([phase_averages(a) for a in averages], [*keys, "study_phase"])
    wide = pivot_values(
        merged, keys, "study_phase", [1, 2], outcomes, template="{value}_phase{key}"
    )
    return with_differences(wide)


def paired_long(wide: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per participant and pair (outcome, x column, y column) with both values."""
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("outcome"),
                F.lit(x).alias("data_x"),
                F.lit(y).alias("data_y"),
                F.col(x).cast("double").alias("x"),
                F.col(y).cast("double").alias("y"),
            )
            for name, x, y in pairs
        ]
    )
    return wide.select(F.inline(cells)).filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def _t_results(stats: DataFrame, level: float = 0.95) -> DataFrame:
    """t, p, interval and effect size from n, mean and sd of the differences."""
    mean, sd, n = F.col("mean_difference"), F.col("__sd"), F.col("n")
    stats = stats.withColumns(
        {
            "stderr": sd / F.sqrt(n),
            "df": (n - 1).cast("double"),
            "effect_size_cohensd": F.try_divide(mean, sd),
        }
    )
    return stats.withColumns(
        {
            "t": F.try_divide(mean, F.col("stderr")),
            "__q": dist.t_quantile(level, F.col("df")),
            "effect_size_magnitude": magnitude(F.col("effect_size_cohensd")),
        }
    ).withColumns(
        {
            "p_value": dist.t_two_sided(F.col("t"), F.col("df")),
            "conf_int1": mean - F.col("__q") * F.col("stderr"),
            "conf_int2": mean + F.col("__q") * F.col("stderr"),
        }
    )


def paired_t_tests(wide: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Paired t-test of x against y per outcome, over the participants that have both."""
    require(wide, [c for _, x, y in pairs for c in (x, y)])
    x, y = F.col("x"), F.col("y")
    stats = (
        paired_long(wide, pairs)
        .groupBy("outcome", "data_x", "data_y")
        .agg(
            F.count("*").alias("n"),
            *[
                agg(c).alias(f"data_{name}_{stat}")
                for name, c in (("x", x), ("y", y))
                for stat, agg in (
                    ("mean", F.avg), ("sd", F.stddev_samp), ("min", F.min), ("max", F.max)
                )
            ],
            F.avg(x - y).alias("mean_difference"),
            F.stddev_samp(x - y).alias("__sd"),
        )
    )
    results = _t_results(stats).withColumns(
        {
            "method": F.lit("Paired t-test"),
            "alternative": F.lit("two.sided"),
            "null_value": F.lit(0.0),
        }
    )
    described = [f"data_{v}_{s}" for v in "xy" for s in ("mean", "sd", "min", "max")]
    return results.select(
        "outcome", "n", "data_x", "data_y", *described, "method", "alternative", "t", "df",
        "p_value", "conf_int1", "conf_int2", "mean_difference", "null_value", "stderr",
        "effect_size_cohensd", "effect_size_magnitude",
    )


# ---- repeated measures -----------------------------------------------------------------


def complete_profiles(
    df: DataFrame, outcomes: Sequence[str], time: str, id: str, times: Sequence
) -> DataFrame:
    """One row per outcome and participant with a column per timepoint, all of them present."""
    require(df, [id, time, *outcomes])
    wide = pivot_values(df, [id], time, times, outcomes, template="{value}@{key}")
    cells = F.array(
        *[
            F.struct(
                F.lit(o).alias("outcome"),
                *[F.col(f"`{o}@{k}`").cast("double").alias(f"y{i}") for i, k in enumerate(times)],
            )
            for o in outcomes
        ]
    )
    return wide.select(F.col(id).alias("id"), F.inline(cells)).dropna(
        subset=[f"y{i}" for i in range(len(times))]
    )


def _moments(profiles: DataFrame, k: int) -> DataFrame:
    """n, means, ranges, covariances and paired differences per outcome: the only shuffle."""
    y = [F.col(f"y{i}") for i in range(k)]
    aggs = [F.count("*").alias("n")]
    for i in range(k):
        aggs += [
            F.avg(y[i]).alias(f"m{i}"),
            F.stddev_samp(y[i]).alias(f"s{i}"),
            F.min(y[i]).alias(f"lo{i}"),
            F.max(y[i]).alias(f"hi{i}"),
            F.var_samp(y[i]).alias(f"v{i}{i}"),
        ]
    for i, j in combinations(range(k), 2):
        aggs += [
            F.covar_samp(y[i], y[j]).alias(f"v{i}{j}"),
            F.avg(y[j] - y[i]).alias(f"dm{i}{j}"),
            F.stddev_samp(y[j] - y[i]).alias(f"ds{i}{j}"),
        ]
    return profiles.groupBy("outcome").agg(*aggs)


def _cov(i: int, j: int) -> Column:
    return F.col(f"v{min(i, j)}{max(i, j)}")


def _total(terms) -> Column:
    out = F.lit(0.0)
    for t in terms:
        out = out + t
    return out


def _contrasts(k: int) -> list[list[float]]:
    """k - 1 orthonormal rows, each orthogonal to the constant (Helmert)."""
    rows = []
    for r in range(1, k):
        norm = (r * (r + 1)) ** 0.5
        rows.append([1 / norm] * r + [-r / norm] + [0.0] * (k - r - 1))
    return rows


def _determinant(m: list[list[Column]]) -> Column:
    """Determinant by cofactors along the first row; matrices here are (k-1) x (k-1), k small."""
    if len(m) == 1:
        return m[0][0]
    return _total(
        (m[0][j] if j % 2 == 0 else -m[0][j])
        * _determinant([row[:j] + row[j + 1 :] for row in m[1:]])
        for j in range(len(m))
    )


def _with_anova(stats: DataFrame, k: int) -> DataFrame:
    """Sums of squares from the covariance matrix S of the k timepoints.

    Between timepoints n * sum (m_i - m)^2; between participants (n - 1) / k * sum S_ij;
    error (n - 1) * (trace S - sum S_ij / k).
    """
    n = F.col("n")
    grand = _total(F.col(f"m{i}") for i in range(k)) / k
    trace = _total(_cov(i, i) for i in range(k))
    every = _total(_cov(i, j) for i in range(k) for j in range(k))
    stats = stats.withColumns(
        {
            "ss_time": n * _total((F.col(f"m{i}") - grand) ** 2 for i in range(k)),
            "ss_subject": (n - 1) / k * every,
            "ss_error": (n - 1) * (trace - every / k),
            "anova_DFn": F.lit(float(k - 1)),
            "anova_DFd": ((n - 1) * (k - 1)).cast("double"),
        }
    )
    f = F.try_divide(
        F.col("ss_time") / F.col("anova_DFn"), F.col("ss_error") / F.col("anova_DFd")
    )
    ges = F.try_divide(
        F.col("ss_time"), F.col("ss_time") + F.col("ss_subject") + F.col("ss_error")
    )
    return stats.withColumns({"anova_F": f, "anova_ges": ges}).withColumn(
        "anova_p", dist.f_sf(F.col("anova_F"), F.col("anova_DFn"), F.col("anova_DFd"))
    )


def _with_sphericity(stats: DataFrame, k: int) -> DataFrame:
    """Mauchly's W with its p-value, Greenhouse-Geisser and Huynh-Feldt epsilons."""
    p, c = k - 1, _contrasts(k)
    n = F.col("n")
    names = {}
    for a in range(p):
        for b in range(a, p):
            names[f"t{a}{b}"] = _total(
                F.lit(c[a][i] * c[b][j]) * _cov(i, j)
                for i in range(k) for j in range(k) if c[a][i] and c[b][j]
            )
    stats = stats.withColumns(names)
    t = [[F.col(f"t{min(a, b)}{max(a, b)}") for b in range(p)] for a in range(p)]
    trace = _total(t[a][a] for a in range(p))
    squares = _total(t[a][b] * t[a][b] for a in range(p) for b in range(p))
    gge = F.try_divide(trace * trace, p * squares)
    rho = 1 - F.try_divide(F.lit(2.0 * p * p + p + 2), 6 * p * (n - 1))
    stats = stats.withColumns(
        {
            "sphericity_W": F.try_divide(_determinant(t), F.pow(trace / p, F.lit(p))),
            "correction_GGe": gge,
            "__rho": rho,
        }
    )
    df = p * (p + 1) / 2 - 1
    x = -(n - 1) * F.col("__rho") * F.log("sphericity_W")
    p_value = dist.chi2_sf(x, F.lit(df))
    if p > 2:
        # Box's second-order term; it vanishes for three timepoints.
        top = (p + 2) * (p - 1) * (p - 2) * (2 * p**3 + 6 * p**2 + 3 * p + 2)
        w2 = F.try_divide(F.lit(float(top)), 288 * F.pow((n - 1) * p * F.col("__rho"), F.lit(2)))
        p_value = p_value + w2 * (dist.chi2_sf(x, F.lit(df + 4)) - p_value)
    gg = F.col("correction_GGe")
    hfe = F.try_divide(n * p * gg - 2, p * (n - 1 - p * gg))
    return stats.withColumns({"sphericity_p": p_value, "correction_HFe": hfe})


def _with_corrections(stats: DataFrame) -> DataFrame:
    out = stats
    for name, eps in (("GG", F.col("correction_GGe")), ("HF", F.col("correction_HFe"))):
        applied = F.least(eps, F.lit(1.0))
        df1, df2 = F.col("anova_DFn") * applied, F.col("anova_DFd") * applied
        out = out.withColumns(
            {
                f"correction_DFn_{name}": df1,
                f"correction_DFd_{name}": df2,
                f"correction_p_{name}": dist.f_sf(F.col("anova_F"), df1, df2),
            }
        )
    return out


def repeated_measures_anova(
    df: DataFrame, outcomes: Sequence[str], time: str, id: str, times: Sequence = (1, 2, 3)
) -> DataFrame:
    """One-way repeated-measures ANOVA of every outcome, one row each.

    Participants lacking a timepoint drop out of that outcome.  Columns: n, anova_*,
    sphericity_*, correction_*, and mean/sd/min/max per timepoint.
    """
    k = len(times)
    stats = _moments(complete_profiles(df, outcomes, time, id, times), k)
    return _anova_columns(stats, times).select("outcome", "n", *_anova_names(times))


ANOVA = (
    "anova_DFn", "anova_DFd", "anova_F", "anova_p", "anova_ges", "sphericity_W", "sphericity_p",
    "correction_GGe", "correction_DFn_GG", "correction_DFd_GG", "correction_p_GG",
    "correction_HFe", "correction_DFn_HF", "correction_DFd_HF", "correction_p_HF",
)


def _anova_columns(stats: DataFrame, times: Sequence) -> DataFrame:
    """ANOVA columns and summaries per timepoint beside the moments."""
    k = len(times)
    out = _with_corrections(_with_sphericity(_with_anova(stats, k), k))
    return out.withColumns(
        {
            f"{stat}_{t}": F.col(f"{short}{i}")
            for stat, short in (("mean", "m"), ("sd", "s"), ("min", "lo"), ("max", "hi"))
            for i, t in enumerate(times)
        }
    )


def _anova_names(times: Sequence) -> list[str]:
    return [*ANOVA, *[f"{s}_{t}" for s in ("mean", "sd", "min", "max") for t in times]]


def adjust_p(
    tests: DataFrame, p: str, group: Sequence[str], method: str = "none", into: str = "p_adj"
) -> DataFrame:
    """Correct p-values for the number of tests in each group.

    Step-down and step-up methods run over the ordered p-values of one group, which holds a
    row per comparison.
    """
    if method not in ADJUSTMENTS:
        raise ValueError(f"`method` must be one of: {', '.join(ADJUSTMENTS)}")
    value = F.col(p)
    if method == "none":
        return tests.withColumn(into, value)
    m = F.count(value).over(Window.partitionBy(*group))
    if method == "bonferroni":
        return tests.withColumn(into, F.least(value * m, F.lit(1.0)))
    upward = Window.partitionBy(*group).orderBy(F.col(p).asc_nulls_last())
    ranked = tests.withColumns({"__m": m, "__i": F.row_number().over(upward)})
    m, i = F.col("__m"), F.col("__i")
    if method == "holm":
        running = F.max(value * (m - i + 1)).over(upward.orderBy("__i"))
    else:
        scale = {
            "hochberg": m - i + 1,
            "BH": m / i,
            "BY": m / i * F.aggregate(
                F.sequence(F.lit(1).cast("long"), m), F.lit(0.0), lambda acc, k: acc + 1 / k
            ),
        }[method]
        running = F.min(value * scale).over(upward.orderBy(F.desc("__i")))
    out = F.when(value.isNotNull(), F.least(running, F.lit(1.0)))
    return ranked.withColumn(into, out).drop("__m", "__i")


def _pairwise_columns(
    stats: DataFrame,
    times: Sequence,
    comparisons: Sequence,
    p_adjust: str = "none",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Comparison rows (later, earlier) with the difference later minus earlier."""
    at = {t: i for i, t in enumerate(times)}
    cells = []
    for later, earlier in comparisons:
        i, j = at[earlier], at[later]
        sign = 1.0 if i < j else -1.0
        a, b = min(i, j), max(i, j)
        cells.append(
            F.struct(
                F.lit(str(earlier)).alias("ttest_group1"),
                F.lit(str(later)).alias("ttest_group2"),
                (F.lit(sign) * F.col(f"dm{a}{b}")).alias("mean_difference"),
                F.col(f"ds{a}{b}").alias("__sd"),
            )
        )
    rows = _t_results(stats.select("outcome", "n", *keep, F.inline(F.array(*cells))))
    return adjust_p(rows, "p_value", ["outcome"], p_adjust).select(
        "outcome",
        "n",
        *keep,
        "ttest_group1",
        "ttest_group2",
        F.col("mean_difference").alias("ttest_estimate"),
        F.col("t").alias("ttest_statistic"),
        F.col("df").alias("ttest_df"),
        F.col("p_value").alias("ttest_p"),
        F.col("conf_int1").alias("ttest_conf_low"),
        F.col("conf_int2").alias("ttest_conf_high"),
        F.col("p_adj").alias("ttest_p_adj"),
        F.lit(p_adjust).alias("p_adj_method"),
        "effect_size_cohensd",
        "effect_size_magnitude",
    )


def pairwise_t_tests(
    df: DataFrame,
    outcomes: Sequence[str],
    time: str,
    id: str,
    times: Sequence = (1, 2, 3),
    comparisons: Sequence[tuple] = COMPARISONS,
    p_adjust: str = "none",
) -> DataFrame:
    """Paired t-tests between chosen timepoints, unpooled."""
    stats = _moments(complete_profiles(df, outcomes, time, id, times), len(times))
    return _pairwise_columns(stats, times, comparisons, p_adjust)


def anova_with_comparisons(
    df: DataFrame,
    outcomes: Sequence[str],
    time: str,
    id: str,
    times: Sequence = (1, 2, 3),
    comparisons: Sequence[tuple] = COMPARISONS,
    p_adjust: str = "none",
) -> DataFrame:
    """ANOVA and pairwise tests together: one row per outcome and comparison."""
    stats = _moments(complete_profiles(df, outcomes, time, id, times), len(times))
    anova = _anova_columns(stats, times)
    rows = _pairwise_columns(anova, times, comparisons, p_adjust, keep=_anova_names(times))
    formula = F.concat(F.col("outcome"), F.lit(f" ~ {time}"))
    return rows.withColumns(
        {
            "anova_formula": F.concat(formula, F.lit(f" + Error({id}/{time})")),
            "ttest_formula": formula,
            "ttest_paired": F.lit(True),
            "ttest_poolsd": F.lit(False),
        }
    )


# ---- cohort comparison -----------------------------------------------------------------


def _exact_rank_sum() -> Column:
    """Chance of a rank sum at least as far from its mean, over all ways to choose the first group.

    Counted on whole numbers, twice the mid-ranks: ``ways`` holds, for every number of rows
    chosen so far and every sum, how often it comes about; each distinct value adds the choices among its ties.
    The smaller group is counted, whose sum is as far from its mean as the other's.
    """
    cells = F.transform(
        "cells", lambda c: F.struct(c["n"].alias("n"), (2 * c["rank"]).cast("long").alias("r"), c["k"].alias("k"))
    )
    rows = F.aggregate(cells, F.lit(0).cast("long"), lambda acc, c: acc + c["n"])
    chosen = F.aggregate(cells, F.lit(0).cast("long"), lambda acc, c: acc + c["k"])

    def counted(v) -> Column:
        few = F.least(v["chosen"], v["rows"] - v["chosen"])
        mine = lambda c: F.when(v["chosen"] <= few, c["k"]).otherwise(c["n"] - c["k"])
        seen = F.aggregate(v["cells"], F.lit(0).cast("long"), lambda acc, c: acc + mine(c) * c["r"])
        # No sum is larger than that of the last ranks, at most twice the rows each.
        return bind(v | {"few": few, "seen": seen, "width": 2 * v["rows"] * few + 1}, spread)

    def spread(v) -> Column:
        width, few = v["width"], v["few"]
        size = (few + 1) * width
        start = F.transform(F.sequence(F.lit(0).cast("long"), size - 1), lambda i: F.when(i == 0, 1.0).otherwise(0.0))

        def add(ways: Column, c: Column) -> Column:
            """Every place gets the ways to come there with t of the n ties, t = 0, 1, ..."""
            ties = F.aggregate(
                F.sequence(F.lit(1).cast("long"), c["n"]), F.array(F.lit(1.0)),
                lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) * (c["n"] - t + 1) / t)))

            def place(u, i: Column) -> Column:
                most = F.least(c["n"], F.floor(i / width))
                return F.aggregate(
                    F.sequence(F.lit(0).cast("long"), most), F.lit(0.0),
                    lambda acc, t: acc + u["ties"][t.cast("int")]
                    * F.when(i - t * (width + c["r"]) >= 0, u["ways"][F.greatest(i - t * (width + c["r"]), F.lit(0)).cast("int")])
                    .otherwise(0.0))

            return bind(
                {"ways": ways, "ties": ties},
                lambda u: F.transform(F.sequence(F.lit(0).cast("long"), size - 1), lambda i: place(u, i)),
            )

        last = F.slice(F.aggregate(v["cells"], start, add), (few * width + 1).cast("int"), width.cast("int"))
        # Twice the mean of the doubled sum is a whole number.
        centre = 2 * few * (v["rows"] + 1)
        far = F.abs(2 * v["seen"] - centre)
        return bind(
            {"last": last},
            lambda u: F.aggregate(
                F.transform(u["last"], lambda w, i: F.when(F.abs(2 * i - centre) >= far, w).otherwise(0.0)),
                F.lit(0.0), lambda acc, w: acc + w)
            / F.aggregate(u["last"], F.lit(0.0), lambda acc, w: acc + w))

    return bind({"cells": cells, "rows": rows, "chosen": chosen}, counted)


def rank_sum_tests(
    df: DataFrame,
    variables: Sequence[str],
    group: str,
    first: str,
    second: str,
    exact: bool = False,
) -> DataFrame:
    """Two-sample rank-sum test per variable: W of the first group.

    The p-value is the normal approximation with tie and continuity correction, or with ``exact``
    the chance, over all ways to choose the first group's rows, of a W at least as far from its
    mean, ties included.  That is meant for small samples: one row of the result takes steps in
    proportion to the rows cubed and the smaller group squared.  Rows: variable, n1, n2, statistic, p_value, method.
    """
    long = unpivot_long(df.select(group, *variables), [group], variables, dtype="double")
    long = long.filter(F.col(group).isin(first, second))
    # One row per distinct value with its rows in total and in the first group.
    cells = value_counts(long, "variable", "value", group)
    values = cells.groupBy("variable", "value").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col(group) == first, F.col("n")).otherwise(0)).alias("n_first"),
    )
    ranked = mid_ranks(values)
    n = F.col("n").cast("double")
    sums = ranked.groupBy("variable").agg(
        F.sum(F.col("n_first") * F.col("rank")).alias("__rank_sum"),
        F.sum("n_first").cast("double").alias("n1"),
        F.sum("n").cast("double").alias("__all"),
        F.sum(n * n * n - n).alias("__ties"),
        *([F.collect_list(F.struct("n", "rank", F.col("n_first").alias("k"))).alias("cells")] if exact else []),
    )
    n1, total = F.col("n1"), F.col("__all")
    n2 = total - n1
    w = F.col("__rank_sum") - n1 * (n1 + 1) / 2
    shift = w - n1 * n2 / 2
    spread = F.sqrt(
        n1 * n2 / 12 * ((total + 1) - F.try_divide(F.col("__ties"), total * (total - 1)))
    )
    z = F.try_divide(shift - F.signum(shift) * 0.5, spread)
    p = _exact_rank_sum() if exact else dist.normal_two_sided(F.col("__z"))
    kind = "exact" if exact else "normal approximation"
    return (
        sums.withColumns({"n2": n2, "statistic": w, "__z": z})
        .withColumn("p_value", p)
        .select(
            "variable",
            F.col("n1").cast("long").alias("n1"),
            F.col("n2").cast("long").alias("n2"),
            "statistic",
            "p_value",
            F.lit(f"Wilcoxon rank sum test, {kind}").alias("method"),
        )
    )


def cross_counts(df: DataFrame, variables: Sequence[str], group: str) -> DataFrame:
    """Rows per variable, level and group, missing values left out."""
    long = unpivot_long(df.select(group, *variables), [group], variables, dtype="string")
    return (
        long.filter(F.col("value").isNotNull() & F.col(group).isNotNull())
        .groupBy("variable", F.col("value").alias("level"), F.col(group).alias("by"))
        .agg(F.count("*").alias("n"))
    )


def chi_square_tests(counts: DataFrame) -> DataFrame:
    """Pearson chi-square without continuity correction, per variable.

    Rows: variable, statistic, df, min_expected, p_value.  Uses that the statistic equals
    N * (sum o^2 / (level total * stratum total) - 1), to which empty cells add nothing: a
    chain of three aggregates, by level, by stratum, by variable, without any join.
    """
    levels = counts.groupBy("variable", "level").agg(
        F.sum("n").cast("double").alias("level_n"),
        # One entry per stratum.
        F.collect_list(F.struct("by", F.col("n").cast("double").alias("n"))).alias("cells"),
    )
    cells = levels.select("variable", "level_n", F.posexplode("cells").alias("place", "cell"))
    o = F.col("cell.n")
    strata = cells.groupBy("variable", "cell.by").agg(
        F.sum(o * o / F.col("level_n")).alias("q"),
        F.sum(o).alias("stratum_n"),
        F.min("level_n").alias("least_level"),
        F.count_if(F.col("place") == 0).alias("n_levels"),
    )
    total = F.sum("stratum_n")
    return (
        strata.groupBy("variable")
        .agg(
            F.greatest(
                total * (F.sum(F.col("q") / F.col("stratum_n")) - 1), F.lit(0.0)
            ).alias("statistic"),
            ((F.sum("n_levels") - 1) * (F.count("*") - 1)).cast("double").alias("df"),
            (F.min("least_level") * F.min("stratum_n") / total).alias("min_expected"),
        )
        .withColumn("p_value", dist.chi2_sf(F.col("statistic"), F.col("df")))
    )


TIE = 1e-7  # tables up to this much likelier than the observed one count as equally likely


def _tilted(x: Column, n: Column) -> Column:
    """Log weight of giving x of n rows to the first group: n choose x, tilted by the group's share.

    The tilt is the same for every table with the observed margins, so it cancels; it keeps the logs small."""
    return dist.log_binomial(x.cast("double"), n.cast("double"), F.col("share"), F.col("other"))


def _likeliest(left: Column, rest: Column, others: Column) -> Column:
    """No way of giving `left` of the `rest` rows of the other levels to the first group weighs
    more, in logs, than this: each level at its own peak under the multiplier that fits."""
    p, q = left / rest, (rest - left) / rest

    def peak(r: Column) -> Column:
        return dist.log_binomial(F.least(F.floor((r + 1) * p), r).cast("double"), r.cast("double"), p, q)

    # The multiplier turns weights at share p into weights at the common share.
    turn = left * F.log(F.col("share") / p) + (rest - left) * F.log(F.col("other") / q)
    inside = F.aggregate(others, F.lit(0.0), lambda acc, r: acc + peak(r)) + turn
    ends = F.when(left == 0, rest * F.log(F.col("other"))).when(left == rest, rest * F.log(F.col("share")))
    return F.coalesce(ends.cast("double"), inside)


def _tail(x: Column, v: dict[str, Column]) -> Column:
    """Sum of the weights from x to `end`, away from the mode, over that of x.

    Neighbouring weights of two levels of a and b rows differ by a ratio of whole numbers, which
    falls away from the mode: after some multiple of the deviation the rest is below the last bit.
    ``down`` is 1 where `end` lies below the mode, else -1."""
    a, b, left, down = v["a"], v["b"], v["left"], v["down"]
    share = left / (a + b)
    spread = F.sqrt(share * (1 - share) * a * b / (a + b))
    steps = F.least(F.abs(x - v["end"]), F.ceil(12 * spread + 60).cast("double"))

    def step(s: Column, i: Column) -> Column:
        # The weight below y over that of y, where y is the upper one of the two neighbours.
        y = x - down * (i - 1) + F.when(down > 0, 0.0).otherwise(1.0)

        def taken(u) -> Column:
            below = u["y"] * (b - left + u["y"]) / ((a - u["y"] + 1) * (left - u["y"] + 1))
            ratio = F.when(down > 0, below).otherwise(F.try_divide(F.lit(1.0), below))
            return F.struct((u["term"] * ratio).alias("term"), (u["sum"] + u["term"]).alias("sum"))

        return bind({"y": y, "term": s["term"], "sum": s["sum"]}, taken)

    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    walk = F.transform(
        F.sequence(F.lit(1), F.greatest(steps, F.lit(1.0)).cast("long")), lambda i: i.cast("double")
    )
    total = F.aggregate(walk, start, step, lambda s: s["sum"] + s["term"])
    return F.when(steps < 1, 1.0).otherwise(total)


def _last_two(left: Column, a: Column, b: Column, limit: Column) -> Column:
    """Chance, given the past, of the ways to deal `left` to two last levels of a and b rows whose
    log weight is at most `limit`: both tails of one hypergeometric row, found by bisection."""
    given = {"a": a.cast("double"), "b": b.cast("double"), "left": left.cast("double"), "limit": limit}

    def weight(x: Column, v) -> Column:
        levels = F.array(*[F.struct(x_.alias("x"), n.alias("n")) for x_, n in ((x, v["a"]), (v["left"] - x, v["b"]))])
        return F.aggregate(levels, F.lit(0.0), lambda acc, s: acc + _tilted(s["x"], s["n"]))

    def edge(v) -> Column:
        """The place nearest to the mode, from `end`, whose weight is within the limit."""
        def halve(s: Column, _) -> Column:
            half = (s["good"] + s["bad"]) / 2
            middle = F.when(v["down"] > 0, F.floor(half)).otherwise(F.ceil(half)).cast("double")
            return bind({"m": middle, "g": s["good"], "b": s["bad"], "ok": weight(middle, v) <= v["limit"]},
                        lambda u: F.struct(F.when(u["ok"], u["m"]).otherwise(u["g"]).alias("good"),
                                           F.when(u["ok"], u["b"]).otherwise(u["m"]).alias("bad")))

        return F.aggregate(F.sequence(F.lit(1), F.lit(54)), F.struct(v["end"].alias("good"), v["mode"].alias("bad")),
                           halve, lambda s: s["good"])

    def mass(v) -> Column:
        inside = bind({"x": edge(v)}, lambda u: F.exp(weight(u["x"], v)) * _tail(u["x"], v))
        return F.when(weight(v["end"], v) <= v["limit"], inside).otherwise(0.0)

    def both(v) -> Column:
        every = F.exp(dist.log_binomial(v["left"], v["a"] + v["b"], F.col("share"), F.col("other")))
        sides = F.array(*[F.struct(v[end].alias("end"), F.lit(down).alias("down"))
                          for end, down in (("low", 1.0), ("high", -1.0))])
        tails = F.aggregate(sides, F.lit(0.0), lambda acc, s: acc + mass(v | {"end": s["end"], "down": s["down"]}))
        return F.when(weight(v["mode"], v) <= v["limit"], every).otherwise(tails)

    def ends(v) -> Column:
        mode = F.floor((v["left"] + 1) * (v["a"] + 1) / (v["a"] + v["b"] + 2)).cast("double")
        low, high = F.greatest(v["left"] - v["b"], F.lit(0.0)), F.least(v["a"], v["left"])
        return bind(v | {"low": low, "high": high, "mode": F.greatest(F.least(mode, high), low)}, both)

    return bind(given, ends)


def fisher_tests(
    counts: DataFrame, first: str, only_below: float | None = None, levels: int | None = None
) -> DataFrame:
    """Fisher's exact test of levels against two groups, per variable, for tables of any size.

    The p-value is the chance of all tables with the observed margins that are no likelier than
    the observed one.  They are never listed.  Levels are dealt one after the other, smallest
    first, over rows: a row says how many of the first group are left and how likely the levels
    so far made it; equal rows are merged with their number.  A row that no ending can lift above the
    observed table counts whole at once, one that is above it already counts nothing, and the last
    two levels are the two tails of one hypergeometric row.  A 2x2 table needs no dealing at all.

    ``levels`` is the largest number of levels of a variable, which sets the length of the plan;
    without it one small job reads it.  ``only_below`` skips variables whose smallest expected
    count is not below it.  Rows: variable, n_tables (with the margins; one level is left to the
    others, so larger ones may count tables that don't fit), p_value.  A variable of one level or one group has p = 1.
    """
    level = counts.groupBy("variable", "level").agg(
        F.sum("n").alias("r"),
        F.sum(F.when(F.col("by") == first, F.col("n")).otherwise(0)).alias("a"),
    ).filter("r > 0")
    total = level.groupBy("variable").agg(
        F.sum("a").alias("c1"),
        F.sum("r").alias("total"),
        # The levels of one variable, as many as its table has rows.
        F.sort_array(F.collect_list(F.struct("r", "level", "a"))).alias("rows"),
    )
    if only_below is not None:
        smaller = F.least(F.col("c1"), F.col("total") - F.col("c1"))
        total = total.filter(F.col("rows")[0]["r"] * smaller / F.col("total") < only_below)
    size = F.size("rows")
    free = F.slice("rows", F.lit(1), size - 1)  # the largest level is determined by the others
    chances = {
        "share": F.col("c1") / F.col("total"),
        "other": (F.col("total") - F.col("c1")) / F.col("total"),
        "sizes": F.transform("rows", lambda r: r["r"]),
        "n_tables": F.aggregate(
            free, F.lit(1.0), lambda acc, r: acc * (F.least(r["r"], F.col("c1")) + 1).cast("double")
        ),
    }
    known = total.withColumns(chances).withColumns(
        {
            "limit": F.aggregate("rows", F.lit(0.0), lambda acc, r: acc + _tilted(r["a"], r["r"])) + TIE,
            "base": dist.log_binomial(F.col("c1").cast("double"), F.col("total").cast("double"), F.col("share"), F.col("other")),
            "open": (size > 1) & (F.col("c1") > 0) & (F.col("c1") < F.col("total")),
        }
    ).drop("rows", "total")
    if levels is None:
        levels = (known.filter("open").agg(F.max(F.size("sizes"))).first()[0] or 2)  # one number

    keys = ["variable", "n_tables", "share", "other", "sizes", "limit", "base"]
    state = known.filter("open").select(
        *keys, F.col("c1").alias("left"), F.lit(0.0).alias("past"), F.lit(1.0).alias("ways"), F.lit(0.0).alias("sum"))
    for done in range(levels - 2):
        state = _dealt(state, done, keys)
    a, b = F.element_at("sizes", -2), F.element_at("sizes", -1)
    ending = F.when(F.col("left").isNotNull(), F.col("ways") * F.exp(F.col("past") - F.col("base"))
                    * _last_two(F.col("left"), a, b, F.col("limit") - F.col("past")))
    tested = state.withColumn("sum", F.col("sum") + F.coalesce(ending, F.lit(0.0))).groupBy("variable", "n_tables").agg(
        F.least(F.sum("sum"), F.lit(1.0)).alias("p_value"))
    trivial = known.filter("NOT open").select("variable", "n_tables", F.lit(1.0).alias("p_value"))
    return tested.unionByName(trivial)


def _dealt(state: DataFrame, done: int, keys: list[str]) -> DataFrame:
    """The next level of every variable that has more than two to come.  ``sum`` holds what is
    counted already; rows without ``left`` carry nothing else."""
    r = F.col("sizes")[done]
    others = F.slice("sizes", done + 2, F.size("sizes"))
    rest = F.aggregate(others, F.lit(0).cast("long"), lambda acc, n: acc + n)
    going = F.col("left").isNotNull() & (F.size("sizes") > done + 2)
    fitting = F.sequence(F.greatest(F.col("left") - rest, F.lit(0).cast("long")), F.least(r, F.col("left")))
    kept = F.lit(None).cast("long")
    dealt = state.withColumn("x", F.explode(F.when(going, fitting).otherwise(F.array(kept))))
    dealt = dealt.withColumns({"__r": r, "__others": others, "__rest": rest})
    moved = F.col("x").isNotNull()
    dealt = dealt.withColumn("past", F.when(moved, F.col("past") + _tilted(F.col("x"), F.col("__r"))).otherwise(F.col("past")))
    dealt = dealt.withColumn("left", F.when(moved, F.col("left") - F.col("x")).otherwise(F.col("left")))
    left, over = F.col("left").cast("double"), F.col("__rest").cast("double")
    whole = moved & (F.col("past") + _likeliest(left, over, F.col("__others")) <= F.col("limit"))
    # An ending has one arrangement at least, of which the tilt is what is left.
    least = left * F.log("share") + (over - left) * F.log("other")
    none = moved & (F.col("past") + least > F.col("limit"))
    every = F.col("ways") * F.exp(
        F.col("past") - F.col("base") + dist.log_binomial(left, over, F.col("share"), F.col("other")))
    dealt = dealt.withColumns({"__whole": whole, "__none": none})
    closed = F.col("__whole") | F.col("__none") | F.col("left").isNull()
    counted = F.when(F.col("__whole"), every).when(F.col("x").isNull(), F.col("sum")).otherwise(0.0)
    return (
        dealt.withColumns({"sum": counted, "ways": F.when(closed, 0.0).otherwise(F.col("ways"))})
        .withColumns({"left": F.when(~closed, F.col("left")), "past": F.when(~closed, F.col("past"))})
        .groupBy(*keys, "left", F.round("past", 9).alias("__past"))
        .agg(F.min("past").alias("past"), F.sum("ways").alias("ways"), F.sum("sum").alias("sum"))
        .drop("__past")
    )


def category_tests(
    df: DataFrame, variables: Sequence[str], group: str, first: str, levels: int | None = None
) -> DataFrame:
    """Chi-square where every expected count is at least 5, else Fisher's exact test.

    ``levels``: as in :func:`fisher_tests`.
    """
    counts = cross_counts(df, variables, group)
    chi = chi_square_tests(counts)
    exact = fisher_tests(counts, first, only_below=5, levels=levels).select(
        "variable", F.col("p_value").alias("__exact")
    )
    sparse = F.col("min_expected") < 5
    return chi.join(exact, "variable", "left").select(
        "variable",
        F.when(sparse, F.col("__exact")).otherwise(F.col("p_value")).alias("p_value"),
        F.when(sparse, "Fisher's exact test")
        .otherwise("Pearson's Chi-squared test")
        .alias("method"),
    )
