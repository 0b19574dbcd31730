"""Questionnaire exports to scores per participant and timepoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewise.functions.columns import select_cols
from phasewise.functions.recode import TIMEPOINTS, timepoint_number
from phasewise.functions.rowwise import rescale, row_mean_strict, standardize
from phasewise.functions.text import last_token, separate, strip_pattern
from phasewise.operators.aggregates import strict_sum
from phasewise.operators.joins import merge_unique
from phasewise.operators.reshape import pivot_one, unpivot_long
from phasewise.operators.sets import stack
from phasewise.plans import codebook

ID = "record_id"
KEYS = [ID, "timepoint_name", "timepoint_number"]


def clean_outcomes(frames: Sequence[DataFrame], timepoints: Sequence[str] = tuple(TIMEPOINTS)):
    """Wide exports ``<measure>_<timepoint>`` to one row per participant and timepoint.

    Each export is unpivoted where it is read; the spread by measure is one aggregation.
    Unpivoting before joining replaces the join of the wide exports by the same shuffle.
    """
    suffix = "_(" + "|".join(timepoints) + ")$"
    long, measures = [], set()
    for df in frames:
        names = [c for c in df.columns if c != ID]
        part = unpivot_long(df, [ID], names, dtype="double")
        long.append(part.withColumn("timepoint_name", last_token(F.col("variable"))))
        measures |= {_measure(n, timepoints) for n in names}
    cells = stack(long).select(
        ID,
        "timepoint_name",
        timepoint_number(F.col("timepoint_name")).alias("timepoint_number"),
        strip_pattern(F.col("variable"), suffix).alias("variable"),
        "value",
    )
    return pivot_one(cells, KEYS, "variable", sorted(measures), "value")


def _measure(name: str, timepoints: Sequence[str]) -> str:
    stem, _, last = name.rpartition("_")
    return stem if last in timepoints else name


def domain_z_scores(promis: DataFrame) -> DataFrame:
    """Long z-scores of the default-calibrated t-scores, cognitive function left out."""
    parts = ["instrument", "domain", "score_type", "calibration_type", "timepoint"]
    long = separate(unpivot_long(promis, [ID], name="name", dtype="double"), "name", parts)
    chosen = long.filter(
        (F.col("score_type") == "t")
        & (F.col("domain") != "cf")
        & (F.col("calibration_type") == "default")
    )
    z = standardize(F.col("value"), codebook.T_MEAN, codebook.T_SD)
    return chosen.select(ID, "timepoint", "domain", z.alias("z"))


def pain_z_scores(pain: DataFrame) -> DataFrame:
    """Long z-scores of the 0-10 pain intensity item."""
    long = unpivot_long(pain, [ID], name="name", dtype="double")
    z = standardize(F.col("value"), codebook.PAIN_MEAN, codebook.PAIN_SD)
    return separate(long, "name", ["domain", "timepoint"]).select(
        ID, "timepoint", "domain", z.alias("z")
    )


def promis_summary_scores(
    promis: DataFrame,
    pain: DataFrame,
    weights: Sequence[tuple[str, float, float]] = codebook.SUMMARY_WEIGHTS,
) -> DataFrame:
    """Physical and mental health summary scores per participant and timepoint.

    One shuffle: the domains are spread by an aggregation, after which composites, weighted
    sums and the count of missing components are arithmetic within the row.
    """
    z = stack([domain_z_scores(promis), pain_z_scores(pain)])
    domains = ["pf", "pain", "social", "fatigue", "dep", "anxiety", "sleep", "global07"]
    wide = pivot_one(z, [ID, "timepoint"], "domain", domains, "z").withColumns(
        {
            "paincomposite": row_mean_strict([F.col("pain"), F.col("global07")]),
            "emotcomposite": row_mean_strict([F.col("dep"), F.col("anxiety")]),
        }
    )

    def weighted(position: int):
        return sum((F.col(w[0]) * w[position] for w in weights), F.lit(0.0))

    missing = sum((F.col(w[0]).isNull().cast("int") for w in weights), F.lit(0))
    physical, mental = weighted(1), weighted(2)
    return wide.select(
        ID,
        F.col("timepoint").alias("timepoint_name"),
        timepoint_number(F.col("timepoint")).alias("timepoint_number"),
        missing.alias("n_component_zscores_na"),
        physical.alias("promis_summary_physical_health_z"),
        mental.alias("promis_summary_mental_health_z"),
        rescale(physical, codebook.T_MEAN, codebook.T_SD).alias("promis_summary_physical_health_t"),
        rescale(mental, codebook.T_MEAN, codebook.T_SD).alias("promis_summary_mental_health_t"),
    )


def weighted_scores_long(z: DataFrame, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Weighted sums from long z-scores and a weight table (domain, weight_physical, ...).

    A missing component makes the sums missing; ``n_missing`` counts them.  Spark
    broadcasts the weight table if it is small.
    """
    joined = z.join(weights, "domain", "left")
    names = select_cols(weights, starts="weight_")
    return joined.groupBy(*keys).agg(
        F.count_if(F.col("z").isNull()).alias("n_missing"),
        *[strict_sum(F.col("z") * F.col(n)).alias(n.replace("weight_", "sum_")) for n in names],
    )


def analysis_outcomes(
    frames: Sequence[DataFrame], pattern: str = r"_score$|^promis_.*_t_|^promis_summary_.*_t$"
) -> DataFrame:
    """Score columns of several per-timepoint frames side by side, one row per timepoint."""
    merged = merge_unique(frames, KEYS)
    scores = select_cols(merged, matches=pattern)
    return merged.select(ID, F.col("timepoint_number").alias("timepoint"), *scores)
