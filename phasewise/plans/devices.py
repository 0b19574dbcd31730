"""Wearable features on the study calendar, averages, device compliance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewise.functions import dates, recode
from phasewise.functions.columns import keep_existing
from phasewise.functions.rowwise import percent, ratio
from phasewise.operators import filters
from phasewise.operators.aggregates import level_and_overall, stat_columns
from phasewise.operators.joins import left_join
from phasewise.operators.reshape import pivot_values

SEGMENT = [
    "local_segment_label",
    "local_segment_start_datetime",
    "local_segment_end_datetime",
]
THRESHOLD = "1/3"


def calendar_device_features(
    calendar: DataFrame,
    features: DataFrame,
    columns: Sequence[str],
    segments: Sequence[str] | None = None,
    min_yield: tuple[str, str | float] | None = None,
) -> DataFrame:
    """Study calendar with the wearable features of each day.

    Daily features by default; with ``segments`` (labels) every column is spread to
    ``<column>_<label>`` instead.  ``min_yield`` (column, threshold) drops poor rows first.
    """
    dated = features.withColumn("date", dates.local_date(F.col("local_segment_start_datetime")))
    dated = keep_existing(dated, ["pid", "date", *SEGMENT, *columns])
    if min_yield is not None:
        dated = filters.enough_yield(dated, *min_yield)
    if segments is None:
        dated = filters.one_segment(dated)
    else:
        values = [c for c in dated.columns if c not in ("pid", "date", "local_segment_label")]
        dated = pivot_values(dated, ["pid", "date"], "local_segment_label", segments, values)
    days = calendar.withColumn("pid", dates.participant_tag(F.col("record_id")))
    return left_join(days, dated, ["pid", "date"], null_safe=True)


def average_device_features(
    days: DataFrame, features: Sequence[str], yield_column: str, threshold: str | float = THRESHOLD
) -> DataFrame:
    """Feature statistics over days of sufficient wear, per participant by phase and overall."""
    marked = days.withColumn(
        "sufficient", recode.sufficient(F.col(yield_column), threshold)
    )
    worn = F.col("sufficient") == 1
    aggs = [
        F.count("*").alias("n_days"),
        F.sum("sufficient").alias("n_days_with_sufficient_data"),
        *[a for f in features for a in stat_columns(f, only=worn)],
    ]
    return level_and_overall(marked, ["record_id"], "phase", aggs)


def device_compliance(
    averages: DataFrame,
    yield_feature: str = "ratiovalidyieldedhours",
    threshold: str | float = THRESHOLD,
) -> DataFrame:
    """Share of days with sufficient wear."""
    share = ratio(F.col("n_days_with_sufficient_data"), F.col("n_days"))
    return averages.select(
        "record_id",
        "phase",
        "n_days",
        "n_days_with_sufficient_data",
        share.alias("prop_days_with_sufficient_data"),
        percent(share).alias("percent_days_with_sufficient_data"),
        F.lit(yield_feature).alias("data_yield_feature"),
        F.lit(recode.parse_threshold(threshold)).alias("data_yield_threshold"),
    )
