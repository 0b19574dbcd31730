"""Coded demographics to one labelled row per participant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from phasewise.functions import choices, dates, recode
from phasewise.functions.columns import rename_by_patterns
from phasewise.operators.sets import stack_cohorts
from phasewise.plans import codebook


def clean_demographics(
    cohorts: Mapping[str, DataFrame],
    spellings: Sequence[tuple[str, str]] = codebook.COLUMN_SPELLINGS,
    categorical: Mapping[str, Mapping] = codebook.CATEGORICAL,
    multiple_choice: Mapping[str, Mapping] = codebook.MULTIPLE_CHOICE,
    date_suffixes: Sequence[str] = codebook.DATE_SUFFIXES,
    intervals: Sequence[tuple[str, str, str]] = codebook.INTERVALS,
) -> DataFrame:
    """Stack the cohorts, label codes, combine choices, build dates and elapsed times.

    Projections only: no shuffle.  Options are combined and counted as numbers, then turned
    into Yes and No.
    """
    people = stack_cohorts({c: rename_by_patterns(df, spellings) for c, df in cohorts.items()})
    people = dates.normalize_dates(people)
    people = recode.recode_labels(people, categorical)
    people = choices.name_options(people, multiple_choice)
    people = choices.combine_options(people, multiple_choice)
    people = choices.count_options(people, multiple_choice)
    people = choices.options_to_words(people, multiple_choice)
    people = dates.construct_dates(people, date_suffixes)
    for start, end, units in intervals:
        people = dates.with_interval(people, start, end, units)
    return people
