"""Multiple-choice questions stored as one 0/1 column per option."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewise.functions.columns import select_cols
from phasewise.functions.text import pretty_join

Options = Mapping[str, Mapping]


def name_options(df: DataFrame, questions: Options) -> DataFrame:
    """``<question>___<code>`` becomes ``<question>_<label>``."""
    renames = {f"{q}___{k}": f"{q}_{v}" for q, codes in questions.items() for k, v in codes.items()}
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def option_columns(df: DataFrame, question: str) -> list[str]:
    return select_cols(df, starts=question, excluding="combined")


def _chosen(df: DataFrame, name: str) -> Column:
    """Whether an option was ticked, as the number 1 or the word Yes."""
    return F.coalesce(F.col(f"`{name}`").cast("string").isin("1", "1.0", "Yes"), F.lit(False))


def combine_options(
    df: DataFrame, questions: Options, sort: bool = False, other_last: bool = True
) -> DataFrame:
    """One text per row naming the chosen options, ``<question>_combined``."""
    added = {}
    for question in questions:
        names = option_columns(df, question)
        if names:
            ticked = F.array(*[F.when(_chosen(df, n), F.lit(n)) for n in names])
            added[f"{question}_combined"] = pretty_join(
                F.array_compact(ticked), prefix=question, sort=sort, other_last=other_last
            )
    return df.withColumns(added)


def count_options(df: DataFrame, questions: Options) -> DataFrame:
    """Number of chosen options, ``<question>_combined_n_choices``."""
    added = {}
    for question in questions:
        ticks = [_chosen(df, n).cast("int") for n in option_columns(df, question)]
        added[f"{question}_combined_n_choices"] = reduce(lambda a, b: a + b, ticks, F.lit(0))
    return df.withColumns(added)


def options_to_words(df: DataFrame, questions: Options) -> DataFrame:
    """0 and 1 in the option columns become No and Yes; other values stay."""
    added = {}
    for question in questions:
        for name in option_columns(df, question):
            text = F.regexp_replace(F.col(f"`{name}`").cast("string"), r"\.0$", "")
            added[name] = F.when(text == "0", "No").when(text == "1", "Yes").otherwise(text)
    return df.withColumns(added)
