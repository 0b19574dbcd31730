"""Recoding values: labels, sentinels, flags, closed level sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIMEPOINTS = {"bl": 1, "mp": 2, "eos": 3}


def code_map(mapping: Mapping) -> Column:
    """A literal map from text code to text label."""
    return F.create_map(*[F.lit(str(x)) for x in chain.from_iterable(mapping.items())])


def code_text(col: Column) -> Column:
    """Text of a code; 1.0 read from a column with gaps is the same code as 1."""
    return F.regexp_replace(col.cast("string"), r"\.0$", "")


def recode_labels(df: DataFrame, mappings: Mapping[str, Mapping]) -> DataFrame:
    """Replace codes by labels in the columns that exist; unknown codes stay as they are."""
    present = {c: m for c, m in mappings.items() if c in df.columns}
    return df.withColumns(
        {
            c: F.coalesce(F.try_element_at(code_map(m), code_text(F.col(c))), code_text(F.col(c)))
            for c, m in present.items()
        }
    )


def timepoint_number(col: Column, order: Mapping[str, int] = TIMEPOINTS) -> Column:
    """Ordinal of a timepoint code, NULL for an unknown one."""
    out = F.lit(None).cast("int")
    for name, number in order.items():
        out = F.when(col == name, F.lit(number)).otherwise(out)
    return out


def sentinel_to_null(col: Column, sentinel) -> Column:
    return F.nullif(col, F.lit(sentinel))


def void_where(col: Column, condition: Column) -> Column:
    """NULL where the condition holds; where it is unknown the value is kept."""
    return F.when(condition, F.lit(None)).otherwise(col)


def note_flag(note: Column) -> Column:
    """0 for an empty note, else 1; a missing note also counts as 1."""
    return F.when(note == "", F.lit(0)).otherwise(F.lit(1))


def survey_phase(kind: Column) -> Column:
    """Study phase a survey kind belongs to: daily ones 1, morning and evening ones 2."""
    return F.when(kind == "DAILY", 1).when(kind.isin("MORNING", "EVENING"), 2)


def reconcile_flag(flag: Column, phase: Column, expected_phase: int) -> Column:
    """Missing in the expected phase means 0; present in another phase means unknown."""
    return (
        F.when((phase == expected_phase) & flag.isNull(), F.lit(0))
        .when((phase != expected_phase) & flag.isNotNull(), F.lit(None))
        .otherwise(flag)
    )


def surveys_expected(phase: Column) -> Column:
    return F.when(phase == 1, 1).when(phase == 2, 2)


def both_flags(a: Column, b: Column, applies: Column) -> Column:
    """1 if both are 1, 0 if either is 0, else unknown; unknown where it does not apply."""
    return F.when(applies & (a == 1) & (b == 1), 1).when(applies & ((a == 0) | (b == 0)), 0)


def either_flag(a: Column, b: Column, applies: Column) -> Column:
    """1 if either is 1, 0 if both are 0, else unknown; unknown where it does not apply."""
    return F.when(applies & ((a == 1) | (b == 1)), 1).when(applies & (a == 0) & (b == 0), 0)


def zero_where(col: Column, condition: Column) -> Column:
    """Fill a missing value with 0, only where the condition holds."""
    return F.when(condition & col.isNull(), F.lit(0)).otherwise(col)


def ownership(owner_id: Column, item_id: Column) -> Column:
    """``Custom`` for items whose id starts with the owner's id, else ``Default``."""
    return F.when(item_id.startswith(owner_id), "Custom").otherwise("Default")


def parse_threshold(value: str | float | int) -> float:
    """A number, or a fraction written as text such as ``1/3``."""
    return float(Fraction(value)) if isinstance(value, str) else float(value)


def sufficient(measure: Column, threshold: str | float | int) -> Column:
    """1 where the measure reaches the threshold, else 0; a missing measure is 0."""
    return F.coalesce(measure >= F.lit(parse_threshold(threshold)), F.lit(False)).cast("int")


def level_index(col: Column, levels: Sequence[str]) -> Column:
    """1-based position within an ordered level set, NULL when off the set."""
    return F.nullif(F.array_position(F.array(*map(F.lit, levels)), col).cast("int"), F.lit(0))


def close_levels(col: Column, levels: Sequence[str]) -> Column:
    """Values outside the level set become missing."""
    return F.when(col.isin(*levels), col)


def living_arrangement(combined: Column) -> Column:
    """Sentence-case living arrangement, ``With ...`` when a partner or children are named."""
    text = F.when(
        combined.rlike("Partner|Children"), F.concat(F.lit("With "), combined)
    ).otherwise(combined)
    return sentence_case(text)


def sentence_case(col: Column) -> Column:
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substr(col, F.lit(2))))


def yes_no(flag: Column) -> Column:
    """``Yes`` for 1, ``No`` for any other value, missing stays missing."""
    return F.when(flag.isNull(), F.lit(None)).when(flag == 1, "Yes").otherwise("No")
