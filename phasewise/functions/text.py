"""Text parsing, list joining and number formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewise.functions.columns import bind
from phasewise.functions.recode import sentence_case


def strip_pattern(col: Column, pattern: str) -> Column:
    return F.regexp_replace(col, pattern, "")


def last_token(col: Column, sep: str = "_") -> Column:
    return F.element_at(F.split(col, sep), -1)


def separate(df: DataFrame, column: str, into: Sequence[str], sep: str = "_") -> DataFrame:
    """Split a text column into named parts.

    Surplus parts are dropped and missing ones are NULL.
    """
    parts = F.split(F.col(column), sep)
    return df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(into)}).drop(column)


def pretty_join(
    items: Column, prefix: str | None = None, sort: bool = False, other_last: bool = False
) -> Column:
    """``A, B & C`` from an array of text."""
    if prefix is not None:
        items = F.transform(items, lambda x: F.regexp_replace(x, f"^{prefix}_", ""))
    if sort:
        items = F.array_sort(items)
    if other_last:
        items = bind({"items": items}, lambda v: _other_last(v["items"]))
    return bind({"items": items, "n": F.size(items)}, lambda v: _in_words(v["items"], v["n"]))


def _other_last(items: Column) -> Column:
    is_other = lambda x: x.rlike("(Other|other)$")
    return F.concat(F.filter(items, lambda x: ~is_other(x)), F.filter(items, is_other))


def _in_words(items: Column, n: Column) -> Column:
    head = F.slice(items, F.lit(1), F.greatest(n - 2, F.lit(0)))
    tail = F.slice(items, F.greatest(n - 1, F.lit(1)), F.lit(2))
    lead = F.when(n > 2, F.concat(F.array_join(head, ", "), F.lit(", "))).otherwise("")
    return F.concat(lead, F.array_join(tail, " & "))


def clean_label(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Ordered regex replacements, then sentence case."""
    for pattern, replacement in rules:
        col = F.regexp_replace(col, pattern, replacement)
    return sentence_case(col)


def name_by_pattern(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first pattern found in the text, NULL when none is."""
    out = F.lit(None).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(col.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def fixed(col: Column, decimals: int | Column) -> Column:
    """Fixed number of decimals with thousands separators."""
    places = decimals if isinstance(decimals, Column) else F.lit(decimals)
    return F.call_function("format_number", col.cast("double"), places)


def plain_number(col: Column, decimals: int = 2) -> Column:
    """At most ``decimals`` decimals, no trailing zeros, no separators."""
    return F.call_function("format_number", col.cast("double"), F.lit("0." + "#" * decimals))


def p_text(p: Column) -> Column:
    """p-value to three decimals, ``<0.001`` and ``>0.999`` at the ends."""
    r = F.round(p, 3)
    return F.when(r < 0.001, "<0.001").when(r > 0.999, ">0.999").otherwise(r.cast("string"))


def small_effect_text(effect: Column) -> Column:
    r = F.round(effect, 3)
    return F.when(r < 0.001, "<0.001").otherwise(r.cast("string"))


def range_text(low: Column, high: Column, decimals: int = 2) -> Column:
    return F.concat(plain_number(low, decimals), F.lit(", "), plain_number(high, decimals))


def summary_text(
    mean: Column,
    sd: Column,
    low: Column,
    high: Column,
    digits: Sequence[int | Column] = (1, 1, 0, 0),
) -> Column:
    """``mean (sd) [min, max]``; a missing statistic is written NA."""
    texts = [
        F.coalesce(fixed(c, d), F.lit("NA")) for c, d in zip((mean, sd, low, high), digits)
    ]
    return F.format_string("%s (%s) [%s, %s]", *texts)


def f_text(df1: Column, df2: Column, f: Column, p: Column) -> Column:
    """``F(df1, df2)=F, p=...``"""
    shown = p_text(p)
    sign = F.when(shown.rlike("[<>]"), "").otherwise("=")
    return F.concat(
        F.lit("F("), plain_number(df1), F.lit(", "), plain_number(df2), F.lit(")="),
        plain_number(f), F.lit(", p"), sign, shown,
    )


def significant(p: Column, alpha: float = 0.05) -> Column:
    return p < F.lit(alpha)


def percent_text(share: Column) -> Column:
    """Share of 1 as percent: one decimal below 10, none above, ``<0.1`` near zero."""
    p = share * 100
    return (
        F.when(p == 0, "0").when(p < 0.1, "<0.1").when(p < 10, fixed(p, 1)).otherwise(fixed(p, 0))
    )


def count_text(n: Column, total: Column) -> Column:
    """``n (p%)``"""
    share = F.coalesce(percent_text(F.try_divide(n, total)), F.lit("NA"))
    return F.format_string("%s (%s%%)", fixed(n, 0), share)
