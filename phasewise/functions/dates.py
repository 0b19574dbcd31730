"""Calendar arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = ("days", "months", "years")


def normalize_dates(df: DataFrame, containing: str = "date") -> DataFrame:
    """Cut every column with ``containing`` in its name to midnight (a date)."""
    return df.withColumns(
        {c: F.col(c).try_cast("timestamp").cast("date") for c in df.columns if containing in c}
    )


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """A date, or NULL when a part is missing or the day does not exist."""
    parts = [F.format_string("%d", p.cast("int")) for p in (year, month, day)]
    known = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.when(known, F.concat_ws("-", *parts)).try_cast("date")


def construct_dates(df: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """``date_<s>`` from ``year_<s>``, ``month_<s>`` and ``day_<s>``."""
    return df.withColumns(
        {
            f"date_{s}": date_from_parts(F.col(f"year_{s}"), F.col(f"month_{s}"), F.col(f"day_{s}"))
            for s in suffixes
        }
    )


def periods_between(start: Column, end: Column, units: str) -> Column:
    """Calendar periods from start to end (31 January to 1 February is one month).

    Negative spans - the event lies in the future - are NULL.
    """
    if units not in UNITS:
        raise ValueError(f"no calendar period is called {units!r}; known: {sorted(UNITS)}")
    if units == "days":
        span = F.datediff(end, start)
    elif units == "months":
        span = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    else:
        span = F.year(end) - F.year(start)
    return F.when(span >= 0, span)


def interval_name(start: str, end: str, units: str) -> str:
    """An event's own name is its column without the leading ``date_``."""
    since, at = start.removeprefix("date_"), end.removeprefix("date_")
    return "_".join((units, "since", since, "at", at))


def with_interval(df: DataFrame, start: str, end: str, units: str) -> DataFrame:
    """Add ``<units>_since_<start>_at_<end>``."""
    span = periods_between(F.col(start), F.col(end), units)
    return df.withColumn(interval_name(start, end, units), span)


def closed_end(exclusive_end: Column) -> Column:
    """Last day inside a window whose end date is exclusive."""
    return F.date_sub(exclusive_end, 1)


def inclusive_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def local_date(ts: Column) -> Column:
    return F.to_date(ts)


def day_open(day: Column) -> Column:
    return F.concat(day.cast("string"), F.lit(" 00:00:00"))


def day_close(day: Column) -> Column:
    return F.concat(day.cast("string"), F.lit(" 23:59:59"))


def participant_tag(label: Column) -> Column:
    return F.concat(F.lit("p"), label.cast("string"))
