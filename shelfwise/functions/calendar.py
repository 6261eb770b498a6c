"""Date expressions (D1-D11). "Today" is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days held by one 64-bit presence word; the sign bit stays unused.
WORD_DAYS = 62


def as_date(value) -> Column:
    """A date column from a Column, a `datetime.date` or an ISO string."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def rolling(date: Column, as_of, days: int) -> Column:
    """Half-open window `(as_of - days, as_of]`, i.e. exactly `days` days."""
    end = as_date(as_of)
    return (date > F.date_sub(end, days)) & (date <= end)


def series_back(as_of, days: int = 28) -> Column:
    """Array of the `days` days that end at `as_of`."""
    end = as_date(as_of)
    return F.sequence(F.date_sub(end, days - 1), end)


def series_until_yesterday(start, today) -> Column:
    """Array from `start` to the day before `today`; `start` itself is always kept."""
    first = as_date(start)
    return F.sequence(first, F.greatest(first, F.date_sub(as_date(today), 1)))


def trial_series(start, end, today) -> Column:
    """Days a trial store still has to load (D3).

    The end is excluded and, if it lies in the future, replaced by yesterday (excluded
    too). The start is always kept.
    """
    first, last, now = as_date(start), as_date(end), as_date(today)
    target = F.when(last <= now, last).otherwise(F.date_sub(now, 1))
    return F.sequence(first, F.greatest(first, F.date_sub(target, 1)))


def monday(date: Column) -> Column:
    return F.date_trunc("week", date).cast("date")


def week_anchor(date: Column, anchor: str = "monday") -> Column:
    """Day that names the week of `date`: its Monday or its Sunday."""
    if anchor not in ("monday", "sunday"):
        raise ValueError(f"unknown week anchor {anchor!r}")
    first = monday(date)
    return first if anchor == "monday" else F.date_add(first, 6)


def week_text(date: Column) -> Column:
    """Two-character ISO week."""
    return F.lpad(F.weekofyear(date).cast("string"), 2, "0")


def year_text(date: Column) -> Column:
    return F.year(date).cast("string")


def twelve_weeks_before(as_of) -> Column:
    """Monday eleven weeks before the week of `as_of`."""
    return F.date_sub(monday(as_date(as_of)), 77)


def day_parity(date: Column) -> Column:
    """1 on odd days of the month, 2 on even ones."""
    return F.when(F.dayofmonth(date) % 2 == 1, 1).otherwise(2)


def day_words(date: Column, hit: Column, as_of, days: int) -> list[Column]:
    """Aggregates that mark the days of a window on which `hit` holds, one bit per day.

    OR-ing bits is a fixed-width buffer that combines map-side, so distinct days are
    counted in the same hash aggregate as the sums, without a distinct shuffle.
    """
    offset = F.datediff(date, F.date_sub(as_date(as_of), days - 1))
    return [
        F.coalesce(
            F.bit_or(
                F.when(
                    hit & offset.between(word * WORD_DAYS, min((word + 1) * WORD_DAYS, days) - 1),
                    F.call_function("shiftleft", F.lit(1).cast("bigint"), offset - word * WORD_DAYS),
                )
            ),
            F.lit(0).cast("bigint"),
        )
        for word in range(-(-days // WORD_DAYS))
    ]


def count_bits(words: list[Column]) -> Column:
    total = F.bit_count(words[0]).cast("bigint")
    for word in words[1:]:
        total = total + F.bit_count(word)
    return total
