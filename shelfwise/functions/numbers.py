"""Numeric helpers: null handling and guarded ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn the NaN of every floating column into NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None).cast("double")) for c in floats})


def zero_if_null(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0))


def per_day(total: Column, days: Column) -> Column:
    """`total / days`, 0 when there is no day (A3)."""
    return F.when(days == 0, F.lit(0.0)).otherwise(total.cast("double") / days)


def ratio(part: Column, whole: Column) -> Column:
    """Plain ratio; a zero denominator gives NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


_LOW_BITS = 30


def money_parts(amount: Column) -> dict[str, Column]:
    """The ten-thousandths of a decimal(18,4) as two 64-bit numbers, the low 30 bits and the rest."""
    units = (amount * 10_000).cast("bigint")
    return {"high": F.shiftright(units, _LOW_BITS), "low": units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))}


def part_sums(column: str, alias: str) -> list[Column]:
    """The sum of a decimal(18,4) as the sums of its `money_parts`.

    They take half the room of a wide decimal in each row of an aggregate, and have room for billions of the largest values.
    """
    return [F.sum(part).alias(f"{alias}_{side}") for side, part in money_parts(F.col(column)).items()]


def sum_of_parts(alias: str) -> Column:
    """The exact sum that `part_sums` stand for, null if there was no value."""
    high, low = (F.col(f"{alias}_{side}").cast("decimal(19,0)") for side in ("high", "low"))
    return high * F.lit(Decimal(1 << _LOW_BITS).scaleb(-4)) + low * F.lit(Decimal(1).scaleb(-4))


def parts_times(alias: str, factor: Column) -> list[Column]:
    """The parts of a sum times a whole number that is at least 1, 0 for null; the low part is carried first, to keep its room."""
    high, low = (F.coalesce(f"{alias}_{side}", F.lit(0).cast("bigint")) for side in ("high", "low"))
    carried = {"high": high + F.shiftright(low, _LOW_BITS), "low": low.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))}
    plain = {"high": high, "low": low}
    return [F.when(factor > 1, carried[side] * factor).otherwise(plain[side]).alias(f"{alias}_{side}") for side in plain]


def double_of_parts(alias: str, factor: Column) -> Column:
    """The sum times a whole number as a double, as a decimal is cast to it. Below 2**52 ten-thousandths, where a double holds
    them exactly, no decimal is needed."""
    high, low = F.col(f"{alias}_high"), F.col(f"{alias}_low")
    small = (factor == 1) & high.between(-(1 << 20), 1 << 20) & (low < 1 << 50)
    units = F.shiftleft(high, _LOW_BITS) + low
    return F.when(small, units.cast("double") / F.lit(10_000.0)).otherwise((sum_of_parts(alias) * factor).cast("double"))
