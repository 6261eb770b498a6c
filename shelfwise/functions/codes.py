"""Small value maps and string codes (ST1, ST2, ST5, D8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.calendar import day_parity

# Fixed values of the source systems.
SOURCE_ID_WIDTH = 15
SOURCE_ID_PADDING = "YYYYYYYYYYYYY"
CYCLE_CODES = {"单日配": 1, "双日配": 2}
OTHER_CYCLE = 3
LOW_DENSITY = "低"
RULE_STRATEGY, ALGORITHM_STRATEGY = "规则", "算法"
DIRECT_STORE, FRANCHISE_STORE = "直营", "加盟"


def source_id(cmid: Column) -> Column:
    """Tenant id followed by the padding, cut to 15 characters (ST1)."""
    return F.substring(F.concat(cmid.cast("string"), F.lit(SOURCE_ID_PADDING)), 1, SOURCE_ID_WIDTH)


def source_id_text(cmid: int) -> str:
    return f"{cmid}{SOURCE_ID_PADDING}"[:SOURCE_ID_WIDTH]


def tenant_of(source: Column) -> Column:
    """Text before the first `Y` (ST2)."""
    return F.substring_index(source, "Y", 1)


def cycle_code(cycle: Column) -> Column:
    """Odd-day delivery 1, even-day delivery 2, anything else (a null included) 3."""
    code = F.lit(OTHER_CYCLE)
    for text, number in CYCLE_CODES.items():
        code = F.when(cycle == text, number).otherwise(code)
    return code


def strategy_type(density: Column) -> Column:
    return F.when(density == LOW_DENSITY, RULE_STRATEGY).otherwise(ALGORITHM_STRATEGY)


def store_type(property_id: Column) -> Column:
    return F.when(property_id.cast("string") == "2", DIRECT_STORE).otherwise(FRANCHISE_STORE)


def can_order(cycle: Column, date: Column) -> Column:
    """1 when a store with this cycle code may order on `date` (C25); no code gives 0."""
    return F.when((cycle == OTHER_CYCLE) | (cycle == day_parity(date)), 1).otherwise(0)
