"""Cause of a stock-out as one CASE.

A NULL operand makes its comparison unknown, so the row falls through to the next
branch, as a NaN comparison does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.keys import RETURNED_CAUSE

# Reason codes.
NOT_SUGGESTED, NOT_BOOKED, NOT_DELIVERED, RETURNED, OTHER = 1, 2, 3, 4, 5


def lost_reason(enrolled: Column) -> Column:
    """Reason code; `enrolled` (NULL counts as false) picks the suggestion-aware rule."""
    suggest, book, delivered = F.col("cm_suggest"), F.col("store_book"), F.col("inv_delivery")
    by_suggestion = (
        F.when((suggest == 0) | suggest.isNull() | (suggest <= delivered), NOT_SUGGESTED)
        .when((suggest > book) & (delivered >= book), NOT_BOOKED)
        .when(book >= suggest, NOT_DELIVERED)
        .otherwise(OTHER)
    )
    by_booking = F.when((book == 0) | book.isNull() | (book <= delivered), NOT_BOOKED).otherwise(NOT_DELIVERED)
    return (
        F.when(F.col("cause") == RETURNED_CAUSE, RETURNED)
        .when(enrolled, by_suggestion)
        .otherwise(by_booking)
        .cast("bigint")
    )
