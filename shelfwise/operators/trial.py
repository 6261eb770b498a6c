"""Trial stores: which days to load, the load, and the state afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.calendar import as_date, trial_series
from shelfwise.keys import STORE
from shelfwise.operators.reports import (
    PRODUCT_COLUMNS,
    STORE_COLUMNS,
    detail_rows,
    join_psd,
    judge_by_date,
    load_summary,
)


def is_candidate() -> Column:
    return (F.col("deal_status") > 0) | (F.col("execute_date") <= F.col("end_date"))


def is_due() -> Column:
    return (F.col("deal_status") > 0) & (F.col("execute_date") <= F.col("end_date"))


def trial_expand(trial_stores: DataFrame, today) -> DataFrame:
    """One row per due store and day to load."""
    days = trial_series(F.col("execute_date"), F.col("end_date"), today)
    return trial_stores.filter(is_due()).select(*STORE, F.explode(days).alias("date"))


def _due_rows(rows: DataFrame, trial_stores: DataFrame, today) -> DataFrame:
    return rows.join(trial_expand(trial_stores, today).distinct(), [*STORE, "date"], "left_semi")


def trial_store_load(summary_sheet: DataFrame, trial_stores: DataFrame, today) -> DataFrame:
    """Summary rows of the due store days."""
    due = _due_rows(load_summary(summary_sheet), trial_stores, today)
    codes = trial_stores.filter(is_candidate()).select(*STORE, F.col("show_code").alias("store_show_code"))
    return due.join(codes, STORE).select(*STORE_COLUMNS)


def trial_product_load(detail_sheet: DataFrame, trial_stores: DataFrame, psd: DataFrame, today) -> DataFrame:
    """Detail rows of the due store days with reason by go-live date and velocity."""
    due = _due_rows(detail_rows(detail_sheet), trial_stores, today)
    judged = judge_by_date(due, trial_stores.filter(is_candidate()), "inner")
    return join_psd(judged, psd).select(*PRODUCT_COLUMNS)


def trial_state(trial_stores: DataFrame, today) -> DataFrame:
    """The store table after a run (C14).

    Every candidate gets today's execute date; due stores are closed (0) once their end
    date has passed, else stay open (1). Other rows are unchanged.
    """
    now = as_date(today)
    candidate, due = F.coalesce(is_candidate(), F.lit(False)), F.coalesce(is_due(), F.lit(False))
    closed = F.when(F.col("end_date") < now, 0).otherwise(1)
    return trial_stores.withColumns(
        {
            "deal_status": F.when(due, closed).otherwise(F.col("deal_status")),
            "execute_date": F.when(candidate, now).otherwise(F.col("execute_date")),
        }
    )
