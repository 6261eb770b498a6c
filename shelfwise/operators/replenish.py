"""Replenishment of a store item day by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.codes import can_order
from shelfwise.functions.numbers import zero_if_null
from shelfwise.keys import ITEM, PAIR, STORE


def future_demand(series: DataFrame, *keys: str) -> DataFrame:
    """Adds `future_demand`: demand after the row up to the next orderable row.

    Without a later orderable row it is the demand of the last row, not a sum. One row
    per day key is expected; a window partition is one store item. `keys` separate
    several series of one item.
    """
    ordered = Window.partitionBy(*PAIR, *keys).orderBy("date")
    running = F.sum("demand").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    upcoming = ordered.rowsBetween(1, Window.unboundedFollowing)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    next_order = F.first(F.when(F.col("can_request_order") == 1, F.col("running")), ignorenulls=True).over(upcoming)
    return (
        series.withColumn("running", running)
        .withColumn(
            "future_demand",
            F.coalesce(next_order - F.col("running"), F.last("demand").over(whole)).cast("bigint"),
        )
        .drop("running")
    )


def _next_day(state: Column, day: Column, daily: Sequence[str]) -> Column:
    """State after one day: `stock` for the next day and the days done so far."""
    left = state["stock"] - day["demand"]
    remain = F.greatest(left, F.lit(0).cast("bigint"))
    wants = (day["can"] == 1) & (day["future"] > left)
    packs = F.ceil((day["future"] - remain).cast("double") / day["mfu"])
    fill = F.when(wants, (day["mfu"] * packs).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    done = F.struct(
        day["date"].alias("date"),
        F.when(wants, 1).otherwise(0).alias("should_fill"),
        fill.alias("fill_qty"),
        state["stock"].alias("cur_stock"),
        *[day[name].alias(name) for name in daily],
    )
    return F.struct((remain + fill).alias("stock"), F.concat(state["days"], F.array(done)).alias("days"))


def replenish(series: DataFrame, labels: Sequence[str] = (), daily: Sequence[str] = ()) -> DataFrame:
    """Order quantities that keep each store item supplied until its next order day.

    `series` has one row per day key and pack size `mfu` with `demand`,
    `can_request_order` and `opening_stock` (constant per store item). An item with
    several pack sizes gets a sequence for each. `labels` are further constant columns and
    `daily` further per-day columns to carry through. The days of an item, at
    most one per day of the window, are folded inside one row, in the shuffle that the
    demand windows already made.
    """
    day = F.struct(
        "date",
        F.col("demand").cast("bigint").alias("demand"),
        F.col("can_request_order").alias("can"),
        F.col("future_demand").alias("future"),
        F.col("mfu").cast("double").alias("mfu"),
        F.col("opening_stock").cast("bigint").alias("opening"),
        *daily,
    )
    carried = "".join(f",{name}:{series.schema[name].dataType.simpleString()}" for name in daily)
    done = f"array<struct<date:date,should_fill:int,fill_qty:bigint,cur_stock:bigint{carried}>>"
    # A float cannot share one hash partitioning between window and aggregate, a decimal can.
    sized = series.withColumn("pack", F.col("mfu").cast("decimal(38,12)"))
    items = (
        future_demand(sized, "pack")
        .groupBy(*PAIR, "pack", *labels)
        .agg(F.sort_array(F.collect_list(day)).alias("series"))
    )
    start = F.struct(F.col("series")[0]["opening"].alias("stock"), F.array().cast(done).alias("days"))
    folded = F.aggregate(
        "series", start, lambda state, day: _next_day(state, day, daily), lambda state: state["days"]
    )
    return items.select(*PAIR, *labels, F.inline(folded))


def replenish_input(
    products: DataFrame, packs: DataFrame, cycles: DataFrame, series: DataFrame
) -> DataFrame:
    """Daily series of every product with pack size, delivery cycle and opening stock.

    `products` has the pair key, `foreign_store_name` and `foreign_item_name`; `packs`
    (cmid, foreign_item_id, mfu); `cycles` (cmid, foreign_store_id, period_type_num);
    `series` is one row per day key with `quantity` and `sale_quantity`. The opening
    stock is the stock of the earliest day. The series is joined last, so its rows stay
    spread by store item and never move by store or item alone.
    """
    first_day = Window.partitionBy(*PAIR).orderBy("date")
    opened = series.withColumn("opening_stock", F.first("quantity").over(first_day))
    configured = products.join(packs, ITEM, "left").join(cycles, STORE, "left")
    return (
        configured.join(opened, PAIR, "left")
        .select(
            *PAIR,
            "foreign_store_name",
            "foreign_item_name",
            "mfu",
            "date",
            zero_if_null("sale_quantity").cast("bigint").alias("demand"),
            F.col("quantity").cast("bigint").alias("quantity"),
            F.col("opening_stock").cast("bigint").alias("opening_stock"),
            can_order(F.col("period_type_num"), F.col("date")).alias("can_request_order"),
        )
    )


def _computable() -> Column:
    return F.coalesce(
        F.col("date").isNotNull() & F.col("opening_stock").isNotNull() & (F.col("mfu") != 0), F.lit(False)
    )


def replenish_rejects(prepared: DataFrame) -> DataFrame:
    """Rows left out because pack size, series or opening stock is missing."""
    return prepared.filter(~_computable())


def replenish_history(prepared: DataFrame) -> DataFrame:
    """Theoretical stock beside the actual stock of each day (C26), from `replenish_input`."""
    theory = replenish(
        prepared.filter(_computable()), ["foreign_store_name", "foreign_item_name"], daily=["quantity"]
    )
    return theory.select(
        "cmid",
        "foreign_store_id",
        "foreign_store_name",
        "foreign_item_id",
        "foreign_item_name",
        F.col("fill_qty").cast("double").alias("fill_qty"),
        F.col("quantity").cast("int").alias("prediction_stock"),
        F.col("cur_stock").cast("int").alias("theory_stock"),
        "date",
    )
