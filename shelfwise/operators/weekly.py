"""Weekly roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.calendar import as_date, monday, twelve_weeks_before, week_anchor, week_text, year_text
from shelfwise.functions.numbers import ratio
from shelfwise.keys import STORE

# Output columns of the reason codes 1, 2, ... in order.
REASON_COLUMNS = {
    4: ["cm_suggest", "store_book", "inv_delivery", "other_reason"],
    5: ["cm_suggest", "store_book", "inv_delivery", "return_goods", "other_reason"],
}


def week_reasons(product_info: DataFrame, classes: int = 4, ordered: bool = True) -> DataFrame:
    """Stock-outs per store, week and reason.

    `classes=4` names weeks by Monday and reads code 4 as other (C15), `classes=5` names
    them by Sunday and separates returns (C16). Ordered by week unless the result goes
    into a table, where the sort would be lost.
    """
    anchor = {4: "monday", 5: "sunday"}[classes]
    counts = [
        F.count_if(F.col("lost_reason") == code).alias(name)
        for code, name in enumerate(REASON_COLUMNS[classes], start=1)
    ]
    result = (
        product_info.groupBy(*STORE, "store_show_code", week_anchor(F.col("date"), anchor).alias("week"))
        .agg(*counts)
        .select(
            *STORE,
            "store_show_code",
            *REASON_COLUMNS[classes],
            F.col("week").alias("date"),
            F.year("week").alias("y"),
            F.weekofyear("week").alias("wk"),
        )
    )
    return result.orderBy("date", *STORE) if ordered else result


def week_store_info(store_info: DataFrame, product_info: DataFrame, lost: DataFrame | None = None) -> DataFrame:
    """Weekly stock-out rate per store, named by Sunday (C17).

    Stores without a lost item keep a NULL count and a NULL show code. `lost` has the distinct items of each week,
    from `item_bitmaps.week_items`; without it they are counted from `product_info`.
    """
    week = week_anchor(F.col("date"), "sunday").alias("week")
    whole = store_info.groupBy(*STORE, "store_name", week).agg(F.max("all_sku").alias("all_sku"))
    if lost is None:
        lost = product_info.groupBy(*STORE, "store_show_code", week).agg(F.count_distinct("foreign_item_id").alias("lost_sku"))
    return whole.join(lost, [*STORE, "week"], "left").select(
        *STORE,
        "store_show_code",
        "store_name",
        "lost_sku",
        "all_sku",
        ratio(F.col("lost_sku"), F.col("all_sku")).alias("store_lost_rate"),
        F.col("week").alias("date"),
        F.year("week").alias("y"),
        F.weekofyear("week").alias("wk"),
    )


def week_store_info_df(store_info: DataFrame, product_info: DataFrame, stores: DataFrame, as_of, lost_items: DataFrame | None = None) -> DataFrame:
    """Stock-out rate of the last twelve weeks per store.

    Lost items are distinct show codes of the week; a store-day that lost nothing
    contributes a zero, so its week appears. The date is the Sunday of the week. `lost_items` has the distinct show codes
    of each week, from `item_bitmaps.week_items` with `count_null`, Monday weeks and stores as keys.
    """
    week = monday(F.col("date")).alias("week")
    if lost_items is None:
        lost = product_info.select(*STORE, "item_show_code", week).distinct().select(*STORE, "week", F.lit(1).alias("lost"))
    else:
        lost = lost_items.select(*STORE, "week", F.col("lost_sku").alias("lost"))
    spared = store_info.filter(F.col("lost_sku") == 0).select(*STORE, week, F.lit(0).alias("lost"))
    recent = F.col("week").between(twelve_weeks_before(as_of), as_date(as_of))
    counted = lost.unionByName(spared).filter(recent).groupBy(*STORE, "week").agg(F.sum("lost").alias("lost_sku"))
    whole = store_info.groupBy(*STORE, week).agg(F.max("all_sku").alias("all_sku")).filter(recent)
    sunday = F.date_add("week", 6)
    return (
        counted.join(whole, [*STORE, "week"], "left")
        .join(stores.select(*STORE, F.col("show_code").alias("store_show_code"), "store_name"), STORE, "left")
        .select(
            *STORE,
            sunday.alias("date"),
            "lost_sku",
            "all_sku",
            ratio(F.col("lost_sku"), F.col("all_sku")).alias("store_lost_rate"),
            year_text(sunday).alias("y"),
            week_text(sunday).alias("wk"),
            "store_show_code",
            "store_name",
        )
    )
