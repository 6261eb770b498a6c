"""Sales per present day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.calendar import as_date
from shelfwise.functions.numbers import per_day
from shelfwise.keys import DISCONTINUED_STATUSES, HEADQUARTERS_STORE, ITEM, PAIR, STORE
from shelfwise.operators.presence import day_level, in_window, pair_activity


def active_goods(goods: DataFrame) -> DataFrame:
    """Goods that are not discontinued; a null status stays."""
    return goods.filter(~F.coalesce("item_status", F.lit("")).isin(DISCONTINUED_STATUSES))


def goods_variants(goods: DataFrame, *labels: str) -> DataFrame:
    """Goods per (tenant, item, labels): highest prices and how many rows fell together.

    A fact row joined to repeated goods rows is counted once per row, so totals computed
    before the join are multiplied by `copies` after it (J21).
    """
    return goods.groupBy(*ITEM, *labels).agg(
        F.count(F.lit(1)).alias("copies"),
        F.max("lastin_price").cast("double").alias("lastin_price"),
        F.max("sale_price").cast("double").alias("sale_price"),
    )


def psd(
    cost: DataFrame,
    inventory: DataFrame,
    goods: DataFrame,
    as_of,
    window_days: int = 28,
    presence: str = "listed",
    null_keys: str = "drop",
    stores: DataFrame | None = None,
    show_codes: Sequence[str] | None = None,
    unique_days: bool = False,
) -> DataFrame:
    """Velocity per (tenant, store, item, show code) over `(as_of - window_days, as_of]`.

    The DataFrame form (C1) is the default, over `active_goods`. The SQL form (C2) is
    `presence="stock_or_sale"` over all goods, with a table of wanted stores and a
    show-code list.
    `null_keys="keep"` retains items without a show code (T1).
    """
    activity = pair_activity(cost, inventory, as_of, window_days, presence, unique_days)
    if stores is not None:
        activity = activity.join(stores.select(*STORE), STORE, "left_semi")
    return velocity(activity.withColumn("date", as_date(as_of)), goods, null_keys, show_codes)


def velocity(activity: DataFrame, goods: DataFrame, null_keys: str, show_codes: Sequence[str] | None) -> DataFrame:
    """Days and totals per store item and `date`, priced by their goods."""
    joined = activity.join(goods_variants(goods, "show_code"), ITEM, "left")
    if show_codes is not None:
        joined = joined.filter(F.col("show_code").isin(list(show_codes)))
    if null_keys == "drop":
        joined = joined.filter(F.col("show_code").isNotNull())
    copies = F.coalesce("copies", F.lit(1))
    return (
        joined.withColumn("sum_total_sale", (F.col("total_sale") * copies).cast("double"))
        .withColumn("psd", per_day(F.col("sum_total_sale"), F.col("days") * copies))
        .select(
            *PAIR,
            "sum_total_sale",
            "psd",
            "lastin_price",
            (F.col("psd") * F.col("lastin_price")).alias("psd_cost"),
            "date",
            F.col("show_code").alias("item_show_code"),
        )
    )


def psd_days(
    cost: DataFrame,
    inventory: DataFrame,
    goods: DataFrame,
    first: str,
    last: str,
    window_days: int = 28,
    presence: str = "listed",
    null_keys: str = "drop",
) -> DataFrame:
    """`psd` of every day from `first` to `last`, with one scan of the facts.

    Facts are aggregated per day once; a window over the days of a store item, at most one
    row for each day of the span, then sums the last `window_days` for every wanted day.
    """
    wanted = F.sequence(as_date(first), as_date(last))
    span = window_days + (dt.date.fromisoformat(last) - dt.date.fromisoformat(first)).days
    facts = day_level(in_window(cost, last, span), in_window(inventory, last, span)).select(
        *PAIR, "date", F.col(f"{presence}_days").alias("days"), "total_sale", F.lit(1).alias("n_facts")
    )
    asked = facts.select(*PAIR).distinct().select(*PAIR, F.explode(wanted).alias("date"))
    daily = (
        facts.unionByName(asked.withColumn("n_facts", F.lit(0)), allowMissingColumns=True)
        .groupBy(*PAIR, "date")
        .agg(*[F.sum(name).alias(name) for name in ("days", "total_sale", "n_facts")])
    )
    recent = Window.partitionBy(*PAIR).orderBy(F.unix_date("date")).rangeBetween(1 - window_days, 0)
    sums = [F.sum(name).over(recent).alias(name) for name in ("days", "total_sale", "n_facts")]
    rolled = daily.select(*PAIR, "date", *sums).filter((F.col("date") >= as_date(first)) & (F.col("n_facts") > 0))
    return velocity(rolled, goods, null_keys, None)


def psd_inventory_driven(
    cost: DataFrame,
    inventory: DataFrame,
    goods: DataFrame,
    stores: DataFrame,
    as_of,
    window_days: int = 28,
    headquarters: str = HEADQUARTERS_STORE,
    ordered: bool = True,
) -> DataFrame:
    """Velocity of stocked goods.

    Only days with an inventory row count; sales of other days are left out. Ordered by velocity unless the result goes into a
    table; the keys behind it keep items of equal velocity out of one sort partition.
    """
    outside = F.col("foreign_store_id") != headquarters
    activity = (
        day_level(
            in_window(cost, as_of, window_days).filter(outside),
            in_window(inventory, as_of, window_days).filter(outside),
        )
        .filter(F.col("stock_rows") > 0)
        .groupBy(*PAIR)
        .agg(
            F.sum("stock_or_sale_days").alias("days"),
            F.sum("total_sale").alias("total_sale"),
            F.sum("total_cost").alias("total_cost"),
        )
    )
    named = stores.groupBy(*STORE, "store_name", "store_status").agg(F.count(F.lit(1)).alias("store_copies"))
    copies = F.col("copies") * F.coalesce("store_copies", F.lit(1))
    result = (
        activity.join(goods_variants(goods, "barcode", "item_name", "show_code"), ITEM)
        .join(named, STORE, "left")
        .withColumn("n_days", F.col("days") * copies)
        .withColumn("sale", (F.col("total_sale") * copies).cast("double"))
        .withColumn("psd", per_day(F.col("sale"), F.col("n_days")))
        .select(
            *STORE,
            F.col("store_name").alias("foreign_store_name"),
            "foreign_item_id",
            "barcode",
            "item_name",
            F.col("show_code").alias("item_show_code"),
            F.lit(None).cast("string").alias("delivery_method"),
            "store_status",
            F.col("n_days").alias("days"),
            "psd",
            F.col("sale").alias("total_sale"),
            (F.col("total_cost") * copies).cast("double").alias("total_cost"),
            (F.col("sale") / window_days).alias("avg_sale"),
            "lastin_price",
            "sale_price",
            (F.col("psd") * F.col("lastin_price")).alias("psd_cost"),
            as_date(as_of).alias("update_date"),
        )
    )
    return result.orderBy(F.col("psd").desc(), *PAIR) if ordered else result
