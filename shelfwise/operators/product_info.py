"""Product information per store and item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.calendar import as_date
from shelfwise.functions.numbers import double_of_parts, per_day
from shelfwise.keys import HEADQUARTERS_STORE, ITEM, PAIR, STORE
from shelfwise.operators.presence import pair_parts
from shelfwise.operators.psd import goods_variants

_KEYS = PAIR + ["item_name", "item_status", "show_code", "store_name", "store_status", "barcode", "alc_way"]


def product_info(
    cost: DataFrame,
    inventory: DataFrame,
    goods: DataFrame,
    stores: DataFrame,
    delivery_ways: DataFrame,
    as_of,
    window_days: int = 28,
    presence: str = "listed",
    null_keys: str = "drop",
    unique_days: bool = False,
    headquarters: str = HEADQUARTERS_STORE,
) -> DataFrame:
    """Velocity, totals and labels of every store item outside the headquarters store.

    Facts are aggregated to one row per (tenant, store, item) before any label is joined;
    each dimension is first folded to its distinct labels with a row count, so no
    aggregate is needed afterwards. The DataFrame form (C4) is the default, over
    `active_goods`; the SQL form (C5) is `presence="stock_or_sale", null_keys="keep"` over
    all goods.
    """
    outside = F.col("foreign_store_id") != headquarters
    activity = pair_parts(
        cost.filter(outside), inventory.filter(outside), as_of, window_days, presence, unique_days
    )
    # The largest of a text is found by a sort aggregate, and the join below goes on with its order.
    ways = (
        delivery_ways.filter(outside)
        .groupBy(*PAIR, F.col("alc_way").alias("way"))
        .agg(F.count(F.lit(1)).alias("way_copies"), F.max("alc_way").alias("alc_way"))
        .drop("way")
    )
    named = stores.groupBy(*STORE, "store_name", "store_status").agg(F.count(F.lit(1)).alias("store_copies"))
    # The narrow labels first; a sort begins with the key that tells most rows apart.
    labelled = (
        activity.join(ways, PAIR, "left")
        .join(named, STORE[::-1], "left")
        .join(goods_variants(goods, "item_name", "item_status", "show_code", "barcode"), ITEM[::-1], "left")
    )
    if null_keys == "drop":
        labelled = labelled.dropna(subset=_KEYS)
    one = F.lit(1)
    copies = F.coalesce("copies", one) * F.coalesce("way_copies", one) * F.coalesce("store_copies", one)
    return (
        labelled.withColumn("n_days", F.col("days") * copies)
        .withColumn("sale", double_of_parts("total_sale", copies))
        .withColumn("psd", per_day(F.col("sale"), F.col("n_days")))
        .select(
            *STORE,
            F.col("store_name").alias("foreign_store_name"),
            "foreign_item_id",
            "barcode",
            "item_name",
            "item_status",
            F.col("show_code").alias("item_show_code"),
            F.col("alc_way").alias("delivery_method"),
            "store_status",
            F.col("n_days").cast("int").alias("days"),
            "psd",
            F.col("sale").alias("total_sale"),
            double_of_parts("total_cost", copies).alias("total_cost"),
            (F.col("sale") / window_days).alias("avg_sale"),
            "lastin_price",
            "sale_price",
            (F.col("psd") * F.col("lastin_price")).alias("psd_cost"),
            as_date(as_of).alias("update_date"),
        )
    )
