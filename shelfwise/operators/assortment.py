"""Store-item assortment cache."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.calendar import as_date
from shelfwise.keys import ITEM, PAIR, STORE


def sku_cache(
    cost: DataFrame,
    inventory: DataFrame,
    goods: DataFrame,
    stores: DataFrame,
    as_of,
    days_delay: int = 0,
    ignored_categories: Sequence[str] = (),
    settings: DataFrame | None = None,
) -> DataFrame:
    """Store items sold or held in the 29 days `[as_of - delay - 28, as_of - delay]`.

    Held means positive quantity and amount. Items without a category or of an ignored
    one are left out (T4). `settings` (cmid, days_delay, ignored_categories array), one row
    per tenant, replaces the two arguments for the tenants it has.
    """
    facts = [cost, inventory]
    if settings is None:
        last = F.date_sub(as_date(as_of), days_delay)
        facts = [f.filter(F.col("date").between(F.date_sub(last, 28), last)) for f in facts]
        kept = goods.filter(~F.col("foreign_category_lv1").isin(list(ignored_categories) or [""]))
    else:
        own = settings.select("cmid", F.coalesce("days_delay", F.lit(days_delay)).alias("delay"), F.col("ignored_categories").alias("ignored"))
        farthest = own.select(F.greatest(F.max("delay"), F.lit(days_delay))).scalar()
        end = as_date(as_of)
        last = F.date_sub(end, F.coalesce("delay", F.lit(days_delay)))
        # the widest window of any tenant reaches the scan, its own one is checked after the join
        facts = [
            f.filter(F.col("date").between(F.date_sub(end, farthest + 28), end))
            .join(own, "cmid", "left")
            .filter(F.col("date").between(F.date_sub(last, 28), last))
            for f in facts
        ]
        default = F.array(*[F.lit(c) for c in ignored_categories]).cast("array<string>")
        kept = goods.join(own, "cmid", "left").filter(~F.array_contains(F.coalesce("ignored", default), F.col("foreign_category_lv1")))
    sold = facts[0].select(*PAIR)
    held = facts[1].filter((F.col("quantity") > 0) & (F.col("amount") > 0)).select(*PAIR)
    kept = kept.select(*ITEM)
    return (
        sold.union(held)
        .distinct()
        .join(kept, ITEM, "left_semi")
        .join(goods.select(*ITEM, F.col("item_name").alias("foreign_item_name")), ITEM, "left")
        .join(stores.select(*STORE, F.col("store_name").alias("foreign_store_name")), STORE, "left")
        .select(*PAIR, "foreign_item_name", "foreign_store_name")
    )
