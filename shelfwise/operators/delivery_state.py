"""Days of central deliveries per store as a maintained table.

The newest delivery of a store needs the whole history once. After that a run reads only the days
that were loaded anew: the state has one row per store with a bit for every day that had a central
delivery, in words of 62 days, a few dozen words for ten years. A loaded day sets its bits and clears those of
stores that no longer have it, so late, corrected and deleted days leave the same state as a
rebuild. A second table holds the items of each store's newest delivery and is refreshed for the
stores whose newest day moved or was loaded again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.calendar import WORD_DAYS
from shelfwise.keys import CENTRAL_DELIVERY, PAIR, STORE
from shelfwise.operators.stockout import Days
from shelfwise.sources.scratch import settle

STATE = "cmid int, foreign_store_id string, days map<int, bigint>"
ITEMS = "cmid int, foreign_store_id string, foreign_item_id string, delivery_date date, delivery_qty bigint"
EPOCH = dt.date(1970, 1, 1)


def no_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def _central(delivery: DataFrame) -> DataFrame:
    return delivery.filter((F.col("delivery_type") == CENTRAL_DELIVERY) & F.col("delivery_date").isNotNull())


def _on_days(table: DataFrame, days: Sequence[str], column: str) -> DataFrame:
    """Rows of the days, as plain dates that reach the scan."""
    return table.filter(F.col(column).isin([dt.date.fromisoformat(day) for day in days]))


def _marked(delivery: DataFrame) -> DataFrame:
    """One row per store with the words of all its delivery days; bits combine before the shuffle."""
    number = F.unix_date("delivery_date")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(WORD_DAYS)))
    words = _central(delivery).groupBy(*STORE, F.floor(number / WORD_DAYS).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy(*STORE).agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("days"))


def rebuilt(delivery: DataFrame) -> DataFrame:
    """The state from the whole history."""
    return _marked(delivery)


def _masks(days: Sequence[str]) -> Column:
    """The bits of some days as a map of words."""
    masks: dict[int, int] = {}
    for day in days:
        word, bit = divmod((dt.date.fromisoformat(day) - EPOCH).days, WORD_DAYS)
        masks[word] = masks.get(word, 0) | 1 << bit
    pairs = [F.lit(x).cast(kind) for word, mask in masks.items() for x, kind in ((word, "int"), (mask, "bigint"))]
    return F.create_map(*pairs) if pairs else F.expr("cast(map() as map<int, bigint>)")


def merged(state: DataFrame, delivery: DataFrame, days: Sequence[str]) -> DataFrame:
    """The state after `days` were loaded again or for the first time; of `delivery` only these days are read.

    A day that has no delivery any more loses its bits, and so does a store without any delivery its row.
    """
    fresh = _marked(_on_days(delivery, days, "delivery_date")).withColumnRenamed("days", "fresh")
    nothing = F.expr("cast(map() as map<int, bigint>)")
    zero = F.lit(0).cast("bigint")
    kept = F.map_zip_with(F.coalesce("days", nothing), _masks(days), lambda _, old, mask: F.coalesce(old, zero).bitwiseAND(F.bitwise_not(F.coalesce(mask, zero))))
    whole = F.map_zip_with(kept, F.coalesce("fresh", nothing), lambda _, old, new: F.coalesce(old, zero).bitwiseOR(F.coalesce(new, zero)))
    joined = state.join(fresh, STORE, "full").select(*STORE, F.map_filter(whole, lambda _, bits: bits != 0).alias("days"))
    return joined.filter(F.size("days") > 0)


def last_days(state: DataFrame) -> DataFrame:
    """Newest central delivery day per store: what `stockout.last_delivery_date` finds in the whole history."""
    word = F.array_max(F.map_keys("days"))
    newest = word * WORD_DAYS + F.length(F.bin(F.element_at("days", word))) - 1
    return state.select(*STORE, F.date_from_unix_date(newest).alias("delivery_date"))


def _items_on(delivery: DataFrame, last: DataFrame) -> DataFrame:
    own = Days.of(settle(last, "last_delivery"), last=F.col("delivery_date")).on(_central(delivery), "last", "delivery_date")
    return own.groupBy(*PAIR, "delivery_date").agg(F.sum("delivery_qty").alias("delivery_qty"))


def latest_items(delivery: DataFrame, state: DataFrame) -> DataFrame:
    """Quantity per item of each store's newest central delivery."""
    return _items_on(delivery, last_days(state))


def refreshed_items(items: DataFrame, state: DataFrame, delivery: DataFrame, days: Sequence[str]) -> DataFrame:
    """`latest_items` after `days` were merged into `state`, from the items before.

    Only stores whose newest day is among `days`, or is another than that of their items, are read from
    `delivery`, and only on these days. What counts is the day of the items, so a run that
    stopped between the two tables is made good by the next.
    """
    held = items.groupBy(*STORE).agg(F.max("delivery_date").alias("held_date"))
    stale = ~F.col("delivery_date").eqNullSafe(F.col("held_date")) | F.col("delivery_date").isin([dt.date.fromisoformat(day) for day in days])
    last = settle(last_days(state).join(held, STORE, "left").select(*STORE, "delivery_date", F.coalesce(stale, F.lit(True)).alias("stale")), "last_delivery")
    kept = items.join(last.filter(~F.col("stale")).select(*STORE), STORE, "left_semi")
    return kept.unionByName(_items_on(delivery, last.filter("stale").drop("stale")))
