"""Exact distinct counts that can be merged.

Items get dense numbers per tenant, new ones behind the old. A day of a store is a bitmap over these
numbers, one row for every 64 bits of which any is set; a week is the bitwise OR of its days, and its
distinct items are the bits set. A store that lost few of many items so has few short rows, and a word is
a number, which a hash aggregate holds in place. A run makes bitmaps of the new days only; days that were
loaded again are simply replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.calendar import week_anchor
from shelfwise.keys import STORE

NUMBERS = "cmid int, item string, number bigint"
DAY_MAPS = "cmid int, foreign_store_id string, store_show_code string, word bigint, items bigint, date date"
SLOTS = 256
NO_ITEM = "\x00"
"""Stands for an unknown item where that counts as one."""


def no_numbers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], NUMBERS)


def _item(column: str, count_null: bool):
    return F.coalesce(F.col(column), F.lit(NO_ITEM)) if count_null else F.col(column)


def numbered(known: DataFrame, rows: DataFrame, column: str = "foreign_item_id", count_null: bool = False) -> DataFrame:
    """`known` numbers and those of the items of `rows` that have none yet, from 1 per tenant without gaps.

    New items are counted within slots by hash, and the slots of a tenant one after the other, so no
    task sorts all items of a tenant. Numbers never change.
    """
    items = rows.select("cmid", _item(column, count_null).alias("item")).filter(F.col("item").isNotNull()).distinct()
    new = items.join(known.select("cmid", "item"), ["cmid", "item"], "left_anti").withColumn("slot", F.pmod(F.xxhash64("item"), F.lit(SLOTS)))
    placed = new.withColumn("place", F.row_number().over(Window.partitionBy("cmid", "slot").orderBy("item")))
    sizes = new.groupBy("cmid", "slot").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("cmid").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    used = known.groupBy("cmid").agg(F.max("number").alias("used"))
    start = sizes.select("cmid", "slot", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    start = start.join(used, "cmid", "left").select("cmid", "slot", (F.col("start") + F.coalesce("used", F.lit(0))).alias("start"))
    added = placed.join(start, ["cmid", "slot"]).select("cmid", "item", (F.col("start") + F.col("place")).cast("bigint").alias("number"))
    return known.select("cmid", "item", "number").unionByName(added)


def day_maps(rows: DataFrame, numbers: DataFrame, column: str = "foreign_item_id", count_null: bool = False) -> DataFrame:
    """Bitmaps of the items of every store and day of `rows`; a day on which a store has none but unknown items has one
    empty row. Every item must have a number."""
    item = _item(column, count_null)
    keyed = rows.select(*STORE, "store_show_code", "date", item.alias("item")).join(numbers, ["cmid", "item"], "left")
    lost = F.col("item").isNotNull() & F.col("number").isNull()
    number = F.when(lost, F.raise_error(F.lit("an item without a number")).cast("bigint")).otherwise(F.col("number"))
    word = F.shiftright(number, 6).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(63).cast("int"))
    maps = keyed.groupBy(*STORE, "store_show_code", "date", word).agg(F.bit_or(bit).alias("items"))
    return maps.select(*STORE, "store_show_code", "word", "items", "date")


def week_items(maps: DataFrame, anchor: str = "sunday", keys: Sequence[str] = (*STORE, "store_show_code")) -> DataFrame:
    """Distinct items per `keys` and week, from bitmaps of days."""
    week = week_anchor(F.col("date"), anchor).alias("week")
    words = maps.groupBy(*keys, week, "word").agg(F.bit_or("items").alias("items"))
    counted = F.coalesce(F.bit_count("items"), F.lit(0))
    return words.groupBy(*keys, "week").agg(F.sum(counted).cast("bigint").alias("lost_sku"))
