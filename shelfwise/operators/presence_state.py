"""Presence and sales of the last days of every store item as a maintained table.

One row per (tenant, store, item): words with a bit for each of the last 60 days (bit k is k days
before `as_of`), and the amounts of the last 28 days by day. A run shifts the words, drops the
days that leave, and reads only the days that were loaded: new ones, late ones and corrected ones alike.
Velocity and the sale days of the stock-out report then come from one row per store item, without
reading 28 or 60 days of facts.

The facts must have at most one row of each side per day key. This is proved while the days are
marked: two amounts of one day can't be in one map.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.calendar import as_date
from shelfwise.functions.numbers import zero_if_null
from shelfwise.keys import PAIR
from shelfwise.operators.presence import MONEY, PRESENCE_RULES, proved_or_fail
from shelfwise.operators.psd import velocity

SPAN = 60
AMOUNT_DAYS = 28
WORDS = ("costed", "sold", "held", "stocked")
_AMOUNTS = f"map<date, struct<sale: {MONEY}, cost: {MONEY}, quantity: {MONEY}>>"
STATE = f"cmid int, foreign_store_id string, foreign_item_id string, {', '.join(f'{word} bigint' for word in WORDS)}, amounts {_AMOUNTS}, as_of date"


def no_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def _mask(days: int) -> int:
    return (1 << days) - 1


def _no_amounts() -> Column:
    return F.expr(f"cast(map() as {_AMOUNTS})")


def _marked(cost: DataFrame, inventory: DataFrame, end: dt.date) -> DataFrame:
    """Words and amounts of the rows given, one row per store item."""
    date, is_cost = F.col("date"), F.col("is_cost")
    sold = cost.select(
        *PAIR,
        "date",
        F.lit(True).alias("is_cost"),
        (zero_if_null("total_sale") > 0).alias("positive"),
        *[F.col(name).cast(MONEY).alias(alias) for name, alias in (("total_sale", "sale"), ("total_cost", "cost"), ("sale_quantity", "quantity"))],
    )
    held = inventory.select(*PAIR, "date", F.lit(False).alias("is_cost"), (zero_if_null("quantity") > 0).alias("positive"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.datediff(F.lit(end), date))
    hits = {"costed": is_cost, "sold": is_cost & F.col("positive"), "held": ~is_cost, "stocked": ~is_cost & F.col("positive")}
    entry = F.when(is_cost & (date > F.date_sub(F.lit(end), AMOUNT_DAYS)), F.struct("date", F.struct("sale", "cost", "quantity")))
    marked = sold.unionByName(held, allowMissingColumns=True).groupBy(*PAIR).agg(
        *[F.coalesce(F.bit_or(F.when(hit, bit)), F.lit(0).cast("bigint")).alias(word) for word, hit in hits.items()],
        F.count_if(is_cost).alias("cost_rows"),
        F.count_if(~is_cost).alias("stock_rows"),
        F.collect_list(entry).alias("entries"),
    )
    proved = (F.bit_count("costed") == F.col("cost_rows")) & (F.bit_count("held") == F.col("stock_rows"))
    checked = proved_or_fail(proved, F.col("costed"), "more than one row of a day key")
    return marked.withColumn("costed", checked).select(*PAIR, *WORDS, F.map_from_entries("entries").alias("amounts"))


def _days(values: Sequence[str], end: dt.date) -> list[dt.date]:
    """The days among `values` that the state at `end` can hold."""
    days = sorted({dt.date.fromisoformat(value) for value in values})
    return [day for day in days if end - dt.timedelta(SPAN) < day <= end]


def rebuilt(cost: DataFrame, inventory: DataFrame, as_of: str) -> DataFrame:
    """The state from the last 60 days of both facts."""
    end = dt.date.fromisoformat(as_of)
    inside = (F.col("date") > F.lit(end - dt.timedelta(SPAN))) & (F.col("date") <= F.lit(end))
    return _marked(cost.filter(inside), inventory.filter(inside), end).withColumn("as_of", F.lit(end))


def merged(state: DataFrame, cost: DataFrame, inventory: DataFrame, days: Sequence[str], as_of: str) -> DataFrame:
    """The state at `as_of` after `days` were loaded for the first time or again.

    Of the facts only these days are read. `days` must name every day after the state's own; `as_of` must not lie
    before that (the query fails else). A store item without a row in the last 60 days has none in the state.
    """
    end = dt.date.fromisoformat(as_of)
    asked = _days(days, end)
    fresh = _marked(cost.filter(F.col("date").isin(asked)), inventory.filter(F.col("date").isin(asked)), end)
    moved = F.datediff(F.lit(end), "as_of")
    cleared = ~sum(1 << (end - day).days for day in asked) & _mask(SPAN)
    zero = F.lit(0).cast("bigint")

    def rolled(word: str) -> Column:
        shifted = F.when(moved < SPAN, F.call_function("shiftleft", F.col(word), moved)).otherwise(zero)
        old = proved_or_fail(moved >= 0, shifted.bitwiseAND(F.lit(cleared).cast("bigint")), "the state is newer than the day")
        return F.coalesce(F.when(F.col("as_of").isNotNull(), old), zero).bitwiseOR(F.coalesce(f"fresh_{word}", zero)).alias(word)

    kept = F.map_filter(F.coalesce("amounts", _no_amounts()), lambda day, _: (day > F.lit(end - dt.timedelta(AMOUNT_DAYS))) & ~day.isin(asked))
    amounts = F.map_concat(kept, F.coalesce("fresh_amounts", _no_amounts()))
    renamed = fresh.select(*PAIR, *[F.col(name).alias(f"fresh_{name}") for name in (*WORDS, "amounts")])
    joined = state.join(renamed, PAIR, "full").select(*PAIR, *[rolled(word) for word in WORDS], amounts.alias("amounts"))
    return joined.filter(F.col("costed").bitwiseOR(F.col("held")) != 0).withColumn("as_of", F.lit(end))


def _total(name: str, days: int) -> Column:
    """Sum of an amount over the last days, 0 without any."""
    kind = "decimal(28,4)"
    recent = F.map_filter("amounts", lambda day, _: day > F.date_sub("as_of", days))
    return F.aggregate(F.map_values(recent), F.lit(0).cast(kind), lambda total, x: (total + F.coalesce(x[name], F.lit(0).cast(MONEY))).cast(kind))


def activity(state: DataFrame, window_days: int = AMOUNT_DAYS, presence: str = "listed") -> DataFrame:
    """Days present and totals per store item, as `presence.pair_activity` has them from the facts of the window."""
    if presence not in PRESENCE_RULES:
        raise ValueError(f"unknown presence rule {presence!r}")
    if window_days > AMOUNT_DAYS:
        raise ValueError(f"amounts are kept for {AMOUNT_DAYS} days")
    mask = F.lit(_mask(window_days)).cast("bigint")
    if presence == "listed":
        present = F.col("sold").bitwiseOR(F.col("held").bitwiseAND(F.bitwise_not("costed")))
    else:
        present = F.col("sold").bitwiseOR(F.col("stocked"))
    seen = F.col("costed").bitwiseOR(F.col("held")).bitwiseAND(mask) != 0
    return state.filter(seen).select(
        *PAIR, F.bit_count(present.bitwiseAND(mask)).cast("bigint").alias("days"), _total("sale", window_days).alias("total_sale"), _total("cost", window_days).alias("total_cost"), F.col("as_of").alias("date")
    )


def psd(state: DataFrame, goods: DataFrame, window_days: int = AMOUNT_DAYS, presence: str = "listed", null_keys: str = "drop", show_codes: Sequence[str] | None = None) -> DataFrame:
    """Velocity at the state's day, as `psd.psd` computes it from the facts."""
    return velocity(activity(state, window_days, presence), goods, null_keys, show_codes)


def sale_history(state: DataFrame) -> DataFrame:
    """Sale days of the last 60 and 28 days, sales of the last week and of the day itself."""
    today = F.element_at("amounts", F.col("as_of"))
    return state.filter(F.col("costed") != 0).select(
        *PAIR,
        F.bit_count("costed").cast("bigint").alias("sale_days_60"),
        F.bit_count(F.col("costed").bitwiseAND(F.lit(_mask(28)).cast("bigint"))).cast("bigint").alias("sale_days_28"),
        today["quantity"].alias("sold_today"),
        _total("sale", 7).alias("sale_7"),
        _total("quantity", 7).alias("quantity_7"),
        as_date(F.col("as_of")).alias("date"),
    )
