"""Sales joined with stock, and the presence of an item on a day.

Both facts have the grain tenant, store, item, day. `full_sku` is the plain full join.
The velocity operators need only totals per (tenant, store, item), so they do not join:
they stack the two facts and aggregate. Every aggregate here has fixed-width buffers and
combines map-side, which keeps a hot store or item from landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.calendar import count_bits, day_words, rolling
from shelfwise.functions.numbers import money_parts, parts_times, sum_of_parts, zero_if_null
from shelfwise.keys import DAY, PAIR

MONEY = "decimal(18,4)"
AMOUNTS = ("total_sale", "total_cost")
_PARTS = [f"{name}_{side}" for name in AMOUNTS for side in ("high", "low")]
PRESENCE_RULES = ("listed", "stock_or_sale")


def in_window(df: DataFrame, as_of, days: int) -> DataFrame:
    """Rows of the window; applied to each input, where it reaches the scan (F2)."""
    return df.filter(rolling(F.col("date"), as_of, days))


def full_sku(cost: DataFrame, inventory: DataFrame) -> DataFrame:
    """Full outer join on the day key with null measures filled.

    `exist` follows the listed rule: a cost row counts when it has a positive sale, an
    inventory row without a cost row always counts.
    """
    sold = cost.select(
        *DAY,
        zero_if_null("total_sale").cast(MONEY).alias("total_sale"),
        F.col("total_cost").cast(MONEY).alias("total_cost"),
        F.when(F.col("total_sale") > 0, 1).otherwise(0).alias("exist"),
    )
    return sold.join(inventory.select(*DAY, "quantity"), DAY, "full").select(
        *DAY,
        zero_if_null("quantity").alias("quantity"),
        zero_if_null("total_sale").cast(MONEY).alias("total_sale"),
        zero_if_null("total_cost").cast(MONEY).alias("total_cost"),
        F.coalesce("exist", F.lit(1)).alias("exist"),
    )


def _stacked(cost: DataFrame, inventory: DataFrame) -> DataFrame:
    """Both facts below each other, amounts as `money_parts`."""
    parts = {
        f"{name}_{side}": part for name in AMOUNTS for side, part in money_parts(F.col(name).cast(MONEY)).items()
    }
    sold = cost.select(
        *DAY,
        F.lit(True).alias("is_cost"),
        (zero_if_null("total_sale") > 0).alias("positive"),
        *[part.alias(name) for name, part in parts.items()],
    )
    stocked = inventory.select(
        *DAY,
        F.lit(False).alias("is_cost"),
        (zero_if_null("quantity") > 0).alias("positive"),
        *[F.lit(None).cast("bigint").alias(name) for name in parts],
    )
    return sold.unionByName(stocked)


def _day_parts(cost: DataFrame, inventory: DataFrame) -> DataFrame:
    """`day_level` with the amounts as parts."""
    is_cost, positive = F.col("is_cost"), F.col("positive")
    counted = (
        _stacked(cost, inventory)
        .groupBy(*DAY)
        .agg(
            F.count_if(is_cost).alias("cost_rows"),
            F.count_if(is_cost & positive).alias("sold_rows"),
            F.count_if(~is_cost).alias("stock_rows"),
            F.count_if(~is_cost & positive).alias("stocked_rows"),
            *[F.sum(name).alias(name) for name in _PARTS],
        )
    )
    cost_rows, sold_rows = F.col("cost_rows"), F.col("sold_rows")
    stock_rows, stocked_rows = F.col("stock_rows"), F.col("stocked_rows")
    fan_out = F.greatest(stock_rows, F.lit(1))
    listed = F.when(cost_rows > 0, sold_rows * fan_out).otherwise(stock_rows)
    neither = (cost_rows - sold_rows) * (stock_rows - stocked_rows)
    stock_or_sale = (
        F.when(stock_rows == 0, sold_rows).when(cost_rows == 0, stocked_rows).otherwise(cost_rows * stock_rows - neither)
    )
    return counted.select(
        *DAY,
        "cost_rows",
        "stock_rows",
        listed.alias("listed_days"),
        stock_or_sale.alias("stock_or_sale_days"),
        *[part for name in AMOUNTS for part in parts_times(name, stock_rows)],
    )


def _with_amounts(df: DataFrame) -> DataFrame:
    """The amounts that the parts stand for in place of the parts."""
    return df.withColumns({name: sum_of_parts(name).cast("decimal(38,4)") for name in AMOUNTS}).drop(*_PARTS)


def day_level(cost: DataFrame, inventory: DataFrame) -> DataFrame:
    """What the full join of a day would sum to, without joining.

    Repeated rows of a day fan out in a join, so each side's totals are multiplied by the
    other side's row count. Columns: day key, `cost_rows`, `stock_rows`, `listed_days`,
    `stock_or_sale_days`, `total_sale`, `total_cost`.
    """
    return _with_amounts(_day_parts(cost, inventory))


def pair_activity(
    cost: DataFrame,
    inventory: DataFrame,
    as_of,
    window_days: int = 28,
    presence: str = "listed",
    unique_days: bool = False,
) -> DataFrame:
    """Days present and totals per (tenant, store, item) over the window.

    `unique_days=True` is for inputs that hold at most one row per day key, such as
    tables written per day by this package or grouped by the day key. It marks days as
    bits and needs a single shuffle. The promise is proved in the same aggregate: if a
    side has more rows than marked days, the query fails. Otherwise days are counted row
    by row first.
    """
    return _with_amounts(pair_parts(cost, inventory, as_of, window_days, presence, unique_days))


def pair_parts(
    cost: DataFrame,
    inventory: DataFrame,
    as_of,
    window_days: int = 28,
    presence: str = "listed",
    unique_days: bool = False,
) -> DataFrame:
    """`pair_activity` with the amounts as parts, which pass aggregates, sorts and joins as plain numbers."""
    if presence not in PRESENCE_RULES:
        raise ValueError(f"unknown presence rule {presence!r}")
    cost, inventory = in_window(cost, as_of, window_days), in_window(inventory, as_of, window_days)
    if not unique_days:
        return (
            _day_parts(cost, inventory)
            .groupBy(*PAIR)
            .agg(F.sum(f"{presence}_days").alias("days"), *[F.sum(name).alias(name) for name in _PARTS])
        )
    is_cost, positive = F.col("is_cost"), F.col("positive")
    marks = {"costed": is_cost, "held": ~is_cost}
    marks |= {"sold": is_cost & positive} if presence == "listed" else {"present": positive}
    words = {name: day_words(F.col("date"), hit, as_of, window_days) for name, hit in marks.items()}
    marked = (
        _stacked(cost, inventory)
        .groupBy(*PAIR)
        .agg(
            *[w.alias(f"{name}_{i}") for name, row in words.items() for i, w in enumerate(row)],
            F.count_if(is_cost).alias("cost_rows"),
            F.count_if(~is_cost).alias("stock_rows"),
            *[zero_if_null(F.sum(name)).alias(name) for name in _PARTS],
        )
    )
    n_words = len(words["costed"])
    proved = (count_bits([F.col(f"costed_{i}") for i in range(n_words)]) == F.col("cost_rows")) & (
        count_bits([F.col(f"held_{i}") for i in range(n_words)]) == F.col("stock_rows")
    )
    days = count_bits([_present_word(presence, i) for i in range(n_words)])
    return marked.select(*PAIR, proved_or_fail(proved, days, "unique_days: more than one row of a day key").alias("days"), *_PARTS)


def proved_or_fail(proved: Column, value: Column, message: str) -> Column:
    """`value` where `proved` holds; else the query fails."""
    return F.when(proved, value).otherwise(F.raise_error(F.lit(message)).cast("bigint"))


def _present_word(presence: str, i: int) -> Column:
    if presence == "stock_or_sale":
        return F.col(f"present_{i}")
    only_held = F.col(f"held_{i}").bitwiseAND(F.bitwise_not(f"costed_{i}"))
    return F.col(f"sold_{i}").bitwiseOR(only_held)
