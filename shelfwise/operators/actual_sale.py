"""Daily stock and sale series per store item."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.numbers import zero_if_null
from shelfwise.keys import DAY, PAIR
from shelfwise.operators.presence import in_window


def daily_series(cost: DataFrame, inventory: DataFrame, as_of, window_days: int = 28) -> DataFrame:
    """Distinct (day key, quantity, sale_quantity) rows of the window, nulls as 0.

    Each side is made distinct before the full join: the distinct rows of a join are the
    joins of the distinct rows, and repeats no longer multiply.
    """
    sold = in_window(cost, as_of, window_days).select(*DAY, "sale_quantity").distinct()
    held = in_window(inventory, as_of, window_days).select(*DAY, "quantity").distinct()
    return (
        sold.join(held, DAY, "full")
        .select(*DAY, zero_if_null("quantity").alias("quantity"), zero_if_null("sale_quantity").alias("sale_quantity"))
        .distinct()
    )


def unique_daily_series(cost: DataFrame, inventory: DataFrame, as_of, window_days: int = 28) -> DataFrame:
    """Same rows as `daily_series` where each side has one value per day key.

    A row that is read twice counts once. Two rows of a day that differ fail the query: no
    sum or choice of them is the stock of that day. The sides are stacked and combined
    map-side by day key, so repeats never reach one task together.
    """
    sold = in_window(cost, as_of, window_days).select(*DAY, zero_if_null("sale_quantity").alias("sale_quantity"))
    held = in_window(inventory, as_of, window_days).select(*DAY, zero_if_null("quantity").alias("quantity"))
    sides = ("quantity", "sale_quantity")
    folded = (
        sold.unionByName(held, allowMissingColumns=True)
        .groupBy(*DAY)
        .agg(*[f(name).alias(f"{f.__name__}_{name}") for name in sides for f in (F.min, F.max)])
    )
    one = [F.col(f"min_{name}").eqNullSafe(F.col(f"max_{name}")) for name in sides]
    message = F.lit("two different rows of one day key")
    return folded.select(
        *DAY,
        *[
            F.when(same, zero_if_null(f"max_{name}")).otherwise(F.raise_error(message).cast(folded.schema[f"max_{name}"].dataType)).alias(name)
            for name, same in zip(sides, one, strict=True)
        ],
    )


def actual_sale(
    cost: DataFrame,
    inventory: DataFrame,
    as_of,
    window_days: int = 28,
    rank: str = "row_number",
    store: tuple[int, str] | None = None,
    unique_days: bool = False,
) -> DataFrame:
    """The series with its day rank per store item (C6), of one `store` (tenant, id) or of all.

    `rank="row_number"` numbers rows (W1, ties by quantity), `rank="dense"` numbers days
    (W2). A window partition is one store item, at most `window_days` days long.
    """
    if store is not None:
        wanted = (F.col("cmid") == store[0]) & (F.col("foreign_store_id") == store[1])
        cost, inventory = cost.filter(wanted), inventory.filter(wanted)
    series = (unique_daily_series if unique_days else daily_series)(cost, inventory, as_of, window_days)
    item = Window.partitionBy(*PAIR)
    ranks = {
        "row_number": F.row_number().over(item.orderBy("date", "quantity", "sale_quantity")),
        "dense": F.dense_rank().over(item.orderBy("date")),
    }
    return series.select(
        *PAIR, F.col("quantity").alias("actual_quantity"), "sale_quantity", "date", ranks[rank].alias("rank_num")
    )


def latest_quantity(inventory: DataFrame, as_of, window_days: int = 28) -> DataFrame:
    """Quantity of the newest day per store item.

    A maximum instead of a ranking window: it combines map-side and breaks ties by the
    higher quantity.
    """
    return (
        in_window(inventory, as_of, window_days)
        .groupBy(*PAIR)
        .agg(F.max(F.struct("date", "quantity")).alias("newest"))
        .select(*PAIR, "newest.quantity")
    )


def suggestions_in_window(suggestions: DataFrame, as_of, window_days: int = 28) -> DataFrame:
    """Suggested quantities of the window."""
    return in_window(suggestions, as_of, window_days).select(
        *PAIR, F.col("fill_qty").alias("suggest_qty"), "date"
    )


def backfill_actual_stock(history: DataFrame, series: DataFrame) -> DataFrame:
    """History with `prediction_stock` replaced by the actual stock of the day, 0 if unknown."""
    actual = series.select(*DAY, "actual_quantity")
    return history.join(actual, DAY, "left").select(
        "cmid",
        "foreign_store_id",
        "foreign_store_name",
        "foreign_item_id",
        "foreign_item_name",
        zero_if_null("actual_quantity").cast("int").alias("prediction_stock"),
        "theory_stock",
        "date",
    )
