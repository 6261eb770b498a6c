"""Stock-out report: rate per store and detail per empty store item."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.calendar import as_date, count_bits, day_words, rolling
from shelfwise.functions.codes import store_type
from shelfwise.functions.numbers import part_sums, ratio, sum_of_parts, zero_if_null
from shelfwise.keys import CENTRAL_DELIVERY, ITEM, PAIR, STORE
from shelfwise.sources.scratch import settle

MONEY = "decimal(18,4)"

# What a source says of a store item, as bits of one number: every row of the stacked sources carries all columns.
_MARKS = {"listed": 1, "aa": 2, "has_ordered": 4, "has_suggested": 8}


Statuses = Sequence[str] | DataFrame


def gate_statuses(settings: DataFrame) -> DataFrame:
    """(cmid, busgate): the allowed statuses of every tenant.

    `settings` has cmid and the arrays item_status_code and foreign_item_status, as read
    from the tenants' configuration; an empty or missing code list falls back to the other.
    """
    codes = F.when(F.size(F.coalesce("item_status_code", F.array())) > 0, F.col("item_status_code"))
    return settings.select("cmid", F.explode(F.coalesce(codes, "foreign_item_status")).alias("busgate")).distinct()


def allowed(cm_sku: DataFrame, statuses: Statuses) -> DataFrame:
    """Rows whose gate status is allowed: one list for all tenants, or (cmid, busgate) rows of each.

    A tenant without a row of its own allows nothing.
    """
    if isinstance(statuses, DataFrame):
        return cm_sku.join(statuses.select("cmid", "busgate"), ["cmid", "busgate"], "left_semi")
    return cm_sku.filter(F.col("busgate").isin(list(statuses)))


def assortment(cm_sku: DataFrame, statuses: Statuses) -> DataFrame:
    """Distinct store items whose gate status is allowed."""
    return allowed(cm_sku, statuses).select(*PAIR).distinct()


def stockout_items(cm_sku: DataFrame, inventory: DataFrame, as_of, statuses: Statuses) -> DataFrame:
    """Assortment items without stock on the day.

    In stock means a summed quantity other than 0, so a negative sum counts as in stock.
    """
    in_stock = (
        inventory.filter(F.col("date") == as_date(as_of))
        .groupBy(*PAIR)
        .agg(F.sum("quantity").alias("stock"))
        .filter(F.col("stock") != 0)
    )
    return assortment(cm_sku, statuses).join(in_stock, PAIR, "left_anti")


def cost_60d(cost: DataFrame, as_of) -> DataFrame:
    """The last 30 days and the 30 days before them."""
    return cost.filter(rolling(F.col("date"), as_of, 60))


def last_delivery_date(delivery: DataFrame) -> DataFrame:
    """Newest central delivery day per store."""
    return (
        delivery.filter(F.col("delivery_type") == CENTRAL_DELIVERY)
        .groupBy(*STORE)
        .agg(F.max("delivery_date").alias("delivery_date"))
    )


def latest_delivery(delivery: DataFrame) -> DataFrame:
    """Quantity per item of each store's newest central delivery."""
    central = delivery.filter(F.col("delivery_type") == CENTRAL_DELIVERY)
    last = settle(last_delivery_date(delivery), "last_delivery")
    return (
        Days.of(last, last=F.col("delivery_date"))
        .on(central, "last", "delivery_date")
        .groupBy(*PAIR, "delivery_date")
        .agg(F.sum("delivery_qty").alias("delivery_qty"))
    )


def asof_store_snapshot(snapshots: DataFrame, as_of) -> DataFrame:
    """Store snapshot of the day, or of the day before for tenants without one.

    Rows of the day pass straight through; only those of the day before are checked.
    """
    end = as_date(as_of)
    today = snapshots.filter(F.col("date") == end)
    yesterday = snapshots.filter(F.col("date") == F.date_sub(end, 1))
    return today.unionByName(yesterday.join(today.select("cmid").distinct(), "cmid", "left_anti"))


def asof_days(asked: DataFrame, snapshots: DataFrame, as_of, tolerance: int = 1) -> DataFrame:
    """(cmid, date): the newest snapshot day of every `asked` tenant within `tolerance` days before `as_of`, null without one.

    Asked tenants and snapshot days are stacked and aggregated together, so the unmatched side comes out of the same
    pass: a load leaves these tenants alone instead of taking no snapshot for no stores.
    """
    end = as_date(as_of)
    recent = snapshots.filter(F.col("date").between(F.date_sub(end, tolerance), end)).select("cmid", "date", F.lit(False).alias("asked"))
    wanted = asked.select("cmid", F.lit(None).cast("date").alias("date"), F.lit(True).alias("asked"))
    return wanted.unionByName(recent).groupBy("cmid").agg(F.max("date").alias("date"), F.max("asked").alias("asked")).filter("asked").select("cmid", "date")


def reference_dates(delivery: DataFrame, suggestions: DataFrame, stores: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """Delivery, order and suggestion day of each store beside its name and property.

    The order day is the day before the last central delivery. The suggestion day is the
    order day if the store has any suggestion on it, else the day before: the fallback is
    taken for the whole day, never item by item.

    One row per store, stores without a delivery included. `last` has the newest central delivery
    day of every store, from `delivery_state.last_days`; without it the delivery history is read
    once. The last days are written, and they bound the days of the suggestions that are
    read. The report joins the result to large facts, so write it as a table and pass the table: its size is then known, a small one
    is broadcast, and with a large one a hot store can still be split.
    """
    newest = last_delivery_date(delivery) if last is None else last.select(*STORE, "delivery_date")
    dates = settle(newest.withColumn("require_date", F.date_sub("delivery_date", 1)), "last_delivery")
    suggested = (
        Days.of(dates, require=F.col("require_date"))
        .within(suggestions, "require")
        .select(*STORE, F.col("date").alias("require_date"))
        .join(dates.select(*STORE, "require_date"), [*STORE, "require_date"], "left_semi")
        .distinct()
        .withColumn("suggested", F.lit(True))
    )
    named = stores.groupBy(*STORE).agg(F.max(F.struct("store_name", "property_id")).alias("store"))
    suggest_date = F.when(F.col("suggested"), F.col("require_date")).otherwise(F.date_sub("require_date", 1))
    return (
        dates.join(suggested, [*STORE, "require_date"], "left")
        .join(named, STORE, "full")
        .select(
            *STORE,
            "store.store_name",
            "store.property_id",
            "delivery_date",
            "require_date",
            suggest_date.alias("suggest_date"),
        )
    )


MOST_NAMED_DAYS = 400


@dataclass(frozen=True)
class Days:
    """Reference days per store, and the different days of each kind over all stores.

    The different days (of the calendar, so they are few) come from one read of a written table. As plain dates in
    the filters they skip the other date partitions of a long history, whatever the joins turn into: each by itself,
    or beyond `MOST_NAMED_DAYS` all between the earliest and the latest.
    """

    dates: DataFrame
    named: dict[str, list[dt.date]]

    @classmethod
    def of(cls, dates: DataFrame, **days: Column) -> Days:
        row = dates.agg(*[F.sort_array(F.collect_set(day)).alias(name) for name, day in days.items()]).first()
        return cls(dates.select(*STORE, *[day.alias(name) for name, day in days.items()]), {name: row[name] for name in days})

    def within(self, table: DataFrame, name: str, column: str = "date") -> DataFrame:
        """Rows of the days of that kind, or between the earliest and the latest of very many."""
        named = self.named[name]
        first, last = (F.lit(day).cast("date") for day in ((named[0], named[-1]) if named else (None, None)))
        inside = F.col(column).between(first, last)
        return table.filter(inside & F.col(column).isin(named) if 0 < len(named) <= MOST_NAMED_DAYS else inside)

    def on(self, table: DataFrame, name: str, column: str = "date") -> DataFrame:
        """Rows that fall on the store's own day of that kind."""
        own = self.dates.select(*STORE, F.col(name).alias(column))
        return self.within(table, name, column).join(own, [*STORE, column])


def _report_days(dates: DataFrame) -> Days:
    """The days a report looks at; `order_stock` is the day before the order day."""
    return Days.of(
        dates,
        delivery=F.col("delivery_date"),
        require=F.col("require_date"),
        suggest=F.col("suggest_date"),
        order_stock=F.date_sub("require_date", 1),
    )


def asof_suggestion(suggestions: DataFrame, dates: DataFrame) -> DataFrame:
    """Suggestions of each store's suggestion day (S17); `dates` comes from `reference_dates`."""
    days = Days.of(dates, suggest=F.col("suggest_date"))
    return days.on(suggestions, "suggest").select(*PAIR, "date", "fill_qty")


def _mark(name: str) -> Column:
    return F.lit(_MARKS[name]).alias("marks")


def _marked(name: str) -> Column:
    return zero_if_null("marks").bitwiseAND(F.lit(_MARKS[name])) != 0


def _measure(rows: DataFrame, column: str, alias: str) -> DataFrame:
    return rows.select(*PAIR, F.col(column).cast(MONEY).alias(alias))


def _advised(rows: DataFrame, column: str, alias: str) -> DataFrame:
    """A quantity with a mark that there is one: an unknown quantity is not the same as none."""
    return rows.select(*PAIR, F.col(column).cast(MONEY).alias(alias), _mark(f"has_{alias}"))


def _advised_quantity(alias: str) -> Column:
    return F.when(_marked(f"has_{alias}"), F.col(alias)).otherwise(0)


def _cause_sources(
    inventory: DataFrame,
    cm_sku: DataFrame,
    delivery: DataFrame,
    suggestions: DataFrame,
    require_orders: DataFrame,
    days: Days,
    as_of,
    statuses: Statuses,
) -> list[DataFrame]:
    central = delivery.filter(F.col("delivery_type") == CENTRAL_DELIVERY)
    return [
        allowed(cm_sku, statuses).select(*PAIR, _mark("listed")),
        _measure(inventory.filter(F.col("date") == as_date(as_of)), "quantity", "stock"),
        _advised(days.on(require_orders, "require"), "order_qty", "ordered"),
        _advised(days.on(suggestions, "suggest"), "fill_qty", "suggested"),
        _measure(days.on(central, "delivery", "delivery_date"), "delivery_qty", "delivered"),
    ]


def _history_sources(
    sales: DataFrame, inventory: DataFrame, aa_sku: DataFrame, days: Days
) -> list[DataFrame]:
    return [
        aa_sku.select(*PAIR, _mark("aa")),
        _measure(days.on(inventory, "order_stock"), "quantity", "order_stock"),
        sales,
    ]


def _ordered_methods(refunds: DataFrame) -> DataFrame:
    """(method, method_rank): the different methods, with numbers that sort as they do.

    Written, so the numbers stay as they are. The rows lie in sorted ranges, so the number of a row grows with its
    method without one task that meets them all.
    """
    methods = refunds.select("method").dropna().distinct().orderBy("method")
    return settle(methods.withColumn("method_rank", F.monotonically_increasing_id()), "refund_methods")


def _returned(refunds: DataFrame, methods: DataFrame) -> DataFrame:
    """Refunded store items with the number of the method; an unknown key is no item."""
    return refunds.dropna(subset=PAIR).join(methods, "method").select(*PAIR, "method_rank")


def _sold(cost: DataFrame, as_of) -> tuple[DataFrame, dict[str, Column]]:
    """The rows of the last 60 days, and how the sale days of an item are counted from them."""
    date = F.col("date")
    last_week = rolling(date, as_of, 7)
    rows = cost_60d(cost, as_of).select(
        *PAIR,
        date.alias("sale_date"),
        F.when(date == as_date(as_of), F.col("sale_quantity")).cast(MONEY).alias("sold_today"),
        F.when(last_week, F.col("total_sale")).cast(MONEY).alias("sale_7"),
        F.when(last_week, F.col("sale_quantity")).cast(MONEY).alias("quantity_7"),
    )
    sale_date = F.col("sale_date")
    [sold] = day_words(sale_date, sale_date.isNotNull(), as_of, 60)
    last_28 = F.lit(((1 << 28) - 1) << 32)
    return rows, {"sale_days_60": count_bits([sold]), "sale_days_28": count_bits([sold.bitwiseAND(last_28)])}


def _sold_before(sale_history: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The same from the maintained row of each item."""
    counts = {name: F.coalesce(F.max(name), F.lit(0).cast("bigint")) for name in ("sale_days_60", "sale_days_28")}
    return sale_history.select(*PAIR, *counts, *[F.col(name).cast(MONEY).alias(name) for name in ("sold_today", "sale_7", "quantity_7")]), counts


def _causes() -> list[Column]:
    return [
        F.bit_or("marks").alias("marks"),
        *part_sums("stock", "stock_sum"),
        *[F.max(name).alias(name) for name in ("stock", "ordered", "suggested")],
        *part_sums("delivered", "delivered"),
    ]


def _per_item(sources: list[DataFrame], *aggregates: Column) -> DataFrame:
    """One row per store item with everything looked up for it.

    Each source contributes its own columns; they are stacked and aggregated together, so
    there is one shuffle with map-side combine instead of one join per source.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    return stacked.groupBy(*PAIR).agg(*aggregates)


def _listed(items: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """Items of the assortment, of the wanted (tenant, store) rows only if there are any given."""
    items = items.filter(_marked("listed"))
    return items if wanted is None else items.join(wanted.select(*STORE), STORE, "left_semi")


def _is_empty() -> Column:
    return zero_if_null(sum_of_parts("stock_sum")) == 0


def stockout_summary(
    inventory: DataFrame,
    cm_sku: DataFrame,
    delivery: DataFrame,
    suggestions: DataFrame,
    require_orders: DataFrame,
    dates: DataFrame,
    as_of,
    statuses: Statuses,
    wanted_stores: DataFrame | None = None,
) -> DataFrame:
    """One row per store with assortment size, empty items and their causes.

    `dates` comes from `reference_dates`. A store without empty items has NULL ratios. An
    item with a suggestion or order of unknown quantity is not counted as left out.
    """
    days = _report_days(dates)
    sources = _cause_sources(inventory, cm_sku, delivery, suggestions, require_orders, days, as_of, statuses)
    empty = _is_empty()
    counted = (
        _listed(_per_item(sources, *_causes()), wanted_stores)
        .groupBy(*STORE)
        .agg(
            F.count_if(empty).alias("lost_sku"),
            F.count(F.lit(1)).alias("all_sku"),
            F.count_if(empty & (_advised_quantity("suggested") == 0)).alias("un_suggest"),
            F.count_if(empty & (_advised_quantity("ordered") == 0)).alias("un_order"),
            F.count_if(empty & (zero_if_null(sum_of_parts("delivered")) == 0)).alias("un_deliver"),
        )
    )
    lost_sku = F.col("lost_sku")
    return (
        counted.join(dates, STORE, "left").select(
            "cmid",
            "store_name",
            "foreign_store_id",
            store_type(F.col("property_id")).alias("store_type"),
            "lost_sku",
            "all_sku",
            ratio(lost_sku, F.col("all_sku")).alias("store_lost_rate"),
            "un_suggest",
            "un_order",
            "un_deliver",
            ratio(F.col("un_suggest"), lost_sku).alias("un_suggest_rate"),
            ratio(F.col("un_order"), lost_sku).alias("un_order_rate"),
            ratio(F.col("un_deliver"), lost_sku).alias("un_deliver_rate"),
            "suggest_date",
            "require_date",
            "delivery_date",
        )
    )


def stockout_detail(
    cost: DataFrame,
    inventory: DataFrame,
    cm_sku: DataFrame,
    delivery: DataFrame,
    suggestions: DataFrame,
    require_orders: DataFrame,
    aa_sku: DataFrame,
    refunds: DataFrame,
    warehouse: DataFrame,
    goods: DataFrame,
    dates: DataFrame,
    as_of,
    statuses: Statuses,
    wanted_stores: DataFrame | None = None,
    sale_history: DataFrame | None = None,
) -> DataFrame:
    """One row per empty store item.

    The sale days come from 60 days of `cost`, or from `sale_history`, which `presence_state.sale_history` gives
    for the same day. Where a lookup could meet several rows of an item, the largest value is taken, so the
    result does not depend on file order (T13). The largest method of a refund is found by its number, in the same
    hash aggregate as the rest: that of a text would sort all refunds twice and join them by store item. Names and warehouse stock of an item,
    the stock by its few days, come in one join by item, so the report is dealt and sorted once for both.
    """
    days = _report_days(dates)
    sources = _cause_sources(inventory, cm_sku, delivery, suggestions, require_orders, days, as_of, statuses)
    sales, sale_days = _sold(cost, as_of) if sale_history is None else _sold_before(sale_history)
    methods = _ordered_methods(refunds)
    sources += [*_history_sources(sales, inventory, aa_sku, days), _returned(refunds, methods)]
    items = _per_item(
        sources,
        *_causes(),
        F.max("order_stock").alias("order_stock"),
        *[count.alias(name) for name, count in sale_days.items()],
        F.max("sold_today").alias("sold_today"),
        *part_sums("sale_7", "sale_7"),
        *part_sums("quantity_7", "quantity_7"),
        F.max("method_rank").alias("method_rank"),
    ).filter(_is_empty())
    named = goods.groupBy(*ITEM).agg(F.max(F.struct("show_code", "item_name")).alias("goods"))
    held = (
        days.within(warehouse, "require")
        .groupBy(*ITEM, "date")
        .agg(F.max("stock_qty").alias("stock_qty"))
        .groupBy(*ITEM)
        .agg(F.map_from_entries(F.collect_list(F.struct("date", "stock_qty"))).alias("held"))
    )

    def amount(column: str | Column) -> Column:
        return zero_if_null(column).cast("double")

    return (
        _listed(items, wanted_stores)
        .join(methods, "method_rank", "left")
        .join(dates, STORE, "left")
        .join(named.join(held, ITEM, "full"), ITEM, "left")
        .select(
            "cmid",
            "foreign_store_id",
            "store_name",
            "foreign_item_id",
            F.col("goods.show_code").alias("item_show_code"),
            F.col("goods.item_name").alias("item_name"),
            amount("stock").alias("actual_stock"),
            amount("order_stock").alias("order_stock"),
            *sale_days,
            _advised_quantity("suggested").cast("double").alias("cm_suggest"),
            _advised_quantity("ordered").cast("double").alias("store_book"),
            amount(sum_of_parts("delivered")).alias("inv_delivery"),
            (amount(sum_of_parts("sale_7")) / 7).alias("avg_sale_7"),
            (amount(sum_of_parts("quantity_7")) / 7).alias("avg_quantity_7"),
            F.when(_marked("aa"), "是").otherwise("否").alias("is_aa"),
            F.coalesce("method", F.lit("")).alias("cause"),
            amount(F.try_element_at("held", F.col("require_date"))).alias("warehouse_stock"),
            amount("sold_today").alias("avg_qty"),
        )
    )
