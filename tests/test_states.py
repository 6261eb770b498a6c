"""Maintained tables against rebuilds, load by load."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import delivery_state, item_bitmaps, presence, presence_state, stockout
from shelfwise.sources import scratch

FIRST = dt.date(2024, 1, 1)


def rows_of(df):
    return sorted(map(str, df.collect()))


def day(n):
    return (FIRST + dt.timedelta(n)).isoformat()


DELIVERY = "cmid int, foreign_store_id string, foreign_item_id string, delivery_date date, delivery_qty bigint, delivery_type string"


def deliveries(spark, held):
    """Rows of a day-by-day dictionary of (store, item, quantity, type)."""
    rows = [(43, s, i, dt.date.fromisoformat(d), q, t) for d, entries in held.items() for s, i, q, t in entries]
    return spark.createDataFrame(rows, DELIVERY)


def test_delivery_state_equals_a_rebuild(spark):
    """New, late, corrected, emptied and very old days, in random loads."""
    rng = random.Random(4)

    def some():
        return [(f"s{rng.randrange(5)}", f"i{rng.randrange(3)}", rng.randrange(9), rng.choice(["统配出", "统配出", "直配出"])) for _ in range(rng.randrange(4))]

    held = {day(n): some() for n in range(0, 90, 7)} | {"1968-03-01": [("s9", "i1", 3, "统配出")]}
    state = scratch.settle(delivery_state.rebuilt(deliveries(spark, held)), "state")
    items = scratch.settle(delivery_state.latest_items(deliveries(spark, held), state), "items")
    for load in range(8):
        loaded = [day(rng.randrange(130)) for _ in range(3)] + (["1968-03-01"] if load == 5 else []) + rng.sample(sorted(held), 2)
        for d in loaded:
            held[d] = some() if rng.random() < 0.7 else []
        now = deliveries(spark, held)
        state = scratch.settle(delivery_state.merged(state, now, loaded), "state")
        assert rows_of(state.select("cmid", "foreign_store_id", F.sort_array(F.map_entries("days")))) == rows_of(delivery_state.rebuilt(now).select("cmid", "foreign_store_id", F.sort_array(F.map_entries("days"))))
        assert rows_of(delivery_state.last_days(state)) == rows_of(stockout.last_delivery_date(now))
        items = scratch.settle(delivery_state.refreshed_items(items, state, now, loaded), "items")
        assert rows_of(items) == rows_of(stockout.latest_delivery(now).select(items.columns))


def test_a_run_that_stopped_between_state_and_items_is_made_good(spark):
    before = {day(0): [("a", "i", 1, "统配出")], day(1): [("a", "j", 2, "统配出"), ("b", "i", 3, "统配出")]}
    after = before | {day(1): [("b", "i", 4, "统配出")]}
    state = delivery_state.rebuilt(deliveries(spark, before))
    items = scratch.settle(delivery_state.latest_items(deliveries(spark, before), state), "items")
    now = deliveries(spark, after)
    merged = scratch.settle(delivery_state.merged(state, now, [day(1)]), "state")  # the items were not refreshed
    again = delivery_state.merged(merged, now, [day(1)])
    assert rows_of(delivery_state.refreshed_items(items, again, now, [day(1)])) == rows_of(stockout.latest_delivery(now).select(items.columns))


def test_empty_delivery_states(spark):
    none = deliveries(spark, {})
    state = delivery_state.merged(delivery_state.no_state(spark), none, [day(0)])
    assert rows_of(state) == [] == rows_of(delivery_state.last_days(state))
    first = deliveries(spark, {day(0): [("a", "i", 1, "统配出")]})
    assert rows_of(delivery_state.last_days(delivery_state.merged(state, first, []))) == []
    assert len(rows_of(delivery_state.last_days(delivery_state.merged(state, first, [day(0)])))) == 1
    with_null = first.withColumn("delivery_date", F.lit(None).cast("date"))
    assert rows_of(delivery_state.rebuilt(with_null)) == []


COST = "cmid int, foreign_store_id string, foreign_item_id string, date date, sale_quantity bigint, total_sale decimal(18,4), total_cost decimal(18,4)"
STOCK = "cmid int, foreign_store_id string, foreign_item_id string, date date, quantity bigint"


def facts(spark, cost, stock):
    c = [(43, "s", i, dt.date.fromisoformat(d), q, s, k) for d, entries in cost.items() for i, (q, s, k) in entries.items()]
    h = [(43, "s", i, dt.date.fromisoformat(d), q) for d, entries in stock.items() for i, q in entries.items()]
    return spark.createDataFrame(c, COST), spark.createDataFrame(h, STOCK)


def test_presence_state_equals_the_scans(spark):
    from decimal import Decimal

    rng = random.Random(9)

    def sales():
        return {f"i{k}": (rng.randrange(5), rng.choice([None, Decimal(0), Decimal("2.5")]), Decimal(1)) for k in range(5) if rng.random() < 0.4}

    def stocks():
        return {f"i{k}": rng.choice([None, 0, -2, 7]) for k in range(5) if rng.random() < 0.4}

    cost, stock = {day(n): sales() for n in range(70)}, {day(n): stocks() for n in range(70)}
    at = 69
    state = scratch.settle(presence_state.rebuilt(*facts(spark, cost, stock), day(at)), "state")
    for moved, late in ((1, 3), (0, 12), (5, 40), (30, 2), (70, 9)):
        loaded = [day(n) for n in range(at + 1, at + moved + 1)] + [day(at - late)]
        at += moved
        for d in loaded:
            cost[d], stock[d] = ({}, {}) if moved == 70 and d != loaded[-2] else (sales(), stocks())
        now = facts(spark, cost, stock)
        state = scratch.settle(presence_state.merged(state, *now, loaded, day(at)), "state")
        entries = F.sort_array(F.map_entries("amounts")).alias("amounts")
        columns = [c for c in state.columns if c != "amounts"]
        assert rows_of(state.select(*columns, entries)) == rows_of(presence_state.rebuilt(*now, day(at)).select(*columns, entries))
        for rule in presence.PRESENCE_RULES:
            for window in (28, 7):
                expected = presence.pair_activity(*now, day(at), window, rule, unique_days=True)
                assert rows_of(presence_state.activity(state, window, rule).drop("date")) == rows_of(expected)
    with pytest.raises(Exception, match="newer than the day"):
        presence_state.merged(state, *now, [], day(at - 1)).collect()


def test_repeated_rows_of_a_day_are_refused(spark):
    from decimal import Decimal

    cost, stock = facts(spark, {day(0): {"i": (1, Decimal(1), Decimal(1))}}, {day(0): {"i": 1}})
    assert presence_state.rebuilt(cost, stock, day(0)).count() == 1
    for facts_again in ((cost.union(cost), stock), (cost, stock.union(stock))):
        with pytest.raises(Exception, match="more than one row of a day key|DUPLICATED_MAP_KEY|[Dd]uplicate"):
            presence_state.rebuilt(*facts_again, day(0)).collect()
    with pytest.raises(ValueError, match="unknown presence rule"):
        presence_state.activity(presence_state.no_state(spark), presence="any")
    with pytest.raises(ValueError, match="amounts are kept"):
        presence_state.activity(presence_state.no_state(spark), 60)


LOST = "cmid int, foreign_store_id string, store_show_code string, foreign_item_id string, date date"


def test_item_numbers_are_dense_and_stay(spark):
    rows = spark.createDataFrame([(c, "s", "S", f"item {k}", FIRST) for c in (43, 85) for k in range(500)], LOST)
    first = scratch.settle(item_bitmaps.numbered(item_bitmaps.no_numbers(spark), rows.filter("foreign_item_id < 'item 3'")), "numbers")
    whole = scratch.settle(item_bitmaps.numbered(first, rows), "numbers")
    assert whole.join(first, ["cmid", "item", "number"], "left_semi").count() == first.count()
    for c in (43, 85):
        assert sorted(r.number for r in whole.filter(F.col("cmid") == c).collect()) == list(range(1, 501))


def test_bitmaps_count_across_buckets(spark):
    """Numbers far apart, unknown items and a store that has only those."""
    numbers = spark.createDataFrame([(43, f"i{k}", k * 20_000) for k in range(1, 9)], item_bitmaps.NUMBERS)
    rows = [(43, "a", "A", f"i{k}", FIRST + dt.timedelta(k % 3)) for k in (1, 2, 2, 5, 8, 5)] + [(43, "a", "A", None, FIRST), (43, "b", "B", None, FIRST)]
    frame = spark.createDataFrame(rows, LOST)
    found = {r.foreign_store_id: r.lost_sku for r in item_bitmaps.week_items(item_bitmaps.day_maps(frame, numbers)).collect()}
    assert found == {"a": 4, "b": 0}
    with pytest.raises(Exception, match="without a number"):
        item_bitmaps.day_maps(frame, numbers.filter("item <> 'i5'")).collect()
    counted = item_bitmaps.numbered(item_bitmaps.no_numbers(spark), frame, count_null=True)
    maps = item_bitmaps.day_maps(frame, counted, count_null=True)
    assert {r.foreign_store_id: r.lost_sku for r in item_bitmaps.week_items(maps).collect()} == {"a": 5, "b": 1}


def test_bitmaps_of_few_items_are_short(spark):
    """A few lost items far apart are a few numbers, and no aggregate sorts them."""
    numbers = spark.createDataFrame([(43, f"i{k}", k * 20_000 + k) for k in range(1, 9)], item_bitmaps.NUMBERS)
    rows = [(43, f"s{s}", "A", f"i{k}", FIRST) for s in range(20) for k in (s % 8 + 1, 8, 8)]
    maps = item_bitmaps.day_maps(spark.createDataFrame(rows, LOST), numbers)
    found = maps.collect()
    assert all(isinstance(r.items, int) for r in found) and len(found) <= 40
    weeks = item_bitmaps.week_items(maps)
    assert "SortAggregate" not in weeks._jdf.queryExecution().executedPlan().toString()
    assert {r.foreign_store_id: r.lost_sku for r in weeks.collect()} == {f"s{s}": 1 if s % 8 == 7 else 2 for s in range(20)}


def test_bitmaps_use_every_bit_of_a_word(spark):
    numbers = spark.createDataFrame([(43, f"i{k}", k) for k in range(200)], item_bitmaps.NUMBERS)
    frame = spark.createDataFrame([(43, "a", "A", f"i{k}", FIRST) for k in range(200)], LOST)
    maps = item_bitmaps.day_maps(frame, numbers)
    assert maps.count() == 4
    assert [r.lost_sku for r in item_bitmaps.week_items(maps).collect()] == [200]
