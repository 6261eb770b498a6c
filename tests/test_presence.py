"""Velocity against a literal row-by-row join, repeated rows included."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from shelfwise.operators import presence, product_info, psd

AS_OF = dt.date(2024, 1, 30)
COST = "cmid int, foreign_store_id string, foreign_item_id string, date date, sale_quantity bigint, total_sale decimal(18,4), total_cost decimal(18,4)"
STOCK = "cmid int, foreign_store_id string, foreign_item_id string, date date, quantity bigint"
GOODS = "cmid int, foreign_item_id string, barcode string, item_name string, show_code string, item_status string, lastin_price decimal(18,4), sale_price decimal(18,4)"


def facts(seed, repeats):
    rng = random.Random(seed)
    cost, stock = [], []
    for store in "ab":
        for item in "xyz":
            for back in range(40):
                day = AS_OF - dt.timedelta(back)
                for _ in range(rng.choice([0, 1, 2] if repeats else [0, 1])):
                    sale = rng.choice([None, Decimal(0), Decimal(-3), Decimal(7), Decimal("12.5")])
                    cost.append((43, store, item, day, rng.randint(0, 5), sale, Decimal(rng.randint(0, 9))))
                for _ in range(rng.choice([0, 1, 2] if repeats else [0, 1])):
                    stock.append((43, store, item, day, rng.choice([None, 0, -2, 4])))
    return cost, stock


def joined(cost, stock, days):
    """Pairs of the full join in the window: (key, cost row or None, stock row or None)."""
    by_key = defaultdict(lambda: ([], []))
    for side, rows in enumerate((cost, stock)):
        for row in rows:
            if AS_OF - dt.timedelta(days) < row[3] <= AS_OF:
                by_key[row[:4]][side].append(row)
    for key, (left, right) in by_key.items():
        for c in left or [None]:
            for s in right or [None]:
                yield key, c, s


def present(rule, c, s):
    sold = c is not None and (c[5] or 0) > 0
    if rule == "listed":
        return c is None or sold
    return sold or (s is not None and (s[4] or 0) > 0)


def expected(cost, stock, rule, days, keep=lambda c, s: True):
    out = defaultdict(lambda: [0, Decimal(0), Decimal(0)])
    for key, c, s in joined(cost, stock, days):
        if keep(c, s):
            total = out[key[:3]]
            total[0] += present(rule, c, s)
            total[1] += (c[5] or 0) if c else 0
            total[2] += c[6] if c else 0
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("rule", presence.PRESENCE_RULES)
@pytest.mark.parametrize("days", [1, 28, 62, 63, 130])
@pytest.mark.parametrize("repeats, unique", [(True, False), (False, False), (False, True)])
def test_pair_activity(spark, rule, days, repeats, unique):
    cost, stock = facts(days, repeats)
    result = presence.pair_activity(
        spark.createDataFrame(cost, COST), spark.createDataFrame(stock, STOCK), AS_OF, days, rule, unique
    )
    got = {tuple(r[:3]): (r.days, r.total_sale, r.total_cost) for r in result.collect()}
    assert got == expected(cost, stock, rule, days)


def test_unknown_rule_is_refused(spark):
    empty = spark.createDataFrame([], COST)
    with pytest.raises(ValueError):
        presence.pair_activity(empty, spark.createDataFrame([], STOCK), AS_OF, 28, "maybe")


def test_full_sku_matches_join(spark):
    cost, stock = facts(5, True)
    got = presence.full_sku(spark.createDataFrame(cost, COST), spark.createDataFrame(stock, STOCK)).collect()
    want = sorted(
        (key, s[4] or 0 if s else 0, (c[5] or 0) if c else 0, int(present("listed", c, s)))
        for key, c, s in joined(cost, stock, 99)
    )
    assert sorted((tuple(r[:4]), r.quantity, r.total_sale, r.exist) for r in got) == want


def test_inventory_driven_counts_stocked_days_only(spark):
    cost, stock = facts(9, True)
    goods = spark.createDataFrame([(43, i, "b", "n", "c", "s", Decimal(2), Decimal(3)) for i in "xyz"], GOODS)
    stores = spark.createDataFrame(
        [(43, "a", "A", "open")], "cmid int, foreign_store_id string, store_name string, store_status string"
    )
    result = psd.psd_inventory_driven(
        spark.createDataFrame(cost, COST), spark.createDataFrame(stock, STOCK), goods, stores, AS_OF
    )
    got = {(r.cmid, r.foreign_store_id, r.foreign_item_id): (r.days, r.total_sale) for r in result.collect()}
    want = expected(cost, stock, "stock_or_sale", 28, keep=lambda c, s: s is not None)
    assert got == {k: (v[0], float(v[1])) for k, v in want.items()}


def velocity(spark, cost, stock, goods, **options):
    return psd.psd(
        spark.createDataFrame(cost, COST),
        spark.createDataFrame(stock, STOCK),
        spark.createDataFrame(goods, GOODS),
        AS_OF,
        **options,
    ).collect()


def test_psd_edges(spark):
    cost = [
        (43, "a", "sold", AS_OF, 1, Decimal(6), Decimal(1)),
        (43, "a", "sold", AS_OF - dt.timedelta(27), 1, Decimal(2), Decimal(1)),
        (43, "a", "sold", AS_OF - dt.timedelta(28), 1, Decimal(99), Decimal(1)),
        (43, "a", "idle", AS_OF, 0, None, Decimal(0)),
        (43, "a", "unknown", AS_OF, 1, Decimal(6), Decimal(1)),
    ]
    goods = [
        (43, "sold", "b", "n", "S", None, Decimal(2), Decimal(3)),
        (43, "idle", "b", "n", "I", None, None, None),
        (85, "unknown", "b", "n", "U", None, Decimal(2), Decimal(3)),
    ]
    rows = {r.foreign_item_id: r for r in velocity(spark, cost, [], goods)}
    assert set(rows) == {"sold", "idle"}
    assert (rows["sold"].sum_total_sale, rows["sold"].psd, rows["sold"].psd_cost) == (8.0, 4.0, 8.0)
    assert (rows["idle"].psd, rows["idle"].psd_cost) == (0.0, None)
    kept = {r.foreign_item_id: r for r in velocity(spark, cost, [], goods, null_keys="keep")}
    assert kept["unknown"].item_show_code is None and kept["unknown"].psd == 6.0


def test_repeated_goods_rows(spark):
    """Rows of one show code count again, a second show code makes a second result."""
    cost = [(43, "a", "x", AS_OF, 1, Decimal(6), Decimal(1))]
    goods = [(43, "x", "b", "n", code, None, Decimal(p), Decimal(3)) for code, p in (("S", 2), ("S", 5), ("T", 1))]
    rows = {r.item_show_code: r for r in velocity(spark, cost, [], goods)}
    assert (rows["S"].sum_total_sale, rows["S"].psd, rows["S"].lastin_price) == (12.0, 6.0, 5.0)
    assert (rows["T"].sum_total_sale, rows["T"].psd) == (6.0, 6.0)


def test_empty_facts(spark):
    assert velocity(spark, [], [], []) == []
    assert velocity(spark, [], [], [], unique_days=True) == []


def test_product_info_multiplies_repeated_labels(spark):
    cost = [(43, "a", "x", AS_OF, 1, Decimal(6), Decimal(1)), (43, "1000000", "x", AS_OF, 1, Decimal(6), Decimal(1))]
    goods = [(43, "x", "b", "n", "S", "ok", Decimal(2), Decimal(3))] * 2
    stores = [(43, "a", "A", "open")] * 3
    ways = [(43, "a", "x", w) for w in ("w", "w", "v")]
    rows = product_info.product_info(
        spark.createDataFrame(cost, COST),
        spark.createDataFrame([], STOCK),
        spark.createDataFrame(goods, GOODS),
        spark.createDataFrame(stores, "cmid int, foreign_store_id string, store_name string, store_status string"),
        spark.createDataFrame(ways, "cmid int, foreign_store_id string, foreign_item_id string, alc_way string"),
        AS_OF,
    ).collect()
    assert {r.delivery_method: (r.days, r.total_sale, r.psd) for r in rows} == {"w": (12, 72.0, 6.0), "v": (6, 36.0, 6.0)}


LARGEST = Decimal("99999999999999.9999")


@pytest.mark.parametrize("amount", [LARGEST, -LARGEST, Decimal("-0.0001"), Decimal("107374.1824"), Decimal("112589990684.2624")])
def test_amounts_are_exact(spark, amount):
    """Three sales rows that meet five stock rows, next to a single one of the day before and a null amount."""
    before = AS_OF - dt.timedelta(1)
    cost = [(43, "a", "x", AS_OF, 1, amount, amount)] * 3 + [(43, "a", "x", before, 1, amount, None)]
    stock = spark.createDataFrame([(43, "a", "x", AS_OF, 1)] * 5, STOCK)
    found = presence.pair_activity(spark.createDataFrame(cost, COST), stock, AS_OF).first()
    assert (found.total_sale, found.total_cost) == (16 * amount, 15 * amount)
    found = presence.pair_activity(spark.createDataFrame(cost[2:], COST), stock.limit(1), AS_OF, unique_days=True).first()
    assert (found.total_sale, found.total_cost) == (2 * amount, amount)
    label = "cmid int, foreign_store_id string, "
    info = product_info.product_info(
        spark.createDataFrame(cost, COST),
        stock,
        spark.createDataFrame([], GOODS),
        spark.createDataFrame([(43, "a", "A", "open")] * 2, label + "store_name string, store_status string"),
        spark.createDataFrame([], label + "foreign_item_id string, alc_way string"),
        AS_OF,
        null_keys="keep",
    ).first()
    assert (info.total_sale, info.total_cost) == (float(32 * amount), float(30 * amount))


def test_product_info_carries_numbers_and_narrow_labels(spark):
    """Amounts are no wide decimals in aggregates, delivery ways are sorted once, and stores are joined before the wider goods."""
    label = "cmid int, foreign_store_id string, "
    tables = (COST, STOCK, GOODS, label + "store_name string, store_status string", label + "foreign_item_id string, alc_way string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = product_info.product_info(*[spark.createDataFrame([], t).repartition(2) for t in tables], AS_OF, null_keys="keep")
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "sum(total_sale_high" in plan and "sum(total_sale#" not in plan
    assert 0 < plan.index("SortMergeJoin [foreign_item_id") < plan.index("SortMergeJoin [foreign_store_id")
    lines = plan.splitlines()
    folded = next(k for k, line in enumerate(lines) if "max(alc_way" in line)
    assert "+- SortAggregate" in lines[folded] and "Sort [" not in lines[folded - 1]


COST_ROW = [(43, "a", "x", AS_OF, 1, Decimal(10), Decimal(1))]
STOCK_ROW = [(43, "a", "x", AS_OF, 3)]


@pytest.mark.parametrize("rule", presence.PRESENCE_RULES)
def test_a_broken_promise_of_unique_days_fails(spark, rule):
    """Two equal sales rows and a stock row of a day."""
    cost = spark.createDataFrame(COST_ROW * 2, COST)
    stock = spark.createDataFrame(STOCK_ROW, STOCK)
    for a, b in ((cost, stock), (cost.limit(1), stock.union(stock))):
        with pytest.raises(Exception, match="more than one row of a day key"):
            presence.pair_activity(a, b, AS_OF, 28, rule, unique_days=True).collect()
    assert presence.pair_activity(cost.limit(1), stock, AS_OF, 28, rule, unique_days=True).first().days == 1
