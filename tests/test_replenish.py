"""The folded sequence against a plain day-by-day loop."""

import datetime as dt
import math
import random

import pytest

from shelfwise.operators import replenish

START = dt.date(2024, 1, 1)
SERIES = (
    "cmid int, foreign_store_id string, foreign_item_id string, date date, demand bigint, "
    "can_request_order int, opening_stock bigint, mfu double"
)


def simulate(days, stock, mfu):
    """days: list of (demand, can_order)."""
    out = []
    for i, (demand, can) in enumerate(days):
        later = [j for j in range(i + 1, len(days)) if days[j][1] == 1]
        future = sum(d for d, _ in days[i + 1 : later[0] + 1]) if later else days[-1][0]
        remain = max(stock - demand, 0)
        should = int(can == 1 and future > stock - demand)
        fill = int(mfu * math.ceil((future - remain) / mfu)) if should else 0
        out.append((future, should, fill, stock))
        stock = remain + fill
    return out


def groups(seed, n, returns):
    rng = random.Random(seed)
    for g in range(n):
        low = -4 if returns else 0
        days = [(rng.randint(low, 12), rng.randint(0, 1)) for _ in range(rng.randint(1, 28))]
        yield str(g), days, rng.randint(-3 if returns else 0, 30), rng.choice([1.0, 2.5, 6.0, 24.0])


@pytest.mark.parametrize("returns", [False, True])
def test_sequence_matches_loop(spark, returns):
    data = list(groups(7, 150, returns))
    rows = [
        (43, "s", item, START + dt.timedelta(i), demand, can, stock, mfu)
        for item, days, stock, mfu in data
        for i, (demand, can) in enumerate(days)
    ]
    random.Random(1).shuffle(rows)
    series = spark.createDataFrame(rows, SERIES)
    want = {
        (item, START + dt.timedelta(i)): step
        for item, days, stock, mfu in data
        for i, step in enumerate(simulate(days, stock, mfu))
    }
    future = {(r.foreign_item_id, r.date): r.future_demand for r in replenish.future_demand(series).collect()}
    assert future == {k: v[0] for k, v in want.items()}
    got = replenish.replenish(series).collect()
    assert {(r.foreign_item_id, r.date): (r.should_fill, r.fill_qty, r.cur_stock) for r in got} == {
        k: v[1:] for k, v in want.items()
    }
    if not returns:
        assert all(r.cur_stock >= 0 and r.fill_qty >= 0 for r in got)
        packs = {item: mfu for item, _, _, mfu in data}
        whole = [r for r in got if packs[r.foreign_item_id].is_integer()]
        assert all(r.fill_qty % packs[r.foreign_item_id] == 0 for r in whole)


def test_one_exchange_feeds_windows_and_fold(spark):
    series = spark.createDataFrame([(43, "s", "i", START, 1, 1, 1, 1.0)], SERIES)
    plan = replenish.replenish(series)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


PRODUCTS = "cmid int, foreign_store_id string, foreign_item_id string, foreign_store_name string, foreign_item_name string"
DAILY = "cmid int, foreign_store_id string, foreign_item_id string, date date, quantity bigint, sale_quantity bigint"


def test_history_and_rejects(spark):
    products = spark.createDataFrame([(43, "s", i, "S", i.upper()) for i in ("ok", "nopack", "zero", "noseries")], PRODUCTS)
    packs = spark.createDataFrame([(43, "ok", 4.0), (43, "zero", 0.0), (43, "noseries", 2.0)], "cmid int, foreign_item_id string, mfu double")
    cycles = spark.createDataFrame([(43, "s", 1)], "cmid int, foreign_store_id string, period_type_num int")
    daily = spark.createDataFrame(
        [(43, "s", i, START + dt.timedelta(n), 5 - n, 2) for i in ("ok", "nopack", "zero") for n in range(3)], DAILY
    )
    prepared = replenish.replenish_input(products, packs, cycles, daily)
    done = sorted(replenish.replenish_history(prepared).collect(), key=lambda r: r.date)
    loop = simulate([(2, 1), (2, 0), (2, 1)], 5, 4.0)
    assert [(r.foreign_item_name, r.fill_qty, r.theory_stock, r.prediction_stock) for r in done] == [
        ("OK", float(fill), stock, 5 - n) for n, (_, _, fill, stock) in enumerate(loop)
    ]
    rejected = {r.foreign_item_id for r in replenish.replenish_rejects(prepared).collect()}
    assert rejected == {"nopack", "zero", "noseries"}
    assert done and len(done) + replenish.replenish_rejects(prepared).count() == prepared.count()


def test_each_pack_size_has_its_own_sequence(spark):
    days = [(3, 1), (5, 0), (4, 1), (2, 0)]
    rows = [
        (43, "s", "i", START + dt.timedelta(n), demand, can, 4, mfu)
        for mfu in (2.0, 9.0)
        for n, (demand, can) in enumerate(days)
    ]
    got = replenish.replenish(spark.createDataFrame(rows, SERIES)).collect()
    want = [(START + dt.timedelta(n), *step[1:]) for mfu in (2.0, 9.0) for n, step in enumerate(simulate(days, 4, mfu))]
    assert sorted((r.date, r.should_fill, r.fill_qty, r.cur_stock) for r in got) == sorted(want)
