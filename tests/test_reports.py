"""Stock-out report, loads, weekly tables, trial stores, supervisors on small edge tables."""

import datetime as dt
from decimal import Decimal

import pytest

from shelfwise.functions import numbers
from shelfwise.operators import actual_sale, assortment, dimensions, reports, stockout, supervisor, trial, weekly

D = dt.date
KEY = "cmid int, foreign_store_id string, foreign_item_id string"
END = D(2024, 1, 30)


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def report_inputs(spark):
    """Store a: delivery on 28 Jan, suggestion only two days before. Store b: no central delivery."""
    items = ("empty", "negative", "offset", "full", "gone")
    return {
        "cost": table(
            spark,
            f"{KEY}, date date, sale_quantity bigint, total_sale double",
            *[(43, "a", "empty", END - dt.timedelta(n), 2, 7.0) for n in (0, 3, 6, 7, 27, 28, 59, 60)],
        ),
        "inventory": table(
            spark,
            f"{KEY}, date date, quantity bigint",
            (43, "a", "negative", END, -1),
            (43, "a", "offset", END, -2),
            (43, "a", "offset", END, 2),
            (43, "a", "full", END, 5),
            (43, "a", "empty", D(2024, 1, 26), 9),
            (43, "a", "empty", D(2024, 1, 29), 8),
        ),
        "cm_sku": table(
            spark,
            f"{KEY}, busgate string",
            *[(43, "a", i, "R" if i == "gone" else "A") for i in items],
            (43, "a", "empty", "A"),
            (43, "b", "empty", "A"),
        ),
        "delivery": table(
            spark,
            f"{KEY}, delivery_date date, delivery_qty bigint, delivery_type string",
            (43, "a", "empty", D(2024, 1, 28), 3, "统配出"),
            (43, "a", "empty", D(2024, 1, 28), 4, "统配出"),
            (43, "a", "empty", D(2024, 1, 29), 100, "直配出"),
            (43, "a", "offset", D(2024, 1, 20), 100, "统配出"),
            (43, "b", "empty", D(2024, 1, 29), 1, "直配出"),
        ),
        "suggestions": table(
            spark,
            f"{KEY}, date date, fill_qty bigint",
            (43, "a", "offset", D(2024, 1, 26), 6),
            (43, "a", "empty", D(2024, 1, 25), 6),
        ),
        "require_orders": table(spark, f"{KEY}, date date, order_qty bigint", (43, "a", "empty", D(2024, 1, 27), 5)),
        "aa_sku": table(spark, KEY, (43, "a", "empty")),
        "refunds": table(spark, f"{KEY}, method string", (43, "a", "offset", "退货")),
        "warehouse": table(
            spark,
            "cmid int, foreign_item_id string, date date, stock_qty bigint",
            (43, "empty", D(2024, 1, 27), 70),
            (43, "empty", D(2024, 1, 28), 99),
        ),
        "goods": table(spark, "cmid int, foreign_item_id string, show_code string, item_name string", (43, "empty", "E", "Empty")),
        "stores": table(
            spark, "cmid int, foreign_store_id string, store_name string, property_id int", (43, "a", "A", 2), (43, "b", "B", 1)
        ),
    }


CAUSES = ["inventory", "cm_sku", "delivery", "suggestions", "require_orders"]


def test_summary(spark):
    t = report_inputs(spark)
    dates = stockout.reference_dates(t["delivery"], t["suggestions"], t["stores"])
    rows = stockout.stockout_summary(*[t[n] for n in CAUSES], dates, END, ["A"]).collect()
    a, b = sorted(rows, key=lambda r: r.foreign_store_id)
    assert (a.lost_sku, a.all_sku, a.store_lost_rate, a.store_type) == (2, 4, 0.5, "直营")
    assert (a.un_suggest, a.un_order, a.un_deliver) == (1, 1, 1)
    assert (a.suggest_date, a.require_date, a.delivery_date) == (D(2024, 1, 26), D(2024, 1, 27), D(2024, 1, 28))
    assert (b.lost_sku, b.un_suggest_rate, b.delivery_date, b.store_type) == (1, 1.0, None, "加盟")
    only = stockout.stockout_summary(*[t[n] for n in CAUSES], dates, END, ["A"], table(spark, "cmid int, foreign_store_id string", (43, "b"), (85, "a"))).collect()
    assert [r.foreign_store_id for r in only] == ["b"]


def test_unknown_quantity_is_not_missing(spark):
    t = report_inputs(spark)
    dates = stockout.reference_dates(t["delivery"], t["suggestions"], t["stores"])
    t["suggestions"] = table(spark, f"{KEY}, date date, fill_qty bigint", (43, "a", "empty", D(2024, 1, 26), None))
    t["require_orders"] = table(spark, f"{KEY}, date date, order_qty bigint", (43, "a", "empty", D(2024, 1, 27), 0))
    rows = stockout.stockout_summary(*[t[n] for n in CAUSES], dates, END, ["A"], table(spark, "cmid int, foreign_store_id string", (43, "a"))).collect()
    assert (rows[0].lost_sku, rows[0].un_suggest, rows[0].un_order) == (2, 1, 2)
    names = ["cost", *CAUSES, "aa_sku", "refunds", "warehouse", "goods"]
    detail = stockout.stockout_detail(*[t[n] for n in names], dates, END, ["A"], table(spark, "cmid int, foreign_store_id string", (43, "a"))).collect()
    assert {r.foreign_item_id: (r.cm_suggest, r.store_book) for r in detail} == {"empty": (None, 0.0), "offset": (0.0, 0.0)}


def test_detail_neither_sorts_refunds_nor_joins_by_item_twice(spark):
    """The largest cause and the stock of the order day, without a sorted aggregate of texts or a second join by item."""
    t = report_inputs(spark)
    dates = stockout.reference_dates(t["delivery"], t["suggestions"], t["stores"])
    method = f"{KEY}, method string"
    t["refunds"] = table(
        spark, method, (43, "a", "empty", "b"), (43, "a", "empty", "é"), (43, "a", "empty", None), (43, "a", "empty", "a"),
        (43, "a", "offset", None), (43, "a", None, "z"), (43, "b", "empty", "B"), (43, "b", "other", "a"), (43, "b", "other", "Z"),
    )
    day, next_day = D(2024, 1, 27), D(2024, 1, 28)
    t["warehouse"] = table(
        spark, "cmid int, foreign_item_id string, date date, stock_qty bigint",
        (43, "empty", day, 70), (43, "empty", day, 71), (43, "empty", day, None), (43, "empty", next_day, 99), (43, "offset", next_day, 5), (43, None, day, 8),
    )
    t["cm_sku"] = t["cm_sku"].union(table(spark, f"{KEY}, busgate string", (43, "a", None, "A")))
    names = ["cost", *CAUSES, "aa_sku", "refunds", "warehouse", "goods"]
    detail = stockout.stockout_detail(*[t[n] for n in names], dates, END, ["A"])
    got = {(r.foreign_store_id, r.foreign_item_id): (r.cause, r.warehouse_stock) for r in detail.collect()}
    assert got == {("a", "empty"): ("é", 71.0), ("a", "offset"): ("", 0.0), ("b", "empty"): ("B", 0.0), ("a", None): ("", 0.0)}
    plan = detail._jdf.queryExecution().optimizedPlan().toString()
    assert "max(method#" not in plan
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line and "foreign_item_id" in line]
    assert len(joins) == 1


def test_sums_in_parts_are_exact(spark):
    amounts = [Decimal("99999999999999.9999")] * 3 + [Decimal("-0.0001"), Decimal("-12345.6789"), None]
    rows = spark.createDataFrame([(k % 2, a) for k, a in enumerate(amounts)] + [(2, None)], "k int, a decimal(18,4)")
    got = rows.groupBy("k").agg(*numbers.part_sums("a", "a")).select("k", numbers.sum_of_parts("a").alias("a")).collect()
    assert {r.k: r.a for r in got} == {0: 2 * amounts[0] + amounts[4], 1: amounts[0] + amounts[3], 2: None}


def test_store_snapshot_falls_back_per_tenant(spark):
    days = [(43, "a", D(2024, 1, 30)), (43, "old", D(2024, 1, 29)), (85, "b", D(2024, 1, 29)), (34, "c", D(2024, 1, 28))]
    snapshots = table(spark, "cmid int, foreign_store_id string, date date", *days)
    assert sorted(r.foreign_store_id for r in stockout.asof_store_snapshot(snapshots, END).collect()) == ["a", "b"]


def test_summary_without_empty_items(spark):
    t = report_inputs(spark)
    dates = stockout.reference_dates(t["delivery"], t["suggestions"], t["stores"])
    t["cm_sku"] = t["cm_sku"].filter("foreign_item_id = 'full'")
    [row] = stockout.stockout_summary(*[t[n] for n in CAUSES], dates, END, ["A"]).collect()
    assert (row.lost_sku, row.store_lost_rate, row.un_order_rate) == (0, 0.0, None)


def test_detail(spark):
    t = report_inputs(spark)
    dates = stockout.reference_dates(t["delivery"], t["suggestions"], t["stores"])
    names = ["cost", *CAUSES, "aa_sku", "refunds", "warehouse", "goods"]
    rows = {
        (r.foreign_store_id, r.foreign_item_id): r
        for r in stockout.stockout_detail(*[t[n] for n in names], dates, END, ["A"]).collect()
    }
    assert set(rows) == {("a", "empty"), ("a", "offset"), ("b", "empty")}
    e, o = rows["a", "empty"], rows["a", "offset"]
    assert (e.sale_days_60, e.sale_days_28, e.avg_sale_7, e.avg_quantity_7, e.avg_qty) == (7, 5, 3.0, 6 / 7, 2.0)
    assert (e.order_stock, e.cm_suggest, e.store_book, e.inv_delivery, e.warehouse_stock) == (9.0, 0.0, 5.0, 7.0, 70.0)
    assert (e.item_show_code, e.is_aa, e.cause) == ("E", "是", "")
    assert (o.actual_stock, o.cm_suggest, o.inv_delivery, o.is_aa, o.cause, o.item_name) == (2.0, 6.0, 0.0, "否", "退货", None)
    assert [tuple(r) for r in stockout.stockout_items(t["cm_sku"], t["inventory"], END, ["A"]).orderBy("foreign_store_id", "foreign_item_id").collect()] == [
        (43, "a", "empty"), (43, "a", "offset"), (43, "b", "empty"),
    ]


def test_gate_statuses(spark):
    rows = [(1, [], ["x"]), (2, ["a"], ["x"]), (3, None, ["y", "z"])]
    settings = spark.createDataFrame(rows, "cmid int, item_status_code array<string>, foreign_item_status array<string>")
    assert sorted(map(tuple, stockout.gate_statuses(settings).collect())) == [(1, "x"), (2, "a"), (3, "y"), (3, "z")]


def test_exact_suggestion_day_wins(spark):
    t = report_inputs(spark)
    exact = table(spark, f"{KEY}, date date, fill_qty bigint", (43, "a", "other", D(2024, 1, 27), 1))
    dates = stockout.reference_dates(t["delivery"], t["suggestions"].union(exact), t["stores"])
    rows = stockout.asof_suggestion(t["suggestions"].union(exact), dates).collect()
    assert [(r.foreign_item_id, r.date) for r in rows] == [("other", D(2024, 1, 27))]


def test_latest_quantity_and_ranks_on_ties(spark):
    day = D(2024, 1, 30)
    stock = table(
        spark, f"{KEY}, date date, quantity bigint",
        (43, "a", "x", day, 4), (43, "a", "x", day, 7), (43, "a", "x", D(2024, 1, 29), 99), (43, "a", "y", day, None),
    )
    cost = table(spark, f"{KEY}, date date, sale_quantity bigint", (43, "a", "x", day, 1), (43, "a", "x", day, 1))
    latest = {r.foreign_item_id: r.quantity for r in actual_sale.latest_quantity(stock, END).collect()}
    assert latest == {"x": 7, "y": None}

    def ranks(rank):
        rows = actual_sale.actual_sale(cost, stock, END, rank=rank, store=(43, "a")).collect()
        return sorted((r.actual_quantity, r.sale_quantity, r.rank_num) for r in rows if r.foreign_item_id == "x")

    assert ranks("row_number") == [(4, 1, 2), (7, 1, 3), (99, 0, 1)]
    assert ranks("dense") == [(4, 1, 2), (7, 1, 2), (99, 0, 1)]
    with pytest.raises(Exception, match="two different rows"):
        actual_sale.unique_daily_series(cost, stock, END).collect()
    once = stock.filter("quantity IS NULL OR quantity <> 7")
    rows = actual_sale.unique_daily_series(cost, once.union(once), END).filter("foreign_item_id = 'x'").collect()
    assert sorted((r.date.day, r.quantity, r.sale_quantity) for r in rows) == [(29, 99, 0), (30, 4, 1)]


STORE_INFO = "cmid int, foreign_store_id string, store_name string, date date, lost_sku bigint, all_sku bigint"
PRODUCTS = f"{KEY}, store_show_code string, item_show_code string, date date, lost_reason bigint"


def test_weekly(spark):
    info = table(
        spark, STORE_INFO,
        (43, "a", "A", D(2019, 12, 30), 1, 10), (43, "a", "A", D(2020, 1, 5), 0, 12),
        (43, "b", "B", D(2020, 1, 1), 0, 0),
        (43, "a", "A", D(2019, 10, 13), 0, 5), (43, "a", "A", D(2019, 10, 14), 0, 5),
    )
    products = table(
        spark, PRODUCTS,
        (43, "a", "i", "SA", "P1", D(2019, 12, 30), 1), (43, "a", "i", "SA", "P1", D(2020, 1, 5), 5),
        (43, "a", "j", "SA", None, D(2020, 1, 4), 4),
    )
    [four] = weekly.week_reasons(products).collect()
    assert (four.cm_suggest, four.store_book, four.inv_delivery, four.other_reason) == (1, 0, 0, 1)
    assert (four.date, four.y, four.wk) == (D(2019, 12, 30), 2019, 1)
    [five] = weekly.week_reasons(products, classes=5).collect()
    assert (five.cm_suggest, five.return_goods, five.other_reason, five.date, five.y) == (1, 1, 1, D(2020, 1, 5), 2020)
    by_sql = {(r.foreign_store_id, r.date): r for r in weekly.week_store_info(info, products).collect()}
    a = by_sql["a", D(2020, 1, 5)]
    assert (a.lost_sku, a.all_sku, a.store_lost_rate, a.store_show_code) == (2, 12, 2 / 12, "SA")
    assert by_sql["b", D(2020, 1, 5)].lost_sku is None and by_sql["b", D(2020, 1, 5)].store_show_code is None
    stores = table(spark, "cmid int, foreign_store_id string, show_code string, store_name string", (43, "a", "SA", "A"))
    by_df = {(r.foreign_store_id, r.date): r for r in weekly.week_store_info_df(info, products, stores, "2020-01-05").collect()}
    assert set(by_df) == {("a", D(2020, 1, 5)), ("b", D(2020, 1, 5)), ("a", D(2019, 10, 20))}
    a = by_df["a", D(2020, 1, 5)]
    assert (a.lost_sku, a.y, a.wk, a.store_show_code) == (2, "2020", "01", "SA")
    b = by_df["b", D(2020, 1, 5)]
    assert (b.lost_sku, b.all_sku, b.store_lost_rate, b.store_name) == (0, 0, None, None)


def test_store_load_drops_unknown_and_closed_stores(spark):
    sheet = table(
        spark, "cmid int, `门店ID` string, `门店名称` string, `门店缺货率` double, `现门店已缺货 SKU 数` bigint, `门店统配商品全量 SKU 数` bigint, date string",
        *[(43, s, s, 0.1, 1, 10, "2024-01-30") for s in ("open", "closed", "unknown")],
    )
    stores = table(
        spark, "cmid int, foreign_store_id string, show_code string, store_status string",
        (43, "open", "SO", None), (43, "closed", "SC", "闭店"), (85, "unknown", "SU", "营业"),
    )
    enrolled = table(spark, "cmid int, foreign_store_id string", (43, "open"), (43, "open"), (43, "unknown"))
    labels = reports.store_labels(stores, enrolled)
    [row] = reports.store_info_load(sheet, labels).collect()
    assert (row.foreign_store_id, row.store_show_code, row.date, row.store_score) == ("open", "SO", END, None)
    detail = table(
        spark, "cmid int, `门店ID` string, `商品名称` string, `当前库存` double, `商品show_code` string, `今日销量` double, `密度` string, "
        "`原因` string, `上上次建议单` double, `上上次订货单` double, `上次送货单` double, date string",
        *[(43, s, "n", 1.0, "P", 1.0, "低", None, 5.0, 9.0, 1.0, "2024-01-30") for s in ("open", "closed", "unknown", "nowhere")],
    )
    first = table(spark, "cmid int, use_date date", (85, D(2020, 1, 1)))
    psd = table(
        spark, "cmid int, foreign_store_id string, foreign_item_id string, item_show_code string, date date, psd_cost double",
        (43, "open", "i", "P", END, 2.5), (43, "unknown", "i", "P", D(2024, 1, 29), 9.9),
    )
    rows = {r.foreign_store_id: r for r in reports.product_exception_load(detail, labels, first, psd, END).collect()}
    assert set(rows) == {"open", "unknown", "nowhere"}
    assert {k: (r.lost_reason, r.store_show_code, r.psd_cost) for k, r in rows.items()} == {
        "open": (3, "SO", 2.5), "unknown": (3, None, None), "nowhere": (3, None, None),
    }
    assert rows["open"].use_date == END and rows["open"].strategy_type == "规则"


def test_trial_state_and_days(spark):
    stores = table(
        spark, "cmid int, foreign_store_id string, show_code string, date date, end_date date, execute_date date, deal_status int",
        (43, "due", "S", D(2024, 1, 1), D(2024, 2, 10), D(2024, 1, 28), 1),
        (43, "over", "S", D(2024, 1, 1), D(2024, 1, 29), D(2024, 1, 27), 2),
        (43, "candidate", "S", D(2024, 1, 1), D(2024, 2, 10), D(2024, 1, 28), 0),
        (43, "late", "S", D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 28), 1),
        (43, "done", "S", D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 28), 0),
    )
    state = {r.foreign_store_id: (r.deal_status, r.execute_date.day) for r in trial.trial_state(stores, "2024-01-31").collect()}
    assert state == {"due": (1, 31), "over": (0, 31), "candidate": (0, 31), "late": (1, 31), "done": (0, 28)}
    days = sorted((r.foreign_store_id, r.date.day) for r in trial.trial_expand(stores, "2024-01-31").collect())
    assert days == [("due", 28), ("due", 29), ("over", 27), ("over", 28)]


def test_assortment(spark):
    goods = table(
        spark, "cmid int, foreign_item_id string, foreign_category_lv1 string, item_name string",
        (43, "sold", "c", "Sold"), (43, "held", "c", "Held"), (43, "null", None, "N"), (43, "ignored", "x", "I"), (43, "blank", "", "B"),
    )
    first, last = D(2024, 1, 1), D(2024, 1, 29)
    cost = table(spark, f"{KEY}, date date", *[(43, "a", i, last) for i in ("null", "ignored", "unknown", "blank")],
                 (43, "a", "sold", first), (43, "b", "sold", D(2023, 12, 31)), (43, "c", "sold", END))
    stock = table(spark, f"{KEY}, date date, quantity bigint, amount double",
                  (43, "a", "held", last, 1, 1.0), (43, "b", "held", last, 1, 0.0), (43, "c", "held", last, 0, 1.0), (43, "a", "sold", last, 1, 1.0))
    stores = table(spark, "cmid int, foreign_store_id string, store_name string", (43, "a", "A"))
    rows = assortment.sku_cache(cost, stock, goods, stores, END, 1, ["x"]).collect()
    assert sorted((r.foreign_store_id, r.foreign_item_id, r.foreign_item_name, r.foreign_store_name) for r in rows) == [
        ("a", "blank", "B", "A"), ("a", "held", "Held", "A"), ("a", "sold", "Sold", "A"),
    ]
    assert assortment.sku_cache(cost, stock, goods, stores, END, 1).filter("foreign_item_id = 'blank'").isEmpty()


def test_supervisors(spark):
    people = table(
        spark, "cmid int, user_id bigint, user_name string, first_name string, level int, stores string",
        (43, 1, "boss", "B", 1, None), (43, 2, "older boss", "O", 1, None),
        (43, 3, "area", "A", 2, '[{"id":"S1"},{"id":"S9"}]'), (43, 4, "shop", "S", 3, '[{"id":"S1"}]'),
        (85, 5, "lonely", "L", 2, "[]"),
    )
    resources = table(spark, "cmid int, showcode string", (43, "S1"), (43, "S2"), (85, "T1"))
    rows = supervisor.supervisor_map(people, resources).collect()
    assert sorted((r.cmid, r.foreign_store_id, r.user_name) for r in rows) == [
        (43, "S1", "shop"), (43, "S2", "older boss"), (43, "S9", "area"),
    ]


def test_pack_sizes(spark):
    a = table(spark, "cmid int, gid int, qpc double, isdu int", (43, 1, 6.0, 2), (43, 1, 6.0, 2), (43, 2, 9.0, 1))
    assert [tuple(r) for r in dimensions.packsize_distinct(a).collect()] == [(43, "1", 6.0)]
    b = table(spark, "cmid int, foreign_item_id int, qpc double", (34, 1, 6.0), (34, 1, 7.0))
    assert dimensions.packsize_distinct(b, vendor="B").count() == 2
    counts = dimensions.packsize_counts(table(spark, "cmid int, foreign_item_id string, mfu double", (43, "1", 6.0), (43, "1", 6.0), (43, "2", None), (85, "1", 6.0)))
    assert sorted(map(tuple, counts.collect())) == [
        (43, "foreign_item_id", 3, 2), (43, "mfu", 2, 1), (85, "foreign_item_id", 1, 1), (85, "mfu", 1, 1),
    ]


def test_non_empty_report_may_stop_at_the_first_row(spark):
    frames = {"some": spark.range(5), "none": spark.range(0)}
    counts = {r.table_name: (r.row_count, r.is_ok) for r in dimensions.non_empty_report(frames).collect()}
    firsts = {r.table_name: (r.row_count, r.is_ok) for r in dimensions.non_empty_report(frames, counted=False).collect()}
    assert counts == {"some": (5, True), "none": (0, False)} and firsts == {"some": (1, True), "none": (0, False)}
