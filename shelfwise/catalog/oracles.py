"""The same results as plain SQL over the base tables, one statement per query."""

from __future__ import annotations

from shelfwise.catalog.fixtures import E_AS_OF, EVENTS, L_AS_OF, L_DAYS, LINEITEM, SHARED, TODAY, ctes

PAIR = "cmid, foreign_store_id, foreign_item_id"
DAY = f"{PAIR}, date"


def _twice(texts: dict[str, str]) -> dict[str, str]:
    """The fixture set with every row of an odd day twice in both facts."""
    both = "SELECT * FROM ({0}) a UNION ALL SELECT * FROM ({0}) b WHERE day(date) % 2 = 1"
    return texts | {name: both.format(texts[name]) for name in ("cost", "inventory")}


def _window(as_of: str, days: int) -> str:
    return f"date > DATE '{as_of}' - {days} AND date <= DATE '{as_of}'"


def _joined(as_of: str, days: int) -> str:
    """CTE `sku`: the plain full join of the window, one row per joined pair of rows."""
    return f""", sku AS (
    SELECT coalesce(c.cmid, i.cmid) AS cmid, coalesce(c.foreign_store_id, i.foreign_store_id) AS foreign_store_id,
      coalesce(c.foreign_item_id, i.foreign_item_id) AS foreign_item_id, coalesce(c.date, i.date) AS date,
      coalesce(i.quantity, 0) AS quantity, coalesce(c.total_sale, 0) AS total_sale, coalesce(c.total_cost, 0) AS total_cost,
      CASE WHEN c.cmid IS NULL THEN 1 WHEN c.total_sale > 0 THEN 1 ELSE 0 END AS listed,
      CASE WHEN i.quantity > 0 OR c.total_sale > 0 THEN 1 ELSE 0 END AS stock_or_sale,
      i.cmid IS NOT NULL AS in_stock_table
    FROM (SELECT * FROM cost WHERE {_window(as_of, days)}) c
    FULL JOIN (SELECT * FROM inventory WHERE {_window(as_of, days)}) i
      ON c.cmid = i.cmid AND c.foreign_store_id = i.foreign_store_id AND c.foreign_item_id = i.foreign_item_id AND c.date = i.date)
"""


_ACTIVE = "SELECT * FROM goods WHERE item_status IS NULL OR item_status NOT IN ('淘汰', '淘汰品')"


def _psd(texts, as_of, days, flag="listed", goods=_ACTIVE, where="", codes="g.show_code IS NOT NULL") -> str:
    return (
        ctes(texts, "cost", "inventory", "goods", "stores")
        + _joined(as_of, days)
        + f""", g AS ({goods}),
    t AS (SELECT s.cmid, s.foreign_store_id, s.foreign_item_id, g.show_code, sum({flag}) AS days,
      CAST(sum(total_sale) AS double) AS sale, CAST(max(g.lastin_price) AS double) AS price
      FROM sku s LEFT JOIN g ON g.cmid = s.cmid AND g.foreign_item_id = s.foreign_item_id
      WHERE {codes} {where} GROUP BY 1, 2, 3, 4),
    p AS (SELECT *, CASE WHEN days = 0 THEN 0.0 ELSE sale / days END AS psd FROM t)
    SELECT {PAIR}, sale AS sum_total_sale, psd, price AS lastin_price, psd * price AS psd_cost,
      DATE '{as_of}' AS date, show_code AS item_show_code FROM p"""
    )


def _product_info(texts, as_of, days, flag, keep_nulls) -> str:
    keys = "item_name, item_status, show_code, store_name, store_status, barcode, alc_way"
    drop = "" if keep_nulls else "WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return (
        ctes(texts, "cost", "inventory", "goods", "stores", "ways")
        + _joined(as_of, days)
        + f""", j AS (SELECT s.*, g.item_name, g.item_status, g.show_code, g.barcode, g.lastin_price, g.sale_price,
      st.store_name, st.store_status, w.alc_way
      FROM sku s
      LEFT JOIN ({"SELECT * FROM goods" if keep_nulls else _ACTIVE}) g ON g.cmid = s.cmid AND g.foreign_item_id = s.foreign_item_id
      LEFT JOIN stores st ON st.cmid = s.cmid AND st.foreign_store_id = s.foreign_store_id
      LEFT JOIN ways w ON w.cmid = s.cmid AND w.foreign_store_id = s.foreign_store_id AND w.foreign_item_id = s.foreign_item_id
      WHERE s.foreign_store_id <> '1000000'),
    t AS (SELECT {PAIR}, {keys}, sum({flag}) AS n, CAST(sum(total_sale) AS double) AS sale,
      CAST(sum(total_cost) AS double) AS outlay, CAST(max(lastin_price) AS double) AS lastin,
      CAST(max(sale_price) AS double) AS price FROM j {drop} GROUP BY {PAIR}, {keys}),
    p AS (SELECT *, CASE WHEN n = 0 THEN 0.0 ELSE sale / n END AS psd FROM t)
    SELECT cmid, foreign_store_id, store_name AS foreign_store_name, foreign_item_id, barcode, item_name, item_status,
      show_code AS item_show_code, alc_way AS delivery_method, store_status, CAST(n AS integer) AS days, psd,
      sale AS total_sale, outlay AS total_cost, sale / {days} AS avg_sale, lastin AS lastin_price, price AS sale_price,
      psd * lastin AS psd_cost, DATE '{as_of}' AS update_date FROM p"""
    )


def _inventory_driven() -> str:
    return (
        ctes(EVENTS, "cost", "inventory", "goods", "stores")
        + _joined(E_AS_OF, 28)
        + f""", t AS (SELECT s.cmid, s.foreign_store_id, st.store_name, st.store_status, g.barcode, s.foreign_item_id, g.item_name,
      g.show_code, sum(stock_or_sale) AS n, CAST(sum(total_sale) AS double) AS sale, CAST(sum(total_cost) AS double) AS outlay,
      CAST(max(g.lastin_price) AS double) AS lastin, CAST(max(g.sale_price) AS double) AS price
      FROM sku s JOIN goods g ON g.cmid = s.cmid AND g.foreign_item_id = s.foreign_item_id
      LEFT JOIN stores st ON st.cmid = s.cmid AND st.foreign_store_id = s.foreign_store_id
      WHERE s.in_stock_table AND s.foreign_store_id <> '1000000' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8),
    p AS (SELECT *, CASE WHEN n = 0 THEN 0.0 ELSE sale / n END AS psd FROM t)
    SELECT cmid, foreign_store_id, store_name AS foreign_store_name, foreign_item_id, barcode, item_name,
      show_code AS item_show_code, CAST(NULL AS varchar) AS delivery_method, store_status, CAST(n AS bigint) AS days, psd,
      sale AS total_sale, outlay AS total_cost, sale / 28 AS avg_sale, lastin AS lastin_price, price AS sale_price,
      psd * lastin AS psd_cost, DATE '{E_AS_OF}' AS update_date FROM p"""
    )


def _series(distinct_days: bool = True) -> str:
    """CTE `daily`: distinct stock and sale per day of the 28-day window of set E."""
    return f""", daily AS (
    SELECT DISTINCT coalesce(c.cmid, i.cmid) AS cmid, coalesce(c.foreign_store_id, i.foreign_store_id) AS foreign_store_id,
      coalesce(c.foreign_item_id, i.foreign_item_id) AS foreign_item_id, coalesce(c.date, i.date) AS date,
      coalesce(i.quantity, 0) AS quantity, coalesce(c.sale_quantity, 0) AS sale_quantity
    FROM (SELECT * FROM cost WHERE {_window(E_AS_OF, 28)}) c
    FULL JOIN (SELECT * FROM inventory WHERE {_window(E_AS_OF, 28)}) i
      ON c.cmid = i.cmid AND c.foreign_store_id = i.foreign_store_id AND c.foreign_item_id = i.foreign_item_id AND c.date = i.date)
"""


def _ranked(rank: str) -> str:
    order = "date, quantity, sale_quantity" if rank == "row_number" else "date"
    return (
        ctes(EVENTS, "cost", "inventory")
        + _series()
        + f"""SELECT {PAIR}, quantity AS actual_quantity, sale_quantity, date,
      CAST({rank}() OVER (PARTITION BY {PAIR} ORDER BY {order}) AS integer) AS rank_num FROM daily"""
    )


# --- stock-out report ------------------------------------------------------------------

_CENTRAL = "delivery_type = '统配出'"


def _dates() -> str:
    return f""", last AS (SELECT cmid, foreign_store_id, max(delivery_date) AS delivery_date FROM delivery WHERE {_CENTRAL} GROUP BY 1, 2),
    dates AS (SELECT l.*, l.delivery_date - 1 AS require_date,
      CASE WHEN EXISTS (SELECT 1 FROM suggestions s WHERE s.cmid = l.cmid AND s.foreign_store_id = l.foreign_store_id
        AND s.date = l.delivery_date - 1) THEN l.delivery_date - 1 ELSE l.delivery_date - 2 END AS suggest_date FROM last l)
"""


def _empty_items(as_of: str, listed: str = "busgate IN ('A', 'N')") -> str:
    return f""", listed AS (SELECT DISTINCT {PAIR} FROM cm_sku WHERE {listed}),
    stocked AS (SELECT {PAIR} FROM inventory WHERE date = DATE '{as_of}' GROUP BY {PAIR} HAVING sum(quantity) <> 0),
    checked AS (SELECT l.*, s.cmid IS NULL AS is_empty FROM listed l LEFT JOIN stocked s
      ON l.cmid = s.cmid AND l.foreign_store_id = s.foreign_store_id AND l.foreign_item_id = s.foreign_item_id)
"""


def _lookup(table: str, value: str, day: str, agg: str, date: str = "date", where: str = "") -> str:
    return f"""(SELECT f.cmid, f.foreign_store_id, f.foreign_item_id, {agg}({value}) AS v FROM {table} f
      JOIN dates d ON d.cmid = f.cmid AND d.foreign_store_id = f.foreign_store_id AND f.{date} = {day} {where} GROUP BY 1, 2, 3)"""


_SUGGESTED = _lookup("suggestions", "fill_qty", "d.suggest_date", "max")
_ORDERED = _lookup("require_orders", "order_qty", "d.require_date", "max")
_DELIVERED = _lookup("delivery", "delivery_qty", "d.delivery_date", "sum", "delivery_date", f"AND {_CENTRAL}")
_USING = "USING (cmid, foreign_store_id, foreign_item_id)"


def _summary(texts, as_of: str, listed: str = "busgate IN ('A', 'N')", where: str = "") -> str:
    return (
        ctes(texts, "inventory", "cm_sku", "delivery", "suggestions", "require_orders", "stores")
        + _dates()
        + _empty_items(as_of, listed)
        + f""", c AS (SELECT k.cmid, k.foreign_store_id, count(*) FILTER (WHERE is_empty) AS lost_sku, count(*) AS all_sku,
      count(*) FILTER (WHERE is_empty AND coalesce(so.v, 0) = 0) AS un_suggest,
      count(*) FILTER (WHERE is_empty AND coalesce(ro.v, 0) = 0) AS un_order,
      count(*) FILTER (WHERE is_empty AND coalesce(dl.v, 0) = 0) AS un_deliver
      FROM checked k LEFT JOIN {_SUGGESTED} so {_USING} LEFT JOIN {_ORDERED} ro {_USING} LEFT JOIN {_DELIVERED} dl {_USING}
      GROUP BY 1, 2)
    SELECT c.cmid, st.store_name, c.foreign_store_id, CASE WHEN st.property_id = 2 THEN '直营' ELSE '加盟' END AS store_type,
      lost_sku, all_sku, lost_sku / CAST(nullif(all_sku, 0) AS double) AS store_lost_rate, un_suggest, un_order, un_deliver,
      un_suggest / CAST(nullif(lost_sku, 0) AS double) AS un_suggest_rate,
      un_order / CAST(nullif(lost_sku, 0) AS double) AS un_order_rate,
      un_deliver / CAST(nullif(lost_sku, 0) AS double) AS un_deliver_rate, suggest_date, require_date, delivery_date
    FROM c LEFT JOIN dates d ON d.cmid = c.cmid AND d.foreign_store_id = c.foreign_store_id
    LEFT JOIN stores st ON st.cmid = c.cmid AND st.foreign_store_id = c.foreign_store_id {where}"""
    )


def _detail(texts, as_of: str) -> str:
    names = ["cost", "inventory", "cm_sku", "delivery", "suggestions", "require_orders", "aa_sku"]
    return (
        ctes(texts, *names, "refunds", "warehouse", "goods", "stores")
        + _dates()
        + _empty_items(as_of)
        + f""", sold AS (SELECT {PAIR}, count(DISTINCT date) AS d60,
      count(DISTINCT CASE WHEN date > DATE '{as_of}' - 28 THEN date END) AS d28,
      sum(CASE WHEN date > DATE '{as_of}' - 7 THEN total_sale END) AS sale_7,
      sum(CASE WHEN date > DATE '{as_of}' - 7 THEN sale_quantity END) AS quantity_7,
      max(CASE WHEN date = DATE '{as_of}' THEN sale_quantity END) AS today
      FROM cost WHERE date BETWEEN DATE '{as_of}' - 59 AND DATE '{as_of}' GROUP BY {PAIR}),
    held AS (SELECT {PAIR}, max(quantity) AS v FROM inventory WHERE date = DATE '{as_of}' GROUP BY {PAIR}),
    aa AS (SELECT DISTINCT {PAIR}, 1 AS v FROM aa_sku),
    back AS (SELECT {PAIR}, max(method) AS v FROM refunds GROUP BY {PAIR}),
    wh AS (SELECT cmid, foreign_item_id, date, max(stock_qty) AS v FROM warehouse GROUP BY 1, 2, 3)
    SELECT k.cmid, k.foreign_store_id, st.store_name, k.foreign_item_id, g.show_code AS item_show_code, g.item_name,
      CAST(coalesce(held.v, 0) AS double) AS actual_stock, CAST(coalesce(os.v, 0) AS double) AS order_stock,
      coalesce(d60, 0) AS sale_days_60, coalesce(d28, 0) AS sale_days_28,
      CAST(coalesce(so.v, 0) AS double) AS cm_suggest, CAST(coalesce(ro.v, 0) AS double) AS store_book,
      CAST(coalesce(dl.v, 0) AS double) AS inv_delivery, CAST(coalesce(sale_7, 0) AS double) / 7 AS avg_sale_7,
      CAST(coalesce(quantity_7, 0) AS double) / 7 AS avg_quantity_7,
      CASE WHEN aa.v = 1 THEN '是' ELSE '否' END AS is_aa, coalesce(back.v, '') AS cause,
      CAST(coalesce(wh.v, 0) AS double) AS warehouse_stock, CAST(coalesce(today, 0) AS double) AS avg_qty
    FROM checked k
    LEFT JOIN dates d ON d.cmid = k.cmid AND d.foreign_store_id = k.foreign_store_id
    LEFT JOIN stores st ON st.cmid = k.cmid AND st.foreign_store_id = k.foreign_store_id
    LEFT JOIN goods g ON g.cmid = k.cmid AND g.foreign_item_id = k.foreign_item_id
    LEFT JOIN wh ON wh.cmid = k.cmid AND wh.foreign_item_id = k.foreign_item_id AND wh.date = d.require_date
    LEFT JOIN {_SUGGESTED} so ON {_on("so")} LEFT JOIN {_ORDERED} ro ON {_on("ro")}
    LEFT JOIN {_DELIVERED} dl ON {_on("dl")}
    LEFT JOIN {_lookup("inventory", "quantity", "d.require_date - 1", "max")} os ON {_on("os")}
    LEFT JOIN sold ON {_on("sold")} LEFT JOIN held ON {_on("held")} LEFT JOIN aa ON {_on("aa")} LEFT JOIN back ON {_on("back")}
    WHERE k.is_empty"""
    )


def _on(alias: str) -> str:
    return " AND ".join(f"{alias}.{c} = k.{c}" for c in PAIR.split(", "))


# --- reasons and loads -----------------------------------------------------------------

_SHEET = """, sheet AS (SELECT cmid, "门店ID" AS foreign_store_id, "商品名称" AS item_name, "当前库存" AS actual_stock,
    "商品show_code" AS item_show_code, "今日销量" AS avg_qty, CASE WHEN "密度" = '低' THEN '规则' ELSE '算法' END AS strategy_type,
    "原因" AS cause, "上上次建议单" AS cm_suggest, "上上次订货单" AS store_book, "上次送货单" AS inv_delivery,
    CAST(date AS date) AS date FROM detail_sheet)
"""
_OPERANDS = {"上上次建议单": 9, "上上次订货单": 10, "上次送货单": 11}
_NAN_SHEET = (
    ", marked AS (SELECT * REPLACE ("
    + ", ".join(f"""CASE WHEN "{c}" = {v} THEN CAST('NaN' AS double) ELSE "{c}" END AS "{c}\"""" for c, v in _OPERANDS.items())
    + ") FROM detail_sheet), known AS (SELECT * REPLACE ("
    + ", ".join(f"""CASE WHEN isnan("{c}") THEN NULL ELSE "{c}" END AS "{c}\"""" for c in _OPERANDS)
    + ") FROM marked)"
    + _SHEET.replace("FROM detail_sheet", "FROM known")
)
_ENROLLED = "s.foreign_store_id IN (SELECT foreign_store_id FROM stores WHERE property_id = 0)"
_CLOSED = "SELECT foreign_store_id FROM stores WHERE store_status = '闭店'"


def _reason(enrolled: str) -> str:
    return f"""CAST(CASE WHEN cause = '退货' THEN 4
      WHEN {enrolled} THEN
        CASE WHEN cm_suggest = 0 OR cm_suggest IS NULL OR cm_suggest <= inv_delivery THEN 1
          WHEN cm_suggest > store_book AND inv_delivery >= store_book THEN 2
          WHEN store_book >= cm_suggest THEN 3 ELSE 5 END
      WHEN store_book = 0 OR store_book IS NULL OR store_book <= inv_delivery THEN 2 ELSE 3 END AS bigint)"""


_NO_SCORES = (
    "CAST(NULL AS double) AS theory_stock, CAST(NULL AS double) AS actual_lost, "
    "CAST(NULL AS double) AS item_score, CAST(NULL AS double) AS update_score"
)
_SUMMARY_COLUMNS = """h.cmid, "门店ID" AS foreign_store_id, "门店名称" AS store_name, "门店缺货率" AS store_lost_rate,
    "现门店已缺货 SKU 数" AS lost_sku, "门店统配商品全量 SKU 数" AS all_sku, CAST(h.date AS date) AS date,
    CAST(NULL AS double) AS store_score, CAST(NULL AS double) AS update_score"""

_TRIAL_DAYS = f""", due AS (SELECT cmid, foreign_store_id, execute_date,
    CASE WHEN end_date <= DATE '{TODAY}' THEN end_date ELSE DATE '{TODAY}' - 1 END AS target, deal_status, end_date FROM trial_stores),
  expanded AS (SELECT cmid, foreign_store_id, deal_status, execute_date, end_date,
    CAST(unnest(generate_series(execute_date, greatest(execute_date, target - 1), INTERVAL 1 DAY)) AS date) AS date FROM due),
  wanted AS (SELECT DISTINCT cmid, foreign_store_id, date FROM expanded WHERE deal_status > 0 AND execute_date <= end_date),
  candidates AS (SELECT * FROM trial_stores WHERE deal_status > 0 OR execute_date <= end_date)
"""
_PRODUCT_COLUMNS = """s.cmid, s.foreign_store_id, store_show_code, p.foreign_item_id, s.item_show_code, item_name, actual_stock, cm_suggest,
    store_book, inv_delivery, use_date, s.date, avg_qty, lost_reason, strategy_type, p.psd_cost"""
_PSD_JOIN = """LEFT JOIN psd p ON p.cmid = s.cmid AND p.foreign_store_id = s.foreign_store_id
    AND p.item_show_code = s.item_show_code AND p.date = s.date"""

# --- weekly ----------------------------------------------------------------------------

_MONDAY = "CAST(date_trunc('week', date) AS date)"


def _week_reasons(columns: list[str], week: str) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE lost_reason = {n}) AS {c}" for n, c in enumerate(columns, 1))
    return (
        ctes(LINEITEM, "product_rows")
        + f"""SELECT cmid, foreign_store_id, store_show_code, {counts}, {week} AS date,
      CAST(year({week}) AS integer) AS y, CAST(weekofyear({week}) AS integer) AS wk
    FROM product_rows GROUP BY cmid, foreign_store_id, store_show_code, {week}"""
    )


# --- replenishment ---------------------------------------------------------------------

_PREPARED = (
    ctes(EVENTS, "cost", "inventory", "products", "packs", "cycles")
    + _series()
    + f""", coded AS (SELECT cmid, foreign_store_id,
      CASE dly_cycle WHEN '单日配' THEN 1 WHEN '双日配' THEN 2 ELSE 3 END AS code FROM cycles),
    prepared AS (SELECT p.*, d.date, coalesce(d.sale_quantity, 0) AS demand, d.quantity, k.mfu,
      first_value(d.quantity) OVER (PARTITION BY d.cmid, d.foreign_store_id, d.foreign_item_id ORDER BY d.date) AS opening_stock,
      CASE WHEN c.code = 3 OR c.code = CASE WHEN day(d.date) % 2 = 1 THEN 1 ELSE 2 END THEN 1 ELSE 0 END AS can_request_order
      FROM products p
      LEFT JOIN daily d ON d.cmid = p.cmid AND d.foreign_store_id = p.foreign_store_id AND d.foreign_item_id = p.foreign_item_id
      LEFT JOIN packs k ON k.cmid = p.cmid AND k.foreign_item_id = p.foreign_item_id
      LEFT JOIN coded c ON c.cmid = p.cmid AND c.foreign_store_id = p.foreign_store_id)
"""
)
_FUTURE = f""", summed AS (SELECT *, sum(demand) OVER w AS cum, row_number() OVER w AS rn,
      last_value(demand) OVER (PARTITION BY {PAIR} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final
      FROM prepared WHERE date IS NOT NULL WINDOW w AS (PARTITION BY {PAIR} ORDER BY date)),
    ahead AS (SELECT s.*, CAST(coalesce((SELECT min_by(n.cum, n.rn) FROM summed n WHERE n.cmid = s.cmid
      AND n.foreign_store_id = s.foreign_store_id AND n.foreign_item_id = s.foreign_item_id AND n.rn > s.rn
      AND n.can_request_order = 1) - s.cum, s.final) AS bigint) AS future_demand FROM summed s)
"""


def _day_step(stock: str) -> str:
    """Columns of one simulated day that starts with `stock`."""
    wants = f"(a.can_request_order = 1 AND a.future_demand > {stock} - a.demand)"
    remain = f"greatest({stock} - a.demand, 0)"
    fill = f"CASE WHEN {wants} THEN CAST(trunc(a.mfu * ceil((a.future_demand - {remain}) / CAST(a.mfu AS double))) AS bigint) ELSE 0 END"
    return f"""a.cmid, a.foreign_store_id, a.foreign_item_id, a.rn, a.date, a.foreign_store_name, a.foreign_item_name, a.quantity,
      CASE WHEN {wants} THEN 1 ELSE 0 END AS should_fill, CAST({fill} AS bigint) AS fill_qty,
      CAST({stock} AS bigint) AS cur_stock, CAST({remain} + {fill} AS bigint) AS next_stock"""


_FOLD = f"""{_FUTURE}, able AS (SELECT * FROM ahead WHERE mfu <> 0 AND opening_stock IS NOT NULL),
    sim AS (SELECT {_day_step("a.opening_stock")} FROM able a WHERE a.rn = 1
      UNION ALL
      SELECT {_day_step("s.next_stock")} FROM sim s JOIN able a ON a.cmid = s.cmid
        AND a.foreign_store_id = s.foreign_store_id AND a.foreign_item_id = s.foreign_item_id AND a.rn = s.rn + 1)
"""

_COST_COLUMNS = f"{DAY}, CAST(sale_quantity AS double) AS sale_quantity"
_STOCK = f"SELECT {DAY}, CAST(coalesce(quantity, 0) AS double) AS quantity FROM inventory"
_SUPERVISORS = """, people AS (SELECT u.cmid, u.id AS user_id, u.username AS user_name, u.first_name, i.level, i.store_a, i.store_b, i.store_c
    FROM user_identity l JOIN identity i ON i.id = l.enterprise_identity_id JOIN users u ON u.id = l.user_id AND u.cmid = i.cmid
    WHERE l.status = 1 AND i.status = 1 AND NOT i.is_store AND NOT i.is_staff AND NOT u.is_staff
      AND (i.level = 1 OR (i.level = 2 AND identity_lv2_name NOT LIKE '%店长%') OR (i.level = 3 AND identity_lv3_name NOT LIKE '%店长%')
        OR (i.level = 4 AND identity_lv4_name NOT LIKE '%店长%') OR (i.level = 5 AND identity_lv5_name NOT LIKE '%店长%'))),
  pairs AS (SELECT p.*, r.showcode AS store FROM people p JOIN store_resources r ON r.cmid = p.cmid WHERE p.level = 1
    UNION ALL SELECT p.*, unnest([store_a, store_b, store_c]) FROM people p WHERE p.level <> 1),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY cmid, store ORDER BY level DESC, user_id DESC) AS rn FROM pairs)
"""

ORACLES: dict[str, str] = {
    # sources
    "scan_cost": ctes(EVENTS, "cost")
    + f"""SELECT {_COST_COLUMNS}, CAST(coalesce(total_sale, 0) AS double) AS total_sale,
      CAST(total_cost AS double) AS total_cost, CASE WHEN total_sale > 0 THEN 1 ELSE 0 END AS exist FROM cost""",
    "scan_inventory": ctes(EVENTS, "inventory") + _STOCK,
    "scan_rejects": ctes(EVENTS, "cost")
    + f"""SELECT {DAY}, CASE WHEN sale_quantity % 7 > 1 THEN CAST(sale_quantity AS double) END AS sale_quantity,
      CASE sale_quantity % 7 WHEN 0 THEN concat(CAST(sale_quantity AS varchar), 'O')
        WHEN 1 THEN concat(CAST(sale_quantity AS varchar), '.123456') END AS rejected FROM cost""",
    "scan_date_window": ctes(EVENTS, "inventory") + f"{_STOCK} WHERE {_window(E_AS_OF, 28)}",
    "scan_missing_ok": ctes(EVENTS, "inventory") + f"{_STOCK} WHERE date <= DATE '2024-01-20'",
    "scan_store": ctes(EVENTS, "stores") + "SELECT cmid, foreign_store_id, store_name, store_status FROM stores",
    "scan_goods_clean": ctes(LINEITEM, "goods_raw")
    + """SELECT cmid, foreign_item_id, barcode, show_code, item_name, item_status,
      CAST(lastin_price AS double) AS lastin_price, CAST(sale_price AS double) AS sale_price FROM goods_raw
    WHERE foreign_item_id NOT IN (SELECT foreign_item_id FROM goods_raw WHERE sale_price IS NOT NULL AND TRY_CAST(sale_price AS double) IS NULL)
      AND (item_status IS NULL OR item_status NOT IN ('淘汰', '淘汰品'))""",
    "reject_malformed": ctes(LINEITEM, "goods_raw")
    + """SELECT * FROM goods_raw WHERE foreign_item_id NOT IN
      (SELECT foreign_item_id FROM goods_raw WHERE sale_price IS NOT NULL AND TRY_CAST(sale_price AS double) IS NULL)""",
    "scan_path_columns": ctes(EVENTS, "cost") + f"SELECT {DAY}, sale_quantity FROM cost",
    "scan_by_date_suffix": ctes(EVENTS, "cost") + f"SELECT {DAY}, sale_quantity FROM cost WHERE date = DATE '2024-01-15'",
    "scan_date_range_folder": ctes(EVENTS, "cost")
    + f"SELECT {DAY}, sale_quantity FROM cost WHERE date >= DATE '2024-01-21'",
    "scan_glob": ctes(EVENTS, "cost") + "SELECT DISTINCT cmid, date FROM cost",
    "scan_latest_file": ctes(EVENTS, "cost")
    + "SELECT cmid, date, CAST(2 AS integer) AS delivery, count(*) AS n_rows FROM cost GROUP BY cmid, date",
    "scan_project_tenant": ctes(SHARED, "store_resources") + "SELECT cmid, showcode FROM store_resources WHERE cmid = 7",
    "scan_vendor_unified": ctes(SHARED, "tenant_config", "ways_a", "ways_b")
    + """SELECT w.*, 'A' AS vendor FROM ways_a w JOIN tenant_config t ON t.cmid = w.cmid AND t.vendor = 'A'
      UNION ALL SELECT w.*, 'B' FROM ways_b w JOIN tenant_config t ON t.cmid = w.cmid AND t.vendor = 'B'""",
    "scan_vendor_default": ctes(SHARED, "tenant_config", "ways_a", "ways_b")
    + """, config AS (SELECT * FROM tenant_config WHERE cmid % 3 <> 0),
      every AS (SELECT *, 'A' AS vendor FROM ways_a UNION ALL SELECT *, 'B' FROM ways_b)
      SELECT w.* FROM every w LEFT JOIN config t ON t.cmid = w.cmid WHERE w.vendor = coalesce(t.vendor, 'A')""",
    "dim_store_property": ctes(LINEITEM, "stores")
    + "SELECT cmid, store_name AS property, CAST(property_id AS varchar) AS cm_store_property_id FROM stores",
    "source_id": ctes(SHARED, "enterprises")
    + """SELECT cmid, substring(concat(CAST(cmid AS varchar), 'YYYYYYYYYYYYY'), 1, 15) AS source_id,
      CAST(cmid AS varchar) AS tenant FROM enterprises""",
    "concat_by_name": ctes(EVENTS, "cost", "inventory")
    + f"""SELECT {DAY}, sale_quantity, CAST(NULL AS bigint) AS quantity FROM cost
      UNION ALL SELECT {DAY}, NULL, quantity FROM inventory""",
    # sinks
    "sink_roundtrip_csv": ctes(EVENTS, "cost") + f"SELECT {DAY}, sale_quantity FROM cost",
    "sink_replace": ctes(EVENTS, "cost") + f"SELECT {_COST_COLUMNS} FROM cost",
    "sink_append": ctes(EVENTS, "cost") + f"SELECT {DAY}, sale_quantity FROM cost",
    "publish_swap": ctes(EVENTS, "inventory") + f"SELECT {DAY}, quantity FROM inventory",
    "mirror_table": ctes(EVENTS, "cost", "inventory")
    + f"SELECT {DAY}, CAST(NULL AS bigint) AS quantity FROM cost UNION ALL SELECT {DAY}, quantity FROM inventory",
    "upsert_daily_retention": ctes(EVENTS, "cost", "inventory")
    + f""", fresh AS (SELECT {DAY}, quantity FROM inventory WHERE date = DATE '2024-01-28')
      SELECT {DAY}, sale_quantity FROM cost WHERE date > DATE '2024-01-28' - 14
        AND NOT (date = DATE '2024-01-28' AND cmid IN (SELECT cmid FROM fresh))
      UNION ALL SELECT * FROM fresh""",
    "upsert_daily_emptied": ctes(EVENTS, "cost", "inventory")
    + f""", fresh AS (SELECT {DAY}, quantity FROM inventory WHERE date = DATE '2024-01-28')
      SELECT {DAY}, sale_quantity FROM cost WHERE date > DATE '2024-01-28' - 14
        AND NOT (date = DATE '2024-01-28' AND cmid IN (SELECT cmid FROM fresh))
      UNION ALL SELECT * FROM fresh WHERE cmid = 43""",
    "upsert_partition": ctes(EVENTS, "cost", "inventory")
    + f""", fresh AS (SELECT {DAY}, quantity FROM inventory WHERE date >= DATE '2024-01-21')
      SELECT {DAY}, sale_quantity FROM cost WHERE (cmid, date) NOT IN (SELECT cmid, date FROM fresh) UNION ALL SELECT * FROM fresh""",
    "upsert_days_emptied": ctes(EVENTS, "cost", "inventory")
    + f"""SELECT {DAY}, sale_quantity FROM cost WHERE date NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
      UNION ALL SELECT {DAY}, quantity FROM inventory WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
        AND (cmid = 43 OR day(date) % 2 = 0)""",
    # maintained tables
    "scan_new_objects": ctes(EVENTS, "cost") + "SELECT foreign_store_id, foreign_item_id, sale_quantity, cmid, date FROM cost",
    "load_quarantine": ctes(EVENTS, "cost")
    + f"""SELECT {DAY}, CAST(sale_quantity AS double) AS sale_quantity, CAST(NULL AS varchar) AS rejected, CAST(NULL AS varchar) AS reasons
      FROM cost WHERE sale_quantity % 7 > 1
      UNION ALL SELECT {DAY}, NULL, concat(CAST(sale_quantity AS varchar), CASE WHEN sale_quantity % 7 = 0 THEN 'O' ELSE '.123456' END),
        CASE WHEN sale_quantity % 7 = 0 THEN 'type:sale_quantity' ELSE 'rounded:sale_quantity' END FROM cost WHERE sale_quantity % 7 <= 1""",
    "delivery_state_days": ctes(LINEITEM, "delivery")
    + f"SELECT cmid, foreign_store_id, max(delivery_date) AS delivery_date FROM delivery WHERE {_CENTRAL} GROUP BY 1, 2",
    "delivery_state_items": ctes(LINEITEM, "delivery")
    + f"""SELECT {PAIR}, delivery_date, CAST(sum(delivery_qty) AS bigint) AS delivery_qty FROM delivery f WHERE {_CENTRAL}
      AND delivery_date = (SELECT max(delivery_date) FROM delivery m WHERE m.cmid = f.cmid AND m.foreign_store_id = f.foreign_store_id AND m.{_CENTRAL})
      GROUP BY {PAIR}, delivery_date""",
    "presence_state_psd": _psd(EVENTS, E_AS_OF, 28),
    "presence_state_sales": ctes(EVENTS, "cost")
    + f"""SELECT {PAIR}, count(DISTINCT date) AS sale_days_60, count(DISTINCT CASE WHEN {_window(E_AS_OF, 28)} THEN date END) AS sale_days_28,
        CAST(max(CASE WHEN date = DATE '{E_AS_OF}' THEN sale_quantity END) AS double) AS sold_today,
        CAST(coalesce(sum(CASE WHEN {_window(E_AS_OF, 7)} THEN total_sale END), 0) AS double) AS sale_7,
        CAST(coalesce(sum(CASE WHEN {_window(E_AS_OF, 7)} THEN sale_quantity END), 0) AS double) AS quantity_7,
        DATE '{E_AS_OF}' AS date FROM cost WHERE {_window(E_AS_OF, 60)} GROUP BY {PAIR}""",
    "asof_unmatched": ctes(EVENTS, "inventory")
    + """, s AS (SELECT cmid, CASE WHEN cmid = 85 THEN date - 1 ELSE date END AS date FROM inventory
        UNION ALL SELECT 99, date - 3 FROM inventory WHERE cmid = 43),
      a AS (SELECT DISTINCT cmid FROM s UNION SELECT 7),
      d AS (SELECT a.cmid, max(s.date) AS date FROM a LEFT JOIN s ON s.cmid = a.cmid AND s.date BETWEEN DATE '2024-01-30' AND DATE '2024-01-31' GROUP BY 1)
      SELECT d.cmid, d.date, c.n_rows FROM d LEFT JOIN (SELECT cmid, date, count(*) AS n_rows FROM s GROUP BY 1, 2) c ON c.cmid = d.cmid AND c.date = d.date""",
    # presence, velocity, product information
    "full_sku": ctes(EVENTS, "cost", "inventory")
    + _joined("2024-01-31", 40)
    + f"""SELECT {DAY}, CAST(quantity AS double) AS quantity, CAST(total_sale AS double) AS total_sale,
      CAST(total_cost AS double) AS total_cost, listed AS exist FROM sku""",
    "psd": _psd(EVENTS, E_AS_OF, 28),
    "psd_all_days": _psd(LINEITEM, L_AS_OF, L_DAYS),
    "psd_dup_goods": _psd(EVENTS, E_AS_OF, 28, goods=f"{_ACTIVE} UNION ALL {_ACTIVE}"),
    "psd_repeated_days": _psd(_twice(EVENTS), E_AS_OF, 28),
    "psd_days": " UNION ALL ".join(f"SELECT * FROM ({_psd(EVENTS, f'2024-01-{day:02d}', 28)}) d{day}" for day in range(3, 31)),
    "psd_sql": _psd(
        EVENTS,
        E_AS_OF,
        28,
        flag="stock_or_sale",
        goods="SELECT * FROM goods",
        where="AND s.foreign_store_id IN (SELECT foreign_store_id FROM stores WHERE store_status = '营业')",
        codes="g.show_code IN ('SC-purchase', 'SC-view', 'SC-signup')",
    ),
    "psd_inventory_driven": _inventory_driven(),
    "product_info": _product_info(EVENTS, E_AS_OF, 28, "listed", False),
    "product_info_sql": _product_info(EVENTS, E_AS_OF, 28, "stock_or_sale", True),
    "product_info_all_days": _product_info(LINEITEM, L_AS_OF, L_DAYS, "stock_or_sale", True),
    "actual_sale_rank": _ranked("row_number"),
    "actual_sale_dense": _ranked("dense_rank"),
    "latest_quantity": ctes(LINEITEM, "inventory")
    + f"""SELECT {PAIR}, quantity FROM (SELECT *, row_number() OVER (PARTITION BY {PAIR} ORDER BY date DESC) AS rn FROM inventory
      WHERE {_window(L_AS_OF, L_DAYS)}) WHERE rn = 1""",
    "suggest_window": ctes(EVENTS, "suggestions")
    + f"""SELECT {PAIR}, fill_qty AS suggest_qty, date FROM suggestions WHERE {_window(E_AS_OF, 28)}""",
    "backfill_actual_stock": ctes(EVENTS, "cost", "inventory", "products")
    + _series()
    + f"""SELECT p.cmid, p.foreign_store_id, p.foreign_store_name, p.foreign_item_id, p.foreign_item_name,
      CAST(coalesce(d.quantity, 0) AS integer) AS prediction_stock, CAST(length(p.foreign_item_id) AS integer) AS theory_stock, c.date
    FROM products p JOIN cost c USING ({PAIR}) LEFT JOIN daily d ON d.cmid = p.cmid AND d.foreign_store_id = p.foreign_store_id
      AND d.foreign_item_id = p.foreign_item_id AND d.date = c.date""",
    # stock-out report
    "stockout_items": ctes(LINEITEM, "cm_sku", "inventory")
    + _empty_items(L_AS_OF)
    + f"SELECT {PAIR} FROM checked WHERE is_empty",
    "latest_delivery": ctes(LINEITEM, "delivery")
    + f"""SELECT {PAIR}, delivery_date, CAST(sum(delivery_qty) AS bigint) AS delivery_qty FROM delivery f WHERE {_CENTRAL}
      AND delivery_date = (SELECT max(delivery_date) FROM delivery m WHERE m.cmid = f.cmid AND m.foreign_store_id = f.foreign_store_id AND m.{_CENTRAL})
      GROUP BY {PAIR}, delivery_date""",
    "asof_suggestion": ctes(LINEITEM, "delivery", "suggestions")
    + _dates()
    + f"""SELECT s.cmid, s.foreign_store_id, s.foreign_item_id, s.date, s.fill_qty FROM suggestions s
      JOIN dates d ON d.cmid = s.cmid AND d.foreign_store_id = s.foreign_store_id AND d.suggest_date = s.date""",
    "asof_store_snapshot": ctes(EVENTS, "inventory")
    + f"""SELECT {PAIR}, CASE WHEN cmid = 85 THEN date - 1 ELSE date END AS date FROM inventory WHERE date = DATE '2024-01-31'""",
    "cost_60d": ctes(LINEITEM, "cost")
    + f"""SELECT {DAY}, sale_quantity FROM cost WHERE date BETWEEN DATE '{L_AS_OF}' - 29 AND DATE '{L_AS_OF}'
      UNION ALL SELECT {DAY}, sale_quantity FROM cost WHERE date >= DATE '{L_AS_OF}' - 59 AND date < DATE '{L_AS_OF}' - 29""",
    "stockout_summary": _summary(LINEITEM, L_AS_OF),
    "stockout_detail": _detail(LINEITEM, L_AS_OF),
    "stockout_summary_settings": _summary(
        EVENTS,
        E_AS_OF,
        listed="(cmid = 43 AND busgate = 'A') OR (cmid = 85 AND busgate IN ('N', 'R'))",
        where="WHERE c.foreign_store_id IN (SELECT foreign_store_id FROM stores WHERE store_status = '营业')",
    ),
    "stockout_summary_dense": _summary(EVENTS, E_AS_OF),
    "stockout_detail_dense": _detail(EVENTS, E_AS_OF),
    # reasons and loads
    "lost_reason": ctes(LINEITEM, "detail_sheet", "stores")
    + _NAN_SHEET
    + f"""SELECT cmid, foreign_store_id, item_show_code, date, cm_suggest, store_book, inv_delivery,
      {_reason(_ENROLLED)} AS lost_reason FROM sheet s""",
    "lost_reason_by_date": ctes(LINEITEM, "detail_sheet", "trial_stores")
    + _NAN_SHEET
    + f"""SELECT s.cmid, s.foreign_store_id, item_show_code, s.date, t.date AS use_date, cm_suggest, store_book, inv_delivery,
      {_reason("s.date >= t.date")} AS lost_reason FROM sheet s
      LEFT JOIN trial_stores t ON t.cmid = s.cmid AND t.foreign_store_id = s.foreign_store_id""",
    "code_maps": ctes(EVENTS, "stores", "cycles")
    + """SELECT s.cmid, s.foreign_store_id, CASE dly_cycle WHEN '单日配' THEN 1 WHEN '双日配' THEN 2 ELSE 3 END AS period_type_num,
      CASE WHEN property_id = 2 THEN '直营' ELSE '加盟' END AS store_type,
      CASE WHEN store_status = '营业' THEN '规则' ELSE '算法' END AS strategy_type
    FROM stores s LEFT JOIN cycles c ON c.cmid = s.cmid AND c.foreign_store_id = s.foreign_store_id""",
    "load_summary": ctes(LINEITEM, "summary_sheet") + f"SELECT {_SUMMARY_COLUMNS} FROM summary_sheet h",
    "load_detail": ctes(LINEITEM, "detail_sheet", "stores")
    + _SHEET
    + f"""SELECT s.*, {_reason(_ENROLLED)} AS lost_reason, {_NO_SCORES}, t.show_code AS store_show_code,
      t.store_status = '闭店' AS is_closed, CASE WHEN t.property_id = 0 THEN true END AS enrolled
      FROM sheet s LEFT JOIN stores t ON t.cmid = s.cmid AND t.foreign_store_id = s.foreign_store_id""",
    "open_stores_only": ctes(LINEITEM, "store_info", "stores")
    + f"SELECT * FROM store_info WHERE foreign_store_id NOT IN ({_CLOSED})",
    "join_psd": ctes(LINEITEM, "product_rows", "psd")
    + f"""SELECT s.cmid, s.foreign_store_id, s.item_show_code, s.date, p.foreign_item_id, s.store_show_code, s.lost_reason, p.psd_cost
      FROM product_rows s {_PSD_JOIN}""",
    "store_info_load": ctes(LINEITEM, "summary_sheet", "stores")
    + f"""SELECT {_SUMMARY_COLUMNS}, s.show_code AS store_show_code FROM summary_sheet h
      JOIN stores s ON s.cmid = h.cmid AND s.foreign_store_id = h."门店ID" WHERE s.store_status <> '闭店'""",
    "product_exception_load": ctes(LINEITEM, "detail_sheet", "stores", "psd", "suggestion_files")
    + _SHEET
    + f""", loaded AS (SELECT s.*, {_reason(_ENROLLED)} AS lost_reason, t.show_code AS store_show_code,
      f.use_date FROM sheet s
      LEFT JOIN (SELECT cmid, CAST(min(modification_time) AS date) AS use_date FROM suggestion_files GROUP BY cmid) f ON f.cmid = s.cmid
      LEFT JOIN stores t ON t.cmid = s.cmid AND t.foreign_store_id = s.foreign_store_id WHERE s.foreign_store_id NOT IN ({_CLOSED}))
    SELECT {_PRODUCT_COLUMNS}, {_NO_SCORES} FROM loaded s {_PSD_JOIN}""",
    "trial_date_series": ctes(LINEITEM, "trial_stores")
    + _TRIAL_DAYS
    + "SELECT cmid, foreign_store_id, date FROM expanded",
    "trial_expand": ctes(LINEITEM, "trial_stores") + _TRIAL_DAYS + "SELECT * FROM wanted",
    "trial_load": ctes(LINEITEM, "detail_sheet", "trial_stores", "psd")
    + _TRIAL_DAYS
    + _SHEET
    + f""", loaded AS (SELECT s.*, t.date AS use_date, t.show_code AS store_show_code, {_reason("s.date >= t.date")} AS lost_reason
      FROM sheet s JOIN wanted w ON w.cmid = s.cmid AND w.foreign_store_id = s.foreign_store_id AND w.date = s.date
      JOIN candidates t ON t.cmid = s.cmid AND t.foreign_store_id = s.foreign_store_id)
    SELECT {_PRODUCT_COLUMNS}, {_NO_SCORES} FROM loaded s {_PSD_JOIN}""",
    "trial_load_summary": ctes(LINEITEM, "summary_sheet", "trial_stores")
    + _TRIAL_DAYS
    + f"""SELECT {_SUMMARY_COLUMNS}, t.show_code AS store_show_code FROM summary_sheet h
      JOIN wanted w ON w.cmid = h.cmid AND w.foreign_store_id = h."门店ID" AND w.date = CAST(h.date AS date)
      JOIN candidates t ON t.cmid = h.cmid AND t.foreign_store_id = h."门店ID\"""",
    "trial_state": ctes(LINEITEM, "trial_stores")
    + f"""SELECT cmid, foreign_store_id, foreign_store_name, show_code, date, start_date, end_date,
      CASE WHEN deal_status > 0 OR execute_date <= end_date THEN DATE '{TODAY}' ELSE execute_date END AS execute_date,
      CASE WHEN deal_status > 0 AND execute_date <= end_date THEN CASE WHEN end_date < DATE '{TODAY}' THEN 0 ELSE 1 END
        ELSE deal_status END AS deal_status FROM trial_stores""",
    # weekly
    "week_reasons": _week_reasons(["cm_suggest", "store_book", "inv_delivery", "other_reason"], _MONDAY),
    "week_reasons_5": _week_reasons(
        ["cm_suggest", "store_book", "inv_delivery", "return_goods", "other_reason"], f"({_MONDAY} + 6)"
    ),
    "week_store_info": ctes(LINEITEM, "store_info", "product_rows")
    + f""", a AS (SELECT cmid, foreign_store_id, store_name, {_MONDAY} + 6 AS w, max(all_sku) AS all_sku FROM store_info GROUP BY 1, 2, 3, 4),
    b AS (SELECT cmid, foreign_store_id, store_show_code, {_MONDAY} + 6 AS w, count(DISTINCT foreign_item_id) AS lost_sku
      FROM product_rows GROUP BY 1, 2, 3, 4)
    SELECT a.cmid, a.foreign_store_id, b.store_show_code, a.store_name, b.lost_sku, a.all_sku,
      CAST(b.lost_sku AS double) / a.all_sku AS store_lost_rate, a.w AS date, CAST(year(a.w) AS integer) AS y,
      CAST(weekofyear(a.w) AS integer) AS wk
    FROM a LEFT JOIN b ON a.cmid = b.cmid AND a.foreign_store_id = b.foreign_store_id AND a.w = b.w""",
    "week_store_info_df": ctes(LINEITEM, "store_info", "product_rows", "stores")
    + f""", lost AS (SELECT DISTINCT cmid, foreign_store_id, item_show_code, {_MONDAY} AS w FROM product_rows),
    n AS (SELECT cmid, foreign_store_id, w, 1 AS v FROM lost
      UNION ALL SELECT cmid, foreign_store_id, {_MONDAY}, 0 FROM store_info WHERE lost_sku = 0),
    b AS (SELECT cmid, foreign_store_id, w, CAST(sum(v) AS bigint) AS lost_sku FROM n
      WHERE w BETWEEN DATE '2001-06-25' - 77 AND DATE '2001-06-28' GROUP BY 1, 2, 3),
    a AS (SELECT cmid, foreign_store_id, {_MONDAY} AS w, max(all_sku) AS all_sku FROM store_info GROUP BY 1, 2, 3)
    SELECT b.cmid, b.foreign_store_id, b.w + 6 AS date, b.lost_sku, a.all_sku, CAST(b.lost_sku AS double) / nullif(a.all_sku, 0) AS store_lost_rate,
      CAST(year(b.w + 6) AS varchar) AS y, lpad(CAST(weekofyear(b.w + 6) AS varchar), 2, '0') AS wk, s.show_code AS store_show_code, s.store_name
    FROM b LEFT JOIN a ON a.cmid = b.cmid AND a.foreign_store_id = b.foreign_store_id AND a.w = b.w
    LEFT JOIN stores s ON s.cmid = b.cmid AND s.foreign_store_id = b.foreign_store_id""",
    # dimensions
    "sku_cache": ctes(EVENTS, "cost", "inventory", "goods", "stores")
    + f""", m AS (SELECT {PAIR} FROM cost WHERE date BETWEEN DATE '{E_AS_OF}' - 29 AND DATE '{E_AS_OF}' - 1
      UNION SELECT {PAIR} FROM inventory WHERE date BETWEEN DATE '{E_AS_OF}' - 29 AND DATE '{E_AS_OF}' - 1 AND quantity > 0 AND amount > 0)
    SELECT m.cmid, m.foreign_store_id, m.foreign_item_id, g.item_name AS foreign_item_name, s.store_name AS foreign_store_name
    FROM m JOIN goods g ON g.cmid = m.cmid AND g.foreign_item_id = m.foreign_item_id AND g.foreign_category_lv1 NOT IN ('p')
    LEFT JOIN stores s ON s.cmid = m.cmid AND s.foreign_store_id = m.foreign_store_id""",
    "sku_cache_settings": ctes(EVENTS, "cost", "inventory", "goods", "stores")
    + f""", m AS (SELECT {PAIR} FROM cost WHERE date BETWEEN DATE '{E_AS_OF}' - 28 - own AND DATE '{E_AS_OF}' - own
      UNION SELECT {PAIR} FROM inventory WHERE date BETWEEN DATE '{E_AS_OF}' - 28 - own AND DATE '{E_AS_OF}' - own AND quantity > 0 AND amount > 0)
    SELECT m.cmid, m.foreign_store_id, m.foreign_item_id, g.item_name AS foreign_item_name, s.store_name AS foreign_store_name
    FROM m JOIN goods g ON g.cmid = m.cmid AND g.foreign_item_id = m.foreign_item_id
      AND g.foreign_category_lv1 <> CASE WHEN m.cmid = 43 THEN 'p' ELSE 'c' END
    LEFT JOIN stores s ON s.cmid = m.cmid AND s.foreign_store_id = m.foreign_store_id""".replace("own", "CASE WHEN cmid = 43 THEN 1 ELSE 3 END"),
    "packsize_vendor": ctes(SHARED, "packs_a", "packs_b")
    + """SELECT DISTINCT cmid, CAST(gid AS varchar) AS foreign_item_id, qpc AS mfu FROM packs_a WHERE isdu = 2 AND cmid <> 85
      UNION SELECT DISTINCT cmid, foreign_item_id, qpc FROM packs_b WHERE cmid = 85""",
    "packsize_distinct": ctes(SHARED, "packs_a")
    + "SELECT DISTINCT cmid, CAST(gid AS varchar) AS foreign_item_id, qpc AS mfu FROM packs_a WHERE isdu = 2",
    "packsize_counts": ctes(SHARED, "packs_a")
    + """, d AS (SELECT DISTINCT cmid, gid, qpc FROM packs_a),
    b AS (SELECT cmid, count(gid) AS g, count(qpc) AS q FROM packs_a GROUP BY cmid),
    a AS (SELECT cmid, count(gid) AS g, count(qpc) AS q FROM d GROUP BY cmid)
    SELECT cmid, 'foreign_item_id' AS column_name, b.g AS rows_before, a.g AS rows_after FROM b JOIN a USING (cmid)
    UNION ALL SELECT cmid, 'mfu', b.q, a.q FROM b JOIN a USING (cmid)""",
    "tenants": ctes(SHARED, "enterprises") + "SELECT DISTINCT cmid FROM enterprises WHERE cmid NOT IN (1)",
    "tenant_stores": ctes(SHARED, "store_resources") + "SELECT showcode FROM store_resources WHERE cmid = 7",
    "supervisor_map": ctes(SHARED, "users", "user_identity", "identity", "store_resources")
    + _SUPERVISORS
    + """SELECT cmid, first_name, store AS foreign_store_id, CAST(user_id AS varchar) AS user_id, user_name FROM ranked WHERE rn = 1""",
    "dq_non_empty": ctes(EVENTS, "cost")
    + """SELECT 'cost' AS table_name, count(*) AS row_count, count(*) > 0 AS is_ok FROM cost
      UNION ALL SELECT 'late cost', count(*), count(*) > 0 FROM cost WHERE date > DATE '2025-01-01'""",
    # JSON
    "json_metric_urls": """SELECT event_id, concat('s3://metric/', CAST(event_id AS varchar)) AS url FROM events WHERE event_type <> 'error'
      UNION ALL SELECT event_id, concat('s3://second/', CAST(event_id AS varchar)) FROM events""",
    "json_fit_urls": """SELECT event_id, concat('s3://fit/', CAST(event_id AS varchar), s.suffix) AS url
      FROM events CROSS JOIN (VALUES (''), ('b'), ('c')) AS s(suffix)""",
    "json_plot_urls": "SELECT event_id, concat('s3://plot/', CAST(event_id AS varchar)) AS url FROM events",
    # dates and replenishment
    "date_series_back": ctes(LINEITEM, "delivery")
    + f"""SELECT cmid, foreign_store_id, CAST(unnest(generate_series(d - 27, d, INTERVAL 1 DAY)) AS date) AS date FROM
      (SELECT cmid, foreign_store_id, max(delivery_date) AS d FROM delivery WHERE {_CENTRAL} GROUP BY 1, 2)""",
    "date_series_forward": ctes(LINEITEM, "delivery")
    + f"""SELECT cmid, foreign_store_id,
      CAST(unnest(generate_series(d, greatest(d, DATE '{L_AS_OF}' - 1), INTERVAL 1 DAY)) AS date) AS date FROM
      (SELECT cmid, foreign_store_id, max(delivery_date) AS d FROM delivery WHERE {_CENTRAL} GROUP BY 1, 2)""",
    "can_order": ctes(EVENTS, "cost", "cycles")
    + f"""SELECT c.cmid, c.foreign_store_id, c.foreign_item_id, c.date,
      CASE WHEN k.dly_cycle IS NULL THEN 0 WHEN k.dly_cycle NOT IN ('单日配', '双日配') THEN 1
        WHEN (k.dly_cycle = '单日配') = (day(c.date) % 2 = 1) THEN 1 ELSE 0 END AS can_request_order
    FROM cost c LEFT JOIN cycles k ON k.cmid = c.cmid AND k.foreign_store_id = c.foreign_store_id""",
    "future_demand": _PREPARED + _FUTURE + f"SELECT {DAY}, demand, can_request_order, future_demand FROM ahead",
    "replenish": _PREPARED + _FOLD + f"SELECT {DAY}, should_fill, fill_qty, cur_stock FROM sim",
    "replenish_history": _PREPARED
    + _FOLD
    + """SELECT cmid, foreign_store_id, foreign_store_name, foreign_item_id, foreign_item_name, CAST(fill_qty AS double) AS fill_qty,
      CAST(quantity AS integer) AS prediction_stock, CAST(cur_stock AS integer) AS theory_stock, date FROM sim""",
    "replenish_repeated_stock": _PREPARED.replace(EVENTS["cost"].format(events="events"), _twice(EVENTS)["cost"].format(events="events")).replace(
        EVENTS["inventory"].format(events="events"), _twice(EVENTS)["inventory"].format(events="events")
    )
    + _FOLD
    + """SELECT cmid, foreign_store_id, foreign_store_name, foreign_item_id, foreign_item_name, CAST(fill_qty AS double) AS fill_qty,
      CAST(quantity AS integer) AS prediction_stock, CAST(cur_stock AS integer) AS theory_stock, date FROM sim""",
    "replenish_rejects": _PREPARED
    + f"""SELECT {DAY}, mfu, CASE WHEN date IS NULL THEN NULL ELSE opening_stock END AS opening_stock FROM prepared
      WHERE date IS NULL OR opening_stock IS NULL OR mfu IS NULL OR mfu = 0""",
}
ORACLES |= {
    "week_bitmaps": ORACLES["week_store_info"],
    "week_bitmaps_df": ORACLES["week_store_info_df"],
    "replenish_bucketed": ORACLES["replenish_history"],
}
