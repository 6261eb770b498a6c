"""Retail tables derived from the benchmark tables, as SQL that Spark and DuckDB both run.

Two sets share one vocabulary. Set E reads `events`: stores are users, items are event
types, thirty dense days of January 2024. Set L reads `lineitem`: stores are suppliers,
items are parts, seven sparse years. Every row of the base table takes part: where an
operator must meet rows without a partner, keys that fit nothing are given to some. Sales carry
the day of the row and stock a later day for some or all rows, so the full join meets
sale-only, stock-only and matched days. Stores with an even key belong to tenant 43, the
others to tenant 85.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("customer", "events", "lineitem", "nation", "orders", "part", "supplier")

E_AS_OF = "2024-01-30"
L_AS_OF = "2001-11-04"
L_DAYS = 2600  # covers every day of set L
STATUSES = ["A", "N"]
TODAY = "2001-06-30"


def _tenant(key: str) -> str:
    return f"CASE WHEN {key} % 2 = 0 THEN 43 ELSE 85 END AS cmid"


_E_KEYS = f"{_tenant('user_id')}, CAST(user_id AS varchar(20)) AS foreign_store_id, event_type AS foreign_item_id"
_L_KEYS = (
    f"{_tenant('l_suppkey')}, CAST(l_suppkey AS varchar(20)) AS foreign_store_id, CAST(l_partkey AS varchar(20)) AS foreign_item_id"
)
_L_QTY = "CAST(l_quantity AS bigint)"
_L_DAY = "CAST(l_shipdate AS date)"

_RAW_IDS = (
    "CAST(p_partkey AS varchar(20)) AS foreign_item_id, concat('69', CAST(p_partkey AS varchar(20))) AS barcode, "
    "concat('P', CAST(p_partkey AS varchar(20))) AS show_code"
)
_RAW_PRICE = "CAST(CAST(p_retailprice AS decimal(18,4)) AS varchar(30))"

EVENTS = {
    "cost": f"""SELECT {_E_KEYS}, CAST(ts AS date) AS date, CAST(count(*) AS bigint) AS sale_quantity,
        CASE WHEN max(event_id % 13) = 0 THEN NULL ELSE CAST(sum(CAST(value AS decimal(12,2))) AS decimal(18,2)) END AS total_sale,
        CAST(sum(CAST(value AS decimal(12,2))) * 0.8 AS decimal(18,4)) AS total_cost
        FROM {{events}} GROUP BY 1, 2, 3, 4""",
    "inventory": f"""SELECT {_E_KEYS}, CAST(ts AS date) + 1 AS date,
        CASE WHEN max(event_id % 11) = 0 THEN NULL ELSE CAST(sum(event_id % 17 - 4) AS bigint) END AS quantity,
        CAST(sum(CAST(value AS decimal(12,2))) AS decimal(18,2)) AS amount
        FROM {{events}} GROUP BY 1, 2, 3, 4""",
    "goods": f"""SELECT cmid, CASE WHEN event_type = 'error' THEN 'no event' ELSE event_type END AS foreign_item_id,
        upper(event_type) AS item_name, concat('69', event_type) AS barcode,
        CASE WHEN event_type = 'click' THEN NULL ELSE concat('SC-', event_type) END AS show_code,
        CASE WHEN event_type = 'signup' THEN '淘汰' WHEN event_type = 'view' THEN NULL ELSE '正常' END AS item_status,
        CASE WHEN event_type = 'view' THEN NULL ELSE substring(event_type, 1, 1) END AS foreign_category_lv1,
        CAST(length(event_type) + 0.25 AS decimal(18,4)) AS lastin_price,
        CAST(length(event_type) + 1.5 AS decimal(18,4)) AS sale_price
        FROM (SELECT DISTINCT {_tenant('user_id')}, event_type FROM {{events}}) d""",
    "stores": f"""SELECT {_tenant('c_custkey')}, CAST(c_custkey AS varchar(20)) AS foreign_store_id, c_name AS store_name,
        concat('S', CAST(c_custkey AS varchar(20))) AS show_code, c_nationkey % 3 AS property_id,
        CASE WHEN c_acctbal < 0 THEN '闭店' ELSE '营业' END AS store_status FROM {{customer}}""",
    "ways": f"""SELECT cmid, foreign_store_id, CASE WHEN n > 10 THEN foreign_item_id ELSE 'no item' END AS foreign_item_id,
        CASE WHEN low < 1 THEN NULL ELSE '统配' END AS alc_way
        FROM (SELECT {_E_KEYS}, min(value) AS low, count(*) AS n FROM {{events}} GROUP BY 1, 2, 3) w""",
    "delivery": f"""SELECT {_E_KEYS}, CAST(ts AS date) AS delivery_date, event_id % 20 AS delivery_qty,
        CASE WHEN value < 100 THEN '统配出' ELSE '直配出' END AS delivery_type FROM {{events}}""",
    "suggestions": f"""SELECT {_E_KEYS}, CAST(ts AS date) - CAST(1 + user_id % 2 AS int) AS date, event_id % 4 AS fill_qty
        FROM {{events}}""",
    "require_orders": f"SELECT {_E_KEYS}, CAST(ts AS date) - 1 AS date, event_id % 3 AS order_qty FROM {{events}}",
    "cm_sku": f"""SELECT {_E_KEYS}, CASE WHEN event_type = 'signup' THEN 'R' WHEN value < 20 THEN 'A' ELSE 'N' END AS busgate
        FROM {{events}}""",
    "aa_sku": f"""SELECT {_tenant('user_id')}, CAST(user_id AS varchar(20)) AS foreign_store_id,
        CASE WHEN value > 150 THEN event_type ELSE 'no item' END AS foreign_item_id FROM {{events}}""",
    "refunds": f"""SELECT {_tenant('user_id')}, CAST(user_id AS varchar(20)) AS foreign_store_id,
        CASE WHEN value > 120 THEN event_type ELSE 'no item' END AS foreign_item_id,
        CASE WHEN value > 200 THEN '退货' ELSE '调拨' END AS method FROM {{events}}""",
    "warehouse": f"""SELECT {_tenant('user_id')}, event_type AS foreign_item_id, CAST(ts AS date) AS date,
        event_id % 90 AS stock_qty FROM {{events}}""",
    "products": f"""SELECT {_tenant('user_id')}, CAST(user_id AS varchar(20)) AS foreign_store_id, event_type AS foreign_item_id,
        concat('store ', CAST(user_id AS varchar(20))) AS foreign_store_name, upper(event_type) AS foreign_item_name
        FROM {{events}} GROUP BY user_id, event_type""",
    "packs": f"""SELECT {_tenant('user_id')}, event_type AS foreign_item_id,
        CASE WHEN event_type = 'signup' THEN NULL ELSE length(event_type) + 0.5 END AS mfu
        FROM {{events}} GROUP BY 1, 2, 3""",
    "cycles": f"""SELECT {_tenant('user_id')},
        concat(CASE WHEN min(value) < 5 THEN '' ELSE 'no store ' END, CAST(user_id AS varchar(20))) AS foreign_store_id,
        CASE user_id % 3 WHEN 0 THEN '单日配' WHEN 1 THEN '双日配' ELSE '三日配' END AS dly_cycle
        FROM {{events}} GROUP BY user_id""",
    "settings": f"""SELECT 43 AS cmid, 'A' AS code_a, CAST(NULL AS varchar(5)) AS code_b, 1 AS days_delay, 'p' AS ignored
        UNION ALL SELECT 85, 'N', 'R', 3, 'c'""",
    "event_rows": """SELECT event_id, user_id, event_type FROM {events}""",
}

LINEITEM = {
    "cost": f"""SELECT {_L_KEYS}, {_L_DAY} AS date, CAST(sum({_L_QTY}) AS bigint) AS sale_quantity,
        CAST(sum(CAST(l_extendedprice AS decimal(12,2))) AS decimal(18,2)) AS total_sale,
        CAST(sum(CAST(l_extendedprice AS decimal(12,2))) * 0.8 AS decimal(18,4)) AS total_cost
        FROM {{lineitem}} GROUP BY 1, 2, 3, 4""",
    "inventory": f"""SELECT {_L_KEYS}, {_L_DAY} + l_linenumber % 2 AS date,
        CAST(sum(CASE WHEN l_returnflag = 'R' THEN -{_L_QTY} ELSE {_L_QTY} END) AS bigint) AS quantity,
        CAST(sum(CAST(l_extendedprice AS decimal(12,2))) AS decimal(18,2)) AS amount
        FROM {{lineitem}} GROUP BY 1, 2, 3, 4""",
    "goods": """SELECT cmid, CAST(p_partkey AS varchar(20)) AS foreign_item_id, p_name AS item_name,
        concat('69', CAST(p_partkey AS varchar(20))) AS barcode, concat('P', CAST(p_partkey AS varchar(20))) AS show_code,
        p_brand AS foreign_category_lv1,
        CASE WHEN p_type = 'PROMO' THEN '淘汰' WHEN p_type = 'ECONOMY' THEN '淘汰品' ELSE p_type END AS item_status,
        CAST(CAST(p_retailprice AS decimal(18,4)) * 0.8 AS decimal(18,4)) AS lastin_price,
        CAST(p_retailprice AS decimal(18,4)) AS sale_price
        FROM (SELECT 43 AS cmid, p.* FROM {part} p UNION ALL SELECT 85, p.* FROM {part} p) t""",
    "stores": f"""SELECT {_tenant('s_suppkey')}, CAST(s_suppkey AS varchar(20)) AS foreign_store_id, s_name AS store_name,
        concat('S', CAST(s_suppkey AS varchar(20))) AS show_code, s_nationkey % 3 AS property_id,
        CASE WHEN s_acctbal < 0 THEN '闭店' ELSE '营业' END AS store_status FROM {{supplier}}""",
    "ways": f"""SELECT {_L_KEYS}, max(CASE WHEN l_returnflag <> 'N' THEN l_linestatus END) AS alc_way
        FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "delivery": f"""SELECT {_L_KEYS}, {_L_DAY} AS delivery_date, {_L_QTY} AS delivery_qty,
        CASE WHEN l_linestatus = 'F' THEN '统配出' ELSE '直配出' END AS delivery_type FROM {{lineitem}}""",
    "suggestions": f"""SELECT {_L_KEYS}, {_L_DAY} - CAST(1 + l_suppkey % 2 AS int) AS date, {_L_QTY} % 12 AS fill_qty
        FROM {{lineitem}}""",
    "require_orders": f"SELECT {_L_KEYS}, {_L_DAY} - 1 AS date, {_L_QTY} % 7 AS order_qty FROM {{lineitem}}",
    "cm_sku": f"SELECT {_L_KEYS}, l_returnflag AS busgate FROM {{lineitem}}",
    "aa_sku": f"""SELECT {_tenant('l_suppkey')}, CAST(l_suppkey AS varchar(20)) AS foreign_store_id,
        concat(CASE WHEN l_discount > 0.05 THEN '' ELSE 'no item ' END, CAST(l_partkey AS varchar(20))) AS foreign_item_id
        FROM {{lineitem}}""",
    "refunds": f"""SELECT {_tenant('l_suppkey')}, CAST(l_suppkey AS varchar(20)) AS foreign_store_id,
        concat(CASE WHEN l_returnflag = 'R' THEN '' ELSE 'no item ' END, CAST(l_partkey AS varchar(20))) AS foreign_item_id,
        CASE WHEN l_linestatus = 'F' THEN '退货' ELSE '调拨' END AS method FROM {{lineitem}}""",
    "warehouse": f"""SELECT {_tenant('l_suppkey')}, CAST(l_partkey AS varchar(20)) AS foreign_item_id, {_L_DAY} - 1 AS date,
        {_L_QTY} AS stock_qty FROM {{lineitem}}""",
    "detail_sheet": f"""SELECT {_tenant('l_suppkey')}, CAST(l_suppkey AS varchar(20)) AS "门店ID",
        concat('item ', CAST(l_partkey AS varchar(20))) AS "商品名称", CAST(l_linenumber AS double) AS "当前库存",
        concat('P', CAST(l_partkey AS varchar(20))) AS "商品show_code", l_quantity AS "今日销量",
        CASE WHEN l_tax < 0.03 THEN '低' ELSE '高' END AS "密度",
        CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '退货' ELSE NULL END AS "原因",
        CASE WHEN {_L_QTY} % 7 = 0 THEN NULL ELSE CAST({_L_QTY} % 12 AS double) END AS "上上次建议单",
        CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_partkey % 12 AS double) END AS "上上次订货单",
        CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(l_orderkey % 12 AS double) END AS "上次送货单",
        CAST({_L_DAY} AS varchar(10)) AS date FROM {{lineitem}}""",
    "summary_sheet": f"""SELECT {_tenant('l_suppkey')}, CAST(l_suppkey AS varchar(20)) AS "门店ID",
        concat('store ', CAST(l_suppkey AS varchar(20))) AS "门店名称",
        count(DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_partkey END) / CAST(count(*) AS double) AS "门店缺货率",
        count(DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_partkey END) AS "现门店已缺货 SKU 数",
        count(*) AS "门店统配商品全量 SKU 数", CAST({_L_DAY} AS varchar(10)) AS date
        FROM {{lineitem}} GROUP BY l_suppkey, {_L_DAY}""",
    "store_info": f"""SELECT {_tenant('l_suppkey')}, CAST(l_suppkey AS varchar(20)) AS foreign_store_id,
        concat('store ', CAST(l_suppkey AS varchar(20))) AS store_name, {_L_DAY} AS date,
        count(DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_partkey END) AS lost_sku, count(*) AS all_sku
        FROM {{lineitem}} GROUP BY l_suppkey, {_L_DAY}""",
    "product_rows": f"""SELECT {_L_KEYS}, concat('S', CAST(l_suppkey AS varchar(20))) AS store_show_code,
        concat('P', CAST(l_partkey AS varchar(20))) AS item_show_code, {_L_DAY} AS date,
        CAST(1 + l_linenumber % 5 AS bigint) AS lost_reason
        FROM {{lineitem}}""",
    "psd": f"""SELECT {_L_KEYS}, concat(CASE WHEN l_linestatus = 'O' THEN 'P' ELSE 'no item ' END, CAST(l_partkey AS varchar(20)))
        AS item_show_code, {_L_DAY} AS date,
        max(l_extendedprice) AS psd_cost FROM {{lineitem}} GROUP BY l_suppkey, l_partkey, l_linestatus, {_L_DAY}""",
    "trial_stores": f"""SELECT {_tenant('s_suppkey')}, CAST(s_suppkey AS varchar(20)) AS foreign_store_id, s_name AS foreign_store_name,
        concat('T', CAST(s_suppkey AS varchar(20))) AS show_code, DATE '2001-03-01' + CAST(s_suppkey % 60 AS int) AS date,
        DATE '2001-01-01' + CAST(s_suppkey % 30 AS int) AS start_date, DATE '2001-04-01' + CAST(s_suppkey % 150 AS int) AS end_date,
        DATE '2001-03-15' + CAST(s_suppkey % 40 AS int) AS execute_date, s_nationkey % 3 AS deal_status FROM {{supplier}}""",
    "suggestion_files": f"""SELECT {_tenant('o_custkey')}, o_orderdate AS modification_time,
        concat('dist/', CAST(o_custkey AS varchar(20)), '/', CAST(CAST(o_orderdate AS date) AS varchar(10)), '.csv.gz') AS path
        FROM {{orders}}""",
    "goods_raw": f"""SELECT {_tenant('p_partkey')}, {_RAW_IDS}, p_name AS item_name,
        CASE p_type WHEN 'PROMO' THEN '淘汰' WHEN 'ECONOMY' THEN '淘汰品' WHEN 'LARGE' THEN NULL ELSE p_type END AS item_status,
        {_RAW_PRICE} AS lastin_price, CASE WHEN p_size = 7 THEN p_name ELSE {_RAW_PRICE} END AS sale_price FROM {{part}}
        UNION ALL
        SELECT {_tenant('p_partkey')}, {_RAW_IDS}, p_name, 'NEW', NULL, {_RAW_PRICE} FROM {{part}}""",
}

SHARED = {
    "users": """SELECT c_nationkey AS cmid, c_custkey AS id, c_name AS username, c_mktsegment AS first_name,
        c_acctbal < -900 AS is_staff FROM {customer}""",
    "user_identity": """SELECT c_custkey AS user_id, c_custkey AS enterprise_identity_id,
        CASE WHEN c_acctbal > 9000 THEN 0 ELSE 1 END AS status FROM {customer}""",
    "identity": """SELECT c_custkey AS id, c_nationkey AS cmid, CASE WHEN c_acctbal < -500 THEN 0 ELSE 1 END AS status,
        c_mktsegment = 'BUILDING' AS is_store, c_acctbal > 9500 AS is_staff, CAST(c_custkey % 5 + 1 AS int) AS level,
        CASE WHEN c_acctbal < 500 THEN NULL WHEN c_acctbal < 2000 THEN '区域店长' ELSE '督导' END AS identity_lv2_name,
        CASE WHEN c_acctbal < 500 THEN NULL WHEN c_acctbal < 2000 THEN '店长A' ELSE '督导' END AS identity_lv3_name,
        CASE WHEN c_acctbal < 500 THEN NULL WHEN c_acctbal < 2000 THEN '店长' ELSE '经理' END AS identity_lv4_name,
        '组长' AS identity_lv5_name,
        concat('S', CAST(c_custkey AS varchar(20))) AS store_a,
        concat('S', CAST(CAST(floor(c_custkey / 3.0) AS bigint) AS varchar(20))) AS store_b,
        concat('S', CAST(CAST(floor(c_custkey / 10.0) AS bigint) AS varchar(20))) AS store_c FROM {customer}""",
    "store_resources": "SELECT s_nationkey AS cmid, concat('S', CAST(s_suppkey AS varchar(20))) AS showcode FROM {supplier}",
    "enterprises": "SELECT c_nationkey AS cmid FROM {customer}",
    "tenant_config": """SELECT n_nationkey AS cmid, CASE WHEN n_regionkey < 2 THEN 'B' ELSE 'A' END AS vendor FROM {nation}""",
    "ways_a": """SELECT c_nationkey AS cmid, CAST(c_custkey AS varchar(20)) AS foreign_store_id, c_mktsegment AS foreign_item_id,
        'A' AS alc_way FROM {customer}""",
    "ways_b": """SELECT s_nationkey AS cmid, CAST(s_suppkey AS varchar(20)) AS foreign_store_id, s_name AS foreign_item_id,
        'B' AS alc_way FROM {supplier}""",
    "packs_b": f"""SELECT {_tenant('p_partkey')}, concat('B', CAST(p_partkey AS varchar(20))) AS foreign_item_id,
        CAST(p_size AS bigint) AS qpc FROM {{part}}""",
    "packs_config": "SELECT 85 + n_nationkey AS cmid, 'B' AS vendor FROM {nation}",
    "packs_a": f"""SELECT {_tenant('l_suppkey')}, l_partkey AS gid, CAST(l_quantity AS bigint) AS qpc,
        l_linenumber AS isdu FROM {{lineitem}}""",
}



def loader(spark: SparkSession, sf_dir: str, texts: dict[str, str]) -> Callable[[str], DataFrame]:
    """Function that builds one derived table by name; base files are opened once."""
    base = functools.cache(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    def load(name: str) -> DataFrame:
        text = texts[name].replace('"', "`")
        return spark.sql(text, **{table: base(table) for table in BASE_TABLES if f"{{{table}}}" in text})

    return load


def ctes(texts: dict[str, str], *names: str) -> str:
    """`WITH` clause that defines the derived tables for the reference SQL."""
    plain = {table: table for table in BASE_TABLES}
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({texts[name].format(**plain)})" for name in names) + "\n"
