"""Schemas of the output tables. Writers select these columns by name and cast to these types.

Names and types are fixed values of the systems that read the tables.
"""

from __future__ import annotations

PSD_INFO = """
    cmid int, foreign_store_id string, foreign_item_id string, sum_total_sale double, psd double,
    lastin_price double, psd_cost double, date date, item_show_code string
"""
PRODUCT_INFO = """
    cmid int, foreign_store_id string, foreign_store_name string, foreign_item_id string, barcode string,
    item_name string, item_status string, item_show_code string, delivery_method string, store_status string,
    days int, psd double, total_sale double, total_cost double, avg_sale double, lastin_price double,
    sale_price double, psd_cost double, update_date date
"""
STORE_INFO = """
    cmid int, foreign_store_id string, store_name string, store_lost_rate double, lost_sku bigint, all_sku bigint,
    date date, store_score double, update_score double, store_show_code string
"""
STORE_PRODUCT_INFO = """
    cmid int, foreign_store_id string, store_show_code string, foreign_item_id string, item_show_code string,
    item_name string, actual_stock double, cm_suggest double, store_book double, inv_delivery double,
    use_date date, date date, theory_stock double, avg_qty double, actual_lost double, lost_reason bigint,
    strategy_type string, psd_cost double, item_score double, update_score double
"""
REPORT_SUMMARY = """
    cmid int, store_name string, foreign_store_id string, store_type string, lost_sku bigint, all_sku bigint,
    store_lost_rate double, un_suggest bigint, un_order bigint, un_deliver bigint, un_suggest_rate double,
    un_order_rate double, un_deliver_rate double, suggest_date date, require_date date, delivery_date date, date date
"""
REPORT_DETAIL = """
    cmid int, foreign_store_id string, store_name string, foreign_item_id string, item_show_code string,
    item_name string, actual_stock double, order_stock double, sale_days_60 bigint, sale_days_28 bigint,
    cm_suggest double, store_book double, inv_delivery double, avg_sale_7 double, avg_quantity_7 double,
    is_aa string, cause string, warehouse_stock double, avg_qty double, date date
"""
STORE_PRODUCT_WEEK = """
    cmid int, foreign_store_id string, store_show_code string, cm_suggest bigint, store_book bigint,
    inv_delivery bigint, other_reason bigint, date date, y int, wk int
"""
NEW_STORE_PRODUCT_WEEK = """
    cmid int, foreign_store_id string, store_show_code string, cm_suggest bigint, store_book bigint,
    inv_delivery bigint, return_goods bigint, other_reason bigint, date date, y int, wk int
"""
NEW_STORE_INFO_WEEK = """
    cmid int, foreign_store_id string, store_show_code string, store_name string, lost_sku bigint, all_sku bigint,
    store_lost_rate double, date date, y int, wk int
"""
STORE_INFO_WEEK = """
    cmid int, foreign_store_id string, date date, lost_sku bigint, all_sku bigint, store_lost_rate double,
    y string, wk string, store_show_code string, store_name string
"""
PRODUCT_STORE = """
    cmid int, foreign_store_id string, foreign_item_id string, foreign_item_name string, foreign_store_name string
"""
PRODUCT_HISTORY = """
    cmid int, foreign_store_id string, foreign_store_name string, foreign_item_id string, foreign_item_name string,
    fill_qty double, prediction_stock int, theory_stock int, date date
"""
FILLED_HISTORY = """
    cmid int, foreign_store_id string, foreign_store_name string, foreign_item_id string, foreign_item_name string,
    prediction_stock int, theory_stock int, date date
"""
STORE_SUPERVISOR = "cmid int, first_name string, foreign_store_id string, user_id string, user_name string"
