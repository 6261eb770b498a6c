"""Loading the daily stock-out report into the monitoring tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.calendar import as_date
from shelfwise.functions.codes import strategy_type
from shelfwise.functions.numbers import nan_to_null
from shelfwise.functions.reasons import lost_reason
from shelfwise.keys import CLOSED_STATUS, STORE

# Headers of the report sheets and the columns they load into.
SUMMARY_HEADERS = {
    "门店ID": "foreign_store_id",
    "门店名称": "store_name",
    "门店缺货率": "store_lost_rate",
    "现门店已缺货 SKU 数": "lost_sku",
    "门店统配商品全量 SKU 数": "all_sku",
}
DETAIL_HEADERS = {
    "门店ID": "foreign_store_id",
    "商品名称": "item_name",
    "当前库存": "actual_stock",
    "商品show_code": "item_show_code",
    "今日销量": "avg_qty",
    "密度": "strategy_type",
    "原因": "cause",
    "上上次建议单": "cm_suggest",
    "上上次订货单": "store_book",
    "上次送货单": "inv_delivery",
}


def _renamed(sheet: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Sheet columns by their new names; a NaN of the sheet is an unknown value."""
    return nan_to_null(sheet).select("cmid", *[F.col(f"`{header}`").alias(name) for header, name in headers.items()], "date")


def _empty_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.lit(None).cast("double") for name in names})


def _sheet(report: DataFrame, headers: dict[str, str]) -> DataFrame:
    """A stored report under the headers of its sheet; a column that it lacks is empty."""
    cells = [(F.col(name) if name in report.columns else F.lit(None).cast("string")).alias(header) for header, name in headers.items()]
    return report.select("cmid", *cells, "date")


def summary_sheet(report: DataFrame) -> DataFrame:
    """The summary of `stockout_summary`, with its day, as the sheet that `load_summary` reads."""
    return _sheet(report, SUMMARY_HEADERS)


def detail_sheet(report: DataFrame) -> DataFrame:
    """The detail of `stockout_detail`, with its day, as the sheet that `load_detail` reads; it has no density."""
    return _sheet(report, DETAIL_HEADERS)


def load_summary(sheet: DataFrame) -> DataFrame:
    """Summary sheet with column names of the store table and empty scores."""
    return _empty_columns(
        _renamed(sheet, SUMMARY_HEADERS).withColumn("date", F.to_date("date")), "store_score", "update_score"
    )


def detail_rows(sheet: DataFrame) -> DataFrame:
    """Detail sheet with column names of the product table, before the reason is judged."""
    renamed = _renamed(sheet, DETAIL_HEADERS).withColumn("date", F.to_date("date"))
    return _empty_columns(
        renamed.withColumn("strategy_type", strategy_type(F.col("strategy_type"))),
        "actual_lost",
        "theory_stock",
        "item_score",
        "update_score",
    )


def store_labels(stores: DataFrame, enrolled_stores: DataFrame) -> DataFrame:
    """What the loads need to know about a store, one row per store.

    Written as a table and passed on, it gives every load a single join by store: small
    tables are broadcast, and beyond that size a store with very many rows can still be
    split by adaptive execution, which a chain of joins on one key would prevent.
    """
    known = stores.select(
        *STORE,
        F.col("show_code").alias("store_show_code"),
        F.coalesce(F.col("store_status") == CLOSED_STATUS, F.lit(False)).alias("is_closed"),
        F.lit(True).alias("is_known"),
    )
    enrolled = enrolled_stores.select(*STORE).distinct().withColumn("enrolled", F.lit(True))
    return known.join(enrolled, STORE, "full")


def load_detail(sheet: DataFrame, labels: DataFrame) -> DataFrame:
    """Detail sheet with reason codes; enrolled stores are judged by the suggestion."""
    judged = detail_rows(sheet).join(labels, STORE, "left")
    return judged.withColumn("lost_reason", lost_reason(F.col("enrolled")))


def judge_by_date(rows: DataFrame, trial_stores: DataFrame, how: str = "left") -> DataFrame:
    """Detail rows judged by the suggestion from the store's go-live date on.

    Rows of other stores are judged by the booking, or left out with `how="inner"`.
    """
    live = trial_stores.select(
        *STORE, F.col("date").alias("use_date"), F.col("show_code").alias("store_show_code")
    )
    return rows.join(live, STORE, how).withColumn("lost_reason", lost_reason(F.col("date") >= F.col("use_date")))


def open_stores_only(df: DataFrame, stores: DataFrame) -> DataFrame:
    """Rows of stores that are not closed."""
    return df.join(stores.filter(F.col("store_status") == CLOSED_STATUS).select(*STORE), STORE, "left_anti")


def join_psd(detail: DataFrame, psd: DataFrame) -> DataFrame:
    """Adds item id and velocity cost by tenant, store, show code and date.

    One join for all dates. A day without a velocity table gives NULL.
    """
    velocity = psd.select(*STORE, "item_show_code", "date", "foreign_item_id", "psd_cost")
    return detail.join(velocity, [*STORE, "item_show_code", "date"], "left")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(",")]


PRODUCT_COLUMNS = _names(schemas.STORE_PRODUCT_INFO)
STORE_COLUMNS = _names(schemas.STORE_INFO)


def store_info_load(sheet: DataFrame, labels: DataFrame) -> DataFrame:
    """Summary rows of known, open stores, ready for the store table (C11)."""
    open_stores = labels.filter(F.col("is_known") & ~F.col("is_closed"))
    return load_summary(sheet).join(open_stores, STORE).select(*STORE_COLUMNS)


def first_suggestion_date(suggestion_files: DataFrame) -> DataFrame:
    """Date in the name of the oldest suggestion file per tenant.

    `suggestion_files` is an object listing with cmid, path and modification time. The
    result has one row per tenant; written as a table, it is broadcast.
    """
    name_date = F.to_date(F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})[^/]*$", 1))
    return (
        suggestion_files.groupBy("cmid")
        .agg(F.min(F.struct("modification_time", "path")).alias("oldest"))
        .select("cmid", F.col("oldest.path").alias("path"))
        .select("cmid", name_date.alias("use_date"))
    )


def product_exception_load(
    sheet: DataFrame, labels: DataFrame, first_dates: DataFrame, psd: DataFrame, as_of
) -> DataFrame:
    """Detail rows of stores not closed, with reason, velocity and go-live date.

    `labels` comes from `store_labels`. `first_dates` has one `use_date` per tenant, see
    `first_suggestion_date`; tenants without one get `as_of`.
    """
    loaded = (
        load_detail(sheet, labels)
        .filter(~F.coalesce("is_closed", F.lit(False)))
        .join(first_dates.select("cmid", "use_date"), "cmid", "left")
        .withColumn("use_date", F.coalesce("use_date", as_date(as_of)))
    )
    return join_psd(loaded, psd).select(*PRODUCT_COLUMNS)
