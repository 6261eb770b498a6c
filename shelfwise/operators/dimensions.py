"""Dimension queries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.keys import ITEM
from shelfwise.sources.tables import vendor_unified


def packsize_distinct(packs: DataFrame, vendor: str = "A") -> DataFrame:
    """Distinct pack sizes per item. Vendor A lists units per use (2 = delivery) and ids as `gid`."""
    if vendor == "A":
        packs = packs.filter(F.col("isdu") == 2).withColumnRenamed("gid", "foreign_item_id")
    return packs.select(
        "cmid", F.col("foreign_item_id").cast("string").alias("foreign_item_id"), F.col("qpc").alias("mfu")
    ).distinct()


def packsize_by_tenant(tenant_config: DataFrame, by_vendor: dict[str, DataFrame], default_vendor: str = "A") -> DataFrame:
    """Distinct pack sizes of every tenant from the table of its own vendor, all tenants in one pass.

    `tenant_config` has cmid and vendor; a tenant that is missing there has the default vendor.
    """
    sizes = {vendor: packsize_distinct(packs, vendor) for vendor, packs in by_vendor.items()}
    return vendor_unified(tenant_config, sizes, default_vendor).drop("vendor")


def packsize_counts(packs: DataFrame) -> DataFrame:
    """Non-null values per tenant and column before and after removing repeated rows.

    Rows are folded with their multiplicity once; both counts come from that.
    """
    folded = packs.groupBy(*ITEM, "mfu").agg(F.count(F.lit(1)).alias("n"))
    counts = folded.groupBy("cmid").agg(
        *[
            expr
            for c in ("foreign_item_id", "mfu")
            for expr in (
                F.sum(F.when(F.col(c).isNotNull(), F.col("n")).otherwise(0)).alias(f"{c}_before"),
                F.count(c).alias(f"{c}_after"),
            )
        ]
    )
    return counts.select(
        "cmid",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"{c}_before").alias("rows_before"),
                        F.col(f"{c}_after").alias("rows_after"),
                    )
                    for c in ("foreign_item_id", "mfu")
                ]
            )
        ),
    )


def tenants(enterprises: DataFrame, excluded: Sequence[int] = (1,)) -> DataFrame:
    return enterprises.filter(~F.col("cmid").isin(list(excluded))).select("cmid").distinct()


def tenant_stores(store_resources: DataFrame, cmid: int) -> DataFrame:
    return store_resources.filter(F.col("cmid") == cmid).select("showcode")


def concat_by_name(*frames: DataFrame) -> DataFrame:
    """Union all by column name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def require_non_empty(df: DataFrame, name: str) -> DataFrame:
    """Raise when there is no row, else pass the frame on."""
    if df.isEmpty():
        raise ValueError(f"{name} must not be empty")
    return df


def non_empty_report(frames: dict[str, DataFrame], counted: bool = True) -> DataFrame:
    """Row count and verdict per table (F13); without `counted` a table is read up to its first row, and the count is 0 or 1."""
    rows = [
        (df if counted else df.limit(1)).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return concat_by_name(*rows).withColumn("is_ok", F.col("row_count") > 0)


def mapping_table(documents: DataFrame, column: str = "document", keys: Sequence[str] = ()) -> DataFrame:
    """Property dimension from API documents `{"result": [{...}, ...]}` (S19), with `keys` of the
    document, the tenant say."""
    schema = "struct<result:array<struct<store_property:string,cm_store_property_id:string>>>"
    parsed = F.from_json(F.col(column), schema)
    return documents.select(*keys, F.inline(parsed["result"])).withColumnRenamed("store_property", "property")
