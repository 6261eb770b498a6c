"""Table scans and tenant-dependent source choice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def project_tenant(table: DataFrame, cmid: int | None = None, *fields: str) -> DataFrame:
    """Projection and tenant filter; both reach the scan."""
    if cmid is not None:
        table = table.filter(F.col("cmid") == cmid)
    return table.select(*fields) if fields else table


def jdbc_options(
    url: str, query: str, partition_column: str | None = None, bounds: tuple[str, str] | None = None, partitions: int = 8
) -> dict[str, str]:
    """Options of a database read; with a partition column the read is split over tasks."""
    options = {"url": url, "dbtable": f"({query}) source"}
    if partition_column is not None:
        low, high = bounds
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": low,
            "upperBound": high,
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 8,
    **options: str,
) -> DataFrame:
    """Result of a query in a remote database.

    Connection options are configuration. Facts need a partition column (a date, say);
    without one the whole result passes through a single task.
    """
    split = jdbc_options(url, query, partition_column, bounds, partitions)
    return spark.read.format("jdbc").options(**(split | options)).load()


def vendor_unified(tenant_config: DataFrame, by_vendor: dict[str, DataFrame], default_vendor: str = "A") -> DataFrame:
    """Rows of each tenant's own vendor system out of several vendor tables.

    `tenant_config` has cmid and vendor, one row per tenant; a tenant that is missing
    there has the default vendor.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [table.withColumn("vendor", F.lit(vendor)) for vendor, table in by_vendor.items()],
    )
    own = tenant_config.select("cmid", F.col("vendor").alias("own_vendor"))
    chosen = F.coalesce("own_vendor", F.lit(default_vendor))
    return stacked.join(own, "cmid", "left").filter(F.col("vendor") == chosen).drop("own_vendor")
