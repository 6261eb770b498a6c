"""Writers of whole tables (K3-K6, K9-K12); `sinks.days` has the daily ones."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEPT_VERSIONS = 3
JDBC_BATCH_ROWS = 5000


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Columns of the target by name, cast to its types; a missing column is an error."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _saved(df: DataFrame, mode: str, table: str, path: str | None, buckets: tuple[int, Sequence[str]] | None = None) -> None:
    writer = df.write.mode(mode).format("parquet")
    if buckets is not None:
        count, keys = buckets
        writer = writer.bucketBy(count, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def replace_table(
    df: DataFrame, table: str, schema: StructType | str | None = None, path: str | None = None
) -> None:
    """Replace a table, with a fixed schema (K3) or the frame's own."""
    _saved(conform(df, schema) if schema else df, "overwrite", table, path)


def append_table(df: DataFrame, table: str) -> None:
    """Append by column name (K5)."""
    existing = df.sparkSession.table(table).schema
    _saved(conform(df, existing), "append", table, None)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def versions(spark: SparkSession, table: str) -> list[str]:
    """Version tables of a published table, oldest first."""
    database, _, name = table.rpartition(".")
    found = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{name}__v*'").collect()
    return sorted(f"{database}.{row.tableName}" if database else row.tableName for row in found)


def replace_bucketed(df: DataFrame, table: str, buckets: int, keys: Sequence[str]) -> None:
    """Replace a table whose rows lie in `buckets` by the hash of `keys` (J8): joins, windows and aggregates on the keys read
    it without a shuffle. Rows are dealt by the same hash before writing, so each bucket is one file."""
    _saved(df.repartition(buckets, *keys), "overwrite", table, None, (buckets, keys))


def publish_swap(df: DataFrame, table: str, keep: int = KEPT_VERSIONS, empty_ok: bool = False, buckets: tuple[int, Sequence[str]] | None = None) -> None:
    """Write a new version as a table of its own, then point the view `table` at it (K9).

    `buckets` (number, keys) writes it as `replace_bucketed` does.

    Replacing the view is one catalog operation: a reader meets the old version or the new
    one, and a crash at any step leaves the old one. An empty version is not published,
    unless that is allowed (F13). The last `keep` versions stay for readers that still use
    them; older ones are dropped with their files.
    """
    if keep < 1:
        raise ValueError("at least the published version must be kept")
    spark = df.sparkSession
    older = versions(spark, table)
    number = int(older[-1].rpartition("__v")[2].partition("_")[0]) + 1 if older else 1
    version = f"{table}__v{number:06d}_{uuid.uuid4().hex[:8]}"
    _saved(df if buckets is None else df.repartition(buckets[0], *buckets[1]), "errorifexists", version, None, buckets)
    if not empty_ok and spark.table(version).isEmpty():
        spark.sql(f"DROP TABLE {version}")
        raise ValueError(f"{table} must not become empty")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")
    for old in [*older, version][:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def jdbc_options(url: str, table: str, partitions: int = 8, batch_rows: int = JDBC_BATCH_ROWS) -> dict[str, str]:
    """Options of a chunked database write (K6)."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(partitions)}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").mode(mode).options(**(jdbc_options(url, table) | options)).save()

