"""Incremental loads of an object store.

The ledger is a table of the objects that were loaded: path, modification time and length, in the partition of
their tenant and day. A run compares it with the listing, which opens no object. Days
with an object that is new, was replaced or is gone are loaded again, whole, from all their
current objects; the others are not touched. The rows are committed before the ledger, so a run that
stopped between the two loads its days once more, with the same outcome.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sinks import days
from shelfwise.sources import files
from shelfwise.sources.scratch import settle

SCHEMA = "path string, modification_time timestamp, length bigint, cmid int, date date"
OBJECT = ["path", "modification_time", "length"]


def dated_listing(spark: SparkSession, root: str, file_glob: str = "*", tenant_from_end: int = 3, date_from_end: int = 2) -> DataFrame:
    """Objects below a prefix with the tenant and day of their path; objects without either are left out."""
    path = F.col("path")
    listing = files.object_listing(spark, root, file_glob).select(*OBJECT, files.path_part(path, tenant_from_end).try_cast("int").alias("cmid"), files.path_date(path, date_from_end).alias("date"))
    return listing.filter(F.col("cmid").isNotNull() & F.col("date").isNotNull())


def changes(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """(cmid, date, path, what): objects that are `new`, were `replaced`, or are `gone`.

    Both sides are stacked and aggregated by object, so there is one shuffle of names and no join.
    """
    known = F.struct("modification_time", "length")
    both = listing.select("cmid", "date", "path", known.alias("now"), F.lit(None).cast("struct<modification_time:timestamp,length:bigint>").alias("then")).unionByName(
        ledger.select("cmid", "date", "path", F.lit(None).cast("struct<modification_time:timestamp,length:bigint>").alias("now"), known.alias("then"))
    )
    found = both.groupBy("cmid", "date", "path").agg(F.max("now").alias("now"), F.max("then").alias("then"))
    what = F.when(F.col("then").isNull(), "new").when(F.col("now").isNull(), "gone").when(~F.col("now").eqNullSafe(F.col("then")), "replaced")
    return found.select("cmid", "date", "path", what.alias("what")).filter(F.col("what").isNotNull())


def load_new(
    spark: SparkSession,
    root: str,
    read: Callable[[Sequence[str]], DataFrame],
    table: str,
    ledger: str,
    folder: str,
    schema: str,
    file_glob: str = "*",
    tenant_from_end: int = 3,
    date_from_end: int = 2,
) -> dict[str, int]:
    """Bring the daily tables `table` and `ledger` (below `folder`) up to date with the objects below `root`.

    `read` makes rows with cmid and date from paths, of whole days only. Returns how many objects are new, replaced
    and gone; without any, no object is opened and no table is touched. `schema` is that of `table`.
    """
    days.create(spark, table, schema, f"{folder}/rows")
    days.create(spark, ledger, SCHEMA, f"{folder}/ledger")
    listing = settle(dated_listing(spark, root, file_glob, tenant_from_end, date_from_end), "listing")
    changed = settle(changes(listing, spark.table(ledger)), "changed-objects")
    counts = {row.what: row["count"] for row in changed.groupBy("what").count().collect()}
    if not counts:
        return counts
    touched = changed.select("cmid", "date").distinct()
    current = settle(listing.join(touched, ["cmid", "date"], "left_semi"), "current-objects")
    # the names of the objects that this run opens: the reader needs them as its argument
    paths = [row.path for row in current.select("path").orderBy("path").toLocalIterator()]
    rows = read(paths) if paths else spark.table(table).limit(0)
    days.replace(rows, table, touched)
    days.replace(current, ledger, touched)
    return counts


def reader(spark: SparkSession, schema: str, header: bool = True, tenant_from_end: int = 3, date_from_end: int = 2) -> Callable[[Sequence[str]], DataFrame]:
    """Reads CSV objects by path, with tenant and day from the path; a bad cell or a damaged object fails the load."""

    def read(paths: Sequence[str]) -> DataFrame:
        path = F.col("_metadata.file_path")
        rows = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(list(paths))
        return rows.select("*", files.path_part(path, tenant_from_end).cast("int").alias("cmid"), files.path_date(path, date_from_end).alias("date"))

    return read
