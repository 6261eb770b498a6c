"""Daily tables whose days are partitions of the catalog.

A daily table is an external table partitioned by tenant and day. A load writes its rows into a folder of
its own, complete, and then points the partitions at it: a day that exists is moved by one
catalog operation, so a reader meets the old day or the new one; new days are added by one statement, days without
rows any more and expired days are dropped by one each. Nothing is overwritten in place and a
crash leaves every day old or new; a rerun ends the same.

Folders that no partition points at any more are kept for readers that still use them: they
become partitions of a managed table beside (`..._old`), numbered by load, and dropping these after
`KEPT_LOADS` further loads lets the catalog delete them. No file system handle is needed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwise.sources.scratch import delete_folders, quoted

RETENTION_DAYS = 84
KEPT_LOADS = 3
DAY_PARTITION = ("cmid", "date")


def spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Few, evenly sized files per partition: small ones are merged, a hot one is split."""
    return df.hint("rebalance", *by)


Spec = tuple[str, ...]
"""The values of a partition as text, in the order of its columns."""


def _clause(by: Sequence[str], spec: Spec) -> str:
    return f"PARTITION ({', '.join(f'{name} = {quoted(value)}' for name, value in zip(by, spec, strict=True))})"


def specs_of(rows: DataFrame, by: Sequence[str]) -> set[Spec]:
    """The different partitions of some rows: bounded by tenants times days of one load."""
    return {tuple(str(value) for value in row) for row in rows.select(*by).distinct().toLocalIterator()}


def partitions(spark: SparkSession, table: str) -> set[Spec]:
    """Partitions of a table by their values; only the catalog is asked."""
    found = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {tuple(part.partition("=")[2] for part in row.partition.split("/")) for row in found}


def create(spark: SparkSession, table: str, schema: StructType | str, root: str, by: Sequence[str] = DAY_PARTITION) -> None:
    """Create the table at `root` if it is not there."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(by)}) LOCATION {quoted(root)}")


def _folders(table: DataFrame, by: Sequence[str], specs: set[Spec]) -> list[str]:
    """The folders in which the files of some partitions lie; columns are not read."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    rows = within(table.select(*by, folder.alias("folder")), by, specs)
    return sorted(row.folder for row in rows.select("folder").distinct().toLocalIterator())


def _retired(spark: SparkSession, table: str) -> str:
    name = f"{table}_old"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (unused int, load string, folder string) USING parquet PARTITIONED BY (load, folder)")
    return name


def retire(spark: SparkSession, table: str, folders: Iterable[str], keep: int = KEPT_LOADS) -> None:
    """Hand folders that the table has left over to be deleted after `keep` further loads that leave any."""
    old = _retired(spark, table)
    held = partitions(spark, old)
    number = 1 + max((int(load) for load, _ in held), default=0)
    added = [f"PARTITION (load = '{number:08d}', folder = '{uuid.uuid4().hex}') LOCATION {quoted(folder)}" for folder in folders]
    if added:
        spark.sql(f"ALTER TABLE {old} ADD {' '.join(added)}")
    expired = [_clause(("load", "folder"), spec) for spec in sorted(held) if int(spec[0]) <= number - keep]
    if expired:
        spark.sql(f"ALTER TABLE {old} DROP IF EXISTS {', '.join(expired)}")


def replace(df: DataFrame, table: str, asked: DataFrame | None = None, by: Sequence[str] = DAY_PARTITION, empty_ok: bool = True) -> None:
    """Make `df` the rows of every partition that it has rows for, and of every one `asked` for (K8).

    `asked` has partition keys; one of them without rows is dropped. The table must exist. Rows
    without a value of a partition column are refused, and with `empty_ok=False` a frame without
    any row (F13); neither changes the table.
    """
    spark = df.sparkSession
    root = _root(spark, table)
    load = f"{root}/loads/{uuid.uuid4().hex}"
    kinds = spark.table(table).schema
    ordered = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields])
    spread(ordered, by).write.partitionBy(*by).parquet(load)
    written = specs_of(spark.read.schema(kinds).parquet(load), by)
    if any("None" in spec for spec in written):
        raise ValueError(f"rows of {table} without {' or '.join(by)}")
    if not written and not empty_ok:
        raise ValueError(f"no rows for {table}")
    held = partitions(spark, table)
    wanted = specs_of(asked, by) if asked is not None else set()
    moved, emptied = written & held, (wanted - written) & held
    left = _folders(spark.table(table), by, moved | emptied) if moved or emptied else []
    place = {spec: quoted("/".join([load, *[f"{name}={value}" for name, value in zip(by, spec, strict=True)]])) for spec in written}
    added = [f"{_clause(by, spec)} LOCATION {place[spec]}" for spec in sorted(written - held)]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
    for spec in sorted(moved):
        spark.sql(f"ALTER TABLE {table} {_clause(by, spec)} SET LOCATION {place[spec]}")
    drop(spark, table, emptied, by)
    if left:
        retire(spark, table, left)


def within(table: DataFrame, by: Sequence[str], specs: set[Spec]) -> DataFrame:
    """Rows of some partitions. Each column is bounded by plain values, which prune partitions; the join settles which pairs.

    The partitions are broadcast: by their keys, all rows of one would be sorted in one task.
    """
    if not specs:
        return table.limit(0)
    for k, name in enumerate(by):
        table = table.filter(F.col(name).isin([F.lit(v).cast(table.schema[name].dataType) for v in sorted({spec[k] for spec in specs})]))
    exact = table.sparkSession.createDataFrame(sorted(specs), ", ".join(f"`{name}` string" for name in by))
    kinds = [F.col(name).cast(table.schema[name].dataType).alias(name) for name in by]
    return table.join(F.broadcast(exact.select(*kinds)), list(by), "left_semi")


def _root(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[-1].data_type.rstrip("/")


def drop(spark: SparkSession, table: str, specs: Iterable[Spec], by: Sequence[str] = DAY_PARTITION) -> None:
    """Drop partitions by one statement; the files of an external table stay."""
    dropped = [_clause(by, spec) for spec in sorted(specs)]
    if dropped:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(dropped)}")


def expire(spark: SparkSession, table: str, day: str, retention_days: int = RETENTION_DAYS) -> set[Spec]:
    """Drop the days that are `retention_days` or more before `day` by one statement; returns them."""
    oldest = (dt.date.fromisoformat(day) - dt.timedelta(days=retention_days)).isoformat()
    expired = {spec for spec in partitions(spark, table) if spec[-1] <= oldest}
    if expired:
        left = _folders(spark.table(table), DAY_PARTITION, expired)
        drop(spark, table, expired)
        retire(spark, table, left)
    return expired


def days_of(tenants: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """(cmid, date) of every tenant of a table and every day from `first` to `last`."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last or first).cast("date"))
    return tenants.select("cmid").distinct().select("cmid", F.explode(span).alias("date"))


def write_daily(df: DataFrame, table: str, day: str, loaded: DataFrame, retention_days: int = RETENTION_DAYS, empty_ok: bool = True) -> None:
    """Load the rows of one day and expire old days (K7); `loaded` has the tenants of the input.

    A tenant of the input without rows loses its day; a tenant without input keeps it. The new day stands before
    anything is dropped.
    """
    replace(df, table, days_of(loaded, day), empty_ok=empty_ok)
    expire(df.sparkSession, table, day, retention_days)


def write_csv_days(df: DataFrame, path: str, by: Sequence[str] = DAY_PARTITION, header: bool = True, asked: DataFrame | None = None) -> None:
    """Gzip CSV per day (K1, K2), one folder per partition, replaced for the days the frame has rows for.

    Folders of `asked` partitions without rows are deleted afterwards.
    """
    spark = df.sparkSession
    writer = spread(df, by).write.mode("overwrite").partitionBy(*by)
    writer = writer.option("partitionOverwriteMode", "dynamic").option("header", header)
    writer.option("compression", "gzip").csv(path)
    if asked is not None:
        wanted, rows = specs_of(asked, by), specs_of(df, by)
        delete_folders(spark, ["/".join([path, *[f"{name}={value}" for name, value in zip(by, spec, strict=True)]]) for spec in sorted(wanted - rows)])
