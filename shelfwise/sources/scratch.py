"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="shelfwise-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a local folder stands in only where there is no cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


def quoted(text: str) -> str:
    """A text as a literal of Spark SQL."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def delete_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Delete folders through the catalog: as partitions of a managed table they go when it is dropped. Spark's own
    API has no other delete. A folder that is not there is fine."""
    if not folders:
        return
    table = f"shelfwise_deleted_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} (unused int, folder int) USING parquet PARTITIONED BY (folder)")
    spark.sql(f"ALTER TABLE {table} ADD {' '.join(f'PARTITION (folder = {k}) LOCATION {quoted(folder)}' for k, folder in enumerate(folders))}")
    spark.sql(f"ALTER TABLE {table} DROP {', '.join(f'PARTITION (folder = {k})' for k in range(len(folders)))}")
    spark.sql(f"DROP TABLE {table}")


def application_folder(spark: SparkSession) -> str:
    """Everything this application puts into the shared folder is below this one."""
    return f"{shared_folder(spark)}/shelfwise-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder; call it when no frame is needed any more."""
    delete_folders(spark, [application_folder(spark)])


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table and read it back.

    The plan above then knows the true size of the data (a small table is broadcast, a
    large one is not) and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
