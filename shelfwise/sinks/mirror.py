"""Copies of tables that move only what differs.

Both sides are reduced to one row per partition: its number of rows and the sum of their hashes, which
does not depend on order or files. Partitions whose figures differ, or that only one side
has, are copied or dropped; afterwards the figures must agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sinks import days
from shelfwise.sources.scratch import settle


def fingerprints(table: DataFrame, by: Sequence[str] = days.DAY_PARTITION) -> DataFrame:
    """Rows and hash sum of every partition. A null is not the same as a missing column, so both go into the hash."""
    values = [x for name in sorted(table.columns) for x in (F.col(name).isNull(), F.col(name))]
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*values).cast("decimal(20,0)")).cast("string").alias("marks"))


def differing(source: DataFrame, target: DataFrame, by: Sequence[str] = days.DAY_PARTITION) -> DataFrame:
    """Partition keys on which the two sides do not agree: one aggregate over both."""
    sides = fingerprints(source, by).withColumn("side", F.lit(1)).unionByName(fingerprints(target, by).withColumn("side", F.lit(-1)))
    judged = sides.groupBy(*by, "n_rows", "marks").agg(F.sum("side").alias("side"))
    return judged.filter("side <> 0").select(*by).distinct()


def mirror(spark: SparkSession, source: str, target: str, root: str, by: Sequence[str] = days.DAY_PARTITION) -> int:
    """Make the daily table `target` (at `root`, created if missing) equal to `source`; returns the number of partitions touched.

    A partition that is gone from the source goes from the copy. A copy that does not agree with the source
    afterwards is an error.
    """
    original = spark.table(source)
    days.create(spark, target, original.schema, root, by)
    changed = settle(differing(original, spark.table(target), by), "changed-partitions")
    specs = days.specs_of(changed, by)
    if specs:
        days.replace(days.within(original, by, specs), target, changed, by)
        left = differing(original, spark.table(target), by)
        if not left.isEmpty():
            raise RuntimeError(f"{target} does not agree with {source} after copying")
    return len(specs)


def mirror_tables(spark: SparkSession, tables: dict[str, tuple[str, str]], by: Sequence[str] = days.DAY_PARTITION) -> dict[str, int]:
    """Mirror several tables: source to (target, root). Each has its own schema, taken from the source."""
    return {source: mirror(spark, source, target, root, by) for source, (target, root) in tables.items()}
