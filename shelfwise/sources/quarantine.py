"""File loads that account for every row.

One pass types the rows, gives the bad ones their reason codes and writes both; what was read, accepted
and rejected is observed while writing. The rejected rows go, as text, into a quarantine table
with one partition for each load. A load that does not add up, has nothing in it or too many bad rows is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.sinks import days
from shelfwise.sources import files, layouts
from shelfwise.sources.scratch import settle

SCHEMA = "reasons array<string>, cells string, file string, load string, day date"
BY = ("load", "day")


@dataclass(frozen=True)
class Load:
    """Accepted rows in their types, rejected rows as text with their reasons and file, and the numbers of both and of all."""

    accepted: DataFrame
    rejected: DataFrame
    n_read: int
    n_accepted: int
    n_rejected: int
    by_reason: dict[str, int]


def sorted_out(raw: DataFrame, layout: dict[int, tuple[str, str]], name: str) -> Load:
    """Read `raw` once and part its rows. The row counts come from the same pass as the written rows."""
    seen = Observation()
    names = layouts.columns(layout)
    codes = layouts.reasons(layout)
    kinds = [kind for _, kind in layout.values()]
    possible = [f"{what}:{n}" for n, kind in layout.values() if kind != "string" for what in (("type", "rounded") if kind.startswith("decimal") else ("type",))]
    marked = raw.select(*names, F.col("_metadata.file_path").alias("_file")).withColumn("_reasons", codes)
    good = F.size("_reasons") == 0
    counts = [F.count_if(F.array_contains("_reasons", code)).alias(f"r{k}") for k, code in enumerate(possible)]
    observed = marked.observe(seen, F.count(F.lit(1)).alias("n_read"), F.count_if(good).alias("n_accepted"), F.count_if(~good).alias("n_rejected"), *counts)
    written = settle(observed, name)
    found = seen.get
    if found["n_accepted"] + found["n_rejected"] != found["n_read"]:
        raise RuntimeError(f"{name}: accepted and rejected rows are not all rows")
    accepted = written.filter(good).select(*[F.col(n).try_cast(kind).alias(n) for n, kind in zip(names, kinds, strict=True)])
    rejected = written.filter(~good).select(F.col("_reasons").alias("reasons"), F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("cells"), F.col("_file").alias("file"))
    return Load(accepted, rejected, found["n_read"], found["n_accepted"], found["n_rejected"], {code: found[f"r{k}"] for k, code in enumerate(possible) if found[f"r{k}"]})


def goods_rejects(raw: DataFrame) -> DataFrame:
    """Rejected rows of a goods file, which is judged by item, in the form of the quarantine."""
    return files.rejected_goods(raw).select("reasons", F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"}).alias("cells"), F.lit(None).cast("string").alias("file"))


def store(spark: SparkSession, rejected: DataFrame, table: str, root: str, name: str, day: str) -> None:
    """Make the rejected rows of this load the partition (`name`, `day`) of the quarantine table; a rerun
    replaces them and a load without any drops them."""
    days.create(spark, table, SCHEMA, root, BY)
    stamped = rejected.select("*", F.lit(name).alias("load"), F.lit(day).cast("date").alias("day"))
    asked = spark.createDataFrame([(name, day)], "load string, day string")
    days.replace(stamped, table, asked, BY)


def require(load: Load, name: str, most_rejected: float = 1.0) -> Load:
    """The load, if it has accepted rows and not more than the share `most_rejected` of bad ones."""
    if not load.n_accepted:
        raise ValueError(f"{name}: none of {load.n_read} rows is usable")
    if load.n_rejected > most_rejected * load.n_read:
        raise ValueError(f"{name}: {load.n_rejected} of {load.n_read} rows are bad: {load.by_reason}")
    return load
