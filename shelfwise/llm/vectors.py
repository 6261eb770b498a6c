"""Vectors in integer form, and states of many tasks merged in groups of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.shared import settle_counted

LARGEST = float(1 << 28)
"""Beyond this a component has no exact integer form whose sums fit in a long."""
FAN = 16
"""States that are merged at once, in one task or on the driver."""


def finite(vectors: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """vec_id, embedding and `columns` of the rows whose vector has no null and only finite components,
    and the length of these vectors.

    Vectors of another length than the commonest one (of equally common ones the smallest), empty
    ones and those with a component beyond `LARGEST` take no part. The length is 0 if nothing is left.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", *columns).where(F.col("embedding").isNotNull())
    rows = rows.where(F.forall("embedding", lambda x: F.coalesce(F.abs(x) <= LARGEST, F.lit(False))) & (F.size("embedding") > 0))
    common = rows.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    length = common.n if common else 0
    return rows.where(F.size("embedding") == length), length


def integers(batch: pa.RecordBatch, length: int, scale: int, offset: int = 0) -> np.ndarray:
    """floor(scale * component) + offset of every vector of a batch; exact, as `scale` is a power of two."""
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat.reshape(-1, length) * scale).astype(np.int64) + offset


def merged_states(states: DataFrame, merge: Callable[[list[bytes]], bytes], name: str) -> bytes | None:
    """One state out of the (block, state) rows of all tasks; None if there is no row.

    Neighbouring blocks are merged `FAN` at a time in Spark until the driver can merge the rest, so
    no task and not the driver ever holds more than `FAN` states. Every level is a written table.
    """

    def step(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("block")
        return pd.DataFrame({"block": [int(ordered["block"].iloc[0]) // FAN], "state": [merge(list(ordered["state"]))]})

    rows, n = settle_counted(states, name)
    while n > FAN:
        rows, n = settle_counted(rows.groupBy(F.floor(F.col("block") / FAN)).applyInPandas(step, "block long, state binary"), name)
    found = [bytes(row.state) for row in rows.orderBy("block").collect()]
    return merge(found) if found else None


def one_state(fold: Callable[[bytes | None, pa.RecordBatch], bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that folds the batches of a task to one (block, state) row; no row for an empty task.
    The block is the number of the task's partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = None
        for batch in batches:
            if batch.num_rows:
                state = fold(state, batch)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([state], pa.binary())], names=["block", "state"])

    return run
