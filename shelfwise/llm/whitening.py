"""Whitening of embeddings by a bidiagonal qd solver.

The integer vectors are centred exactly and reduced block by block to triangular factors (QR of the
rows stacked under the factor so far); the factors of all tasks are merged in groups. The last one has
the singular values and right singular vectors of the whole centred table: `bidiagonal.leading` finds
them by Householder reflections, dqds and twisted factorisations. The covariance is never formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.bidiagonal import leading
from shelfwise.llm.shared import output
from shelfwise.llm.vectors import finite, integers, merged_states, one_state

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
QR_ROWS = 4096

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Whitener:
    """`sums` are exact. Column k of `directions` is component k, `variances` are its eigenvalues."""

    rows: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """rows * x - sums, exact: as longs where these hold it, else as Python's integers."""
        largest = int(np.abs(x).max(initial=0)) * self.rows + max(map(abs, self.sums), default=0)
        kind = np.int64 if largest < 1 << 62 else object
        return x.astype(kind) * self.rows - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.variances)


def squares(deviations: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None where it exceeds a long."""
    largest = int(np.abs(deviations).max(initial=0))
    exact = deviations if largest * largest * deviations.shape[1] < 1 << 63 else deviations.astype(object)
    found = (exact * exact).sum(axis=1).tolist()
    return [x if x < 1 << 63 else None for x in found]


def stacked(factors: list[np.ndarray]) -> np.ndarray:
    """Triangular factor of all rows below each other, square also when there are few rows."""
    rows = np.concatenate(factors)
    missing = max(0, rows.shape[1] - len(rows))
    return np.linalg.qr(np.concatenate([rows, np.zeros((missing, rows.shape[1]))]), mode="r")


def exact_sums(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of rows and the sum of every dimension of their integer form, in two halves that can't overflow."""
    ints = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("long"))
    each = rows.select(F.posexplode(ints).alias("place", "x"))
    halves = each.groupBy("place").agg(F.sum(F.shiftright("x", 32)).alias("high"), F.sum(F.col("x").bitwiseAND(0xFFFFFFFF)).alias("low"), F.count(F.lit(1)).alias("rows"))
    found = halves.orderBy("place").collect()
    return found[0].rows, tuple((row.high << 32) + row.low for row in found)


def _factor(rows: DataFrame, mean: Whitener, length: int) -> np.ndarray:
    def unpack(state: bytes) -> np.ndarray:
        return np.frombuffer(state).reshape(length, length)

    def fold(state: bytes | None, batch: pa.RecordBatch) -> bytes:
        for start in range(0, batch.num_rows, QR_ROWS):
            block = mean.centred(integers(batch.slice(start, QR_ROWS), length, SCALE, OFFSET))
            state = stacked([block] if state is None else [unpack(state), block]).tobytes()
        return state

    def merge(states: list[bytes]) -> bytes:
        return stacked([unpack(s) for s in states]).tobytes()

    return unpack(merged_states(rows.mapInArrow(one_state(fold), "block long, state binary"), merge, "factors"))


def fit(rows: DataFrame, length: int, components: int = COMPONENTS) -> Whitener:
    """Learn from all rows of `finite`, which must not be empty. Components without variance are left out."""
    n, sums = exact_sums(rows)
    centre = Whitener(n, sums, np.empty((length, 0)), np.empty(0), 0.0)
    values, directions, total = leading(_factor(rows, centre, length), components)
    return Whitener(n, sums, directions, values / n, total / n)


def _joined(states: list[tuple[float, np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    """Count, mean and centred products of the union of several sets of rows."""
    n, mean, products = states[0]
    for m, other, more in states[1:]:
        gap = other - mean
        products = products + more + np.outer(gap, gap) * (n * m / (n + m))
        mean = mean + gap * (m / (n + m))
        n += m
    return n, mean, products


def identity_error(rows: DataFrame, model: Whitener, length: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on all rows."""
    k = len(model.variances)

    def unpack(state: bytes) -> tuple[float, np.ndarray, np.ndarray]:
        flat = np.frombuffer(state)
        return float(flat[0]), flat[1 : k + 1], flat[k + 1 :].reshape(k, k)

    def pack(n: float, mean: np.ndarray, products: np.ndarray) -> bytes:
        return np.concatenate([[n], mean, products.ravel()]).tobytes()

    def fold(state: bytes | None, batch: pa.RecordBatch) -> bytes:
        white = model.whitened(integers(batch, length, SCALE, OFFSET))
        mean = white.mean(axis=0)
        own = (float(len(white)), mean, (white - mean).T @ (white - mean))
        return pack(*_joined([own] if state is None else [unpack(state), own]))

    def merge(states: list[bytes]) -> bytes:
        return pack(*_joined([unpack(s) for s in states]))

    n, _, products = unpack(merged_states(rows.mapInArrow(one_state(fold), "block long, state binary"), merge, "products"))
    return float(np.abs(products / n - np.eye(k)).max())


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: its whitened coordinate and the figures of the whole table.

    Null vectors and vectors with null, non-finite or (beyond 2**28) too large components take no part, nor do
    vectors of another length than the commonest one. Repeated rows count and are returned each, null
    ids included; other columns are ignored. A component whose variance is zero (few or equal rows) can't be
    whitened and has no rows; an empty table, or one without any variance, gives an empty result.
    `deviation` is null where the exact number exceeds a long, which unit vectors reach beyond some three million rows.
    """
    rows, length = finite(vectors)
    if not length:
        return _nothing(vectors.sparkSession)
    model = fit(rows, length, components)
    if not len(model.variances):
        return _nothing(vectors.sparkSession)
    error = identity_error(rows, model, length)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.variances)
        for batch in batches:
            x = integers(batch, length, SCALE, OFFSET)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            deviation = pa.array(squares(model.deviations(x)), pa.int64()).take(pa.array(each))
            columns = [
                batch.column("vec_id").take(pa.array(each)),
                np.tile(np.arange(1, k + 1), m),
                np.full(m * k, model.rows),
                deviation,
                model.whitened(x).ravel(),
                np.tile(model.variances / model.trace, m),
                np.full(m * k, error),
            ]
            yield output(SCHEMA.names, columns, SCHEMA)

    return rows.mapInArrow(run, SCHEMA)
