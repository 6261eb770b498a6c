"""Nearest neighbours by inner product with multi-index hashing over learned binary codes.

Vectors become codes of 256 bits: signs after rotations that were learned on a bounded sample
(iterative quantisation, several starts). To let codes follow the inner product when norms differ,
a vector gets one more component that makes all norms equal. A code is split into 16 substrings;
each index block has a table for each substring: its rows ordered by the 16 bits, and where each
value begins. By the pigeonhole principle a code within Hamming distance r of a query is within
floor(r / 16) in one substring at least, so looking up all values at that distance in every table
retrieves every code within r. What is retrieved is filtered by the whole
code and ranked by the inner products of the original vectors in double precision. Where there are more values to
look up than rows in the block (wide radii, as among vectors without clusters), the distances of a batch of
queries to all codes are one matrix product instead; it retrieves the same rows.

The radius of a query is its distance to a certain place among the codes of the bounded sample, so
that it follows the density around the query; the codes within it are retrieved from all rows. The
place is measured, since a fixed number of vectors loses neighbours as the table grows: for a
bounded number of queries the exact neighbours are sought among all rows, and the place is the
smallest that holds the share `RECALL` of them, and `wanted` vectors at least. A query that finds fewer than `k`
is searched again with twice the radius, until it has them or the radius holds all codes.

Rows are coded once in tasks and written by block; queries are coded in tasks too. Spark brings every block
and every group of queries together, both of bounded size; a block returns its best `k` for each query, and Spark
merges them. The driver holds the coder and its sample only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.shared import settle_counted, uniform
from shelfwise.sources.scratch import settle

BITS, TABLES = 256, 16
SUBSTRING = BITS // TABLES
SAMPLE = 8192
LEAST_IN_SAMPLE = 8
MEASURED, RECALL = 200, 0.97
"""Queries whose exact neighbours are sought to set the radius, and the share of these it must hold."""
QUERY_GROUP, BLOCK_ROWS = 16_384, 16_384
"""Queries and rows that meet in one task at most."""
LEAST_GROUP = 512
TILE = 64
"""Queries whose distances to a block are one matrix product."""
_ONES = np.array([bin(k).count("1") for k in range(1 << SUBSTRING)], dtype=np.uint8)

SCHEMA = "query_id long, vec_id long, score double, distance long"


@dataclass(frozen=True)
class Coder:
    norm: float
    centre: np.ndarray
    planes: np.ndarray

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as 16 substrings of 16 bits."""
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0))
        bits = (np.column_stack([vectors, rest]) - self.centre) @ self.planes > 0
        return np.packbits(bits, axis=1).view(np.uint16).reshape(len(vectors), TABLES)


def fit(sample: np.ndarray, norm: float, rounds: int = 15, seed: int = 5) -> Coder:
    """Learn the rotations: each alternates between signs and the rotation that fits them best."""
    rng = np.random.default_rng(seed)
    dimension = sample.shape[1]
    rest = np.sqrt(np.maximum(norm**2 - (sample**2).sum(axis=1), 0))
    whole = np.column_stack([sample, rest])
    centre = whole.mean(axis=0)
    _, directions = np.linalg.eigh((whole - centre).T @ (whole - centre))
    main = directions[:, ::-1][:, :dimension]
    projected = (whole - centre) @ main
    planes = []
    for _ in range(math.ceil(BITS / dimension)):
        rotation = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.sign(projected @ rotation).T @ projected)
            rotation = (u @ v).T
        planes.append(main @ rotation)
    return Coder(norm, centre, np.concatenate(planes, axis=1)[:, :BITS])


def distances(code: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hamming distances of one code to many."""
    return _ONES[codes ^ code].sum(axis=1, dtype=np.int64)


def radius(code: np.ndarray, sample_codes: np.ndarray, wanted: int) -> int:
    """The smallest radius with `wanted` sample codes; all bits if there are not so many."""
    if wanted >= len(sample_codes):
        return BITS
    return int(np.partition(distances(code, sample_codes), wanted - 1)[wanted - 1])


def place_holding(share: float, codes: np.ndarray, neighbours: list[np.ndarray], sample_codes: np.ndarray) -> int:
    """The place among the sample codes whose distance holds `share` of all neighbours, given as
    distances from each code; beyond the sample if it must."""
    places = [np.searchsorted(np.sort(distances(c, sample_codes)), far) + 1 for c, far in zip(codes, neighbours, strict=True)]
    places = np.sort(np.concatenate([*places, np.empty(0, np.int64)]))
    return int(places[math.ceil(share * len(places)) - 1]) if len(places) else len(sample_codes)


_MASKS = [np.flatnonzero(_ONES <= reach).astype(np.uint16) for reach in range(SUBSTRING + 1)]


def _signs(codes: np.ndarray) -> np.ndarray:
    """Codes as vectors of 1 and -1: their product is the number of bits minus twice the Hamming distance."""
    return np.unpackbits(codes.view(np.uint8), axis=1).astype(np.float32) * 2 - 1


class Block:
    """Distinct vectors of a part of the rows with the smallest ids of each, and its tables."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, coder: Coder, k: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        self.vectors, owner = np.unique(vectors, axis=0, return_inverse=True)
        owner = owner.ravel()
        by_owner = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[by_owner], np.arange(len(self.vectors) + 1))
        # one more than k, since one of them may be the query itself
        self.ids = [np.unique(ids[by_owner[i:j]])[: k + 1] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        self.codes = coder.codes(self.vectors)
        self.norm = coder.norm
        self._tables: list[tuple[np.ndarray, np.ndarray]] | None = None
        self.probed = 0  # rows that look-ups retrieved, for measurements

    def tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each substring the rows by its value, and where each value begins."""
        if self._tables is None:
            orders = [np.argsort(self.codes[:, t], kind="stable") for t in range(TABLES)]
            values = np.arange((1 << SUBSTRING) + 1)
            self._tables = [(order, np.searchsorted(self.codes[order, t], values)) for t, order in enumerate(orders)]
        return self._tables

    def by_lookup(self, reach: int) -> bool:
        """Whether there are fewer values to look up than rows."""
        return reach < BITS and TABLES * len(_MASKS[reach // TABLES]) < len(self.codes)

    def within(self, code: np.ndarray, reach: int) -> np.ndarray:
        """Rows whose code is within `reach`, ascending."""
        if reach >= BITS:
            return np.arange(len(self.codes))
        if not self.by_lookup(reach):
            return np.flatnonzero(distances(code, self.codes) <= reach)
        parts = []
        for t, (order, starts) in enumerate(self.tables()):
            values = (_MASKS[reach // TABLES] ^ code[t]).astype(np.int64)
            low, size = starts[values], starts[values + 1] - starts[values]
            low, size = low[size > 0], size[size > 0]
            parts.append(order[np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)])
        rows = np.unique(np.concatenate(parts))
        self.probed += len(rows)
        return rows[distances(code, self.codes[rows]) <= reach]

    def _slack(self, vector: np.ndarray) -> float:
        return 1e-9 * self.norm * math.sqrt((vector**2).sum())

    def _ranked(self, query_id: int, vector: np.ndarray, code: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int, float, int]]:
        """(query, id, score, distance of the codes) of the best rows."""
        scores = (self.vectors[rows] * vector).sum(axis=1)
        if len(rows) > k + 1:  # a vector is found through at least one id, but the query's own may be one
            limit = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
            rows, scores = rows[scores >= limit], scores[scores >= limit]
        far = distances(code, self.codes[rows]).tolist()
        found = [(-s, i, d) for r, s, d in zip(rows.tolist(), scores.tolist(), far, strict=True) for i in self.ids[r].tolist() if i != query_id]
        return [(query_id, i, -s, d) for s, i, d in sorted(found)[:k]]

    def search(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, reaches: np.ndarray, k: int) -> list[tuple[int, int, float, int]]:
        """The best `k` rows of this block within the reach of each query."""
        out: list[tuple[int, int, float, int]] = []
        wide = np.array([not self.by_lookup(int(r)) for r in reaches], dtype=bool)
        for q in np.flatnonzero(~wide).tolist():
            out += self._ranked(int(ids[q]), vectors[q], codes[q], self.within(codes[q], int(reaches[q])), k)
        signs = _signs(self.codes) if wide.any() else None
        rest = np.flatnonzero(wide)
        for start in range(0, len(rest), TILE):
            part = rest[start : start + TILE]
            near = (BITS - _signs(codes[part]) @ signs.T) / 2 <= reaches[part][:, None]
            # quick products, with room for their rounding; the few that are left are ranked exactly
            quick = np.where(near, vectors[part] @ self.vectors.T, -np.inf)
            for q, row in zip(part.tolist(), quick, strict=True):
                limit = np.partition(row, len(row) - k - 1)[len(row) - k - 1] if len(row) > k + 1 else -np.inf
                chosen = np.flatnonzero(np.isfinite(row) & (row >= limit - self._slack(vectors[q])))
                out += self._ranked(int(ids[q]), vectors[q], codes[q], chosen, k)
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding as doubles, of the rows that take part: an id, no null, not zero, all finite."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    finite = F.forall("embedding", lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")) & ~F.isnan(x), F.lit(False)))
    return rows.where(finite & F.exists("embedding", lambda x: x != 0))


def _matrix(table: pa.Table | pa.RecordBatch, dimension: int) -> np.ndarray:
    column = table.column("embedding")
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _codes(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("code").to_pylist()), dtype=np.uint16).reshape(-1, TABLES)


def _no_neighbours(vectors: DataFrame) -> DataFrame:
    return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def search(vectors: DataFrame, is_query, k: int = 20, wanted: int = 400) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found of each row that `is_query` (a column of
    vec_id) marks, among all rows but those of its own id; all of them if they are fewer.

    Nearest is the largest inner product; ties go to the smaller id. Null ids and vectors, zero
    vectors and vectors with null or non-finite components take no part, nor do vectors of another
    length than the commonest one. A row that repeats id and vector counts once; of a query id with
    several vectors the smallest vector is searched for. Other columns are ignored; an empty table,
    or one without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))
    common = lengths.orderBy(F.desc("rows"), "n").first()
    if common is None:
        return _no_neighbours(vectors)
    dimension, total = common.n, common.rows
    rows = rows.where(F.size("embedding") == dimension)
    order = F.xxhash64("vec_id")
    rate = min(1.0, 4.0 * SAMPLE / total)
    drawn = rows.where(uniform(order) <= rate).orderBy(order, "vec_id", "embedding").limit(SAMPLE)
    sample = np.unique(np.array([row.embedding for row in drawn.collect()], dtype=np.float64).reshape(-1, dimension), axis=0)
    if not len(sample):  # too few rows for the cut by hash to leave any
        sample = np.array([rows.orderBy("vec_id").first().embedding])
    coder = fit(sample, math.sqrt(common.norm))
    sample_codes = coder.codes(sample)
    in_sample = max(LEAST_IN_SAMPLE, math.ceil(wanted * min(1.0, SAMPLE / total)))
    queries, asked = settle_counted(rows.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    if not asked:
        return _no_neighbours(vectors)
    blocks = settle(_blocked(rows, -(-total // BLOCK_ROWS)), "blocks")
    n_blocks = -(-total // BLOCK_ROWS)
    if in_sample < len(sample_codes):
        some = settle(queries.where(uniform(order) <= min(1.0, 4.0 * MEASURED / asked)).orderBy(order, "vec_id").limit(MEASURED), "measured")
        exact = _ranked(_found(blocks, _coded(some, coder, sample_codes, len(sample_codes)), n_blocks, 1, coder, dimension, k), k)
        far = {row.query_id: row.far for row in exact.groupBy("query_id").agg(F.collect_list("distance").alias("far")).collect()}
        measured = some.collect()
        codes = coder.codes(np.array([row.embedding for row in measured], dtype=np.float64).reshape(-1, dimension))
        in_sample = max(in_sample, place_holding(RECALL, codes, [np.array(far.get(row.vec_id, []), dtype=np.int64) for row in measured], sample_codes))
    open_queries = settle(_coded(queries, coder, sample_codes, in_sample), "coded-queries")
    found = None
    while asked:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        groups = max(-(-asked // QUERY_GROUP), min(-(-asked // LEAST_GROUP), -(-tasks // n_blocks)))
        part = settle(_ranked(_found(blocks, open_queries, n_blocks, groups, coder, dimension, k), k), "found")
        held = part.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("held"))
        short = open_queries.join(held, "vec_id", "left").where((F.coalesce("held", F.lit(0)) < k) & (F.col("reach") < BITS))
        open_queries, asked = settle_counted(short.drop("held").withColumn("reach", F.least(F.lit(BITS), F.col("reach") * 2 + 1)), "open-queries")
        done = part.join(open_queries.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti") if asked else part
        found = done if found is None else found.union(done)
    return found.select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _blocked(rows: DataFrame, n_blocks: int) -> DataFrame:
    """Rows with their block, by a hash of id and vector. Rows that a batch repeats are left out before they are
    dealt, so that no block gets very many equal rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, int] = {}
            for i, key in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("mark").to_pylist(), strict=True)):
                seen.setdefault(key, i)
            yield batch.take(pa.array(list(seen.values()), pa.int64()))

    marked = rows.select("vec_id", "embedding", F.xxhash64("vec_id", "embedding").alias("mark"))
    return marked.mapInArrow(run, marked.schema).select(F.pmod("mark", F.lit(n_blocks)).cast("int").alias("block"), "vec_id", "embedding")


def _coded(queries: DataFrame, coder: Coder, sample_codes: np.ndarray, in_sample: int) -> DataFrame:
    """vec_id, embedding, code and reach of every query, computed in tasks."""
    shared = queries.sparkSession.sparkContext.broadcast((coder, sample_codes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, sample_codes = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = coder.codes(_matrix(batch, len(coder.centre) - 1))
            reaches = [radius(code, sample_codes, in_sample) for code in codes]
            columns = [batch.column("vec_id"), batch.column("embedding"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(reaches, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "embedding", "code", "reach"])

    return queries.select("vec_id", "embedding").mapInArrow(run, "vec_id long, embedding array<double>, code binary, reach int")


def _found(blocks: DataFrame, queries: DataFrame, n_blocks: int, n_groups: int, coder: Coder, dimension: int, k: int) -> DataFrame:
    """The best `k` of every block for every query: each block meets each group of queries in one task."""
    shared = blocks.sparkSession.sparkContext.broadcast(coder)
    group = F.pmod(F.xxhash64("vec_id"), F.lit(n_groups)).cast("int").alias("part")
    every_group = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("part")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        best: list[tuple[int, int, float, int]] = []
        if rows.num_rows and asked.num_rows:
            block = Block(rows.column("vec_id").to_numpy(), _matrix(rows, dimension), shared.value, k)
            best = block.search(asked.column("vec_id").to_numpy(), _matrix(asked, dimension), _codes(asked), asked.column("reach").to_numpy(), k)
        columns = list(zip(*best, strict=True)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "vec_id", "score", "distance"])

    left = blocks.select("block", every_group, "vec_id", "embedding").groupBy("block", "part")
    right = queries.select(every_block, group, "vec_id", "embedding", "code", "reach").groupBy("block", "part")
    return left.cogroup(right).applyInArrow(run, SCHEMA)
