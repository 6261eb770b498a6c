"""Vector code compression with codebooks of integers, assigned over a lexicographic trie.

Vectors become integers and are cut into equal consecutive parts. The distinct parts of all rows,
with their numbers, are written once in lexicographic order, spread over the tasks by ranges. A task
reads its range as a trie: neighbours share the nodes of their common leading dimensions. It walks
the trie depth first, a bundle of neighbouring subtrees at a time; a node holds the distances of its
prefix to all codebook entries, that is those of its parent plus one squared difference, so a
common prefix is accumulated once for all parts below it. A leaf has the whole distances: its nearest
entry is their first minimum, and its part counts with its weight in the sums of that entry.
Only these sums, of the size of the codebooks, leave the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shared import output
from shelfwise.llm.vectors import finite, integers
from shelfwise.sources.scratch import settle

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
BUNDLE = 4096
"""Leaves that are walked at once; the walk keeps the path to the last one."""
PARTS_SCHEMA = "part int, place array<long>"
SUMS_SCHEMA = "part int, entry int, members long, position int, high long, low long"

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("error", T.DecimalType(38, 0)),
    ]
)


@dataclass(frozen=True)
class Codebooks:
    """`entries[p]` has one row of integers for each entry of part position p; `starts` has where each part begins."""

    starts: tuple[int, ...]
    entries: tuple[np.ndarray, ...]

    def text(self) -> str:
        return ",".join(str(x) for book in self.entries for x in book.ravel().tolist())


def starts_of(length: int, parts: int) -> tuple[int, ...]:
    """Where the parts begin, and the end; parts differ by one at most if the length can't be divided evenly."""
    wide, longer = divmod(length, parts)
    return tuple(np.cumsum([0, *[wide + (k < longer) for k in range(parts)]]).tolist())


def walk(places: np.ndarray, book: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Depth-first walk of the trie of `places`, rows in lexicographic order: (leaves, nearest entry, distance).

    At each depth a bundle has one node for each distinct prefix; the first one goes on from the path
    to the last leaf of the bundle before, where they share a prefix.
    """
    n, depth = places.shape
    largest = int(max(np.abs(places).max(initial=0), np.abs(book).max(initial=0)))
    kind = np.int64 if 4 * largest * largest * max(depth, 1) < 1 << 63 else object
    book = book.astype(kind)
    path: list[np.ndarray] = []
    before: np.ndarray | None = None
    for start in range(0, n, BUNDLE):
        leaves = places[start : start + BUNDLE]
        # the depth from which a leaf has nodes of its own: the first dimension that differs from its neighbour
        shared = np.zeros((len(leaves), depth), dtype=bool)
        shared[1:] = np.logical_and.accumulate(leaves[1:] == leaves[:-1], axis=1)
        if before is not None:
            shared[0] = np.logical_and.accumulate(leaves[0] == before)
        above = np.zeros((1, len(book)), dtype=kind)
        above_of = np.zeros(len(leaves), dtype=np.int64)
        ends = []
        for d in range(depth):
            fresh = np.flatnonzero(~shared[:, d])
            own = (leaves[fresh, d].astype(kind)[:, None] - book[None, :, d]) ** 2 + above[above_of[fresh]]
            carried = bool(shared[0, d])
            nodes = np.concatenate([path[d], own]) if carried else own
            above_of = np.cumsum(~shared[:, d]) - (0 if carried else 1)
            above = nodes
            ends.append(nodes[-1:])
        path, before = ends, leaves[-1]
        whole = above[above_of]
        nearest = whole.argmin(axis=1)
        yield slice(start, start + len(leaves)), nearest, whole[np.arange(len(leaves)), nearest]


def _part_rows(rows: DataFrame, length: int, starts: tuple[int, ...]) -> DataFrame:
    """(part, place, members): the distinct parts in integers with their numbers, in order, written."""
    ints = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE))
    cuts = F.array(*[F.struct(F.lit(p).alias("part"), F.slice("x", i + 1, j - i).alias("place")) for p, (i, j) in enumerate(zip(starts[:-1], starts[1:], strict=True))])
    each = rows.select(ints.alias("x")).select(F.inline(cuts))
    counted = each.groupBy("part", "place").agg(F.count(F.lit(1)).alias("members"))
    return settle(counted.repartitionByRange("part", "place").sortWithinPartitions("part", "place"), "distinct-parts")


def _sums(distinct: DataFrame, books: Codebooks) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Members and componentwise sums of every used entry, by part and entry."""
    shared = distinct.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        totals: dict[tuple[int, int], list] = {}
        for batch in batches:
            part = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                p = int(part[i])
                places = batch.column("place").slice(i, j - i).flatten().to_numpy().reshape(j - i, -1)
                members = batch.column("members").slice(i, j - i).to_numpy()
                for leaves, nearest, _ in walk(places, books.entries[p]):
                    weights = members[leaves]
                    wide = int(np.abs(places[leaves]).max(initial=0)) * int(weights.sum()) >= 1 << 62
                    weighted = (places[leaves].astype(object) if wide else places[leaves]) * weights[:, None]
                    for entry in np.unique(nearest).tolist():
                        chosen = nearest == entry
                        total = totals.setdefault((p, entry), [0, [0] * places.shape[1]])
                        total[0] += int(weights[chosen].sum())
                        total[1] = [a + int(b) for a, b in zip(total[1], weighted[chosen].sum(axis=0).tolist(), strict=True)]
        rows = [(p, e, n if k == 0 else 0, k, x >> 32, x & 0xFFFFFFFF) for (p, e), (n, sums) in totals.items() for k, x in enumerate(sums)]
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            names = ["part", "entry", "members", "position", "high", "low"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    found = distinct.mapInArrow(run, SUMS_SCHEMA).groupBy("part", "entry", "position").agg(F.sum("members").alias("members"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    sums: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for row in found.orderBy("part", "entry", "position").collect():
        members, places = sums.get((row.part, row.entry), (0, []))
        sums[row.part, row.entry] = (members + row.members, [*places, (row.high << 32) + row.low])
    return sums


def train(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after `rounds` rounds over all rows of `finite`, which must not be empty.

    They start as the parts of the first `entries` rows by vec_id, null ids last, equal ids by vector; fewer rows
    give fewer entries.
    """
    starts = starts_of(length, parts)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).collect()
    x = np.floor(np.array([row.embedding for row in first], dtype=np.float64) * SCALE).astype(np.int64)
    books = Codebooks(starts, tuple(x[:, i:j] for i, j in zip(starts[:-1], starts[1:], strict=True)))
    distinct = _part_rows(rows, length, starts)
    for _ in range(rounds):
        made = [book.copy() for book in books.entries]
        for (p, entry), (members, sums) in _sums(distinct, books).items():
            made[p][entry] = [s // members for s in sums]
        books = Codebooks(starts, tuple(made))
    return books


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and distance of every row, by the walk over the trie of the distinct rows."""
    if not x.shape[1]:
        return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    places, back = np.unique(x, axis=0, return_inverse=True)
    found = [(n, d) for _, n, d in walk(places, book)]
    return np.concatenate([n for n, _ in found])[back.ravel()], np.concatenate([d for _, d in found])[back.ravel()]


def encode(rows: DataFrame, length: int, books: Codebooks) -> DataFrame:
    """vec_id, label (as text), code and error of every row of `finite`, whose labels are a column of any type."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            x = integers(batch, length, SCALE)
            codes, errors = [], np.zeros(len(x), dtype=object)
            for p, book in enumerate(books.entries):
                chosen, far = nearest(x[:, books.starts[p] : books.starts[p + 1]], book)
                codes.append(chosen)
                errors = errors + far
            texts = ["".join(f"{c:02x}" for c in row) for row in np.array(codes).T.tolist()]
            yield output(SCHEMA.names, [batch.column("vec_id"), batch.column("label"), texts, errors.tolist()], SCHEMA)

    return rows.select("vec_id", "embedding", F.col("label").cast("string").alias("label")).mapInArrow(run, SCHEMA)


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that takes part.

    Null vectors and vectors with null, non-finite or (beyond 2**28) too large components take no part, nor do
    vectors of another length than the commonest one. Repeated rows count and are returned each, null ids
    included, which come last where the codebooks start; null labels are equal to each other. Ties go to the
    lower entry. A length that 8 does not divide gives parts that differ by one. Other columns are ignored; an
    empty table gives an empty result. An error that exceeds a long is null.
    """
    rows, length = finite(vectors, "label")
    if not length:
        return _nothing(vectors.sparkSession)
    books = train(rows, length)
    coded = settle(encode(rows, length, books), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(settle(by_label, "label-errors"), F.col("label").eqNullSafe(F.col("_label")))
    digest = F.sha2(F.lit(books.text()), 256).alias("codebooks_sha256")
    return joined.select("vec_id", "code", F.expr("try_cast(error AS bigint)").alias("error"), F.expr("try_cast(label_error AS bigint)").alias("label_error"), digest)


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in SQL: assignments and codebooks of all rounds as one chain of named results."""
    far = "list_sum([(a.place[i] - b.place[i]) * (a.place[i] - b.place[i]) FOR i IN range(1, len(a.place) + 1)])"

    def assigned(k: int) -> str:
        return f"near{k} AS MATERIALIZED (SELECT a.rn, a.p, min({{'d': {far}, 'e': b.e}}) AS best FROM parts a JOIN book{k} b ON a.p = b.p GROUP BY a.rn, a.p)"

    def moved(k: int) -> str:
        sums = f"SELECT n.p, n.best.e AS e, t.i, sum(a.place[t.i]) AS total, count(*) AS members FROM near{k - 1} n JOIN parts a ON a.rn = n.rn AND a.p = n.p, LATERAL (SELECT unnest(range(1, len(a.place) + 1)) AS i) t GROUP BY n.p, n.best.e, t.i"
        floor = "CAST(floor(total / members) AS BIGINT)"
        lists = f"SELECT p, e, list({floor} ORDER BY i) AS place FROM ({sums}) GROUP BY p, e"
        return f"book{k} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.place, b.place) AS place FROM book{k - 1} b LEFT JOIN ({lists}) m ON b.p = m.p AND b.e = m.e)"

    steps = [assigned(0)]
    for k in range(1, rounds + 1):
        steps += [moved(k), assigned(k)]
    chain = ",\n".join(steps)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, label,
    [CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), parts AS MATERIALIZED (
  SELECT rn, p, x[p * len(x) // {parts} + 1 : (p + 1) * len(x) // {parts}] AS place FROM kept, range({parts}) t(p)
), book0 AS MATERIALIZED (SELECT p, rn - 1 AS e, place FROM parts WHERE rn <= {entries}),
{chain},
coded AS (
  SELECT rn, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY rn
), digest AS (
  SELECT sha256(string_agg(array_to_string(place, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, d.codebooks_sha256
FROM kept k JOIN coded c ON k.rn = c.rn, digest d"""


ORACLE = oracle()
