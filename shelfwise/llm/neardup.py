"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is a set of five-word shingles weighted by tf-idf, (1 + ln tf) * idf with
idf = 1 + IDF_SHARE * ln((N + 1) / (df + 1)) / ln(N + 1). df is counted over all documents, in a table
of fixed size indexed by a part of the shingle's hash. The idf is damped because copies make their
own shingles common: with the full logarithm, near copies in a group of thousands would weigh
little but for their few own words, and would miss the threshold that two copies alone reach.

24 weighted samples per document are put into eight bands of three; documents of weighted Jaccard
similarity s agree in all samples of some band with probability 1 - (1 - s^3)^8, which is 0.997 at
0.8. Candidates are verified on the whole texts by weighted Jaccard similarity.

Equal texts (after lower-casing and splitting into words) are folded first. In a bucket no pair
list is made: every member is compared with one pivot, verified links are contracted to
components, and only documents whose buckets still hold several components are worked on further.
Those are put into buckets by prefix: in the order of rarity among them, two documents of
similarity t share a shingle before which each has at most the share 1 - t of its weight. That is
exact, and it parts documents that merely share a passage, and near copies whose own words make up
too much of their weight. Each of these buckets has pivots too, and what is in different
components after that is compared pair by pair, unless the weights from the shared shingle on rule
the similarity out. So a group of n near copies costs some n comparisons.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.components import components
from shelfwise.llm.shared import bounded_broadcast, mixed, settle_counted, shingle_counts, slices, texts_of
from shelfwise.sources.scratch import settle

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 8, 3
SAMPLES = BANDS * ROWS

DF_BITS, DF_CHUNK = 20, 1024
IDF_SHARE = 0.25
TABLE_BITS = 16
BAND_PIVOTS, PREFIX_PIVOTS = 1, 1

BROADCAST_ROWS = 2_000_000
"""Id lists up to this many rows (16 bytes each) are broadcast; beyond it they are shuffled."""


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DF_BITS)).astype(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The idf of each of the 2**20 entries, from all documents.

    Tasks count in a table of fixed size and emit it in chunks; the chunks are added where they
    meet by hash. Only the finished table, 8 MB at any input size, comes to the driver.
    """
    size = 1 << DF_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, documents = np.zeros(size, dtype=np.int64), 0
        for part in slices(batches, "text"):
            owner, hashes, _ = shingle_counts(texts_of(part), WIDTH)
            counts += np.bincount(_bucket(hashes), minlength=size)
            documents += len(np.unique(owner))
        rows = [(k, counts[k * DF_CHUNK : (k + 1) * DF_CHUNK].astype("<i8").tobytes()) for k in range(size // DF_CHUNK)]
        rows = [row for row in rows if any(row[1])] + [(-1, np.array([documents], dtype="<i8").tobytes())]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.binary())], names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(v, dtype="<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    frequencies, documents = np.zeros(size, dtype=np.int64), 0
    for row in docs.select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema).toLocalIterator():
        values = np.frombuffer(row.counts, dtype="<i8")
        if row.chunk < 0:
            documents += int(values[0])
        else:
            frequencies[row.chunk * DF_CHUNK : (row.chunk + 1) * DF_CHUNK] += values
    rarity = np.log((documents + 1) / (frequencies + 1)).clip(min=0) / max(np.log(documents + 1), 1e-9)
    return (1 + IDF_SHARE * rarity).astype(np.float32)


def weighted(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle hash, count and weight of the shingles of each text."""
    owner, hashes, counts = shingle_counts(texts, WIDTH)
    weights = (1 + np.log(counts)).astype(np.float32) * idf[_bucket(hashes)]
    return owner, hashes, counts, weights


@functools.lru_cache(maxsize=1)
def _draws() -> list[tuple[np.ndarray, ...]]:
    """For each sample: gamma(2, 1) draws r, 1 / r, ln of gamma(2, 1) draws c, uniform draws beta,
    indexed by 16 bits of a hash of the shingle."""
    rng = np.random.Generator(np.random.PCG64(20240229))
    n = 1 << TABLE_BITS
    out = []
    for _ in range(SAMPLES):
        r, c, beta = rng.gamma(2.0, size=n), rng.gamma(2.0, size=n), rng.random(n)
        out.append((r.astype(np.float32), (1 / r).astype(np.float32), np.log(c).astype(np.float32), beta.astype(np.float32)))
    return out


def samples(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Weighted samples of the documents that begin at `starts`: document x sample, 32 bits each.

    A sample is the shingle and step t that minimise ln a = ln c - r (t - beta + 1) with
    t = floor(ln w / r + beta). The order-preserving bits of ln a and a mark of (shingle, t) share
    a word, so one minimum gives both.
    """
    log_weights = np.log(weights)
    marks = mixed(hashes ^ np.uint64(0xA0761D6478BD642F)).astype(np.uint32)
    out = np.empty((len(starts), SAMPLES), dtype=np.uint32)
    for k, (r, inverse, log_c, beta) in enumerate(_draws()):
        at = ((hashes * np.uint64(2 * (0x9E3779B97F4A7C15 * (k + 1) % (1 << 63)) + 1)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        b = beta[at]
        t = np.floor(log_weights * inverse[at] + b)
        bits = (log_c[at] - r[at] * (t - b + np.float32(1))).view(np.uint32)
        ordered = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(0x80000000))
        mark = marks ^ (t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
        packed = (ordered.astype(np.uint64) << np.uint64(32)) | mark
        out[:, k] = np.minimum.reduceat(packed, starts).astype(np.uint32)
    return out


def _band_keys(drawn: np.ndarray) -> np.ndarray:
    keys = np.empty((len(drawn), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(drawn), band + 1, dtype=np.uint64)
        for row in range(ROWS):
            key = mixed(key * np.uint64(0x9FB21C651E98DF25) + drawn[:, band * ROWS + row])
        keys[:, band] = key
    return keys


def prefix_buckets(docs: DataFrame, ids: tuple[DataFrame, int], repeated: tuple[DataFrame, int], idf: Broadcast) -> DataFrame:
    """(rep, band, rest, total): each of the documents `ids` with the shingles of its prefix that others have too,
    the weight from there on and the whole weight. `repeated` has the ids that several rows have: of those,
    equal rows are taken once, and each different text has a prefix of its own.

    A document's shingles are ordered by the number of these documents that have them; its prefix
    ends where the weight before a shingle exceeds the share 1 - threshold of the whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            owner, hashes, _, weights = weighted(texts_of(part), idf.value)
            ids = part.column("rep").to_numpy()[owner]
            total = np.bincount(owner, weights, minlength=part.num_rows)[owner]
            texts = part.column("text_hash").to_numpy()[owner]
            columns = [ids, texts, hashes.view(np.int64), weights.astype(np.float64), total]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["rep", "text_hash", "band", "weight", "total"])

    texts = _texts(docs, ids)
    if repeated[1]:
        several = bounded_broadcast(*repeated, BROADCAST_ROWS)
        once = texts.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        texts = texts.join(several, "doc_id", "left_anti").union(once)
    rows = texts.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("text_hash"), "text")
    held = settle(rows.mapInArrow(run, "rep long, text_hash long, band long, weight double, total double"), "shingles")
    common = held.groupBy("band").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    shared = held.join(common, "band")
    rarest = Window.partitionBy("rep", "text_hash").orderBy("holders", "band")
    own = F.col("total") - F.sum("weight").over(Window.partitionBy("rep", "text_hash"))  # of shingles that nobody else has
    before = own + F.sum("weight").over(rarest.rowsBetween(Window.unboundedPreceding, -1))
    placed = shared.withColumn("before", F.coalesce(before, own)).where(F.col("before") <= F.col("total") * (1 - THRESHOLD + 1e-6))
    rows = placed.select("rep", "band", (F.col("total") - F.col("before")).alias("rest"), "total")
    return rows.join(_crowded(rows), "band")


def _crowded(rows: DataFrame) -> DataFrame:
    """The buckets with more than one row."""
    return rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")


def sketches(docs: DataFrame, idf: Broadcast) -> DataFrame:
    """doc_id, a 128-bit mark of the weighted set, and band keys; none for rows without words or id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            owner, hashes, counts, weights = weighted(texts_of(part), idf.value)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, np.int64)
            if not len(starts):
                continue
            number = counts.astype(np.uint64)
            low = np.add.reduceat(mixed(hashes + number * np.uint64(0xE7037ED1A0B428DB)), starts)
            high = np.add.reduceat(mixed(hashes * np.uint64(0x8EBC6AF09C88C6E3) ^ number), starts)
            keys = _band_keys(samples(hashes, weights, starts)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(owner[starts])),
                    pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)),
                    pa.array(list(keys), pa.list_(pa.int64())),
                ],
                names=["doc_id", "low", "high", "bands"],
            )

    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, low long, high long, bands array<long>")


def similarity(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (ascending hashes, weights)."""
    _, i, k = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(one[1][i], other[1][k]).sum(dtype=np.float64))
    union = float(one[1].sum(dtype=np.float64)) + float(other[1].sum(dtype=np.float64)) - shared
    return shared / union if union else 0.0


def _texts(docs: DataFrame, ids: tuple[DataFrame, int]) -> DataFrame:
    """doc_id and text of the documents `ids`, a table with its number of rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return rows.join(bounded_broadcast(*ids, BROADCAST_ROWS), "doc_id", "left_semi")


def _verified(pairs: DataFrame, docs: DataFrame, idf: Broadcast) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""
    texts = _texts(docs, settle_counted(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "candidate-ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text_b"):
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            texts = {}
            for side, ids in (("text_a", a), ("text_b", b)):
                texts |= zip(ids, part.column(side), strict=True)
            order = {doc: k for k, doc in enumerate(texts)}
            owner, hashes, _, weights = weighted([t.as_py() for t in texts.values()], idf.value)
            cuts = np.searchsorted(owner, np.arange(len(order) + 1))
            sets = [(hashes[i:j], weights[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            keep = [similarity(sets[order[x]], sets[order[y]]) >= THRESHOLD for x, y in zip(a, b, strict=True)]
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def _labelled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` with the component of `rep`, itself if it has no link."""
    return rows.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _open_buckets(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Bucket rows with their components, of the buckets that hold more than one component."""
    rows = _labelled(buckets, found)
    mixed_up = rows.groupBy("band").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low < _high").select("band")
    return rows.join(mixed_up, "band")


def _pivot_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Every member of a bucket against one of its members, drawn for each bucket and turn, if that is in another component."""
    pivot = rows.groupBy("band").agg(F.min_by(F.struct("rep", "component"), F.struct(F.xxhash64("rep", "band", F.lit(turn)), "rep")).alias("pivot"))
    found = rows.join(pivot, "band").where(F.col("component") != F.col("pivot.component"))
    return found.select(F.least("rep", "pivot.rep").alias("a"), F.greatest("rep", "pivot.rep").alias("b")).distinct()


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """Members of different components of a prefix bucket that can be similar.

    If the bucket's shingle is the first that two documents share, what they share weighs at most
    `rest` of either, and at similarity t it weighs t / (1 + t) of both wholes together.
    """
    sides = [rows.select("band", *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "component", "rest", "total")]) for side in "ab"]
    enough = (F.col("total_a") + F.col("total_b")) * (THRESHOLD / (1 + THRESHOLD) - 1e-6)
    pairs = sides[0].join(sides[1], "band").where((F.col("component_a") < F.col("component_b")) & (F.least("rest_a", "rest_b") >= enough))
    return pairs.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id, the smallest id among the documents it is connected with, one row per row of `docs`.

    Null and empty texts, and texts of white space only, resemble nothing: each is its own
    class. Shorter texts than five words have one shingle of all their words. A null doc_id gets
    a null class. Rows that repeat an id count as one document; if their texts differ, what
    resembles either is in its class. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs))
    marks = settle(sketches(docs, idf), "sketches")
    folded = marks.groupBy("low", "high").agg(F.min_by(F.struct("doc_id", "bands"), "doc_id").alias("first"))
    reps = settle(folded.select("low", "high", F.col("first.doc_id").alias("rep"), "first.bands"), "texts")
    members = settle(marks.select("doc_id", "low", "high").join(reps.select("low", "high", "rep"), ["low", "high"]).select("doc_id", "rep").distinct(), "members")

    repeated = settle_counted(marks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    one_id = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    links, n_links = settle_counted(one_id.select("a", "b"), "links")
    found = settle(components(links), "components") if n_links else links.toDF("node", "component")
    rows = reps.select("rep", F.explode("bands").alias("band"))
    buckets = settle(rows.join(_crowded(rows), "band").distinct(), "buckets")
    for turn in range(BAND_PIVOTS + PREFIX_PIVOTS + 1):
        if turn == BAND_PIVOTS:
            apart = settle_counted(_open_buckets(buckets, found).select(F.col("rep").alias("doc_id")).distinct(), "apart")
            buckets = settle(prefix_buckets(docs, apart, repeated, idf), "prefix-buckets")
        rows = settle(_open_buckets(buckets, found), "open-buckets")
        pairs = _pivot_pairs(rows, turn) if turn < BAND_PIVOTS + PREFIX_PIVOTS else _cross_pairs(rows)
        links = links.union(settle(_verified(settle(pairs, "pairs"), docs, idf), "links"))
        found = settle(components(links), "components")
    named = _labelled(members, found).groupBy("doc_id").agg(F.min("component").alias("class_id"))
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return every.join(named, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
