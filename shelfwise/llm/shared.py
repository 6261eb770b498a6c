"""What several operators share: bounded slices of Arrow batches, learning samples, word hashes."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelfwise.sources.scratch import settle

SLICE_BYTES = 1 << 19
"""Text that a vectorised step works on at once; one longer text is a slice of its own."""


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 8 << 20

_shipped: set[str] = set()


def _bytes(setting: str | None) -> float:
    """The number of bytes of a size setting such as 8m or 67108864b; unlimited if it has none."""
    found = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", (setting or "").strip().lower())
    return int(found[1]) * 1024 ** " kmgt".index(found[2] or " ") if found else float("inf")


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once for each application, as `--py-files` would, and keep
    batches to Python small: long texts else make batches that JVM and worker hold several times."""
    if _bytes(spark.conf.get(BATCH_BYTES, None)) > MOST_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, str(MOST_BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(__file__).resolve().parents[2]
        target = Path(tempfile.mkdtemp(prefix="shelfwise-code-")) / "shelfwise.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for file in sorted((root / "shelfwise").rglob("*.py")):
                archive.write(file, file.relative_to(root))
        context.addPyFile(str(target))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`df` written and read again, with its number of rows, observed while writing."""
    seen = Observation()
    written = settle(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return written, seen.get["rows"]


def bounded_broadcast(table: DataFrame, rows: int, most: int) -> DataFrame:
    """`table`, broadcast if its counted rows are at most `most`; beyond it Spark chooses."""
    return F.broadcast(table) if rows <= most else table


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, cut so that a slice holds at most `limit` bytes of `column`."""
    for batch in batches:
        sizes = np.nan_to_num(np.asarray(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), float))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0.0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; null counts as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning. A null id is not held out, but is never learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return doc_id.isNotNull() & ~held_out(doc_id)


def uniform(order: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1."""
    return F.shiftrightunsigned(order, 11) / F.lit(float(1 << 53))


def per_class_sample(rows: DataFrame, by: str, key: str, size: int) -> DataFrame:
    """At most `size` rows of each value of `by`, chosen by the hash of `key`.

    A first cut by hash, at a rate from the class counts, leaves about four times the
    wanted rows, so the ranking never meets an unbounded class.
    """
    order = F.xxhash64(F.col(key))
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_class_rows"))
    rate = F.least(F.lit(1.0), F.lit(4.0 * size) / F.col("_class_rows"))
    cut = rows.join(counts, by).where(uniform(order) <= rate).drop("_class_rows")
    place = F.row_number().over(Window.partitionBy(by).orderBy(order, key))
    return cut.withColumn("_place", place).where(F.col("_place") <= size).drop("_place")


def output(names: list[str], arrays: list, schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, type=kinds.field(n).type) for n, x in zip(names, arrays, strict=True)], names=names)


# --- words and shingles of many texts at once -------------------------------------------------

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95]] = True
_WORD[128:] = True
MULT = 0x9E3779B97F4A7C15
INVERSE = pow(MULT, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    filled, step = 1, base
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(step)
        filled += more
        step = step * step % (1 << 64)
    return out


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the text number of each word.

    Words are lower-cased runs of letters, digits and underscore; every character beyond
    ASCII counts as part of a word. A text without any such run but with other visible
    characters is one word as a whole, so that copies of it can still meet.
    """
    coded = [text.lower().encode() for text in texts]
    data = np.frombuffer(b"\n".join(coded) + b"\n", dtype=np.uint8)
    inside = _WORD[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(MULT, len(data)), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))
    lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) + 1
    owner = np.searchsorted(np.cumsum(lengths), starts, side="right")
    bare = np.flatnonzero(np.bincount(owner, minlength=len(texts)) == 0)
    extra = [(i, whole) for i in bare.tolist() if (whole := b" ".join(coded[i].split()))]
    if extra:
        import xxhash

        hashes = np.concatenate([hashes, np.array([xxhash.xxh64_intdigest(w) for _, w in extra], dtype=np.uint64)])
        owner = np.concatenate([owner, np.array([i for i, _ in extra], dtype=owner.dtype)])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    return hashes, owner


def shingle_counts(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number (ascending), hash (ascending within), count.

    A text of fewer than `width` words has one shingle of all its words; without words none.
    """
    words, owner = word_hashes(texts)
    n = len(words)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    position = np.arange(n) - np.searchsorted(owner, owner, side="left")
    size = np.bincount(owner, minlength=len(texts))[owner]
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        shifted = np.zeros(n, dtype=np.uint64)
        shifted[: n - k] = words[k:]
        shifted[position + k >= size] = 0
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + shifted
    keep = position <= np.maximum(size - width, 0)
    hashes, owner = mixed(rolled[keep]), owner[keep]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
    return owner[first], hashes[first], np.diff(np.r_[first, len(hashes)])
