"""Document fingerprints by invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: at line breaks, and within a line after places chosen by the bytes
before them (a hash of the last `WINDOW` bytes), so that an edit moves no cut but those beside it. A
paragraph is a 64-bit digest, numbered where it repeats. Each digest goes into three cells of a
sketch, one in each third; a cell holds the number of its digests, their exclusive or, and that of
their check values. Two sketches of one size are subtracted cell by cell: what both texts share
cancels out. Peeling recovers the rest: a cell with one digest left (its check fits) names it, and
taking it out of its other cells leaves more such cells. If cells remain, the two texts are sketched
again, larger and with other cells, until all is recovered; the fingerprint is the smallest sketch.

Likeness is that of the two multisets of digests, the common part over the union: with n and m
digests and d recovered ones it is (n + m - d) / (n + m + d).

The successor of a document is found without a global order in one task: documents go to ranges of
(doc_id, hash of the text) whose bounds are drawn from the keys, and each range gets a copy of the first
document of the next one. Work on texts is vectorised over slices of bounded size, and long texts are
digested in blocks.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shared import INVERSE, MULT, mixed, output, powers, slices, uniform

WINDOW = 8
CUT_MASK = np.uint64(31)
"""A cut within a line falls after one byte in 32 on average."""
LONGEST = 1 << 14
"""Bytes of a paragraph at most: text without any place to cut, such as one repeated letter, is cut by length."""
BLOCK_BYTES = 1 << 20
CELLS = 12
"""Cells of a fingerprint; a failed peeling is repeated with `GROWTH` times as many."""
GROWTH = 4
THIRDS = 3
RANGE_ROWS = 2000
RANGES_PER_PARTITION = 4
DRAWN_PER_RANGE = 20

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


# --- paragraphs and their digests -------------------------------------------------------------


def _cuts(data: np.ndarray) -> np.ndarray:
    """Ends of paragraphs by content: after a line break, and where the hash of the window ends in zeros.

    A place whose window equals that of the byte before it is none, so runs of one byte are not cut to pieces.
    """
    rolled = np.zeros(len(data), dtype=np.uint64)
    for back in range(WINDOW):
        shifted = np.zeros(len(data), dtype=np.uint64)
        shifted[back:] = data[: max(0, len(data) - back)] + np.uint64(1)
        rolled += shifted * np.uint64(pow(MULT, back + 1, 1 << 64))
    chosen = (mixed(rolled) & CUT_MASK) == 0
    chosen[1:] &= rolled[1:] != rolled[:-1]
    chosen[:WINDOW] = False
    return np.flatnonzero(chosen | (data == 10)) + 1


def _limited(ends: np.ndarray) -> np.ndarray:
    """The ends, with more of them where a paragraph would be longer than `LONGEST`."""
    gaps = np.diff(ends, prepend=0)
    wide = np.flatnonzero(gaps > LONGEST)
    pieces = [np.arange(ends[k] - gaps[k] + LONGEST, ends[k], LONGEST) for k in wide.tolist()]
    return np.sort(np.concatenate([ends, *pieces])) if pieces else ends


def _digests(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the paragraphs that end at `ends`."""
    starts = np.r_[0, ends[:-1]]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data + np.uint64(1)) * powers(MULT, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))


def _long_digests(data: np.ndarray) -> np.ndarray:
    """Digests of a text that is taken in blocks; a block goes on where the last whole paragraph ended."""
    found, start = [], 0
    while start < len(data):
        stop = min(start + BLOCK_BYTES, len(data))
        lead = min(start, WINDOW)  # a cut depends on the bytes before it, not on the block
        ends = _cuts(data[start - lead : stop].astype(np.uint64)) - lead
        ends = np.unique(np.append(ends[ends > 0], stop - start))
        ends = _limited(ends)
        if stop < len(data) and len(ends) > 1:  # the last paragraph may go on
            ends = ends[:-1]
        found.append(_digests(data[start : start + ends[-1]].astype(np.uint64), ends))
        start += int(ends[-1])
    return np.concatenate([*found, np.empty(0, np.uint64)])


def numbered(owner: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and key of every digest; the second occurrence of a digest in a text is another key than the first."""
    order = np.lexsort((digests, owner))
    owner, digests = owner[order], digests[order]
    first = np.r_[True, (digests[1:] != digests[:-1]) | (owner[1:] != owner[:-1])] if len(owner) else np.empty(0, bool)
    group = np.flatnonzero(first)
    place = np.arange(len(owner)) - np.repeat(group, np.diff(np.r_[group, len(owner)]))
    return owner, mixed(digests + place.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


@dataclass(frozen=True)
class Keys:
    """Keys of several texts, by text: those of text i are values[starts[i] : starts[i + 1]]."""

    starts: np.ndarray
    values: np.ndarray

    def of(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in `texts` and key, for the keys of all of them."""
        counts = (self.starts[1:] - self.starts[:-1])[texts]
        owner = np.repeat(np.arange(len(texts)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return owner, self.values[self.starts[:-1][texts][owner] + within]

    def counts(self, texts: np.ndarray) -> np.ndarray:
        return (self.starts[1:] - self.starts[:-1])[texts]


def keys_of(texts: list[str]) -> Keys:
    """Keys of the paragraphs of every text; an empty text has none."""
    owners, digests = [], []
    coded = [np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8) for text in texts]
    short: list[int] = []
    room = 0

    def flush() -> None:
        nonlocal room
        if short:
            data = np.concatenate([coded[i] for i in short]).astype(np.uint64)
            bounds = np.cumsum([len(coded[i]) for i in short])
            ends = _joined_ends(data, bounds)
            digests.append(_digests(data, ends))
            owners.append(np.array(short)[np.searchsorted(bounds, ends, side="left")])
        short.clear()
        room = 0

    for i, data in enumerate(coded):
        if len(data) > BLOCK_BYTES:
            found = _long_digests(data)
            digests.append(found)
            owners.append(np.full(len(found), i))
        elif len(data):
            if room + len(data) > BLOCK_BYTES:
                flush()
            short.append(i)
            room += len(data)
    flush()
    owner, values = numbered(np.concatenate([*owners, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*digests, np.empty(0, np.uint64)]))
    return Keys(np.searchsorted(owner, np.arange(len(texts) + 1)), values)


def _joined_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the paragraphs of texts that lie one after the other and end at `bounds`; each is cut as if alone."""
    ends = _cuts(data)
    text = np.searchsorted(bounds, ends, side="left")
    ends = ends[(ends - np.r_[0, bounds[:-1]][text] > WINDOW) | (data[ends - 1] == 10)]
    return _limited(np.unique(np.concatenate([ends, bounds])))


# --- sketches -----------------------------------------------------------------------------------


def _check(keys: np.ndarray) -> np.ndarray:
    return mixed(keys ^ np.uint64(0x5851F42D4C957F2D))


def _places(keys: np.ndarray, cells: int, third: int) -> np.ndarray:
    """Cell of every key in one third of a sketch; other sizes deal the keys anew."""
    width = np.uint64(cells // THIRDS)
    salt = np.uint64(((third + 1) * 0xD1342543DE82EF95 + cells * 0x2545F4914F6CDD1D) % (1 << 64))
    return (mixed(keys + salt) % width).astype(np.int64) + third * int(width)


class Sketches:
    """Sketches of `cells` cells for several texts or pairs of texts, changed in place."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.counts = np.zeros(n * cells, dtype=np.int64)
        self.keys = np.zeros(n * cells, dtype=np.uint64)
        self.checks = np.zeros(n * cells, dtype=np.uint64)

    def put(self, owner: np.ndarray, keys: np.ndarray, times: np.ndarray | int) -> None:
        """Add (times 1) or take out (times -1) keys."""
        times = np.broadcast_to(np.asarray(times, dtype=np.int64), keys.shape)
        checks = _check(keys)
        for third in range(THIRDS):
            cell = owner * self.cells + _places(keys, self.cells, third)
            np.add.at(self.counts, cell, times)
            np.bitwise_xor.at(self.keys, cell, keys)
            np.bitwise_xor.at(self.checks, cell, checks)

    def text(self, i: int) -> str:
        """The cells of sketch i in hexadecimal: all numbers (4 bytes each), keys (8) and checks (8)."""
        part = slice(i * self.cells, (i + 1) * self.cells)
        return b"".join([self.counts[part].astype(">u4").tobytes(), self.keys[part].astype(">u8").tobytes(), self.checks[part].astype(">u8").tobytes()]).hex()

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owner, key and sign of all that can be recovered, and which sketches are empty then: these are recovered whole."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        look = np.arange(self.n * self.cells)
        while len(look):
            single = look[np.abs(self.counts[look]) == 1]
            single = single[_check(self.keys[single]) == self.checks[single]]
            owner, keys, signs = single // self.cells, self.keys[single], self.counts[single]
            order = np.lexsort((keys, owner))
            owner, keys, signs = owner[order], keys[order], signs[order]
            if len(owner):
                once = np.r_[True, (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])]
                owner, keys, signs = owner[once], keys[once], signs[once]
                self.put(owner, keys, -signs)
                found.append((owner, keys, signs))
            look = np.unique(np.concatenate([owner * self.cells + _places(keys, self.cells, third) for third in range(THIRDS)]))
        left = (self.counts != 0) | (self.keys != 0) | (self.checks != 0)
        empty = ~left.reshape(self.n, self.cells).any(axis=1)
        return (*(np.concatenate([np.empty(0, kind), *[f[k] for f in found]]) for k, kind in enumerate((np.int64, np.uint64, np.int64))), empty)


def sketched(keys: Keys, texts: np.ndarray, cells: int) -> Sketches:
    made = Sketches(len(texts), cells)
    made.put(*keys.of(texts), 1)
    return made


def differences(keys: Keys, ours: np.ndarray, theirs: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair, key and sign (1 only in our text, -1 only in theirs) of all digests in which the texts of pair i differ.

    Each pair is subtracted and peeled at `cells` cells; those that fail are sketched again, larger. Nothing
    partial is kept of a failure, so the result is whole.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    open_pairs = np.arange(len(ours))
    while len(open_pairs):
        failed = []
        share = max(1, (1 << 20) // cells)  # cells that are held at once
        for start in range(0, len(open_pairs), share):
            pairs = open_pairs[start : start + share]
            gap = sketched(keys, ours[pairs], cells)
            gap.put(*keys.of(theirs[pairs]), -1)
            owner, key, sign, whole = gap.peel()
            good = whole[owner]
            found.append((pairs[owner[good]], key[good], sign[good]))
            failed.append(pairs[~whole])
        open_pairs = np.concatenate(failed)
        cells *= GROWTH
    return tuple(np.concatenate([np.empty(0, kind), *[f[k] for f in found]]) for k, kind in enumerate((np.int64, np.uint64, np.int64)))


def likeness(keys: Keys, ours: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Common digests over all digests of every pair; 1 for two texts without any."""
    pair, _, _ = differences(keys, ours, theirs)
    differing = np.bincount(pair, minlength=len(ours))
    together = keys.counts(ours) + keys.counts(theirs)
    return np.where(together == 0, 1.0, (together - differing) / np.maximum(together + differing, 1))


# --- successors -----------------------------------------------------------------------------------


def edited(text: str, following: str) -> str:
    """`text` with its last quarter replaced by as much of the beginning of `following`, or all of that."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _key_columns(docs: DataFrame) -> tuple[Column, Column, Column]:
    """Whether the id is null, the id (or 0), the hash of the text: the order of documents."""
    doc_id = F.col("doc_id").cast("long")
    return doc_id.isNull().alias("last"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")


Key = tuple[bool, int, int]


def range_starts(docs: DataFrame) -> list[Key]:
    """Keys of existing documents at which the ranges start, ascending; the first of all documents comes first."""
    spark = docs.sparkSession
    keys = docs.select(*_key_columns(docs))
    found = keys.agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("last", "id", "mark")).alias("first")).first()
    if not found.rows:
        return []
    most = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(most, -(-found.rows // RANGE_ROWS))
    rate = min(1.0, DRAWN_PER_RANGE * ranges / found.rows)
    # drawn by a hash of the key, so that equal rows, however many, are one key
    drawn = keys.where(uniform(F.xxhash64("last", "id", "mark")) <= rate).distinct().orderBy("last", "id", "mark").collect()
    chosen = {tuple(row) for row in drawn[:: max(1, len(drawn) // ranges)]}
    return sorted(chosen | {tuple(found.first)})


def _dealt(docs: DataFrame, starts: list[Key]) -> DataFrame:
    """bucket, guest, last, id, mark, text, copies: every document in its range, equal rows of a batch as one
    with their number, and as guest of each range the document that follows its last one."""
    shared = docs.sparkSession.sparkContext.broadcast(starts)
    schema = "bucket int, guest boolean, last boolean, id long, mark long, text string, copies long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = shared.value
        for batch in batches:
            rows: dict[Key, list[int]] = {}
            for k, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("last", "id", "mark")), strict=True)):
                rows.setdefault(key, [k, 0])[1] += 1
            kept = batch.take(pa.array([k for k, _ in rows.values()], pa.int64()))
            n = len(rows)
            bucket = pa.array([bisect.bisect_right(starts, key) - 1 for key in rows], pa.int32())
            columns = [bucket, pa.array([False] * n), *[kept.column(c) for c in ("last", "id", "mark", "text")], pa.array([c for _, c in rows.values()], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in schema.split(", ")])

    texts = docs.select(*_key_columns(docs), F.coalesce("text", F.lit("")).alias("text"))
    own = texts.mapInArrow(run, schema)
    heads = docs.sparkSession.createDataFrame([((k - 1) % len(starts), *key) for k, key in enumerate(starts)], "bucket int, last boolean, id long, mark long")
    # `starts` is bounded by the number of shuffle partitions
    guests = texts.join(F.broadcast(heads), ["last", "id", "mark"]).groupBy("bucket", "last", "id", "mark").agg(F.max("text").alias("text"))
    guests = guests.select("bucket", F.lit(True).alias("guest"), "last", "id", "mark", "text", F.lit(1).cast("long").alias("copies"))
    return own.union(guests).repartition("bucket").sortWithinPartitions("bucket", "guest", "last", "id", "mark")


def _described(rows: list[tuple], documents: list[int]) -> pa.RecordBatch:
    """Result rows of the documents at the places `documents` of `rows`, each of which the next row follows."""
    texts = [row[5] for row in rows]
    changed = [edited(texts[k], texts[k + 1]) for k in documents]
    # a document with copies of itself is followed by one of them, but for the last
    repeated = [k for k in documents if rows[k][6] > 1]
    doubled = [edited(texts[k], texts[k]) for k in repeated]
    keys = keys_of([*texts, *changed, *doubled])
    place, n, m = np.array(documents), len(texts), len(documents)
    prints = sketched(keys, np.arange(n + m + len(doubled)), CELLS)
    near_edited = likeness(keys, np.r_[place, np.array(repeated, dtype=np.int64)], np.arange(n, n + m + len(doubled)))
    near_next = likeness(keys, place, place + 1)
    columns: list[list] = [[] for _ in SCHEMA.names]

    def add(k: int, after: str, j: int, next_like: float, times: int) -> None:
        digest = hashlib.sha256(after.encode("utf-8", "surrogatepass")).hexdigest()
        doc_id = None if rows[k][2] else rows[k][3]
        values = (doc_id, len(texts[k]), digest, prints.text(k), prints.text(n + j), float(near_edited[j]), next_like)
        for column, value in zip(columns, values, strict=True):
            column.extend([value] * times)

    for j, k in enumerate(documents):
        add(k, changed[j], j, float(near_next[j]), 1)
    for j, k in enumerate(repeated):
        add(k, doubled[j], m + j, 1.0, rows[k][6] - 1)
    return output(SCHEMA.names, columns, SCHEMA)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses.

    The next document is that with the next larger id, after the last the first; null ids follow all others,
    and documents of one id are ordered by the hash of their text. A single document follows itself. A null text
    counts as empty and has a fingerprint of empty cells; two empty texts have likeness 1. Repeated rows are returned
    each: the one before the next document is edited with that, the others with themselves. Long texts are
    digested in blocks; other columns are ignored; an empty table gives an empty result.
    """
    starts = range_starts(docs)
    if not starts:
        return _nothing(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: tuple | None = None
        for part in slices(batches, "text"):
            columns = (part.column(c).to_pylist() for c in ("bucket", "guest", "last", "id", "mark", "text", "copies"))
            rows: list[tuple] = [pending] if pending else []
            for now in zip(*columns, strict=True):
                before = rows[-1] if rows else None
                if before and before[:5] == now[:5]:  # equal rows that came in other batches
                    rows[-1] = (*before[:6], before[6] + now[6])
                else:
                    rows.append(now)
            pending = rows[-1] if rows else None
            documents = [k for k, row in enumerate(rows[:-1]) if not row[1]]
            if documents:
                yield _described(rows, documents)

    return _dealt(docs, starts).mapInArrow(run, SCHEMA)


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
