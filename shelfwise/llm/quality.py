"""Quality classifier by compression.

Two zstandard dictionaries are built, from good and from bad labelled text. A text is
compressed with each in blocks; what the good dictionary saves against the bad one, divided by the
size of the text, is its evidence. A text that repeats itself compresses well with either, so little is saved and it
has little evidence of being good. The division is damped: a text counts as if some bytes of typical good text
came with it, so that a few words, which hold no evidence, score by what is known of all texts. A logistic
curve over this difference, fitted on labelled rows that took no part in the dictionaries, gives
the probability of label 1.

Learning uses a bounded sample: at most `rows_per_class` labelled documents of each label,
chosen by hash, at most `bytes_per_class` of their text. Everything else reads all rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shared import held_out, learnable, output, per_class_sample, slices, texts_of
from shelfwise.sources.scratch import settle

BLOCK = 1024
LEVEL = 3
PRIOR_BYTES = 128
"""Typical good text that every text is taken to come with."""

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Model:
    """`good` and `bad` are dictionary bytes; both empty means nothing could be learned. `typical` is the difference of
    good text for each of its bytes, `slope` and `constant` those of the curve."""

    good: bytes
    bad: bytes
    typical: float
    slope: float
    constant: float


def labelled_sample(docs: DataFrame, labels: DataFrame, rows_per_class: int) -> DataFrame:
    """doc_id, text and label of the sample. Labels other than 0 and 1 and null texts are left out;
    a document labelled both ways counts for both. A document counts once: of several texts under one id the smallest."""
    known = labels.where(learnable(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", "quality").distinct()
    ids = settle(per_class_sample(known, "quality", "doc_id", rows_per_class), "quality-ids")
    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))


def blocks(text: str) -> list[bytes]:
    data = text.encode()
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def _dictionary(texts: list[str], size: int) -> bytes:
    samples = [block for text in texts for block in blocks(text)]
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text for the trainer: use it as it is
        return b"".join(samples)[-size:]


@functools.lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False, write_dict_id=False, write_checksum=False)


def saved(good: bytes, bad: bytes, text: str) -> tuple[int, int]:
    """Bytes that the good dictionary saves against the bad one, over all blocks, and the size of the text."""
    difference = raw = 0
    for block in blocks(text):
        difference += len(_compressor(bad).compress(block)) - len(_compressor(good).compress(block))
        raw += len(block)
    return difference, raw


def damped(difference: int, raw: int, typical: float) -> float:
    """The normalised difference; `typical` for an empty text."""
    return (difference + PRIOR_BYTES * typical) / (raw + PRIOR_BYTES)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, ...]:
    """Weights of a ridge-damped logistic curve by Newton steps, the last one constant."""
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    design = np.column_stack([x / scale, np.ones(len(x))])
    ridge = np.array([0.05] * x.shape[1] + [1e-6])
    beta = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(hessian, design.T @ (p - y) + ridge * beta)
        beta -= np.clip(step, -2, 2)
    return (*(beta[:-1] / scale).tolist(), float(beta[-1]))


def known_share(labels: DataFrame) -> float:
    """Share of label 1 among the labels that may be learned from; corrects for the sample, which is balanced."""
    rows = labels.where(learnable(F.col("doc_id")) & F.col("quality").isin(0, 1))
    return min(max(rows.agg(F.avg("quality")).first()[0], 0.01), 0.99)


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = 3000, bytes_per_class: int = 16 << 20, dictionary_size: int = 262_144) -> Model:
    """Fit on the bounded sample. Without rows of both labels the model scores everything 0.5."""
    texts: dict[int, list[str]] = {0: [], 1: []}
    room = {0: bytes_per_class, 1: bytes_per_class}
    sample = labelled_sample(docs, labels, rows_per_class).orderBy(F.xxhash64("doc_id"), "doc_id", "text", "quality")
    for row in sample.toLocalIterator():
        if room[row.quality] > 0 and row.text:
            texts[row.quality].append(row.text)
            room[row.quality] -= len(row.text.encode())
    if min(len(texts[0]), len(texts[1])) < 4:
        return Model(b"", b"", 0.0, 0.0, 0.0)
    good, bad = (_dictionary(texts[k][0::2], dictionary_size) for k in (1, 0))
    rest = [(*saved(good, bad, text), k) for k in (0, 1) for text in texts[k][1::2]]
    typical = float(np.median([difference / raw for difference, raw, k in rest if k == 1]))
    x, y = np.array([[damped(difference, raw, typical)] for difference, raw, _ in rest]), np.array([k for *_, k in rest])
    slope, constant = _logistic(x, y)
    share = known_share(labels)
    odds = math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
    return Model(good, bad, typical, slope, constant + odds)


def score(model: Model, text: str) -> float:
    if not model.good or not model.bad:
        return 0.5
    difference = damped(*saved(model.good, model.bad, text), model.typical)
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, model.slope * difference + model.constant))))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """Score every row of `docs` by its whole text.

    A null text counts as empty; an empty text gets the score of typical good text. Long texts are compressed block by block. Repeated
    rows are scored each, other columns are ignored, an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            scores = [score(shared.value, text) for text in texts_of(part)]
            columns = [part.column("doc_id"), part.column("held_out"), scores, [int(x >= 0.5) for x in scores]]
            yield output(SCHEMA.names, columns, SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, all their columns, whose text scores at least 0.5.

    A null text counts as empty, so such rows go or stay together with empty ones. Repeated rows are judged each, long texts
    by all their blocks; columns keep their names whatever they are; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield part.filter(pa.array([score(shared.value, text) >= 0.5 for text in texts_of(part)]))

    return docs.mapInArrow(run, docs.schema)
