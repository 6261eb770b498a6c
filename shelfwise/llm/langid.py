"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of zero to three bytes is counted once, over a
bounded sample, and then frozen. A byte is coded in its longest known context; an escape
(method C: as many escapes as distinct followers) leads to the next shorter context with the
followers already seen excluded, and at last to a uniform choice of 256 bytes. The language
whose tree gives the shortest exact code length wins.

Since the counts are frozen, the cost of each byte in each context is a table, in integers of
1/4096 bit, so sums are exact and do not depend on their order. Texts are lower-cased and
every run of characters that are no letters becomes one space before coding.

The sample is bounded: `rows_per_language` documents of each language, chosen by hash, and at
most `bytes_per_language` of them. Everything else reads whole texts of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shared import held_out, learnable, output, per_class_sample, slices, texts_of
from shelfwise.sources.scratch import settle

UNIT = 4096
UNKNOWN = "und"
_OTHER = regex.compile(r"\P{L}+")
_LETTER = regex.compile(r"\p{L}")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Model:
    """`symbol` maps a byte to a symbol; two table steps lead from the last three symbols to a
    context; `costs[context * symbols + symbol]` has the cost for each language."""

    languages: tuple[str, ...]
    symbol: np.ndarray
    pairs: np.ndarray
    contexts: np.ndarray
    costs: np.ndarray


def folded(text: str) -> bytes:
    """Lower-case letters with single spaces between and around their runs."""
    return _OTHER.sub(" ", f" {text.lower()} ").encode()


def _count(data: bytes, symbol: np.ndarray, n: int) -> list[np.ndarray]:
    """Occurrences of each 1-, 2-, 3- and 4-gram: rows are contexts as numbers, columns followers; sparse as (key, count)."""
    s = symbol[np.frombuffer(data, dtype=np.uint8)].astype(np.int64)
    grams, key = [], np.zeros(len(s), dtype=np.int64)
    for k in range(4):
        # key of position i: the k symbols before it and itself
        part = np.zeros(len(s), dtype=np.int64)
        part[k:] = s[: len(s) - k] * n**k
        key = key + part
        grams.append(np.unique(key[k:], return_counts=True))
    return grams


def _costs(grams: list, contexts: list[np.ndarray], n: int, spare: int) -> list[np.ndarray]:
    """Probabilities of each symbol in each context of `contexts[k]` (numbers of k symbols), for one language."""
    uniform = np.full(n, 1 / 256)
    uniform[0] = spare / 256  # symbol 0 stands for all bytes that were not seen in learning
    shorter = np.broadcast_to(uniform, (1, n))
    out = []
    for k in range(4):
        keys, counts = grams[k]
        rows = np.searchsorted(contexts[k], keys // n)
        known = (rows < len(contexts[k])) & (contexts[k][np.minimum(rows, len(contexts[k]) - 1)] == keys // n)
        table = np.zeros((len(contexts[k]), n))
        table[rows[known], (keys % n)[known]] = counts[known]
        if k:  # the context without its oldest symbol, known by construction
            parent = out[-1][np.searchsorted(contexts[k - 1], contexts[k] % n ** (k - 1))]
        else:
            parent = shorter
        seen = table > 0
        followers, total = seen.sum(axis=1), table.sum(axis=1)
        left = np.where(seen, 0, parent).sum(axis=1)
        escape = np.where(left > 0, followers / np.maximum(total + followers, 1), 0)
        escape[total == 0] = 1  # never met in this language: the shorter context as it is
        found = table / np.maximum(total + np.where(left > 0, followers, 0), 1)[:, None]
        out.append(np.where(seen, found, parent * (escape / np.where(left > 0, left, 1))[:, None]))
    return out


def build(texts: dict[str, list[bytes]]) -> Model:
    """Freeze the trees of the folded sample texts of each language.

    Contexts of two and three bytes become nodes only where some follower came twice in a language;
    a text falls back to the shorter context there, as for a context that was never met.
    """
    languages = tuple(sorted(texts))
    used = sorted(set(b"".join(b"".join(t) for t in texts.values())) | {32})
    n = len(used) + 1
    symbol = np.zeros(256, dtype=np.int32)
    symbol[used] = np.arange(1, n)
    grams = {lang: _count(b"".join(texts[lang]), symbol, n) for lang in languages}
    contexts = [np.zeros(1, dtype=np.int64)]
    for k in range(1, 4):
        followed = [keys[counts > 1] // n for keys, counts in (grams[lang][k] for lang in languages)] if k > 1 else [np.arange(n)]
        found = np.unique(np.concatenate(followed)) if followed else np.zeros(0, dtype=np.int64)
        if k > 1:
            found = found[np.isin(found % n ** (k - 1), contexts[-1])]
        contexts.append(found)
    first = np.cumsum([0] + [len(c) for c in contexts])
    tables = []
    for lang in languages:
        p = np.concatenate(_costs(grams[lang], contexts, n, 256 - len(used)))
        tables.append(np.rint(-np.log2(np.maximum(p, 2.0**-40)) * UNIT).astype(np.int32).ravel())
    # two steps: (third last, second last) -> row; (row, last) -> the longest known context
    heads = np.unique(contexts[3] // n)
    pairs = np.tile(np.arange(n, dtype=np.int32), n)
    pairs[heads] = n + np.arange(len(heads))
    by_two = first[1] + np.tile(np.arange(n), n)
    by_two[contexts[2]] = first[2] + np.arange(len(contexts[2]))
    steps = np.concatenate([by_two.reshape(n, n), by_two.reshape(n, n)[heads % n]])
    rows = n + np.searchsorted(heads, contexts[3] // n)
    steps[rows, contexts[3] % n] = first[3] + np.arange(len(contexts[3]))
    return Model(languages, symbol, pairs, steps.astype(np.int32).ravel(), np.stack(tables, axis=1))


def train(docs: DataFrame, rows_per_language: int = 400, bytes_per_language: int = 2 << 20) -> Model | None:
    """Learn from text and non-null lang of documents that are not held out; None if there is none.

    A document counts once: of several texts under one id and language the smallest.
    """
    known = docs.where(learnable(F.col("doc_id")) & F.col("lang").isNotNull()).select("doc_id", "lang").distinct()
    ids = settle(per_class_sample(known, "lang", "doc_id", rows_per_language), "language-ids")
    sample = docs.where(F.col("text").isNotNull()).select("doc_id", "lang", "text").join(ids, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    texts: dict[str, list[bytes]] = {}
    room: dict[str, int] = {}
    for row in sample.orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "text").toLocalIterator():
        if room.setdefault(row.lang, bytes_per_language) > 0 and _LETTER.search(row.text):
            texts.setdefault(row.lang, []).append(folded(row.text))
            room[row.lang] -= len(texts[row.lang][-1])
    return build(texts) if texts else None


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Code length of each folded text in each language, in units of 1/4096 bit. A text starts after three spaces."""
    data = np.frombuffer(b"".join(b"   " + text for text in texts), dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.cumsum(sizes + 3) - sizes
    s, n = model.symbol[data], int(model.symbol.max()) + 1
    row = model.pairs[s[:-3] * n + s[1:-2]]
    context = model.contexts[row * n + s[2:-1]]
    cost = np.zeros((len(s) + 1, len(model.languages)), dtype=np.int32)
    cost[3:-1] = model.costs[context * n + s[3:]]
    ends = np.stack([starts, starts + sizes], axis=1).ravel()
    sums = np.add.reduceat(cost, ends, axis=0, dtype=np.int64)[0::2]
    sums[sizes == 0] = 0
    return sums


def judged(model: Model | None, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and posterior, all languages held equally likely beforehand. Ties go to the first name."""
    if model is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    bits = code_lengths(model, [folded(text) for text in texts])
    best = bits.argmin(axis=1)
    behind = np.minimum((bits - bits.min(axis=1, keepdims=True)) / UNIT, 1000.0)
    scores = 1 / np.exp2(-behind).sum(axis=1)
    lettered = [bool(_LETTER.search(text)) for text in texts]
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered, strict=True)]
    return names, [x if ok else 0.0 for x, ok in zip(scores.tolist(), lettered, strict=True)]


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Language of every row of `docs`, judged by its whole text alone.

    A null text or one without a letter is `und` with score 0, as is every row where nothing
    could be learned. Repeated rows are judged each; other columns are ignored; an empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            names, scores = judged(shared.value, texts_of(part))
            yield output(SCHEMA.names, [part.column("doc_id"), part.column("held_out"), names, scores], SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, SCHEMA)
