"""Token counts of a byte-pair vocabulary without making tokens.

A text is cut into segments that no piece of the vocabulary spans: blanks with the visible
run after them. In a segment the characters form a linked list; a heap holds the adjacent
pairs that are pieces. The pair of the lowest rank, the leftmost among equals, is merged
again and again. The count is the number of characters less the merges; a character that is
no piece and stays single counts as its UTF-8 bytes (byte fallback). No identifiers arise.

Counts of short segments are kept in a bounded table of each Python worker.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shared import output, slices, texts_of

BLANK = "▁"
KEPT_SEGMENTS, KEPT_LENGTH = 400_000, 40
_SEGMENTS = re.compile(" *[^ ]+| +")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]
)


class Vocabulary:
    """Ranks of the pieces (blanks written as spaces), lowest merged first."""

    def __init__(self, scores: dict[str, float]):
        if any(" " in piece.lstrip(" ") for piece in scores):
            raise ValueError("a piece spans a blank; the segments would not be independent")
        self.ranks = {piece: -score for piece, score in scores.items()}
        self.words = _Kept(lambda word: self.count_segment(" " + word))

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_unused, model.is_byte)
        ids = [i for i in range(model.get_piece_size()) if not any(kind(i) for kind in special)]
        return cls({model.id_to_piece(i).replace(BLANK, " "): model.get_score(i) for i in ids})

    def count_segment(self, segment: str) -> int:
        ranks = self.ranks
        part: list[str] = list(segment)
        n = len(part)
        heap = [(ranks[p], i, p) for i in range(n - 1) if (p := part[i] + part[i + 1]) in ranks]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not part[i] or j >= n or part[i] + part[j] != pair:
                continue  # one of the two has been merged meanwhile
            part[i], part[j] = pair, ""
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := pair + part[k]) in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            h = before[i]
            if h >= 0 and (p := part[h] + pair) in ranks:
                heapq.heappush(heap, (ranks[p], h, p))
        left = sum(len(c.encode()) - 1 for c in part if len(c) == 1 and c not in ranks)
        return n - merges + left

    def count(self, text: str) -> int:
        """Tokens of a whole text, one blank put before it; an empty text has none."""
        if not text:
            return 0
        text = text.replace(BLANK, " ")
        if text[0] != " " and text[-1] != " " and "  " not in text:
            return sum(map(self.words.__getitem__, text.split(" ")))
        return sum(self.words[s[1:]] if s[1:2] != " " else self.count_segment(s) for s in _SEGMENTS.findall(" " + text))


class _Kept(dict):
    """Results of a function of a string; short ones are kept until the table is full, then it starts anew."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> int:
        value = self.make(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= KEPT_SEGMENTS:
                self.clear()
            self[key] = value
        return value


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has more than `limit` tokens.

    A null text counts as empty: no bytes, no tokens. Repeated rows are counted each, other
    columns are ignored, an empty table gives an empty result. `path` is read on each executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = vocabulary(path).count
        for part in slices(batches, "text"):
            texts = texts_of(part)
            tokens = [count(text) for text in texts]
            sizes = [len(text.encode()) for text in texts]
            yield output(SCHEMA.names, [part.column("doc_id"), sizes, tokens, [n > limit for n in tokens]], SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
