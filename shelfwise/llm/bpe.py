"""Byte-level BPE encoding of whole texts by words, of long words by tree concatenation, and decoding.

A text is cut before the last white-space character ahead of each word and after the word, where the
splitting pattern always cuts. Each different word of a slice is encoded once, and the tokens of
short words are kept for the next slices.

A word longer than a leaf is halved again and again; all leaves of a slice are encoded side by
side, then neighbours are joined pairwise up the tree. At a join a window around the cut is
encoded anew. Two facts make the result exact:

* The splitting pattern always cuts where the character class (letter, number, white space,
  other) changes, except after white space and after an apostrophe. If the window reaches such
  a place on both sides, what lies outside is encoded alone and stays as it is.
* Inside one long run without such a place the window begins and ends at token borders. If its
  first token is the left side's token there and its last one the right side's, every pair of
  neighbours in the joined sequence occurs in a valid encoding, which for merge-rank BPE makes
  the whole sequence the valid one. Until then the window grows to twice its size.

Special strings inside a text are cut out first, as the library does.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shared import output, slices, texts_of

LEAF = 16_384
SLICE = 1 << 18
"""Bytes of text encoded at once: the library keeps far more than the identifiers of each token."""
SHORT_WINDOW = 512
KEPT_WORDS = 200_000
LONGEST_KEPT = 64
"""Characters of the longest words, and number of words, whose tokens a worker keeps; beyond that number it starts anew."""
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORDS = re.compile(f"[{_SPACE}]?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])")
"""The white space of the splitting pattern, which is not that of Python, and the parts of a text by it, without gaps."""
_BORDER = regex.compile(
    r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=[^\s\p{L}\p{N}])(?=[\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=\p{L})"
)

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Node:
    """A stretch of a text and, once encoded, its tokens."""

    start: int
    end: int
    ids: list[int]


class Codec:
    def __init__(self, path: str):
        os.environ.setdefault("RAYON_NUM_THREADS", "2")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items() if t.special}
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        table = _byte_of_character()
        size = self.library.get_vocab_size()
        pieces = [self.library.id_to_token(i) for i in range(size)]
        self.bytes = [p.encode() if p in self.special else bytes(table[c] for c in p) for p in pieces]
        self.decimal = [str(i).encode() for i in range(size)]
        self._sizes = np.array([len(b) for b in self.bytes])
        self._kept: dict[str, list[int]] = {}

    def encode(self, texts: list[str], leaf: int = LEAF) -> list[list[int]]:
        """Tokens of each whole text."""
        kept, words = self._kept, [self._words(text) for text in texts]
        new = set().union(*words).difference(kept)
        kept.update(self._new_words(new, leaf))
        out = [list(itertools.chain.from_iterable(map(kept.__getitem__, found))) for found in words]
        for word in new:
            if len(word) > LONGEST_KEPT:
                del kept[word]
        if len(kept) > KEPT_WORDS:
            kept.clear()
        return out

    def _words(self, text: str) -> list[str]:
        """The text in parts that are encoded alone; a special string is one, and white space before it stays together."""
        if not any(special in text for special in self.special):
            return _WORDS.findall(text)
        return [word for piece in self._cut.split(text) for word in ([piece] if piece in self.special else _WORDS.findall(piece))]

    def _new_words(self, words: set[str], leaf: int) -> Iterator[tuple[str, list[int]]]:
        """Each word with its tokens. Short ones after one blank are encoded many in a text, as a call for each costs
        more than its tokens, and parted by their bytes."""
        blank = [w for w in words if 1 < len(w) <= LONGEST_KEPT and w[0] == " " and not w[1].isspace()]
        lines = ["".join(some) for some in itertools.batched(blank, 64)]
        if any(special in line for special in self.special for line in lines):
            blank, lines = [], []
        ids = list(itertools.chain.from_iterable(self.encode_words(lines, leaf)))
        ends = np.searchsorted(np.cumsum(self._sizes[ids]), np.cumsum([len(w.encode()) for w in blank])) + 1 if blank else np.empty(0, int)
        yield from zip(blank, (ids[a:b] for a, b in itertools.pairwise([0, *ends.tolist()])), strict=True)
        others = list(words.difference(blank))
        yield from zip(others, self.encode_words(others, leaf), strict=True)

    def encode_words(self, texts: list[str], leaf: int = LEAF) -> list[list[int]]:
        """Tokens of each text as a whole, nothing kept."""
        plans = [self._parts(text, leaf) for text in texts]
        stretches = [part[node.start : node.end] for plan in plans for part, nodes in plan for node in nodes]
        coded = iter(self.library.encode_batch_fast(stretches, add_special_tokens=False))
        out = []
        for plan in plans:
            ids: list[int] = []
            for part, nodes in plan:
                for node in nodes:
                    node.ids = next(coded).ids
                ids += self._joined(part, nodes)
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def _parts(self, text: str, leaf: int) -> list[tuple[str, list[Node]]]:
        """The text without its special strings, each stretch with its leaves; a special string is a leaf."""
        if len(text) <= leaf:
            return [(text, [Node(0, len(text), [])])]
        pieces = [p for p in self._cut.split(text) if p] if self._cut else [text]
        return [(piece, [Node(0, len(piece), [])] if piece in self.special else _leaves(0, len(piece), leaf)) for piece in pieces]

    def _joined(self, text: str, nodes: list[Node]) -> list[int]:
        while len(nodes) > 1:
            pairs = [nodes[i : i + 2] for i in range(0, len(nodes), 2)]
            nodes = [self._join(text, *pair) if len(pair) == 2 else pair[0] for pair in pairs]
        return nodes[0].ids if nodes else []

    def _join(self, text: str, left: Node, right: Node) -> Node:
        cut, reach = left.end, 32
        while True:
            start = max(left.start, cut - reach)
            end = min(right.end, cut + reach)
            borders = [m.start() for m in _BORDER.finditer(text, max(left.start, start - 1), min(right.end, end + 1))]
            a = max((b for b in borders if start <= b <= cut), default=left.start if start == left.start else None)
            q = min((b for b in borders if cut <= b <= end), default=right.end if end == right.end else None)
            if a is not None and q is not None:
                ids = self._encode_alone(text[a:q])
                return Node(left.start, right.end, self._before(left.ids, text[a:cut]) + ids + self._after(right.ids, text[cut:q]))
            if reach >= SHORT_WINDOW and (joined := self._join_run(text, left, right, reach, a, q)):
                return joined
            reach *= 2

    def _join_run(self, text: str, left: Node, right: Node, reach: int, a: int | None, q: int | None) -> Node | None:
        """A window that ends inside the run on one or both sides, there at token borders."""
        cut = left.end
        i, head = self._token_border(left.ids, cut - left.start if a is None else cut - a, reach, from_end=True, exact=a is not None, text=text[left.start : cut])
        j, tail = self._token_border(right.ids, right.end - cut if q is None else q - cut, reach, from_end=False, exact=q is not None, text=text[cut : right.end])
        if head is None or tail is None:
            return None
        window = self._encode_alone(head + tail)
        if not window or (a is None and (head.startswith("'") or window[0] != left.ids[i])) or (q is None and window[-1] != right.ids[j - 1]):
            return None
        return Node(left.start, right.end, left.ids[:i] + window + right.ids[j:])

    def _token_border(self, ids: list[int], size: int, reach: int, *, from_end: bool, exact: bool, text: str) -> tuple[int, str | None]:
        """Index of the token where the window starts (or ends), and the window's text on that side."""
        if exact:
            side = text[len(text) - size :] if from_end else text[:size]
            return (len(self._before(ids, side)) if from_end else len(ids) - len(self._after(ids, side))), side
        data = b""
        order = range(len(ids) - 1, -1, -1) if from_end else range(len(ids))
        chunks: list[bytes] = []
        n = 0
        for k in order:
            chunks.append(self.bytes[ids[k]])
            n += len(chunks[-1])
            if n >= reach:
                data = b"".join(reversed(chunks)) if from_end else b"".join(chunks)
                try:
                    return (k if from_end else k + 1), data.decode()
                except UnicodeDecodeError:  # the border is inside a character: one token more
                    continue
        return 0, None

    def _before(self, ids: list[int], tail: str) -> list[int]:
        """`ids` without the tokens of `tail` at their end; a token ends where `tail` begins."""
        left, k = len(tail.encode()), len(ids)
        while left > 0:
            k -= 1
            left -= len(self.bytes[ids[k]])
        return ids[:k]

    def _after(self, ids: list[int], head: str) -> list[int]:
        left, k = len(head.encode()), 0
        while left > 0:
            left -= len(self.bytes[ids[k]])
            k += 1
        return ids[k:]

    def _encode_alone(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids


def _leaves(start: int, end: int, leaf: int) -> list[Node]:
    if end - start <= leaf:
        return [Node(start, end, [])]
    middle = (start + end) // 2
    return _leaves(start, middle, leaf) + _leaves(middle, end, leaf)


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Tokens of every whole text and digests of the identifiers and of the decoded text.

    A null text counts as empty: no tokens, digests of the empty string. Repeated rows are coded
    each, other columns are ignored, an empty table gives an empty result. `path` is read on
    each executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = codec(path)
        for part in slices(batches, "text", SLICE):
            sizes, marks, back = [], [], []
            for ids in used.encode(texts_of(part)):
                sizes.append(len(ids))
                marks.append(hashlib.sha256(b",".join(map(used.decimal.__getitem__, ids))).hexdigest())
                back.append(hashlib.sha256(used.decode(ids).encode()).hexdigest())
            yield output(SCHEMA.names, [part.column("doc_id"), sizes, marks, back], SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def with_tokens(docs: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """`docs` with the identifiers of the whole text as an array, in place of any column of that name."""
    schema = T.StructType([f for f in docs.schema if f.name != column] + [T.StructField(column, T.ArrayType(T.IntegerType()))])
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = codec(path)
        for part in slices(batches, "text", SLICE):
            ids = pa.array(used.encode(texts_of(part)), type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), ids], names=schema.names)

    return docs.mapInArrow(run, schema)
