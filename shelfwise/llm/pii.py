"""Personal data: fixed patterns, and a linear-chain conditional random field that adds spans.

The patterns give the base spans, which always stay. The field labels tokens (runs of digits,
runs of letters, single other characters) with the beginning or inside of an email address, IP
address, card number or phone number, from features of their word shapes alone. It is trained
by gradient ascent on the likelihood of a small labelled table, `labelled_lines`, and decoded by
Viterbi over batches of equally long stretches.

A word without a digit and without `@` never belongs to a span. Such words are fixed to "outside",
which splits the chain: the best path of the whole text is the best path of each stretch of
other words, so texts of any length are decoded whole and exactly.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import random
import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shared import output, slices, texts_of

Span = tuple[str, int, int]

KINDS = ("email", "ip", "card", "phone")
STATES = ("O", *(f"{part}-{kind}" for kind in KINDS for part in "BI"))
ALLOWED = np.array([[not after.startswith("I") or before[2:] == after[2:] for after in STATES] for before in STATES])
BARRED = -1e4

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *(T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)

# --- the fixed patterns ------------------------------------------------------------------------

_HINT = re.compile("[0-9@]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a match can begin only where a run of digits does
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost, non-overlapping, in linear time: from each `@` back over the local part."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            yield "email", start, found.end()
            done = found.end()
        else:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start and then kind; a failing match is dropped without a retry."""
    if not _HINT.search(text):
        return []
    spans = list(_emails(text))
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", *m.span()) for m in _CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


# --- tokens and word shapes --------------------------------------------------------------------

_WORDS = re.compile(r"\S+")
_TOKENS = re.compile(r"[0-9]+|[^\W\d_]+|[^0-9]")
_RUNS = ((re.compile("[0-9]+"), "9"), (re.compile(r"[^\W\d_]+"), "a"))


@dataclass
class Stretch:
    """Neighbouring words that may hold personal data, token by token: where each begins and ends, its own shape
    (marked where it begins a word), the shape of its word, and the size of a number. Equal shapes are one string."""

    starts: array
    ends: array
    near: list[str]
    whole: list[str]
    size: list[str]

    @property
    def spans(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends, strict=True))

    def __len__(self) -> int:
        return len(self.near)

    @property
    def features(self) -> list[list[str]]:
        """The features of every token: SLOTS of its surroundings, then its word and size."""
        at = lambda k: self.near[k] if 0 <= k < len(self) else "end"
        return [[*[mark + "~".join(at(i + k) for k in places) for mark, places in SLOTS], f"w{self.whole[i]}", f"z{self.size[i]}"] for i in range(len(self))]


SLOTS = (("s", (0,)), ("p", (-1,)), ("n", (1,)), ("q", (-2,)), ("m", (2,)), ("ps", (-1, 0)), ("sn", (0, 1)))
"""Features by the shapes of the tokens at these distances."""


def _shape(token: str) -> str:
    if token[0] in "0123456789":
        return f"d{min(len(token), 20)}"
    if token[0].isalpha():
        case = "A" if token.isupper() else "a" if token.islower() else "Aa"
        return case + str(min(len(token), 4))
    return token


@functools.lru_cache(maxsize=4096)
def _word_shape(word: str) -> str:
    word = word.strip("\"'.,;:!?%$#&*|")
    for pattern, mark in _RUNS:
        word = pattern.sub(mark, word)
    return word


def _stretch(text: str, words: list[tuple[int, int]]) -> Stretch:
    made = Stretch(array("q"), array("q"), [], [], [])
    for start, end in words:
        shape = sys.intern(_word_shape(text[start:end]))
        first = "_"
        for m in _TOKENS.finditer(text, start, end):
            token = m[0]
            made.starts.append(m.start())
            made.ends.append(m.end())
            made.near.append(sys.intern(first + _shape(token)))
            made.whole.append(shape)
            made.size.append("" if token[0] not in "0123456789" or len(token) > 3 else "byte" if int(token) <= 255 else "more")
            first = ""
    return made


def stretches(text: str) -> list[Stretch]:
    if not _HINT.search(text):
        return []
    runs: list[list[tuple[int, int]]] = []
    follows = False
    for m in _WORDS.finditer(text):
        if marked := bool(_HINT.search(text, *m.span())):
            if not follows:
                runs.append([])
            runs[-1].append(m.span())
        follows = marked
    return [_stretch(text, words) for words in runs]


# --- the field ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    index: dict[str, int]
    emit: np.ndarray  # feature x state; row 0 is for features that were never seen
    move: np.ndarray  # state x state, with BARRED where a label can't follow

    def _looked_up(self, names: list[str]) -> np.ndarray:
        """Weights of some features, one row each."""
        return self.emit[[self.index.get(name, 0) for name in names]]

    def _emissions(self, stretch: Stretch) -> np.ndarray:
        """Token x state. Each different shape, pair of shapes, word shape and size is looked up once."""
        ids: dict[str, int] = {"end": 0}
        own = np.fromiter((ids.setdefault(x, len(ids)) for x in stretch.near), dtype=np.int64, count=len(stretch))
        names, n = list(ids), len(ids)
        padded = np.concatenate([[0, 0], own, [0, 0]])
        out = np.zeros((len(stretch), len(STATES)))
        for mark, places in SLOTS:
            key = np.zeros(len(stretch), dtype=np.int64)
            for k in places:
                key = key * n + padded[2 + k : 2 + k + len(stretch)]
            found, back = np.unique(key, return_inverse=True)
            parts = [[names[code // n ** (len(places) - 1 - j) % n] for j in range(len(places))] for code in found.tolist()]
            out += self._looked_up([mark + "~".join(part) for part in parts])[back.ravel()]
        for mark, values in (("w", stretch.whole), ("z", stretch.size)):
            kinds: dict[str, int] = {}
            code = np.fromiter((kinds.setdefault(x, len(kinds)) for x in values), dtype=np.int64, count=len(stretch))
            out += self._looked_up([mark + x for x in kinds])[code]
        return out

    def scores(self, batch: list[Stretch]) -> np.ndarray:
        """Emissions of stretches, padded to the longest: stretch x token x state."""
        out = np.zeros((len(batch), max(map(len, batch)), len(STATES)))
        for k, stretch in enumerate(batch):
            out[k, : len(stretch)] = self._emissions(stretch)
        return out


_START = np.array([0.0 if not s.startswith("I") else BARRED for s in STATES])


def viterbi(field: Field, batch: list[Stretch]) -> list[list[int]]:
    """The best state path of each stretch. Ties go to the earlier state."""
    if len(batch) == 1:
        return [_one_path(field, batch[0])]
    scores, sizes = field.scores(batch), np.array([len(s) for s in batch])
    steps = scores.shape[1]
    best = scores[:, 0] + _START
    back = np.zeros(scores.shape, dtype=np.int8)
    for t in range(1, steps):
        through = best[:, :, None] + field.move[None]
        back[:, t] = through.argmax(axis=1)
        best = np.where((t < sizes)[:, None], through.max(axis=1) + scores[:, t], best)
    state = best.argmax(axis=1)
    paths = np.zeros((len(batch), steps), dtype=np.int64)
    rows = np.arange(len(batch))
    for t in range(steps - 1, -1, -1):
        paths[:, t] = state
        state = np.where((t < sizes) & (t > 0), back[rows, t, state], state)
    return [path[:n].tolist() for path, n in zip(paths, sizes.tolist(), strict=True)]


def _one_path(field: Field, stretch: Stretch) -> list[int]:
    """The same for one stretch, which may be very long: small steps, one byte a state to go back."""
    scores = field._emissions(stretch)
    back = np.zeros(scores.shape, dtype=np.int8)
    best, move, columns = scores[0] + _START, field.move, np.arange(len(STATES))
    for t in range(1, len(scores)):
        through = best[:, None] + move
        chosen = through.argmax(axis=0)
        back[t] = chosen
        best = through[chosen, columns] + scores[t]
    state = int(best.argmax())
    path = [state] * len(scores)
    for t in range(len(scores) - 1, 0, -1):
        state = int(back[t, state])
        path[t - 1] = state
    return path


def labelled_lines(seed: int = 7, n: int = 600) -> list[tuple[str, list[Span]]]:
    """The small labelled table: lines with marked personal data, and lines with look-alikes."""
    rng = random.Random(seed)
    number = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("aeinorstlmd") for _ in range(rng.randint(2, 8)))
    byte = lambda: str(rng.randint(0, 255))
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))

    def card() -> str:
        body = number(rng.choice([13, 14, 14, 15, 15, 15, 15, 15, 18]))
        digits = body + next(d for d in "0123456789" if luhn(body + d))
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return rng.choice(["", "", " ", "-"]).join(groups)

    makers = {
        "email": lambda: f"{word()}{rng.choice(['', '.', '_', '+'])}{rng.choice([word(), number(2)])}@{word()}{rng.choice(['', number(1)])}.{rng.choice(['com', 'org', 'example.com', 'co.uk', 'de'])}",
        "ip": lambda: ".".join(byte() for _ in range(4)),
        "card": card,
        "phone": lambda: rng.choice(
            [
                f"+{rng.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}",
                f"+{rng.randint(1, 99)} {number(3)} {number(3)} {number(4)}",
                f"+{rng.randint(1, 99)}-{number(3)}-{number(7)}",
                f"+{number(11)}",
                f"({number(3)}) {number(3)}-{number(4)}",
                f"{rng.randint(2, 9)}{number(2)}-{number(3)}-{number(4)}",
            ]
        ),
    }
    alike = [
        lambda: f"version {rng.randint(0, 9)}.{rng.randint(0, 20)}",
        lambda: f"Version {rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}",
        lambda: f"CC BY-NC {rng.randint(1, 4)}.0.",
        lambda: f'token = "{hexes(rng.choice([24, 32, 40, 40]))}"',
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}",
        lambda: f"{rng.randint(0, 23)}:{rng.randint(10, 59)}",
        lambda: f"${rng.randint(1, 999)}.{number(2)}",
        lambda: f"{rng.randint(1, 99)},{number(3)},{number(3)}",
        lambda: f"{rng.randint(300, 999)}.{rng.randint(300, 999)}.{byte()}.{byte()}",
        lambda: f"chapter {rng.randint(1, 99)}",
        lambda: f"pp. {rng.randint(1, 99)}-{rng.randint(100, 199)}",
        lambda: f"order {number(rng.choice([5, 6, 8, 9, 10, 11]))}",
        lambda: f"{rng.randint(1, 9)} @ {rng.randint(1, 9)}.{number(2)}",
        lambda: f"@{word()}{number(2)}",
        lambda: f"isbn {number(3)}-{number(1)}-{number(2)}-{number(6)}-{number(1)}",
        lambda: f"{word()}{number(3)}{word()}",
        lambda: f"{number(rng.choice([20, 24, 30]))}",
    ]
    lines = []
    for k in range(n):
        text, spans = word(), []
        for _ in range(rng.randint(1, 2)):
            text += rng.choice([" ", " ", ", ", "\n"])
            if k % 2:
                kind = rng.choice(KINDS)
                found = makers[kind]()
                spans.append((kind, len(text), len(text) + len(found)))
                text += found
            else:
                text += rng.choice(alike)()
            text += rng.choice(["", "", ".", ",", "!!", "%%%", " |"]) + " " + word()
        lines.append((text, spans))
    return lines


def _gold(stretch: Stretch, spans: list[Span]) -> list[int]:
    states = []
    for start, end in stretch.spans:
        span = next((s for s in spans if s[1] <= start and end <= s[2]), None)
        states.append(STATES.index(f"{'B' if span[1] == start else 'I'}-{span[0]}") if span else 0)
    return states


@functools.lru_cache(maxsize=2)
def train(seed: int = 7, rounds: int = 80, damping: float = 0.002) -> Field:
    """Fit the field to `labelled_lines` by Adam steps on the damped log-likelihood."""
    data = [(s, _gold(s, spans)) for text, spans in labelled_lines(seed) for s in stretches(text)]
    names = sorted({f for s, _ in data for row in s.features for f in row})
    index = {f: i + 1 for i, f in enumerate(names)}
    n, steps, states, slots = len(data), max(len(g) for _, g in data), len(STATES), len(data[0][0].features[0])
    ids, gold = np.zeros((n, steps, slots), dtype=np.int64), np.zeros((n, steps), dtype=np.int64)
    sizes = np.array([len(g) for _, g in data])
    for k, (s, g) in enumerate(data):
        ids[k, : len(g)] = [[index[f] for f in row] for row in s.features]
        gold[k, : len(g)] = g
    inside = np.arange(steps)[None] < sizes[:, None]
    one = np.eye(states)
    gold_emit = one[gold] * inside[..., None]
    gold_move = np.einsum("nti,ntj->ij", gold_emit[:, :-1], gold_emit[:, 1:])
    weights = [np.zeros((len(index) + 1, states)), np.zeros((states, states))]
    barred = np.where(ALLOWED, 0.0, BARRED)
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

    for step in range(1, rounds + 1):
        emit, move = weights[0][ids].sum(axis=2), weights[1] + barred
        forward, backward = np.zeros((steps, n, states)), np.zeros((steps, n, states))
        forward[0] = emit[:, 0] + _START
        for t in range(1, steps):
            reached = total(forward[t - 1][:, :, None] + move, 1) + emit[:, t]
            forward[t] = np.where(inside[:, t, None], reached, forward[t - 1])
        for t in range(steps - 2, -1, -1):
            reached = total(move + (emit[:, t + 1] + backward[t + 1])[:, None, :], 2)
            backward[t] = np.where(inside[:, t + 1, None], reached, 0)
        whole = total(forward[-1], 1)
        share = np.exp(forward + backward - whole[None, :, None]).transpose(1, 0, 2) * inside[..., None]
        paired = np.zeros((states, states))
        for t in range(steps - 1):
            both = forward[t][:, :, None] + move + (emit[:, t + 1] + backward[t + 1])[:, None, :] - whole[:, None, None]
            paired += np.exp(both[inside[:, t + 1]]).sum(axis=0)
        slope = np.zeros_like(weights[0])
        rest = (gold_emit - share)[inside]
        for k in range(slots):
            np.add.at(slope, ids[..., k][inside], rest)
        for k, gradient in enumerate((slope / n - damping * weights[0], (gold_move - paired) * ALLOWED / n - damping * weights[1])):
            m[k], v[k] = 0.9 * m[k] + 0.1 * gradient, 0.99 * v[k] + 0.01 * gradient**2
            weights[k] = weights[k] + 0.1 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    weights[0][0] = 0
    return Field(index, weights[0], weights[1] + barred)


def _plausible(kind: str, found: str) -> bool:
    digits = _digits(found)
    if kind == "email":
        return "." in found.partition("@")[2].strip(".")
    if kind == "ip":
        return all(p.isdecimal() and int(p) <= 255 for p in found.split(".")) and found.count(".") == 3
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 7 <= len(digits) <= 15


def field_spans(field: Field, texts: list[str], batch: int = 256) -> list[list[Span]]:
    """Spans of the best paths, those of an impossible form dropped."""
    work = [(k, s) for k, text in enumerate(texts) for s in stretches(text)]
    work.sort(key=lambda x: len(x[1]))
    out: list[list[Span]] = [[] for _ in texts]
    start = 0
    while start < len(work):
        stop = start + 1
        while stop < min(len(work), start + batch) and (stop + 1 - start) * len(work[stop][1]) <= 65_536:
            stop += 1
        part = work[start:stop]
        for (k, stretch), path in zip(part, viterbi(field, [s for _, s in part]), strict=True):
            open_span: list | None = None
            found: list[list] = []
            for state, a, b in zip(path, stretch.starts, stretch.ends, strict=True):
                name = STATES[state]
                if name.startswith("B"):
                    open_span = [name[2:], a, b]
                    found.append(open_span)
                elif name.startswith("I"):
                    open_span[2] = b
            out[k] += [(kind, a, b) for kind, a, b in found if _plausible(kind, texts[k][a:b])]
        start = stop
    return out


def all_spans(field: Field, texts: list[str]) -> Iterator[tuple[list[Span], list[Span]]]:
    """For each text its base spans, and these with the field's spans that touch none of them."""
    for text, more in zip(texts, field_spans(field, texts), strict=True):
        base = base_spans(text)
        added = [s for s, free in zip(more, untouched(more, base), strict=True) if free]
        yield base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def untouched(spans: list[Span], base: list[Span]) -> list[bool]:
    """Whether each span overlaps none of `base`: of those that start before its end, none ends after its start."""
    starts = [s[1] for s in base]
    reach = list(itertools.accumulate((s[2] for s in base), max))
    places = [bisect.bisect_left(starts, s[2]) for s in spans]
    return [k == 0 or reach[k - 1] <= s[1] for s, k in zip(spans, places, strict=True)]


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every whole text.

    A null text counts as empty: no spans, the digest of the empty string. Long texts are searched whole, in time that
    grows with their length. Repeated rows are searched each, other columns are ignored, an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = list(all_spans(shared.value, texts_of(part)))
            counts = [[sum(s[0] == kind for s in base) for base, _ in rows] for kind in KINDS]
            marks = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in rows]
            yield output(SCHEMA.names, [part.column("doc_id"), *counts, marks, [written(every) for _, every in rows]], SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def masked_text(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping ones are replaced as one."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """`docs` with personal data masked in `text`; null stays null, empty stays empty, other columns stay as they are,
    whatever their names. Whole texts are masked, however long; repeated rows stay; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw, texts = part.column("text"), texts_of(part)
            new = [masked_text(t, every) if every else t for t, (_, every) in zip(texts, all_spans(shared.value, texts), strict=True)]
            new = [t if ok else None for t, ok in zip(new, raw.is_valid().to_pylist(), strict=True)]
            columns = [*part.columns]
            columns[place] = pa.array(new, type=raw.type)
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(run, docs.schema)
