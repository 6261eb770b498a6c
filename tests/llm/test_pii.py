import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import pii
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.shared import table
from tests.llm.support import SF_DIR, awkward

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["@", "a", "1", ".", "-", "+", " ", "12", "255", "256", "b.c", "@x.y", "(", "٣", "4539 1488 0343 6467"]), max_size=16).map("".join))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_query_rows_equal_the_plain_patterns(spark):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in table(spark, SF_DIR, "documents").collect()}
    found = QUERIES["op1_pii"](spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == kind for s in base) for kind in pii.KINDS]
        assert set(filter(None, pii.written(base).split(","))) <= set(r.spans.split(","))


def test_long_runs_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 50_000, "1." * 50_000):
        pii.base_spans(text)
    assert pii.base_spans("1" * 200_000 + " 10.0.0.1")[-1] == ("ip", 200_001, 200_009)


def test_field_on_lines_it_has_not_seen():
    field = pii.train()
    lines = pii.labelled_lines(seed=99, n=300)
    found = pii.field_spans(field, [text for text, _ in lines])
    right = sum(len(set(a) & set(b)) for a, (_, b) in zip(found, lines, strict=True))
    assert right >= 0.95 * sum(len(spans) for _, spans in lines)
    assert right >= 0.97 * sum(map(len, found))


def test_field_adds_what_the_patterns_miss():
    (base, every), = pii.all_spans(pii.train(), ["call (415) 555-3436 today"])
    assert base == [] and every == [("phone", 5, 19)]


def test_look_alikes_stay_clean():
    texts = ["Apache License, Version 2.0.", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "CC BY-NC 4.0", "on 2024-01-12 at 10:45", "card 1234567890123456"]
    assert [every for _, every in pii.all_spans(pii.train(), texts)] == [[]] * 5


def best_path(field, stretch):
    """The best path over every path of a short stretch."""
    import itertools

    scores = field.scores([stretch])[0]
    n = len(stretch.spans)

    def worth(path):
        return pii._START[path[0]] + scores[0][path[0]] + sum(field.move[a][b] + scores[t][b] for t, (a, b) in enumerate(zip(path, path[1:]), 1))

    return max(worth(p) for p in itertools.product(range(len(pii.STATES)), repeat=n)), worth


@pytest.mark.parametrize("text", ["1.2.3", "a1@b", "+1 22", "(2) 3"])
def test_viterbi_finds_the_best_of_all_paths(text):
    field = pii.train()
    stretch = pii.stretches(text)[0]
    best, worth = best_path(field, stretch)
    padded = pii.stretches("10.0.0.1 and 5")
    path = pii.viterbi(field, [stretch, *padded])[0]
    assert abs(worth(path) - best) < 1e-9


def test_awkward_rows(spark):
    rows = awkward(spark)
    field = pii.train()
    found = pii.find(rows, field)
    assert found.count() == rows.count()
    assert {r.spans for r in found.where("doc_id in (1, 2, 3)").collect()} == {""}
    assert pii.find(rows.limit(0), field).count() == 0
    masked = pii.mask(rows, field)
    assert masked.columns == rows.columns and masked.count() == rows.count()
    assert masked.where("doc_id = 1").first().text is None


def test_masking():
    assert pii.masked_text("a x@y.z b 10.0.0.1", [("email", 2, 7), ("ip", 10, 18)]) == "a [email] b [ip]"
    rng = random.Random(0)
    text = " ".join(str(rng.random()) for _ in range(5))
    assert pii.masked_text(text, []) == text


def test_a_million_characters_of_numbers_stay_linear():
    """Twice the numbers take about twice the time, in the field and in merging the spans."""
    field = pii.train()

    def seconds(text):
        start = time.perf_counter()
        found = list(pii.all_spans(field, [text]))
        return time.perf_counter() - start, found

    for make in (lambda n: " ".join(str(k * 7919 % 100_003) for k in range(n)), lambda n: " ".join(f"a{k}@b.com" for k in range(n // 4))):
        (short, _), (long, found) = seconds(make(40_000)), seconds(make(160_000))
        assert long < 9 * short + 1
        assert all(s[2] - s[1] > 0 for s in found[0][1])


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 6)), max_size=8), st.lists(st.tuples(st.integers(0, 40), st.integers(1, 6)), max_size=8))
def test_overlaps_equal_all_pairs(spans, base):
    spans, base = ([("ip", a, a + n) for a, n in sorted(x)] for x in (spans, base))
    assert pii.untouched(spans, base) == [all(s[2] <= b[1] or b[2] <= s[1] for b in base) for s in spans]


def test_one_long_stretch_has_the_same_path_alone_and_in_a_batch():
    field = pii.train()
    lines = " ".join(text for text, _ in pii.labelled_lines(seed=5, n=200))
    found = pii.stretches(lines)
    joined = pii.stretches(" ".join(text.replace("\n", " ") for text, _ in pii.labelled_lines(seed=6, n=40) if not text.isalpha()))
    for stretch in [*found[:40], *joined]:
        alone = pii._one_path(field, stretch)
        assert pii.viterbi(field, [stretch, stretch])[0] == alone
        assert np.allclose(field.scores([stretch])[0], [[sum(field.emit[field.index.get(f, 0), k] for f in row) for k in range(len(pii.STATES))] for row in stretch.features])
