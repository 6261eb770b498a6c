import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import fingerprints
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.shared import MULT, table
from tests.llm.support import awkward, docs_of, rows_of

M = 1 << 64


def mixed(v):
    v = (v ^ (v >> 30)) * 0xBF58476D1CE4E5B9 % M
    v = (v ^ (v >> 27)) * 0x94D049BB133111EB % M
    return v ^ (v >> 31)


def paragraphs(text):
    """The paragraphs of a text, byte by byte."""
    data, out, start = text.encode(), [], 0

    def rolled(i):
        return sum((data[i - back] + 1) * pow(MULT, back + 1, M) for back in range(8)) % M

    for i in range(len(data)):
        cut = data[i] == 10 or (i >= 8 and mixed(rolled(i)) & 31 == 0 and rolled(i) != rolled(i - 1))
        if cut or i + 1 - start == fingerprints.LONGEST or i + 1 == len(data):
            out.append(data[start : i + 1])
            start = i + 1
    return out


def like(a, b):
    a, b = Counter(paragraphs(a)), Counter(paragraphs(b))
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def brute(docs):
    """(doc_id, n_chars, digest, near_edited, near_next) of (id, text) pairs in order."""
    out = []
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + after[:quarter]
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), like(text, changed), like(text, after)))
    return out


def shown(frame):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in frame.collect()]


def test_whole_table_against_brute_force(spark):
    data = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text or "") for r in table(spark, data, "documents").collect())
    found = QUERIES["op13_fingerprints"](spark, data)
    assert sorted(shown(found)) == brute(docs)
    prints = {}
    for r in found.collect():
        prints.setdefault(dict(docs)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert len(set.union(*prints.values())) == len(prints)


def test_many_ranges_give_the_same(spark, monkeypatch):
    frame = table(spark, "/root/testdata/sf0.001", "documents").repartition(5)
    wanted = rows_of(fingerprints.fingerprint(frame))
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 9)
    assert len(fingerprints.range_starts(frame)) > 10
    assert rows_of(fingerprints.fingerprint(frame)) == wanted


def test_awkward_rows(spark):
    frame = awkward(spark)
    found = fingerprints.fingerprint(frame).collect()
    assert len(found) == frame.count()
    five = [r for r in found if r.doc_id == 5]
    assert len(five) == 2 and {r.near_next for r in five} >= {1.0} and len({r.fingerprint for r in five}) == 1
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].n_chars == by_id[2].n_chars == 0 and by_id[1].near_next == 1.0
    assert by_id[None].near_next == like("text without an id is here now", "")  # the last one; the first is the null text
    assert set(by_id[1].fingerprint) == {"0"}
    assert fingerprints.fingerprint(frame.limit(0)).collect() == []
    one = shown(fingerprints.fingerprint(docs_of(spark, [(9, "abcdefgh ijkl")])))
    assert one == brute([(9, "abcdefgh ijkl")])


def test_many_equal_rows_and_one_hot_id(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 10)
    texts = [f"text {k} " * (k % 7) for k in range(60)]
    rows = [(7, "the same words again and again")] * 200 + [(8, t) for t in texts] + [(k, "tail") for k in range(20, 30)]
    found = shown(fingerprints.fingerprint(docs_of(spark, rows).repartition(6)))
    assert Counter(r[0] for r in found) == Counter(i for i, _ in rows)
    sevens = Counter(r for r in found if r[0] == 7)
    own = brute([(7, "the same words again and again")])[0]
    assert sevens[own] == 199 and len(sevens) == 2


def test_long_texts_are_cut_as_one(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcde \n") for _ in range(30_000)) + "z" * 50_000 + "".join(rng.choice("abcde ") for _ in range(9_000))
    whole = fingerprints.keys_of([text]).values
    monkeypatch.setattr(fingerprints, "BLOCK_BYTES", 20_000)
    assert fingerprints.keys_of([text]).values.tolist() == whole.tolist()
    assert fingerprints.keys_of(["", text, "x"]).starts.tolist() == [0, 0, len(whole), len(whole) + 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \né", max_size=120), min_size=1, max_size=6))
def test_cuts_and_counts(texts):
    keys = fingerprints.keys_of(texts)
    assert keys.counts(np.arange(len(texts))).tolist() == [len(paragraphs(t)) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(len(texts))]
    found = fingerprints.likeness(keys, np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
    assert np.allclose(found, [like(texts[i], texts[j]) for i, j in pairs])


def test_peeling_recovers_the_differing_digests_and_retries():
    rng = np.random.default_rng(2)
    values = [np.unique(rng.integers(0, M, size=n, dtype=np.uint64)) for n in (0, 1, 40, 3000)]
    values.append(np.sort(np.concatenate([values[3][50:], rng.integers(0, M, size=7, dtype=np.uint64)])))
    keys = fingerprints.Keys(np.cumsum([0, *map(len, values)]), np.concatenate(values))
    ours, theirs = np.array([0, 0, 1, 2, 3, 3]), np.array([0, 1, 2, 3, 4, 0])
    pair, key, sign = fingerprints.differences(keys, ours, theirs)
    for k, (a, b) in enumerate(zip(ours, theirs, strict=True)):
        a, b = set(values[a].tolist()), set(values[b].tolist())
        assert set(key[(pair == k) & (sign == 1)].tolist()) == a - b
        assert set(key[(pair == k) & (sign == -1)].tolist()) == b - a
        assert (pair == k).sum() == len(a ^ b)
    gap = fingerprints.sketched(keys, np.array([3]), fingerprints.CELLS)
    *_, whole = gap.peel()
    assert not whole[0]  # 3,000 digests don't fit in the smallest sketch
