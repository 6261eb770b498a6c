import collections
import math

import numpy as np
import pytest

from shelfwise.llm import neardup
from shelfwise.llm.components import components
from shelfwise.llm.shared import shingle_counts, table, word_hashes
from tests.llm.support import awkward, docs_of, rows_of


def words_of(text):
    import re

    return re.findall(r"[0-9a-z_\u0080-\U0010ffff]+", text.lower())


def shingles_of(text):
    w = words_of(text)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def union_find(nodes, edges):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        up[high] = low
    return {n: top(n) for n in nodes}


def test_shingle_counts_equal_plain_counting():
    texts = ["a b c d e f", "A, b! c d e f", "", "x y", "a b c d e a b c d e a b c d e", "é É é ü x_1 Z"]
    owner, hashes, counts = shingle_counts(texts, 5)
    for k, text in enumerate(texts):
        assert sorted(counts[owner == k].tolist()) == sorted(shingles_of(text).values())
    assert set(hashes[owner == 0]) == set(hashes[owner == 1])
    assert len(word_hashes(["%% $$", " "])[0]) == 1


@pytest.mark.parametrize("share", [0.3, 0.6, 0.8, 0.95])
def test_samples_agree_as_often_as_weights_overlap(share):
    rng = np.random.default_rng(3)
    agree = []
    similar = []
    for _ in range(60):
        h = rng.integers(0, 1 << 63, size=200, dtype=np.uint64)
        w = rng.gamma(2.0, size=200).astype(np.float32) + np.float32(0.1)
        cut = int(200 * share)
        other = np.r_[h[:cut], rng.integers(0, 1 << 63, size=200 - cut, dtype=np.uint64)]
        a, b = neardup.samples(h, w, np.array([0]))[0], neardup.samples(other, w, np.array([0]))[0]
        agree.append((a == b).mean())
        i, j = np.argsort(h), np.argsort(other)
        similar.append(neardup.similarity((h[i], w[i]), (other[j], w[j])))
    assert abs(np.mean(agree) - np.mean(similar)) < 0.05


def test_classes_equal_all_pairs(spark):
    """Every pair of the small table by exact document frequencies of the shared table's entries."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    idf = neardup.inverse_frequencies(docs)
    ids = sorted(texts)
    owner, hashes, _, weights = neardup.weighted([texts[i] for i in ids], idf)
    sets = {i: (hashes[owner == k], weights[owner == k]) for k, i in enumerate(ids)}
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if neardup.similarity(sets[a], sets[b]) >= 0.8]
    assert links
    assert dict(rows_of(neardup.classes(docs))) == union_find(ids, links)


def test_document_frequencies_cover_all_rows(spark):
    docs = docs_of(spark, ["a b c d e", "a b c d e", "v w x y z", None, ""]).repartition(3)
    idf = neardup.inverse_frequencies(docs)
    for text, df in (("a b c d e", 2), ("v w x y z", 1)):
        assert math.isclose(idf[neardup._bucket(shingle_counts([text], 5)[1])[0]], 1 + 0.25 * math.log(4 / (df + 1)) / math.log(4), rel_tol=1e-6)


def test_a_large_group_of_copies_and_near_copies_is_one_class(spark):
    base = [f"w{k}" for k in range(300)]
    near = [" ".join(base[: 3 * k] + [f"other{k}"] + base[3 * k + 1 :]) for k in range(60)]
    far = [" ".join(f"u{k}x{i}" for i in range(80)) + " " + " ".join(base[:40]) for k in range(40)]
    docs = docs_of(spark, [" ".join(base)] * 50 + near + far)
    found = dict(rows_of(neardup.classes(docs)))
    assert {found[k] for k in range(110)} == {0}
    assert all(found[k] == k for k in range(110, 150))


def test_prefix_buckets_miss_no_pair(spark):
    """Without pivots every link between different texts comes from the prefix buckets; repeated rows change nothing."""
    import random

    rng = random.Random(8)
    texts = []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(60)]
        for _ in range(14):
            words = list(base)
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(60)] = f"x{rng.random()}"
            texts.append(" ".join(words) + (" some line that all of them share" if rng.random() < 0.7 else ""))
    docs = docs_of(spark, texts)
    idf = neardup.inverse_frequencies(docs)
    owner, hashes, _, weights = neardup.weighted(texts, idf)
    sets = [(hashes[owner == k], weights[owner == k]) for k in range(len(texts))]
    similar = {(a, b) for b in range(len(texts)) for a in range(b) if texts[a] != texts[b] and neardup.similarity(sets[a], sets[b]) >= 0.8}
    assert len(similar) > 30
    ids = spark.range(len(texts)).withColumnRenamed("id", "doc_id")
    nothing = ids.limit(0)
    shared = spark.sparkContext.broadcast(idf)
    thirds = ids.where("doc_id % 3 = 0")
    for frame, repeated in ((docs, nothing), (docs.union(docs.where("doc_id % 3 = 0")), thirds)):
        rows = neardup.prefix_buckets(frame, (ids, len(texts)), (repeated, repeated.count()), shared)
        pairs = set(map(tuple, neardup._cross_pairs(rows.withColumn("component", rows["rep"])).collect()))
        assert similar <= pairs


def test_awkward_rows(spark):
    rows = awkward(spark)
    found = neardup.classes(rows).collect()
    assert len(found) == rows.count()
    assert {(r.doc_id, r.class_id) for r in found} == {(1, 1), (2, 2), (3, 3), (None, None), (5, 5), (6, 6), (7, 7)}
    assert neardup.classes(rows.limit(0)).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 20), (30, 31), (31, 30), (30, 31)] + [(100 + k, 101 + k) for k in range(40)]
    frame = spark.createDataFrame(edges, "a long, b long")
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert dict(rows_of(components(frame))) == union_find(nodes, [e for e in edges if e[0] != e[1]])
    assert components(frame.limit(0)).count() == 0
