import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import ann
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.shared import table
from tests.llm.support import rows_of


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 7, 7) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")


def brute(rows, queries, k):
    out = []
    for q in queries:
        near = sorted((-sum(float(np.float32(a)) * float(np.float32(b)) for a, b in zip(v, dict(rows)[q], strict=True)), i) for i, v in rows if i != q)
        out += [(q, n + 1, i) for n, (_, i) in enumerate(near[:k])]
    return out


@pytest.mark.parametrize("data", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall(spark, data):
    rows = table(spark, data, "embeddings").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    found = {}
    for r in QUERIES["op9_neighbours"](spark, data).collect():
        found.setdefault(r.query_id, []).append(r)
    queries = [k for k, i in enumerate(ids) if i % 20 == 0]
    assert sorted(found) == ids[queries].tolist()
    hits = 0
    for k in queries:
        scores = x @ x[k]
        scores[k] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        got = sorted(found[ids[k]], key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        assert all(abs(r.score - x[np.searchsorted(ids, r.vec_id)] @ x[k]) < 1e-12 for r in got)
        hits += len({r.vec_id for r in got} & set(best.tolist()))
    assert hits >= 0.9 * 20 * len(queries)


def test_every_code_within_the_radius_is_retrieved():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32))
    coder = ann.fit(x[:500], float(np.sqrt((x**2).sum(axis=1).max())))
    block = ann.Block(np.arange(3000), x, coder, 20)
    for q in range(5):
        code = coder.codes(x[q : q + 1])[0]
        for reach in (0, 15, 40, 90, 110, 256):
            assert block.within(code, reach).tolist() == np.flatnonzero(ann.distances(code, block.codes) <= reach).tolist()


def test_norms_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * (1 + i % 5)).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(70)]
    found = [r[:3] for r in sorted(map(tuple, ann.search(vectors_of(spark, rows).repartition(4), lambda v: v % 20 == 0).collect()))]
    assert found == sorted(brute(rows, [i for i, _ in rows if i % 20 == 0], 20))


def test_awkward_rows(spark):
    good = [1.0, 2.0]
    rows = [(0, good), (0, good), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (100, [None, 1.0]), (120, [1.0, 2.0, 3.0]), (None, good), (1, [3.0, 4.0]), (2, [1.0, 0.0]), (140, [])]
    frame = vectors_of(spark, rows)
    assert rows_of(ann.search(frame, lambda v: v % 20 == 0)) == [(0, 1, 1, 11.0), (0, 2, 2, 1.0)]
    assert rows_of(ann.search(frame.limit(0), lambda v: v % 20 == 0)) == []
    assert rows_of(ann.search(frame, lambda v: v < 0)) == []
    assert rows_of(ann.search(vectors_of(spark, [(0, good)]), lambda v: v == 0)) == []


def test_groups_of_queries_give_the_same(spark, monkeypatch):
    frame = table(spark, "/root/testdata/sf0.001", "embeddings")
    wanted = rows_of(ann.search(frame, lambda v: v % 20 == 0))
    monkeypatch.setattr(ann, "QUERY_GROUP", 7)
    monkeypatch.setattr(ann, "LEAST_GROUP", 3)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 60)
    assert rows_of(ann.search(frame, lambda v: v % 20 == 0)) == wanted


def test_the_radius_grows_until_enough_are_found(spark, monkeypatch):
    """Each query starts with a radius that holds nothing but its own code."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(400)]
    monkeypatch.setattr(ann, "radius", lambda code, sample, wanted: 0)
    monkeypatch.setattr(ann, "place_holding", lambda *_: 1)
    coded = ann._coded
    monkeypatch.setattr(ann, "_coded", lambda *a: coded(*a).withColumn("reach", F.lit(0)))
    found = ann.search(vectors_of(spark, rows), lambda v: v % 20 == 0).collect()
    per_query = {}
    for r in found:
        per_query.setdefault(r.query_id, []).append(r.rank)
    assert sorted(per_query) == list(range(0, 400, 20))
    assert all(sorted(ranks) == list(range(1, 21)) for ranks in per_query.values())


def test_look_ups_retrieve_few_rows_of_clustered_vectors():
    """Near copies of 200 centres: look-ups at the needed radius reach a few hundredths of the rows, and find all of them."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(200, 64))
    x = np.repeat(centres, 80, axis=0) + rng.normal(size=(16_000, 64)) * 0.1
    coder = ann.fit(x[::4], float(np.sqrt((x**2).sum(axis=1).max())))
    block = ann.Block(np.arange(len(x)), x, coder, 20)
    for q in range(0, 16_000, 800):
        code = coder.codes(x[q : q + 1])[0]
        exact = np.argsort(-(x @ x[q]))[:20]
        reach = int(np.sort(ann.distances(code, coder.codes(x[exact])))[-1])
        assert block.by_lookup(reach)
        assert block.within(code, reach).tolist() == np.flatnonzero(ann.distances(code, block.codes) <= reach).tolist()
    assert block.probed < 0.1 * 20 * len(x)


def test_recall_does_not_fall_as_the_table_grows(spark, tmp_path):
    x = np.random.default_rng(4).normal(size=(100_000, 64)).astype(np.float32)
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.FixedSizeListArray.from_arrays(x.ravel(), 64).cast(pa.list_(pa.float32()))}), tmp_path / "x.parquet")
    found = {}
    for r in ann.search(spark.read.parquet(str(tmp_path / "x.parquet")), lambda v: v % 200 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    x, hits = x.astype(np.float64), 0
    for q in range(0, len(x), 200):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(found[q] & set(np.argpartition(-scores, 20)[:20].tolist()))
    assert hits >= 0.94 * 20 * len(found)


def test_the_place_holds_the_share():
    rng = np.random.default_rng(6)
    codes, sample = rng.integers(0, 1 << 16, (30, 16), dtype=np.uint16), rng.integers(0, 1 << 16, (500, 16), dtype=np.uint16)
    far = [rng.integers(90, 125, 20) for _ in codes]
    place = ann.place_holding(0.9, codes, far, sample)
    held = [sum((f <= ann.radius(c, sample, p)).sum() for c, f in zip(codes, far, strict=True)) for p in (place - 1, place)]
    assert held[0] < 0.9 * 600 <= held[1]
    assert ann.radius(codes[0], sample, ann.place_holding(0.9, codes, [np.array([256])] * 30, sample)) == ann.BITS
