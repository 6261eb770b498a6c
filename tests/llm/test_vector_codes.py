import hashlib

import numpy as np

from shelfwise.llm import vector_codes
from shelfwise.llm.queries import ORACLES, QUERIES
from tests.llm.support import rows_of
from tests.support import connect, duckdb_answer, spark_answer

VECTORS = "vec_id long, embedding array<float>, label int, code string, error int, part int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], VECTORS)


def brute(rows):
    """(vec_id, code, error, label_error, digest) of rows (vec_id, vector, label), in plain loops."""
    ints = [[int(np.floor(float(np.float32(c)) * 4096)) for c in v] for _, v, _ in rows]
    starts = vector_codes.starts_of(len(ints[0]), 8)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, [float(np.float32(c)) for c in rows[k][1]]))

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    books, codes, errors = [], [""] * len(rows), [0] * len(rows)
    for i, j in zip(starts[:-1], starts[1:], strict=True):
        book = [ints[k][i:j] for k in order[:16]]
        for step in range(7):
            chosen = [min(range(len(book)), key=lambda e, v=v: (far(v[i:j], book[e]), e)) for v in ints]  # noqa: B023
            if step < 6:
                members = {e: [ints[k][i:j] for k, c in enumerate(chosen) if c == e] for e in set(chosen)}
                book = [[sum(col) // len(members[e]) for col in zip(*members[e], strict=True)] if e in members else book[e] for e in range(len(book))]
        books += [x for entry in book for x in entry]
        for k, c in enumerate(chosen):
            codes[k] += f"{c:02x}"
            errors[k] += far(ints[k][i:j], book[c])
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    by_label = {}
    for (_, _, label), e in zip(rows, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    return [(rows[k][0], codes[k], errors[k], by_label[rows[k][2]], digest) for k in range(len(rows))]


def test_whole_table_against_sql(spark):
    data = "/root/testdata/sf0.01"
    got = spark_answer(QUERIES["op12_vector_codes"](spark, data))
    assert got == duckdb_answer(connect(data), ORACLES["op12_vector_codes"])


def test_copies_prefixes_and_unused_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-3, 4, size=16) / 8).tolist(), i % 3) for i in range(150)]  # parts repeat often
    rows += [(200 + i, [0.25] * 16, None) for i in range(80)]
    rows += [(1000, [0.25] * 16, 9), (-5, [9.0] * 16, 9), (-4, [9.0] * 16, None)]
    found = rows_of(vector_codes.compress(vectors_of(spark, rows).repartition(7)))
    assert found == sorted(brute(rows), key=str)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [float(k) for k in range(10)], 1), (2, [0.5] * 10, None), (2, [0.5] * 10, None), (None, [-1.0] * 10, 1), (3, [0.1] * 10, 2)]
    bad = [(4, None, 1), (5, [nan] * 10, 1), (6, [inf] * 10, 1), (7, [None] + [1.0] * 9, 1), (8, [1.0] * 9, 1), (9, [], 1), (10, [1e30] * 10, 1)]
    assert rows_of(vector_codes.compress(vectors_of(spark, good + bad))) == sorted(brute(good), key=str)
    assert vector_codes.compress(vectors_of(spark, bad[:4])).collect() == []
    empty, full = vector_codes.compress(vectors_of(spark, good).limit(0)), vector_codes.compress(vectors_of(spark, good))
    assert empty.collect() == [] and empty.dtypes == full.dtypes
    # fewer dimensions than parts: the last parts are empty and always entry 0
    short = [(1, [1.0, 2.0], 1), (2, [0.5, 3.0], 1)]
    assert rows_of(vector_codes.compress(vectors_of(spark, short))) == sorted(brute(short), key=str)
    # squares beyond a long are exact inside and null outside
    wide = [(1, [2.0**28] * 8, 1), (2, [-(2.0**28)] * 8, 1), (3, [0.0] * 8, 2)]
    assert [r[:3] for r in rows_of(vector_codes.compress(vectors_of(spark, wide)))] == [r[:3] for r in sorted(brute(wide), key=str)]


def test_walk_shares_prefixes_across_bundles(monkeypatch):
    rng = np.random.default_rng(8)
    places = np.unique(rng.integers(-2, 3, size=(500, 5)), axis=0)
    book = rng.integers(-2, 3, size=(6, 5))
    whole = ((places[:, None, :] - book[None]) ** 2).sum(axis=2)
    for bundle in (1, 2, 7, 64, 4096):
        monkeypatch.setattr(vector_codes, "BUNDLE", bundle)
        found = list(vector_codes.walk(places, book))
        assert np.concatenate([n for _, n, _ in found]).tolist() == whole.argmin(axis=1).tolist()
        assert np.concatenate([d for _, _, d in found]).tolist() == whole.min(axis=1).tolist()


def test_walk_computes_each_prefix_once(monkeypatch):
    """Nodes whose distances are computed = distinct prefixes, also across bundles."""
    places = np.array(sorted((a, b, c) for a in range(3) for b in range(4) for c in range(5)))
    prefixes = sum(len({tuple(p[: d + 1]) for p in places.tolist()}) for d in range(3))
    made = []

    class Counted(np.ndarray):
        def __pow__(self, power):
            made.append(len(self))
            return np.asarray(self) ** power

    monkeypatch.setattr(vector_codes, "BUNDLE", 7)
    book = np.zeros((2, 3), dtype=np.int64).view(Counted)
    list(vector_codes.walk(places, book))
    assert sum(made) == prefixes
