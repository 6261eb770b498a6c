import numpy as np
import pytest

from shelfwise.llm import whitening
from shelfwise.llm.bidiagonal import bidiagonalise, leading, squared_values
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.shared import table
from tests.llm.support import rows_of

VECTORS = "vec_id long, embedding array<float>, n string, component string, label int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], VECTORS)


def brute(vectors):
    """n, deviations, eigenvalues and eigenvectors of the covariance, by the textbook."""
    x = np.floor(np.array(vectors, dtype=np.float64) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return ((x * n - sums) ** 2).sum(axis=1), centred, values[::-1], directions[:, ::-1]


@pytest.mark.parametrize("shape", ["plain", "graded", "equal", "near", "rank", "blocks"])
def test_solver(shape):
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(400, 40))
    if shape == "graded":
        rows = rows * np.geomspace(1, 1e-5, 40)
    elif shape in ("equal", "near"):
        spread = np.repeat([3.0, 2.0, 1.0], [12, 18, 10]) * (1 + (1e-9 * rng.normal(size=40) if shape == "near" else 0))
        rows = spread[:, None] * np.linalg.qr(rng.normal(size=(40, 40)))[0]
    elif shape == "rank":
        rows = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 40))
    elif shape == "blocks":
        rows = np.kron(np.eye(8), rng.normal(size=(20, 5)))
    factor = np.linalg.qr(rows, mode="r")
    values, found, total = leading(factor, 25)
    k = 5 if shape == "rank" else 25
    assert len(values) == k and total == pytest.approx((rows * rows).sum())
    expected = np.linalg.svd(factor, compute_uv=False)[:k] ** 2
    assert np.abs(values / expected - 1).max() < 1e-9
    scaled = found.T @ (factor.T @ factor) @ found / np.sqrt(np.outer(values, values))
    assert np.abs(scaled - np.eye(k)).max() < 1e-8
    assert np.abs(found.T @ found - np.eye(k)).max() < 1e-8


def test_bidiagonal_form_and_values():
    r = np.linalg.qr(np.random.default_rng(3).normal(size=(50, 9)), mode="r")
    a, b, right = bidiagonalise(r)
    middle = np.diag(a) + np.diag(b, 1)
    assert np.allclose(right.T @ (r.T @ r) @ right, middle.T @ middle)
    assert np.allclose(np.sqrt(squared_values(a, b)), np.linalg.svd(r, compute_uv=False), rtol=1e-13)
    # a tiny value beside large ones is found to full relative accuracy
    assert squared_values(np.array([1.0, 1e-9, 1.0]), np.array([0.0, 0.0]))[-1] == pytest.approx(1e-18, rel=1e-14)


def test_whole_table(spark):
    data = "/root/testdata/sf0.1"
    rows = sorted((r.vec_id, list(r.embedding)) for r in table(spark, data, "embeddings").collect())
    deviations, centred, values, directions = brute([v for _, v in rows])
    found = sorted(QUERIES["op11_whitening"](spark, data).collect(), key=lambda r: (r.vec_id, r.component))
    assert [(r.vec_id, r.component) for r in found] == [(i, k) for i, _ in rows for k in range(1, 9)]
    assert {r.n for r in found} == {len(rows)}
    assert [r.deviation for r in found[::8]] == deviations.tolist()
    white = np.array([r.whitened for r in found]).reshape(-1, 8)
    expected = centred @ directions[:, :8] / np.sqrt(values[:8])
    signs = np.sign((white * expected).sum(axis=0))
    assert np.abs(white * signs - expected).max() < 1e-8
    assert np.allclose([r.explained for r in found[:8]], values[:8] / values.sum(), rtol=1e-10)
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-9
    assert np.abs(white.T @ white / len(white) - np.eye(8)).max() < 1e-9


def test_many_tasks_are_merged_in_groups(spark, monkeypatch):
    monkeypatch.setattr("shelfwise.llm.vectors.FAN", 3)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    one = rows_of(whitening.whiten(vectors_of(spark, rows).coalesce(1)))
    many = rows_of(whitening.whiten(vectors_of(spark, rows).repartition(29)))
    assert [r[:4] for r in one] == [r[:4] for r in many] and len(one) == 6 * 300
    assert np.allclose(np.abs([r[4] for r in one]), np.abs([r[4] for r in many]))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 0.5]), (2, [0.0, 1.0, 0.25]), (2, [0.0, 1.0, 0.25]), (None, [0.5, -1.0, 0.0]), (4, [3.0, 3.0, 3.0])]
    bad = [(5, None), (6, [nan, 1.0, 1.0]), (7, [inf, 1.0, 1.0]), (8, [None, 1.0, 1.0]), (9, [1.0]), (10, []), (11, [1e30, 1.0, 1.0])]
    found = rows_of(whitening.whiten(vectors_of(spark, good + bad)))
    deviations, *_ = brute([v for _, v in good])
    assert sorted((str(r[0]), r[3]) for r in found) == sorted((str(i), int(d)) for (i, _), d in zip(good, deviations, strict=True) for _ in range(3))
    assert all(r[2] == 5 and r[6] < 1e-9 for r in found)
    frame = vectors_of(spark, good)
    empty = whitening.whiten(frame.limit(0))
    assert empty.collect() == [] and empty.schema == whitening.whiten(frame).schema
    assert whitening.whiten(vectors_of(spark, bad[:4])).collect() == []
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0])] * 3)).collect() == []  # no variance
    assert len(whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [2.0, 2.0])])).collect()) == 2  # one component


def test_large_numbers_stay_exact():
    model = whitening.Whitener(1 << 30, (3 << 60, 5), np.empty((2, 0)), np.empty(0), 0.0)
    x = np.array([[1 << 38, 7]])
    deviations = model.deviations(x)
    assert deviations.tolist() == [[(1 << 68) - (3 << 60), 7 * (1 << 30) - 5]]
    assert whitening.squares(deviations) == [None]
    assert whitening.squares(np.array([[3, 4]])) == [25]
