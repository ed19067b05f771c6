import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.whitening import whitened


def brute(rows, count=16):
    """Whitened rows, each component up to its sign, by a plain eigenvalue routine."""
    x = np.floor(64 * np.array(rows)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    y = fit - sums / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    return n, [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x], (x - sums / n) @ vectors / np.sqrt(values), values / np.trace(v)


def compare(out, ids, rows, count=16):
    n, deviation, white, explained = brute(rows, count)
    by_row = {}
    for r in out:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    assert set(by_row) == set(ids) and all(sorted(c) == list(range(1, white.shape[1] + 1)) for c in by_row.values())
    found = np.array([[by_row[i][c + 1].whitened for c in range(white.shape[1])] for i in ids])
    signs = np.sign((found * white).sum(0))
    assert np.abs(found - white * signs).max() < 1e-6
    for i, d in zip(ids, deviation):
        r = by_row[i][1]
        assert (r.n, int(r.deviation)) == (n, d)
    assert np.allclose([by_row[ids[0]][c + 1].explained for c in range(white.shape[1])], explained, rtol=1e-9)
    assert {r.identity_error for r in out} == {out[0].identity_error} and out[0].identity_error < 1e-9


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    compare(whitening.op12_whitening(spark, sf_dir).collect(), [r.vec_id for r in table], [r.embedding for r in table])


def test_copies_count_once_in_the_fit(spark):
    rng = np.random.default_rng(2)
    some = rng.normal(size=(40, 5)) * [9, 5, 3, 2, 1]
    rows = np.concatenate((some, np.repeat(some[:1], 500, 0)))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    compare(whitened(df).collect(), list(range(len(rows))), rows)
    compare(whitened(df, count=2).collect(), list(range(len(rows))), rows, 2)


@pytest.mark.parametrize("values", [
    [1, 2, 3], [1, 1, 1, 5], [0, 0, 0], [7], [1e6, *[1] * 20, *[0] * 20], np.logspace(0, -12, 30),
    np.r_[np.ones(20), 1 + 1e-13 * np.arange(10)], [1, 2, 2, 2, 3], [-1, 0, 1]])
def test_divide_and_conquer(values):
    n = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))
    for turn in (np.eye(n), q):
        v = turn @ np.diag(values) @ turn.T
        size = max(np.linalg.norm(v), 1e-300)
        found, vectors = whitening.components(v, min(n, 16))
        assert np.abs(found - np.sort(values)[::-1][:16]).max() <= 1e-13 * max(size, 1)
        assert np.abs(v @ vectors - vectors * found).max() <= 1e-13 * max(size, 1)
        assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-13


def test_polar_factor():
    a = np.random.default_rng(3).normal(size=(30, 30))
    u, _, v = np.linalg.svd(a)
    assert np.abs(whitening.polar(a) - u @ v).max() < 1e-12
    assert (whitening.polar(np.zeros((3, 3))) == np.eye(3)).all()


def test_odd_rows(spark):
    good = [[0.5, 1.0, 0.0], [0.25, -1.0, 2.0], [0.5, 1.0, 0.0], [1.0], [], [3.0, 0.0, 1e3]]
    bad = [None, [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1e300, 0.0, 0.0]]
    rows = [(i, v, 1.5, "s") for i, v in enumerate(good)] + [(None, good[0], 1.5, "s")] + [(100 + i, v, 1.5, "s") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened double, x string")
    out = whitened(df).collect()
    compare([r for r in out if r.vec_id is not None], list(range(len(good))), [v + [0.0] * (3 - len(v)) for v in good])
    assert sorted((r.component, r.whitened) for r in out if r.vec_id is None) == sorted((r.component, r.whitened) for r in out if r.vec_id == 0)
    for few in (df.where("false"), df.where("vec_id >= 100"), df.where("vec_id = 1"), df.where("vec_id in (0, 2)"), df.where("vec_id = 4")):
        assert whitened(few).count() == 0
    two = whitened(df.where("vec_id in (0, 1)")).collect()  # one direction varies
    assert [(r.component, round(abs(r.whitened), 9)) for r in two] == [(1, 1.0)] * 2


def test_deviation_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [2.0 ** 50]), (1, [0.0]), (2, [1.0])], "vec_id long, embedding array<double>")
    exact = {r.vec_id: int(r.deviation) for r in whitened(df).collect()}
    x = [64 << 50, 0, 64]
    assert exact == {i: (3 * v - sum(x)) ** 2 for i, v in enumerate(x)}
