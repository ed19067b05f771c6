import math

import numpy as np

from tidemark.llm import vectors
from tidemark.llm.vectors import near_duplicates


def brute(ids, data, threshold=0.9):
    """Links per row and least id of its component."""
    good = [v is not None and len(v) > 0 and None not in v and all(map(math.isfinite, v)) and any(v) for v in data]
    width = max((len(v) for v, g in zip(data, good) if g), default=0)
    x = np.array([list(v) + [0.0] * (width - len(v)) if g else [0.0] * width for v, g in zip(data, good)], float)
    norm = np.linalg.norm(x, axis=1)
    x = x / np.where(norm, norm, 1)[:, None]
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    head = np.arange(len(ids))
    while True:
        seen = np.minimum(head, np.where(near, head[None, :], len(ids)).min(1, initial=len(ids)))
        if (seen == head).all():
            break
        head = seen
    return near, [min(ids[j] for j in np.flatnonzero(head == h)) for h in head]


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = [r.vec_id for r in table]
    near, component = brute(ids, [r.embedding for r in table])
    out = {r.vec_id: r for r in vectors.op8_vectors(spark, sf_dir).collect()}
    assert len(out) == len(ids)
    for i, key in enumerate(ids):
        assert (out[key].n_links, out[key].component_id, out[key].kept) == (near[i].sum(), component[i], key == component[i])


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(15)
    base = rng.normal(size=(400, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cos = rng.uniform(0.9001, 0.93, 400)[:, None]
    data = np.concatenate((base, cos * base + np.sqrt(1 - cos ** 2) * away))
    near, _ = brute(list(range(800)), data.tolist())
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    out = near_duplicates(df).collect()
    assert 0.9 * near.sum() <= sum(r.n_links for r in out) <= near.sum()
    assert all(r.n_links <= near[r.vec_id].sum() for r in out)


def test_crowd_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(16)
    centre = rng.normal(size=24)
    data = [(centre + 0.05 * rng.normal(size=24)).tolist() for _ in range(150)] + [centre.tolist()] * 30 + rng.normal(size=(200, 24)).tolist()
    ids = list(range(len(data)))
    near, component = brute(ids, data)
    df = spark.createDataFrame(list(zip(ids, data)), "vec_id long, embedding array<double>")
    out = {r.vec_id: r for r in near_duplicates(df).collect()}
    assert all((out[i].n_links, out[i].component_id) == (near[i].sum(), component[i]) for i in range(180))


def test_odd_rows(spark):
    a = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]),
            (7, a), (8, a), (8, a), (None, a), (9, [2.0, 4.0, 6.0]), (10, [5.0]), (11, [5.0, 0.0, -0.0]), (12, [-1.0, 1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, n_links int, key string")
    out = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert out == [(0, 4, 7, False), *((i, 0, i, True) for i in range(1, 7)), (7, 4, 7, True), (8, 4, 7, False), (8, 4, 7, False),
                   (9, 4, 7, False), (10, 1, 10, True), (11, 1, 10, False), (12, 0, 12, True)]
    assert near_duplicates(df.where("false")).count() == 0
    assert [r.n_links for r in near_duplicates(df.where("vec_id = 8")).collect()] == [1, 1]


def test_shorter_substrings_where_codes_do_not_reach():
    x = np.random.default_rng(21).normal(size=(600, 24))
    tables = vectors.learn(x / np.linalg.norm(x, axis=1, keepdims=True), 20_000_000, threshold=0.85)
    assert len(tables.codes) == vectors.MOST_CODES and tables.bits < 20
