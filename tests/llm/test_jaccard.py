import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm.components import components
from tidemark.llm.jaccard import choose_bands, near_copies


def shingle_set(text):
    words = (text or "").encode().split()
    k = min(5, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute(texts, threshold=0.8):
    """Links per row and least index of each group."""
    sets = [shingle_set(t) for t in texts]
    links, head = [0] * len(texts), list(range(len(texts)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {p for members in by.values() for p in combinations(members, 2)}
    for i, j in pairs:
        if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
            links[i], links[j] = links[i] + 1, links[j] + 1
            a, b = sorted((find(i), find(j)))
            head[b] = a
    return links, [find(i) for i in range(len(texts))]


def check(rows, ids, texts):
    links, heads = brute(texts)
    assert len(rows) == len(texts)
    out = {r.doc_id: r for r in rows}
    for i, key in enumerate(ids):
        assert (out[key].n_links, out[key].class_id) == (links[i], ids[heads[i]]), key
        assert out[key].kept == (heads[i] == i)


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = choose_bands(threshold, 0.99, 256)
        assert 1 - (1 - threshold ** rows) ** bands >= 0.99 and bands * rows <= 256
    with pytest.raises(ValueError):
        choose_bands(0.1, 0.999, 10)


def test_components_of_random_edges(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(200)] + [(7, 5000 + i) for i in range(300)]
    head = {}

    def find(x):
        while head.setdefault(x, x) != x:
            x = head[x]
        return x

    for a, b in edges:
        head[max(find(a), find(b))] = min(find(a), find(b))
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert set(out) == nodes
    groups = {}
    for x in nodes:
        groups.setdefault(out[x], set()).add(find(x))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({find(x) for x in nodes})
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def near_texts(rng, n):
    base = [f"w{i}" for i in range(90)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        out.append(" ".join(words))
    return out


def test_query(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    check(jaccard.op10_near_copies(spark, sf_dir).collect(), [d.doc_id for d in docs], [d.text for d in docs])


def test_hot_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 8)
    texts = near_texts(random.Random(10), 60) + ["a b c d e f g"] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # Pairs at 0.8 exactly may be missed once in a thousand; with ample bands none is here.
    check(near_copies(df, recall=0.999999, hashes=400).collect(), list(range(len(texts))), texts)


def test_linked_pairs_as_sets():
    rng = np.random.default_rng(11)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25)).astype(np.uint64)) for _ in range(40)]
    for first in (0, 15):
        near = jaccard.linked(sets, first, 0.5)
        for i, j in combinations(range(40), 2):
            s, t = set(sets[i].tolist()), set(sets[j].tolist())
            apart = first and (i < first) == (j < first)
            assert near[i, j] == near[j, i] == (not apart and len(s & t) / len(s | t) >= 0.5)


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(50_000))
    rows = [(1, None, 1, "a"), (2, "", 2, "b"), (None, "one two", 3, "c"), (4, "one two", 4, "d"), (4, "one two", 4, "d"),
            (None, None, 5, "e"), (7, long, 6, "f"), (8, long + " end", 7, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_links int, class_id string")
    out = sorted(((r.doc_id or 0, r.class_id or 0, r.n_links, r.kept) for r in near_copies(df).collect()))
    assert out == [(0, 0, 0, True), (0, 4, 2, False), (1, 1, 0, True), (2, 2, 0, True), (4, 4, 2, False), (4, 4, 2, True), (7, 7, 1, True), (8, 7, 1, False)]
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(kept.agg(F.collect_list("n_links")).first()[0]) == [1, 2, 4, 5, 6]
    assert near_copies(df.where("false")).count() == 0
    assert jaccard.one_of_each(df.where("false")).count() == 0
