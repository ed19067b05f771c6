import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical
from tidemark.llm.hashing import filed
from tidemark.llm.lexical import search, term_counts

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items):
    """Rows of the contract: every document scored for every item."""
    counts = [(i, Counter(PATTERN.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df, out = Counter(t for _, c in counts for t in c), []
    for item, text in items:
        scores = []
        for i, c in counts:
            m, score = 25 + 75 * sum(c.values()) * n // total, 0
            for t in PATTERN.findall((text or "").translate(LOWER)):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:10], 1)]
    return sorted(out)


def random_texts(n, seed, words=120):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(words)] + ["Straße", "北京", "ÀB", "é9"]
    return [" ".join(rng.choices(pool, [1 / (i + 1) for i in range(len(pool))], k=rng.choice([1, 5, 40, 300]))) for _ in range(n)]


def found(docs, items):
    return sorted(tuple(r) for r in search(docs, items).select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("pairs", [100_000, 7])
def test_equals_brute_force(spark, monkeypatch, pairs):
    """Also with items in many blocks, and documents in blocks of eight."""
    monkeypatch.setattr(lexical, "PAIRS", pairs)
    if pairs == 7:
        monkeypatch.setattr(lexical, "BLOCK_DOCS", 8)
    docs = list(enumerate(random_texts(300, 1)))
    items = list(enumerate(random_texts(5, 2)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert found(*frames) == brute(docs, items)


def test_poor_signatures_cost_time_only(spark, monkeypatch):
    monkeypatch.setattr(lexical, "WIDTH", 1)
    docs, items = list(enumerate(random_texts(120, 3))), list(enumerate(random_texts(4, 4)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert found(*frames) == brute(docs, items)


def test_bounds_are_never_below_scores():
    docs = random_texts(200, 5)
    items = lexical.Items([], [], [])
    terms = {}
    for i, text in enumerate(random_texts(6, 6)):
        items.counts.append({terms.setdefault(t, len(terms)): n for t, n in term_counts(text.encode()).items()})
        items.ids.append(i)
    items.terms = list(terms)
    counts = [term_counts(t.encode()) for t in docs]
    sizes = np.array([sum(c.values()) for c in counts])
    items.weigh(len(docs), int(sizes.sum()), dict(Counter(t for c in counts for t in c)))
    import pyarrow as pa

    zeros = pa.array([0] * len(docs))
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in docs]), zeros, pa.array(range(len(docs)))], names=["_text", "_file", "_at"])
    bounds, seen = lexical._Bounds(items, [1] * 6), {}
    for row in lexical._Index()([batch]):
        for out in bounds([row]):
            for item, at, bound in zip(*(out.column(c).to_pylist() for c in ("item", "at", "bound"))):
                seen[item, at] = bound
    for item in range(6):
        for at, (count, size) in enumerate(zip(counts, sizes.tolist())):
            assert seen.get((item, at), 0) >= items.score(item, count, size)


def test_few_documents_are_scored_exactly(spark, sf_dir):
    docs = filed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    (items,) = lexical._item_blocks(spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr("item_id", "text as _text"))
    index = lexical.stored(lexical.signatures(docs), "t")
    frame = docs.selectExpr("text as _text")
    df = {bytes(r.term): r.n for r in frame.mapInArrow(lexical._Frequencies(items.terms), "term binary, n long").collect()}
    sizes = [n for r in index.select("sizes").collect() for n in r.sizes]
    items.weigh(len(sizes), sum(sizes), df)
    best = search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("rank = 10").collect()
    at = {i: r.score for r in best for i, k in enumerate(items.ids) if k == r.item_id}
    bounds = lexical._Bounds(items, [at.get(i, 0) for i in range(len(items.ids))])
    candidates = index.mapInArrow(bounds, "item int, file long, at long, bound long").count()
    assert 10 * len(at) <= candidates < 20 * len(items.ids)


def test_odd_rows(spark):
    long = "alpha " * 200_000 + "x" * 3_000_000 + " beta"
    docs = [(1, None), (2, ""), (3, "... -- !"), (4, "Alpha beta"), (4, "Alpha beta"), (None, "ALPHA beta"), (5, "alpha gamma"), (6, long), (7, "delta")]
    items = [(1, "alpha Beta"), (1, "alpha Beta"), (2, None), (3, "nowhere"), (None, "gamma, gamma")]
    df = spark.createDataFrame([(*r, 9, "s") for r in docs], "doc_id long, text string, _text int, item string")
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, score int")
    out = [tuple(r) for r in search(df, asked).collect()]
    once = sorted((r, str(d)) for i, r, d, s in out if i == 1)
    assert len(once) == 10 and {d for _, d in once} == {"None", "4", "5", "6"}
    scores = {r: s for i, r, d, s in out if i == 1}
    assert [d for i, r, d, s in sorted(out, key=lambda x: x[1]) if i == 1][:2] == [None, None] and scores[1] == scores[3]
    assert [(i, r, d) for i, r, d, s in out if i != 1] == [(None, 1, 5)]
    want = {(i, s) for k, r, i, s in brute([(k or 0, t) for k, t in docs], [(1, "alpha Beta")])}
    assert {(d or 0, s) for i, r, d, s in out if i == 1} == want
    assert search(df.where("false"), asked).count() == 0 and search(df, asked.where("false")).count() == 0
    assert search(df.where("doc_id < 4"), asked).count() == 0


def test_terms_of_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 16)
    for text in random_texts(40, 7) + ["a" * 100, " " * 50, "a" * 15 + " b", "a" * 16 + " b"]:
        assert term_counts(text.encode()) == Counter(t.encode() for t in PATTERN.findall(text.translate(LOWER)))
