import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import passages
from tidemark.llm.hashing import Words, word_cache

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """Per row: words, words removed, words kept."""
    split = [(key, WORD.findall(text or "")) for key, text in rows]
    least = {}
    for key, words in split:
        for i in range(len(words) - 49):
            if key is not None:
                w = tuple(words[i:i + 50])
                least[w] = min(least.get(w, key), key)
    out = []
    for key, words in split:
        gone = set()
        for i in range(len(words) - 49):
            if key is not None and least[tuple(words[i:i + 50])] < key:
                gone |= set(range(i, i + 50))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def digests(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert digests(passages.op7_passages(spark, sf_dir)) == brute(docs)


def test_random_shared_passages(spark):
    rng = random.Random(12)
    pool = [[f"w{rng.randrange(3000)}" for _ in range(rng.randint(20, 160))] for _ in range(25)]
    pool.append(["a"] * 120)
    pool.append(["x", "y", "z"] * 40)
    docs = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = list(rng.choice(pool))
            if rng.random() < 0.3:
                part[rng.randrange(len(part))] = "changed"
            lo = rng.randint(0, 15) if rng.random() < 0.5 else 0
            words += part[lo:]
            words += [f"own{rng.randrange(10 ** 6)}" for _ in range(rng.randint(0, 30))]
        docs.append((rng.choice([i, i, i, i // 2, None]), rng.choice([" ", "\n", "  \t"]).join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert digests(passages.digest(passages.without_repeats(df, joined=True))) == brute(docs)


def test_hot_passage(spark):
    common = [f"c{i}" for i in range(70)]
    docs = [(i, " ".join([f"a{i}"] * (i % 3) + common + [f"b{i}"] * (i % 5))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert digests(passages.digest(passages.without_repeats(df, joined=True))) == brute(docs)


def test_fingerprints_follow_the_words():
    cache, rng = word_cache(), random.Random(13)
    words = [rng.choice([b"a", b"b", b"c"]) for _ in range(300)]
    own = Words(words, cache)
    begin = np.array([rng.randrange(290) for _ in range(400)])
    end = np.array([b + rng.randint(1, 10) for b in begin])
    seen = {}
    for b, e, p in zip(begin, end, own.runs(begin, end).tolist()):
        assert seen.setdefault(tuple(p), words[b:e]) == words[b:e]
    assert len(seen) == len({tuple(words[b:e]) for b, e in zip(begin, end)})


def test_cut_keeps_white_space():
    text = b" a  b\n\nc d\t"
    assert passages.cut(text, [{"first": 1, "stop": 2}]) == (b" a  c d\t", 4, 1)
    assert passages.cut(text, [{"first": 0, "stop": 4}]) == (b"", 4, 4)
    assert passages.cut(text, [{"first": 0, "stop": 2}, {"first": 1, "stop": 3}]) == (b"d\t", 4, 3)
    with pytest.raises(ValueError):
        passages.cut(text, [{"first": 3, "stop": 5}])


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(1, None, 1, "a"), (2, "", 2, "b"), (None, long, 3, "c"), (4, long, 4, "d"), (4, long, 4, "d"), (5, "new " + long, 5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, spans string")
    out = passages.without_repeats(df.withColumnRenamed("n_words", "start"))
    assert out.columns == ["doc_id", "text", "start", "spans", "n_words", "n_removed"]
    assert sorted((r.doc_id or 0, r.text is None, r.n_words, r.n_removed) for r in out.collect()) == [
        (0, False, 30_000, 0), (1, True, 0, 0), (2, False, 0, 0), (4, False, 30_000, 0), (4, False, 30_000, 0), (5, False, 30_001, 30_000)]
    assert passages.without_repeats(df.where("false")).count() == 0
