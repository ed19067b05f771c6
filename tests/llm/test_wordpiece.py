import random

from tidemark.llm import wordpiece
from tidemark.llm.wordpiece import UNKNOWN, Automaton


def greedy(word, pieces, mark):
    text, at, n = mark + word, 0, 0
    while at < len(text):
        size = next((k for k in range(len(text) - at, 0, -1) if text[at:at + k] in pieces), None)
        if size is None:
            return None
        at, n = at + size, n + 1
    return n


def test_random_vocabularies_as_greedy():
    rng = random.Random(5)
    for _ in range(300):
        pieces = {"".join(rng.choice("_abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 25))}
        own = Automaton(pieces, "_")
        for _ in range(40):
            word = "".join(rng.choice("abcd" if rng.random() < 0.2 else "abc") for _ in range(rng.randint(0, 14)))
            expected = greedy(word, pieces, "_")
            assert own.count(word.encode()) == (UNKNOWN + 1 if expected is None else expected)


def test_query_as_greedy(spark, sf_dir):
    pieces = set(wordpiece.vocabulary(wordpiece.vocabulary_path()))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = wordpiece.op9_token_counts(spark, sf_dir).collect()
    assert len(out) == len(docs)
    cache = {}
    for r in out:
        words = (docs[r.doc_id] or "").encode().split()
        counts = [cache.setdefault(w, greedy(w.decode(), pieces, wordpiece.MARK)) for w in words]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(c or 1 for c in counts), counts.count(None))


def test_odd_rows(spark):
    rows = [(1, None, 1), (1, "", 2), (None, " \t\n", 3), (2, "the the", 4), (2, "the the", 4), (3, "a" * 200_000, 5), (4, "😀\U000e0101", 6)]
    out = wordpiece.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()
    seen = sorted((r.doc_id or 0, r.n_words, r.n_tokens > 0, r.n_unknown) for r in out)
    assert seen == [(0, 0, False, 0), (1, 0, False, 0), (1, 0, False, 0), (2, 2, True, 0), (2, 2, True, 0), (3, 1, True, 0), (4, 1, True, 1)]
    assert wordpiece.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
