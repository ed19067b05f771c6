from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import bpe
from tidemark.llm.common import stored, table
from test_jaccard import brute as near_groups
from test_passages import WORD
from test_quality_forest import plain as base_counts


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The documents before and after each stage, and the last stage's result."""
    docs, out = table(spark, sf_dir, "documents"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "step")
        out.append(docs)
    return [d.collect() for d in out]


def ids(rows):
    return Counter(r.doc_id for r in rows)


def test_filters_keep_rows_as_they_came(steps):
    for before, after in zip(steps[:3], steps[1:4]):
        known = Counter(map(tuple, before))
        assert not Counter(map(tuple, after)) - known and after


def test_language_and_quality(steps):
    assert all(any(map(str.isalpha, r.text)) for r in steps[1])
    assert len(steps[1]) >= 0.99 * len(steps[0])
    for r in steps[1]:
        n, *_, repeated = base_counts(r.text)
        if n < 50 or 100 * repeated > 50 * n:
            assert r.doc_id not in ids(steps[2])


def test_one_of_each_group(steps):
    rows = sorted(steps[2], key=lambda r: r.doc_id)
    _, heads = near_groups([r.text for r in rows])
    assert ids(steps[3]) == Counter(rows[h].doc_id for h in set(heads))


def test_no_passage_is_left_twice(steps):
    rows = {r.doc_id: r for r in steps[3]}
    assert set(ids(steps[4])) <= set(rows)
    for r in steps[4]:
        if r.text == rows[r.doc_id].text:
            assert r == rows[r.doc_id]
        else:
            assert r.n_chars == len(r.text)
    first = {}
    for r in sorted(steps[3], key=lambda r: r.doc_id):
        words = WORD.findall(r.text)
        gone = set()
        for i in range(len(words) - 49):
            if first.setdefault(tuple(words[i:i + 50]), r.doc_id) < r.doc_id:
                gone |= set(range(i, i + 50))
        left = [w for i, w in enumerate(words) if i not in gone]
        found = [WORD.findall(x.text) for x in steps[4] if x.doc_id == r.doc_id]
        assert found == ([left] if left or not words else [])


def test_packed_pieces_hold_all_tokens(steps):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    sizes = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in steps[4]}
    total = Counter()
    for p in steps[5]:
        total[p.doc_id] += p.length
    assert total == sizes


def test_run_gives_the_last_stage(spark, sf_dir, steps):
    total = lambda rows: Counter({k: sum(r.length for r in rows if r.doc_id == k) for k in {r.doc_id for r in rows}})
    assert total(corpus_pipeline.run(spark, sf_dir).collect()) == total(steps[5])


def test_odd_documents_pass_every_stage(spark, sf_dir):
    words = " ".join(f"the{i} and of" for i in range(40))
    rows = [(1, None, "en", None, None, "x"), (None, words, None, None, 5, "y"), (2, "", "en", "s", 0, None), (3, words, "en", "s", 9, "z"),
            (3, words, "en", "s", 9, "z"), (4, words + " " + " ".join(f"new{i}" for i in range(500)), "en", "s", 1, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string")
    for name, stage in corpus_pipeline.STAGES:
        docs, before = stored(stage(spark, docs, sf_dir), "step"), docs
        assert name == "packing" or docs.columns == before.columns
    empty = spark.createDataFrame([], before.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
