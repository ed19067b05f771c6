import itertools
import math
import zlib

import numpy as np
import pytest

from tidemark.llm import language
from tidemark.llm.wordpiece import MARK, vocabulary, vocabulary_path

PATH = vocabulary_path()


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(6)
    return language.Model(["a", "b"], rng.integers(0, 50, (language.lattice(PATH).size, 2)).astype(float), PATH)


def segmentations(text, pieces):
    for cut in itertools.product([0, 1], repeat=len(text) - 1):
        parts, begin = [], 0
        for i, c in enumerate([*cut, 1], 1):
            if c:
                parts.append(text[begin:i])
                begin = i
        if all(p in pieces or (len(p) == 1 and p not in pieces) for p in parts):
            yield parts


def test_forward_sums_all_segmentations(model):
    pieces = {p: i for i, p in enumerate(vocabulary(PATH))}
    other, plain = len(pieces), model.weights
    for word in ["the", "Änder", "xq", "a", "\U000e0101z", "ation"]:
        text = MARK + word.lower()
        sums = sum(np.prod([plain[pieces.get(p, other)] for p in parts], axis=0) for parts in segmentations(text, pieces))
        assert np.allclose(language.log_sums([word], model)[0], np.log(sums))


def test_expected_counts_cover_each_character(model):
    words, times = ["hello", "naïve", "the"], np.array([2, 1, 5])
    counts = language.expected(words, times, PATH, model.weights[:, :1])
    sizes = np.array([len(p) for p in vocabulary(PATH)] + [1])
    assert math.isclose((counts * sizes).sum(), sum(n * (len(w) + 1) for w, n in zip(words, times)), rel_tol=1e-9)


def exact_log_sum(word, pieces, logs):
    """The forward sum in logarithms, position by position."""
    text, longest = MARK + word.lower(), max(map(len, pieces))
    sums = [np.zeros(logs.shape[1])]
    for j in range(1, len(text) + 1):
        terms = [sums[i] + logs[pieces[text[i:j]]] for i in range(max(0, j - longest), j) if text[i:j] in pieces]
        if text[j - 1] not in pieces:
            terms.append(sums[j - 1] + logs[len(pieces)])
        sums.append(np.logaddexp.reduce(terms, axis=0))
    return sums[-1]


@pytest.fixture(scope="module")
def lopsided():
    """Counts of millions in the Latin pieces only, so that other scripts are very improbable."""
    latin = np.array([p.replace(MARK, "").isascii() for p in vocabulary(PATH)] + [False])
    return language.Model(["a", "b"], np.stack((latin * 200.0, latin * 190.0 + 1e-3), 1) * 6, PATH)


@pytest.mark.parametrize("word", ["thequickbrownfox" * 625, "สวัสดีครับ" * 1000, "北京" * 40, "กขค" * 20, "x\U0001f600" * 300, "é"])
@pytest.mark.parametrize("span", [64, 1 << 15])
def test_words_of_any_length_in_any_script(lopsided, word, span, monkeypatch):
    monkeypatch.setattr(language, "SPAN", span)
    pieces = {p: i for i, p in enumerate(vocabulary(PATH))}
    exact = exact_log_sum(word, pieces, np.log(lopsided.weights))
    assert np.allclose(language.log_sums([word, "the", word[:7]], lopsided)[0], exact, rtol=1e-9)
    ((lang, score),) = language.Scorer(lopsided)([word])
    assert lang == "ab"[int(exact.argmax())] and 0 <= score <= 1


def test_expected_counts_of_long_words(lopsided, monkeypatch):
    words, times = ["ab" * 3000, "กข" * 500, "the"], np.array([1, 2, 3])
    whole = language.expected(words, times, PATH, lopsided.weights[:, :1])
    monkeypatch.setattr(language, "SPAN", 50)
    assert np.allclose(whole, language.expected(words, times, PATH, lopsided.weights[:, :1]))
    sizes = np.array([len(p) for p in vocabulary(PATH)] + [1])
    assert math.isclose((whole * sizes).sum(), sum(n * (len(w) + 1) for w, n in zip(words, times)), rel_tol=1e-9)


def test_memory_of_the_scorer_is_bounded(lopsided, monkeypatch):
    monkeypatch.setattr(language, "CACHE_WORDS", 50)
    monkeypatch.setattr(language, "CACHE_BYTES", 300)
    scorer, plain = language.Scorer(lopsided), language.Scorer(lopsided)
    for n in range(30):
        texts = [f"word{n} other{n} " * 5, "y" * (200 + n), "the " * n, None, "12 34"]
        assert scorer(texts) == [language.Scorer(lopsided)([t])[0] for t in texts]
        assert len(scorer.known) <= 60 and all(len(w) <= language.LONG_WORD for w in scorer.known)
    assert plain(["", " ", "..."]) == [("und", 0.0)] * 3


def test_very_long_text(spark, lopsided):
    text = "the cat and the dog " * 100_000 + "z" * 30_000
    df = spark.createDataFrame([(1, text), (2, "the cat")], "doc_id long, text string")
    out = {r.doc_id: r for r in language.identified(df, lopsided).collect()}
    assert out[1].lang_pred in ("a", "b") and 0 <= out[1].score <= 1


def test_query_on_held_out_rows(spark, sf_dir):
    out = {r.doc_id: r for r in language.op6_language(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(out) == len(docs)
    for d in docs:
        assert out[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        assert 0 <= out[d.doc_id].score <= 1
    held = [d for d in docs if out[d.doc_id].held_out]
    assert sum(out[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.where(language.held_out("doc_id")).collect()
    assert language.taught(spark.createDataFrame(rows, docs.schema)) is None


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, score string, LANG int"
    rows = [(1, "the cat and the dog", "en", "x", 1), (3, "le chat et le chien", "fr", None, 2), (3, "le chat et le chien", "fr", None, 2),
            (None, "the end", None, None, 3), (5, None, "en", None, 4), (6, "12 34 !", "en", None, 5), (7, "", None, None, 6)]
    rows = [r for r in rows if r[0] is None or r[0] > 3 or zlib.crc32(str(r[0]).encode()) % 4 != 2]
    df = spark.createDataFrame(rows, schema)
    model = language.taught(df)
    out = language.identified(df, model).collect()
    assert len(out) == len(rows)
    assert {r.lang_pred for r in out if r.doc_id in (5, 6, 7)} == {"und"}
    assert next(r for r in out if r.doc_id is None).lang_pred in model.langs
    kept = language.only_identified(df, model, 0.0)
    assert kept.schema.simpleString() == df.schema.simpleString() and kept.count() == len(rows) - 3
    empty = df.where("false")
    assert language.taught(empty) is None
    assert language.identified(df, None).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language.identified(empty, model).count() == 0
