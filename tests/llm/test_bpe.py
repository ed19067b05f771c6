import gc
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = bpe.vocabulary_path()
PARTS = ["a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "​", "'s", "'ll", "É", "ß", "1", "²", "½", "日本", "😀",
         "é", "<|endoftext|>", "<|end", "...", "!!", "\r\n", "　", "ab", "x" * 300, "the ", "\x00", "﻿", "ʰ", "_"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.codec(PATH)


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_random_texts_as_the_library(own, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    for text, made in zip(texts, own.encode_all(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids(made) == expected, text
        assert own.decode(made) == library.decode(expected, skip_special_tokens=False)


def test_letters_with_marks_as_the_library(own, library):
    """Words of letters and marks between single spaces."""
    rng = random.Random(4)
    letters = ["a", "the", "s", "Ll", "é", "ß", "ª", "µ", "ɐ", "ʰ", "ж", "日", "1", "e\u0301", "²"]
    marks = list(bpe.MARKS) + ["'s", "'ll", "...", "'", "’", "$$", "\x7f", ""]
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(0, 4))) + "".join(rng.choice(marks) for _ in range(rng.randint(0, 3)))
    texts = [" ".join(filter(None, (word() for _ in range(rng.randint(1, 8))))) for _ in range(4000)]
    for text, made in zip(texts, own.encode_all(texts)):
        assert ids(made) == library.encode(text, add_special_tokens=False).ids, text
    assert gc.isenabled()


def test_long_words_by_heap_as_by_scan(own, library):
    rng = random.Random(2)
    for size in (1, 2, bpe.SHORT - 1, bpe.SHORT, bpe.SHORT + 1, 20_000):
        word = "".join(rng.choice("abcdeèñ") for _ in range(size))
        assert ids(own.encode(word)) == library.encode(word, add_special_tokens=False).ids
        data = word.encode()
        if size < 1000:
            assert own._heap(data) == own._scan(np.frombuffer(data, np.uint8).reshape(1, -1))[0]


def test_full_cache_starts_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    small = bpe.Codec(PATH)
    texts = [f"word{i} and number {i * 7}  two\n spaces" for i in range(50)]
    for text in texts:
        assert ids(small.encode_all([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_query_as_the_library(spark, sf_dir, library):
    out = {r.doc_id: r for r in bpe.op4_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(out) == len(docs)
    for d in docs:
        expected = library.encode(d.text or "", add_special_tokens=False).ids
        r = out[d.doc_id]
        assert r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_odd_rows(spark):
    rows = [Row(doc_id=1, text=None, ids=1, DOC_ID=5), Row(doc_id=None, text="", ids=2, DOC_ID=6),
            Row(doc_id=1, text="a b", ids=3, DOC_ID=7), Row(doc_id=1, text="a b", ids=3, DOC_ID=7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, DOC_ID int")
    out = bpe.encoded(df).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, bytes(r.decoded)) for r in out) == [
        (0, 0, b""), (1, 0, b""), (1, 2, b"a b"), (1, 2, b"a b")]
    assert bpe.encoded(df.where("false")).count() == 0


def test_caches_are_bounded_by_what_they_hold(monkeypatch):
    """Thousands of long words leave nothing behind, and no word is cut or lost."""
    from tidemark.llm import bpe, common

    made = []
    cache = common.WordCache(lambda w: made.append(len(w)) or len(w), 100, 1000)
    for n in range(5000):
        assert cache[b"x" * (1 << 14) + str(n).encode()] == (1 << 14) + len(str(n))
        assert cache[b"short%d" % n] == len(b"short%d" % n)
        assert len(cache) <= 100 and sum(map(len, cache)) <= 1100
    monkeypatch.setattr(bpe, "CACHE_WORDS", 200)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    own, plain = bpe.Codec(bpe.vocabulary_path()), bpe.Codec(bpe.vocabulary_path())
    for n in range(20):
        texts = [f"a{n} b{n} " * 20 + "x" * (250 + n), "word " * n + "\t" + "longer" * 60, " y", "z" * 256 + " " + "z" * 255]
        assert own.encode_all(texts) == [plain.encode(t) for t in texts]
        assert max(map(len, own.words)) <= bpe.SHORT and len(own.words) <= 400
        assert [own.decode(i) for i in own.encode_all(texts)] == texts


def test_very_long_text(spark):
    from tidemark.llm import bpe

    text = "many words of one text " * 100_000 + "q" * 100_000
    (row,) = bpe.encoded(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.decoded.decode() == text and row.n_tokens * 4 == len(row.ids)


def test_full_caches_keep_what_is_needed(monkeypatch):
    """Texts that share words, with caches that are full after each call."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    own, fresh = bpe.Codec(bpe.vocabulary_path()), bpe.Codec(bpe.vocabulary_path())
    calls = [["the cat, the dog", "", " cat", "a  b"], ["the dog\nsat down.", "the cat, the cat"], ["dog, the"]]
    seen = []
    monkeypatch.setattr(own, "encode_words", lambda words: seen.append(set(words)) or fresh.encode_words(words))
    for texts in calls:
        assert own.encode_all(texts) == [fresh.encode(t) for t in texts]
    assert sum(" the" in words for words in seen) == 1
    assert own.encode_all([]) == []
