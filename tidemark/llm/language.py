"""Operator 6: language identification by unigrams that sum over all segmentations.

The pieces of a fixed public vocabulary are given a probability in every language. The
probability of a word is the sum, over all ways to cut it into pieces, of the product
of their probabilities; the forward algorithm adds them up from left to right. Words
are lower-cased, split at ASCII white space and read with a mark before them; a
character in no piece is a piece of its own kind. Words of any length are summed whole: only as
many positions are held as the longest piece spans, and their common scale moves along. A text is scored by its words; the prediction is the
language of the highest sum of logarithms, and its score the share of that language
if the text were one average word: 1 where the words speak for one language only,
near 1/languages where they don't tell.

Probabilities are fitted by expectation-maximisation on the word counts of labelled
rows, counted by Spark: at most about ``SAMPLE`` rows of each language, chosen by a hash
of the text (a documented bound; a third of the rows in one language changes nothing).
What reaches the driver is one number per piece and language; the model has a column for
every value of the language column, which is taken to have few.

Results for odd input: a null text and one without a letter is ``und`` with score 0.
Rows without a language teach nothing but are predicted. If no row can teach, all
are ``und``. Texts are scored whole, however long they or their words are, and scores lie
between 0 and 1. Equal and null ids are rows like others, equal sums go to the first language by
name, an empty table gives no rows, and further columns of any name don't matter.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import lean, only_rows, pick, shuffle_width, slices, stored, table, texts
from tidemark.llm.wordpiece import MARK, vocabulary, vocabulary_path

SAMPLE = 2000
ROUNDS = 3
CELLS, SPAN = 1 << 17, 1 << 15  # characters of a group of words, and of one look at their pieces
LEAST = 1e-30  # smaller numbers move the scale
CACHE_WORDS, CACHE_BYTES, LONG_WORD = 200_000, 8 << 20, 64
PRIOR = 0.05  # added to every count
UNDECIDED = "und"


class Lattice:
    """Finds all pieces in words: at each character, as far as a piece goes."""

    def __init__(self, path: str):
        pieces = vocabulary(path)
        self.size = len(pieces) + 1  # the last: a character in no piece
        self.longest = max(map(len, pieces), default=1)
        letters = sorted({c for p in pieces for c in p})
        self.kinds = np.zeros(ord(letters[-1]) + 2, np.int64)  # 0: in no piece
        self.kinds[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        kind = {c: i for i, c in enumerate(letters, 1)}
        steps, ends = {}, [-1]
        for number, piece in enumerate(pieces):
            node = 0
            for c in piece:
                after = steps.setdefault(node * self.width + kind[c], len(ends))
                if after == len(ends):
                    ends.append(-1)
                node = after
            ends[node] = number
        self.ends = np.array(ends, np.int32)
        # Steps by (node, kind) in a hash table of numbers: the place of a key, or one of the next.
        self.bits = max(4, (4 * len(steps)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.after = np.full(1 << self.bits, -1, np.int32)
        keys, after = np.array(list(steps), np.int64), np.array(list(steps.values()), np.int32)
        place = self._place(keys)
        while len(keys):
            free = self.keys[place] < 0
            self.keys[place[free]], self.after[place[free]] = keys[free], after[free]
            lost = self.keys[place] != keys
            keys, after, place = keys[lost], after[lost], (place[lost] + 1) & (1 << self.bits) - 1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _step(self, nodes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Where a character leads from each node, or -1."""
        keys = nodes * self.width + kinds
        place = self._place(keys)
        seen = self.keys[place]
        found = np.where(seen == keys, self.after[place], -1).astype(np.int64)
        open_ = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(open_):
            place[open_] = (place[open_] + 1) & (1 << self.bits) - 1
            seen = self.keys[place[open_]]
            hit = seen == keys[open_]
            found[open_[hit]] = self.after[place[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return found

    def arcs(self, words: list[str]) -> np.ndarray:
        """Rows of word, start, stop, piece."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kinds[np.minimum(text, len(self.kinds) - 1)]
        word = np.repeat(np.arange(len(words)), lengths)
        start = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at, nodes, left, found = np.arange(len(text)), np.zeros(len(text), np.int64), lengths[word] - start, []
        for size in range(1, self.longest + 1):
            nodes = self._step(nodes, kinds[at + size - 1])
            ends = np.where(nodes >= 0, self.ends[nodes], -1)
            if size == 1:  # a character that is no piece goes by itself all the same
                here = np.where(ends >= 0, ends, self.size - 1)
                found.append((at, here, size))
            else:
                some = ends >= 0
                found.append((at[some], ends[some], size))
            on = (nodes >= 0) & (left[at] > size)
            at, nodes = at[on], nodes[on]
            if not len(at):
                break
        return np.concatenate([
            np.stack((word[i], start[i], start[i] + size, piece), 1).astype(np.int32) for i, piece, size in found])


@functools.cache
def lattice(path: str) -> Lattice:
    return Lattice(path)


def marked(word: str) -> str:
    return MARK + word.lower()


def _groups(words: list[str]) -> Iterator[np.ndarray]:
    """Numbers of words of about one length, so that a group has at most ``CELLS`` characters, or one word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    begin = 0
    while begin < len(order):
        end = begin + 1
        top = min(len(order), begin + 4096)
        while end < top and (end + 1 - begin) * lengths[order[end]] <= CELLS:
            end += 1
        yield order[begin:end]
        begin = end


def _sorted_arcs(own: Lattice, words: list[str], begin: int, end: int, by: int) -> tuple[np.ndarray, np.ndarray]:
    """Arcs that stop (``by`` 2) in (begin, end], or start (``by`` 1) in [begin, end), in
    order, and where each position's begin."""
    low, high = (max(0, begin - own.longest), end) if by == 2 else (begin, end + own.longest)
    arcs = own.arcs([w[low:high] for w in words])
    arcs[:, 1:3] += low
    arcs = arcs[(arcs[:, 2] > begin) if by == 2 else (arcs[:, 1] < end)]
    arcs = arcs[np.argsort(arcs[:, by], kind="stable")]
    first = begin + 1 if by == 2 else begin
    return arcs, np.searchsorted(arcs[:, by], np.arange(first, first + end - begin + 1))


def forward(own: Lattice, words: list[str], weights: np.ndarray, keep: bool = False):
    """Logarithm of the sum over all segmentations, by word and column of ``weights``
    (piece, column); with ``keep`` also of those of every beginning of the words.

    Only the last positions that a piece can reach back to are held, in one scale for each word
    and column, which moves along before numbers get too small.
    """
    n, ring, columns = len(words), own.longest + 1, weights.shape[1]
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    sums, scale = np.zeros((n, ring, columns)), np.zeros((n, columns))
    sums[:, 0] = 1
    out, kept = np.zeros((n, columns)), np.zeros((n, width + 1, columns)) if keep else None
    ends = [np.flatnonzero(lengths == j) for j in range(width + 1)] if width <= 4096 else None
    for begin in range(0, width, SPAN):
        end = min(begin + SPAN, width)
        arcs, edges = _sorted_arcs(own, words, begin, end, 2)
        for j in range(begin + 1, end + 1):
            some = arcs[edges[j - begin - 1]:edges[j - begin]]
            now = sums[:, j % ring]
            now[:] = 0
            np.add.at(now, some[:, 0], sums[some[:, 0], some[:, 1] % ring] * weights[some[:, 3]])
            small = (now < LEAST) & (now > 0)
            if small.any():
                factor = np.where(small, 1 / np.where(small, now, 1), 1)
                sums *= factor[:, None, :]
                scale -= np.log(factor)
            done = ends[j] if ends is not None else np.flatnonzero(lengths == j)
            if len(done):
                out[done] = np.log(now[done]) + scale[done]
            if keep:
                with np.errstate(divide="ignore"):
                    kept[:, j] = np.log(now) + scale
    return (out, kept) if keep else out


def backward(own: Lattice, words: list[str], weights: np.ndarray) -> np.ndarray:
    """The same from each position to the end of the word, for one column of weights."""
    n, ring = len(words), own.longest + 1
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    sums, scale, kept = np.zeros((n, ring)), np.zeros(n), np.full((n, width + 1), -np.inf)
    for end in range(width, -1, -SPAN):
        begin = max(0, end - SPAN + 1)
        arcs, edges = _sorted_arcs(own, words, begin, end + 1, 1)
        for i in range(end, begin - 1, -1):
            some = arcs[edges[i - begin]:edges[i - begin + 1]]
            now = sums[:, i % ring]
            now[:] = lengths == i
            np.add.at(now, some[:, 0], sums[some[:, 0], some[:, 2] % ring] * weights[some[:, 3], 0])
            small = (now < LEAST) & (now > 0)
            if small.any():
                factor = np.where(small, 1 / np.where(small, now, 1), 1)
                sums *= factor[:, None]
                scale -= np.log(factor)
            with np.errstate(divide="ignore"):
                kept[:, i] = np.log(now) + scale
    return kept


def log_sums(words: list[str], model: Model) -> np.ndarray:
    """Log probability of each word in each language, all segmentations summed."""
    out, own, words = np.zeros((len(words), len(model.langs))), lattice(model.path), [marked(w) for w in words]
    for some in _groups(words):
        out[some] = forward(own, [words[i] for i in some], model.weights)
    return out


def expected(words: list[str], times: np.ndarray, path: str, weights: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words, all segmentations weighted by
    their probability. ``weights``: one column."""
    own, total, words = lattice(path), np.zeros(len(weights)), [marked(w) for w in words]
    logs = np.log(weights[:, 0])
    for group in _groups(words):
        some = [words[i] for i in group]
        whole, before = forward(own, some, weights, keep=True)
        after, width = backward(own, some, weights), max(map(len, some))
        for begin in range(0, width, SPAN):
            arcs, _ = _sorted_arcs(own, some, begin, min(begin + SPAN, width), 2)
            w, i, j, p = arcs.T
            share = np.exp(before[w, i, 0] + logs[p] + after[w, j] - whole[w, 0])
            total += np.bincount(p, share * times[group][w], len(total))
    return total


class Model:
    """Languages, and the probability of every piece in each of them."""

    def __init__(self, langs: list[str], counts: np.ndarray, path: str):
        self.langs, self.path = langs, path
        smooth = counts + PRIOR
        self.weights = smooth / smooth.sum(0)


def in_training(id_col: str) -> Column:
    """Rows that may teach: all but those whose hash of the id leaves 2 over 4."""
    return ~held_out(id_col)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


class _Expect:
    def __init__(self, model: Model):
        self.model = model

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = self.model
        sums = np.zeros(model.weights.shape)
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist())
            words, times = batch.column("word").to_pylist(), np.array(batch.column("n").to_pylist(), float)
            for k, lang in enumerate(model.langs):
                mine = np.flatnonzero(langs == lang)
                if len(mine):
                    sums[:, k] += expected([words[i] for i in mine], times[mine], model.path, model.weights[:, k:k + 1])
        piece, lang = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(sums[piece, lang])],
            names=["lang_no", "piece", "times"])


def fit(rows: DataFrame, path: str | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model | None:
    """Fit on rows ``text`` and ``lang``, none of them null."""
    path = path or vocabulary_path()
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_lang:
        return None
    langs = sorted(per_lang)
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, sample / per_lang[k]))])
    # The place of a text in [0, 1), whatever else it comes with; copies stand or fall together.
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.where(place < share[F.col("lang")])
    # Words of texts: at any white space of ASCII, none of them empty.
    words = chosen.select("lang", F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")
    counted = stored(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).repartition(shuffle_width(rows.sparkSession)), "words")
    model = Model(langs, np.zeros((lattice(path).size, len(langs))), path)
    for _ in range(rounds):
        sums = counted.mapInArrow(_Expect(model), "lang_no int, piece int, times double")
        counts = np.zeros(model.weights.shape)
        # One number for each piece and language, whatever the rows.
        for r in sums.groupBy("lang_no", "piece").agg(F.sum("times").alias("times")).toLocalIterator():
            counts[r["piece"], r["lang_no"]] = r["times"]
        model = Model(langs, counts, path)
    return model


class Scorer:
    """Predicts texts; the sums of words seen lately are kept, of ``CACHE_WORDS`` words
    and ``CACHE_BYTES`` bytes at most, none of them long."""

    def __init__(self, model: Model | None):
        self.model, self.known, self.held, self.sums = model, {}, 0, None

    def _values(self, words: set[bytes]) -> tuple[dict[bytes, int], np.ndarray]:
        """A number for each of the words, and their sums by number."""
        new = list(words.difference(self.known))
        if len(self.known) + len(new) > CACHE_WORDS or self.held > CACHE_BYTES:
            self.known, self.held, self.sums, new = {}, 0, None, list(words)
        short = [w for w in new if len(w) <= LONG_WORD]
        long = [w for w in new if len(w) > LONG_WORD]
        if short:
            fresh = log_sums([w.decode() for w in short], self.model)
            self.known.update(zip(short, range(len(self.known), len(self.known) + len(short))))
            self.sums = fresh if self.sums is None else np.concatenate((self.sums, fresh))
            self.held += sum(map(len, short))
        if not long:
            return self.known, self.sums
        fresh = log_sums([w.decode() for w in long], self.model)
        both = fresh if self.sums is None else np.concatenate((self.sums, fresh))
        return self.known | dict(zip(long, range(len(self.known), len(both)))), both

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if self.model is None:
            return [(UNDECIDED, 0.0) for _ in texts]
        split = [t.encode().split() if t and any(map(str.isalpha, t)) else [] for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        out = [(UNDECIDED, 0.0)] * len(texts)
        rows = np.flatnonzero(sizes)
        if not len(rows):
            return out
        known, sums = self._values(set().union(*split))
        numbers = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(sizes.sum()))
        begins = (np.cumsum(sizes) - sizes)[rows]
        total = np.add.reduceat(sums[numbers], begins, axis=0)
        best = total.argmax(1)
        apart = (total - total[np.arange(len(rows)), best][:, None]) / sizes[rows][:, None]
        for row, k, share in zip(rows.tolist(), best.tolist(), (1 / np.exp(apart).sum(1)).tolist()):
            out[row] = (self.model.langs[k], share)
        return out


class _Predict:
    """Adds prediction and score, or keeps the rows that reach a least score."""

    def __init__(self, model: Model | None, least: float | None = None):
        self.model, self.least = model, least

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = Scorer(self.model)  # of this task; nothing outlives it
        for batch in slices(batches, "_text", 2 << 20):
            nulls = batch.column("_text").is_null().to_pylist()
            found = scorer([None if none else t.decode() for none, t in zip(nulls, texts(batch, "_text"))])
            if self.least is not None:
                yield batch.filter(pa.array([lang != UNDECIDED and score >= self.least for lang, score in found], pa.bool_()))
                continue
            columns = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "_text"}
            langs, scores = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*columns, "lang_pred", "score"])


def taught(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> Model | None:
    """The model of the labelled rows that may teach."""
    rows = pick(docs, doc_id=id_col, text=text, lang=lang)
    return fit(rows.where(in_training("doc_id") & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang"))


def identified(docs: DataFrame, model: Model | None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row its id, whether it is held out, predicted language and score."""
    frame = pick(docs, doc_id=id_col, _text=text).withColumn("held_out", held_out("doc_id"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.select("doc_id", "held_out", "_text").mapInArrow(
        _Predict(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def only_identified(docs: DataFrame, model: Model | None, least: float, text: str = "text") -> DataFrame:
    """The rows whose language is found with at least this score, as they came."""
    return only_rows(docs, text, _Predict(model, least))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identified(docs, taught(docs))
