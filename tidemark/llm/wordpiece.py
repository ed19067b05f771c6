"""Operator 9: word-piece token counts by a linear longest-match automaton.

The pieces of a fixed public vocabulary form a trie; a word is read with a mark before
it, so pieces that begin with the mark start words and the others continue them. Every
node has a failure link: the node reached after the longest pieces that its string
begins with are taken off, and beside it only how many pieces those are. Reading a
word, one follows trie edges, and where there is none, the failure link, adding its
count. Each character is read once and no piece is built; the count is that of greedy
longest match. Counts of words seen before come from a cache of bounded size.

A word that greedy matching can't cover counts as one unknown token, as word-piece
tokenizers do. Words are split at ASCII white space.

Results for odd input: null and empty texts, and texts of white space only, have no
words and no tokens. Words and texts of any length are counted whole. Equal and null
ids are rows like others; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import WordCache, lean, pick, slices, table, texts

MARK = "▁"  # stands for the space before a word
UNKNOWN = 1 << 40  # a word's value: tokens, and this where the token is the unknown one


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def vocabulary(path: str) -> tuple[str, ...]:
    """The ordinary pieces of a sentence-piece model, in the order of their ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return tuple(
        model.id_to_piece(i) for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))


class Automaton:
    """Trie with failure links and the numbers of pieces that they take off."""

    def __init__(self, pieces: Iterable[str], mark: str = MARK):
        self.next: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                node = self.next[node][c]
            ends[node] = bool(piece)
        self.fail = [-1] * len(ends)  # -1: no link, the word can't be covered
        self.taken = [0] * len(ends)
        level = [0]
        while level:  # shorter strings first
            below = []
            for node in level:
                for c, child in self.next[node].items():
                    below.append(child)
                    if ends[child]:
                        self.fail[child], self.taken[child] = 0, 1
                        continue
                    at, taken = self.fail[node], self.taken[node]
                    while at >= 0 and c not in self.next[at]:
                        taken += self.taken[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[child], self.taken[child] = self.next[at][c], taken
            level = below
        self.mark = mark
        self.counts = WordCache(self.count)

    def count(self, word: bytes) -> int:
        """Tokens of a word in UTF-8."""
        steps, fail, taken = self.next, self.fail, self.taken
        node = total = 0
        for c in self.mark + word.decode():
            while (to := steps[node].get(c)) is None:
                if fail[node] < 0:
                    return UNKNOWN + 1
                total += taken[node]
                node = fail[node]
            node = to
        while node:
            if fail[node] < 0:
                return UNKNOWN + 1
            total += taken[node]
            node = fail[node]
        return total


@functools.cache
def automaton(path: str) -> Automaton:
    return Automaton(vocabulary(path))


class _Count:
    def __init__(self, path: str):
        self.path = path

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts = automaton(self.path).counts
        for batch in slices(batches, "_text"):
            words, values = [], []
            for text in texts(batch, "_text"):
                split = text.split()
                words.append(len(split))
                values.append(sum(map(counts.__getitem__, split)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array([v % UNKNOWN for v in values], pa.int64()),
                 pa.array([v // UNKNOWN for v in values], pa.int64())],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"])
        counts.clear()


def token_counts(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, path: str | None = None) -> DataFrame:
    """Per row its words, word-piece tokens, and how many of these are unknown words.
    One pass, no shuffle."""
    frame = pick(docs, doc_id=id_col, _text=text)
    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(
        _Count(path or vocabulary_path()), f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
