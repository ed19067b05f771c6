"""Operator 4: byte-level BPE encoding and decoding over a contiguous rank array.

A text is split by the public pattern of the vocabulary. A word is encoded by holding
its parts and the rank of every adjacent pair in small contiguous arrays: the ranks
are scanned for the least one, that boundary is deleted, and the ranks on its two sides
are looked up again. New words of a batch that have one length are scanned together, a
row each. A scan costs the length of the word, so words above ``SHORT`` bytes, where
repeated scans would cost its square, take the least rank from a heap over the same
parts. Both give the same ids. Words seen before come from a cache of bounded size.

Results for odd input: null and empty texts give no ids. A text of any length is
encoded whole. The special token's own string in a text becomes its id, as the
library does by default. Rows with equal or null ``doc_id`` are rows like others, and an
empty table gives no rows. Caches are bounded in words and in characters.
"""

from __future__ import annotations

import functools
import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import CACHE_BYTES, lean, pick, slices, table, texts, uncollected

#: How byte-level vocabularies split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
SHORT = 256  # bytes
CACHE_WORDS = 150_000  # of either cache; a full one keeps what the next texts need
#: The marks of ASCII, and the end of the Latin letters.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS = "\u0250"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones for
    themselves, the others for 256 and on in their order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Ids of texts and texts of ids, for a vocabulary file of byte-level BPE."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        raw = lambda piece: bytes(letters[c] for c in piece)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        ids = {raw(p): n for p, n in spec["model"]["vocab"].items() if p not in self.special}
        self.pieces = {n: p for p, n in ids.items()} | {n: t.encode() for t, n in self.special.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        pairs = [(raw(a), raw(b)) for a, b in pairs]
        # A merge is found by the ids of its two parts; its rank is its place in the list.
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.key_ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(order, len(pairs)).astype(np.int32)
        self.none = len(pairs)
        self.joined = np.array([ids[a + b] for a, b in pairs], np.int32)
        self._rank_of: dict[int, int] | None = None
        self.byte_ids = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        every = np.arange(256)
        self.byte_ranks = self._ranks(self.byte_ids[every[:, None]], self.byte_ids[every])
        self.split = regex.compile(PATTERN).findall
        self.apart = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.words: dict[str, bytes] = {}  # word: ids
        self.spaced: dict[str, bytes] = {}  # what stands between two spaces: ids, with the space before it
        self.held = [0, 0]  # characters of the words in either

    def rank_of(self) -> dict[int, int]:
        """Ranks by the ids of two parts, made when the first long word comes."""
        if self._rank_of is None:
            self._rank_of = dict(zip(self.keys[:-1].tolist(), self.key_ranks[:-1].tolist()))
        return self._rank_of

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.key_ranks[at], self.none).astype(np.int32)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        data = list(map(str.encode, words))
        out: list[bytes] = [b""] * len(data)
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        order = np.argsort(lengths, kind="stable")
        begins = np.flatnonzero(np.diff(lengths[order], prepend=-1))
        for some in np.split(order, begins[1:]):
            rows, length = some.tolist(), int(lengths[some[0]]) if len(some) else 0
            if length > SHORT:
                for i in rows:
                    out[i] = self._heap(data[i])
                continue
            for begin in range(0, len(rows), 1 << 13):
                part = rows[begin:begin + (1 << 13)]
                block = np.frombuffer(b"".join([data[i] for i in part]), np.uint8).reshape(len(part), length)
                for i, ids in zip(part, self._scan(block)):
                    out[i] = ids
        return out

    def _scan(self, block: np.ndarray) -> list[bytes]:
        """Words of one length, a row each. A row holds the ids of its parts and beside
        them the ranks of adjacent parts. Every round scans each row for its least rank,
        deletes that boundary and refreshes the ranks on either side; rows without a
        known pair are done. All rows left have lost one boundary a round, so they stay
        contiguous arrays of one width."""
        out: list[bytes] = [b""] * len(block)
        rows, parts = np.arange(len(block)), self.byte_ids[block]
        ranks = self.byte_ranks[block[:, :-1], block[:, 1:]]
        while True:
            width = parts.shape[1]
            if width > 1:
                at = ranks.argmin(1)
                least = ranks[np.arange(len(rows)), at]
                done = least == self.none
            else:
                done = np.ones(len(rows), bool)
            if done.any():
                flat, step = parts[done].astype("<u4").tobytes(), 4 * width
                for i, row in enumerate(rows[done].tolist()):
                    out[row] = flat[i * step:(i + 1) * step]
                rows, parts, ranks = rows[~done], parts[~done], ranks[~done]
                if not len(rows):
                    return out
                at, least = at[~done], least[~done]
            line = np.arange(len(rows))
            keep = np.ones(parts.shape, bool)
            keep[line, at + 1] = False
            parts[line, at] = self.joined[least]
            parts = parts[keep].reshape(len(rows), width - 1)
            keep = keep[:, 1:]  # the boundary after part ``at`` goes
            ranks = ranks[keep].reshape(len(rows), width - 2)
            if width > 2:
                left = np.flatnonzero(at > 0)
                ranks[left, at[left] - 1] = self._ranks(parts[left, at[left] - 1], parts[left, at[left]])
                right = np.flatnonzero(at < width - 2)
                ranks[right, at[right]] = self._ranks(parts[right, at[right]], parts[right, at[right] + 1])

    def _heap(self, data: bytes) -> bytes:
        """The same merges for a long word: leftmost least rank from a heap, stale
        entries told by the parts that they were made for."""
        parts = self.byte_ids[np.frombuffer(data, np.uint8)].tolist()
        n, ranks = len(parts), self.rank_of()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := ranks.get(parts[i] << 32 | parts[j])) is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = int(self.joined[rank]), -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return array("I", [p for p in parts if p >= 0]).tobytes()

    def forget(self) -> None:
        """Empty the caches, at the end of a task."""
        self.words.clear()
        self.spaced.clear()
        self.held = [0, 0]

    def _learn_spaced(self, parts: list[str]) -> None:
        """Encode what these parts of texts, split at spaces, add to the cache. Only what neither
        is empty nor begins or ends with white space: after a space that follows such a
        part, a word begins, and it is split alike whatever came before it."""
        if len(self.spaced) > CACHE_WORDS or self.held[1] > CACHE_BYTES:
            # What these texts need stays.
            self.spaced = {w: ids for w in parts if (ids := self.spaced.get(w)) is not None}
            self.held[1] = sum(map(len, self.spaced))
        new = set(parts).difference(self.spaced)
        # Letters alone are one word, with the space before them, and marks after them another.
        # Beyond ``LETTERS``, and where digits are among them, the pattern says what is a letter.
        # Most are ASCII letters alone.
        plain, marked, others = set(filter(str.isascii, filter(str.isalpha, new))), [], []
        new -= plain
        if plain and len(max(plain, key=len)) >= SHORT:
            plain = {w for w in plain if len(w) < SHORT}
        for w in new:
            if not w or len(w) >= SHORT:
                continue
            stem = w.rstrip(MARKS)
            if stem.isalpha() and (stem.isascii() or max(stem) < LETTERS):
                if len(stem) == len(w):
                    plain.add(w)
                else:
                    marked.append((w, stem, w[len(stem):]))
            elif not (w[0].isspace() or w[-1].isspace()):
                others.append(w)
        plain.update({stem for _, stem, _ in marked}.difference(self.spaced))
        order = list(plain)
        self.spaced.update(zip(order, self.encode_words([" " + w for w in order])))
        split = [self.split(" " + w) for w in others]
        self._learn_words(set().union(*split, {tail for *_, tail in marked}))
        get, stems = self.words.__getitem__, self.spaced
        stems.update([(w, stems[stem] + get(tail)) for w, stem, tail in marked])
        stems.update(zip(others, [b"".join(map(get, ws)) for ws in split]))
        self.held[1] += sum(map(len, order)) + sum(map(len, others)) + sum(len(w) for w, *_ in marked)

    def _learn_words(self, words: set[str]) -> dict[str, bytes]:
        """Encode words for the cache; long ones are not kept but returned."""
        if len(self.words) > CACHE_WORDS or self.held[0] > CACHE_BYTES:
            self.words.clear()
            self.held[0] = 0
        words = list(words.difference(self.words))
        short, long = [w for w in words if len(w) <= SHORT], [w for w in words if len(w) > SHORT]
        self.words.update(zip(short, self.encode_words(short)))
        self.held[0] += sum(map(len, short))
        return dict(zip(long, self.encode_words(long)))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        with uncollected():
            return self._encode_all(texts)

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        """A part between spaces is looked up once per call, however often it occurs; the
        ids of all its places are gathered as arrays."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        edges, parts = split.offsets.to_numpy().astype(np.int64), split.flatten().dictionary_encode()
        places, distinct = parts.indices.to_numpy(), parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        del split, parts
        self._learn_spaced(distinct)
        # The first part of a text has no space before it, so it is split by itself.
        first_places = places[edges[:-1]]
        firsts = {i: distinct[i] for i in np.unique(first_places).tolist()}
        self._learn_words(set().union(*[self.split(w) for w in firsts.values() if len(w) < SHORT]))
        found = list(map(self.spaced.get, distinct))
        known = np.fromiter((ids is not None for ids in found), bool, len(found))
        # White space beside a space, or a long word: such a text is split as a whole.
        plain = np.logical_and.reduceat(known[places], edges[:-1])
        if self.apart:
            plain &= np.array([not any(s in text for s in self.special) for text in texts])
        number = {i: len(found) + k for k, i in enumerate(firsts)}
        found += [self._words_of(w) if known[i] else None for i, w in firsts.items()]
        places = places.copy()
        places[edges[:-1]] = np.array([number[i] for i in first_places.tolist()], places.dtype)
        found = [ids or b"" for ids in found]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        del found
        here = sizes[places]
        ends = np.cumsum(here)
        shift = (np.cumsum(sizes) - sizes)[places] - (ends - here)
        ids = flat[np.repeat(shift.astype(np.int32), here) + np.arange(ends[-1], dtype=np.int32)]
        stops = ends[edges[1:] - 1].tolist()
        return [
            ids[begin:stop].tobytes() if whole else self._encode_apart(text)
            for text, whole, begin, stop in zip(texts, plain.tolist(), [0, *stops], stops)]

    def _encode_apart(self, text: str) -> bytes:
        """The ids of a text that may hold special tokens."""
        if self.apart and any(s in text for s in self.special):
            return b"".join(
                array("I", [self.special[part]]).tobytes() if part in self.special else self._words_of(part)
                for part in self.apart(text) if part)
        return self._words_of(text)

    def _words_of(self, text: str) -> bytes:
        words = self.split(text)
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            long = self._learn_words(set(words))
            return b"".join([long[w] if len(w) > SHORT else self.words[w] for w in words])

    def decode(self, ids: bytes) -> str:
        pieces = b"".join(map(self.pieces.__getitem__, memoryview(ids).cast("I").tolist()))
        return pieces.decode("utf-8", "replace")


@functools.cache
def codec(path: str) -> Codec:
    """One codec per worker process; the path names a file that every machine has."""
    return Codec(path)


def encoded(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, path: str | None = None) -> DataFrame:
    """Per row its id, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers)
    and ``decoded`` (UTF-8, made from the ids). One pass, no shuffle."""
    frame = pick(docs, doc_id=id_col, _text=text)
    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(
        _Encode(path or vocabulary_path()), f"doc_id {kind}, n_tokens long, ids binary, decoded binary")


class _Encode:
    def __init__(self, path: str):
        self.path = path

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = codec(self.path)
        for batch in slices(batches, "_text", 4 << 20):
            ids = own.encode_all([t.decode() for t in texts(batch, "_text")])
            decoded = [own.decode(made).encode() for made in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(made) // 4 for made in ids], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                names=["doc_id", "n_tokens", "ids", "decoded"])
        own.forget()


def digest(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(encoded(table(spark, sf_dir, "documents")))
