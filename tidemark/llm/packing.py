"""Operator 3: order-preserving packing by dynamic programming.

Documents are put one after another, in the order in which their rows are stored, and
the stream of their tokens is cut into windows of at most ``length`` tokens. A window
may end after a document (free), after a sentence (``SENTENCE``) or, where a sentence
is long, after every ``STRIDE`` tokens of it (``INSIDE``); penalties count in tokens of
padding. The cheapest set of cuts is

    cost(j) = penalty(j) + min over i of cost(i) + length - (position(j) - position(i))

over the cuts i within ``length`` tokens before j. As ``cost(i) + position(i)`` does not
depend on j, the minimum comes from a monotone queue, and each cut enters and leaves
the queue once.

Order is kept within a partition of the scan; a partition is packed by itself, without
a shuffle, in blocks of ``BLOCK`` tokens, of which the last window is carried on into
the next. So memory holds a block and one batch of texts, and each partition ends with
one short window: it is padded, or cut at powers of two, which need no padding,
whichever costs less.

Results for odd input: a null or empty text is the one token that ends a document.
Equal and null ids are rows like others. A text of any length is packed whole; an
empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe
from tidemark.llm.common import lean, pick, slices, table, texts

LENGTH = 1024
SENTENCE, INSIDE, STRIDE = 2, 16, 32
BLOCK = 1 << 18
END = 0  # the id that ends a document


def padding(length: int, full: int = LENGTH) -> int:
    """Padding that a sequence of this many tokens needs."""
    return 0 if length & (length - 1) == 0 else full - length


def choose_cuts(positions: list[int], penalties: list[int], length: int = LENGTH) -> list[int]:
    """The cheapest increasing choice of ``positions`` that ends with the last one and
    leaves no window above ``length``. Neighbouring positions lie within ``length``."""
    # A key is cost + position. The queue is what of these two lists lies at ``first`` and above.
    points, back = [0, *positions], [0]
    queue, least, first, j = [0], [0], 0, 0
    for here, penalty in zip(positions, penalties):
        j += 1
        low = here - length
        while points[queue[first]] < low:
            first += 1
        key = least[first] + length + penalty
        back.append(queue[first])
        while len(least) > first and least[-1] >= key:
            least.pop()
            queue.pop()
        queue.append(j)
        least.append(key)
    cuts, at = [], len(points) - 1
    while at:
        cuts.append(points[at])
        at = back[at]
    return cuts[::-1]


def candidates(kinds: np.ndarray) -> tuple[list[int], list[int]]:
    """Where a stretch may be cut and at what penalty. ``kinds``, by token: 2 after a
    document's end, 1 after a sentence's."""
    natural = np.flatnonzero(kinds) + 1
    penalty = np.where(kinds[natural - 1] == 2, 0, SENTENCE)
    edges = np.concatenate(([0], natural, [len(kinds)]))
    wide = np.flatnonzero(np.diff(edges) > STRIDE)
    inside = [np.arange(edges[w] + STRIDE, edges[w + 1], STRIDE) for w in wide.tolist()]
    if inside:
        inside = np.concatenate(inside)
        natural = np.concatenate((natural, inside))
        penalty = np.concatenate((penalty, np.full(len(inside), INSIDE)))
        order = np.argsort(natural, kind="stable")
        natural, penalty = natural[order], penalty[order]
    return natural.tolist(), penalty.tolist()


def short_window(length: int, full: int = LENGTH) -> list[int]:
    """Lengths of the windows for what is left at the end of a partition."""
    powers = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    return powers if (len(powers) - 1) * INSIDE < padding(length, full) else [length]


class Packer:
    """Cuts a stream of documents into windows; ``out`` collects rows of pieces."""

    def __init__(self, first_sequence: int, length: int = LENGTH, block: int = BLOCK):
        self.sequence, self.length, self.block = first_sequence, length, block
        self.ids: list[np.ndarray] = []
        self.kinds: list[np.ndarray] = []
        self.waiting = 0
        self.docs: deque[list] = deque()  # key, tokens, tokens already placed
        self.out: list[tuple] = []

    def add(self, key, ids: np.ndarray, kinds: np.ndarray) -> None:
        self.docs.append([key, len(ids), 0])
        self.ids.append(ids)
        self.kinds.append(kinds)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            self._place(False)

    def finish(self) -> None:
        if self.waiting:
            self._place(True)

    def _place(self, last: bool) -> None:
        ids, kinds, begin = np.concatenate(self.ids), np.concatenate(self.kinds), 0
        while True:
            stop = min(begin + self.block, len(ids))
            final = last and stop == len(ids)
            if stop - begin < self.block and not final:
                break
            cuts = choose_cuts(*candidates(kinds[begin:stop]), self.length)
            if final:
                *head, tail = [b - a for a, b in zip([0, *cuts], cuts)]
                lengths = [*head, *short_window(tail, self.length)]
            else:
                lengths = [b - a for a, b in zip([0, *cuts], cuts[:-1])]
            for n in lengths:
                self._emit(ids[begin:begin + n])
                begin += n
            if final:
                break
        self.ids, self.kinds, self.waiting = [ids[begin:].copy()], [kinds[begin:].copy()], len(ids) - begin

    def _emit(self, window: np.ndarray) -> None:
        offset = 0
        while offset < len(window):
            doc = self.docs[0]
            n = min(doc[1] - doc[2], len(window) - offset)
            self.out.append((doc[0], doc[2], n, window[offset:offset + n].tobytes(), doc[1], self.sequence, offset))
            doc[2] += n
            offset += n
            if doc[2] == doc[1]:
                self.docs.popleft()
        self.sequence += 1


class _Pack:
    def __init__(self, path: str, length: int, block: int):
        self.path, self.length, self.block = path, length, block

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        codec = bpe.codec(self.path)
        ends, breaks, opens = sentence_marks(codec)
        packer = Packer(TaskContext.get().partitionId() << 32, self.length, self.block)
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        kinds = [None, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

        def rows(id_type):
            done, packer.out = packer.out, []
            columns = list(zip(*done))
            arrays = [pa.array(c, k or id_type) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        id_type = None
        for batch in slices(batches, "_text", 2 << 20):
            id_type = batch.schema.field("doc_id").type
            encoded = codec.encode_all([t.decode() for t in texts(batch, "_text")])
            for key, made in zip(batch.column("doc_id").to_pylist(), encoded):
                ids = np.append(np.frombuffer(made, "<u4"), np.uint32(END))
                marks = np.zeros(len(ids), np.uint8)
                marks[:-2] = breaks[ids[:-2]] | ends[ids[:-2]] & opens[ids[1:-1]]
                marks[-1] = 2
                packer.add(key, ids, marks)
                if len(packer.out) >= 1024:
                    yield rows(id_type)
        packer.finish()
        codec.forget()
        if packer.out:
            yield rows(id_type)


def sentence_marks(codec: bpe.Codec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By token id: whether it ends like a sentence, holds a line break, or begins with
    white space."""
    size = max(codec.pieces) + 1
    ends, breaks, opens = (np.zeros(size, bool) for _ in range(3))
    for number, piece in codec.pieces.items():
        ends[number] = piece.rstrip(b"\"')]}").endswith((b".", b"!", b"?", "。".encode()))
        breaks[number] = b"\n" in piece
        opens[number] = piece[:1].isspace()
    return ends, breaks, opens


def packed(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, path: str | None = None,
           length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Per piece: the document, where in it the piece starts, its length and ids
    (little-endian unsigned 32-bit integers), the document's tokens, the sequence and
    the piece's place there."""
    frame = pick(docs, doc_id=id_col, _text=text)
    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(
        _Pack(path or bpe.vocabulary_path(), length, block),
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(packed(table(spark, sf_dir, "documents")))
