"""Operator 7: removal of repeated passages by De Bruijn compaction.

The edges of the graph are the windows of 50 words (its nodes would be runs of 49). A
word goes if one of its windows also starts in a document of smaller id.

Writing every edge would move fifty times the text, so edges travel in paths from the
start. Each window names an anchor, the run of ``ANCHOR`` words in it of least
fingerprint; equal windows name equal anchors, and the windows of a text that follow
one another with one anchor are a path. A path is known by the 128-bit fingerprint of its words.

1. Paths whose anchor is in one document only hold no repeated window and are left.
2. For each path left its least document is its owner, and it has all windows of the path.
   Where paths branch at an anchor, they are opened into single windows, read at one source
   place for each path, and a window that a path of a smaller owner holds is noted as that
   one's too.
3. Unbranched stretches are compacted: where a path is always followed by one and the
   same, and that always preceded by the first, they are joined, and chains of such
   joints are folded by pointer doubling, so after n rounds chains of 2**n paths are one.
   What the windows say is moved to the head of each chain, and only heads remain.
4. Each place in a document where a head starts gives the spans to remove, in words of
   that document. With a document's text the spans are cut; their coordinates must fit
   inside it, else the run stops.

A passage that very many documents share is one row in each step but the last, where it is
a row per document; grouped steps combine before they shuffle, and joins on it have one
row on the other side. Lists are kept per document or path, never per passage.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null and empty texts, and those below 50 words,
lose nothing. A null id is neither smaller nor larger than another: such a row loses
nothing and takes nothing. Rows of one id take nothing from each other. Texts of any
length are treated whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import WHITE, lean, slices, stored, table, texts
from tidemark.llm.hashing import PLACE, Words, binary16, filed, with_place, word_cache

WINDOW, ANCHOR = 50, 8


def paths_of(words: Words, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The paths of a text: anchor, fingerprint, first window, windows."""
    if words.n < window:
        return np.zeros(0, np.uint64), np.zeros((0, 2), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = words.windows(anchor)
    view = np.lib.stride_tricks.sliding_window_view(grams, window - anchor + 1)
    at = view.argmin(1) + np.arange(len(view))
    starts = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    counts = np.diff(np.append(starts, len(at)))
    return grams[at[starts]], words.runs(starts, starts + counts + window - 1), starts, counts


class _Paths:
    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache = word_cache()
        for batch in slices(batches, "_text", 4 << 20):
            anchors, prints, starts, counts, rows = [], [], [], [], []
            for row, text in enumerate(texts(batch, "_text")):
                a, p, s, n = paths_of(Words(text.split(), cache))
                anchors.append(a)
                prints.append(p)
                starts.append(s)
                counts.append(n)
                rows.append(np.full(len(a), row))
            rows = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_file").take(rows), batch.column("_at").take(rows), batch.column("doc_id").take(rows),
                 pa.array(np.concatenate(anchors).view(np.int64)), binary16(np.concatenate(prints)),
                 pa.array(np.concatenate(starts)), pa.array(np.concatenate(counts))],
                names=["_file", "_at", "doc_id", "anchor", "path", "start", "n"])


class _Open:
    """The windows of the wanted paths of a document."""

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache = word_cache()
        for batch in slices(batches, "_text", 4 << 20):
            prints, paths, offsets, owners = [], [], [], []
            for text, wanted in zip(texts(batch, "_text"), batch.column("wanted").to_pylist()):
                words = Words(text.split(), cache)
                for w in wanted:
                    begin = np.arange(w["start"], w["start"] + w["n"])
                    prints.append(words.runs(begin, begin + WINDOW))
                    paths += [w["path"]] * w["n"]
                    offsets.append(np.arange(w["n"], dtype=np.int32))
                    owners += [w["owner"]] * w["n"]
            if not prints:
                continue
            yield pa.RecordBatch.from_arrays(
                [binary16(np.concatenate(prints)), pa.array(paths, pa.binary()), pa.array(np.concatenate(offsets)),
                 pa.array(owners, pa.int64())],
                names=["window", "path", "offset", "owner"])


def _owners(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per path and stretch of its windows a document that has them: ``path``, ``begin``,
    ``end`` (windows, end left out), ``owner``. All windows of a path are its owner's; by
    other paths at a branch some may also be a smaller document's, which matters to the
    owner alone."""
    whole = nodes.select("path", F.lit(0).cast("long").alias("begin"), F.col("n").alias("end"), "owner", F.lit(True).alias("whole"))
    branched = stored(
        nodes.groupBy("anchor").agg(F.count(F.lit(1)).alias("paths")).where("paths > 1").select("anchor"), "branched")
    request = F.struct(F.col("source.start").alias("start"), "n", "path", "owner")
    wanted = (
        nodes.join(branched, "anchor", "left_semi")
        .groupBy(F.col("source._file").alias("_file"), F.col("source._at").alias("_at"))
        .agg(F.collect_list(request).alias("wanted"))
    )
    opened = stored(
        with_place(docs, _text="_text").join(wanted.hint("merge"), PLACE).select("_text", "wanted")
        .mapInArrow(_Open(), "window binary, path binary, offset int, owner long"), "windows")
    shared = stored(
        opened.groupBy("window").agg(F.min("owner").alias("least"), F.max("owner").alias("most"))
        .where("least < most").select("window", "least"), "shared")
    lent = opened.join(shared, "window").where("least < owner")
    # Stretches of windows of one document: at most a window's length of rows for each path.
    along = Window.partitionBy("path").orderBy("offset")
    goes_on = (F.lag("least").over(along) == F.col("least")) & (F.lag("offset").over(along) == F.col("offset") - 1)
    lent = (
        lent.withColumn("stretch", F.sum(F.when(goes_on, 0).otherwise(1)).over(along))
        .groupBy("path", "stretch").agg(
            F.min("offset").cast("long").alias("begin"), (F.max("offset") + 1).cast("long").alias("end"), F.min("least").alias("owner"))
        .drop("stretch").withColumn("whole", F.lit(False))
    )
    return whole.unionByName(lent)


def _chains(nodes: DataFrame) -> DataFrame:
    """Per path that has one: the head of its chain and how many windows after the
    head's first its own first is."""
    before = nodes.where("in_one").select(F.col("path"), F.col("before").alias("head"))
    sure = nodes.where("out_one").select(F.col("path").alias("head"), F.col("after"), F.col("n").alias("far"))
    links = stored(before.join(sure, "head").where("after = path").select("path", "head", "far"), "links")
    while True:
        up = links.select(F.col("path").alias("head"), F.col("head").alias("higher"), F.col("far").alias("more"))
        step = stored(
            links.join(up, "head", "left")
            .select("path", F.coalesce("higher", "head").alias("head"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"),
                    F.col("higher").isNotNull().alias("moved")), "links")
        if step.where("moved").isEmpty():
            return step.drop("moved")
        links = step.drop("moved")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans of words to remove, for the rows ``doc_id``, ``_text`` of a filed frame: per
    row that loses words its place and ``spans``, an array of first word and end."""
    # Stored, as it is read twice and every text is hashed for it.
    paths = stored(with_place(docs, doc_id="doc_id", _text="_text").mapInArrow(
        _Paths(), "_file long, _at long, doc_id long, anchor long, path binary, start long, n long"), "all-paths")
    # Stored, like other aggregates that are joined back to what they count: a join may
    # split a hot key only if neither side has been dealt by it for an aggregate.
    shared = stored(
        paths.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most").select("anchor"), "shared")
    seen = stored(paths.join(shared, "anchor", "left_semi"), "paths")
    # The paths around each one in its document; a path that starts elsewhere is no neighbour.
    along = Window.partitionBy(*PLACE).orderBy("start")
    previous, following = F.lag(F.struct("path", (F.col("start") + F.col("n")).alias("stop"))).over(along), F.lead(F.struct("path", "start")).over(along)
    around = seen.select(
        "*", F.when(previous["stop"] == F.col("start"), previous["path"]).alias("before"),
        F.when(following["start"] == F.col("start") + F.col("n"), following["path"]).alias("after"))
    one = lambda c: (F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1)))
    nodes = stored(
        around.groupBy("path").agg(
            F.min("anchor").alias("anchor"), F.min("n").alias("n"), F.min("doc_id").alias("owner"),
            F.min(F.struct("doc_id", *PLACE, "start")).alias("source"),
            F.min("before").alias("before"), F.min("after").alias("after"),
            one("before").alias("in_one"), one("after").alias("out_one")), "nodes")
    chains = _chains(nodes)
    owners = _owners(docs, nodes).join(chains, "path", "left").select(
        F.coalesce("head", "path").alias("path"), "owner", "whole",
        (F.col("begin") + F.coalesce("far", F.lit(0))).alias("begin"), (F.col("end") + F.coalesce("far", F.lit(0))).alias("end"))
    # Stretches that meet and have one owner become one.
    down = Window.partitionBy("path", "whole").orderBy("begin")
    goes_on = (F.lag("end").over(down) == F.col("begin")) & (F.lag("owner").over(down) == F.col("owner"))
    stretches = stored(
        owners.withColumn("part", F.sum(F.when(goes_on, 0).otherwise(1)).over(down))
        .groupBy("path", "whole", "part").agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("owner").alias("owner")),
        "stretches")
    first, stop = F.col("start") + F.col("begin"), F.col("start") + F.col("end") + (WINDOW - 1)
    return (
        seen.select(*PLACE, "doc_id", "path", "start").join(stretches, "path").where("owner < doc_id")
        .groupBy(*PLACE).agg(F.sort_array(F.collect_list(F.struct(first.alias("first"), stop.alias("stop")))).alias("spans"))
    )


def cut(text: bytes, spans: list) -> tuple[bytes, int, int]:
    """The text without the spans of words, its words, and how many went. White space
    goes with the word before it."""
    if not spans:
        return text, len(text.split()), 0
    data = np.frombuffer(text, np.uint8)
    inside = ~np.isin(data, np.frombuffer(WHITE, np.uint8))
    begins = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    n = len(begins)
    gone = np.zeros(n + 1, np.int64)
    for s in spans:
        if not 0 <= s["first"] < s["stop"] <= n:
            raise ValueError(f"a span of words {s['first']} to {s['stop']} in a text of {n}")
        gone[s["first"]] += 1
        gone[s["stop"]] -= 1
    gone = np.cumsum(gone)[:n] > 0
    edges = np.append(begins, len(text))
    edges[0] = 0
    turn = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True]))))
    return b"".join(text[edges[a]:edges[b]] for a, b in zip(turn[::2], turn[1::2])), n, int(gone.sum())


class _Cut:
    """Rows with their texts cut, and words before and lost as last columns; with ``joined``
    after them the words left, joined by one space."""

    def __init__(self, joined: bool):
        self.joined = joined

    @lean
    def __call__(self, batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches, "_text"):
            done = [cut(t, s) for t, s in zip(texts(batch, "_text"), batch.column("spans").to_pylist())]
            nulls = batch.column("_text").is_null().to_pylist()
            text = pa.array([None if none else t.decode() for (t, *_), none in zip(done, nulls)], pa.string())
            names = [n for n in batch.schema.names if n != "spans"]
            more = [pa.array([n for _, n, _ in done], pa.int64()), pa.array([n for *_, n in done], pa.int64())]
            if self.joined:
                more.append(pa.array([b" ".join(t.split()) for t, *_ in done], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [*(text if n == "_text" else batch.column(n) for n in names), *more],
                names=[*names, *["n_words", "n_removed", "kept_words"][:len(more)]])


def without_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, joined: bool = False) -> DataFrame:
    """All rows and columns, the text without what is repeated, and ``n_words`` and
    ``n_removed`` after the others; with ``joined`` then ``kept_words``, the words left,
    joined by one space."""
    names = docs.columns
    inner = ["_text" if n == text else f"_c{i}" for i, n in enumerate(names)]
    plain = filed(docs.toDF(*inner))
    keyed = plain.withColumn("doc_id", F.col(inner[names.index(id_col)]).cast("long"))
    spans = stored(repeated_spans(keyed), "spans")
    rows = with_place(plain, **{c: c for c in inner}).join(spans.hint("merge"), PLACE, "left").drop(*PLACE)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields]
    more = {"n_words": "long", "n_removed": "long"} | ({"kept_words": "binary"} if joined else {})
    return rows.mapInArrow(_Cut(joined), ", ".join([*kinds, *[f"{n} {k}" for n, k in more.items()]])).toDF(*names, *more)


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), joined=True))


OP7_SQL = r"""
with split as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words from documents
), windows as (
  select doc_id, p, array_to_string(words[p:p + 49], ' ') as said
  from (select doc_id, words, unnest(range(1, len(words) - 48)) as p from split where len(words) >= 50)
), taken as (
  select doc_id, p from (select doc_id, p, min(doc_id) over (partition by said) as least from windows) where least < doc_id
), gone as (
  select distinct doc_id, p + k as p from (select doc_id, p, unnest(range(0, 50)) as k from taken)
), single as (
  select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from split
), kept as (
  select doc_id, string_agg(word, ' ' order by p) as said, count(*) as n
  from single anti join gone using (doc_id, p) group by doc_id
)
select doc_id, cast(len(words) as bigint) as n_words, cast(len(words) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(said, '')) as kept_sha256
from split left join kept using (doc_id)
"""
