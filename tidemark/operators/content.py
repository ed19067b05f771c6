"""Two states of a source compared by hash trees over their keys.

Keys are hashed into ``WIDTHS[-1]`` leaves; a node of a smaller width holds the leaves whose
number leaves its own as remainder. Every node has its rows and the sum of their hashes, so the tree of a
state is one aggregate that combines before its shuffle, whatever its buckets, files or order of
batches. Two trees are compared from the root down, and only nodes below a differing one are looked
at. Then only the buckets that hold differing leaves are read again, and keys that differ are named.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.quality import union_all
from tidemark.operators.state import ChangeTable, Head
from tidemark.session import new_folder

WIDTHS = (1, 16, 256, 4096)  # each divides the next


def _leaf(key: str, widths: tuple[int, ...]) -> str:
    return f"pmod(xxhash64(`{key}`), {widths[-1]})"


def _among(value: str, numbers: list[int]) -> Column:
    """As text, since thousands of literals are slow to make one by one."""
    return F.expr(f"{value} IN ({', '.join(map(str, numbers))})") if numbers else F.lit(False)


def content_tree(rows: DataFrame, key: str, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Per width and node its ``row_count`` and ``content``, the sum of its rows' hashes.
    Nodes without rows are left out; a null key is a key like others."""
    # Beside each value stands whether it is null, so that null is like no text.
    row_hash = F.xxhash64(*[part for c in sorted(rows.columns) for part in (F.col(c).cast("string"), F.col(c).isNull())])
    leaves = rows.groupBy(F.expr(_leaf(key, widths)).alias("leaf")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(row_hash.cast("decimal(38,0)")).alias("content"))
    nodes = F.explode(F.array(*[
        F.struct(F.lit(w).alias("width"), F.pmod("leaf", F.lit(w)).alias("node")) for w in widths])).alias("_node")
    return leaves.select(nodes, "row_count", "content").groupBy("_node.width", "_node.node").agg(
        F.sum("row_count").alias("row_count"), F.sum("content").cast("decimal(38,0)").alias("content"))


def stored_tree(table: ChangeTable, head: Head, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """The tree of a table as of a commit, written to the working folder."""
    rows = table.state(head, list(head.parts)).select(*table.source.columns)
    tree, path = content_tree(rows, table.source.key, widths), new_folder(table.spark, f"tree-{table.name}")
    tree.repartition(1).write.parquet(path)  # some thousand rows
    return table.spark.read.schema(tree.schema).parquet(path)


def differing_leaves(one: DataFrame, other: DataFrame, widths: tuple[int, ...] = WIDTHS) -> list[int]:
    """Leaves that are not the same in both trees, found from the root down; at most as
    many numbers as there are leaves."""
    above: list[int] | None = None
    for before, width in zip((1, *widths), widths):
        at = F.col("width") == width
        if above is not None:
            at &= _among(f"pmod(node, {before})", above)
        sides = [tree.where(at).select("node", F.struct("row_count", "content").alias(name)) for tree, name in ((one, "_one"), (other, "_other"))]
        unlike = sides[0].join(sides[1], "node", "full").where(~F.col("_one").eqNullSafe(F.col("_other")))
        above = sorted(r["node"] for r in unlike.select("node").collect())
        if not above:
            break
    return above or []


def _rows_of(table: ChangeTable, head: Head, leaves: list[int], widths: tuple[int, ...]) -> DataFrame:
    """Rows of some leaves. Where the number of buckets divides that of leaves, a leaf lies in
    one bucket, and no other is read."""
    parts = list(head.parts)
    if head.buckets and widths[-1] % head.buckets == 0:
        parts = sorted({str(n % head.buckets) for n in leaves})
    rows = table.state(head, parts)
    return rows.where(_among(_leaf(table.source.key, widths), leaves))


def differing_keys(
    one: tuple[ChangeTable, Head], other: tuple[ChangeTable, Head], trees: tuple[DataFrame, DataFrame] | None = None,
    widths: tuple[int, ...] = WIDTHS,
) -> DataFrame:
    """Keys whose rows differ between two states of one source: ``row_key`` as text and
    ``difference`` (``ADDED``: only in the other, ``REMOVED``: only in the first, ``CHANGED``)."""
    source = one[0].source
    trees = trees or (stored_tree(*one, widths), stored_tree(*other, widths))
    leaves = differing_leaves(*trees, widths)
    whole = F.struct(*source.columns)

    def side(state: tuple[ChangeTable, Head], name: str) -> DataFrame:
        rows = _rows_of(*state, leaves, widths).select(F.col(source.key).alias("_key"), whole.alias("_row"))
        blank = F.lit(None).cast(rows.schema["_row"].dataType)
        return rows.select("_key", *[(F.col("_row") if n == name else blank).alias(n) for n in ("_one", "_other")])

    both = side(one, "_one").unionByName(side(other, "_other")).groupBy("_key").agg(
        F.first("_one", ignorenulls=True).alias("_one"), F.first("_other", ignorenulls=True).alias("_other"))
    return both.where(~F.col("_one").eqNullSafe(F.col("_other"))).select(
        F.col("_key").cast("string").alias("row_key"),
        F.when(F.col("_one").isNull(), "ADDED").when(F.col("_other").isNull(), "REMOVED").otherwise("CHANGED").alias("difference"))


def rerun_differences(tables: dict[str, ChangeTable], rerun: Callable[[], object]) -> DataFrame:
    """Run ``rerun()`` and name the keys that it changed, per table. None means that it may be
    repeated. A table whose files are the same isn't read."""
    before = {name: table.head() for name, table in tables.items()}
    rerun()
    spark = next(iter(tables.values())).spark
    found = [spark.createDataFrame([], "source string, row_key string, difference string")]
    for name, table in tables.items():
        after = table.head()
        if before[name].parts != after.parts:
            found.append(differing_keys((table, before[name]), (table, after)).select(F.lit(name).alias("source"), "row_key", "difference"))
    return union_all(found)
