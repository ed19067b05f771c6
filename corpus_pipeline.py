"""The corpus pipeline: language, quality, near copies, repeated passages, packing.

Each stage takes what the one before has kept, and its decisions take effect. A stage's
result is written as Parquet to the shared folder and read again as the next one's
documents, so a lost executor costs no finished stage. Stages keep the columns of their
input, whatever further ones it has; the last returns the packed pieces. The case rules
of each operator (nulls, empty and long texts, equal ids, empty tables) are those of its
module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import jaccard, language, packing, passages, quality
from tidemark.llm.common import stored, table

#: A text in which the words of its language don't prevail over all others goes.
LEAST_SCORE = 0.5


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and those in which no language prevails."""
    return language.only_identified(docs, language.taught(docs), LEAST_SCORE)


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules or the isolation forest reject."""
    stats = stored(quality.measured(docs), "quality")
    return quality.only_good(docs, quality.fit(stats, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 words or more that a document of smaller id has; a document of
    which nothing is left goes."""
    cut = passages.without_repeats(docs)
    names = docs.columns
    inner = [f"_c{i}" for i in range(len(names))]
    plain = cut.toDF(*inner, "_words", "_removed").where("_removed = 0 or _removed < _words")
    if "n_chars" in names:  # the length of the text follows the text
        at, text = (f"_c{names.index(c)}" for c in ("n_chars", "text"))
        plain = plain.withColumn(at, F.when(F.col("_removed") > 0, F.length(text)).otherwise(F.col(at)).cast(docs.schema["n_chars"].dataType))
    return plain.select(*inner).toDF(*names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts into sequences of at most 1024 tokens."""
    return packing.digest(packing.packed(docs))


STAGES = [
    ("language", by_language),
    ("quality", by_quality),
    ("near copies", near_copies),
    ("repeated passages", repeated_passages),
    ("packing", packed),
]

#: Language, quality and packing rest on trained models and programs that SQL can't state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
