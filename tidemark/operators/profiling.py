"""Profiles of raw tables and reconciliation with their landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def profile_table(df: DataFrame, name: str, key: str, ts: str) -> DataFrame:
    """Rows, key duplicates, time range and NULLs per column, as one row per column.

    Two reads: one of all columns that shuffles nothing but its result, and one of
    the key column alone, whose counts combine before the shuffle.
    """
    columns = F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count_if(F.col(f.name).isNull()).alias("null_count"))
        for f in df.schema
    ])
    figures = df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"),
        columns.alias("_columns"))
    keys = df.where(F.col(key).isNotNull()).select(key).distinct().agg(F.count(F.lit(1)).alias("distinct_keys"))
    both = figures.unionByName(keys, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return one.select(
        F.lit(name).alias("table_name"), "total_rows", "distinct_keys",
        (F.col("total_rows") - F.col("distinct_keys")).alias("duplicate_keys"), "min_ts", "max_ts",
        F.inline("_columns"))


def file_inventory(df: DataFrame) -> DataFrame:
    """Rows and bytes per landing file, from the reader's file metadata."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session that answers counts and bounds of Parquet files from their footers; the
    caller's own session keeps its settings."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def footer_aggregates(session: SparkSession, path: str, key: str) -> DataFrame:
    """Rows, rows with a key, and the bounds of a numeric key, without reading a row."""
    return session.read.parquet(path).agg(
        F.count(F.lit(1)).alias("row_count"), F.count(key).alias("keyed_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def footer_profile(spark: SparkSession, files: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per table of ``files`` (name: path and key): rows, rows without a key, bounds
    of the key, files and bytes. Only footers and the listing of files are read, so a table of any
    size costs its number of files."""
    session, rows = footer_session(spark), []
    for name, (path, key) in files.items():
        found = footer_aggregates(session, path, key).first()  # one row
        # Of whole files only the length is asked for, which the listing knows.
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        sizes = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        bounds = [None if b is None else int(b) for b in (found["min_key"], found["max_key"])]
        rows.append((name, found["row_count"], found["row_count"] - found["keyed_rows"], *bounds, sizes[0], sizes[1]))
    return spark.createDataFrame(
        rows, "table_name string, row_count long, null_keys long, min_key long, max_key long, files long, bytes long")


def reconcile_lake(landing: dict[str, DataFrame], raw: dict[str, DataFrame], manifest: DataFrame) -> DataFrame:
    """Landing files against raw tables and the manifest, one row per source."""
    from tidemark.operators.quality import union_all

    sides = []
    for name, df in landing.items():
        files = file_inventory(df).agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("landing_rows"), F.count(F.lit(1)).alias("landing_files"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("landing_bytes"))
        counted = raw[name].agg(F.count(F.lit(1)).alias("raw_rows"))
        both = files.unionByName(counted, allowMissingColumns=True)
        sides.append(both.agg(
            F.lit(name).alias("source_name"), F.lit(len(df.columns)).alias("landing_columns"),
            *[F.max(c).alias(c) for c in both.columns]))
    wanted = manifest.select(F.col("table_name").alias("_table"), F.col("baseline").alias("manifest_rows"))
    joined = union_all(sides).join(wanted, F.concat(F.lit("raw_"), "source_name") == F.col("_table"), "left")
    agree = (F.col("landing_rows") == F.col("raw_rows")) & (F.col("raw_rows") == F.col("manifest_rows"))
    return joined.drop("_table").withColumn("matched", F.coalesce(agree, F.lit(False)))
