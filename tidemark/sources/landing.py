"""Landing files: Parquet and CSV in, daily directories out."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.incremental import since

log = logging.getLogger(__name__)


def scan_landing(
    spark: SparkSession, path: str, schema: T.StructType, ts: str, mark: datetime, *, inclusive: bool = False
) -> DataFrame:
    """Landing rows after the mark. The time condition is pushed into the scan, where
    it skips row groups. A path that does not exist is an empty source."""
    try:
        found = spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no landing files at %s", path)
        return spark.createDataFrame([], schema)
    return since(found, ts, mark, inclusive=inclusive)


# Quotes inside a value are doubled, blanks are content, and NULL has its own sign.
CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"', "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def scan_csv_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV extracts with strict quoting; a malformed record stops the read."""
    return spark.read.options(**CSV_OPTIONS, mode="FAILFAST").schema(schema).csv(path)


def write_csv_landing(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS, quoteAll=True).csv(path)


def write_landing_by_day(df: DataFrame, ts: str, path: str) -> None:
    """One directory per day, ``dt=YYYY-MM-DD``. A heavy day is split over tasks."""
    dated = df.withColumn("dt", F.date_format(ts, "yyyy-MM-dd"))
    dated.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(path)
