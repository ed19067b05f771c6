"""Text cleaning as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fit(column: Column | str, width: int) -> Column:
    """Cut to ``width`` characters. A cast to VARCHAR(n) would not cut in Spark."""
    return F.substring(F.col(column) if isinstance(column, str) else column, 1, width)


def canonicalize(column: Column | str, domain) -> Column:
    """Map spellings to canonical values; anything else, NULL included, takes the default."""
    groups, default = domain
    cleaned = F.upper(F.trim(F.col(column) if isinstance(column, str) else column))
    mapped = F.lit(None).cast("string")
    for value, spellings in reversed(groups):
        mapped = F.when(cleaned.isin(*spellings), F.lit(value)).otherwise(mapped)
    return F.coalesce(mapped, F.lit(default))


def is_mapped(column: Column | str, domain) -> Column:
    """Whether the value has a canonical spelling; NULL has none."""
    spellings = [s for _, group in domain[0] for s in group]
    cleaned = F.upper(F.trim(F.col(column) if isinstance(column, str) else column))
    return F.coalesce(cleaned.isin(*spellings), F.lit(False))


def blank_to_null(column: str) -> Column:
    return F.nullif(F.trim(F.col(column)), F.lit(""))
