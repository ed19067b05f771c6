"""Incremental ingestion, star-schema modelling and data quality on Spark."""
