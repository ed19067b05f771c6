"""Building the marts from raw tables, and reading the warehouse back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import marts, staging
from tidemark.operators.state import VersionedTable, materialize_mart
from tidemark.schemas import CONTRACTS


def plan_marts(spark: SparkSession, raw: dict[str, DataFrame], change_log: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four marts as lazy frames. ``raw`` holds the current rows of each source;
    with a change log of customers the dimension has history."""
    profiles = staging.stg_customers(raw["customers"])
    if change_log is not None:
        profiles = staging.stg_customers(change_log, "arrival_seq")
    return {
        "dim_date": marts.dim_date(spark),
        "dim_customer": marts.dim_customer_scd2(profiles),
        "fact_orders": marts.fact_orders(staging.stg_orders(raw["orders"])),
        "fact_subscription_events": marts.fact_subscription_events(staging.stg_subscriptions(raw["subscriptions"])),
    }


def build_marts(
    spark: SparkSession, root: str, raw: dict[str, DataFrame], batch_id: str, change_log: DataFrame | None = None
) -> dict[str, VersionedTable]:
    """Rebuild all marts under their contracts. Each becomes visible with its commit;
    they do not read each other, so their jobs are submitted side by side."""
    planned = plan_marts(spark, raw, change_log)

    def build(name: str) -> VersionedTable:
        return materialize_mart(spark, f"{root}/{name}", name, planned[name], CONTRACTS[name], batch_id)

    with ThreadPoolExecutor(max_workers=len(planned)) as pool:
        return dict(zip(planned, pool.map(inheritable_thread_target(spark)(build), planned)))


def warehouse(built: dict[str, VersionedTable], raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every layer by name: raw tables, staging views over them, stored marts."""
    layers = {f"raw_{source}": df for source, df in raw.items()}
    layers |= {f"stg_{source}": staging.STAGING[source](df) for source, df in raw.items()}
    return layers | {name: mart.read().drop("slice") for name, mart in built.items()}
