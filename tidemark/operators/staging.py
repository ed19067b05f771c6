"""Cleaning: raw rows to typed, trimmed, canonical staging rows. Lazy and narrow.

Descriptive text is cut to the width of its column; keys are passed whole, since two
keys cut alike would become one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import blank_to_null, canonicalize, fit, is_mapped
from tidemark.schemas import (
    ACCOUNT_STATUSES, MONEY, ORDER_STATUSES, PLAN_TIERS, SUBSCRIPTION_STATUSES,
)


def _ingested(raw: DataFrame) -> list[Column]:
    return [F.col("_ingested_at").alias("ingested_at")] if "_ingested_at" in raw.columns else []


def stg_customers(raw: DataFrame, *keep: str) -> DataFrame:
    """``keep`` names further columns to pass through, such as the arrival order."""
    return raw.select(
        "customer_id",
        fit(blank_to_null("first_name"), 128).alias("first_name"),
        fit(blank_to_null("last_name"), 128).alias("last_name"),
        fit(F.lower(F.trim("email")), 255).alias("email"),
        fit(F.upper(F.trim("country_code")), 8).alias("country_code"),
        canonicalize("plan_tier", PLAN_TIERS).alias("plan_tier"),
        canonicalize("account_status", ACCOUNT_STATUSES).alias("account_status"),
        fit("acquisition_channel", 64).alias("acquisition_channel"),
        "source_updated_at",
        fit("_source_op", 1).alias("source_op"),
        F.col("_is_deleted").alias("is_deleted"),
        fit("_batch_id", 64).alias("batch_id"),
        *_ingested(raw), *keep,
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    gross = F.col("order_amount_usd").cast(MONEY)
    discount = F.coalesce(F.col("discount_usd"), F.lit(0)).cast(MONEY)
    return raw.select(
        "order_id",
        "customer_id",
        canonicalize("order_status", ORDER_STATUSES).alias("order_status"),
        "order_timestamp",
        F.to_date("order_timestamp").alias("order_date"),
        gross.alias("gross_amount_usd"),
        discount.alias("discount_usd"),
        (gross - discount).cast(MONEY).alias("net_amount_usd"),
        fit(F.upper(F.trim("payment_method")), 32).alias("payment_method"),
        fit(F.upper(F.trim("shipping_country")), 8).alias("shipping_country"),
        "source_updated_at",
        fit("_batch_id", 64).alias("batch_id"),
        *_ingested(raw),
    )


def clamp_start() -> Column:
    """A subscription cannot start after it was cancelled: the earlier time wins."""
    inverted = F.col("cancelled_at") < F.col("started_at")
    return F.when(inverted, F.col("cancelled_at")).otherwise(F.col("started_at"))


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    # Activity follows the status as delivered, not the canonical one.
    open_ended = F.col("cancelled_at").isNull() | (F.col("cancelled_at") > F.col("event_timestamp"))
    active = (F.upper(F.trim("status")) == "ACTIVE") & open_ended
    return raw.select(
        "subscription_event_id",
        "subscription_id",
        "customer_id",
        canonicalize("plan_tier", PLAN_TIERS).alias("plan_tier"),
        F.col("monthly_recurring_revenue").cast(MONEY).alias("mrr_amount_usd"),
        canonicalize("status", SUBSCRIPTION_STATUSES).alias("subscription_status"),
        fit(F.upper(F.trim("billing_frequency")), 32).alias("billing_frequency"),
        clamp_start().alias("started_at"),
        "cancelled_at",
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        F.coalesce(active, F.lit(False)).alias("is_active"),
        fit("_source_op", 1).alias("source_op"),
        fit("_batch_id", 64).alias("batch_id"),
        *_ingested(raw),
    )


def stg_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        "customer_id",
        "session_id",
        fit(F.lower(F.trim("event_name")), 64).alias("event_name"),
        fit(F.lower(F.trim("device_category")), 32).alias("device_category"),
        fit(F.lower(F.trim("operating_system")), 32).alias("operating_system"),
        fit(F.trim("page_path"), 255).alias("page_path"),
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        fit("_batch_id", 64).alias("batch_id"),
        *_ingested(raw),
    )


def unmapped_values(raw: DataFrame, column: str, domain) -> DataFrame:
    """Spellings no rule covers, with the default they fell to."""
    return (
        raw.where(~is_mapped(column, domain))
        .groupBy(F.col(column).alias("raw_value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("raw_value", F.lit(domain[1]).alias("mapped_value"), "row_count")
    )


def clamp_chronology(raw: DataFrame) -> DataFrame:
    """Subscription events with the start clamped, and whether it had to be."""
    changed = F.coalesce(F.col("cancelled_at") < F.col("started_at"), F.lit(False))
    return raw.select(
        "subscription_event_id", F.col("started_at").alias("raw_started_at"), "cancelled_at",
        clamp_start().alias("started_at"), changed.alias("was_clamped"),
    )


STAGING = {
    "customers": stg_customers,
    "orders": stg_orders,
    "subscriptions": stg_subscriptions,
    "events": stg_events,
}
