"""Projections of the operational tables onto the four sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.skew import HOT_ROWS, Heat, left_join_many
from tidemark.schemas import MONEY

DEFAULT_COUNTRY = "India"
DEFAULT_METHOD = "card"
FIXED_TIER = "PRO"
DEFAULT_TIER = "STARTER"
DEFAULT_STATUS = "ACTIVE"


def project_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        "first_name", "last_name",
        F.col("primary_email").alias("email"),
        F.coalesce("country", F.lit(DEFAULT_COUNTRY)).alias("country_code"),
        F.lit(FIXED_TIER).alias("plan_tier"),
        F.upper(F.coalesce("lifecycle_stage", F.lit(DEFAULT_STATUS))).alias("account_status"),
        "acquisition_channel",
        F.col("created_at").alias("source_updated_at"),
        F.lit("I").alias("_source_op"),
        F.lit(False).alias("_is_deleted"),
    )


def project_orders(
    orders: DataFrame, intents: DataFrame, methods: DataFrame, addresses: DataFrame, hot: Heat | int = HOT_ROWS
) -> DataFrame:
    """An order with several payment intents appears once per intent; the upsert that
    follows keeps one. Small sides are broadcast by their measured size; a heavy
    method or address is on the preserved side, which adaptive execution can split."""
    intent = intents.select("order_id", F.col("payment_method_id").alias("_method"))
    method = methods.select(F.col("payment_method_id").alias("_method"), "method_name")
    address = addresses.select(F.col("address_id").alias("_address"), F.col("country").alias("_country"))
    joined = (
        left_join_many(orders, intent.where("order_id IS NOT NULL"), "order_id", hot)
        .join(method, "_method", "left")
        .join(address, F.col("shipping_address_id") == F.col("_address"), "left")
    )
    return joined.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("status").alias("order_status"),
        F.col("created_at").alias("order_timestamp"),
        F.coalesce("total", F.lit(0)).cast(MONEY).alias("order_amount_usd"),
        F.coalesce("discount", F.lit(0)).cast(MONEY).alias("discount_usd"),
        F.coalesce("method_name", F.lit(DEFAULT_METHOD)).alias("payment_method"),
        F.coalesce("_country", F.lit(DEFAULT_COUNTRY)).alias("shipping_country"),
        F.col("created_at").alias("source_updated_at"),
        F.lit("I").alias("_source_op"),
    )


def project_subscriptions(events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    contract = subscriptions.withColumnRenamed("subscription_id", "_contract")
    joined = events.join(contract, F.col("subscription_id") == F.col("_contract"), "left")
    return joined.select(
        F.col("event_id").cast("string").alias("subscription_event_id"),
        F.col("subscription_id").cast("string").alias("subscription_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.coalesce("to_plan", "plan", F.lit(DEFAULT_TIER)).alias("plan_tier"),
        F.coalesce("mrr_delta", "mrr", F.lit(0)).cast(MONEY).alias("monthly_recurring_revenue"),
        F.upper(F.coalesce("status", "event_type", F.lit(DEFAULT_STATUS))).alias("status"),
        F.lit("monthly").alias("billing_frequency"),
        F.coalesce("start_date", "event_time").alias("started_at"),
        "cancelled_at",
        F.col("event_time").alias("event_timestamp"),
        F.lit("I").alias("_source_op"),
    )


def project_events(events: DataFrame) -> DataFrame:
    user = F.col("user_id").cast("string")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.coalesce(user, F.lit("anonymous")).alias("customer_id"),
        F.concat(F.lit("sess_"), F.coalesce(user, F.lit("anon")), F.lit("_"), F.col("event_id").cast("string"))
        .alias("session_id"),
        F.col("event_type").alias("event_name"),
        F.lit("desktop").alias("device_category"),
        F.lit("unknown").alias("operating_system"),
        F.concat(F.lit("/app/"), "event_type").alias("page_path"),
        F.col("occurred_at").alias("event_timestamp"),
    )
