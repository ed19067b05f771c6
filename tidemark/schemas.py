"""Schemas, value domains and thresholds. Fixed values, stated once."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

TS = T.TimestampNTZType()
MONEY = T.DecimalType(12, 2)
STR = T.StringType()
INT = T.IntegerType()
BOOL = T.BooleanType()
DATE = T.DateType()
LONG = T.LongType()

EPOCH = datetime(1970, 1, 1)
OPEN_END = "9999-12-31 23:59:59"
UNKNOWN_SK = "-1"
UNKNOWN = "UNKNOWN"


def struct(required: tuple[str, ...], **types: T.DataType) -> T.StructType:
    """A schema from keyword types; names listed in ``required`` are NOT NULL."""
    return T.StructType([T.StructField(n, t, n not in required) for n, t in types.items()])


RAW_CUSTOMERS = struct(
    ("customer_id", "source_updated_at", "_source_op", "_is_deleted", "_batch_id"),
    customer_id=STR, first_name=STR, last_name=STR, email=STR, country_code=STR,
    plan_tier=STR, account_status=STR, acquisition_channel=STR,
    source_updated_at=TS, _source_op=STR, _is_deleted=BOOL, _batch_id=STR,
)
RAW_ORDERS = struct(
    (
        "order_id", "customer_id", "order_status", "order_timestamp", "order_amount_usd", "source_updated_at",
        "_source_op", "_batch_id",
    ),
    order_id=STR, customer_id=STR, order_status=STR, order_timestamp=TS,
    order_amount_usd=MONEY, discount_usd=MONEY, payment_method=STR, shipping_country=STR,
    source_updated_at=TS, _source_op=STR, _batch_id=STR,
)
RAW_SUBSCRIPTIONS = struct(
    (
        "subscription_event_id", "subscription_id", "customer_id", "plan_tier", "monthly_recurring_revenue",
        "status", "billing_frequency", "started_at", "event_timestamp", "_source_op", "_batch_id",
    ),
    subscription_event_id=STR, subscription_id=STR, customer_id=STR, plan_tier=STR,
    monthly_recurring_revenue=MONEY, status=STR, billing_frequency=STR,
    started_at=TS, cancelled_at=TS, event_timestamp=TS, _source_op=STR, _batch_id=STR,
)
RAW_EVENTS = struct(
    ("event_id", "customer_id", "session_id", "event_name", "event_timestamp", "_batch_id"),
    event_id=STR, customer_id=STR, session_id=STR, event_name=STR,
    device_category=STR, operating_system=STR, page_path=STR,
    event_timestamp=TS, _batch_id=STR,
)


@dataclass(frozen=True)
class Source:
    """One ingested source: its key, its event-time column and, for sources that
    are updated in place, the columns an accepted later change may overwrite."""

    name: str
    schema: T.StructType
    key: str
    ts: str
    mutable: tuple[str, ...]
    stale_hours: tuple[int, int]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


SOURCES = {
    s.name: s
    for s in (
        Source(
            "customers", RAW_CUSTOMERS, "customer_id", "source_updated_at",
            tuple(n for n in RAW_CUSTOMERS.fieldNames() if n != "customer_id"), (24, 72),
        ),
        Source(
            "orders", RAW_ORDERS, "order_id", "source_updated_at",
            ("order_status", "order_amount_usd", "discount_usd", "source_updated_at", "_source_op", "_batch_id"),
            (12, 48),
        ),
        Source(
            "subscriptions", RAW_SUBSCRIPTIONS, "subscription_event_id", "event_timestamp",
            ("status", "monthly_recurring_revenue", "_source_op", "_batch_id"), (24, 72),
        ),
        Source("events", RAW_EVENTS, "event_id", "event_timestamp", (), (12, 48)),
    )
}

# Canonical values: (canonical, accepted spellings); the last column is the default.
PLAN_TIERS = (
    (("PRO", ("PRO", "PROFESSIONAL")), ("ENTERPRISE", ("ENTERPRISE",)),
     ("STARTER", ("STARTER",)), ("FREE", ("FREE",))),
    "STARTER",
)
ACCOUNT_STATUSES = (
    (("ACTIVE", ("ACTIVE",)), ("SUSPENDED", ("SUSPENDED", "AT_RISK")), ("CHURNED", ("CHURNED",)),
     ("CANCELLED", ("CANCELLED",)), ("PENDING", ("PENDING", "NEW"))),
    "ACTIVE",
)
ORDER_STATUSES = (
    (("COMPLETED", ("DELIVERED", "SHIPPED", "COMPLETED")), ("PENDING", ("PLACED", "PACKED", "PAID", "PENDING")),
     ("CANCELLED", ("CANCELLED",)), ("REFUNDED", ("REFUNDED",))),
    "PENDING",
)
SUBSCRIPTION_STATUSES = (
    (("ACTIVE", ("ACTIVE",)), ("PAST_DUE", ("PAST_DUE",)), ("TRIALING", ("TRIALING",)),
     ("CANCELLED", ("CHURNED", "CANCELLED")), ("EXPIRED", ("PAUSED", "EXPIRED"))),
    "ACTIVE",
)
TIER_RANK = (("FREE", 0), ("STARTER", 1), ("PRO", 2), ("ENTERPRISE", 3))
LIFECYCLE_TYPES = ("SIGNUP", "RENEWAL", "UPGRADE", "DOWNGRADE", "CHURN", "REACTIVATION")
TRACKED_ATTRIBUTES = ("plan_tier", "account_status", "country_code")

# Mart contracts.
DIM_DATE = struct(
    (
        "date_key", "date_day", "year", "quarter", "month", "month_name", "week_of_year", "day_of_month",
        "day_of_week", "day_name", "is_weekend",
    ),
    date_key=INT, date_day=DATE, year=INT, quarter=INT, month=INT, month_name=STR,
    week_of_year=INT, day_of_month=INT, day_of_week=INT, day_name=STR, is_weekend=BOOL,
)
DIM_CUSTOMER = struct(
    ("customer_sk", "customer_id", "plan_tier", "account_status", "valid_from", "valid_to", "is_current"),
    customer_sk=STR, customer_id=STR, first_name=STR, last_name=STR, email=STR, country_code=STR,
    plan_tier=STR, account_status=STR, acquisition_channel=STR,
    valid_from=TS, valid_to=TS, is_current=BOOL,
)
FACT_ORDERS = struct(
    (
        "order_id", "customer_id", "order_status", "order_timestamp", "order_date", "date_key",
        "gross_amount_usd", "discount_usd", "net_amount_usd",
    ),
    order_id=STR, customer_id=STR, order_status=STR, order_timestamp=TS, order_date=DATE, date_key=INT,
    gross_amount_usd=MONEY, discount_usd=MONEY, net_amount_usd=MONEY,
    payment_method=STR, shipping_country=STR,
)
FACT_SUBSCRIPTION_EVENTS = struct(
    (
        "subscription_event_id", "subscription_id", "customer_id", "plan_tier", "mrr_amount_usd",
        "subscription_status", "billing_frequency", "started_at", "event_timestamp", "event_date", "date_key",
        "is_active",
    ),
    subscription_event_id=STR, subscription_id=STR, customer_id=STR, plan_tier=STR, mrr_amount_usd=MONEY,
    subscription_status=STR, billing_frequency=STR, started_at=TS, cancelled_at=TS,
    event_timestamp=TS, event_date=DATE, date_key=INT, is_active=BOOL,
)
CONTRACTS = {
    "dim_date": DIM_DATE,
    "dim_customer": DIM_CUSTOMER,
    "fact_orders": FACT_ORDERS,
    "fact_subscription_events": FACT_SUBSCRIPTION_EVENTS,
}


def canonical_values(domain) -> list[str]:
    return [value for value, _ in domain[0]]


# Generic data tests: table -> unique columns, required columns, value domains.
_TIER = canonical_values(PLAN_TIERS)
_SUB = canonical_values(SUBSCRIPTION_STATUSES)
_ORDER = canonical_values(ORDER_STATUSES)
_ACCOUNT = canonical_values(ACCOUNT_STATUSES)


@dataclass(frozen=True)
class TableTests:
    unique: tuple[str, ...]
    not_null: tuple[str, ...]
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    dates: tuple[str, ...] = ()  # columns that must exist in dim_date.date_key


# What each table is tested for.
GENERIC_TESTS = {
    "raw_customers": TableTests(
        unique=("customer_id",),
        not_null=("customer_id", "source_updated_at", "_source_op", "_is_deleted"),
    ),
    "raw_orders": TableTests(
        unique=("order_id",),
        not_null=("order_id", "customer_id", "order_timestamp", "order_amount_usd"),
    ),
    "raw_subscriptions": TableTests(
        unique=("subscription_event_id",),
        not_null=("subscription_event_id", "subscription_id", "customer_id", "event_timestamp"),
    ),
    "raw_events": TableTests(
        unique=("event_id",),
        not_null=("event_id", "customer_id", "event_timestamp"),
    ),
    "stg_customers": TableTests(
        unique=("customer_id",),
        not_null=("customer_id", "plan_tier", "account_status", "source_updated_at", "is_deleted"),
        accepted=(("plan_tier", tuple(_TIER)), ("account_status", tuple(_ACCOUNT))),
    ),
    "stg_orders": TableTests(
        unique=("order_id",),
        not_null=(
            "order_id", "customer_id", "order_status", "order_timestamp", "gross_amount_usd", "discount_usd",
            "net_amount_usd",
        ),
        accepted=(("order_status", tuple(_ORDER)),),
    ),
    "stg_subscriptions": TableTests(
        unique=("subscription_event_id",),
        not_null=(
            "subscription_event_id", "subscription_id", "customer_id", "plan_tier", "mrr_amount_usd",
            "subscription_status", "started_at",
        ),
        accepted=(("plan_tier", tuple(_TIER)), ("subscription_status", tuple(_SUB))),
    ),
    "stg_events": TableTests(
        unique=("event_id",),
        not_null=("event_id", "customer_id", "session_id", "event_name", "event_timestamp"),
    ),
    "dim_date": TableTests(
        unique=("date_key", "date_day"),
        not_null=("date_key", "date_day"),
    ),
    "dim_customer": TableTests(
        unique=("customer_sk",),
        not_null=(
            "customer_sk", "customer_id", "plan_tier", "account_status", "valid_from", "valid_to",
            "is_current",
        ),
        accepted=(("plan_tier", tuple(_TIER)),),
    ),
    "fact_orders": TableTests(
        unique=("order_id",),
        not_null=(
            "order_id", "customer_id", "order_status", "order_timestamp", "order_date", "date_key",
            "gross_amount_usd", "discount_usd", "net_amount_usd",
        ),
        accepted=(("order_status", tuple(_ORDER)),),
        dates=("date_key",),
    ),
    "fact_subscription_events": TableTests(
        unique=("subscription_event_id",),
        not_null=(
            "subscription_event_id", "subscription_id", "customer_id", "plan_tier", "mrr_amount_usd",
            "subscription_status", "billing_frequency", "started_at", "event_timestamp", "event_date",
            "date_key", "is_active",
        ),
        accepted=(("plan_tier", tuple(_TIER)), ("subscription_status", tuple(_SUB))),
        dates=("date_key",),
    ),
}

# Monitoring thresholds.
FRESH_PASS_HOURS, FRESH_WARN_HOURS = 24, 48
VOLUME_PASS_PERCENT, VOLUME_WARN_PERCENT = 10, 25
RUNTIME_PASS_SECONDS, RUNTIME_WARN_SECONDS = 600, 1200
