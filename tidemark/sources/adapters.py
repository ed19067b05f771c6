"""Shapes the given order and event tables into the four ingested sources.

Each adapter is one SQL text over the tables named in it. ``{TS}`` stands for the
engine's zone-less timestamp type. Values are made dirty on purpose (blanks, mixed
case, unknown spellings, NULLs, inverted dates), so that cleaning has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Stated rather than inferred, which would cost a job per table to read footers.
BASE_TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

ADAPTERS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_customers": (("customer", "nation"), """
        SELECT CONCAT('CUST-', LPAD(CAST(c_custkey AS STRING), 6, '0')) AS customer_id,
               CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE CONCAT(' First', CAST(c_custkey AS STRING)) END AS first_name,
               CONCAT('Last', CAST(c_custkey AS STRING), ' ') AS last_name,
               CONCAT('  User_', CAST(c_custkey AS STRING), '@Example.COM ') AS email,
               LOWER(n_name) AS country_code,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'professional' WHEN 'BUILDING' THEN ' Enterprise '
                    WHEN 'FURNITURE' THEN 'starter' WHEN 'HOUSEHOLD' THEN 'Free' ELSE 'basic' END AS plan_tier,
               CASE c_custkey % 7 WHEN 0 THEN 'active' WHEN 1 THEN 'At_Risk' WHEN 2 THEN ' churned'
                    WHEN 3 THEN 'cancelled' WHEN 4 THEN 'NEW' WHEN 5 THEN CAST(NULL AS STRING)
                    ELSE 'weird' END AS account_status,
               CASE WHEN c_acctbal < 0 THEN 'Referral' ELSE 'Direct' END AS acquisition_channel,
               CAST('2024-01-01 00:00:00' AS {TS}) + (c_custkey % 1000) * INTERVAL '1' MINUTE AS source_updated_at,
               'I' AS _source_op, c_custkey % 20 = 0 AS _is_deleted, 'first-customers' AS _batch_id
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""),
    # Many versions per customer; arrival order differs from event order.
    "customer_changes": (("events",), """
        SELECT CONCAT('CUST-', LPAD(CAST(user_id AS STRING), 6, '0')) AS customer_id,
               CASE WHEN user_id % 10 = 0 THEN '  ' ELSE CONCAT(' First', CAST(user_id AS STRING)) END AS first_name,
               CONCAT('Last', CAST(user_id AS STRING), ' ') AS last_name,
               CONCAT('  User_', CAST(event_id AS STRING), '@Example.COM ') AS email,
               CASE event_id % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'united states' ELSE ' de ' END AS country_code,
               CASE event_type WHEN 'signup' THEN 'free' WHEN 'view' THEN ' Starter' WHEN 'click' THEN 'professional'
                    WHEN 'purchase' THEN 'ENTERPRISE' ELSE 'basic' END AS plan_tier,
               CASE event_id % 6 WHEN 0 THEN 'active' WHEN 1 THEN 'AT_RISK' WHEN 2 THEN 'churned'
                    WHEN 3 THEN 'cancelled' WHEN 4 THEN 'new' ELSE CAST(NULL AS STRING) END AS account_status,
               'Direct' AS acquisition_channel, ts AS source_updated_at,
               CASE WHEN event_type = 'signup' THEN 'I'
                    WHEN event_type = 'error' AND event_id % 5 = 0 THEN 'D' ELSE 'U' END AS _source_op,
               event_type = 'error' AND event_id % 5 = 0 AS _is_deleted,
               CONCAT('BATCH-', CAST(event_id % 7 AS STRING)) AS _batch_id,
               (event_id % 7) * 1000000000 + event_id AS arrival_seq
        FROM {events}"""),
    # The same log without the changes that a purchase itself causes.
    "profile_changes": (("customer_changes",), """
        SELECT * FROM {customer_changes} WHERE plan_tier <> 'ENTERPRISE'"""),
    "raw_orders": (("orders", "customer", "nation"), """
        SELECT CONCAT('ORD-', LPAD(CAST(o_orderkey AS STRING), 7, '0')) AS order_id,
               CONCAT('CUST-', LPAD(CAST(o_custkey AS STRING), 6, '0')) AS customer_id,
               CASE o_orderkey % 9 WHEN 0 THEN 'Delivered' WHEN 1 THEN ' shipped ' WHEN 2 THEN 'COMPLETED'
                    WHEN 3 THEN 'placed' WHEN 4 THEN 'packed' WHEN 5 THEN 'PAID' WHEN 6 THEN 'cancelled'
                    WHEN 7 THEN 'refunded' ELSE 'lost' END AS order_status,
               o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND AS order_timestamp,
               CAST(o_totalprice AS DECIMAL(12,2)) AS order_amount_usd,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 500 AS DECIMAL(12,2)) END AS discount_usd,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN ' stripe'
                    WHEN '3-MEDIUM' THEN 'PayPal' ELSE 'apple_pay' END AS payment_method,
               LOWER(n_name) AS shipping_country,
               o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND AS source_updated_at,
               'I' AS _source_op, 'first-orders' AS _batch_id
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"""),
    # Profiles of customers who order: some changed in 1994 and 1996, some were deleted, and
    # those whose number 11 divides are unknown.
    "order_profiles": (("raw_customers",), """
        SELECT customer_id, first_name, last_name, email, country_code, plan_tier, account_status, acquisition_channel,
               CAST('1992-02-01 00:00:00' AS {TS}) + (CAST(SUBSTRING(customer_id, 6) AS INT) % 300) * INTERVAL '1' DAY
                   AS source_updated_at, 'I' AS _source_op, FALSE AS _is_deleted, 'first-profiles' AS _batch_id,
               CAST(1 AS BIGINT) AS arrival_seq
        FROM {raw_customers} WHERE CAST(SUBSTRING(customer_id, 6) AS INT) % 11 <> 0
        UNION ALL
        SELECT customer_id, first_name, last_name, email, country_code, 'enterprise', account_status, acquisition_channel,
               CAST('1994-03-01 12:00:00' AS {TS}) + (CAST(SUBSTRING(customer_id, 6) AS INT) % 50) * INTERVAL '1' HOUR,
               'U', FALSE, 'BATCH-94', CAST(2 AS BIGINT)
        FROM {raw_customers} WHERE CAST(SUBSTRING(customer_id, 6) AS INT) % 11 IN (1, 2, 3, 4)
        UNION ALL
        SELECT customer_id, first_name, last_name, email, country_code, 'free', account_status, acquisition_channel,
               CAST('1996-07-01 00:00:00' AS {TS}) + (CAST(SUBSTRING(customer_id, 6) AS INT) % 90) * INTERVAL '1' DAY,
               CASE WHEN plan_tier = 'basic' THEN 'D' ELSE 'U' END, plan_tier = 'basic', 'BATCH-96', CAST(3 AS BIGINT)
        FROM {raw_customers} WHERE CAST(SUBSTRING(customer_id, 6) AS INT) % 11 IN (3, 4, 5)"""),
    # Every order arrives once; then real updates, stale updates and exact ties.
    "order_changes": (("raw_orders",), """
        SELECT *, CAST(1 AS BIGINT) AS arrival_seq FROM {raw_orders}
        UNION ALL
        SELECT order_id, 'CUST-MUST-NOT-WIN', 'refunded', order_timestamp, order_amount_usd, order_amount_usd,
               'must_not_win', 'xx', source_updated_at + INTERVAL '1' DAY, 'U', 'BATCH-UPD', CAST(2 AS BIGINT)
        FROM {raw_orders} WHERE order_status IN ('Delivered', ' shipped ', 'COMPLETED')
        UNION ALL
        SELECT order_id, customer_id, 'STALE', order_timestamp, order_amount_usd, discount_usd, payment_method,
               shipping_country, source_updated_at - INTERVAL '1' DAY, 'U', 'BATCH-STALE', CAST(3 AS BIGINT)
        FROM {raw_orders} WHERE payment_method IN ('PayPal', ' stripe')
        UNION ALL
        SELECT order_id, customer_id, 'cancelled', order_timestamp, order_amount_usd, discount_usd, payment_method,
               shipping_country, source_updated_at, 'U', 'BATCH-TIE', CAST(4 AS BIGINT)
        FROM {raw_orders} WHERE discount_usd IS NULL OR payment_method = 'credit_card'"""),
    "raw_subscriptions": (("events",), """
        SELECT CONCAT('SUB-EVT-', LPAD(CAST(event_id AS STRING), 7, '0')) AS subscription_event_id,
               CONCAT('SUB-', LPAD(CAST(user_id AS STRING), 6, '0')) AS subscription_id,
               CONCAT('CUST-', LPAD(CAST(user_id AS STRING), 6, '0')) AS customer_id,
               CASE event_id % 5 WHEN 0 THEN 'pro' WHEN 1 THEN 'Professional' WHEN 2 THEN 'ENTERPRISE'
                    WHEN 3 THEN ' free ' ELSE 'basic' END AS plan_tier,
               CAST(value AS DECIMAL(12,2)) AS monthly_recurring_revenue,
               CASE event_id % 8 WHEN 0 THEN 'active' WHEN 1 THEN 'past_due' WHEN 2 THEN 'Trialing'
                    WHEN 3 THEN 'churned' WHEN 4 THEN 'CANCELLED' WHEN 5 THEN 'paused' WHEN 6 THEN 'expired'
                    ELSE 'unknown' END AS status,
               CASE WHEN event_id % 4 = 0 THEN 'annual' ELSE ' monthly' END AS billing_frequency,
               ts - INTERVAL '1' HOUR AS started_at,
               CASE event_id % 5 WHEN 0 THEN ts - INTERVAL '2' HOUR WHEN 1 THEN ts + INTERVAL '24' HOUR
                    ELSE NULL END AS cancelled_at,
               ts AS event_timestamp, 'I' AS _source_op, 'first-subscriptions' AS _batch_id
        FROM {events}"""),
    "subscription_changes": (("raw_subscriptions",), """
        SELECT *, CAST(1 AS BIGINT) AS arrival_seq FROM {raw_subscriptions}
        UNION ALL
        SELECT subscription_event_id, subscription_id, customer_id, 'must_not_win',
               CAST(monthly_recurring_revenue + CAST(1 AS DECIMAL(12,2)) AS DECIMAL(12,2)), 'past_due',
               billing_frequency, started_at, cancelled_at, event_timestamp + INTERVAL '2' HOUR, 'U', 'BATCH-UPD',
               CAST(2 AS BIGINT)
        FROM {raw_subscriptions} WHERE plan_tier IN ('pro', 'ENTERPRISE')
        UNION ALL
        SELECT subscription_event_id, subscription_id, customer_id, plan_tier,
               CAST(monthly_recurring_revenue + CAST(2 AS DECIMAL(12,2)) AS DECIMAL(12,2)), 'expired',
               billing_frequency, started_at, cancelled_at, event_timestamp + INTERVAL '1' HOUR, 'U', 'BATCH-LATE',
               CAST(3 AS BIGINT)
        FROM {raw_subscriptions} WHERE plan_tier = 'pro'
        UNION ALL
        SELECT subscription_event_id, subscription_id, customer_id, plan_tier, monthly_recurring_revenue, 'STALE',
               billing_frequency, started_at, cancelled_at, event_timestamp - INTERVAL '1' HOUR, 'U', 'BATCH-STALE',
               CAST(4 AS BIGINT)
        FROM {raw_subscriptions} WHERE status IN ('active', 'Trialing')"""),
    "raw_events": (("events",), """
        SELECT CONCAT('EVT-', LPAD(CAST(event_id AS STRING), 7, '0')) AS event_id,
               CONCAT('CUST-', LPAD(CAST(user_id AS STRING), 6, '0')) AS customer_id,
               CONCAT('SESS-', CAST(user_id AS STRING), '-', CAST(event_id % 4 AS STRING)) AS session_id,
               CONCAT(' ', UPPER(event_type)) AS event_name,
               CASE event_id % 3 WHEN 0 THEN 'Desktop' WHEN 1 THEN ' MOBILE' ELSE 'tablet' END AS device_category,
               CASE WHEN event_id % 2 = 0 THEN 'Linux ' ELSE 'macOS' END AS operating_system,
               CONCAT(' /app/', event_type) AS page_path, ts AS event_timestamp, 'first-events' AS _batch_id
        FROM {events}"""),
    # Every event is delivered twice; the replay carries a path that must not win.
    "event_arrivals": (("raw_events",), """
        SELECT *, CAST(1 AS BIGINT) AS arrival_seq FROM {raw_events}
        UNION ALL
        SELECT event_id, customer_id, session_id, event_name, device_category, operating_system,
               '/must-not-win', event_timestamp, 'BATCH-REPLAY', CAST(2 AS BIGINT) FROM {raw_events}"""),
    # Orders placed by event users, with customers that no profile knows.
    "pit_orders": (("events",), """
        SELECT CONCAT('PIT-', CAST(event_id AS STRING)) AS order_id,
               CASE WHEN event_id % 50 = 0 THEN 'CUST-ORPHAN'
                    ELSE CONCAT('CUST-', LPAD(CAST(user_id AS STRING), 6, '0')) END AS customer_id,
               ts AS order_timestamp, CAST(value AS DECIMAL(12,2)) AS net_amount_usd
        FROM {events} WHERE event_type = 'purchase'"""),
    # Discounts above the amount, repeated orders, missing and unknown customers.
    "dirty_orders": (("raw_orders",), """
        SELECT order_id, customer_id, order_status, order_timestamp, order_amount_usd,
               CASE WHEN payment_method = ' stripe' AND order_status = 'lost'
                    THEN CAST(order_amount_usd + CAST(1 AS DECIMAL(12,2)) AS DECIMAL(12,2))
                    ELSE discount_usd END AS discount_usd,
               payment_method, shipping_country, source_updated_at, _source_op, _batch_id
        FROM {raw_orders}
        UNION ALL
        SELECT order_id, CASE WHEN payment_method = 'PayPal' THEN NULL ELSE 'CUST-ORPHAN' END, order_status,
               order_timestamp, order_amount_usd, discount_usd, payment_method, shipping_country,
               source_updated_at, _source_op, 'BATCH-DUP'
        FROM {raw_orders} WHERE order_status = 'refunded' AND discount_usd IS NULL"""),
    # Upstream operational tables, for the source projections.
    "up_customers": (("customer", "nation"), """
        SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
               CONCAT(c_name, '@example.com') AS primary_email,
               CASE WHEN n_name = 'CHINA' THEN NULL ELSE n_name END AS country,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE LOWER(c_mktsegment) END AS lifecycle_stage,
               'web' AS acquisition_channel,
               CAST('2024-01-01 00:00:00' AS {TS}) + (c_custkey % 1000) * INTERVAL '1' MINUTE AS created_at
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""),
    "up_orders": (("orders",), """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_orderdate AS created_at,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS total,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderkey % 500 AS DECIMAL(12,2)) END AS discount,
               o_custkey AS shipping_address_id
        FROM {orders}"""),
    # Pending orders have no payment yet; urgent ones were paid in two attempts.
    "up_payment_intents": (("orders",), """
        SELECT o_orderkey AS order_id, o_orderkey % 4 AS payment_method_id FROM {orders} WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT o_orderkey, (o_orderkey + 1) % 4 FROM {orders} WHERE o_orderpriority = '1-URGENT'"""),
    # Method 3 is used by payments but missing here.
    "up_payment_methods": (("orders",), """
        SELECT DISTINCT o_orderkey % 3 AS payment_method_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'upi' ELSE 'wallet' END AS method_name
        FROM {orders}"""),
    "up_addresses": (("customer", "nation"), """
        SELECT c_custkey AS address_id, CASE WHEN n_name = 'CHINA' THEN NULL ELSE n_name END AS country
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""),
    "up_subscription_events": (("events",), """
        SELECT event_id, user_id AS subscription_id, user_id, event_type, ts AS event_time,
               CASE WHEN event_type IN ('click', 'view') THEN 'PRO' END AS to_plan,
               CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) END AS mrr_delta
        FROM {events}"""),
    # Users whose first event was an error never got a subscription row.
    "up_subscriptions": (("events",), """
        SELECT user_id AS subscription_id,
               CASE WHEN COUNT(*) > 60 THEN 'ENTERPRISE' END AS plan,
               CAST(MAX(value) AS DECIMAL(12,2)) AS mrr,
               CASE WHEN COUNT(*) > 65 THEN 'active' END AS status,
               CASE WHEN COUNT(*) > 55 THEN MIN(ts) END AS start_date,
               CASE WHEN COUNT(*) > 75 THEN MAX(ts) END AS cancelled_at
        FROM {events} GROUP BY user_id
        HAVING MIN(ts) < MIN(CASE WHEN event_type = 'error' THEN ts END)"""),
    "up_events": (("events",), """
        SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS user_id, event_type,
               ts AS occurred_at
        FROM {events}"""),
    # One commit per source and day, some of them failed.
    "commit_log": (("events",), """
        SELECT CASE event_type WHEN 'view' THEN 'events' WHEN 'click' THEN 'orders' WHEN 'error' THEN 'customers'
                    ELSE 'subscriptions' END AS source,
               CAST(CAST(ts AS DATE) AS STRING) AS batch_id,
               CAST(ROW_NUMBER() OVER (PARTITION BY CASE event_type WHEN 'view' THEN 'events' WHEN 'click' THEN 'orders'
                    WHEN 'error' THEN 'customers' ELSE 'subscriptions' END ORDER BY CAST(ts AS DATE)) AS BIGINT)
                    AS commit_no,
               MAX(ts) AS watermark, CAST(COUNT(*) AS BIGINT) AS records,
               CASE WHEN MAX(value) > 499 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE WHEN MAX(value) > 499 THEN 'extract failed' END AS error_message,
               MAX(ts) + INTERVAL '5' MINUTE AS committed_at
        FROM {events}
        GROUP BY CASE event_type WHEN 'view' THEN 'events' WHEN 'click' THEN 'orders' WHEN 'error' THEN 'customers'
                 ELSE 'subscriptions' END, CAST(ts AS DATE)"""),
    # One processing run per user and day.
    "run_log": (("events",), """
        SELECT CONCAT('RUN-', CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS run_id,
               MIN(ts) AS started_at, MIN(ts) + COUNT(*) * INTERVAL '320' SECOND AS finished_at
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)"""),
}


def table(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A given table, or one of the adapters over them. Nothing runs until an action.

    ``known`` remembers the frames of one folder, so that each is analysed once.
    """
    known = {} if known is None else known
    if name not in known:
        if name in BASE_TABLES:
            known[name] = spark.read.schema(BASE_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
        else:
            inputs, text = ADAPTERS[name]
            frames = {i: table(spark, sf_dir, i, known) for i in inputs}
            known[name] = spark.sql(text.replace("{TS}", "TIMESTAMP_NTZ"), **frames)
    return known[name]
