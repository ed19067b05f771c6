"""Activity by month as bit masks, against plain sets."""

import random
from collections import Counter
from datetime import date

import pytest
from conftest import rows
from test_plans import plan

from tidemark.operators import star


def brute(orders):
    """Retention and streaks from sets of months."""
    months, undated = {}, set()
    for customer, day in orders:
        if customer is None:
            continue
        months.setdefault(customer, set())
        if day is None:
            undated.add(customer)
        else:
            months[customer].add(day.year * 12 + day.month - 1)
    retention, streaks = Counter(), Counter()
    for customer, active in months.items():
        first = min(active) if active else None
        cohort = None if first is None else first // 12 * 100 + first % 12 + 1
        for month in active:
            retention[cohort, month - first] += 1
        if customer in undated:
            retention[cohort, None] += 1
        n = 0
        while first is not None and first + n in active:
            n += 1
            streaks[cohort, n] += 1
    return [sorted(((*k, v) for k, v in c.items()), key=repr) for c in (retention, streaks)]


@pytest.mark.parametrize("years", [1, 5, 40])
def test_masks_equal_sets(spark, years):
    """Spans of one and of several words, orders without a date or a customer."""
    rng = random.Random(years)
    orders = [(None if rng.random() < 0.02 else f"c{rng.randrange(40)}",
               None if rng.random() < 0.02 else date(1970 - rng.randrange(2) + rng.randrange(years), rng.randrange(1, 13), rng.randrange(1, 29)))
              for _ in range(1500)]
    df = spark.createDataFrame(orders, "customer_id string, order_date date")
    retention, streaks = brute(orders)
    assert rows(star.cohort_retention(df), "cohort_month", "month_offset", "active_customers") == retention
    assert rows(star.cohort_streaks(df), "cohort_month", "first_months", "customers") == streaks


def test_no_dates_and_no_rows(spark):
    df = spark.createDataFrame([("a", None)], "customer_id string, order_date date")
    assert rows(star.cohort_retention(df), "cohort_month", "month_offset", "active_customers") == [(None, None, 1)]
    assert star.cohort_streaks(df).count() == star.cohort_retention(df.where("false")).count() == 0


def test_masks_combine_before_the_only_shuffle_by_customer(tables):
    text = plan(star.active_months(tables.orders()))
    assert text.count("Exchange hashpartitioning(customer_id") == 1 and "partial_bit_or" in text
    assert plan(star.cohort_retention(tables.orders())).count("Exchange hashpartitioning(customer_id") == 1
