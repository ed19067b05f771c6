"""Bins of lateness against exact quantiles."""

import math
import random
from datetime import datetime, timedelta

import pytest
from conftest import rows

from tidemark.operators import incremental

MARK = datetime(2024, 5, 1)


def frame(spark, seconds):
    return spark.createDataFrame([(MARK - timedelta(seconds=s),) for s in seconds], "ts timestamp_ntz")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lookback_covers_the_share_within_the_stated_error(spark, seed):
    rng = random.Random(seed)
    late = [rng.choice([-5.0, 0.0, 0.25, rng.expovariate(1 / 3600), rng.paretovariate(0.5)]) for _ in range(2000)]
    shares = [0.1, 0.5, 0.9, 0.999, 1.0]
    chosen = {r.share: r for r in incremental.choose_lookback(incremental.lateness_bins(frame(spark, late), "ts", MARK), shares).collect()}
    for share in shares:
        exact = sorted(late)[math.ceil(share * len(late)) - 1]
        found = chosen[share].lookback_seconds
        assert chosen[share].row_count == len(late)
        assert sum(s <= found for s in late if s >= 0) + sum(s < 0 for s in late) >= share * len(late)
        assert max(exact, 0) <= found <= max(exact, 1) * incremental.GROWTH + 2


def test_bins_of_batches_add_up(spark):
    rng = random.Random(5)
    late = [rng.expovariate(1 / 500) - 100 for _ in range(900)]
    whole = incremental.lateness_bins(frame(spark, late), "ts", MARK)
    parts = [incremental.lateness_bins(frame(spark, late[n::3]), "ts", MARK) for n in range(3)]
    both = parts[2].unionByName(parts[0]).unionByName(parts[1])
    assert rows(incremental.choose_lookback(both, [0.3, 0.8])) == rows(incremental.choose_lookback(whole, [0.3, 0.8]))


def test_no_rows_and_all_on_time(spark):
    empty = frame(spark, [1.0]).where("false")
    assert incremental.choose_lookback(incremental.lateness_bins(empty, "ts", MARK), [0.5]).count() == 0
    (row,) = incremental.choose_lookback(incremental.lateness_bins(frame(spark, [-1.0, -9.0]), "ts", MARK), [0.9]).collect()
    assert row.lookback_seconds == 0
