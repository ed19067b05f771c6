"""Ingestion runs over the four sources."""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.incremental import since, stamp_batch
from tidemark.operators.state import MAX_DELTAS, ChangeTable, Outcome
from tidemark.functions.dates import effective_mark
from tidemark.schemas import EPOCH, SOURCES

log = logging.getLogger(__name__)


class RunFailed(RuntimeError):
    """Sources of a run failed: ``problems`` says why, ``offered`` counts the rows of all, 0 for those that failed."""

    def __init__(self, offered: dict[str, int], problems: dict[str, Exception]):
        super().__init__("; ".join(f"source {source} failed: {problem}" for source, problem in problems.items()))
        self.offered, self.problems = offered, problems


def new_run_id() -> str:
    return f"RUN-{uuid.uuid4().hex[:8].upper()}"


def run_source(
    spark: SparkSession, root: str, source: str, changes: DataFrame, run_id: str, *,
    lookback: timedelta | None = None, full_refresh: bool = False, buckets: int | None = None,
    max_deltas: int = MAX_DELTAS, committed_at: datetime | None = None, loaded_at: datetime | None = None,
) -> Outcome:
    """Read what is new, stamp it, apply it and commit it with its mark.

    The changes may come with an ``arrival_seq`` of their own or, as projections of
    operational tables do, without. Rows and mark become visible in one commit. An error is recorded, leaves the
    mark where it was and is raised again.
    """
    table = ChangeTable(spark, f"{root}/{source}", source, buckets, max_deltas)
    try:
        head = table.head(run_id)
        mark = EPOCH if full_refresh else head.watermark or EPOCH
        ts = SOURCES[source].ts
        fresh = since(changes, ts, effective_mark(mark, lookback), inclusive=bool(lookback))
        return table.merge(stamp_batch(fresh, run_id), run_id, head=head, committed_at=committed_at, loaded_at=loaded_at)
    except Exception as problem:
        table.record_failure(run_id, str(problem), committed_at)
        raise


def run_all(
    spark: SparkSession, root: str, inputs: dict[str, DataFrame], run_id: str, **options
) -> dict[str, int]:
    """Run every source; one that fails does not stop the others.

    When all have ended and any failed, ``RunFailed`` is raised: a count of 0 means that
    a source had nothing new. Sources share nothing, so their jobs are submitted side by side.
    """
    def attempt(source: str) -> int | Exception:
        try:
            return run_source(spark, root, source, inputs[source], run_id, **options).offered
        except Exception as problem:
            log.error("source %s failed: %s", source, problem)
            return problem

    with ThreadPoolExecutor(max_workers=len(inputs)) as pool:
        ended = dict(zip(inputs, pool.map(inheritable_thread_target(spark)(attempt), inputs)))
    problems = {source: end for source, end in ended.items() if isinstance(end, Exception)}
    offered = {source: 0 if source in problems else end for source, end in ended.items()}
    if problems:
        raise RunFailed(offered, problems) from next(iter(problems.values()))
    return offered
