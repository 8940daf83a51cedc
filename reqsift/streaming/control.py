"""Starting and stopping named streaming steps in one session."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def running(spark: SparkSession) -> dict[str, StreamingQuery]:
    return {q.name: q for q in spark.streams.active if q.name}


def start(spark: SparkSession, jobs: Mapping[str, Callable[[str], StreamingQuery]]) -> dict[str, StreamingQuery]:
    """Start the jobs, each a function of its query name; names already running are refused."""
    taken = sorted(set(jobs) & set(running(spark)))
    if taken:
        raise ValueError(f"already running: {', '.join(taken)}")
    return {name: job(name) for name, job in jobs.items()}


def stop(spark: SparkSession, name: str) -> bool:
    """Stop the named step; its checkpoint lets it be started again. False if it does not run."""
    query = running(spark).get(name)
    if query is None:
        return False
    query.stop()
    return True
