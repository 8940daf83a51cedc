"""Streaming jobs. Each micro-batch writes under its own id, so a replay after a failure overwrites itself."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Mapping
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..operators import counts, lookup, ordinal, sinks, state, windows
from ..session import committed, delete_path, qualified
from .steps import Sink, run_steps

FOLD_EVERY = 100


def writer(df: DataFrame, checkpoint: str, trigger: str | None = None, name: str | None = None) -> DataStreamWriter:
    """A stream writer that resumes from ``checkpoint``.

    ``trigger`` is an interval such as ``'10 seconds'``; without one, all that is there is processed and
    the query ends.
    """
    out = df.writeStream.option("checkpointLocation", checkpoint)
    out = out.trigger(processingTime=trigger) if trigger else out.trigger(availableNow=True)
    return out.queryName(name) if name else out


class LateRows(StreamingQueryListener):
    """Sums the rows that stateful operators dropped as too late, over all micro-batches of every query of a session.

    Make it before the queries start; a query itself remembers its last 100 micro-batches only.
    """

    def __init__(self, spark: SparkSession):
        self._dropped: Counter[str] = Counter()
        self._ended: defaultdict[str, Event] = defaultdict(Event)
        self._spark = spark
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._dropped[str(progress.runId)] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, timeout: float = 60) -> int:
        """Rows that this run of ``query`` dropped, all of them once it has ended."""
        run = str(query.runId)
        if not query.isActive and not self._ended[run].wait(timeout):
            raise TimeoutError("the end of the query was not reported")
        return self._dropped[run]

    def close(self) -> None:
        self._spark.streams.removeListener(self)


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The name under which a stream with this checkpoint, and no other, numbers its batches in a state."""
    return hashlib.sha256(qualified(spark, checkpoint).encode()).hexdigest()[:16]


def _add_counts(batch: DataFrame, key: str, state_root: str, batch_id: int, writer: str) -> None:
    state.put_counts(counts.count_by(batch, key).withColumnRenamed(key, "host"), state_root, batch_id, writer)


def _fold(batch: DataFrame, state_root: str, batch_id: int, writer: str, fold_every: int) -> None:
    if fold_every and batch_id % fold_every == fold_every - 1:
        state.fold_counts(batch.sparkSession, state_root, writer)


def count_into_state(
    stream: DataFrame, state_root: str, checkpoint: str, key: str = "host", fold_every: int = FOLD_EVERY, **options
) -> StreamingQuery:
    """Running counts per key: each micro-batch adds its own counts to the state table.

    Streams with checkpoints of their own may share a state. A stream's counts are folded after every ``fold_every`` of
    its batches (0: never).
    """
    me = writer_id(stream.sparkSession, checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        _add_counts(batch, key, state_root, batch_id, me)
        _fold(batch, state_root, batch_id, me, fold_every)

    return writer(stream.select(key), checkpoint, **options).foreachBatch(sink).start()


def sift_stream(
    requests: DataFrame,
    state_root: str,
    archive_root: str,
    checkpoint: str,
    order_by: str | None = None,
    spread_by: list[str] | None = None,
    fold_every: int = FOLD_EVERY,
    **options,
) -> StreamingQuery:
    """The main job: drop requests to listed hosts, count the rest into the state, archive their lines.

    ``requests`` has ``host`` and ``line``. The allowlist is read again in every micro-batch, so a change
    takes effect with the next one; a micro-batch that is done again uses the one it used before. With ``order_by`` the
    archived lines are numbered within the batch.
    """
    me = writer_id(requests.sparkSession, checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        listing = state.read_listing(spark, state_root, through=state.pinned_listing(spark, state_root, me, batch_id))
        kept = lookup.drop_listed(batch, listing, spread_by=spread_by).persist()
        try:
            _add_counts(kept, "host", state_root, batch_id, me)
            lines = ordinal.with_ordinal(kept, order_by, ordinal="seq") if order_by else kept
            lines.write.mode("overwrite").parquet(f"{archive_root}/batch={batch_id}")
        finally:
            kept.unpersist()
        _fold(batch, state_root, batch_id, me, fold_every)  # last: nothing of this batch is done again after it

    return writer(requests, checkpoint, **options).foreachBatch(sink).start()


def fan_out(stream: DataFrame, sinks_by_step: Mapping[str, Sink], checkpoint: str, **options) -> StreamingQuery:
    """Give every micro-batch to all steps; it is computed once.

    Each step is marked done with a batch, under the checkpoint. One that raises fails the batch after the others have run;
    done again, the batch goes to the failed steps only.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        run_steps(batch, batch_id, sinks_by_step, f"{checkpoint}/marks")

    return writer(stream, checkpoint, **options).foreachBatch(sink).start()


def windowed_distinct_to(
    stream: DataFrame,
    ts: str,
    duration: str,
    delay: str,
    key: str,
    *values: str,
    path: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Distinct tuples per window, appended as Parquet; ``delay`` is how late an event may come.

    Later ones are dropped: ``LateRows`` counts them, ``windows_and_late_to`` keeps them.
    """
    _check_zone(stream)
    timed = stream.select(F.col(ts).cast("timestamp").alias(ts), key, *values).withWatermark(ts, delay)
    out = windows.windowed_distinct(timed, ts, duration, key, *values)
    return writer(out, checkpoint, **options).outputMode("append").format("parquet").option("path", path).start()


def _check_zone(stream: DataFrame) -> None:
    if stream.sparkSession.conf.get("spark.sql.session.timeZone") != "UTC":
        raise ValueError("windows of zone-less times need a session whose spark.sql.session.timeZone is UTC")


def windows_and_late_to(
    stream: DataFrame,
    ts: str,
    duration: str,
    delay: str,
    key: str,
    *values: str,
    path: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Distinct tuples per window under ``path/windows``, and under ``path/late`` every row whose window was closed.

    The watermark is ``delay`` behind the latest time of all micro-batches before. A window is closed when it
    ends there or before; rows without a time are late. Each micro-batch writes its own distinct tuples, its late rows and the
    watermark for the next one, so a batch that is done again replaces itself; ``read_windows`` puts them together.
    """
    _check_zone(stream)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = f"{path}/watermark/batch="
        before = spark.read.parquet(f"{known}{batch_id - 1}") if committed(spark, f"{known}{batch_id - 1}") else None
        rows = batch.persist()
        try:
            seen = rows.agg(F.max(ts).alias("seen"))
            limit = before.select(F.expr(f"seen - interval {delay}")).scalar() if before else F.lit(None).cast("timestamp")
            window = F.window(F.col(ts), duration)
            closed = F.coalesce(F.col("_window.end") <= limit, F.lit(False))
            timed_rows = rows.withColumn("_window", window)  # without those that have no time
            ontime = timed_rows.filter(~closed).select(F.col("_window.start").alias("window_start"), key, *values).distinct()
            ontime.write.mode("overwrite").parquet(f"{path}/windows/batch={batch_id}")
            behind = timed_rows.filter(closed).drop("_window").unionByName(rows.filter(F.col(ts).isNull()))
            behind.write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            latest = seen.unionByName(before) if before else seen
            latest.agg(F.max("seen").alias("seen")).coalesce(1).write.mode("overwrite").parquet(f"{known}{batch_id}")
            delete_path(spark, f"{known}{batch_id - 2}")
        finally:
            rows.unpersist()

    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return writer(timed, checkpoint, **options).foreachBatch(sink).start()


def read_windows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The distinct tuples per window, and the late rows, that ``windows_and_late_to`` has written."""
    return spark.read.parquet(f"{path}/windows").drop("batch").distinct(), spark.read.parquet(f"{path}/late").drop("batch")


def topic_to(lines: DataFrame, servers: str, topic: str, checkpoint: str, **options) -> StreamingQuery:
    """Framed lines of a stream to a topic; needs the Kafka connector on the class path."""
    out = writer(sinks.topic_rows(lines), checkpoint, **options).format("kafka")
    return out.option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.acks", "1").start()


def json_by_key_to(
    stream: DataFrame, key: str, path: str, checkpoint: str, key_buckets: int | None = None, **options
) -> StreamingQuery:
    """Keyed JSON lines of a stream, one sub-directory per micro-batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        sinks.append_json(batch, key, f"{path}/batch={batch_id}", mode="overwrite", key_buckets=key_buckets)

    return writer(stream, checkpoint, **options).foreachBatch(sink).start()
