"""Steps and parsers by name: a chain of them is data, not code."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import counts, filters, lookup, ordinal, parse, sinks, windows
from ..operators import state as state_table
from ..sources import archives, topics
from ..sources.tables import read_table, stream_table
from ..streaming import jobs
from ..streaming.steps import run_steps

Apply = Callable[..., DataFrame]
Check = Callable[[Mapping[str, Any]], list[str]]


#: What a parameter of this name must be; others may be anything.
TYPES: dict[str, tuple[type, ...]] = {
    **dict.fromkeys(("col", "key", "ts", "duration", "order_by", "ordinal", "charset", "text", "value", "line", "mode"), (str,)),
    **dict.fromkeys(("path", "root", "folder", "name", "glob", "writer"), (str,)),
    **dict.fromkeys(("cols", "values", "keep", "spread_by", "within", "ties"), (list, tuple)),
    **dict.fromkeys(("max_files", "limit", "size", "rows_per_bucket", "max_broadcast_bytes", "after_day", "number", "key_buckets"), (int,)),
    **dict.fromkeys(("state", "other"), (str, DataFrame)),
}
POSITIVE = ("limit", "size", "rows_per_bucket", "key_buckets", "max_files")
#: The step that gives the rows to a chain of its own and passes them on as they came.
FORK = "fork"


@dataclass(frozen=True)
class MicroBatch:
    """What a step of a stream may need to know: the number of the micro-batch, and the name its stream writes under."""

    number: int
    writer: str


@dataclass(frozen=True)
class Step:
    """A function ``(DataFrame, **params) -> DataFrame`` with what it needs to be told.

    A ``source`` takes the session instead of a DataFrame and can only come first; a ``stream_source`` begins specs that run
    as streams. A ``sink`` writes and passes its rows on. ``whole`` steps say something of a whole table, which no micro-batch
    is. ``per_batch`` is what the step does in a stream, if that is something else: ``(DataFrame, MicroBatch, **params)``, with
    the parameters ``batch_required`` and ``batch_optional``.
    """

    name: str
    apply: Apply
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    check: Check | None = None
    source: bool = False
    stream_source: bool = False
    sink: bool = False
    whole: bool = False
    per_batch: Apply | None = None
    batch_required: tuple[str, ...] = ()
    batch_optional: tuple[str, ...] = ()

    def validate(self, params: Mapping[str, Any], stream: bool = False) -> list[str]:
        """Problems with ``params``; an empty list means none."""
        other = stream and self.per_batch
        required, optional = (self.batch_required, self.batch_optional) if other else (self.required, self.optional)
        known = set(required) | set(optional)
        problems = [f"{self.name}: missing parameter '{p}'" for p in required if p not in params]
        problems += [f"{self.name}: unknown parameter '{p}'" for p in params if p not in known]
        for p, given in params.items():
            kinds = TYPES.get(p) if p in known else None
            if kinds and (not isinstance(given, kinds) or isinstance(given, bool)):
                problems.append(f"{self.name}: '{p}' must be {' or '.join(_TYPE_NAMES[k] for k in kinds[:1] + kinds[2:])}")
            elif kinds == (list, tuple) and not all(isinstance(x, str) for x in given):
                problems.append(f"{self.name}: '{p}' must hold texts")
            elif p in POSITIVE and p in known and given <= 0:
                problems.append(f"{self.name}: '{p}' must be positive")
        if self.check and not problems:
            try:
                problems += [f"{self.name}: {p}" for p in self.check(params)]
            except Exception as error:
                problems.append(f"{self.name}: {error}")
        return problems


_TYPE_NAMES = {str: "a text", int: "a whole number", list: "a list of texts", DataFrame: "a table"}


@dataclass
class Registry:
    steps: dict[str, Step] = field(default_factory=dict)

    def register(self, step: Step) -> Step:
        if step.name in self.steps:
            raise ValueError(f"step '{step.name}' is registered already")
        self.steps[step.name] = step
        return step

    def validate(self, spec: Sequence[Mapping[str, Any]], stream: bool = False, inner: bool = False) -> list[str]:
        """Problems with a spec, a list of ``{"step": name, **params}``, before any plan is built."""
        if not isinstance(spec, (list, tuple)):
            return ["a spec is a list of steps"]
        problems = []
        for i, item in enumerate(spec):
            if not isinstance(item, Mapping):
                problems.append(f"item {i}: a step is a mapping")
                continue
            name = item.get("step")
            if name == FORK:
                problems += [f"item {i}: {FORK}: unknown parameter '{p}'" for p in _params(item) if p != "steps"]
                problems += [f"item {i}: {FORK}: {p}" for p in self.validate(item.get("steps"), stream, inner=True)]
            elif not isinstance(name, str) or name not in self.steps:
                problems.append(f"item {i}: unknown step '{name}'")
            else:
                step = self.steps[name]
                if (step.source or step.stream_source) and (i or inner):
                    problems.append(f"item {i}: {name}: a source comes first")
                elif step.stream_source and not stream:
                    problems.append(f"item {i}: {name}: a stream is started, not run")
                if stream and step.whole:
                    problems.append(f"item {i}: {name}: needs a whole table, not a micro-batch")
                problems += [f"item {i}: {p}" for p in step.validate(_params(item), stream)]
        if stream and not inner and not problems:
            first = spec[0].get("step") if spec else None
            if first is None or first == FORK or not self.steps[first].stream_source:
                problems = ["item 0: the first step must be a stream source"]
            elif not any(item["step"] == FORK or self.steps[item["step"]].sink for item in spec):
                problems = ["the stream writes nothing"]
        return problems

    def apply(self, df: DataFrame, spec: Sequence[Mapping[str, Any]]) -> DataFrame:
        """Chain the steps of ``spec`` onto ``df``."""
        problems = self.validate(spec)
        if problems:
            raise ValueError("; ".join(problems))
        if spec and spec[0]["step"] != FORK and self.steps[spec[0]["step"]].source:
            raise ValueError("a spec with a source is run, not applied to a table")
        for item in spec:
            if item["step"] == FORK:
                self.apply(df, item["steps"])
            else:
                df = df.transform(self.steps[item["step"]].apply, **_params(item))
        return df

    def run(self, spark: SparkSession, spec: Sequence[Mapping[str, Any]] | str) -> DataFrame:
        """A spec that begins with a source, as a list or as JSON text; returns what the last step gives.

        Sinks write when they are reached and pass their rows on.
        """
        spec = json.loads(spec) if isinstance(spec, str) else spec
        problems = self.validate(spec)
        if not problems and not (spec and spec[0]["step"] != FORK and self.steps[spec[0]["step"]].source):
            problems = ["item 0: the first step must be a source"]
        if problems:
            raise ValueError("; ".join(problems))
        return self.apply(self.steps[spec[0]["step"]].apply(spark, **_params(spec[0])), spec[1:])

    def stream(
        self, spark: SparkSession, spec: Sequence[Mapping[str, Any]] | str, checkpoint: str, trigger: str | None = None, name: str | None = None
    ) -> StreamingQuery:
        """Start a spec that begins with a stream source, as a list or as JSON text; it resumes from ``checkpoint``.

        The steps after the source make up one function of a micro-batch. Each sink and each fork is marked done with a
        batch, so if one of them fails, the batch that is done again leaves out the others; and each writes under the number
        of the batch, so what it had written before it failed is replaced.
        """
        spec = json.loads(spec) if isinstance(spec, str) else spec
        problems = self.validate(spec, stream=True)
        if problems:
            raise ValueError("; ".join(problems))
        me = jobs.writer_id(spark, checkpoint)

        def sink(batch: DataFrame, number: int) -> None:
            self._run_batch(batch, spec[1:], MicroBatch(number, me), f"{checkpoint}/marks", "")

        source = self.steps[spec[0]["step"]].apply(spark, **_params(spec[0]))
        return jobs.writer(source, checkpoint, trigger, name).foreachBatch(sink).start()

    def _run_batch(self, df: DataFrame, spec: Sequence[Mapping[str, Any]], batch: MicroBatch, marks: str, place: str) -> None:
        """The steps of ``spec`` on one micro-batch; neighbouring sinks and forks share their rows."""
        sinks: dict[str, Any] = {}

        def one(item, where):
            if item["step"] == FORK:
                return lambda rows, _: self._run_batch(rows, item["steps"], batch, marks, f"{where}.")
            return lambda rows, _: self._in_batch(rows, item, batch)

        for i, item in enumerate([*spec, None]):
            where = f"{place}{i}"
            if item and (item["step"] == FORK or self.steps[item["step"]].sink):
                sinks[f"{where} {item['step']}"] = one(item, where)
                continue
            if sinks:
                run_steps(df, batch.number, sinks, marks)
                sinks = {}
            if item:
                df = self._in_batch(df, item, batch)

    def _in_batch(self, df: DataFrame, item: Mapping[str, Any], batch: MicroBatch) -> DataFrame:
        step = self.steps[item["step"]]
        if step.per_batch:
            return step.per_batch(df, batch, **_params(item))
        return df.transform(step.apply, **_params(item))


def _params(item: Mapping[str, Any]) -> dict[str, Any]:
    return {k: v for k, v in item.items() if k != "step"}


def _frame(df: DataFrame, table: DataFrame | str) -> DataFrame:
    """A table given as such or by the path of its Parquet files."""
    return table if isinstance(table, DataFrame) else df.sparkSession.read.parquet(table)


def _listing(df: DataFrame, table: DataFrame | str) -> DataFrame:
    """A listing given as such or by the root of a stored state."""
    return table if isinstance(table, DataFrame) else state_table.read_listing(df.sparkSession, table)


def _known(df: DataFrame, table: DataFrame | str) -> DataFrame:
    return table if isinstance(table, DataFrame) else state_table.read_state(df.sparkSession, table)


def _nonblank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return filters.nonblank(df, *cols)


def _select(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def _distinct(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    return counts.distinct_per_key(df, key, *values)


def _windowed(df: DataFrame, ts: str, duration: str, key: str, values: Sequence[str]) -> DataFrame:
    return windows.windowed_distinct(df, ts, duration, key, *values)


def _drop_listed(df: DataFrame, state: DataFrame | str, **options) -> DataFrame:
    return lookup.drop_listed(df, _listing(df, state), **options)


def _enrich(df: DataFrame, state: DataFrame | str, **options) -> DataFrame:
    return lookup.enrich_with_state(df, _known(df, state), **options)


def _merge(df: DataFrame, state: DataFrame | str, key: str = "host") -> DataFrame:
    return counts.merge_counts(_known(df, state), df, key)


def _union(df: DataFrame, key: str, other: DataFrame | str) -> DataFrame:
    return counts.union_keys(key, df, _frame(df, other))


def _difference(df: DataFrame, other: DataFrame | str, key: str = "host") -> DataFrame:
    return counts.key_difference(df, _frame(df, other), key)


def _read_archives(spark: SparkSession, root: str, after_day: int | None = None, glob: str = "*.zip") -> DataFrame:
    return archives.scan_days(spark, root, after_day, glob)


def _write_archive(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    sinks.write_archive(df, path, mode)
    return df


def _append_json(df: DataFrame, key: str, path: str, **options) -> DataFrame:
    sinks.append_json(df, key, path, **options)
    return df


def _put_counts(df: DataFrame, root: str, number: int, writer: str = state_table.WRITER) -> DataFrame:
    state_table.put_counts(df, root, number, writer)
    return df


def _drop_listed_now(df: DataFrame, batch: MicroBatch, state: DataFrame | str, **options) -> DataFrame:
    """With the listing as it was when this micro-batch was first done."""
    if isinstance(state, str):
        spark = df.sparkSession
        state = state_table.read_listing(spark, state, through=state_table.pinned_listing(spark, state, batch.writer, batch.number))
    return lookup.drop_listed(df, state, **options)


def _archive_batch(df: DataFrame, batch: MicroBatch, path: str, order_by: str | None = None) -> DataFrame:
    """The rows as they are, numbered within the micro-batch with ``order_by``."""
    rows = ordinal.with_ordinal(df, order_by, ordinal="seq") if order_by else df
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch.number}")
    return df


def _json_batch(df: DataFrame, batch: MicroBatch, key: str, path: str, **options) -> DataFrame:
    sinks.append_json(df, key, f"{path}/batch={batch.number}", mode="overwrite", **options)
    return df


def _count_batch(df: DataFrame, batch: MicroBatch, root: str) -> DataFrame:
    state_table.put_counts(df, root, batch.number, batch.writer)
    return df


def default_registry() -> Registry:
    registry = Registry()
    # fmt: off
    for step in (
        Step("read_table", read_table, ("folder", "name"), source=True),
        Step("read_archives", _read_archives, ("root",), ("after_day", "glob"), source=True),
        Step("read_state", state_table.read_state, ("root",), source=True),
        Step("stream_table", stream_table, ("folder", "name"), ("max_files",), stream_source=True),
        Step("stream_archives", archives.stream_files, ("root",), ("glob", "max_files"), stream_source=True),
        Step("explode_archives", archives.explode_archives, (), ("charset",)),
        Step("parse_requests", parse.parse_requests, (), ("text", "keep", "observation")),
        Step("unframe", topics.unframe, (), ("value",)),
        Step("select", _select, ("cols",)),
        Step("nonblank", _nonblank, ("cols",)),
        Step("key_equals", filters.key_equals, ("col", "value")),
        Step("listed", filters.listed),
        Step(
            "drop_listed", _drop_listed, ("state",), ("key", "spread_by", "max_broadcast_bytes"), per_batch=_drop_listed_now,
            batch_required=("state",), batch_optional=("key", "spread_by", "max_broadcast_bytes"),
        ),
        Step("enrich_with_state", _enrich, ("state",), ("key", "spread_by", "max_broadcast_bytes")),
        Step("count_by", counts.count_by, (), ("key",)),
        Step("merge_counts", _merge, ("state",), ("key",), whole=True),
        Step("total_count", counts.total_count, whole=True),
        Step("rank_by_count", counts.rank_by_count, (), ("key", "limit"), whole=True),
        Step("distinct_per_key", _distinct, ("key", "values"), whole=True),
        Step("union_keys", _union, ("key", "other"), whole=True),
        Step("key_difference", _difference, ("other",), ("key",), whole=True),
        Step("exposure_by_host", counts.exposure_by_host, whole=True),
        Step("tumbling_counts", windows.tumbling_counts, ("ts", "duration", "key"), whole=True),
        Step("windowed_distinct", _windowed, ("ts", "duration", "key", "values"), whole=True),
        Step("with_ordinal", ordinal.with_ordinal, ("order_by",), ("within", "ordinal", "rows_per_bucket", "ties"), whole=True),
        Step("count_batches", ordinal.count_batches, ("order_by",), ("size", "rows_per_bucket"), whole=True),
        Step("framed_lines", sinks.framed_lines),
        Step("topic_rows", sinks.topic_rows, (), ("line",)),
        Step(
            "write_archive", _write_archive, ("path",), ("mode",), sink=True, per_batch=_archive_batch,
            batch_required=("path",), batch_optional=("order_by",),
        ),
        Step(
            "append_json", _append_json, ("key", "path"), ("mode", "key_buckets"), sink=True, per_batch=_json_batch,
            batch_required=("key", "path"), batch_optional=("key_buckets",),
        ),
        Step(
            "put_counts", _put_counts, ("root", "number"), ("writer",), sink=True, per_batch=_count_batch, batch_required=("root",),
        ),
    ):
        registry.register(step)
    return registry
