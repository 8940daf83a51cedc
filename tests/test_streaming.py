import json

import pytest
from pyspark.sql import functions as F

from reqsift.operators import state, windows
from reqsift.plans.registry import default_registry
from reqsift.sources.tables import stream_table
from reqsift.streaming import control, flush, jobs
from reqsift.streaming.steps import StepsFailed, run_steps

SCHEMA = "id long, host string, line string, ts timestamp_ntz"


@pytest.fixture
def source(spark, tmp_path):
    """A folder to which tests add files; every file becomes one micro-batch."""

    class Source:
        folder = str(tmp_path / "source")
        root = str(tmp_path)

        def add(self, *hosts, start=0):
            rows = spark.createDataFrame([(start + i, h) for i, h in enumerate(hosts)], "id long, host string")
            rows = rows.withColumn("line", F.concat("host", F.lit("|| x"))).withColumn(
                "ts", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)")
            )
            rows.coalesce(1).write.mode("append").parquet(self.folder)

        def stream(self):
            return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.folder)

    return Source()


def read_counts(spark, root):
    return {r.host: r["count"] for r in state.read_counts(spark, root).collect()}


def test_running_counts_over_batches_and_restart(spark, source):
    def run():
        jobs.count_into_state(source.stream(), f"{source.root}/state", f"{source.root}/cp").awaitTermination()
        return read_counts(spark, f"{source.root}/state")

    source.add("a", "b", "a")
    source.add("a", "c")
    assert run() == {"a": 3, "b": 1, "c": 1}
    assert run() == {"a": 3, "b": 1, "c": 1}
    source.add("c")
    state.fold(spark, f"{source.root}/state")
    assert run() == {"a": 3, "b": 1, "c": 2}


def test_counts_are_folded_every_so_many_batches(spark, source):
    import os

    for _ in range(5):
        source.add("a", "b")
    root = f"{source.root}/state"
    jobs.count_into_state(source.stream(), root, f"{source.root}/cp", fold_every=2).awaitTermination()
    (me,) = os.listdir(f"{root}/counts")
    assert sorted(os.listdir(f"{root}/counts/{me}")) == ["base=3", "batch=4"]
    assert read_counts(spark, root) == {"a": 5, "b": 5}


def test_replayed_micro_batch_counts_once(spark, source):
    import os

    source.add("a", "b")
    cp = f"{source.root}/cp"
    jobs.count_into_state(source.stream(), f"{source.root}/state", cp).awaitTermination()
    for name in os.listdir(f"{cp}/commits"):  # as if the driver died before the commit
        os.remove(f"{cp}/commits/{name}")
    jobs.count_into_state(source.stream(), f"{source.root}/state", cp).awaitTermination()
    assert read_counts(spark, f"{source.root}/state") == {"a": 1, "b": 1}


def test_two_streams_and_a_new_checkpoint_share_a_state(spark, source):
    source.add("a", "b")
    source.add("a")
    root = f"{source.root}/state"
    for cp in ("one", "two"):
        jobs.count_into_state(source.stream(), root, f"{source.root}/{cp}").awaitTermination()
    state.fold(spark, root)
    jobs.count_into_state(source.stream(), root, f"{source.root}/three").awaitTermination()
    assert read_counts(spark, root) == {"a": 6, "b": 3}


def test_old_files_are_read(spark, tmp_path):
    import os
    import time

    folder, out = tmp_path / "t.parquet", str(tmp_path / "out")
    for day in (0, 20, 4000):
        before = set(folder.iterdir()) if folder.exists() else set()
        spark.range(day, day + 1).coalesce(1).write.mode("append").parquet(str(folder))
        for file in set(folder.iterdir()) - before:
            os.utime(file, (time.time() - day * 86_400,) * 2)
        stream = stream_table(spark, str(tmp_path), "t", max_files=1)
        jobs.writer(stream, f"{out}-cp").format("parquet").start(out).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 20, 4000]


def test_sift_done_again_after_it_folded(spark, source):
    """The driver dies before the commit of a batch that has folded; the listing changes; the batch is done again."""
    import os

    root, cp = f"{source.root}/state", f"{source.root}/cp"

    def run():
        jobs.sift_stream(source.stream(), root, f"{source.root}/archive", cp, fold_every=1).awaitTermination()

    state.put_listing(spark.createDataFrame([("a", "1")], "host string, status string"), root)
    source.add("a", "b")
    run()
    state.put_listing(spark.createDataFrame([("a", "0"), ("b", "1")], "host string, status string"), root)
    for name in os.listdir(f"{cp}/commits"):
        os.remove(f"{cp}/commits/{name}")
    run()
    assert read_counts(spark, root) == {"b": 1}
    assert [r.host for r in spark.read.parquet(f"{source.root}/archive").collect()] == ["b"]


def test_sift_reads_the_allowlist_in_every_micro_batch(spark, source):
    root = f"{source.root}/state"

    def run():
        jobs.sift_stream(
            source.stream(), root, f"{source.root}/archive", f"{source.root}/cp", order_by="id"
        ).awaitTermination()

    listing = spark.createDataFrame([("a", "1"), ("b", "0")], "host string, status string")
    state.put_listing(listing, root)
    source.add("a", "b", "c", "", None)
    run()
    assert read_counts(spark, root) == {"b": 1, "c": 1}
    state.put_listing(spark.createDataFrame([("a", "0"), ("b", "5")], "host string, status string"), root)
    source.add("a", "b", "c", start=10)
    run()
    assert {r.host: (r["count"], r.status) for r in state.read_state(spark, root).collect()} == {
        "a": (1, "0"), "b": (1, "5"), "c": (2, "0"),
    }
    rows = spark.read.parquet(f"{source.root}/archive").orderBy("id").collect()
    assert [(r.batch, r.seq, r.line) for r in rows] == [
        (0, 1, "b|| x"), (0, 2, "c|| x"), (1, 1, "a|| x"), (1, 2, "c|| x"),
    ]


def test_windowed_distinct_stream_equals_batch(spark, source):
    for n in range(3):
        source.add(*["a", "b", "a"] * 10, start=n * 25)
    jobs.windowed_distinct_to(
        source.stream(), "ts", "10 seconds", "1 hour", "host",
        path=f"{source.root}/out", checkpoint=f"{source.root}/cp",
    ).awaitTermination()
    got = spark.read.parquet(f"{source.root}/out").select(F.col("window_start").cast("timestamp_ntz"), "host")
    table = spark.read.schema(SCHEMA).parquet(source.folder)
    want = windows.windowed_distinct(table, "ts", "10 seconds", "host")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_state_of_closed_windows_is_dropped(spark, source):
    for n in range(5):
        source.add(*[f"h{i}" for i in range(20)], start=n * 100_000)
    query = jobs.windowed_distinct_to(
        source.stream(), "ts", "10 seconds", "1 minute", "host",
        path=f"{source.root}/out", checkpoint=f"{source.root}/cp",
    )
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert spark.read.parquet(f"{source.root}/out").count() == 100
    assert max(held) <= 40


def test_fan_out_gives_the_same_batches_to_all_steps(spark, source):
    source.add("a", "b")
    source.add("c")
    seen = {"one": [], "two": []}

    def step(name):
        return lambda batch, batch_id: seen[name].append((batch_id, sorted(r.host for r in batch.collect())))

    jobs.fan_out(source.stream(), {n: step(n) for n in seen}, f"{source.root}/cp").awaitTermination()
    assert seen["one"] == seen["two"] and sum(len(hosts) for _, hosts in seen["one"]) == 3


def test_json_by_key_stream(spark, source):
    source.add("a", "b")
    source.add("a", start=5)
    jobs.json_by_key_to(
        source.stream().select("id", "host"), "host", f"{source.root}/json", f"{source.root}/cp"
    ).awaitTermination()
    rows = spark.read.schema("id long, host string").json(f"{source.root}/json")
    assert sorted((r.id, r.host) for r in rows.collect()) == [(0, "a"), (1, "b"), (5, "a")]


def test_start_and_stop_by_name(spark, source):
    source.add("a")

    def job(name):
        return jobs.count_into_state(
            source.stream(), f"{source.root}/{name}", f"{source.root}/cp-{name}", trigger="1 seconds", name=name
        )

    started = control.start(spark, {"first": job, "second": job})
    try:
        assert set(control.running(spark)) == {"first", "second"}
        with pytest.raises(ValueError, match="first"):
            control.start(spark, {"first": job})
        for query in started.values():
            query.processAllAvailable()
        assert control.stop(spark, "first") and not control.stop(spark, "first")
        assert set(control.running(spark)) == {"second"}
        source.add("b")
        control.start(spark, {"first": job})["first"].processAllAvailable()
        assert read_counts(spark, f"{source.root}/first") == {"a": 1, "b": 1}
    finally:
        for query in spark.streams.active:
            query.stop()


def test_stream_of_a_table_file_and_of_a_table_folder(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    file = next(p for p in (tmp_path / "part.parquet").iterdir() if p.name.startswith("part-"))
    (tmp_path / "single").mkdir()
    (tmp_path / "single" / "part.parquet").write_bytes(file.read_bytes())
    for folder in (tmp_path, tmp_path / "single"):
        out = str(folder / "out")
        jobs.writer(stream_table(spark, str(folder), "part"), f"{out}-cp").format("parquet").start(out).awaitTermination()
        assert spark.read.parquet(out).count() == 10


# --- steps that fail alone --------------------------------------------------------------------------


def test_a_step_that_fails_is_done_again_alone(spark, source):
    source.add("a", "b")
    source.add("c")
    seen, failures = {"good": [], "bad": [], "last": []}, [1]

    def step(name):
        def sink(batch, batch_id):
            if name == "bad" and batch_id == 1 and failures:
                failures.pop()
                raise RuntimeError("no luck")
            seen[name].append((batch_id, sorted(r.host for r in batch.collect())))

        return sink

    def run():
        jobs.fan_out(source.stream(), {n: step(n) for n in seen}, f"{source.root}/cp").awaitTermination()

    with pytest.raises(Exception, match="no luck"):
        run()
    # The others were done with the batch all the same.
    assert [len(seen[n]) for n in ("good", "bad", "last")] == [2, 1, 2]
    run()
    assert seen["good"] == seen["last"] == seen["bad"] and [i for i, _ in seen["bad"]] == [0, 1]


def test_all_errors_are_told_and_marks_are_few(spark, tmp_path):
    import os

    def bad(batch, batch_id):
        raise KeyError(f"k{batch_id}")

    for n in range(5):
        with pytest.raises(StepsFailed) as error:
            run_steps(spark.range(1), n, {"a/b": bad, "c": lambda b, i: None, "d": bad}, str(tmp_path / "marks"))
        assert set(error.value.errors) == {"a/b", "d"}
    assert sorted(f for f in os.listdir(tmp_path / "marks" / "step=c") if not f.startswith(".")) == ["batch=3", "batch=4"]


# --- late rows --------------------------------------------------------------------------------------


def test_dropped_rows_are_counted_over_all_batches(spark, source):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for n in range(6):
            source.add("a", "b", start=100_000 * (3 - n))
        late = jobs.LateRows(spark)
        query = jobs.windowed_distinct_to(
            source.stream(), "ts", "10 seconds", "1 second", "host", path=f"{source.root}/out", checkpoint=f"{source.root}/cp"
        )
        query.awaitTermination()
        # Spark drops by the watermark before last, so nothing of the first two; what the query remembers of the rest is less.
        assert late.of(query) == 2 * 4
        assert sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators) < 8
        late.close()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def windows_and_late(spark, source, delay="1 second"):
    stream = source.stream().withColumn("_late", F.lit(1))
    jobs.windows_and_late_to(stream, "ts", "10 seconds", delay, "host", path=f"{source.root}/out", checkpoint=f"{source.root}/cp").awaitTermination()
    inside, late = jobs.read_windows(spark, f"{source.root}/out")
    return sorted((str(r.window_start), r.host) for r in inside.collect()), sorted(r.id for r in late.collect())


def test_windows_and_late_rows_are_all_rows(spark, source):
    source.add("a", "b", "a", start=0)
    source.add("a", start=100)  # the watermark stands at 99 s after it
    source.add("a", "b", start=5)
    source.add("c", start=95)  # behind the latest, but its window is open
    inside, late = windows_and_late(spark, source)
    assert inside == [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:00:00", "b"), ("2024-01-01 00:01:30", "c"), ("2024-01-01 00:01:40", "a")]
    assert late == [5, 6]
    source.add("z", start=3)
    assert windows_and_late(spark, source) == (inside, [3, 5, 6])  # across a restart


def test_a_batch_done_again_splits_as_before(spark, source):
    import os

    source.add("a", start=100)
    source.add("b", start=5)
    want = windows_and_late(spark, source)
    for name in ("1", ".1.crc"):
        os.remove(f"{source.root}/cp/commits/{name}")
    assert windows_and_late(spark, source) == want and want[1] == [5]


def test_rows_without_a_time_are_late(spark, source):
    source.add("a", "b")
    rows = spark.createDataFrame([(7, "n", "n|| x", None)], SCHEMA)
    rows.write.mode("append").parquet(source.folder)
    inside, late = windows_and_late(spark, source)
    assert late == [7] and len(inside) == 2


# --- batches by count or time -----------------------------------------------------------------------


def flushed(spark, source, size, span, delay="0 seconds"):
    batches = flush.count_or_time_batches(source.stream(), "host", "ts", size, span, delay)
    out = f"{source.root}/flushed"
    jobs.writer(batches, f"{source.root}/cp").outputMode("append").format("parquet").option("path", out).start().awaitTermination()
    rows = spark.read.parquet(out).withColumn("first", F.unix_seconds("first") % 86_400).withColumn("last", F.unix_seconds("last") % 86_400)
    return sorted((r.host, r.batch, r["first"], r["last"], r.rows, r.closed_by) for r in rows.collect())


def test_flush_by_count(spark, source):
    source.add(*["a"] * 7)
    source.add(*["a"] * 4, start=7)
    assert flushed(spark, source, 5, "1 hour") == [("a", 0, 0, 4, 5, "count"), ("a", 1, 5, 9, 5, "count")]


def test_flush_by_time_when_the_key_goes_on(spark, source):
    source.add("a", "a", "a")
    source.add("a", start=10)
    source.add("a", start=60)
    assert flushed(spark, source, 100, "10 seconds") == [("a", 0, 0, 2, 3, "time"), ("a", 1, 10, 10, 1, "time")]


def test_a_quiet_key_is_flushed(spark, source):
    """Nothing comes for the key any more; the time of the others closes its batch."""
    source.add("quiet", "busy")
    source.add("busy", start=5)
    source.add("busy", start=500)
    got = flushed(spark, source, 100, "10 seconds")
    assert ("quiet", 0, 0, 0, 1, "time") in got and ("busy", 0, 1, 5, 2, "time") in got and len(got) == 2


def test_flush_goes_on_after_a_restart(spark, source):
    source.add("a", "a", "a")
    assert flushed(spark, source, 4, "1 hour") == []
    source.add("a", "a", start=3)
    assert flushed(spark, source, 4, "1 hour") == [("a", 0, 0, 3, 4, "count")]


def test_flush_with_the_default_state_store(spark, source):
    """A session that names no state store has the one on the heap."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        source.add("quiet", "busy", "busy")
        assert flushed(spark, source, 2, "10 seconds") == [("busy", 0, 1, 2, 2, "count")]
        source.add("busy", start=10)
        assert flushed(spark, source, 2, "10 seconds")[1:] == [("quiet", 0, 0, 0, 1, "time")]  # over just at the watermark
    finally:
        spark.conf.set(name, before)


def test_flush_needs_sensible_bounds(spark, source):
    source.add("a")
    with pytest.raises(ValueError, match="one row"):
        flush.count_or_time_batches(source.stream(), "host", "ts", 0, "1 hour", "0 seconds")
    with pytest.raises(ValueError, match="duration"):
        flush.count_or_time_batches(source.stream(), "host", "ts", 1, "soon", "0 seconds")


# --- specs as streams -------------------------------------------------------------------------------


def spec_of(source, more=()):
    return json.dumps(
        [
            {"step": "stream_table", "folder": source.root, "name": "pages", "max_files": 1},
            {"step": "nonblank", "cols": ["host"]},
            {"step": "drop_listed", "state": f"{source.root}/state"},
            {"step": "fork", "steps": [{"step": "count_by", "key": "host"}, {"step": "put_counts", "root": f"{source.root}/state"}]},
            {"step": "write_archive", "path": f"{source.root}/archive", "order_by": "id"},
            *more,
        ]
    )


def test_a_spec_as_a_stream(spark, source):
    source.folder = f"{source.root}/pages.parquet"
    state.put_listing(spark.createDataFrame([("a", "1")], "host string, status string"), f"{source.root}/state")
    source.add("a", "b", "", "b")
    source.add("c", start=10)
    more = [{"step": "select", "cols": ["id", "host"]}, {"step": "append_json", "key": "host", "path": f"{source.root}/json"}]

    def run():
        default_registry().stream(spark, spec_of(source, more), f"{source.root}/cp").awaitTermination()
        archive = spark.read.parquet(f"{source.root}/archive").orderBy("batch", "seq").collect()
        lines = spark.read.schema("id long, host string").json(f"{source.root}/json").count()
        return read_counts(spark, f"{source.root}/state"), [(r.batch, r.seq, r.host) for r in archive], lines

    assert run() == ({"b": 2, "c": 1}, [(0, 1, "b"), (0, 2, "b"), (1, 1, "c")], 3)
    source.add("a", "d", start=20)
    assert run() == ({"b": 2, "c": 1, "d": 1}, [(0, 1, "b"), (0, 2, "b"), (1, 1, "c"), (2, 1, "d")], 4)


def test_a_spec_whose_archive_fails_counts_once(spark, source, monkeypatch):
    from reqsift.plans import registry

    source.folder = f"{source.root}/pages.parquet"
    source.add("a", "b", "b")
    steps = default_registry()
    broken, calls = steps.steps["write_archive"], []

    def once(df, batch, **params):
        calls.append(batch.number)
        if len(calls) == 1:
            raise RuntimeError("disk full")
        return broken.per_batch(df, batch, **params)

    steps.steps["write_archive"] = registry.Step(
        "write_archive", broken.apply, sink=True, per_batch=once, batch_required=("path",), batch_optional=("order_by",)
    )
    counted = []
    put = steps.steps["put_counts"]
    steps.steps["put_counts"] = registry.Step(
        "put_counts", put.apply, sink=True, batch_required=("root",),
        per_batch=lambda df, batch, **params: counted.append(batch.number) or put.per_batch(df, batch, **params),
    )
    with pytest.raises(Exception, match="disk full"):
        steps.stream(spark, spec_of(source), f"{source.root}/cp").awaitTermination()
    steps.stream(spark, spec_of(source), f"{source.root}/cp").awaitTermination()
    assert read_counts(spark, f"{source.root}/state") == {"a": 1, "b": 2} and counted == [0] and calls == [0, 0]
    assert spark.read.parquet(f"{source.root}/archive").count() == 3
