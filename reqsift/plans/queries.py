"""The named queries: ``(spark, folder) -> DataFrame`` over the tables in ``folder``."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import redact, request, text
from ..operators import counts, filters, lookup, ordinal, parse, sinks, state, windows
from ..session import age_files, list_children, scratch_dir
from ..sources import archives
from ..sources.tables import read_table, rows_after_day, stream_table
from ..streaming import control, flush, jobs
from . import derive, ingest
from .registry import default_registry

Query = Callable[[SparkSession, str], DataFrame]

LISTED_FROM = 9
BATCH_ROWS = 2000
FLUSH_ROWS, FLUSH_AFTER, FLUSH_DELAY = 30, "12 hours", "1 hour"
ARCHIVE_ROWS = 100
AFTER_DAY = "2024-01-15"

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- inputs -----------------------------------------------------------------------------------------


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return derive.requests_of(read_table(spark, folder, "pages"))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events")


def _transcripts(spark: SparkSession, folder: str) -> DataFrame:
    return derive.transcripts(read_table(spark, folder, "pages"))


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return parse.parse_requests(_transcripts(spark, folder), keep=("page_id",))


def _with_status(host_counts: DataFrame) -> DataFrame:
    """The rule of the test data: hosts with many requests are listed, but never a ``www.`` host.

    The exception leaves something to sift at every scale.
    """
    many = (F.col("count") >= LISTED_FROM) & ~F.col("host").startswith("www.")
    return host_counts.withColumn("status", F.when(many, "1").otherwise("0"))


def _host_state(spark: SparkSession, folder: str) -> DataFrame:
    return _with_status(counts.count_by(_requests(spark, folder)))


def _stored_listing(spark: SparkSession, folder: str) -> str:
    """The statuses as a stored listing, as the sifting job finds them; returns the state root."""
    root = scratch_dir(spark, "state")
    state.put_listing(_host_state(spark, folder), root)
    return root


def _half(requests: DataFrame, parity: int) -> DataFrame:
    return requests.filter(F.col("page_id") % 2 == parity)


def _window_text(column: str = "window_start"):
    return F.date_format(column, windows.WINDOW_FORMAT).alias("window_start")


# --- sources ----------------------------------------------------------------------------------------


@query
def scan_days_after(spark, folder):
    return rows_after_day(_events(spark, folder), "ts", AFTER_DAY).select("event_id", "event_type")


def _archive_root(spark, folder) -> str:
    root = scratch_dir(spark, "archives")
    derive.write_archives(derive.placed_transcripts(read_table(spark, folder, "pages")), root)
    return root


@query
def zip_listing(spark, folder):
    files = archives.scan_days(spark, _archive_root(spark, folder))
    return files.select("day", F.substring_index("path", "/", -1).alias("name"))


@query
def zip_days_after(spark, folder):
    files = archives.scan_days(spark, _archive_root(spark, folder), derive.FIRST_DAY)
    return files.select("day", F.substring_index("path", "/", -1).alias("name"))


@query
def zip_entries(spark, folder):
    """Every entry, its raw text told by length and digest: raw texts leave only through the parser."""
    root = _archive_root(spark, folder)
    entries = archives.explode_archives(archives.list_files(spark, root))
    return archives.with_day(entries, root).select(
        "day", "entry", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5")
    )


@query
def listing_sorted(spark, folder):
    return archives.list_sorted(spark, _archive_root(spark, folder))


@query
def archived_requests(spark, folder):
    root = _archive_root(spark, folder)
    parsed = ingest.archived_requests(archives.list_files(spark, root), root)
    return parsed.select(
        "day", "entry", "host", "url", "action_type", "has_password", text.encode_map(F.col("fields")).alias("fields")
    )


@query
def stream_source_counts(spark, folder):
    root = scratch_dir(spark, "source-counts")
    stream = stream_table(spark, folder, "events").select("event_id", "event_type")
    out = jobs.writer(stream, f"{root}/checkpoint").format("parquet").option("path", f"{root}/rows").start()
    out.awaitTermination()
    return counts.count_by(spark.read.parquet(f"{root}/rows"), "event_type")


@query
def state_keys(spark, folder):
    return state.state_keys(_host_state(spark, folder))


@query
def state_lookup(spark, folder):
    """Point read of the key that sorts first, which a scalar subquery finds; the filter goes below the counting."""
    first = _requests(spark, folder).agg(F.min("host")).scalar()
    return _host_state(spark, folder).filter(F.col("host") == first)


# --- scalar functions -------------------------------------------------------------------------------


@query
def request_host(spark, folder):
    return _transcripts(spark, folder).select("page_id", request.host(F.col("text")).alias("host"))


@query
def request_url(spark, folder):
    url = redact.redact_url(request.url(F.col("text"))).alias("url")
    return _transcripts(spark, folder).select("page_id", url)


@query
def request_method(spark, folder):
    return _transcripts(spark, folder).select("page_id", request.method(F.col("text")).alias("action_type"))


@query
def json_fields(spark, folder):
    fields = text.last_win_map(request.json_entries(F.col("props")))
    return (
        _events(spark, folder)
        .select("event_id", fields.alias("fields"))
        .select("event_id", F.col("fields")["k"].alias("k"), F.size("fields").cast("long").alias("n_fields"))
    )


@query
def payload_fields(spark, folder):
    return (
        _parsed(spark, folder)
        .filter(F.col("action_type") == "GET")
        .select("page_id", text.encode_map(F.col("fields")).alias("fields"))
    )


@query
def form_params(spark, folder):
    return (
        _parsed(spark, folder)
        .filter(F.col("action_type") == "POST")
        .select("page_id", F.to_json("request_parameters").alias("request_parameters"))
    )


@query
def kv_array(spark, folder):
    return _events(spark, folder).select("event_id", F.to_json(request.json_entries(F.col("props"))).alias("pairs"))


@query
def headers(spark, folder):
    return (
        _parsed(spark, folder)
        .filter(F.col("action_type") == "POST")
        .select("page_id", text.encode_map(F.col("fields")).alias("headers"))
    )


@query
def redacted_props(spark, folder):
    fields = redact.redact_map(text.last_win_map(request.json_entries(F.col("props"))), extra=("k",))
    return _events(spark, folder).select("event_id", text.encode_map(fields).alias("props"))


@query
def redacted_requests(spark, folder):
    return _parsed(spark, folder).select(
        "page_id",
        "host",
        "url",
        "action_type",
        "has_username",
        "has_password",
        text.encode_map(F.col("fields")).alias("fields"),
        F.to_json("request_parameters").alias("request_parameters"),
    )


def _event_map():
    return F.create_map(
        F.lit("type"), F.col("event_type"),
        F.lit("event"), F.col("event_id").cast("string"),
        F.lit("by"), F.col("user_id").cast("string"),
        F.lit("none"), F.lit(None).cast("string"),
    )


@query
def encode_map(spark, folder):
    return _events(spark, folder).select("event_id", text.encode_map(_event_map()).alias("line"))


@query
def decode_map(spark, folder):
    return (
        _events(spark, folder)
        .select("event_id", text.decode_map(text.encode_map(_event_map())).alias("m"))
        .select("event_id", *[F.col("m")[k].alias(f"m_{k}") for k in ("type", "event", "by", "none")])
    )


@query
def framed_lines(spark, folder):
    """Value column of the topic rows."""
    rows = sinks.topic_rows(sinks.framed_lines(filters.nonblank(_parsed(spark, folder), "host")))
    return rows.select("value")


@query
def frame_key(spark, folder):
    message = text.frame(F.col("event_type"), text.encode_map(_event_map()))
    return (
        _events(spark, folder)
        .select("event_id", message.alias("message"))
        .select(
            "event_id",
            text.frame_key(F.col("message")).alias("key"),
            text.frame_line(F.col("message")).alias("line"),
        )
    )


@query
def scalar_suite(spark, folder):
    name = F.col("p_name")
    return read_table(spark, folder, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.lower(F.col("p_type")).alias("lowered"),
        F.substring(name, 1, 3).alias("head"),
        F.replace(name, F.lit(" "), F.lit("[[:]]")).alias("replaced"),
        F.get(F.split(name, " "), F.lit(1)).alias("second"),
        F.array_join(F.split(name, " "), "[[--]]").alias("joined"),
        F.endswith(name, F.lit("ring")).alias("ends"),
        F.regexp_replace("p_brand", r"\D", "").cast("int").alias("number"),
        text.is_blank(F.nullif(F.col("p_type"), F.lit("SMALL"))).alias("blank"),
        (F.length(F.uuid()) == 36).alias("uuid_ok"),
        (F.unix_millis(F.current_timestamp()) > 0).alias("millis_ok"),
    )


# --- filters ----------------------------------------------------------------------------------------


def _some_blank(requests: DataFrame) -> DataFrame:
    blanked = F.when(F.col("page_id") % 7 == 0, "").when(F.col("page_id") % 11 == 0, F.lit(None))
    return requests.withColumn("host", blanked.otherwise(F.col("host")))


@query
def nonblank_key(spark, folder):
    return filters.nonblank(_some_blank(_requests(spark, folder)), "host").select("page_id", "host")


@query
def nonblank_all(spark, folder):
    part = read_table(spark, folder, "part").select(
        "p_partkey",
        F.nullif("p_brand", F.lit("Brand#2")).alias("brand"),
        F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_type")).alias("type"),
    )
    return filters.nonblank(part, "brand", "type")


@query
def key_equals(spark, folder):
    return filters.key_equals(_events(spark, folder), "event_type", "purchase").select("event_id", "user_id")


@query
def drop_bad_records(spark, folder):
    return _parsed(spark, folder).groupBy("action_type").agg(F.count(F.lit(1)).alias("kept"))


@query
def bad_records(spark, folder):
    return (
        parse.classify(_transcripts(spark, folder))
        .groupBy(F.col("_method").alias("action_type"))
        .agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("_bad")).alias("bad_records"))
    )


@query
def listed_hosts(spark, folder):
    return filters.listed(_host_state(spark, folder)).select("host", "status")


# --- joins ------------------------------------------------------------------------------------------


def _unlisted(spark, folder) -> DataFrame:
    listing = state.read_listing(spark, _stored_listing(spark, folder))
    return lookup.drop_listed(_requests(spark, folder), listing, spread_by=["page_id"])


@query
def unlisted_requests(spark, folder):
    return _unlisted(spark, folder).select("page_id", "host", "url")


@query
def unlisted_spread(spark, folder):
    """The same with the listing shuffled, the hot hosts spread over salts: the form for listings too large to broadcast."""
    listing = state.read_listing(spark, _stored_listing(spark, folder))
    kept = lookup.drop_listed(_requests(spark, folder), listing, spread_by=["page_id"], max_broadcast_bytes=0)
    return kept.select("page_id", "host", "url")


@query
def enrich_with_state(spark, folder):
    """All requests with what was known from those of the even pages."""
    requests = _requests(spark, folder)
    root = scratch_dir(spark, "state")
    state.put_counts(counts.count_by(_half(requests, 0)), root, 0)
    state.put_listing(_with_status(state.read_counts(spark, root)), root)
    known = state.read_state(spark, root)
    return lookup.enrich_with_state(requests, known, spread_by=["page_id"]).select(
        "page_id", "host", "known_count", "known_status"
    )


@query
def unlisted_stream(spark, folder):
    state_root = _stored_listing(spark, folder)
    root = scratch_dir(spark, "sift")
    stream = derive.requests_of(stream_table(spark, folder, "pages")).withColumn("line", text.frame(F.col("host"), F.col("url")))
    jobs.sift_stream(
        stream, state_root, f"{root}/archive", f"{root}/checkpoint", spread_by=["page_id"]
    ).awaitTermination()
    return spark.read.parquet(f"{root}/archive").select("page_id", "host", "line")


@query
def sift_archives(spark, folder):
    """The whole flow: archives as a stream, parsed, redacted, sifted, counted and archived."""
    state_root = _stored_listing(spark, folder)
    root = scratch_dir(spark, "sift-archives")
    files = archives.stream_files(spark, _archive_root(spark, folder))
    parsed = parse.parse_requests(archives.explode_archives(files), keep=("entry",), observation="sift_archives")
    lines = sinks.framed_lines(parsed).select("entry", "host", "line")
    jobs.sift_stream(lines, state_root, f"{root}/archive", f"{root}/checkpoint", spread_by=["entry"]).awaitTermination()
    return spark.read.parquet(f"{root}/archive").select("entry", "line")


# --- aggregations -----------------------------------------------------------------------------------


@query
def host_counts(spark, folder):
    return counts.count_by(_requests(spark, folder))


@query
def state_merge(spark, folder):
    requests = _requests(spark, folder)
    old = _with_status(counts.count_by(_half(requests, 0)))
    return counts.merge_counts(old, counts.count_by(_half(requests, 1)))


@query
def state_table(spark, folder):
    """The stored form of the merge: statuses, then one batch of counts per half."""
    requests = _requests(spark, folder)
    root = scratch_dir(spark, "state")
    for parity in (0, 1):
        state.put_counts(counts.count_by(_half(requests, parity)), root, parity)
    known = state.read_counts(spark, root, through=0)
    state.put_listing(_with_status(known), root)
    return state.read_state(spark, root)


@query
def total_count(spark, folder):
    return counts.total_count(counts.count_by(_requests(spark, folder)))


@query
def distinct_per_key(spark, folder):
    return counts.distinct_per_key(_events(spark, folder), "event_type", "user_id")


@query
def exposure_by_host(spark, folder):
    return counts.exposure_by_host(_parsed(spark, folder))


# --- order, ordinals, sets --------------------------------------------------------------------------


@query
def hosts_by_count(spark, folder):
    """The whole sifting step: unlisted requests, counted per host, ranked."""
    return counts.rank_by_count(counts.count_by(_unlisted(spark, folder)))


@query
def state_by_count(spark, folder):
    """The whole state table, ranked."""
    return counts.rank_by_count(_host_state(spark, folder))


@query
def top_hosts(spark, folder):
    return counts.rank_by_count(counts.count_by(_requests(spark, folder)), limit=10)


@query
def batch_ordinals(spark, folder):
    events = _events(spark, folder).select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return ordinal.with_ordinal(events, "event_id", within=["day"])


@query
def time_ordinals(spark, folder):
    """Events in order of time; the id, unique, decides between equal times."""
    events = _events(spark, folder).select("event_id", "ts")
    return ordinal.with_ordinal(events, "ts", ties=["event_id"]).select("event_id", "ordinal")


@query
def union_keys(spark, folder):
    requests = _requests(spark, folder)
    return counts.union_keys("host", _half(requests, 0), _half(requests, 1))


@query
def key_difference(spark, folder):
    known = _host_state(spark, folder)
    return counts.key_difference(known, known.filter(F.col("status") == "0"))


# --- batches, windows, streams ----------------------------------------------------------------------


@query
def count_batches(spark, folder):
    events = _events(spark, folder).select("event_id", "event_type")
    batched = ordinal.count_batches(events, "event_id", BATCH_ROWS)
    return batched.groupBy("batch", "event_type").agg(F.count(F.lit(1)).alias("count"), F.max("seq").alias("last_seq"))


@query
def archive_rows(spark, folder):
    """The lines are stored first: numbering reads them several times, parsing should happen once."""
    root = scratch_dir(spark, "archive")
    lines = sinks.framed_lines(filters.nonblank(_parsed(spark, folder), "host")).select("page_id", "line")
    lines.write.parquet(f"{root}/lines")
    sinks.write_archive(
        ordinal.count_batches(spark.read.parquet(f"{root}/lines"), "page_id", ARCHIVE_ROWS), f"{root}/rows"
    )
    return spark.read.parquet(f"{root}/rows")


@query
def json_by_key(spark, folder):
    path = scratch_dir(spark, "json")
    sinks.append_json(_events(spark, folder).select("event_id", "user_id", "event_type"), "event_type", path)
    return spark.read.schema("event_id bigint, user_id bigint, event_type string").json(path)


@query
def tumbling_counts(spark, folder):
    return windows.tumbling_counts(_events(spark, folder), "ts", "1 day", "event_type").select(
        _window_text(), "event_type", "count"
    )


@query
def windowed_distinct(spark, folder):
    return windows.windowed_distinct(_events(spark, folder), "ts", "1 day", "event_type", "user_id").select(
        _window_text(), "event_type", "user_id"
    )


@query
def windowed_distinct_stream(spark, folder):
    """Rows that come after their window was closed would be missing: the query raises if there are any."""
    root = scratch_dir(spark, "windowed")
    late = jobs.LateRows(spark)
    query_ = jobs.windowed_distinct_to(
        stream_table(spark, folder, "events"),
        "ts",
        "1 day",
        "30 days",
        "event_type",
        "user_id",
        path=f"{root}/rows",
        checkpoint=f"{root}/checkpoint",
    )
    query_.awaitTermination()
    dropped = late.of(query_)
    late.close()
    if dropped:
        raise RuntimeError(f"{dropped} rows came after their window was closed")
    return spark.read.parquet(f"{root}/rows").select(_window_text(), "event_type", "user_id")


@query
def late_events(spark, folder):
    """Events in three files: up to the 10th, from the 20th on, and then those between, whose windows are closed by then.
    What is in the windows and what came late are all rows."""
    root = scratch_dir(spark, "late-events")
    events = _events(spark, folder)
    day = F.dayofmonth("ts")
    for part in (events.filter(day <= 10), events.filter(day >= 20), events.filter(day.between(11, 19))):
        part.write.mode("append").parquet(f"{root}/events.parquet")
        jobs.windows_and_late_to(
            stream_table(spark, root, "events"), "ts", "1 day", "1 day", "event_type", "user_id",
            path=f"{root}/out", checkpoint=f"{root}/checkpoint",
        ).awaitTermination()
    inside, late = jobs.read_windows(spark, f"{root}/out")
    kinds = [F.lit(None).cast("long").alias("event_id"), F.lit("window").alias("kind")]
    late = late.select(F.date_trunc("day", "ts").alias("window_start"), "event_type", "user_id", "event_id", F.lit("late").alias("kind"))
    both = inside.select("window_start", "event_type", "user_id", *kinds).unionByName(late)
    return both.withColumn("window_start", _window_text())


@query
def count_or_time_batches(spark, folder):
    """Batches per kind of event that end with a number of rows or after some hours, those of kinds that fall silent too."""
    root = scratch_dir(spark, "flush")
    late = jobs.LateRows(spark)
    stream = stream_table(spark, folder, "events")
    batches = flush.count_or_time_batches(stream, "event_type", "ts", FLUSH_ROWS, FLUSH_AFTER, FLUSH_DELAY)
    out = jobs.writer(batches, f"{root}/checkpoint").outputMode("append").format("parquet").option("path", f"{root}/rows").start()
    out.awaitTermination()
    dropped = late.of(out)
    late.close()
    if dropped:
        raise RuntimeError(f"{dropped} rows came behind the watermark")
    rows = spark.read.parquet(f"{root}/rows")
    return rows.withColumn("first", F.unix_micros("first")).withColumn("last", F.unix_micros("last"))


@query
def fan_out(spark, folder):
    """One stream to two steps; their outputs are told apart by a tag."""
    root = scratch_dir(spark, "fan-out")

    def step(tag, key):
        def sink(batch, batch_id):
            counts.count_by(batch.withColumn("key", key), "key").write.mode("overwrite").parquet(
                f"{root}/out/step={tag}/batch={batch_id}"
            )

        return sink

    steps = {
        "by_type": step("by_type", F.col("event_type")),
        "by_day": step("by_day", F.date_format("ts", "yyyy-MM-dd")),
    }
    stream = stream_table(spark, folder, "events").select("event_type", "ts")
    jobs.fan_out(stream, steps, f"{root}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{root}/out")
    return rows.groupBy("step", "key").agg(F.sum("count").alias("count"))


@query
def running_counts(spark, folder):
    root = scratch_dir(spark, "running")
    stream = derive.requests_of(stream_table(spark, folder, "pages"))
    jobs.count_into_state(stream, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return state.read_state(spark, f"{root}/state")


@query
def running_counts_two_writers(spark, folder):
    """Two streams of all pages count into one state, which is folded between; one goes on under a new checkpoint."""
    root = scratch_dir(spark, "two-writers")
    for checkpoint, parity in (("one", 0), ("two", 1), ("three", 0), ("four", 1)):
        stream = derive.requests_of(stream_table(spark, folder, "pages"))
        jobs.count_into_state(_half(stream, parity), f"{root}/state", f"{root}/{checkpoint}").awaitTermination()
        state.fold(spark, f"{root}/state")
    return state.read_state(spark, f"{root}/state")


@query
def late_file_stream(spark, folder):
    """Pages as files of which half, added last, have time stamps 20 days before the others; across a restart."""
    root = scratch_dir(spark, "late-files")
    requests = _requests(spark, folder).select("page_id", "host")
    for age, parity in ((0, 0), (20, 1)):
        done = [name for name, _ in list_children(spark, f"{root}/pages.parquet")]
        _half(requests, parity).write.mode("append").parquet(f"{root}/pages.parquet")
        if age:
            age_files(spark, f"{root}/pages.parquet", age, but=done)
        stream = stream_table(spark, root, "pages", max_files=1)
        out = jobs.writer(stream, f"{root}/checkpoint").format("parquet").option("path", f"{root}/rows").start()
        out.awaitTermination()
    return spark.read.parquet(f"{root}/rows")


@query
def resumed_ingest(spark, folder):
    """Two days are ingested, then all three, the added one being the first: it is read though later ones are done."""
    pages = read_table(spark, folder, "pages")
    root, out = scratch_dir(spark, "days"), scratch_dir(spark, "ingested")
    first = F.col("page_id") % 3 == 0
    for part in (pages.filter(~first), pages.filter(first)):
        derive.write_archives(derive.placed_transcripts(part), root)
        ingest.ingest_days(spark, root, out)
    rows = ingest.read_ingested(spark, out).groupBy(F.col("day").cast("long").alias("day"), "host")
    return rows.agg(F.count(F.lit(1)).alias("requests"))


@query
def added_to_finished_day(spark, folder):
    """All days are ingested, then archives are added to each of them, and the ingest is run twice more: what is new is read,
    once."""
    pages = read_table(spark, folder, "pages")
    root, out = scratch_dir(spark, "days"), scratch_dir(spark, "ingested")
    placed = derive.placed_transcripts(pages)
    later = F.substring_index("entry", ".", 1).cast("long") % 4 == 3
    derive.write_archives(placed.filter(~later), root)
    ingest.ingest_days(spark, root, out)
    derive.write_archives(placed.filter(later).withColumn("archive", F.replace("archive", F.lit("part-"), F.lit("added-"))), root)
    for _ in range(2):
        ingest.ingest_days(spark, root, out)
    rows = ingest.read_ingested(spark, out)
    added = F.contains(F.substring_index("path", "/", -1), F.lit("added-"))
    return rows.select("day", "entry", "host", "url", added.alias("added"))


@query
def listing_two_writers(spark, folder):
    """Eight writers set the statuses of their hosts at once, then those of the first are set the other way, while the listing
    is folded."""
    root = scratch_dir(spark, "listing")
    known = _host_state(spark, folder).select("host", "status")
    share = F.pmod(F.crc32(F.col("host").cast("binary")), F.lit(8))

    def put(n: int) -> None:
        state.put_listing(known.filter(share == n), root)

    def turn(_: int) -> None:
        turned = F.when(F.col("status") == "0", "1").otherwise("0")
        state.put_listing(known.filter(share == 0).withColumn("status", turned), root)

    with ThreadPoolExecutor(8) as writers:
        list(writers.map(put, range(8)))
        list(writers.map(lambda job: job(0), [turn, lambda _: state.fold_listing(spark, root)]))
    state.fold(spark, root, logs=("listing",))
    return state.read_listing(spark, root).select("host", "status", (share == 0).alias("turned"))


@query
def stopped_and_restarted(spark, folder):
    """A job is started by name and stopped; it counts what came meanwhile when it is started again."""
    root = scratch_dir(spark, "restarted")
    pages = read_table(spark, folder, "pages").select("page_id", "url")

    def job(name):
        stream = derive.requests_of(stream_table(spark, root, "pages"))
        return jobs.count_into_state(stream, f"{root}/state", f"{root}/checkpoint", trigger="1 second", name=name)

    name = f"restarted-{root[-12:]}"
    for parity in (0, 1):
        _half(pages, parity).write.mode("append").parquet(f"{root}/pages.parquet")
        control.start(spark, {name: job})[name].processAllAvailable()
        control.stop(spark, name)
    return state.read_state(spark, f"{root}/state")


# --- steps by name ----------------------------------------------------------------------------------


@query
def steps_from_spec(spark, folder):
    """The sifting step once more, from a JSON text alone; equals ``hosts_by_count``."""
    source = scratch_dir(spark, "requests")
    _requests(spark, folder).write.parquet(f"{source}/requests.parquet")
    spec = json.dumps(
        [
            {"step": "read_table", "folder": source, "name": "requests"},
            {"step": "nonblank", "cols": ["host"]},
            {"step": "drop_listed", "state": _stored_listing(spark, folder), "spread_by": ["page_id"]},
            {"step": "count_by", "key": "host"},
            {"step": "rank_by_count"},
        ]
    )
    return default_registry().run(spark, spec)


@query
def stream_from_spec(spark, folder):
    """The sifting job from a JSON text: pages as a file stream, sifted, counted into the state and archived; started again
    for the second half. Per host, what was counted and what was archived."""
    root = scratch_dir(spark, "stream-spec")
    requests = _requests(spark, folder).withColumn("line", text.frame(F.col("host"), F.col("url")))
    spec = json.dumps(
        [
            {"step": "stream_table", "folder": root, "name": "requests", "max_files": 4},
            {"step": "nonblank", "cols": ["host"]},
            {"step": "drop_listed", "state": _stored_listing(spark, folder), "spread_by": ["page_id"]},
            {"step": "fork", "steps": [{"step": "count_by", "key": "host"}, {"step": "put_counts", "root": f"{root}/state"}]},
            {"step": "write_archive", "path": f"{root}/archive"},
        ]
    )
    for parity in (0, 1):
        _half(requests, parity).write.mode("append").parquet(f"{root}/requests.parquet")
        default_registry().stream(spark, spec, f"{root}/checkpoint").awaitTermination()
    archived = spark.read.parquet(f"{root}/archive").groupBy("host").agg(F.count(F.lit(1)).alias("archived"), F.count_distinct("line").alias("lines"))
    return state.read_counts(spark, f"{root}/state").join(archived, "host", "full_outer")


@query
def archives_to_archive(spark, folder):
    """From zip archives to JSON lines and on to the archive by specs."""
    out = scratch_dir(spark, "by-spec")
    spec = [
        {"step": "read_archives", "root": _archive_root(spark, folder)},
        {"step": "explode_archives"},
        {"step": "parse_requests", "keep": ["entry"]},
        {"step": "nonblank", "cols": ["host"]},
        {"step": "framed_lines"},
        {"step": "select", "cols": ["entry", "host", "line"]},
        {"step": "append_json", "key": "host", "path": f"{out}/json", "key_buckets": 4},
    ]
    default_registry().run(spark, json.dumps(spec))
    lines = spark.read.schema("entry string, line string").json(f"{out}/json")
    numbered = lines.withColumn("no", F.substring_index("entry", ".", 1).cast("long"))
    tail = [
        {"step": "count_batches", "order_by": "no", "size": ARCHIVE_ROWS},
        {"step": "write_archive", "path": f"{out}/rows"},
    ]
    default_registry().apply(numbered, tail)
    return spark.read.parquet(f"{out}/rows")
