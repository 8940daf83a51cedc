"""The table of host counts and statuses, kept as batches of rows that add up.

``<root>/counts/writer=<id>/batch=<n>`` holds the counts of micro-batch ``n`` of one writer, ``base=<n>`` beside it all of
that writer's up to and including ``n``. A batch that is written again replaces itself, so a replayed micro-batch changes
nothing, and a batch costs its own size rather than that of the whole state. Writers number their batches on their own and
don't touch each other's. Directories without ``_SUCCESS`` are unfinished and are not read. Files are sorted by host.

``<root>/listing/data=<id>`` holds statuses that were set together, and ``<root>/listing/manifests/<n>.json`` which of them,
in which order, make up the listing after step ``n``. A manifest is put in place only if none of its number is there: of
writers that race, one wins and the others try again with the next number. Manifests don't change, so the listing of an
earlier step can be read until it is expired.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import committed, committed_below, delete_path, list_children, put_if_absent, read_text

COUNTS = "host string, count bigint"
LISTING = "host string, status string"
WRITER = "main"


def put_counts(rows: DataFrame, root: str, number: int, writer: str = WRITER) -> None:
    """Add ``rows(host, count)`` as batch ``number`` of ``writer``, typically the id of a micro-batch."""
    rows = rows.select("host", F.col("count").cast("long").alias("count")).sortWithinPartitions("host")
    rows.write.mode("overwrite").parquet(f"{root}/counts/writer={writer}/batch={number}")


def put_listing(rows: DataFrame, root: str) -> None:
    """Set the status of ``rows(host, status)``: ``'0'`` takes a host off the allowlist, others put it on.

    Any number of writers at a time; of statuses of one host, those of the later step hold.
    """
    name = _put_statuses(rows, root)
    _publish(rows.sparkSession, root, lambda parts, step: [*parts, [name, step]])


def _put_statuses(rows: DataFrame, root: str) -> str:
    name = "p" + uuid.uuid4().hex
    rows.select("host", "status").sortWithinPartitions("host").write.parquet(f"{root}/listing/data={name}")
    return name


def _manifests(spark: SparkSession, root: str) -> list[int]:
    names = [name for name, _ in list_children(spark, f"{root}/listing/manifests")]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _manifest(spark: SparkSession, root: str, number: int) -> list[list]:
    """``[id, step]`` of each part of the listing after step ``number``."""
    return json.loads(read_text(spark, f"{root}/listing/manifests/{number}.json")) if number >= 0 else []


def _publish(spark: SparkSession, root: str, change: Callable[[list, int], list]) -> int:
    """Put the next manifest, ``change`` of the latest one and its own number, in place."""
    while True:
        last = last_listing(spark, root)
        text = json.dumps(change(_manifest(spark, root, last), last + 1))
        if put_if_absent(spark, f"{root}/listing/manifests/{last + 1}.json", text):
            return last + 1


def last_listing(spark: SparkSession, root: str) -> int:
    """The number of the latest step of the listing, -1 before the first."""
    return max(_manifests(spark, root), default=-1)


def pinned_listing(spark: SparkSession, root: str, writer: str, number: int) -> int:
    """The listing step that batch ``number`` of ``writer`` uses: the latest when first asked, the same ever after."""
    path = f"{root}/pins/writer={writer}/batch={number}"
    if not committed(spark, path):
        pin = spark.createDataFrame([(last_listing(spark, root),)], "listing long")
        pin.coalesce(1).write.mode("overwrite").parquet(path)
        delete_path(spark, f"{root}/pins/writer={writer}/batch={number - 2}")
    return spark.read.parquet(path).first()["listing"]


def _numbers(names: list[str]) -> tuple[list[int], list[int]]:
    """The numbers of the bases and of the batches among folder names."""
    kinds = {"base": [], "batch": []}
    for name in names:
        kind, _, number = name.partition("=")
        if kind in kinds:
            kinds[kind].append(int(number))
    return sorted(kinds["base"]), sorted(kinds["batch"])


def _parts(names: list[str], through: int | None = None) -> tuple[list[int], list[int]]:
    """The base (none or one) and the batches after it that make up the state at ``through``; raises if that is gone."""
    bases, batches = _numbers(names)
    held = [n for n in bases if through is None or n <= through][-1:]
    # What a later base has folded is gone, unless all of it is still there.
    if bases and through is not None and not held and batches[:1] != [0]:
        raise ValueError(f"version {through} was folded into {bases[0]}")
    return held, [n for n in batches if (not held or n > held[0]) and (through is None or n <= through)]


def _rows(spark: SparkSession, log: str, schema: str, names: list[str], through: int | None = None) -> DataFrame:
    """All rows of a log with the number of their ``batch`` (-1 for the base)."""
    bases, batches = _parts(names, through)
    tables = [
        spark.read.schema(schema).parquet(f"{log}/base={n}").withColumn("batch", F.lit(-1).cast("long")) for n in bases
    ]
    if batches:
        reader = spark.read.schema(schema + ", batch bigint").option("basePath", log)
        tables.append(reader.parquet(*[f"{log}/batch={n}" for n in batches]))
    return reduce(DataFrame.unionByName, tables) if tables else spark.createDataFrame([], schema + ", batch bigint")


def read_listing(spark: SparkSession, root: str, through: int | None = None) -> DataFrame:
    """``host, status`` as set last (as of step ``through``), each host once; an expired step raises."""
    known = _manifests(spark, root)
    number = max(known, default=-1) if through is None else through
    if number >= 0 and number not in known:
        raise ValueError(f"step {number} of the listing was expired, or is to come")
    return _listed(spark, root, _manifest(spark, root, number))


def _listed(spark: SparkSession, root: str, parts: list[list]) -> DataFrame:
    log = f"{root}/listing"
    if not parts:
        return spark.createDataFrame([], LISTING)
    steps = F.create_map(*[F.lit(x) for name, step in parts for x in (name, step)])
    reader = spark.read.schema(LISTING + ", data string").option("basePath", log)
    rows = reader.parquet(*[f"{log}/data={name}" for name, _ in parts])
    return rows.groupBy("host").agg(F.max_by("status", F.element_at(steps, F.col("data"))).alias("status"))


def _writers(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The finished folders of each writer."""
    writers: dict[str, list[str]] = {}
    for path in committed_below(spark, f"{root}/counts", 2):
        writer, _, name = path.partition("/")
        writers.setdefault(writer.removeprefix("writer="), []).append(name)
    return writers


def read_counts(spark: SparkSession, root: str, through: int | None = None, writer: str = WRITER) -> DataFrame:
    """``host, count``, each host once, of all writers; ``through`` takes ``writer`` as of that micro-batch.

    A version that was folded into a later one raises.
    """
    tables = [
        _rows(spark, f"{root}/counts/writer={name}", COUNTS, names, through if name == writer else None)
        for name, names in sorted(_writers(spark, root).items())
    ]
    rows = reduce(DataFrame.unionByName, tables) if tables else spark.createDataFrame([], COUNTS)
    return rows.groupBy("host").agg(F.sum("count").alias("count"))


def read_state(spark: SparkSession, root: str, through: int | None = None) -> DataFrame:
    """``host, count, status``, each host once; a host whose status was never set has ``'0'``.

    Both sides come out of their aggregation partitioned by host, so the join shuffles nothing more.
    """
    return (
        read_counts(spark, root, through)
        .join(read_listing(spark, root), "host", "full_outer")
        .select(
            "host",
            F.coalesce("count", F.lit(0).cast("long")).alias("count"),
            F.coalesce("status", F.lit("0")).alias("status"),
        )
    )


def state_keys(table: DataFrame, key: str = "host") -> DataFrame:
    """All keys, each once, in order."""
    return table.select(key).distinct().orderBy(key)


def state_get(table: DataFrame, host: str, key: str = "host") -> DataFrame:
    """The row of one key; for many keys use ``lookup.enrich_with_state``."""
    return table.filter(F.col(key) == F.lit(host))


def _replace(now: DataFrame, spark: SparkSession, log: str, names: list[str], keep_history: bool) -> None:
    bases, batches = _parts(names)
    if not batches:
        return
    now.sortWithinPartitions("host").write.mode("overwrite").parquet(f"{log}/base={batches[-1]}")
    if not keep_history:
        for n in batches:
            delete_path(spark, f"{log}/batch={n}")
        for n in bases:
            delete_path(spark, f"{log}/base={n}")


def fold_counts(spark: SparkSession, root: str, writer: str = WRITER, keep_history: bool = False) -> None:
    """Write one writer's present counts as its new base and drop the parts it replaces; called by that writer."""
    log, names = f"{root}/counts/writer={writer}", _writers(spark, root).get(writer, [])
    now = _rows(spark, log, COUNTS, names).groupBy("host").agg(F.sum("count").alias("count"))
    _replace(now, spark, log, names, keep_history)


def fold(spark: SparkSession, root: str, logs: tuple[str, ...] = ("counts", "listing"), keep_history: bool = False) -> None:
    """Write each log's present state as its new base and drop the parts it replaces.

    Called between batches of all writers. Readers still at work on the old parts need ``keep_history``.
    """
    if "counts" in logs:
        for writer in _writers(spark, root):
            fold_counts(spark, root, writer, keep_history)
    if "listing" in logs:
        fold_listing(spark, root)
        if not keep_history:
            expire_listing(spark, root)


def fold_listing(spark: SparkSession, root: str) -> None:
    """Write the present listing as one part of the next manifest; earlier steps stay as they are. Others may write meanwhile."""
    last = last_listing(spark, root)
    parts = _manifest(spark, root, last)
    if len(parts) < 2:
        return
    name = _put_statuses(_listed(spark, root, parts), root)
    # What others have set since comes after it.
    _publish(spark, root, lambda now, _: [[name, last], *(p for p in now if p[1] > last)])


def expire_listing(spark: SparkSession, root: str) -> None:
    """Delete the steps before the latest one and before all that a batch is pinned to, and the parts only they have."""
    known = _manifests(spark, root)
    paths = [f"{root}/pins/{p}" for p in committed_below(spark, f"{root}/pins", 2)]
    pinned = spark.read.parquet(*paths).agg(F.min("listing")).first()[0] if paths else None
    first = min(known[-1:] + ([pinned] if pinned is not None else []), default=0)
    kept = {name for n in known if n >= first for name, _ in _manifest(spark, root, n)}
    for n in known:
        if n < first:
            gone = {name for name, _ in _manifest(spark, root, n)} - kept
            delete_path(spark, f"{root}/listing/manifests/{n}.json")
            for name in gone:
                delete_path(spark, f"{root}/listing/data={name}")
