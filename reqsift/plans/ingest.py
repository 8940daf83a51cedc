"""Day-wise ingest of archives into redacted request records, with a ledger of the files that were read.

``<out>/rows/day=<n>/run=<k>`` holds the records of the ``k``-th run that found something new for a day, and
``<out>/files/day=<n>/run=<k>`` the path, length and time of the files they came from. The ledger is written last: a run
without it did not happen, its records are not read and the next run replaces them.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.parse import parse_requests
from ..session import committed_below, scratch_dir
from ..sources import archives

LEDGER = "path string, length bigint, modificationTime timestamp"
#: Files added to a day that is done are named to the reader, so many at a time.
NAMED_FILES = 10_000


def archived_requests(files: DataFrame, root: str, observation=None, **options) -> DataFrame:
    """Archives to parsed requests with ``path``, ``entry`` and ``day``."""
    entries = archives.explode_archives(files, **options)
    parsed = parse_requests(entries, keep=("path", "entry"), observation=observation)
    return archives.with_day(parsed, root)


def finished_runs(spark: SparkSession, out: str) -> dict[int, list[int]]:
    """The finished runs of each day."""
    found = (re.fullmatch(r"day=(\d+)/run=(\d+)", path) for path in committed_below(spark, f"{out}/files", 2))
    runs: dict[int, list[int]] = {}
    for day, run in sorted((int(m[1]), int(m[2])) for m in found if m):
        runs.setdefault(day, []).append(run)
    return runs


def finished_days(spark: SparkSession, out: str) -> list[int]:
    return sorted(finished_runs(spark, out))


def _committed(spark: SparkSession, out: str, kind: str, runs: dict[int, list[int]]) -> DataFrame | None:
    """The finished runs of ``kind`` (rows or files), with ``day`` and ``run``."""
    paths = [f"{out}/{kind}/day={day}/run={run}" for day, numbers in runs.items() for run in numbers]
    if not paths:
        return None
    tables = spark.read.option("basePath", f"{out}/{kind}").parquet(*paths)
    return tables.withColumn("day", F.col("day").cast("long")).withColumn("run", F.col("run").cast("int"))


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """``path, length, modificationTime, day, run`` of every file that was read."""
    ledger = _committed(spark, out, "files", finished_runs(spark, out))
    return spark.createDataFrame([], LEDGER + ", day bigint, run int") if ledger is None else ledger


def new_files(spark: SparkSession, root: str, out: str, after_day: int | None = None) -> DataFrame:
    """``path, length, modificationTime, day`` of the archives of all days that the ledger doesn't have as they are now.

    One listing of the days, done by Spark's tasks where there are many, and one anti-join; no contents are read.
    """
    listed = archives.scan_days(spark, root, after_day).select("path", "length", "modificationTime", "day")
    return listed.join(read_ledger(spark, out).drop("run", "day"), ["path", "length", "modificationTime"], "left_anti")


def _as_pattern(path: str) -> str:
    """A path for a reader that takes patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _ingest(files: DataFrame, root: str, out: str, day: int, run: int, options: dict) -> dict[str, int]:
    """The files are listed once, when ``files`` is made: the ledger has those that were read."""
    seen = Observation(f"day-{day}-{run}")
    rows = archived_requests(files, root, observation=seen, **options)
    rows.drop("day").write.mode("overwrite").parquet(f"{out}/rows/day={day}/run={run}")
    report = dict(seen.get)
    files.select("path", "length", "modificationTime").write.mode("overwrite").parquet(f"{out}/files/day={day}/run={run}")
    return report


def ingest_days(spark: SparkSession, root: str, out: str, after_day: int | None = None, **options) -> dict[int, dict[str, int]]:
    """Parse every archive that the ledger doesn't have: those of new days, whenever they come, and those added to a day
    that is done. A file that was changed is read again, and its records replace the earlier ones.

    A run that failed half-way is done again and replaces itself. Days up to ``after_day`` are not listed. A day without
    archives is finished too. Returns, per day with something new, the number of records and of bad ones.
    """
    runs, folders = finished_runs(spark, out), {}
    for name in archives.day_folders(spark, root, after_day):
        folders.setdefault(int(name), []).append(f"{root}/{name}")
    fresh = scratch_dir(spark, "new-files")
    new_files(spark, root, out, after_day).write.partitionBy("day").parquet(fresh)
    fresh = spark.read.schema(LEDGER + ", day bigint").parquet(fresh)
    added = {r["day"] for r in fresh.select("day").distinct().collect()}
    report: dict[int, dict[str, int]] = {}
    for day in sorted(folders):
        todo = fresh.filter(F.col("day") == day)
        if day not in runs:
            report[day] = _ingest(archives.list_files(spark, folders[day]), root, out, day, 0, options)
        elif day in added:
            # By name: listing their folders would open the files that are done as well.
            last, run, total = "", runs[day][-1], []
            while True:
                paths = [r["path"] for r in todo.filter(F.col("path") > last).orderBy("path").limit(NAMED_FILES).select("path").collect()]
                if not paths:
                    break
                run, last = run + 1, paths[-1]
                files = archives.list_files(spark, [_as_pattern(p) for p in paths])
                total.append(_ingest(files, root, out, day, run, options))
            report[day] = reduce(lambda a, b: {k: a[k] + b[k] for k in a}, total)
    return report


def read_ingested(spark: SparkSession, out: str, after_day: int | None = None) -> DataFrame:
    """The ingested records; ``after_day`` prunes whole days. Of a file that was read more than once, those of the last time."""
    runs = {day: numbers for day, numbers in finished_runs(spark, out).items() if after_day is None or day > after_day}
    rows = _committed(spark, out, "rows", runs)
    if rows is None:
        raise ValueError(f"nothing was ingested into {out}")
    if all(len(numbers) == 1 for numbers in runs.values()):
        return rows.drop("run")
    latest = Window.partitionBy("path", "day")
    read = _committed(spark, out, "files", runs).select("path", "day", "run", F.max("run").over(latest).alias("last"))
    stale = read.filter("run < last").drop("last")  # mostly none
    return rows.join(stale, ["path", "day", "run"], "left_anti").drop("run")
