"""Ordinals and count-sized batches without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BUCKET = 1_000_000
#: The most cut points asked for in one aggregate; further ones are laid between them as the rows need.
GRID = 10_000
#: A stored row takes so many bytes at least, as far as the number of cut points goes.
LEAST_ROW_BYTES = 4
BATCH_SIZE = 200_000


def _position(df: DataFrame, order_by: str) -> Column:
    """A double that never decreases when ``order_by`` increases."""
    kind = df.schema[order_by].dataType
    if isinstance(kind, T.TimestampNTZType):  # without the session's zone, whose clock may go back
        apart = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(order_by))
        return apart.cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(order_by)).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(order_by)).cast("double")
    return F.col(order_by).cast("double")


def _grid(df: DataFrame, rows_per_bucket: int) -> int:
    """How many cut points to ask for: some for each bucket that the table may fill, told from the plan without a job.

    The plan's size errs upwards where it is not that of files, and a row takes some bytes of a file at least.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    wanted = max(8 * df.sparkSession.sparkContext.defaultParallelism, 2 * size // (LEAST_ROW_BYTES * rows_per_bucket))
    return min(wanted, GRID)


def _bounds(df: DataFrame, column: str, rows_per_bucket: int) -> list[float]:
    """Approximate quantiles that cut the table into buckets of bounded size, from one aggregate with the count.

    At most ``GRID`` numbers reach the driver; where a table has more buckets than were asked for, each interval is cut
    evenly. Bounds only balance the work: results do not depend on how exact they are.
    """
    size = _grid(df, rows_per_bucket)
    fractions = ", ".join(f"{i / size!r}D" for i in range(size + 1))
    quantiles = F.expr(f"percentile_approx({column}, array({fractions}), {max(2 * size, 1000)})")
    rows, grid = df.agg(F.count(F.lit(1)), quantiles).first()
    n = max(-(-rows // rows_per_bucket), df.sparkSession.sparkContext.defaultParallelism)
    if not grid or n == 1:
        return []
    if n <= size:
        return sorted({grid[size * i // n] for i in range(1, n)})
    parts = -(-n // size)
    ends = sorted(set(grid))
    between = [a + (b - a) * i / parts for a, b in zip(ends, ends[1:]) for i in range(1, parts)]
    return sorted({*ends, *between})


def with_ordinal(
    df: DataFrame,
    order_by: str,
    within: Sequence[str] = (),
    ordinal: str = "ordinal",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Number the rows 1..n by ``order_by`` (a number, date or time) and then ``ties``, per group of ``within``.

    ``order_by`` and ``ties`` together are unique; rows of equal ``order_by`` share a bucket.

    Rows are numbered inside quantile buckets and shifted by the sizes of the buckets before them, so
    even a group that holds the whole table is spread over all tasks. ``df`` is read three times, mostly
    its key columns: store it first if it is costly to compute.
    """
    placed = df.withColumn("_pos", _position(df, order_by))
    bounds = _bounds(placed.select("_pos"), "_pos", rows_per_bucket)
    splits = [float("-inf"), *bounds, float("inf")]
    if bounds:
        bucketizer = Bucketizer(splits=splits, inputCol="_pos", outputCol="_bucket", handleInvalid="keep")
        bucketed = bucketizer.transform(placed).withColumn("_bucket", F.col("_bucket").cast("int"))
    else:
        bucketed = placed.withColumn("_bucket", F.lit(0))
    # A struct is never null, so groups whose key is null stay joinable.
    keyed = bucketed.withColumn("_group", F.struct(*within, "_bucket"))

    before = Window.partitionBy("_within").orderBy("_group._bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_group")
        .count()
        .withColumn("_within", F.struct(F.lit(0), *[F.col(f"_group.{c}") for c in within]))
        .select("_group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(Window.partitionBy("_group").orderBy(order_by, *ties))
    return (
        keyed.withColumn("_local", local)
        .join(offsets, "_group")
        .withColumn(ordinal, F.col("_before") + F.col("_local"))
        .select(*df.columns, ordinal)
    )


def count_batches(
    df: DataFrame, order_by: str, size: int = BATCH_SIZE, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Cut the table, in ``order_by`` order, into batches of exactly ``size`` rows; the last is the rest.

    Adds ``batch`` (from 0) and ``seq`` (1..size within the batch).
    """
    zero_based = F.col("_ordinal") - 1
    return (
        with_ordinal(df, order_by, ordinal="_ordinal", rows_per_bucket=rows_per_bucket)
        .withColumn("batch", F.floor(zero_based / size).cast("long"))
        .withColumn("seq", (zero_based % size + 1).cast("int"))
        .drop("_ordinal")
    )
