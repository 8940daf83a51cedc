import datetime
import random

import pytest
from pyspark.sql import functions as F

from reqsift.operators import ordinal


@pytest.fixture(scope="module")
def rows(spark):
    """Ids far from uniform; one group has a third of the rows, another is null."""
    rng = random.Random(7)
    ids = rng.sample(range(1000), 500) + [10**6 + 7 * i for i in range(500)] + [2**60 + i for i in range(500)]
    groups = ["hot" if i % 3 == 0 else rng.choice(["a", "b", None]) for i in range(len(ids))]
    data = list(zip(ids, groups))
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("rows_per_bucket", [10, 10**6])
def test_ordinals_over_the_table(spark, rows, rows_per_bucket):
    df = spark.createDataFrame(rows, "id long, g string").repartition(4)
    got = {r.id: r.ordinal for r in ordinal.with_ordinal(df, "id", rows_per_bucket=rows_per_bucket).collect()}
    assert got == {i: n for n, i in enumerate(sorted(i for i, _ in rows), 1)}


@pytest.mark.parametrize("rows_per_bucket", [10, 10**6])
def test_ordinals_within_groups(spark, rows, rows_per_bucket):
    df = spark.createDataFrame(rows, "id long, g string").repartition(4)
    got = {r.id: r.ordinal for r in ordinal.with_ordinal(df, "id", ["g"], rows_per_bucket=rows_per_bucket).collect()}
    want = {}
    for g in {g for _, g in rows}:
        want |= {i: n for n, i in enumerate(sorted(i for i, x in rows if x == g), 1)}
    assert got == want


def test_a_single_group_is_numbered_by_many_tasks(spark):
    df = spark.range(4000).withColumn("g", F.lit("one"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = ordinal.with_ordinal(df, "id", ["g"], rows_per_bucket=100)
        sizes = [r[0] for r in numbered.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(sizes) > 1 and max(sizes) < 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_order_by_time(spark):
    start = datetime.datetime(2024, 1, 1)
    data = [(start + datetime.timedelta(minutes=(i * 37) % 100),) for i in range(100)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(data, f"ts {kind}")
        got = [r.ordinal for r in ordinal.with_ordinal(df, "ts", rows_per_bucket=10).orderBy("ts").collect()]
        assert got == list(range(1, 101))


def test_zone_less_times_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.range(240).selectExpr("id", "timestamp_ntz'2024-10-26 23:00:00' + make_dt_interval(0, 0, id) AS ts")
        got = ordinal.with_ordinal(df.repartition(4), "ts", rows_per_bucket=10).collect()
        assert all(r.ordinal == r.id + 1 for r in got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_more_buckets_than_the_grid(spark, monkeypatch):
    monkeypatch.setattr(ordinal, "GRID", 4)
    df = spark.range(1000).repartition(3)
    assert len(ordinal._bounds(df.selectExpr("CAST(id AS DOUBLE) AS p"), "p", 50)) >= 15
    assert all(r.ordinal == r.id + 1 for r in ordinal.with_ordinal(df, "id", rows_per_bucket=50).collect())


def test_count_batches_are_exact_and_keep_the_rest(spark, rows):
    df = spark.createDataFrame(rows, "id long, g string")
    got = ordinal.count_batches(df, "id", size=400, rows_per_bucket=50).orderBy("id").collect()
    assert [(r.batch, r.seq) for r in got] == [(n // 400, n % 400 + 1) for n in range(1500)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long")
    assert ordinal.count_batches(df, "id").collect() == []
