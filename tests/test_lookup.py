import random

import pytest
from pyspark.sql import functions as F

from reqsift.operators import lookup
from reqsift.operators.filters import listed


def skewed(spark, rows=3000):
    """A third of all rows has one key."""
    rng = random.Random(1)
    data = [(i, "hot" if i % 3 == 0 else f"h{rng.randrange(400)}") for i in range(rows)]
    data += [(rows, None), (rows + 1, "")]
    return spark.createDataFrame(data, "id long, host string").repartition(4, "id")


def state(spark, hot_status):
    data = [("hot", 7, hot_status), ("", 1, "1"), ("unused", 3, "1")]
    data += [(f"h{i}", i, "1" if i % 2 else "0") for i in range(0, 300)] + [("h399", 1, None)]
    return spark.createDataFrame(data, "host string, count long, status string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_same_rows_as_a_plain_join(spark, how, limit):
    facts, table = skewed(spark), state(spark, "1").select("host", "count")
    got = lookup.lookup_join(facts, table, "host", how, max_broadcast_bytes=limit)
    want = facts.join(table, "host", how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_small_lookup_is_broadcast_and_facts_are_not_shuffled(spark):
    got = lookup.drop_listed(skewed(spark), state(spark, "1"))
    assert "BroadcastHashJoin" in plan(got)


def test_large_lookup_spreads_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        facts, table = skewed(spark), state(spark, "0")
        got = lookup.drop_listed(facts, table, spread_by=["id"], max_broadcast_bytes=0)
        per_task = (
            got.filter("host = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()
        )
        assert sum(r[0] for r in per_task) == 1000
        assert len(per_task) > 1 and max(r[0] for r in per_task) < 800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_keys_has_no_false_negative(spark):
    keys = lookup.hot_keys(skewed(spark), "host", 0.25)
    assert "hot" in keys and len(keys) <= 4


def test_only_truly_hot_keys_and_their_shares(spark):
    even = spark.range(20_000).selectExpr("concat('h', id) AS host")
    assert lookup.hot_keys(even, "host", 1 / 500) == {}
    assert lookup.hot_keys(skewed(spark), "host", 0.25) == {"hot": 1000 / 3002}


def test_null_keys_come_out_of_many_tasks(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(2000).selectExpr("id", "CAST(NULL AS STRING) AS host").union(skewed(spark))
        got = lookup.lookup_join(facts, state(spark, "1").select("host", "count"), "host", "left", ["id"], 0)
        tasks = [r[0] for r in got.filter("host IS NULL").groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(tasks) == 2001 and len(tasks) == 4 and max(tasks) < 800
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_table_bytes_grows_with_rows_and_texts(spark):
    one = spark.createDataFrame([("abc",)], "s string")
    assert 0 < lookup.table_bytes(one) < lookup.table_bytes(one.withColumn("s", F.repeat("s", F.lit(10))))
    assert lookup.table_bytes(one.filter("false")) == 0


def test_null_status_is_not_listed(spark):
    names = {r.host for r in listed(state(spark, None)).select("host").collect()}
    assert "hot" not in names and "h399" not in names and "h1" in names and "h0" not in names


def test_empty_allowlist_keeps_every_request_with_a_host(spark):
    facts = skewed(spark)
    assert lookup.drop_listed(facts, state(spark, "1").filter("false")).count() == facts.count() - 2


def test_enrich(spark):
    facts = spark.createDataFrame([("h3",), ("new",), ("h399",)], "host string")
    rows = {r.host: (r.known_count, r.known_status) for r in lookup.enrich_with_state(facts, state(spark, "1")).collect()}
    assert rows == {"h3": (3, "1"), "new": (0, "0"), "h399": (1, "0")}


def test_unknown_join_type(spark):
    with pytest.raises(ValueError):
        lookup.lookup_join(skewed(spark), state(spark, "1"), "host", "full_outer")
