"""The physical plans are the ones wanted: filters and columns reach the scan, nothing shuffles needlessly."""

import pytest

from __spark_entry__ import queries
from reqsift.operators import counts
from reqsift.operators.parse import parse_requests

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def explained(spark, name):
    return plan(queries()[name](spark, FOLDER))


def test_day_scan_is_pushed_down(spark):
    text = explained(spark, "scan_days_after")
    assert "GreaterThanOrEqual(ts" in text and "Exchange" not in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in text


@pytest.mark.parametrize("name", ["host_counts", "unlisted_requests", "redacted_requests", "exposure_by_host"])
def test_html_is_never_read(spark, name):
    assert "html" not in explained(spark, name)


def test_small_listing_is_broadcast_into_an_anti_join(spark):
    text = explained(spark, "unlisted_requests")
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert text.count("hashpartitioning") == 1  # of the listing only


@pytest.mark.parametrize("name, shuffles", [("host_counts", 1), ("state_merge", 2), ("distinct_per_key", 1)])
def test_shuffles(spark, name, shuffles):
    text = explained(spark, name)
    assert text.count("Exchange hashpartitioning") == shuffles
    assert "partial_count" in text or name == "distinct_per_key"


def test_top_k_is_no_full_sort(spark):
    assert "TakeOrderedAndProject" in explained(spark, "top_hosts")


def test_no_single_partition_window_over_the_table(spark):
    assert "SinglePartition" not in explained(spark, "batch_ordinals")


def test_no_python_outside_the_archives(spark):
    for name in ("redacted_requests", "framed_lines", "count_batches", "exposure_by_host"):
        assert "Python" not in explained(spark, name) and "InArrow" not in explained(spark, name)


def test_unused_columns_are_pruned_through_the_parser(spark, tmp_path):
    spark.createDataFrame([(1, "POST /x HTTP/1.1\nHost: a", "o")], "id int, text string, other string").write.parquet(
        str(tmp_path / "t")
    )
    df = counts.count_by(parse_requests(spark.read.parquet(str(tmp_path / "t")), keep=("id",)))
    text = plan(df)
    assert "ReadSchema: struct<text:string>" in text and "transform_values" not in text
    assert df.collect() == [("a", 1)]


def test_ingested_days_are_pruned(spark, tmp_path):
    from reqsift.plans.ingest import read_ingested

    out = str(tmp_path / "out")
    for day in (1, 2, 3):
        for kind in ("rows", "files"):
            spark.createDataFrame([("a", "h")], "path string, host string").write.parquet(f"{out}/{kind}/day={day}/run=0")
    rows = read_ingested(spark, out, after_day=1)
    assert {f.rsplit("/", 3)[1] for f in rows.inputFiles()} == {"day=2", "day=3"}
    assert "Join" not in plan(rows)  # each file was read once
    assert "PartitionFilters: [isnotnull(day" in plan(rows.filter("day = 3"))
