import glob
import json
import re

from pyspark.sql import functions as F

from reqsift.operators import sinks
from reqsift.operators.parse import parse_requests
from reqsift.sources.topics import unframe

POST = "POST /x HTTP/1.1\nHost: a.example\nReferer: http://r/\nUrl: evil\nk[[:]]v"


def parsed(spark):
    return parse_requests(spark.createDataFrame([(POST,)], "text string"))


def test_framed_line(spark):
    line = sinks.framed_lines(parsed(spark)).first().line
    assert line == (
        "a.example|| action_type[[:]]POST[[--]]host[[:]]a.example[[--]]referer[[:]]http://r/[[--]]"
        'request_parameters[[:]][{"key":"k","value":"v"}][[--]]url[[:]]/x'
    )


def test_topic_rows_and_back(spark):
    rows = sinks.topic_rows(sinks.framed_lines(parsed(spark)))
    row = rows.first()
    assert re.fullmatch(r"[0-9a-f-]{36}", row.key)
    back = unframe(rows).first()
    assert back.host == "a.example" and back.line.startswith("action_type[[:]]POST")


def test_archive_per_batch(spark, tmp_path):
    path = str(tmp_path / "p")
    for batch in (0, 1):
        sinks.write_archive(spark.createDataFrame([(batch, 1, "x"), (batch, 2, "y")], "batch long, seq int, line string"), path)
    rows = spark.read.parquet(path).collect()
    assert sorted((r.batch, r.seq, r.line) for r in rows) == [(0, 1, "x"), (0, 2, "y"), (1, 1, "x"), (1, 2, "y")]


def test_json_per_key(spark, tmp_path):
    df = spark.createDataFrame([("a/b", 1), ("c", 2), (None, 3)], "host string, n int")
    path = str(tmp_path / "j")
    sinks.append_json(df, "host", path)
    sinks.append_json(df, "host", path)
    back = spark.read.schema("host string, n int").json(path).select("host", "n")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.union(df).collect()))
    assert len(glob.glob(f"{path}/host=*")) == 3


def test_json_by_key_bucket_keeps_the_key(spark, tmp_path):
    df = spark.range(1000).select(F.concat(F.lit("h"), "id").alias("host"), "id")
    path = str(tmp_path / "j")
    sinks.append_json(df, "host", path, key_buckets=4)
    assert len(glob.glob(f"{path}/key_bucket=*")) == 4
    lines = [json.loads(line) for f in glob.glob(f"{path}/*/*.json") for line in open(f)]
    assert {(r["host"], r["id"]) for r in lines} == {(f"h{i}", i) for i in range(1000)}
