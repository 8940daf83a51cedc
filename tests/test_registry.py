import pytest

from reqsift.plans.registry import Registry, Step, default_registry


def test_problems_are_listed_before_any_plan_is_built():
    spec = [
        {"step": "nonblank"},
        {"step": "nope"},
        {"step": "count_by", "colour": "red"},
        {"step": "rank_by_count", "limit": 0},
        {"step": "key_equals", "col": "a", "value": "b"},
    ]
    assert default_registry().validate(spec) == [
        "item 0: nonblank: missing parameter 'cols'",
        "item 1: unknown step 'nope'",
        "item 2: count_by: unknown parameter 'colour'",
        "item 3: rank_by_count: 'limit' must be positive",
    ]
    with pytest.raises(ValueError, match="unknown step"):
        default_registry().apply(None, spec)


def test_wrong_values_are_problems_and_raise_nothing():
    spec = [
        {"step": "rank_by_count", "limit": "5"},
        {"step": "nonblank", "cols": "name"},
        {"step": "distinct_per_key", "key": "a", "values": [1]},
        {"step": "drop_listed", "state": 7},
        {"step": "read_table", "folder": "f", "name": "n"},
        "count_by",
        {"step": ["x"]},
    ]
    assert default_registry().validate(spec) == [
        "item 0: rank_by_count: 'limit' must be a whole number",
        "item 1: nonblank: 'cols' must be a list of texts",
        "item 2: distinct_per_key: 'values' must hold texts",
        "item 3: drop_listed: 'state' must be a text",
        "item 4: read_table: a source comes first",
        "item 5: a step is a mapping",
        "item 6: unknown step '['x']'",
    ]
    assert default_registry().validate({"step": "x"}) == ["a spec is a list of steps"]


def test_a_spec_without_source_is_not_run(spark):
    with pytest.raises(ValueError, match="source"):
        default_registry().run(spark, '[{"step": "count_by"}]')


def test_own_steps(spark):
    registry = Registry()
    registry.register(Step("less_than", lambda df, n: df.filter(df.id < n), ("n",)))
    assert registry.apply(spark.range(10), [{"step": "less_than", "n": 3}]).count() == 3
    with pytest.raises(ValueError, match="already"):
        registry.register(Step("less_than", lambda df: df))


def test_parser_by_name(spark):
    df = spark.createDataFrame([("POST /x HTTP/1.1\nHost: a",), ("POST /x HTTP/1.1\nHost: a",)], "text string")
    spec = [{"step": "parse_requests"}, {"step": "count_by"}]
    assert [tuple(r) for r in default_registry().apply(df, spec).collect()] == [("a", 2)]


def test_problems_of_stream_specs():
    registry = default_registry()
    source = {"step": "stream_table", "folder": "f", "name": "n"}
    spec = [
        {"step": "read_table", "folder": "f", "name": "n"},
        source,
        {"step": "rank_by_count"},
        {"step": "fork", "steps": [{"step": "nope"}, {"step": "fork", "steps": 7}], "colour": "red"},
        {"step": "put_counts", "root": "r", "number": 1},
        {"step": "fork"},
    ]
    assert registry.validate(spec, stream=True) == [
        "item 1: stream_table: a source comes first",
        "item 2: rank_by_count: needs a whole table, not a micro-batch",
        "item 3: fork: unknown parameter 'colour'",
        "item 3: fork: item 0: unknown step 'nope'",
        "item 3: fork: item 1: fork: a spec is a list of steps",
        "item 4: put_counts: unknown parameter 'number'",
        "item 5: fork: a spec is a list of steps",
    ]
    assert registry.validate([{"step": "nonblank", "cols": ["a"]}], stream=True) == ["item 0: the first step must be a stream source"]
    assert registry.validate([], stream=True) == ["item 0: the first step must be a stream source"]
    assert registry.validate([source], stream=True) == ["the stream writes nothing"]
    assert registry.validate([source]) == ["item 0: stream_table: a stream is started, not run"]
    assert registry.validate([{**source, "max_files": 0}], stream=True) == ["item 0: stream_table: 'max_files' must be positive"]
    with pytest.raises(ValueError, match="writes nothing"):
        registry.stream(None, [source], "cp")


def test_fork_in_a_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, "b"), (2, "a")], "id long, host string")
    spec = [{"step": "fork", "steps": [{"step": "append_json", "key": "host", "path": str(tmp_path / "json")}]}, {"step": "count_by"}]
    assert sorted(map(tuple, default_registry().apply(df, spec).collect())) == [("a", 1), ("b", 1)]
    assert spark.read.json(str(tmp_path / "json")).count() == 2
