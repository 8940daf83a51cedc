from pyspark.sql import functions as F

from reqsift.operators import counts


def test_merge_counts(spark):
    old = spark.createDataFrame([("a", 2, "1"), ("b", 1, "0"), ("n", 1, None)], "host string, count long, status string")
    new = spark.createDataFrame([("a", 3), ("c", 4)], "host string, count long")
    got = {(r.host, r["count"], r.status) for r in counts.merge_counts(old, new).collect()}
    assert got == {("a", 5, "1"), ("b", 1, "0"), ("c", 4, "0"), ("n", 1, "0")}


def test_rank_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 9)], "host string, count long")
    assert [r.host for r in counts.rank_by_count(df).collect()] == ["c", "a", "b"]
    assert [r.host for r in counts.rank_by_count(df, limit=2).collect()] == ["c", "a"]


def test_total_of_nothing_is_zero(spark):
    assert counts.total_count(spark.createDataFrame([], "host string, count long")).first()[0] == 0


def test_key_sets(spark):
    a = spark.createDataFrame([("a",), ("b",), ("b",)], "host string")
    b = spark.createDataFrame([("b",), ("c",)], "host string")
    assert sorted(r.host for r in counts.union_keys("host", a, b).collect()) == ["a", "b", "c"]
    assert [r.host for r in counts.key_difference(a, b).collect()] == ["a"]


def test_exposure_counts_cleartext_only(spark):
    rows = [("h", "http://h/", True, True), ("h", "https://h/", True, True), ("h", "/x", False, True), ("h", "/", False, False)]
    df = spark.createDataFrame(rows, "host string, url string, has_username boolean, has_password boolean")
    other = {f"has_{kind}": F.lit(False) for kind in ("basic", "bearer", "session", "userinfo", "key")}
    r = counts.exposure_by_host(df.withColumns(other)).first()
    assert (r.requests, r.with_username, r.with_password, r.exposed, r.exposed_share) == (4, 2, 3, 2, 0.5)
