import json

import pytest
from pyspark.sql import Observation

from reqsift.functions.request import url_host
from reqsift.operators.parse import parse_requests

GET = 'GET /search?q=tea HTTP/1.1\nHost: shop.example.com\n{"data":"{\\"Q\\"[[:]]\\"tea\\",\\"Page\\"[[:]]\\"2\\"}"}'
POST = (
    "POST /form HTTP/1.1\nHost: shop.example.com:8080\nReferer: http://shop.example.com/a\n"
    "city[[:]]Oslo\npassword[[:]]PLANTED-SECRET-1"
)


def parse(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r.i: r for r in parse_requests(df, keep=("i",)).collect()}


def one(spark, text):
    return parse(spark, text)[0]


def get(payload, head="GET /a HTTP/1.1\nHost: h\n"):
    return head + payload


def test_get(spark):
    r = one(spark, GET)
    assert (r.host, r.url, r.action_type) == ("shop.example.com", "/search?q=tea", "GET")
    assert r.fields == {"q": "tea", "page": "2"} and r.request_parameters is None
    assert not r.has_username and not r.has_password


def test_post(spark):
    r = one(spark, POST)
    assert (r.host, r.url, r.action_type) == ("shop.example.com", "/form", "POST")
    assert r.fields == {"referer": "http://shop.example.com/a"}  # all after the first colon
    assert [tuple(p) for p in r.request_parameters] == [("city", "Oslo"), ("password", "[redacted]")]
    assert r.has_password and not r.has_username


def test_data_as_object_or_text(spark):
    rows = parse(spark, get('{"data":{"A"[[:]]1,"b":{"c":2},"n":null}}'), get(json.dumps({"data": '{"A":1}'})))
    assert rows[0].fields == {"a": "1", "b": '{"c":2}', "n": None}
    assert rows[1].fields == {"a": "1"}


def test_keys_that_differ_in_case_only_last_wins(spark):
    assert one(spark, get('{"data":{"A":1,"a":2}}')).fields == {"a": "2"}


def test_payload_cannot_overwrite_columns(spark):
    r = one(spark, get('{"data":{"Host":"evil","url":"evil"}}'))
    assert (r.host, r.url) == ("h", "/a") and r.fields == {"host": "evil", "url": "evil"}


@pytest.mark.parametrize(
    "text",
    [
        "",
        None,
        get('{"data":'),
        get("{}"),
        get('{"data":null}'),
        get('{"data":"no json"}'),
        "POST/x HTTP/1.1\nHost: h",
        "hello world",
        "HEAD",
        "Host: h\nGET /a HTTP/1.1",  # the request line comes first
        "GET\nHost: h",
    ],
)
def test_bad_records_are_dropped(spark, text):
    assert parse(spark, text, POST).keys() == {1}


def test_bad_records_are_counted(spark):
    df = spark.createDataFrame([(GET,), ("",), (POST,), (get("nope"),)], "text string")
    seen = Observation("seen")
    assert parse_requests(df, observation=seen).count() == 2
    assert seen.get == {"records": 4, "bad_records": 2}


def test_empty_data_is_kept(spark):
    assert one(spark, get('{"data":{}}')).fields == {}


def test_trailing_line_end_is_not_a_line(spark):
    assert one(spark, GET + "\n").fields == one(spark, GET.replace("\n", "\r\n") + "\r\n").fields
    assert one(spark, GET.replace("\n", "\r")).host == "shop.example.com"


@pytest.mark.parametrize(
    "line, host",
    [
        ("Host: a:8080", "a"),
        ("host:a", "a"),
        ("Host:", ""),
        ("X-Host-Name: b", ""),
        ("Host: [::1]:80", "[::1]"),
        ("Host: bob:PLANTED@a:80", "a"),
        ("Accept: */*", ""),
    ],
)
def test_host(spark, line, host):
    r = one(spark, f"POST /x HTTP/1.1\n{line}\nk[[:]]v")
    assert r.host == host and "host" not in r.fields


def test_first_host_header_wins_over_body(spark):
    assert one(spark, "POST /x HTTP/1.1\nHost: a\n\nHost: b").host == "a"


def test_post_with_get_in_body_stays_post(spark):
    r = one(spark, "POST /x HTTP/1.1\nHost: a\nnote[[:]]GET this")
    assert r.action_type == "POST" and [tuple(p) for p in r.request_parameters] == [("note", "GET this")]


def test_other_methods_and_a_body_line_like_a_request_line(spark):
    r = one(spark, "PUT /x HTTP/1.1\nHost: a\n\nGET it now\nk[[:]]v")
    assert (r.action_type, r.url, r.host) == ("PUT", "/x", "a") and [tuple(p) for p in r.request_parameters] == [("k", "v")]
    assert one(spark, "\r\n\n HEAD /y HTTP/1.1\nHost: a").action_type == "HEAD"


@pytest.mark.parametrize("rest", ["", "\nHost: h", "\nHost: h\nAccept: */*\n", "\nHost: h\n\n"])
def test_get_without_payload_is_kept(spark, rest):
    r = one(spark, "GET /a HTTP/1.1" + rest)
    assert (r.action_type, r.url, r.fields) == ("GET", "/a", {})


def test_hosts_in_any_case_and_bracketed(spark):
    assert one(spark, "POST /x HTTP/1.1\nHost: A.Example.COM:80").host == "a.example.com"
    urls = ["HTTP://A/x", "http://[::1]:80/x", "https://u:p@B.org:1/", "no url", "ftp://c"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(url_host(df.u)).collect()] == ["a", "[::1]", "b.org", "", "c"]


def test_pairs(spark):
    r = one(spark, "POST /x HTTP/1.1\nCity[[:]]Oslo\nempty[[:]]\na[[:]]b[[:]]c\n[[:]]x\n  pad[[:]]y  ")
    assert [tuple(p) for p in r.request_parameters] == [("city", "Oslo"), ("a", "b"), ("", "x"), ("pad", "y")]
    assert r.fields == {}


def test_header_lines(spark):
    text = 'POST http://h/x HTTP/1.1\nA: 1:2\nA : 3\nempty:\nno header\nx=1&t=12:30\n{"k":"v"}\nB:\t4'
    assert one(spark, text).fields == {"a": "3", "b": "4"}


def test_post_without_form_has_empty_parameters(spark):
    assert one(spark, "POST /x HTTP/1.1\nA: 1").request_parameters == []


def test_only_stated_columns_come_out(spark):
    df = spark.createDataFrame([(GET,)], "text string")
    assert parse_requests(df).columns == [
        "host", "url", "action_type", "has_username", "has_password", "has_basic", "has_bearer", "has_session",
        "has_userinfo", "has_key", "fields", "request_parameters",
    ]


def test_the_raw_text_cannot_be_kept(spark):
    with pytest.raises(ValueError):
        parse_requests(spark.createDataFrame([(GET,)], "text string"), keep=("text",))


def test_two_parsed_tables_in_one_plan(spark):
    a, b = (parse_requests(spark.createDataFrame([(t,)], "text string")) for t in (GET, POST))
    assert a.union(b).count() == 2


def test_multipart_keeps_headers_and_pairs_but_no_value_lines(spark):
    head = "POST /x HTTP/1.1\nHost: a\nContent-Type: multipart/form-data; boundary=b\n"
    r = one(spark, head + '\n--b\nContent-Disposition: form-data; name="k"\n\nv: 1\n--b--\ncity[[:]]Oslo')
    assert r.fields == {"content-type": "multipart/form-data; boundary=b"}
    assert [tuple(p) for p in r.request_parameters] == [("city", "Oslo")]
    assert one(spark, head + "A: 1").fields == {"content-type": "multipart/form-data; boundary=b", "a": "1"}
