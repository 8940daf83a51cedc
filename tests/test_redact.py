import glob
import os

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reqsift.functions import redact
from reqsift.operators import counts, ordinal, sinks
from reqsift.operators.parse import parse_requests

SECRET = "PLANTED-SECRET-1"
NAMES = [
    "password", "Passwd", "PWD", "username", "User", "login", "token", "access_token", "secret", "client-secret",
    "Authorization", "Proxy-Authorization", "cookie", "Set-Cookie", "session", "JSESSIONID", "sessionKey",
    "user_name", "j_username",
    "pass", "pw", "passwort", "passcode", "pin", "otp", "auth", "bearer", "X-Api-Key", "api_key", "apikey", "access_key",
    "access-key", "private_key", "PHPSESSID", "session_id", "sid", "jwt", "signature", "sig", "cvv", "cvc", "X-Auth",
    "userpass", "dbpass", "pass1", "pass2", "authkey", "pincode", "passkey", "otpcode", "pswd", "psw", "pword", "x-csrf", "mdp",
    "senha", "contrasena", "contraseña", "wachtwoord", "heslo", "kennwort", "passphrase", "X-XSRF-Token", "userPin", "cvv2", "dbpw",
]

CARRIERS = [
    "POST /x HTTP/1.1\nHost: h\n{n}[[:]]{s}",
    "POST /x HTTP/1.1\nHost: h\n{n}: {s}",
    "POST /x HTTP/1.1\nHost: h\n{n} : Basic {s}",
    "POST /x?{n}={s} HTTP/1.1\nHost: h",
    "POST /x?a=1&{n}={s}&b=2#f HTTP/1.1\nHost: h",
    "POST /x#{n}={s} HTTP/1.1\nHost: h",
    "POST http://h/x?{n}={s} HTTP/1.1\nHost: h\nReferer: http://h/?{n}={s}&c=3",
    "POST /x?d=%7B%22{n}%22%3A%22{s}%22%7D HTTP/1.1\nHost: h",
    "POST /x?d=%257B%2522{n}%2522%253A%2522{s}%2522%257D HTTP/1.1\nHost: h",
    "POST /x HTTP/1.1\nHost: h\nform[[:]]{{\"{n}\":\"{s}\"}}",
    "POST /x HTTP/1.1\nHost: h\nform[[:]]{n}={s}&x=1",
    "POST /x HTTP/1.1\nHost: h\nform[[:]]{n}%3D{s}",
    "POST /x HTTP/1.1\nHost: h\nform[[:]]a [[--]] {n}: {s}",
    "POST /x HTTP/1.1\nHost: h\n{n}={s}&t=12:30",
    "POST /x HTTP/1.1\nHost: h\n{{\"{n}\":\"{s}\"}}",
    "POST /x HTTP/1.1\nHost: h\n{n}={s}[[:]]v",
    'GET /x HTTP/1.1\nHost: h\n{{"data":{{"{n}":"{s}"}}}}',
    'GET /x HTTP/1.1\nHost: h\n{{"data":"{{\\"{n}\\"[[:]]\\"{s}\\"}}"}}',
    'GET /x HTTP/1.1\nHost: h\n{{"data":{{"f":{{"{n}":{{"deep":"{s}"}}}}}}}}',
    'GET /x HTTP/1.1\nHost: h\n{{"data":{{"f":[{{"{n}":"{s}"}}]}}}}',
    'GET /x HTTP/1.1\nHost: h\nCookie: {n}={s}\n{{"data":{{}}}}',
]
MULTIPART = (
    'POST /x HTTP/1.1\nHost: h\nContent-Type: multipart/form-data; boundary=b\n\n--b\n'
    'Content-Disposition: form-data; name="{n}"\n\nx:{s}\n--b--'
)
CARRIERS += [
    MULTIPART,
    "POST /x HTTP/1.1\nHost: h\nxml[[:]]<a><{n}>{s}</{n}></a>",
    "POST /x HTTP/1.1\nHost: h\n<ns:{n}>{s}</ns:{n}>",
    "POST /x?d=%3C{n}%3E{s} HTTP/1.1\nHost: h",
]
PASSWORD_MENTIONS = [
    f"POST /x HTTP/1.1\nHost: h\nnote[[:]]{text}"
    for text in (f"my password {SECRET}", f'["pwd","{SECRET}"]', f"passwd|{SECRET}", f"Secret, {SECRET}")
]
USERINFO = [
    f"POST http://bob:{SECRET}@h/x HTTP/1.1\nHost: h\nReferer: https://bob:{SECRET}@h:80/y",
    f"POST /x?to=http://bob:{SECRET}@h/ HTTP/1.1\nHost: bob:{SECRET}@h",
    f'GET http://{SECRET}@h/x HTTP/1.1\nHost: h\n{{"data":{{"u":"ftp://{SECRET}@h/"}}}}',
    f"POST /x HTTP/1.1\nHost: h\nback[[:]]//{SECRET}@h/",
]


CARRIERS += [
    'GET /x?{n}={s} HTTP/1.1\nHost: h\n{{"data":{{"{n}1":"{s}"}}}}',
]


def planted():
    texts = [c.format(n=n, s=SECRET) for c in CARRIERS for n in NAMES]
    return texts + PASSWORD_MENTIONS + USERINFO


@pytest.fixture(scope="module")
def parsed(spark):
    texts = planted()
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    return parse_requests(df, keep=("i",))


def test_no_planted_secret_in_any_output_column(spark, parsed):
    texts = planted()
    rows = parsed.collect()
    assert len(rows) == len(texts)
    leaks = [(texts[r.i], r.asDict(True)) for r in rows if SECRET in repr(r.asDict(True))]
    assert not leaks, leaks[0]


def test_no_planted_secret_in_any_file(spark, parsed, tmp_path):
    lines = ordinal.count_batches(sinks.framed_lines(parsed), "i", 50)
    sinks.write_archive(lines, str(tmp_path / "archive"))
    sinks.topic_rows(lines).write.option("compression", "none").json(str(tmp_path / "topic"))
    flat = parsed.select("host", "url", F.to_json("fields").alias("f"), F.to_json("request_parameters").alias("p"))
    sinks.append_json(flat, "host", str(tmp_path / "json"))
    counts.exposure_by_host(parsed).write.json(str(tmp_path / "audit"))
    text = spark.read.parquet(str(tmp_path / "archive")).agg(F.array_join(F.collect_list("line"), "\n")).first()[0]
    assert SECRET not in text and "[redacted]" in text
    files = [f for f in glob.glob(f"{tmp_path}/**/*", recursive=True) if os.path.isfile(f)]
    assert files and all(SECRET.encode() not in open(f, "rb").read() for f in files)


#: Names that are sensitive as whole words only.
WHOLE = ("user", "mdp", "dbpw", "userpin", "cvv2", "pass", "pw", "pin", "otp", "auth", "x-auth", "sid", "jwt", "sig", "cvv", "cvc")
WORDS = st.sampled_from(["a", "b2", "x-y", "q", "%20", ".", "/", "&", ";", "é"])
FILLER = st.lists(WORDS, max_size=5).map("".join)
CASES = st.lists(
    st.tuples(st.sampled_from(range(len(CARRIERS))), st.sampled_from(NAMES), FILLER, FILLER, st.booleans()),
    min_size=100,
    max_size=200,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate])
@given(CASES)
def test_random_names_around_a_sensitive_word_leak_nothing(spark, cases):
    def name(n, before, after):
        clean = "".join(c for c in before + "_" if c.isalnum() or c in "-_.")
        tail = "".join(c for c in after if c.isalnum() or c in "-_.")
        return n if n.lower() in WHOLE else clean + n + tail

    texts = []
    for carrier, n, before, after, upper in cases:
        full = name(n, before, after)
        texts.append(CARRIERS[carrier].format(n=full.upper() if upper else full, s=SECRET))
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    rows = parse_requests(df, keep=("i",)).collect()
    leaks = [(texts[r.i], r.asDict(True)) for r in rows if SECRET in repr(r.asDict(True))]
    assert not leaks, leaks[0]


@pytest.mark.parametrize(
    "url, clean",
    [
        ("/a?q=tea", "/a?q=tea"),
        ("/a?token=x&q=tea", "/a?token=[redacted]&q=tea"),
        ("/a?q=tea;PassWord=x#f", "/a?q=tea;PassWord=[redacted]#f"),
        ("http://u:p@h:80/a?user=x", "http://h:80/a?user=[redacted]"),
        ("http://h/mail?to=a@b", "http://h/mail?to=a@b"),
        ("/a?user_id=7&user-agent=x", "/a?user_id=7&user-agent=x"),
        ("/a?d=%7B%22pwd%22%3A%22x%22%7D", "/a?[redacted]"),
        ("", ""),
        (None, None),
    ],
)
def test_redact_url(spark, url, clean):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(redact.redact_url(F.col("u"))).first()[0] == clean


def test_kinds_of_credentials(spark):
    texts = {
        "POST /x HTTP/1.1\nAuthorization: Basic abc": "basic",
        'GET /x HTTP/1.1\nProxy-Authorization:basic abc\n{"data":{}}': "basic",
        "POST /x HTTP/1.1\nAuthorization: Bearer abc": "bearer",
        'GET /x HTTP/1.1\nCookie: a=1; JSESSIONID=abc\n{"data":{}}': "session",
        "POST /x HTTP/1.1\nCookie: sid=abc": "session",
        "POST http://bob:x@h/ HTTP/1.1": "userinfo",
        "POST /x HTTP/1.1\nCookie: theme=dark\nAuthorization: Digest x": "",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = parse_requests(df, keep=("i",)).orderBy("i").collect()
    kinds = ("basic", "bearer", "session", "userinfo")
    assert [[k for k in kinds if r[f"has_{k}"]] for r in rows] == [[k] if k else [] for k in texts.values()]
    audit = counts.exposure_by_host(parse_requests(df.filter("i = 0"))).first()
    assert (audit.with_basic, audit.with_bearer, audit.exposed) == (1, 0, 1)


def test_an_encrypted_scheme_in_capitals_is_not_cleartext(spark):
    df = spark.createDataFrame([("POST HTTPS://h/x HTTP/1.1\nHost: h\nAuthorization: Basic abc",)], "text string")
    assert counts.exposure_by_host(parse_requests(df)).first().exposed == 0


def test_flags(spark):
    texts = [
        "POST /x HTTP/1.1\nUsername[[:]]a",
        "POST /x HTTP/1.1\npwd: a",
        "POST /x?login=a&passwd=b HTTP/1.1",
        "POST /x?password= HTTP/1.1\nuser[[:]]  ",
        "POST /x HTTP/1.1\nnewpassword[[:]]a",
        MULTIPART.format(n="password", s="x"),
        MULTIPART.format(n="username", s="x"),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = parse_requests(df, keep=("i",)).orderBy("i").collect()
    assert [(r.has_username, r.has_password) for r in rows] == [
        (True, False), (False, True), (True, True), (False, False), (False, True), (False, True), (True, False),
    ]


@pytest.mark.parametrize(
    "value, clean",
    [
        ("http://h/reset-password", "http://h/reset-password"),
        ("http://h/login/password/reset?step=2", "http://h/login/password/reset?step=2"),
        ("Mozilla/5.0 (X11; Linux) Gecko/2010, like", "Mozilla/5.0 (X11; Linux) Gecko/2010, like"),
        ("http://h/?token=x", "http://h/?token=[redacted]"),
        ("token: x", "[redacted]"),
        ("password x", "[redacted]"),
    ],
)
def test_scrub(spark, value, clean):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(redact.scrub(F.col("v"))).first()[0] == clean


def test_extra_names_only_add(spark):
    m = F.create_map(F.lit("k"), F.lit("1"), F.lit("password"), F.lit("2"), F.lit("z"), F.lit("3"))
    out = spark.range(1).select(redact.redact_map(m, extra=("K",))).first()[0]
    assert out == {"k": "[redacted]", "password": "[redacted]", "z": "3"}


def test_json_sink_refuses_sensitive_columns(spark, tmp_path):
    df = spark.createDataFrame([("h", "x")], "host string, Password string")
    with pytest.raises(ValueError, match="Password"):
        sinks.append_json(df, "host", str(tmp_path / "out"))
