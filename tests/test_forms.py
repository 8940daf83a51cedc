"""Credentials that only their form tells, under harmless names, and plain values that must stay."""

import random
import string

import pytest
from pyspark.sql import functions as F

from reqsift.functions import redact
from reqsift.operators import counts
from reqsift.operators.parse import parse_requests

RANDOM = random.Random(11)


def drawn(n, letters):
    return "".join(RANDOM.choice(letters) for _ in range(n))


BASE64 = string.ascii_letters + string.digits + "+/"
URL64 = string.ascii_letters + string.digits + "-_"
FORMS = {
    "signed": f"eyJhbGciOiJIUzI1NiJ9.{drawn(40, URL64)}.{drawn(43, URL64)}",
    "three parts": f"{drawn(24, string.ascii_letters + string.digits)}.{drawn(24, string.ascii_letters)}.{drawn(24, string.digits + 'abXY')}",
    "key id": "AKIA" + drawn(16, string.ascii_uppercase + string.digits),
    "code host": "ghp_" + drawn(36, string.ascii_letters + string.digits),
    "chat": "xoxb-" + drawn(12, string.digits) + "-" + drawn(24, string.ascii_letters),
    "payment": "sk_live_" + drawn(24, string.ascii_letters + string.digits),
    "maps": "AIza" + drawn(35, URL64),
    "private key": "-----BEGIN+RSA+PRIVATE+KEY-----" + drawn(64, string.ascii_letters),
    "hex": drawn(40, "0123456789abcdef"),
    "hex capitals": drawn(32, "0123456789ABCDEF"),
    "base64": drawn(43, string.ascii_letters + string.digits) + "=",
    "mixed": drawn(24, string.ascii_letters + string.digits),
    "small and digits": "q7x9" + drawn(28, string.ascii_lowercase + string.digits),
}
NAMES = ["ref", "colour", "q", "X-Trace", "data1"]
CARRIERS = [
    "POST /x HTTP/1.1\nHost: h\n{n}[[:]]{s}",
    "POST /x HTTP/1.1\nHost: h\n{n}: {s}",
    "POST /x HTTP/1.1\nHost: h\n{n}: abc {s}, def",
    "POST /x?{n}={s} HTTP/1.1\nHost: h",
    "POST /x?a=1&{n}={s}&b=2#f HTTP/1.1\nHost: h",
    "POST /x#{n}={s} HTTP/1.1\nHost: h",
    "POST /x/{s}/y HTTP/1.1\nHost: h",
    "POST http://h/x?{n}={s} HTTP/1.1\nHost: h\nReferer: http://h/{n}/{s}?c=3",
    "POST /x?d=%7B%22{n}%22%3A%22{s}%22%7D HTTP/1.1\nHost: h",
    "POST /x HTTP/1.1\nHost: h\nform[[:]]{{\"{n}\":\"{s}\"}}",
    "POST /x HTTP/1.1\nHost: h\nform[[:]]{n}={s}&x=1",
    "POST /x HTTP/1.1\nHost: h\n{s}[[:]]v",
    'GET /x HTTP/1.1\nHost: h\n{{"data":{{"{n}":"{s}"}}}}',
    'GET /x HTTP/1.1\nHost: h\n{{"data":"{{\\"{n}\\"[[:]]\\"{s}\\"}}"}}',
    'GET /x HTTP/1.1\nHost: h\n{{"data":{{"f":[{{"{n}":{{"deep":"{s}"}}}}]}}}}',
    "POST /x HTTP/1.1\nHost: h\nxml[[:]]<a><{n}>{s}</{n}></a>",
]
PLAIN = [
    "", "tea", "text/html,application/xhtml+xml,application/xml;q=0.9,image/avif,image/webp,*/*;q=0.8",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.2 Mobile/15E148",
    "http://shop.example.org/en/articles/how-to-install-windows-11-on-an-old-computer-2024?page=2",
    "https://www.example.com/Catalogue/MensShoes/RunningShoes/Size42/BrandNewCollection2024.html",
    "/static/js/vendors~main.chunk.js", "2024-01-15T10:22:33.123456+01:00", "Wed, 21 Oct 2015 07:28:00 GMT",
    "550e8400-e29b-41d4-a716-446655440000", "gzip, deflate, br, zstd", "en-GB,en;q=0.9,de-DE;q=0.8", "getUserAccountDetails",
    "customer_shipping_address_line_2", "the quick brown fox jumps over the lazy dog", "31.415926535897932384626433",
    "IMG_20240115_102233_HDR.jpg", "W3C//DTD XHTML 1.0 Transitional//EN", "12345678901234567890123456", "+49 30 1234567 890",
    "Donaudampfschifffahrtsgesellschaftskapitaen", "a.very.long.host.name.with.many.labels.example.co.uk",
]
HARMLESS = ["passenger", "compass", "author", "shipping", "opinion", "passage", "authority", "spinner", "mapping", "bypass", "footprint"]


def texts():
    return [(f, c.format(n=n, s=s)) for f, s in FORMS.items() for c in CARRIERS for n in NAMES]


def parsed(spark, lines):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i long, text string")
    return parse_requests(df, keep=("i",))


def test_no_form_comes_out_under_any_name(spark):
    cases = texts()
    rows = parsed(spark, [t for _, t in cases]).collect()
    assert len(rows) == len(cases)
    for r in rows:
        form, text = cases[r.i]
        out, secret = repr(r.asDict(True)), FORMS[form]
        parts = [secret[i : i + 12] for i in range(0, len(secret) - 12, 6)]
        assert not any(p in out for p in parts if "-----BEGIN" not in p and "PRIVATE" not in p), (form, text, out)


def test_forms_are_counted(spark):
    lines = [CARRIERS[i].format(n="ref", s=s) for s in FORMS.values() for i in (0, 1, 3, 12)]
    audit = counts.exposure_by_host(parsed(spark, lines)).first()
    assert (audit.requests, audit.with_key, audit.exposed) == (len(lines),) * 3
    plain = counts.exposure_by_host(parsed(spark, [CARRIERS[0].format(n="ref", s="tea")])).first()
    assert (plain.with_key, plain.exposed) == (0, 0)


@pytest.mark.parametrize("value", PLAIN)
def test_plain_values_stay(spark, value):
    df = spark.createDataFrame([(value,)], "v string")
    got = df.select(redact.mask_forms(F.col("v")), redact.redact_url(F.col("v")), redact.holds_form(F.col("v"))).first()
    assert tuple(got) == (value, value, False)


def test_null_is_null(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert tuple(df.select(redact.mask_forms(F.col("v")), redact.holds_form(F.col("v"))).first()) == (None, False)


def test_only_the_credential_is_replaced(spark):
    df = spark.createDataFrame([(f"before {FORMS['mixed']} after {FORMS['key id']}",)], "v string")
    assert df.select(redact.scrub(F.col("v"))).first()[0] == "before [redacted] after [redacted]"


def test_one_token_inside_another(spark):
    token = FORMS["mixed"]
    df = spark.createDataFrame([(f"{token} {token}x9Z",)], "v string")
    assert df.select(redact.scrub(F.col("v"))).first()[0] == "[redacted] [redacted]"


def test_random_keys_are_found_and_words_are_not(spark):
    rng = random.Random(4)
    keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(rng.randint(20, 64))) for _ in range(2000)]
    words = "account order Shipping address Line customer id Number 2024 12 list View page detail Item price 7 update".split()
    names = [rng.choice(["-", "_", ""]).join(rng.choice(words) for _ in range(rng.randint(3, 7))) for _ in range(2000)]
    df = spark.createDataFrame([(k, n) for k, n in zip(keys, names)], "k string, n string")
    found, wrong = df.agg(F.count_if(redact.holds_form(F.col("k"))), F.count_if(redact.holds_form(F.col("n")))).first()
    assert found >= 1980 and wrong <= 40, (found, wrong)


def test_harmless_names_keep_their_values(spark):
    lines = [f"POST /x?{n}=tea HTTP/1.1\nHost: h\n{n}[[:]]tea\nX-{n}: tea" for n in HARMLESS]
    for r in parsed(spark, lines).collect():
        assert "redacted" not in repr(r.asDict(True)) and not r.has_password


def test_names_that_hold_a_password_are_counted(spark):
    names = "userpass dbpass pass1 pincode passkey otpcode pswd psw pword mdp senha contrasena wachtwoord heslo kennwort pw".split()
    rows = parsed(spark, [f"POST /x HTTP/1.1\nHost: h\n{n}[[:]]v" for n in names]).collect()
    assert [names[r.i] for r in rows if not r.has_password] == []
