"""URL rules, WARC archives and licences on rows with nulls, ties, repeats and clashing columns; empty tables."""

import base64
import gzip
import hashlib
import heapq
import random

import pytest
from helpers import documents
from pyspark.sql import functions as F

from reqsift.llm import licences, urlrules, warc
from reqsift.session import scratch_dir

URLS = [
    (1, "https://EXAMPLE.org/es/1?x=/en/"),
    (2, "http://a.example.org/en/12#top"),
    (3, None),
    (4, "no scheme"),
    (5, ""),
    (6, "https://shop.com/de/a"),
    (6, "https://shop.com/de/a"),
    (7, "ftp://com/fr/x"),
    (8, "https://notexample.net"),
    (None, "https://x.com/fr/a?q"),
    (9, "https://bad.net/win/5"),
    (10, "https://Ünï.net/É?a://b/c"),
    (11, "x://"),
]


def pages(spark, rows=URLS):
    clash = [F.lit("clash").alias(c) for c in ("host", "path", "rule", "verdict", "rules", "token")]
    return spark.createDataFrame(rows, "page_id long, url string").select("*", *clash)


def labelled(spark, rows=40):
    bad = [(f"https://{'bad' if i % 2 else 'good'}.net/win/{i}", bool(i % 2)) for i in range(rows)]
    return spark.createDataFrame(bad + [("https://bad.net/win/0", None), (None, True)], "url string, bad boolean")


def test_filter_urls(spark):
    got = urlrules.filter_urls(pages(spark), labelled(spark), min_rows=10, common=0.9).collect()
    assert len(got) == len(URLS)
    by_id = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert by_id == {
        1: ("example.org", "/es/1", "example.org/es/", "block"),
        2: ("a.example.org", "/en/12", "example.org/en/1", "block"),
        3: ("", "", None, "allow"),
        4: ("", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("shop.com", "/de/a", "com/de/", "block"),
        7: ("com", "/fr/x", "com/fr/", "allow"),
        8: ("notexample.net", "", None, "allow"),
        None: ("x.com", "/fr/a", "com/fr/", "allow"),
        9: ("bad.net", "/win/5", None, "block"),  # by a mined rule
        10: ("Ünï.net", "/É", None, "allow"),
        11: ("", "", None, "allow"),
    }


def test_mined_rules(spark):
    rules = urlrules.mine_rules(labelled(spark), min_rows=10, common=0.9)[0].collect()
    assert {r["rule"]: (r["confidence"], r["rows"]) for r in rules} == {"h:bad.net": (1.0, 20)}
    none = labelled(spark).limit(0)
    assert [x.count() for x in urlrules.mine_rules(none)] == [0, 0]
    assert urlrules.filter_urls(pages(spark, []), labelled(spark)).count() == 0


def planted(spark):
    """Rows with the production parameters' support: a host that is bad in one language only, and rules of two to four tokens."""
    url = lambda host, lang, n, rest="": (f"https://{host}/{lang}/{n}{rest}")
    rows = [(url("x.net", "en", i), i >= 2) for i in range(40)] + [(url("x.net", "de", i), i >= 32) for i in range(40)]
    rows += [(url(f"h{i % 50}.org", "en", i), False) for i in range(300)]
    four = ["p:aa", "p:bb", "p:cc", "p:dd"]
    for missing in (None, *four):
        path = "/".join(p[2:] for p in four if p != missing)
        rows += [(f"https://y{i}.com/{path}", missing is None) for i in range(25)]
    return spark.createDataFrame(rows, "url string, bad boolean")


def test_rules_of_common_tokens_and_of_any_length(spark):
    # All in https, so that no rule needs to name it; p:en is in most rows.
    mined = {r["rule"]: (r["confidence"], r["rows"]) for r in urlrules.mine_rules(planted(spark))[0].collect()}
    assert mined.pop("h:net|h:x.net p:en") == (0.95, 38)  # the two hosts stand in the same rows
    assert mined.pop("p:aa p:bb p:cc p:dd") == (1.0, 25)
    assert mined == {}
    rows = [(1, "https://x.net/en/7"), (2, "https://x.net/de/7"), (3, "https://z.com/dd/cc/bb/aa"), (4, "https://z.com/aa/bb/cc")]
    got = urlrules.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), planted(spark), rules=()).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {1: "block", 2: "allow", 3: "block", 4: "allow"}


def test_a_host_of_most_or_all_rows_gets_its_rule(spark):
    rows = [(f"https://spam.net/{i}", i >= 5) for i in range(100)] + [(f"http://good{i}.org/{i}", False) for i in range(60)]
    mined = urlrules.mine_rules(spark.createDataFrame(rows, "url string, bad boolean"))[0].collect()
    assert {"h:net|h:spam.net|s:https": (0.95, 95)}.items() <= {r["rule"]: (r["confidence"], r["rows"]) for r in mined}.items()
    mined = urlrules.mine_rules(spark.createDataFrame(rows[:100], "url string, bad boolean"))[0].collect()
    assert {r["rule"] for r in mined} == {"h:net|h:spam.net|s:https"}
    got = urlrules.filter_urls(pages(spark, [(1, "ftp://spam.net/a"), (2, "ftp://other.org/a")]), spark.createDataFrame(rows[:100], "url string, bad boolean"), rules=())
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == {1: "block", 2: "allow"}


def apriori(rows, least, confidence):
    """Item sets that block, by trying all: sets of tokens with distinct rows, without those that have a part as sure."""
    from itertools import combinations

    held = {}
    for n, (tokens, _) in enumerate(rows):
        for token in tokens:
            held.setdefault(token, set()).add(n)
    items = {}
    for token, where in sorted(held.items()):
        items.setdefault(frozenset(where), []).append(token)
    items = {"|".join(tokens): where for where, tokens in items.items()}
    bad = {n for n, (_, b) in enumerate(rows) if b}
    sure = {}
    for size in range(1, 6):
        for names in combinations(sorted(items), size):
            where = frozenset.intersection(*(items[x] for x in names))
            if len(where & bad) >= least and len(where & bad) >= confidence * len(where):
                sure[names] = len(where & bad) / len(where)
    return {" ".join(k): v for k, v in sure.items() if not any(set(p) < set(k) and w >= v for p, w in sure.items())}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules_equal_brute_force_apriori(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(160):
        path = [w for w in "abcdefg" if rng.random() < 0.45]
        path += ["twin1", "twin2"] if "a" in path else []
        url = f"http://x{rng.randint(1, 3)}.com/{'/'.join(path)}" + ("?s=1&t=2" if rng.random() < 0.2 else "")
        rows.append((url, rng.random() < (0.95 if {"a", "c"} <= set(path) or "?" in url else 0.6 if "b" in path else 0.1)))
    df = spark.createDataFrame(rows, "url string, bad boolean")
    tokens = [(r["t"], r["bad"]) for r in df.select(urlrules.url_tokens("url").alias("t"), "bad").collect()]
    got = urlrules.mine_rules(df, min_rows=6, min_confidence=0.8)[0].collect()
    # Sets with what stands in every row are no surer than without.
    want = apriori([([x for x in t if x not in ("s:http", "h:com")], b) for t, b in tokens], 6, 0.8)
    assert {r["rule"]: round(r["confidence"], 9) for r in got} == {k: round(v, 9) for k, v in want.items()} and len(want) > 3


@pytest.mark.parametrize("mixed", [False, True])
def test_many_shared_parameters_are_one_item(spark, mixed):
    """30 URLs of a crawled site with 40 equal parameters, all bad or most of them."""
    query = "&".join(f"p{k}=1" for k in range(40))
    rows = [(f"http://site.biz/{i}?{query}", not mixed or i > 0) for i in range(30)] + [(f"http://g{i}.org/{i}", False) for i in range(70)]
    [rule] = urlrules.mine_rules(spark.createDataFrame(rows, "url string, bad boolean"))[0].collect()
    assert len(rule["items"]) == 1 and rule["rule"].count("|") == 41 and rule["confidence"] == (29 / 30 if mixed else 1.0)


def test_rules_are_matched_by_url(spark):
    """No id, and one id for several URLs none of which meets the rule alone."""
    # The rule is "h:x.net p:en".
    rows = [(None, "https://x.net/en/1"), (None, "https://x.net/de/1"), (1, "https://x.net/de/2"), (1, "https://y.org/en/2"), (2, None)]
    rows += [(3, "https://x.net/en/3"), (3, "https://y.org/de/3"), (3, "https://x.net/en/3")]
    got = urlrules.filter_urls(pages(spark, rows), planted(spark), rules=()).collect()
    verdicts = sorted((r["host"] + r["path"], r["verdict"]) for r in got)
    assert verdicts == sorted(
        ((url or "https://").split("://")[1], "block" if (url or "").startswith("https://x.net/en/") else "allow") for _, url in rows
    )


PAGES = [
    (3, "http://www.b.org/2", "same"),
    (1, "http://a.org/x#frag", "same"),
    (2, "http://b.org/1", None),
    (4, None, ""),
    (5, "http://b.org/1", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n\r\n\r\n"),
    (6, "http://b.org/\r\nX: y", "é" * 5000),
    (7, "http://b.org/1", "same"),
    (8, "http://b.org/1", "Große\n"),
    (8, "http://b.org/1", "Große\n"),
]


def test_warc(spark):
    clash = [F.lit("clash").alias(c) for c in ("digest", "id", "date", "payload", "type", "size", "d")]
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").select("*", *clash)
    path = scratch_dir(spark, "warc")
    warc.write_archives(df, path, archive_bytes=2000)
    got = warc.archived_pages(spark, path).collect()
    assert len(got) == len(PAGES)
    first = {}
    for i, _, html in PAGES:
        first[html or ""] = min(first.get(html or "", i), i)
    payload = {i: (html or "") for i, _, html in PAGES}
    for r in got:
        data = payload[r["id"]].encode()
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        origin = first[payload[r["id"]]]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if origin == r["id"] else ("revisit", origin))
    ordered = sorted(got, key=lambda r: r["capture_no"])
    assert [r["capture_no"] for r in ordered] == list(range(1, len(got) + 1))
    assert [r["url_key"] for r in ordered] == sorted(r["url_key"] for r in got)
    whole = warc.read_archives(spark, path, payloads=True).filter("type = 'response'").collect()
    assert sorted(r["payload"] for r in whole) == sorted([*first, payload[8]])


def test_warc_keeps_small_payloads_and_empty_tables(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = scratch_dir(spark, "warc")
    warc.write_archives(df, path, least=5)
    assert {r["record_type"] for r in warc.archived_pages(spark, path).collect()} == {"response"}
    path = scratch_dir(spark, "warc")
    warc.write_archives(df.limit(0), path)
    assert warc.archived_pages(spark, path).count() == 0


def test_changed_archives_are_an_error(spark, tmp_path):
    same = "equal texts, long enough to be stored once " * 10
    df = spark.createDataFrame([(1, "http://a.org/1", same), (2, "http://a.org/2", same)], "page_id long, url string, html string")
    path = scratch_dir(spark, "warc")
    warc.write_archives(df, path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    data = b"".join(gzip.decompress(f["content"]) for f in files if f["length"])
    head, found, rest = data.partition(b"WARC-Type: revisit")
    assert found and data.count(b"equal texts") == 10
    digest = base64.b32encode(hashlib.sha1(same.encode()).digest())
    start = data.rindex(b"WARC/1.1", 0, len(head))
    revisit = data[start:].replace(digest, b"A" * 32, 1)
    for name, changed in (("body", data.replace(b"equal texts", b"other texts", 1)), ("revisit", data[:start] + revisit)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.txt.gz").write_bytes(gzip.compress(changed))
        with pytest.raises(Exception, match="digest"):
            warc.archived_pages(spark, str(tmp_path / name)).collect()


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(runs):
    lists = [sorted((i * 7919 + j * j * 31) % 50 for j in range(i * 3)) for i in range(runs)]
    tagged = [[(x, i) for x in a] for i, a in enumerate(lists)]
    assert list(warc.LoserTree([iter(a) for a in tagged])) == list(heapq.merge(*tagged))


def test_broken_archive_is_an_error():
    with pytest.raises(ValueError):
        list(warc._records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc._records(b"HTTP/1.1\r\n\r\n"))


def test_licences(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "LICENSE", mit),
        (2, "a/x.py", "code\n\tReleased  under the MIT license\ncode"),
        (3, "a/b/COPYING", gpl),
        (4, "a/b/c/deep.py", "no notice"),
        (5, "a/y.py", None),
        (6, "a/b/z.py", mit),
        (7, None, gpl),
        (8, None, ""),
        (8, None, ""),
        (9, "a/b/w.py", "a copyright notice that names nothing at all"),
        (9, "a/b/w.py", "a copyright notice that names nothing at all"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    df = df.selectExpr("*", "1 AS licence", "2 AS line", "3 AS folder", "4 AS id", "5 AS own_licence")
    got = {r["doc_id"]: (r["own_licence"], r["licence"], r["inherited_from"]) for r in licences.scan_licences(df).collect()}
    assert got == {
        1: ("MIT", "MIT", None),
        2: ("MIT", "MIT", None),
        3: ("GPL-3.0", "GPL-3.0", None),
        4: (None, "GPL-3.0", "a/b/COPYING"),
        5: (None, "MIT", "LICENSE"),
        6: ("MIT", "MIT", None),
        7: ("GPL-3.0", "GPL-3.0", None),
        8: (None, None, None),
        9: (None, "GPL-3.0", "a/b/COPYING"),
    }
    assert licences.scan_licences(df).count() == len(rows)
    assert licences.scan_licences(documents(spark, []).withColumn("path", F.lit("x"))).count() == 0


WRAPPED = [
    (1, "a/x.py", "# Copyright 2020 A. Author\n#\n# Licensed under the Apache\n# License, Version 2.0.\n\nimport os\n", "Apache-2.0"),
    (2, "a/y.c", "/*\n * This work is licensed under the GNU\n * General Public License, version 2.\n */\nint x;\n", "GPL-2.0"),
    (3, "a/z.txt", "prose of its own\nReleased\nunder\nthe\nMIT\nLicense.\nmore prose of another kind", "MIT"),
    (4, None, "-- SPDX-License-Identifier: LGPL-3.0-or-later\nSELECT 1", "LGPL-3.0"),
    (5, "b/t.rs", "// Dedicated to the public\n// domain under CC0 1.0.\nfn main() {}", "CC0-1.0"),
    (6, "b/u.rs", "// a comment on what follows\nfn main() {}", None),
    (7, "b/v.rs", "// SPDX-License-Identifier: ISC\nfn main() {}", None),
    (8, "c/README", "MIT License\n\nsome words", "MIT"),
    (None, "c/w", "Licensed under\nCC BY-SA 4.0.", "CC-BY-SA-4.0"),
]


def test_wrapped_notices(spark):
    df = spark.createDataFrame([r[:3] for r in WRAPPED], "doc_id long, path string, text string")
    got = {r["doc_id"]: r["own_licence"] for r in licences.scan_licences(df).collect()}
    assert got == {r[0]: r[3] for r in WRAPPED}


def test_whole_licence_texts(spark):
    texts = licences.whole_texts()
    changed = lambda t: " \n".join(t.replace("Regents of the University of California", "A. Author").split()[3:])
    rows = [(i, f"{name}/LICENSE", changed(t)) for i, (name, t) in enumerate(texts)]
    rows += [(100 + i, f"{name}/src/x", "code") for i, (name, _) in enumerate(texts)]
    agpl = dict(texts)["GPL-3.0"].replace("GENERAL PUBLIC", "AFFERO GENERAL PUBLIC").replace("29 June", "19 November")
    rows += [(200, "own/LICENSE", "terms of our own that say nothing of the usual kind"), (201, "own/x", "code"), (202, "agpl/COPYING", agpl)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r["doc_id"]: r for r in licences.scan_licences(df).collect()}
    for i, (name, _) in enumerate(texts):
        assert got[i]["own_licence"] == got[100 + i]["licence"] == name
        assert got[100 + i]["inherited_from"] == f"{name}/LICENSE"
    assert got[200]["licence"] is None and got[201]["licence"] is None and got[202]["licence"] == "AGPL-3.0"
