"""Runs of repeated words against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import DOCUMENTS, LONG, documents

from reqsift.llm import periodic


def brute(words):
    """Every maximal stretch of every period, the smallest period of each."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i:
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in best.items())


def collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < e for s, e, q in runs))


def odd_texts():
    rng = random.Random(7)
    texts = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 200, ["a", "b"] * 4, ["a", "b"] * 3, "a b c ".split() * 33 + ["a"]]
    for letters in (1, 2, 3, 5):
        texts += [[rng.choice("abcde"[:letters]) for _ in range(rng.randint(1, 120))] for _ in range(12)]
    for _ in range(25):  # planted periods, next to each other and inside one another
        text = []
        for _ in range(rng.randint(1, 4)):
            part = [rng.choice("abcdefghij") for _ in range(rng.randint(1, 17))]
            text += (part * rng.randint(1, 9))[: rng.randint(1, 140)]
        texts.append(text)
    a, b = ["a"], ["a", "b"]
    for _ in range(10):
        a, b = b, b + a
    texts.append(b)  # a Fibonacci word
    texts.append([w for w in "abcde" for _ in range(7)] * 5)
    return texts


def test_runs_of_many_texts_equal_brute_force():
    texts = odd_texts()
    assert periodic.runs_of_texts([[w.encode() for w in t] for t in texts]) == [brute(t) for t in texts]


def test_collapsed_text():
    for text in odd_texts():
        words = [w.encode() for w in text]
        [runs] = periodic.runs_of_texts([words])
        assert periodic.collapsed(words, runs).decode() == collapsed(text, runs)


@pytest.mark.parametrize("b", [1, 2, 8, 64])
@pytest.mark.parametrize("prime", periodic.PRIMES)
def test_squared_differences(b, prime):
    rng = np.random.default_rng(b)
    blocks, windows = rng.integers(0, 1 << 20, (b, 5)), rng.integers(0, 1 << 20, (2 * b, 5))
    windows[:b, 2] = blocks[:, 2]
    got = periodic.squared_differences(blocks, windows, *prime)
    want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(blocks[:, r], windows[s:, r])) % prime[0] for r in range(5)] for s in range(b)]
    assert got.tolist() == want and got[0, 2] == 0


def test_occurrences_are_those_of_plain_comparison():
    rng = np.random.default_rng(3)
    ids = np.append(rng.integers(0, 2, 600), 9)
    for b in (1, 2, 4, 8, 16):
        starts = np.arange(0, len(ids) - b, b)
        want = {(s, d) for s in starts.tolist() for d in range(b, 2 * b) if s + d + b <= len(ids) and (ids[s : s + b] == ids[s + d : s + d + b]).all()}
        at, d = periodic.occurrences(ids, starts, b)
        assert set(zip(at.tolist(), d.tolist())) == want


def test_large_periods_and_one_long_text():
    rng = random.Random(1)
    part = [b"%d" % rng.randrange(10**6) for _ in range(9_001)]
    text = [b"x"] + part * 5 + [b"y"] * 70_000
    [runs] = periodic.runs_of_texts([text])
    assert runs == [(1, 45_006, 9_001), (45_006, 115_006, 1)]


def test_bounds_that_the_method_needs():
    with pytest.raises(ValueError):
        periodic.find_runs(np.array([1]), exponent=3)


def test_rows(spark):
    """Nulls, empty, blank and long texts, repeated rows and clashing names: a row for each row."""
    extra = [(20, "na " * 9 + "batman " + "a b " * 5, "en", "a", 1), (None, "x " * 6, "en", "a", 1), (21, LONG + " tick tock" * 50, "en", "a", 1)]
    rows = DOCUMENTS + extra
    found = periodic.periodic_runs(documents(spark, rows))
    assert found.columns == ["doc_id", "runs", "collapsed"]
    got = sorted((r["doc_id"] or 0, [(x["start"], x["start"] + x["length"], x["period"]) for x in r["runs"]], r["collapsed"]) for r in found.collect())
    want = []
    for id_, text, *_ in rows:
        words = periodic.WORD and [w.decode() for w in (text or "").encode().split()]
        runs = brute(words) if len(words) < 2000 else [(len(words) - 100, len(words), 2)] if "tick" in text else []
        want.append((id_ or 0, runs, collapsed(words, runs) if len(words) < 2000 or runs == [] else " ".join(words[:-98])))
    assert got == sorted(want)


def test_digests(spark):
    text = "na " * 9 + "batman " + "a b " * 5
    [row] = periodic.digest_columns(periodic.periodic_runs(documents(spark, [(20, text, "en", "a", 1)]))).collect()
    assert row["n_runs"] == 2 and (row["start"], row["length"], row["period"], row["exponent_milli"]) == (10, 10, 2, 5000)
    assert row["runs_sha256"] == hashlib.sha256(b"0,9,1\n10,10,2\n").hexdigest()
    assert row["collapsed_sha256"] == hashlib.sha256(b"na batman a b").hexdigest()


def test_longest_run_by_start_then_none(spark):
    texts = [(1, "a a a a a a x b b b b b b", "en", "a", 1), (2, "nothing here", "en", "a", 1), (3, None, "en", "a", 1)]
    rows = periodic.digest_columns(periodic.periodic_runs(documents(spark, texts))).orderBy("doc_id").collect()
    assert (rows[0]["start"], rows[0]["length"]) == (0, 6)
    for row in rows[1:]:
        assert row["n_runs"] == 0 and [row[c] for c in ("start", "length", "period", "exponent_milli")] == [None] * 4
        assert row["runs_sha256"] == hashlib.sha256(b"").hexdigest()
    assert rows[2]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    assert periodic.digest_columns(periodic.periodic_runs(documents(spark, []))).collect() == []


def test_planted_runs(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(i % 23)), "en", "a", 1) for i in range(300)] + [(None, "a b", "en", "a", 1), (301, None, "en", "a", 1)]
    got = sorted((r["doc_id"] or -1, r["text"]) for r in periodic.with_planted_runs(documents(spark, rows)).collect() if r["doc_id"] != 301)
    want = []
    for id_, text, *_ in rows[:-1]:
        h = zlib.crc32(str(id_).encode())
        g, words = h // 10, text.split()
        if id_ is not None and h % 10 == 0 and words:
            n = len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(w if i < a else words[a + (i - a) % p] for i, w in enumerate(words))
        want.append((-1 if id_ is None else id_ or -1, text))
    assert got == sorted(want)
