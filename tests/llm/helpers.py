"""Rows for the operators' tests: nulls, empty and long texts, ties, repeats, and columns whose names clash."""

from __future__ import annotations

import hashlib
import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "The quick brown fox jumps over the lazy dog and runs to the river for a drink of water with all of its friends"
LONG = " ".join(f"word{i % 977} of the text{i}" for i in range(12_000))

DOCUMENTS = [
    (1, PROSE, "en", "a", 1),
    (2, PROSE + " today", "en", "a", 2),
    (3, PROSE, None, None, None),
    (3, PROSE, None, None, None),  # repeated whole
    (4, None, "en", "b", 0),
    (5, "", "en", "b", 0),
    (6, " \t\n ", "en", "b", 4),
    (7, PROSE.replace(" ", "  \n"), "en", "b", 5),
    (None, PROSE + " today", "en", "c", 6),
    (None, "a text of its own without any number at all and with the usual words in it", "en", "c", 6),
    (8, LONG, "en", "c", 7),
    (9, LONG + " end", "en", "c", 8),
    (10, "x", "en", "c", 1),
    (11, "x", "en", "c", 1),
    (12, "Größe é 日本語 \x85 \u00a0 ſ İ \U0001f600 password = hunter22 and the rest of it is fine", "de", "d", 9),
    (13, "one\none\ntwo\n\none two\n the of and to", "en", "d", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHES = "_counts _t _w kept keep_id n_words component_id node id key digest blob found length piece ids _row _own _m start rows path".split()


def documents(spark, rows=DOCUMENTS, clash=True):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHES if clash else ():
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df.repartition(3)


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def shingles(text, width):
    found = words(text)
    return {tuple(found[i : i + width]) for i in range(max(len(found) - width + 1, 1))} if found else set()


def linked(a, b, percent=80):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def normal_digest(text):
    return hashlib.sha256(SPACE.sub(" ", text or "").encode()).hexdigest()


def groups_of(texts, width):
    """Smallest index reachable over links, by brute force."""
    sets = [shingles(t, width) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], sets
