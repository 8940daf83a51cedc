"""Mixing by virtual finish times: targets against the repeated resharing, the mix against its promises."""

import random
from fractions import Fraction

import pytest
from helpers import DOCUMENTS, WORD, documents
from pyspark.sql import functions as F

from reqsift.llm import mixing


def reshared(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by sharing the excess out again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = Fraction(share) * sum(sizes.values()), set()
    while True:
        left = budget - sum(most * sizes[s] for s in full)
        whole = sum(weight[s] for s in names if s not in full)
        target = {s: Fraction(most * sizes[s]) if s in full else left * weight[s] / whole for s in names}
        above = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not above:
            return {s: float(t) for s, t in target.items()}
        full |= above


def words(text):
    return len(WORD.findall(text or ""))


def check(spark, rows, quantum=64):
    df = documents(spark, rows)
    out = mixing.mixed(df, quantum=quantum).join(df.select("doc_id", "source").distinct(), "doc_id", "left").collect() if rows else []
    sizes, source_of = {}, {}
    for id_, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
        source_of[id_] = source
    target = reshared(sizes)
    got = mixing.mixed(df, quantum=quantum).collect()
    assert sorted(((r["doc_id"] or -1), r["size"]) for r in got) == sorted((id_ or -1, words(text)) for id_, text, *_ in rows)
    taken = {}
    for r in got:
        source = source_of[r["doc_id"]]
        assert r["target"] == pytest.approx(target[source], rel=1e-12) and r["source_size"] == sizes[source]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
    budget = int(1.5 * sum(sizes.values()))
    assert sum(taken.values()) == budget
    for source, t in taken.items():
        assert t >= target[source] - quantum - 1
        assert t <= target[source] * (1 + (len(sizes) + 1) * quantum / max(budget, 1)) + 1
    assert out is not None
    return got


def texts(n, sources, seed=0, longest=300):
    rng = random.Random(seed)
    return [(i, "w " * rng.randint(0, longest), "en", rng.choice(sources), 1) for i in range(n)]


def test_targets_equal_repeated_resharing(spark):
    rng = random.Random(5)
    for n in (1, 2, 3, 7, 20):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, rng.randint(1, 10**6)]) for i in range(n)} | ({None: 50} if n > 2 else {})
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = reshared(sizes)
        assert {r["source"]: pytest.approx(r["target"], rel=1e-12) for r in got} == want


def test_sources_get_their_targets(spark):
    check(spark, texts(300, ["a", "b", "c", "d", None]))


def test_one_source_with_most_rows_and_small_packets(spark):
    check(spark, texts(300, ["a"] * 8 + ["b", "c"], seed=2), quantum=5)


def test_order_of_code_points(spark):
    check(spark, texts(120, ["\U0001f600", "￮", "Z", "a", "", None], seed=3))


def test_odd_rows(spark):
    """Null, empty, blank and long texts, null ids and sources, repeated rows, clashing names."""
    rows = [(i, t, lang, s if i is not None else "c", n) for i, t, lang, s, n in DOCUMENTS]
    check(spark, [r for r in rows if r[0] != 3] + [(3, "a b c", "en", None, 1)] * 2)


def test_rows_without_ids_spread(spark):
    rows = [(None, "w " * 20, "en", "a", 1)] * 50 + texts(50, ["b"], seed=4)
    got = check(spark, rows)
    assert sum(r["taken"] > 0 for r in got if r["doc_id"] is None) > 10


def test_nothing_to_mix(spark):
    assert check(spark, []) == []
    got = check(spark, [(1, None, "en", "a", 1), (2, " ", "en", "b", 1)])
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2


def test_the_mix_is_gapless_and_served_in_turn(spark):
    df = documents(spark, texts(200, ["a", "b", "c"], seed=6))
    found, packets = mixing.mix(df)
    rows = sorted(map(tuple, packets.join(found.select("row", "rank", "size"), "row").select("position", "words", "rank", "row", "pass", "start", "size").collect()))
    at = 0
    for position, n, *_ in rows:
        assert position == at
        at += n
    # Each source has its share of any beginning of the mix, to within a packet of every source.
    target = {r["rank"]: r["target"] for r in found.select("rank", "target").distinct().collect()}
    served = dict.fromkeys(target, 0)
    for position, n, rank, *_ in rows:
        served[rank] += n
        for s, t in target.items():
            assert abs(served[s] - (position + n) * t / sum(target.values())) <= 64 * (len(target) + 1)
    # A document's packets don't overlap and lie inside it.
    for row, pass_, start, n, size in [(r[3], r[4], r[5], r[1], r[6]) for r in rows]:
        assert pass_ in (0, 1) and 0 <= start < start + n <= size
    assert len({(r[3], r[4], r[5]) for r in rows}) == len(rows)


def test_reruns_agree_however_rows_are_dealt(spark):
    rows = texts(150, ["a", "b", None], seed=8)
    one = sorted(map(tuple, mixing.mixed(documents(spark, rows)).collect()))
    two = sorted(map(tuple, mixing.mixed(documents(spark, rows[::-1]).repartition(7)).collect()))
    assert one == two


def test_own_sizes(spark):
    df = documents(spark, texts(50, ["a", "b"], seed=9))
    got = mixing.mixed(df, size=F.length("text").cast("long"), weights=(1, 1), share=0.5, most=1)
    assert sum(r["taken"] for r in got.collect()) == int(0.5 * df.agg(F.sum(F.length("text"))).first()[0])
