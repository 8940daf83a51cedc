"""Clustering by lookup tables against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from reqsift.llm import centroids

NAN, INF = float("nan"), float("inf")


def brute(rows, dims, k, rounds, scale):
    """``(id, cluster, distance)`` of the usable rows, and the centroids."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        held = [[] for _ in centres]
        for _, v in kept:
            held[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(h) for x in zip(*h)] if h else c for h, c in zip(held, centres)]
    return sorted(((-1 if i is None else i, n, d) for i, v in kept for d, n in [nearest(v)])), centres


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.selectExpr("*", "'clash' AS v", "1 AS cluster", "2L AS distance", "'x' AS key").repartition(3)


def check(spark, rows, dims=3, k=4, rounds=3, scale=64):
    assigned, centres = centroids.cluster(table(spark, rows), dims=dims, k=k, rounds=rounds, scale=scale)
    want, want_centres = brute(rows, dims, k, rounds, scale)
    got = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in assigned.collect())
    assert got == want and centres.tolist() == want_centres
    return assigned, centres


def vectors(n, dims=3, seed=0, spread=2.0):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-spread, spread) for _ in range(dims)]) for i in range(n)]


def test_against_plain_python(spark):
    check(spark, vectors(200))


def test_rows_that_are_no_vectors_and_rows_without_id(spark):
    rows = vectors(40) + [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0]), (104, [1.0, NAN, 0.0]), (105, [INF, 0.0, 0.0])]
    rows += [(106, [1.0, 2.0, 3.0, 4.0]), (None, [0.5, 0.5, 0.5]), (None, [0.1, 0.2, 0.3]), (None, None), (7, [0.0, 0.0, -0.0])]
    check(spark, rows + rows[:10])


def test_ties_and_equal_vectors(spark):
    check(spark, [(i, [float(i % 2), 0.0, -1.0]) for i in range(30)])


def test_fewer_vectors_than_centroids(spark):
    _, centres = check(spark, vectors(3))
    assert len(centres) == 3


def test_values_far_apart(spark):
    check(spark, vectors(100, spread=1e6))


def test_too_large_to_square(spark):
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(table(spark, [(1, [1e30, 0.0, 0.0])] + vectors(5)), dims=3, k=2)


def test_empty_table(spark):
    assigned, centres = centroids.cluster(table(spark, []), dims=3)
    assert assigned.collect() == [] and len(centres) == 0
    assert centroids.with_totals(assigned, centres).collect() == []


def test_tables_hold_the_occurring_values():
    matrix = np.array([[0, 5, -7], [10**6, 5, 2], [3, 4, -7]])
    centres = np.array([[1, 2, 3], [-4, 0, 9]])
    tables = centroids.Tables(matrix, centres)
    assert [len(t) for t in tables.tables] == [3, 2, 2]
    assert tables.distances().tolist() == ((matrix[:, None] - centres[None]) ** 2).sum(axis=2).tolist()


def test_totals(spark):
    assigned, centres = check(spark, vectors(50), k=3)
    rows = centroids.with_totals(assigned, centres).collect()
    assert {r["inertia"] for r in rows} == {sum(r["distance"] for r in rows)}
    for c in {r["cluster"] for r in rows}:
        mine = [r for r in rows if r["cluster"] == c]
        assert {r["cluster_inertia"] for r in mine} == {sum(r["distance"] for r in mine)}
        digest = hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest()
        assert {r["centroid_sha256"] for r in mine} == {digest}
