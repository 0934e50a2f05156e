"""Interval joins against brute force."""

import random

import pytest

from helixframe.operators import rangejoin as rj


@pytest.fixture(scope="module")
def data(spark):
    r = random.Random(1)
    pts = [(i, r.choice("ab"), r.randrange(0, 500)) for i in range(200)]
    ivs = [(r.choice("ab"), s, s + r.randrange(0, 80), i) for i, s in enumerate(r.randrange(0, 500) for _ in range(60))]
    return pts, ivs, spark.createDataFrame(pts, "ord long, chrom string, pos long"), spark.createDataFrame(ivs, "chrom string, start long, end long, iv long")


@pytest.mark.parametrize("width", [1, 7, 64, 1000])
def test_points_in_intervals(data, width):
    pts, ivs, p, i = data
    got = sorted((r["ord"], r["iv"]) for r in rj.points_in_intervals(p, i, "pos", width=width).collect())
    assert got == sorted((o, k) for o, c, x in pts for d, s, e, k in ivs if c == d and s <= x < e)


@pytest.mark.parametrize("width", [5, 100])
def test_contained(data, width):
    pts, ivs, p, i = data
    got = {r["ord"]: r["inside"] for r in rj.contained(p, i, "pos", width=width).collect()}
    assert got == {o: any(c == d and s <= x < e for d, s, e, _ in ivs) for o, c, x in pts}


def test_band(data, spark):
    pts, _, p, _ = data
    q = spark.createDataFrame([(c, x, o) for o, c, x in pts[:50]], "chrom string, at long, other long")
    got = sorted((r["ord"], r["other"]) for r in rj.band(p, q, "pos", "at", 9).collect())
    assert got == sorted((o, u) for o, c, x in pts for u, d, y in pts[:50] if c == d and abs(x - y) <= 9)


@pytest.mark.parametrize("horizon", [None, 3])
def test_first_containing(data, horizon):
    pts, ivs, p, i = data
    got = {r["ord"]: r["iv"] for r in rj.first_containing(p, i, "pos", ["start", "iv"], width=50, horizon=horizon).collect()}
    want = {}
    for o, c, x in pts:
        own = sorted((s, k, e) for d, s, e, k in ivs if d == c)
        before = [v for v in own if v[0] <= x]
        before = before[-horizon:] if horizon else before
        want[o] = next((k for s, k, e in before if x < e), None)
    assert got == want


def test_empty_sides(spark, data):
    _, _, p, i = data
    assert rj.points_in_intervals(p.limit(0), i, "pos").count() == 0
    assert rj.contained(p, i.limit(0), "pos").filter("inside").count() == 0
    assert rj.first_containing(p, i.limit(0), "pos", ["start"]).count() == p.count()
