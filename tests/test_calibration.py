"""Isotonic calibration and cut-offs against plain definitions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import calibration as C


def plain_isotonic(points):
    """(x, n, ok) ascending to x -> share, by the greatest of the least means."""
    out = {}
    for i, (x, *_) in enumerate(points):
        best = 0.0
        for a in range(i + 1):
            least = min(sum(p[2] for p in points[a : b + 1]) / sum(p[1] for p in points[a : b + 1]) for b in range(i, len(points)))
            best = max(best, least)
        out[x] = best
    return out


def plain_bound(ok, n, z=1.959964):
    p = ok / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def reviews(seed, groups=("a", "b", None), steps=40, rows=900):
    rng = random.Random(seed)
    made = []
    for i in range(rows):
        x = rng.randrange(steps) / steps
        made.append((rng.choice(groups), x, rng.random() < x * x))
    return made


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_blocks_equal_the_definition(spark, seed):
    rows = reviews(seed)
    odd = [("a", None, True), ("a", float("nan"), True), ("b", 0.5, None), ("only", None, True)]
    df = spark.createDataFrame(rows + odd, "g string, confidence double, is_correct boolean")
    blocks = C.calibration(df.repartition(7), ["g"]).collect()
    for g in ("a", "b", None):
        counts = {}
        for _, x, ok in (r for r in rows if r[0] == g):
            n, k = counts.get(x, (0, 0))
            counts[x] = (n + 1, k + ok)
        expected = plain_isotonic([(x, *counts[x]) for x in sorted(counts)])
        mine = sorted((b for b in blocks if b.g == g), key=lambda b: b.low)
        assert all(p.high < q.low and p.calibrated < q.calibrated for p, q in zip(mine, mine[1:]))
        assert sum(b.reviewed for b in mine) == sum(n for n, _ in counts.values())
        for x, share in expected.items():
            assert [b.calibrated for b in mine if b.low <= x <= b.high] == [pytest.approx(share, abs=1e-12)]
    assert {b.g for b in blocks} == {"a", "b", None}


def test_ranges_pool_to_the_same_blocks(spark):
    rows = [(x / 500, (x * 7919) % 500 < x) for x in range(500) for _ in range(3)]
    df = spark.createDataFrame(rows, "confidence double, is_correct boolean")
    found = [tuple(r) for r in C.calibration(df).orderBy("low").collect()]
    counts = {}
    for x, ok in rows:
        n, k = counts.get(x, (0, 0))
        counts[x] = (n + 1, k + ok)
    xs = sorted(counts)
    whole = C.pooled(xs, xs, [counts[x][0] for x in xs], [counts[x][1] for x in xs])
    assert found == [(*b, b[3] / b[2]) for b in whole] and len(found) > 3


def test_threshold_is_the_lowest_that_holds(spark):
    rows = [(x, ok) for _, x, ok in reviews(9, rows=3000)]
    blocks = C.calibration(spark.createDataFrame(rows, "confidence double, is_correct boolean"))
    lows = sorted(b.low for b in blocks.collect())
    targets = (0.0, 0.5, 0.7, 0.85, 0.9999)
    got = {r.target: r for r in C.calibrated_threshold(blocks, targets).collect()}
    for target in targets:
        fit = []
        for low in lows:
            tail = [ok for x, ok in rows if x >= low]
            if plain_bound(sum(tail), len(tail)) >= target:
                fit.append((low, len(tail), sum(tail)))
        r = got[target]
        assert (r.threshold, r.automated, r.correct) == (min(fit) if fit else (None, None, None))
    assert got[0.0].threshold == lows[0] and got[0.9999].threshold is None


def test_few_reviews_do_not_open_the_gate(spark):
    df = spark.createDataFrame([(0.9, True)] * 3, "confidence double, is_correct boolean")
    assert C.calibrated_threshold(C.calibration(df), [0.95]).first().threshold is None
    many = spark.createDataFrame([(0.9, True)] * 100, "confidence double, is_correct boolean")
    assert C.calibrated_threshold(C.calibration(many), [0.95]).first().threshold == 0.9


def test_rows_get_their_block(spark):
    df = spark.createDataFrame([("a", 0.2, False), ("a", 0.4, True), ("a", 0.4, False), ("a", 0.8, True), (None, 0.5, True)], "g string, confidence double, is_correct boolean")
    rows = [("a", 0.1), ("a", 0.2), ("a", 0.5), ("a", 1.0), ("a", None), ("a", float("nan")), (None, 0.0), ("new", 0.9)]
    frame = spark.createDataFrame(rows, "g string, confidence double")
    got = [r.calibrated for r in C.calibrated(frame.coalesce(1), C.calibration(df, ["g"]), ["g"]).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [0.0, 0.0, 0.5, 1.0, None, None, 1.0, None]))
    alone = C.calibrated(frame, C.calibration(df)).filter("confidence = 0.5").first().calibrated
    assert alone == 1.0  # blocks of all groups: 0.2, 0.4, 0.5 to 0.8


def test_no_reviews(spark):
    empty = spark.createDataFrame([], "confidence double, is_correct boolean")
    blocks = C.calibration(empty)
    assert blocks.count() == 0
    frame = spark.createDataFrame([(0.5,)], "confidence double")
    assert C.calibrated(frame, blocks).first().calibrated is None
    assert [tuple(r) for r in C.calibrated_threshold(blocks, [0.5]).collect()] in ([], [(0.5, None, None, None, None)])
