"""Interval labels by sweep against a direct search: nesting, touching ends,
ties, long chains of levels, a recording with most rows, NULLs."""

import random

import pytest
from pyspark.sql import functions as F

from cadence.operators import ordinal
from cadence.operators.labels import flatten_intervals, interval_label

LINES = "recording_id string, line_no long, beg double, end double, code int"
POINTS = "recording_id string, event_id long, t double"


def direct(points, lines):
    out = []
    for k, e, t in points:
        hits = [(n, c) for kk, n, b, d, c in lines if None not in (kk, n, b, d, c) and t is not None and kk == k and b <= t <= d]
        out.append((k, e, t, max(hits)[1] if hits else 0))
    return sorted(out, key=str)


def run(spark, points, lines, **how):
    got = interval_label(spark.createDataFrame(points, POINTS), spark.createDataFrame(lines, LINES), **how)
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("seed, longest", [(1, 3), (2, 40), (3, 2000)])
def test_sweep_equals_direct_search(spark, seed, longest):
    """Whole-number times make begins, ends and points meet; long lines nest
    hundreds deep, which takes several bands of tree levels."""
    rng = random.Random(seed)
    lines, points = [], []
    for n in range(700):
        k = "hot" if rng.random() < 0.9 else f"r{rng.randrange(3)}"
        b = rng.randrange(1500)
        lines.append((k, rng.randrange(500), float(b), float(b + rng.randrange(longest)), rng.randrange(1, 9)))
    for e in range(900):
        points.append(("hot" if rng.random() < 0.9 else f"r{rng.randrange(4)}", e, rng.randrange(-10, 4000) / 2.0))
    want = direct(points, lines)
    assert run(spark, points, lines) == want
    assert run(spark, points, lines, bucket_s=37.0) == want


def test_hot_recording_is_swept_in_ranges(spark, monkeypatch):
    """With a small row target the recording is split and maxima are carried
    over ranges that hold points only (one line covers 90 % of the points)."""
    monkeypatch.setattr(ordinal, "ROWS_PER_BUCKET", 50)
    lines = [("a", 1, 0.0, 900.0, 7), ("a", 2, 950.0, 960.0, 8)]
    points = [("a", e, float(e)) for e in range(1000)]
    assert run(spark, points, lines) == direct(points, lines)


def test_missing_values_and_repeats(spark):
    lines = [("a", 1, 0.0, 10.0, 6), (None, 2, 0.0, 10.0, 8), ("a", None, 0.0, 10.0, 8), ("a", 3, None, 10.0, 8), ("a", 4, 9.0, 1.0, 8), ("a", 5, 2.0, 3.0, None)]
    points = [("a", 1, 2.5), ("a", 1, 2.5), (None, 2, 5.0), ("a", 3, None), ("b", 4, 5.0), ("a", 5, 10.0), ("a", 6, 10.5)]
    for how in ({}, {"bucket_s": 4.0}):
        assert run(spark, points, lines, **how) == direct(points, lines)
    nan = run(spark, [("a", 1, float("nan"))], lines)
    assert [r[3] for r in nan] == [0]
    assert run(spark, [], lines) == [] and [r[3] for r in run(spark, points, [])] == [0] * len(points)


def test_pieces_are_disjoint_and_few(spark):
    """As many pieces as begins and ends, whatever the overlap."""
    lines = [("a", n, float(n), 5000.0 - n, 1 + n % 8) for n in range(300)]
    pieces = flatten_intervals(spark.createDataFrame(lines, LINES)).orderBy("_r").collect()
    assert [p["_r"] for p in pieces] == list(range(600))
    assert [p["win"]["line_no"] for p in pieces[:300]] == list(range(300))
    assert pieces[-1]["win"] is None


def test_no_aggregate_follows_the_sweep(spark):
    points = spark.createDataFrame([("a", 1, 2.0)], POINTS)
    lines = spark.createDataFrame([("a", 1, 0.0, 3.0, 6)], LINES)
    plan = interval_label(points, lines).select(F.col("code"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("Union")[0]
