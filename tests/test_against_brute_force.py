"""Time-grid operators against plain loops over random samples."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from labelspark.operators import align, series
from tests.helpers import identified

KEYS = align.KEYS


def random_series(seed, names="abc", span=5000, n=60):
    rng = random.Random(seed)
    made = {}
    for name in names:
        times = sorted(rng.sample(range(-600, span), n))
        value, points = 0, []
        for t in times:
            value = 0 if rng.random() < 0.15 else value + rng.randint(0, 9)
            points.append((t, float(value)))
        made[name] = points
    return made


def frame(spark, made):
    rows = [("s", {"n": name}, t, v) for name, points in made.items() for t, v in points]
    random.Random(1).shuffle(rows)
    return identified(spark, rows).repartition(4)


def answers(df):
    got = {(r.labels_c[0].value, r.ts_ms): r.value for r in df.collect()}
    assert len(got) == df.count()
    return got


GRIDS = [
    (0, 4000, 100, 300),
    (0, 4000, 300, 100),
    (0, 4000, 100, 100),
    (7, 3999, 130, 1000),
    (-500, 6000, 17, 5),
    (1000, 1000, 50, 400),
    (0, 4000, 1000, 2500),
]


@pytest.mark.parametrize("grid", GRIDS)
def test_range_select(spark, grid):
    start, end, step, lookback = grid
    made = random_series(sum(grid))
    wanted = {}
    for name, points in made.items():
        for t in range(start, end + 1, step):
            seen = [p for p in points if t - lookback < p[0] <= t]
            if seen:
                wanted[name, t] = seen[-1][1]
    assert answers(align.range_select(frame(spark, made), *grid)) == wanted


@pytest.mark.parametrize("at", [0, 777, 4999])
def test_instant_select(spark, at):
    made = random_series(at)
    wanted = {}
    for name, points in made.items():
        seen = [p for p in points if at - 150 < p[0] <= at]
        if seen:
            wanted[name, at] = seen[-1][1]
    assert answers(align.instant_select(frame(spark, made), at, 150)) == wanted


def rise(before, after):
    return after - before if after >= before else after


@pytest.mark.parametrize("grid", GRIDS)
@pytest.mark.parametrize("most", [3_600_000, 40])
def test_counters(spark, grid, most, monkeypatch):
    monkeypatch.setattr(align, "MAX_BLOCK_MS", most)
    start, end, step, window = grid
    made = random_series(sum(grid) + 1)
    rates, last = {}, {}
    for name, points in made.items():
        for t in range(start, end + 1, step):
            seen = [p for p in points if t - window < p[0] <= t]
            if len(seen) < 2:
                continue
            gain = sum(rise(a[1], b[1]) for a, b in zip(seen, seen[1:]))
            rates[name, t] = pytest.approx(gain / ((seen[-1][0] - seen[0][0]) / 1000))
            a, b = seen[-2:]
            last[name, t] = pytest.approx(rise(a[1], b[1]) / ((b[0] - a[0]) / 1000))
    df = frame(spark, made)
    assert answers(align.counter_rate(df, *grid)) == rates
    assert answers(align.counter_irate(df, *grid)) == last


@pytest.mark.parametrize(
    "step,window,most", [(100, 300, 3_600_000), (7, 5, 3), (5, 7, 2), (60, 300, 7), (97, 250, 10), (97, 250, 1000)]
)
def test_windows_are_made_of_whole_blocks(spark, monkeypatch, step, window, most):
    monkeypatch.setattr(align, "MAX_BLOCK_MS", most)
    start, points = 1000, 6
    blocks = align.Blocks(start, step, window)
    times = spark.range(start - window - step, start + points * step).withColumn("k", blocks.number(F.col("id")))
    by_time = {r.id: r.k for r in times.collect()}
    for i in range(points):
        at = start + i * step
        inside = {by_time[t] for t in range(at - window + 1, at + 1)}
        assert max(inside) == i * blocks.per_step and min(inside) > i * blocks.per_step - blocks.per_window
        assert by_time[at - window] <= i * blocks.per_step - blocks.per_window
        assert by_time.get(at + 1, i * blocks.per_step + 1) > i * blocks.per_step
    held = {}
    for t, k in by_time.items():
        held.setdefault(k, []).append(t)
    assert max(len(ts) for ts in held.values()) <= most


def test_readings_of_one_time_and_readings_that_are_no_numbers(spark):
    rows = [("s", {"n": "a"}, t, v, s) for t, v, s in ((1000, 1.0, 0), (2000, 100.0, 0), (2000, 5.0, 1), (3000, 7.0, 0))]
    ties = identified(spark, [r[:4] for r in rows]).withColumn("seq", F.when(F.col("value") == 5, 1).otherwise(0))
    assert answers(align.counter_rate(ties, 3000, 3000, 1000, 5000, tiebreak="seq")) == {("a", 3000): 3.0}
    assert answers(align.counter_irate(ties, 3000, 3000, 1000, 5000, tiebreak="seq")) == {("a", 3000): 2.0}
    for odd in (float("nan"), float("inf")):
        points = [("s", {"n": "a"}, t * 1000, odd if t == 5 else float(t)) for t in range(1, 41)]
        got = answers(align.counter_rate(identified(spark, points), 10_000, 40_000, 5000, 5000))
        assert {t: v for (_, t), v in got.items()} == {t: 1.0 for t in range(10_000, 40_001, 5000)}
        held = answers(align.counter_rate(identified(spark, points), 6000, 6000, 5000, 5000))["a", 6000]
        assert held != held or held == float("inf")


def test_one_hot_series(spark):
    """A series with nearly all samples gives the same answers and chunks as its neighbours' rules say."""
    hot = [("s", {"n": "hot"}, t * 7, t % 100) for t in range(60_000)]
    cold = [("s", {"n": f"c{i}"}, i * 1000, i) for i in range(50)]
    df = identified(spark, hot + cold).repartition(8)
    got = answers(align.range_select(df, 0, 420_000, 1000, 3000))
    assert got["hot", 420_000] == float(59_999 % 100)
    for t in (0, 1000, 77_000, 419_000):
        assert got["hot", t] == float(t // 7 % 100)
    chunks = series.chunk_raw(df, block_ms=10_000)
    sizes = chunks.filter("labels_c[0].value = 'hot'").select(F.size("samples").alias("n")).groupBy("n").count()
    assert {r.n: r["count"] for r in sizes.collect()} == {120: 500}


def test_tiebreak(spark):
    df = identified(spark, [("s", {"n": "a"}, 1000, v) for v in (5, 9, 7)]).withColumn("seq", F.col("value") * -1)
    assert answers(align.instant_select(df, 1000, 10, tiebreak="seq")) == {("a", 1000): 5.0}
    assert answers(align.range_select(df, 1000, 2000, 500, 600, tiebreak="seq")) == {("a", 1000): 5.0, ("a", 1500): 5.0}


def test_answers_are_copied_to_the_grid_last(spark):
    df = identified(spark, [("a", {"x": "1"}, 1000 * i, i) for i in range(10)])
    shown = align.counter_rate(df, 0, 9000, 1000, 5000)._jdf.queryExecution().optimizedPlan().toString()
    above, found, below = shown.partition("Generate explode(sequence")
    assert found and not any(word in above for word in ("Aggregate", "Window", "Sort", "Repartition"))
    assert "Window" in below and "Aggregate" not in below


def test_rates_by_series_with_gaps_and_windows_within_a_step(spark):
    """A window shorter than the step, series that pause for several steps, and blocks that no window holds."""
    points = [(t, float(t % 7)) for t in (1, 40, 41, 95, 96, 97, 100, 101, 399, 400, 401, 760, 795, 799, 800)]
    df = identified(spark, [(s, {}, t, v) for s in "ab" for t, v in points if s == "a" or t > 90])
    for window in (10, 60, 100, 130, 450):
        got = {(r.source, r.ts_ms): r.value for r in align.counter_rate(df, 0, 1000, 100, window).collect()}
        want = {}
        for s in "ab":
            for at in range(0, 1001, 100):
                inside = [(t, v) for t, v in points if at - window < t <= at and (s == "a" or t > 90)]
                if len(inside) > 1:
                    gain = sum(v - w if v >= w else v for (_, w), (_, v) in zip(inside, inside[1:]))
                    want[s, at] = gain / ((inside[-1][0] - inside[0][0]) / 1000)
        assert got == pytest.approx(want)
