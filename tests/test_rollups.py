"""Requests from stored hours against the same from samples."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest

from labelspark import Federation
from labelspark.operators import align, rollup
from labelspark.operators.matchers import selector
from labelspark.sources import config, store
from tests.helpers import identified, samples
from tests.test_store import plan

HOUR = 3_600_000
T0 = 19_800 * 24 * HOUR


def counters(seed, n=260):
    """Two series with restarts, equal and missing hours, samples on the hour, and numbers that are none."""
    rng = random.Random(seed)
    rows = []
    for name in ("a", "b"):
        value = 0.0
        for t in sorted({rng.choice([rng.randrange(40) * HOUR, rng.randrange(40 * HOUR)]) for _ in range(n // 2)}):
            value = rng.choice([value + rng.randrange(9), value, 1.0, 0.0])
            odd = rng.random()
            rows.append(("s", {"n": name}, T0 + t, float("nan") if odd < 0.01 else float("inf") if odd < 0.02 else value))
    return rows


def answers(df):
    return {(str(r["labels_c"]), r["ts_ms"]): r["value"] if r["value"] != r["value"] else round(r["value"], 9) for r in df.collect()}


def same(a, b):
    return a.keys() == b.keys() and all(a[k] == b[k] or a[k] != a[k] and b[k] != b[k] for k in a)


GRIDS = [(0, 40 * HOUR, HOUR, 3 * HOUR), (0, 40 * HOUR, 2 * HOUR, 2 * HOUR), (777, 39 * HOUR, 5 * HOUR + 13, 7 * HOUR), (HOUR // 2, 30 * HOUR, HOUR, HOUR), (3 * HOUR, 3 * HOUR, HOUR, 2 * HOUR + 1)]


@pytest.mark.parametrize("grid", GRIDS)
def test_hours_answer_as_samples_do(spark, grid):
    held = identified(spark, counters(sum(grid)))
    hours = rollup.hourly(held)
    start, end, step, window = T0 + grid[0], T0 + grid[1], grid[2], grid[3]
    found = answers(rollup.counter_rate(hours, held, start, end, step, window))
    assert same(found, answers(align.counter_rate(held, start, end, step, window))) and (found or grid is GRIDS[4])
    found = answers(rollup.range_select(hours, held, start, end, step, window))
    assert same(found, answers(align.range_select(held, start, end, step, window))) and found


def test_merging_is_associative(spark):
    held = identified(spark, [r for r in counters(5) if r[3] == r[3] and abs(r[3]) < 1e9])
    keys = ["source", "labels_c"]
    hours = rollup.hourly(held)
    by_four = rollup.merged(hours.selectExpr(*keys, "hour div 4 AS k", *rollup.SUMMARY), keys)
    twice = rollup.merged(by_four.selectExpr(*keys, "k div 3 AS k", *rollup.SUMMARY), keys)
    once = rollup.merged(hours.selectExpr(*keys, "hour div 12 AS k", *rollup.SUMMARY), keys)
    rows = [sorted(str(r) for r in df.select(*keys, "k", *rollup.SUMMARY).collect()) for df in (twice, once)]
    assert rows[0] == rows[1] and rows[0]


def test_a_sample_on_the_hour_belongs_to_the_hour_before(spark):
    held = identified(spark, [("s", {"n": "a"}, t, 1.0) for t in (0, 1, HOUR, HOUR + 1, -1, -HOUR)])
    assert sorted((r.hour, r.first_ts, r.last_ts) for r in rollup.hourly(held).collect()) == [
        (-2, -HOUR, -HOUR), (-1, -1, 0), (0, 1, HOUR), (1, HOUR + 1, HOUR + 1),
    ]


def test_stored_hours_replace_days_and_leave_samples_unread(spark, tmp_path):
    rows = counters(9)
    store.write_samples(samples(spark, rows), f"{tmp_path}/samples")
    held = store.read_samples(spark, f"{tmp_path}/samples")
    store.write_series(held, f"{tmp_path}/series")
    store.write_rollups(held, f"{tmp_path}/hours", T0 - HOUR, T0 + 40 * HOUR)
    fed = Federation(held, config.literal_sources(spark, {"s": {}}), series=store.read_series(spark, f"{tmp_path}/series"))
    by_hours = replace(fed, rollups=store.read_rollups(spark, f"{tmp_path}/hours"))
    chosen = selector(("n", "=~", "a|b"))

    def told(f, *grid):
        return sorted(str((r.labels, r.ts_ms, r.value)) for r in f.rate(chosen, *grid).collect()), sorted(
            str((r.labels, r.ts_ms, r.value)) for r in f.query_range(chosen, *grid[:3], 5 * HOUR).collect()
        )

    for grid in ((T0 // 1000, T0 // 1000 + 40 * 3600, 7200, 4 * HOUR), (T0 // 1000 + 99, T0 // 1000 + 30 * 3600, 5000, 4 * HOUR), (T0 // 1000, T0 // 1000 + 7200, 600, HOUR)):
        assert told(fed, *grid) == told(by_hours, *grid)
    grid = (T0 // 1000, T0 // 1000 + 40 * 3600, 7200)
    for df in (by_hours.rate(chosen, *grid, 4 * HOUR), by_hours.query_range(chosen, *grid, 5 * HOUR)):
        assert f"{tmp_path}/samples" not in plan(df) and f"{tmp_path}/hours" in plan(df)
    # Late samples: the day is summed up anew, the others stay.
    late = samples(spark, [("s", {"n": "a"}, T0 + 5, 3.0)])
    store.write_samples(late, f"{tmp_path}/samples")
    held = store.read_samples(spark, f"{tmp_path}/samples")
    before = by_hours.rollups.count()
    store.write_rollups(held, f"{tmp_path}/hours", T0, T0)
    hours = store.read_rollups(spark, f"{tmp_path}/hours")
    assert hours.count() in (before, before + 1) and hours.count() == rollup.hourly(held, ("source", *store.SERIES_ID)).count()
    with pytest.raises(ValueError):
        Federation(held, fed.sources, rollups=hours)
