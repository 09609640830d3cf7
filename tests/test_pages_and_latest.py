"""Pages of series by a cursor, and the latest samples as a kept table."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from labelspark import Federation
from labelspark.operators.matchers import selector
from labelspark.sources import config, store
from labelspark.streaming.latest import last_samples, latest_log, latest_samples, stream_latest
from tests.helpers import SAMPLES, samples
from tests.test_store import plan

DAY = 86_400_000
T0 = 19_800 * DAY
OWNERS = {"a": {"region": "eu"}, "b": {"region": "eu"}, "c": {}}
UP = selector(("__name__", "=", "up"))


def rows(n, seed=1):
    rng = random.Random(seed)
    return [
        (rng.choice("abc"), {"__name__": "up", "job": f"j{rng.randrange(5)}", "replica": rng.choice("xy")}, T0 + rng.randrange(DAY), rng.randrange(99))
        for _ in range(n)
    ]


def made(spark, place, given):
    store.write_samples(samples(spark, given), f"{place}/samples")
    held = store.read_samples(spark, f"{place}/samples")
    store.write_series(held, f"{place}/series")
    return Federation(held, config.literal_sources(spark, OWNERS), ("replica",), series=store.read_series(spark, f"{place}/series"))


def shown(r):
    return r.source, sorted(r.labels.items()), r.chunks


def test_pages_follow_one_another(spark, tmp_path):
    stored = made(spark, tmp_path, rows(120))
    for fed in (stored, replace(stored, series=None)):
        want = [shown(r) for r in fed.select_series(UP, T0, T0 + DAY, step_ms=3_600_000).collect()]
        got, after = [], None
        while True:
            page = fed.series_page(UP, T0, T0 + DAY, 11, after, step_ms=3_600_000).collect()
            if not page:
                break
            assert len(page) <= 11 and [p.cursor for p in page] == sorted(p.cursor for p in page)
            got += [shown(r) for r in page]
            after = page[-1].cursor
        assert sorted(map(str, got)) == sorted(map(str, want)) and [g[:2] for g in got] == [w[:2] for w in want]
        assert len({str(g[:2]) for g in got}) < len(got)  # equal final labels, of which none is lost or told twice
    page = stored.series_page(UP, T0, T0 + DAY, 3)
    shape = plan(page)
    assert "TakeOrderedAndProject" in shape
    with pytest.raises(ValueError):
        stored.series_page(UP, T0, T0 + DAY, 0)
    with pytest.raises(ValueError):
        stored.series_page(UP, T0 + DAY, T0, 5)


def test_cursors_hold_odd_labels(spark):
    given = [("c", {"__name__": "up", "odd": v}, T0 + 1, 1.0) for v in ("", "'", '"', "\\", "ü\n", "$x", "a")]
    fed = Federation(samples(spark, given), config.literal_sources(spark, OWNERS))
    got, after = [], None
    for _ in range(7):
        (row,) = fed.series_page(UP, T0, T0 + DAY, 1, after).collect()
        got.append(row.labels.get("odd", ""))
        after = row.cursor
    assert got == sorted(got) and len(set(got)) == 7
    assert fed.series_page(UP, T0, T0 + DAY, 1, after).collect() == []


def instant(fed, at, lookback=DAY):
    return sorted((r.source, str(sorted(r.labels.items())), r.ts_ms, r.value) for r in fed.query(UP, at, lookback).collect())


def test_instant_queries_from_the_latest_samples(spark, tmp_path):
    given = rows(90, seed=2)
    fed = made(spark, tmp_path, given)
    landing = str(tmp_path / "in")
    table = latest_log(spark, str(tmp_path / "latest"), fan=2)
    for part in (given[:40], given[40:60], given[60:]):  # in no order of time
        samples(spark, part).coalesce(1).write.mode("append").parquet(landing)

    def run():
        arriving = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(landing)
        stream_latest(arriving, table, str(tmp_path / "checkpoint"), once=True).awaitTermination()

    run()
    quick = replace(fed, latest=latest_samples(table))
    newest = max(t for _, _, t, _ in given) // 1000 + 1
    for at in (newest, newest + 3600, T0 // 1000 + 43_200, T0 // 1000):
        assert instant(quick, at) == instant(fed, at)
        assert instant(quick, at, 3_600_000) == instant(fed, at, 3_600_000)
    assert f"{tmp_path}/samples" not in plan(quick.query(UP, newest)) and f"{tmp_path}/samples" in plan(quick.query(UP, T0 // 1000 + 43_200))
    before = table.last_version()
    run()
    assert table.last_version() == before
    with pytest.raises(ValueError):
        replace(quick, series=None)


def test_ties_of_the_latest_sample(spark):
    labels = F.create_map(F.lit("__name__"), F.lit("up"))
    df = spark.createDataFrame([("a", 5, 1.0, 9), ("a", 5, 7.0, 3), ("a", None, 2.0, 99), ("a", 4, 8.0, 50)], "source string, ts_ms bigint, value double, event bigint")
    df = df.withColumn("labels", labels)
    assert last_samples(df, "event").first().latest.value == 1.0
    assert last_samples(df).first().latest.value == 7.0
