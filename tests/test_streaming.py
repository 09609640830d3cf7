"""Refresh of the catalogue and of external labels, and continuous labelling."""

from __future__ import annotations

import pytest

from labelspark.operators.matchers import selector
from labelspark.streaming.attach import stream_attach
from labelspark.streaming.refresh import (
    AllSourcesFailed,
    announced_at,
    refresh_announced,
    refresh_external,
    stream_announced,
    tenant_readers,
)
from labelspark.sources.folders import shared_dir
from labelspark.streaming.versions import VersionedTable
from tests.helpers import SAMPLES, samples, sources

HOUR = 3_600_000


def row(source, value, t, label="prometheus"):
    return (source, {"__name__": "up", label: value}, t, 1.0)


def arrive(spark, path, rows):
    samples(spark, rows).coalesce(1).write.mode("append").parquet(path)


def told(df):
    return [r.labels_s for r in df.collect()]


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def failing():
    raise OSError("no answer")


def test_versions(spark, table):
    assert table.current() is None and table.last_version() is None
    for n in (3, 5):
        table.replace(spark.range(n))
    assert (table.last_version(), table.current().count(), table.at(0).count()) == (1, 5, 3)
    assert table.last_version(below=1) == 0
    table.write(spark.range(7), 1)
    assert (table.last_version(), table.current().count()) == (1, 7)


def test_a_failed_write_is_not_seen(spark, table):
    table.replace(spark.range(3))
    with pytest.raises(Exception, match="broken"):
        table.replace(spark.range(9).selectExpr("raise_error('broken') AS id"))
    assert (table.last_version(), table.current().count()) == (0, 3)


def test_shared_dir_follows_the_session(spark):
    class Session:
        class conf:
            get = staticmethod({"spark.checkpoint.dir": "hdfs:///shared/"}.get)

    assert shared_dir(Session).startswith("hdfs:///shared/")
    assert shared_dir(spark) != shared_dir(spark)


def test_failed_sources_are_skipped(spark, table):
    readers = {"tenant-a": lambda: samples(spark, [row("x", "prom-a", 1)]), "tenant-b": failing}
    failures = refresh_announced(readers, ["prometheus"], table, now_ms=10)
    assert [name for name, _ in failures] == ["tenant-b"] and "no answer" in failures[0][1]
    assert told(announced_at(table.current(), 10)) == ['{prometheus="prom-a"}']


def test_a_source_that_fails_while_read_is_skipped(spark, table):
    bad = samples(spark, [row("x", "prom-b", 1)]).selectExpr(
        "source", "if(ts_ms > 0, raise_error('lost'), labels) AS labels", "ts_ms", "value"
    )
    readers = {"tenant-a": lambda: samples(spark, [row("x", "prom-a", 1)]), "tenant-b": lambda: bad}
    assert [name for name, _ in refresh_announced(readers, ["prometheus"], table, 10)] == ["tenant-b"]
    assert told(announced_at(table.current(), 10, 0, "source")) == ['{prometheus="prom-a"}']


def test_the_former_sets_stay_if_all_fail(spark, table):
    refresh_announced({"tenant-a": lambda: samples(spark, [row("x", "prom-a", 1)])}, ["prometheus"], table, 10)
    with pytest.raises(AllSourcesFailed, match="tenant-a: no answer") as raised:
        refresh_announced({"tenant-a": failing}, ["prometheus"], table, 10)
    assert [name for name, _ in raised.value.failures] == ["tenant-a"]
    assert told(announced_at(table.current(), 10)) == ['{prometheus="prom-a"}']


def test_each_refresh_replaces_all(spark, table):
    for value in ("old", "new"):
        refresh_announced({"t": lambda v=value: samples(spark, [row("x", v, 1)])}, ["prometheus"], table, 10)
    assert told(announced_at(table.current(), 10)) == ['{prometheus="new"}']


def test_lookback(spark, table):
    rows = [row("x", "recent", 9 * HOUR), row("x", "edge", 4 * HOUR), row("x", "old", 4 * HOUR - 1), row("x", "next", 11 * HOUR)]
    refresh_announced({"t": lambda: samples(spark, rows)}, ["prometheus"], table, 10 * HOUR, 6 * HOUR)
    assert told(announced_at(table.current(), 10 * HOUR)) == ['{prometheus="edge"}', '{prometheus="recent"}']


def test_bad_requests(spark, table):
    reader = {"t": lambda: samples(spark, [row("x", "a", 1)])}
    with pytest.raises(ValueError):
        refresh_announced(reader, ["prometheus"], table, 10, -1000)
    with pytest.raises(ValueError):
        refresh_announced({}, ["prometheus"], table, 10)
    with pytest.raises(AllSourcesFailed):
        refresh_announced(reader, [""], table, 10)


def test_stream_of_announcements(spark, table, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def run():
        arriving = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(landing)
        stream_announced(arriving, ["prometheus", "zone"], table, checkpoint, once=True).awaitTermination()

    arrive(spark, landing, [row("a", "p1", HOUR), row("a", "p2", 5 * HOUR), row("b", "z1", 2 * HOUR, "zone")])
    run()
    arrive(spark, landing, [row("a", "p1", 6 * HOUR), row("b", "p1", 3 * HOUR)])
    arrive(spark, landing, [row("a", "p1", 2 * HOUR)])  # late
    run()
    seen = {(r.source, r.label, r.value): r.last_seen for r in table.current().collect()}
    assert seen == {
        ("a", "prometheus", "p1"): 6 * HOUR,
        ("a", "prometheus", "p2"): 5 * HOUR,
        ("b", "prometheus", "p1"): 3 * HOUR,
        ("b", "zone", "z1"): 2 * HOUR,
    }
    assert told(announced_at(table.current(), 7 * HOUR, 2 * HOUR)) == ['{prometheus="p1"}', '{prometheus="p2"}']
    assert told(announced_at(table.current(), 7 * HOUR)) == ['{prometheus="p1"}', '{prometheus="p2"}', '{zone="z1"}']
    before = table.last_version()
    run()
    assert table.last_version() == before
    landing, checkpoint = str(tmp_path / "more"), str(tmp_path / "other checkpoint")
    arrive(spark, landing, [row("a", "p9", 7 * HOUR)])
    run()
    assert table.last_version() == before + 1
    assert {r.value for r in table.current().collect()} == {"p1", "p2", "p9", "z1"}


def test_old_versions_are_removed(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "table"), keep=2)
    for n in range(1, 6):
        table.replace(spark.range(n))
    assert (table.last_version(), table.current().count(), table.at(3).count()) == (4, 5, 4)
    assert sorted(p.name for p in (tmp_path / "table" / "data").iterdir()) == ["v3", "v4"]


def test_a_label_also_seen_later_stays(spark, table):
    seen = spark.createDataFrame([("a", "l", "v", 11 * HOUR)], "source string, label string, value string, last_seen bigint")
    assert told(announced_at(seen, 10 * HOUR, HOUR)) == ['{l="v"}']


def test_a_hanging_source_is_given_up(spark, table):
    from time import sleep

    readers = {"a": lambda: samples(spark, [row("x", "p", 1)]), "b": lambda: sleep(20)}
    failures = refresh_announced(readers, ["prometheus"], table, 10, seconds=8)
    assert [name for name, _ in failures] == ["b"] and told(announced_at(table.current(), 10)) == ['{prometheus="p"}']


def test_a_source_has_its_limit_from_its_own_start(spark, table):
    from inspect import signature
    from threading import Event

    gate = Event()
    readers = {f"slow-{i}": lambda: gate.wait(60) for i in range(4)}
    readers |= {f"quick-{i}": lambda i=i: samples(spark, [row("x", f"p{i}", 1)]) for i in range(3)}
    try:
        failures = refresh_announced(readers, ["prometheus"], table, 10, seconds=8)
    finally:
        gate.set()
    assert [name for name, _ in failures] == [f"slow-{i}" for i in range(4)]
    assert told(announced_at(table.current(), 10)) == [f'{{prometheus="p{i}"}}' for i in range(3)]
    assert signature(refresh_announced).parameters["seconds"].default >= 60


def test_an_empty_first_load_is_refused(spark, table):
    with pytest.raises(ValueError):
        refresh_announced({"a": lambda: samples(spark, [])}, ["prometheus"], table, 10)
    with pytest.raises(ValueError):
        refresh_external(table, lambda: sources(spark, {"a": {}}))


def test_a_reader_per_tenant(spark):
    fields = spark.createDataFrame([("b|a",), ("a| c",)], "tenant_field string")
    readers = tenant_readers(fields, lambda tenant: tenant.upper())
    assert {t: read() for t, read in readers.items()} == {"a": "A", "b": "B", "c": "C"}


def test_external_labels_are_refreshed_or_kept(spark, table):
    with pytest.raises(OSError):
        refresh_external(table, failing)
    assert refresh_external(table, lambda: sources(spark, {"a": {"region": "eu"}})) is None
    assert "no answer" in refresh_external(table, failing)
    assert table.current().first().external_labels == {"region": "eu"}
    assert refresh_external(table, lambda: sources(spark, {"a": {"region": "us"}})) is None
    assert table.current().first().external_labels == {"region": "us"}


def test_labels_on_arriving_samples(spark, table, tmp_path):
    landing, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "checkpoint"))
    regions = iter(["eu", None, "us"])

    def read():
        region = next(regions)
        return sources(spark, {"a": {"region": region}, "b": {"region": "asia"}}) if region else failing()

    def run():
        arriving = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(landing)
        stream_attach(
            arriving, table, selector(("region", "!=", "asia"), ("__name__", "=", "up")), out, checkpoint,
            read_sources=read, dropped=["zone"], once=True,
        ).awaitTermination()

    for t in (1, 2, 3):
        arrive(spark, landing, [row("a", "z", t, "zone"), row("b", "z", t, "zone")])
        run()
    checkpoint, regions = str(tmp_path / "another"), iter(["us", "us", "us"])
    landing = str(tmp_path / "later")
    arrive(spark, landing, [row("a", "z", 4, "zone")])
    run()
    got = {r.ts_ms: (r.source, r.labels) for r in spark.read.parquet(out).collect()}
    assert got == {
        t: ("a", {"__name__": "up", "region": region}) for t, region in ((1, "eu"), (2, "eu"), (3, "us"), (4, "us"))
    }
