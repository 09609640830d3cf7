"""Logs of parts, batches that run again, labels that expire, and sources whose jobs are cancelled."""

from __future__ import annotations

import random
from pathlib import Path
from time import monotonic

import pytest
from pyspark.sql import functions as F

from labelspark.operators.matchers import selector
from labelspark.sources import folders
from labelspark.streaming.attach import attached, stream_attach
from labelspark.streaming.expiry import STATE_STORE, living, living_log, stream_living
from labelspark.streaming.refresh import announced_at, announced_log, refresh_announced, stream_announced
from labelspark.streaming.versions import LogTable, VersionedTable
from tests.helpers import SAMPLES, samples, sources
from tests.test_streaming import HOUR, arrive, row, told

SEEN = "source string, label string, value string, last_seen bigint"


def seen_rows(df):
    return {(r.source, r.label, r.value): r.last_seen for r in df.collect()}


def size(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*.parquet"))


@pytest.mark.parametrize("fan", [2, 3])
def test_a_log_equals_its_rows(spark, tmp_path, fan):
    rng = random.Random(fan)
    table, want = announced_log(spark, str(tmp_path), fan=fan, keep=2), {}
    assert table.current() is None and table.last_version() is None
    for batch in range(9):
        rows = [("s", "l", f"v{rng.randrange(6)}", rng.randrange(100)) for _ in range(5)]
        table.append(spark.createDataFrame(rows, SEEN), "run", batch)
        for *key, at in rows:
            want[tuple(key)] = max(at, want.get(tuple(key), at))
        assert seen_rows(table.current()) == want
    levels = [level for _, level in table.state().parts]
    assert all(levels.count(n) < fan for n in set(levels)) and max(levels) >= 1
    named = {folder for folder, _ in table.state().parts}
    old = {folder for folder, _ in table.state(table.last_version() - 1).parts}
    there = {str(p.relative_to(tmp_path)) for p in tmp_path.glob("run=*/batch=*/try=*")}
    assert there == named | old and len(list((tmp_path / "_manifests").glob("version=*"))) == 2
    table.compact()
    assert len(table.state().parts) == 1 and seen_rows(table.current()) == want
    assert table.compact().version == table.last_version()


def test_a_batch_counts_once(spark, tmp_path):
    table = LogTable(spark, str(tmp_path))
    table.append(spark.range(3), "a", 0)
    before = table.state()
    assert table.append(spark.range(9).selectExpr("raise_error('not looked at') AS id"), "a", 0) == before == table.state()
    with pytest.raises(Exception, match="broken"):
        table.append(spark.range(9).selectExpr("cast(raise_error('broken') AS bigint) AS id"), "a", 1)
    assert table.state() == before and table.current().count() == 3
    table.append(spark.range(4), "a", 1)
    table.append(spark.range(5), "b", 0)
    table.append(spark.range(6))
    assert table.has("a", 1) and not table.has("a", 2) and table.current().count() == 18


def test_a_batch_writes_what_it_holds(spark, tmp_path):
    table = announced_log(spark, str(tmp_path), fan=100)
    table.append(spark.range(200_000).selectExpr("'s' AS source", "'l' AS label", "uuid() AS value", "id AS last_seen"))
    large = size(tmp_path)
    table.append(spark.createDataFrame([("s", "l", "v", 1)], SEEN))
    assert size(tmp_path) - large < large / 50 and table.current().count() == 200_001


def test_a_committed_version_is_never_touched(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    seen = spark.createDataFrame([("s", "l", "v", 1)], SEEN)
    broken = seen.withColumn("last_seen", F.raise_error(F.lit("broken")).cast("bigint"))
    table.absorb(seen, ["source", "label", "value"], "run", 0)
    table.absorb(broken, ["source", "label", "value"], "run", 0)
    assert table.last_version() == 0 and table.current().count() == 1
    with pytest.raises(Exception, match="broken"):
        table.write(broken, 0)
    assert table.current().count() == 1
    held = table.current()
    table.write(seen.unionByName(seen), 0)
    assert table.current().count() == 2 and held.count() == 1


@pytest.mark.parametrize("kind", ["log", "versions"])
def test_a_stream_batch_that_runs_again(spark, tmp_path, kind):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    table = announced_log(spark, str(tmp_path / "t")) if kind == "log" else VersionedTable(spark, str(tmp_path / "t"))

    def run(broken=False):
        arriving = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(landing)
        if broken:
            arriving = arriving.withColumn("ts_ms", F.raise_error(F.lit("gone")).cast("bigint"))
        stream_announced(arriving, ["prometheus"], table, checkpoint, once=True).awaitTermination()

    arrive(spark, landing, [row("a", "p1", HOUR)])
    arrive(spark, landing, [row("a", "p2", 2 * HOUR)])
    run()
    folders.remove(spark, f"{checkpoint}/commits/1")
    before = table.last_version()
    run(broken=True)
    assert table.last_version() == before and told(announced_at(table.current(), 9 * HOUR)) == ['{prometheus="p1"}', '{prometheus="p2"}']
    arrive(spark, landing, [row("a", "p3", 3 * HOUR)])
    run()
    assert seen_rows(table.current().select(*SEEN.replace(" string", "").replace(" bigint", "").split(", "))) == {
        ("a", "prometheus", f"p{i}"): i * HOUR for i in (1, 2, 3)
    }


def test_labelled_batches_appear_whole_and_once(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "checkpoint"))
    owners = VersionedTable(spark, str(tmp_path / "sources"))
    owners.replace(sources(spark, {"a": {"region": "eu"}}))

    def run(broken=None):
        arriving = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(landing)
        if broken is not None:
            bad = F.raise_error(F.lit("gone")).cast("double")
            arriving = arriving.withColumn("value", F.when(F.col("ts_ms") == broken, bad).otherwise(F.col("value")))
        stream_attach(arriving, owners, selector(("__name__", "=", "up")), out, checkpoint, once=True).awaitTermination()

    day = 24 * HOUR
    for t in (1, day + 1, day + 2):
        arrive(spark, landing, [row("a", "p", t), row("a", "q", t)])
    with pytest.raises(Exception, match="gone"):
        run(broken=day + 1)
    table = attached(spark, out)
    assert sorted(r.ts_ms for r in table.current().collect()) == [1, 1]
    run()
    folders.remove(spark, f"{checkpoint}/commits/2")
    run(broken=day + 2)
    want = [1, 1, day + 1, day + 1, day + 2, day + 2]
    assert sorted(r.ts_ms for r in table.current().collect()) == want
    table.compact()
    assert sorted(r.ts_ms for r in table.current().collect()) == want
    folder = table.state().parts[0][0]
    assert sorted(p.name for p in Path(out, folder).glob("day=*")) == ["day=1970-01-01", "day=1970-01-02"]
    assert {tuple(sorted(r.labels.items())) for r in table.current().collect()} == {
        (("__name__", "up"), ("prometheus", v), ("region", "eu")) for v in "pq"
    }


def test_labels_leave_when_their_lookback_ends(spark, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    table = living_log(spark, str(tmp_path / "t"))
    name = "spark.sql.streaming.stateStore.providerClass"
    kept = spark.conf.get(name)
    spark.conf.set(name, STATE_STORE)

    def run(*rows):
        arrive(spark, landing, [row("a", v, int(t * HOUR)) for v, t in rows])
        arriving = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(landing)
        stream_living(arriving, ["prometheus"], 4 * HOUR, table, checkpoint, delay="1 hour", once=True).awaitTermination()
        return [s.split('"')[1] for s in told(living(table))]

    try:
        assert run(("old", 1), ("edge", 4), ("new", 9)) == ["edge", "new"]  # the watermark is at 8
        assert run(("old", 2), ("back", 8.5), ("new", 7)) == ["back", "edge", "new"]  # too late, late, and no later than known
        assert run(("old", 12), ("new", 14)) == ["new", "old"]  # at 13: one comes back, two leave
        assert run(("old", 12), ("later", 30)) == ["later"]
    finally:
        spark.conf.set(name, kept)
    with pytest.raises(ValueError):
        stream_living(spark.readStream.schema(SAMPLES).parquet(landing), ["prometheus"], 0, table, checkpoint)


def test_a_source_given_up_frees_its_cores(spark, tmp_path):
    endless = spark.range(0, 10**13, 1, 3).selectExpr("'x' AS source", "map('prometheus', cast(id % 3 AS string)) AS labels", "id AS ts_ms", "1.0D AS value")
    table = VersionedTable(spark, str(tmp_path / "t"))
    readers = {f"slow-{i}": lambda: endless for i in range(3)} | {"quick": lambda: samples(spark, [row("x", "p", 1)])}
    begun = monotonic()
    failures = refresh_announced(readers, ["prometheus"], table, 10, at_once=2, seconds=6)
    assert [name for name, _ in failures] == ["slow-0", "slow-1", "slow-2"] and monotonic() - begun < 60
    assert list(spark.sparkContext.statusTracker().getActiveJobsIds()) == []
    assert told(announced_at(table.current(), 10)) == ['{prometheus="p"}']
    assert not list((tmp_path / "t" / "parts").rglob("*.parquet"))


def test_a_cluster_is_refused_a_local_folder():
    def session(**settings):
        return type("Session", (), {"conf": type("Conf", (), {"get": staticmethod(lambda key, default=None: settings.get(key.replace(".", "_"), default))})})

    assert folders.shared_base(session(spark_checkpoint_dir="hdfs:///shared/", spark_master="yarn")) == "hdfs:///shared"
    assert folders.shared_base(session(spark_sql_warehouse_dir="file:/tmp/w", spark_master="local[8]")) == "file:/tmp/w"
    assert folders.shared_base(session(spark_sql_warehouse_dir="s3a://w/", spark_master="yarn")) == "s3a://w"
    with pytest.raises(ValueError, match="checkpoint"):
        folders.shared_base(session(spark_sql_warehouse_dir="file:/tmp/w", spark_master="yarn"))
