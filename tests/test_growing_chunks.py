"""Chunks that grow against chunks of all samples at once."""

from __future__ import annotations

import random

import pytest

from labelspark.operators.series import chunk_raw
from labelspark.sources.store import SERIES_ID, with_series_id
from labelspark.streaming.chunks import KEYS, chunk_log, chunks_of, merge_chunks, stream_chunks
from tests.helpers import SAMPLES, samples


def shown(df):
    return sorted((r.source, r.id_hi, r.id_lo, r.chunk, r.min_time, r.max_time, [(s.ts_ms, s.value) for s in r.samples]) for r in df.collect())


def at_once(spark, rows, size):
    kept = {}
    for source, labels, ts, value in rows:
        kept[source, tuple(sorted(labels.items())), ts] = value
    unlike = [(s, dict(labels), ts, v) for (s, labels, ts), v in kept.items()]
    return shown(chunk_raw(with_series_id(samples(spark, unlike)), KEYS, size))


@pytest.mark.parametrize("seed", range(2))
def test_batches_in_any_order_give_the_chunks_of_all(spark, tmp_path, seed):
    rng = random.Random(seed)
    table, told = chunk_log(spark, str(tmp_path), fan=3), []
    assert chunks_of(table) is None
    for batch in range(4):
        times = range(1000, 2000) if batch == 0 else range(3000)
        rows = [(rng.choice("ab"), {"n": rng.choice("xy")}, rng.choice(times), batch * 1000.0 + i) for i in range(rng.randrange(5, 40))]
        rows = list({(r[0], r[1]["n"], r[2]): r for r in rows}.values())  # one sample per time in a batch
        told += rows
        merge_chunks(table, samples(spark, rows), size=7)
        assert shown(chunks_of(table)) == at_once(spark, told, 7)


def test_only_touched_chunks_are_written(spark, tmp_path):
    table = chunk_log(spark, str(tmp_path))
    merge_chunks(table, samples(spark, [("a", {"n": "x"}, t, 1.0) for t in range(0, 1000, 10)]), size=10)
    merge_chunks(table, samples(spark, [("a", {"n": "x"}, 905, 2.0), ("a", {"n": "new"}, 1, 1.0)]), size=10)
    part = spark.read.parquet(f"{tmp_path}/{table.state().parts[-1][0]}")
    assert sorted(r.chunk for r in part.collect()) == [0, 9, 10]
    before = table.state()
    merge_chunks(table, samples(spark, [("a", {"n": "x"}, 905, 3.0)]), size=10, run="", batch=1)
    assert table.state() == before
    merge_chunks(table, samples(spark, []), size=10)
    assert shown(chunks_of(table)) == at_once(
        spark, [("a", {"n": "x"}, t, 1.0) for t in range(0, 1000, 10)] + [("a", {"n": "x"}, 905, 2.0), ("a", {"n": "new"}, 1, 1.0)], 10
    )


def test_a_stream_keeps_its_chunks(spark, tmp_path):
    landing = str(tmp_path / "in")
    table = chunk_log(spark, str(tmp_path / "chunks"))
    rows = [("a", {"n": "x"}, t, float(t)) for t in (5, 300, 200, 100, 1, 250)]
    for i in range(0, 6, 2):
        samples(spark, rows[i : i + 2]).coalesce(1).write.mode("append").parquet(landing)
    for _ in range(2):
        arriving = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(landing)
        stream_chunks(arriving, table, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert shown(chunks_of(table)) == at_once(spark, rows, 120) and SERIES_ID == KEYS[1:]
