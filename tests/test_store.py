"""Stored samples, the series table, and the plans over them."""

from __future__ import annotations

import io
from contextlib import contextmanager, redirect_stdout

import pytest
from pyspark.sql import functions as F

from labelspark import Federation
from labelspark.operators import align, discovery, routing, series
from labelspark.operators.matchers import matching, selector
from labelspark.sources import config, store
from tests.helpers import samples

DAY = 86_400_000
T0 = 19_800 * DAY
ROWS = [
    (f"src-{s}", {"__name__": m, "job": f"j{j}", "empty": ""}, T0 + d * DAY + j * 1000, s * 100 + d * 10 + j)
    for s in range(4)
    for m in ("up", "down")
    for j in range(3)
    for d in range(3)
]
OWNERS = {f"src-{s}": {"region": "eu" if s < 2 else "us"} for s in range(4)}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    store.write_samples(samples(spark, ROWS), f"{path}/samples", hot=["__name__", "job", "region"])
    store.write_series(store.read_samples(spark, f"{path}/samples"), f"{path}/series")
    return path


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@contextmanager
def setting(spark, **settings):
    settings = {name.replace("_", "."): value for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_round_trip(spark, stored):
    df = store.read_samples(spark, f"{stored}/samples")
    assert df.count() == len(ROWS)
    assert {"name", "label_job", "day", "source"} <= set(df.columns)
    assert {tuple(r[0]) for r in df.select(F.map_keys("labels")).collect()} == {("__name__", "job")}


def test_days_are_pruned(spark, stored):
    df = store.read_samples(spark, f"{stored}/samples", T0 + DAY - 1, T0 + 2 * DAY - 1)
    assert df.count() == len(ROWS) // 3
    assert "PartitionFilters: [isnotnull(day" in plan(df)


def test_hot_labels_reach_the_scan(spark, stored):
    df = store.read_samples(spark, f"{stored}/samples")
    chosen = selector(("__name__", "=", "up"), ("job", "=~", "j1|j2"))
    shown = plan(matching(df, chosen).select("ts_ms", "value"))
    assert "EqualTo(name,up)" in shown and "In(label_job, [j1,j2])" in shown
    assert "labels" not in shown.split("ReadSchema")[1].split("\n")[0]


def test_routing_prunes_source_partitions(spark, stored):
    df = store.read_samples(spark, f"{stored}/samples")
    owners = config.literal_sources(spark, OWNERS)
    chosen = selector(("region", "=", "eu"), ("__name__", "=", "up"))
    hits = routing.federate(df, owners, chosen, external_names={"region"})
    shown = plan(hits)
    assert "dynamicpruning" in shown and "BroadcastHashJoin" in shown
    assert {r.source for r in hits.collect()} == {"src-0", "src-1"}
    kept = routing.keep_routed(df, owners, chosen)
    assert "dynamicpruning" in plan(kept) and kept.count() == len(ROWS) // 2


@pytest.mark.parametrize("bounds", [{}, {"BROADCAST_ROWS": 1}, {"BROADCAST_BYTES": 10}])
def test_answers_do_not_hang_on_a_broadcast(spark, stored, bounds, monkeypatch):
    """Past the bounds the source table is joined by salted shuffle, with the same rows."""
    for name, value in bounds.items():
        monkeypatch.setattr(routing, name, value)
    with setting(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_autoBroadcastJoinThreshold="-1"):
        df = store.read_samples(spark, f"{stored}/samples")
        owners = config.literal_sources(spark, OWNERS)
        fed = Federation(df, owners, external_names=frozenset({"region"}))
        chosen = selector(("region", "=", "eu"), ("__name__", "=", "up"))
        answer = fed.query_range(chosen, T0 // 1000, T0 // 1000 + 3 * 86_400, 43_200, DAY)
        shown = plan(answer)
        assert fed.small == (not bounds) == ("BroadcastHashJoin" in shown)
        assert ("_salt" in shown) == bool(bounds)
        got = {(r.source, r.labels["job"], r.ts_ms, r.value) for r in answer.collect()}
        assert len(got) == 2 * 3 * 6
        assert all(r.labels["region"] == "eu" for r in answer.collect())
        assert fed.series_metadata(chosen, T0, T0 + 3 * DAY).count() == 6
        assert {r.name for r in fed.label_names(chosen).collect()} == {"__name__", "job", "region"}
        assert routing.keep_routed(df, owners, chosen).count() == len(ROWS) // 2


def test_one_routed_source_of_many_prunes(spark, stored):
    """The size of the whole source table does not matter, only that of its routed part."""
    many = spark.range(routing.BROADCAST_ROWS + 10).select(
        F.concat(F.lit("src-"), "id").alias("source"),
        F.create_map(F.lit("region"), F.when(F.col("id") == 1, "eu").otherwise("us")).alias("external_labels"),
    )
    df = store.read_samples(spark, f"{stored}/samples")
    with setting(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_autoBroadcastJoinThreshold="-1"):
        hits = routing.federate(df, many, selector(("region", "=", "eu"), ("__name__", "=", "up")), external_names={"region"})
        assert {r.source for r in hits.collect()} == {"src-1"}
        shown = plan(hits)
        assert "dynamicpruningexpression(source" in shown and "dynamicpruningexpression(true)" not in shown


def test_writes_add_or_replace_partitions(spark, tmp_path):
    path = str(tmp_path / "samples")
    first = [("a", {"__name__": "up"}, T0 + d * DAY, 1.0) for d in range(3)]
    store.write_samples(samples(spark, first), path)
    store.write_samples(samples(spark, [("b", {"__name__": "up"}, T0, 2.0)]), path)
    assert store.read_samples(spark, path).count() == 4
    store.write_samples(samples(spark, [("a", {"__name__": "up"}, T0 + DAY + 5, 3.0)]), path, mode="partitions")
    got = {(r.source, r.ts_ms, r.value) for r in store.read_samples(spark, path).collect()}
    assert got == {("a", T0, 1.0), ("a", T0 + DAY + 5, 3.0), ("a", T0 + 2 * DAY, 1.0), ("b", T0, 2.0)}
    assert store.read_samples(spark, path, after=T0).count() == 2
    assert store.read_samples(spark, path, until=T0).count() == 2
    store.write_samples(samples(spark, first[:1]), path, mode="all")
    assert store.read_samples(spark, path).count() == 1
    with pytest.raises(ValueError):
        store.write_samples(samples(spark, first), path, mode="other")


def test_ranges_with_open_ends(spark, stored):
    least, most = -(2**63), 2**63 - 1
    df = store.read_samples(spark, f"{stored}/samples")
    table = store.read_series(spark, f"{stored}/series")
    for frame in (df, table):
        assert series.in_range(frame, least, most).count() == series.in_range(frame, None, None).count() == frame.count()
        assert series.in_range(frame, 10**14, None).count() == series.in_range(frame, None, -(10**17)).count() == 0
        assert series.in_range(frame, -(10**17), 10**17).count() == frame.count()
    fed = Federation(df, config.literal_sources(spark, OWNERS))
    assert fed.label_names(start=10**14).count() == 0 and fed.label_names(end=T0 - 1).count() == 0


def test_no_cross_product_and_aggregation_before_the_shuffle(spark, stored):
    df = series.with_identity(store.read_samples(spark, f"{stored}/samples"))
    end = T0 + 3 * DAY
    for made in (
        align.range_select(df, T0, end, 60_000, 300_000),
        align.counter_rate(df, T0, end, 60_000, 300_000),
        align.counter_irate(df, T0, end, 60_000, 300_000),
        series.chunk_raw(df),
    ):
        shown = plan(made)
        assert "CartesianProduct" not in shown and "NestedLoop" not in shown
    shown = plan(align.range_select(df, T0, end, 60_000, 300_000))
    assert "partial_max_by" in shown
    assert shown.count("Exchange\n") + shown.count(") Exchange") >= 2
    assert "Window" not in plan(align.range_select(df, T0, end, 300_000, 300_000))
    assert "partial_max_by" in plan(align.instant_select(df, end, DAY))


def test_chunks_read_the_samples_once(spark, stored):
    df = series.with_identity(store.read_samples(spark, f"{stored}/samples"))
    with setting(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_autoBroadcastJoinThreshold="-1"):
        chunks = series.chunk_raw(df)
        assert sum(len(r.samples) for r in chunks.collect()) == len(ROWS)
        final = plan(chunks).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("Scan parquet") == 1


def test_metadata_reads_no_values(spark, stored):
    df = series.with_identity(store.read_samples(spark, f"{stored}/samples"))
    read = plan(series.series_metadata(df)).split("ReadSchema")[1].split("\n")[0]
    assert "value:double" not in read and "ts_ms" not in read


def test_limit_is_a_top_k(spark, stored):
    fed = Federation(store.read_samples(spark, f"{stored}/samples"), config.literal_sources(spark, OWNERS))
    assert "TakeOrderedAndProject" in plan(fed.series_metadata(selector(("job", "!=", "x")), T0, T0 + DAY, limit=5))


def test_series_table_serves_discovery(spark, stored):
    table = store.read_series(spark, f"{stored}/series")
    assert table.count() == 4 * 2 * 3 * 3
    owners = config.literal_sources(spark, OWNERS)
    names = discovery.label_names(series.overlapping(table, T0, T0 + DAY), owners)
    assert [r.name for r in names.collect()] == ["__name__", "job", "region"]
    values = discovery.label_values(table, owners, "job", selector(("region", "=", "us"), ("job", "!=", "j0")))
    assert [r.value for r in values.collect()] == ["j1", "j2"]
    by_table = Federation(table, owners)
    by_samples = Federation(store.read_samples(spark, f"{stored}/samples"), owners)
    chosen = selector(("region", "=", "us"), ("job", "!=", "j0"))
    for fed in (by_table, by_samples):
        assert fed.series_metadata(chosen, T0 + 1001, T0 + DAY - 1).count() == 4
        assert fed.series_metadata(chosen, T0 + 2001, T0 + DAY - 1).count() == 0
        assert fed.label_names(chosen, T0 + 4 * DAY, T0 + 5 * DAY).count() == 0
    shown = plan(series.in_range(table, T0, T0 + 10))
    assert "PartitionFilters: [isnotnull(day" in shown


def test_work_by_series_id(spark, stored):
    """With ids in place of label lists all requests answer the same, and the label map is not read."""
    df = store.read_samples(spark, f"{stored}/samples")
    table = store.read_series(spark, f"{stored}/series")
    assert store.series_labels(table).count() == 4 * 2 * 3
    owners = config.literal_sources(spark, OWNERS)
    plain = Federation(df, owners, external_names=frozenset({"region"}))
    slim = Federation(df, owners, external_names=frozenset({"region"}), series=table)
    chosen = selector(("region", "=", "eu"), ("__name__", "=", "up"), ("job", "!=", "j0"))
    first, last, step = T0 // 1000, T0 // 1000 + 3 * 86_400, 43_200

    def rows(df):
        return sorted(str(r.asDict(recursive=True)) for r in df.collect())

    for request in (
        lambda fed: fed.query(chosen, last, 2 * DAY),
        lambda fed: fed.query_range(chosen, first, last, step, DAY),
        lambda fed: fed.rate(chosen, first, last, step, 2 * DAY),
        lambda fed: fed.irate(chosen, first, last, step, 2 * DAY),
        lambda fed: fed.select_series(chosen, T0, T0 + 3 * DAY, step_ms=60_000),
        lambda fed: fed.series_metadata(chosen, T0, T0 + 3 * DAY, replica=["job"], limit=5),
    ):
        got = rows(request(slim))
        assert got == rows(request(plain)) and got
    scans = [line for line in plan(slim.rate(chosen, first, last, step, 2 * DAY)).split("\n") if "ReadSchema" in line]
    assert any("value:double" in line for line in scans)
    assert all("labels" not in line.replace("label_", "") for line in scans if "value:double" in line)
    filters = [line for line in plan(slim.query(chosen, last, DAY)).split("\n") if "PartitionFilters" in line]
    assert len(filters) >= 2 and all("day" in line for line in filters)


def test_sources_table(spark, tmp_path):
    path = str(tmp_path / "sources")
    config.literal_sources(spark, OWNERS).write.parquet(path)
    assert config.read_sources(spark, path).filter(F.col("external_labels")["region"] == "eu").count() == 2


def below_exchanges(df):
    """The lines of a plan, as it was run, that stand below a shuffle."""
    df.collect()
    lines, found = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n"), []
    depth = None
    for line in lines:
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and at <= depth:
            depth = None
        if depth is not None:
            found.append(line)
        elif "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line:
            depth = at
    return found


def test_buckets_keep_samples_in_place(spark, tmp_path):
    from dataclasses import replace

    from labelspark.sources import buckets

    rows = [("s", {"__name__": "up", "n": str(i)}, T0 + d * DAY + i, 1.0) for i in range(50) for d in range(3)]
    for part in (rows[:70], rows[70:]):
        buckets.write_bucketed(samples(spark, part), "in_buckets", f"{tmp_path}/samples", 4)
    held = buckets.read_bucketed(spark, "in_buckets", T0 - 1, T0 + 3 * DAY)
    store.write_series(held, f"{tmp_path}/series")
    fed = Federation(held, config.literal_sources(spark, {"s": {}}), series=store.read_series(spark, f"{tmp_path}/series"), broadcast_ids=0, buckets=4)
    chosen = selector(("__name__", "=", "up"), ("n", "=~", "[0-9]*3"))
    with setting(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_autoBroadcastJoinThreshold="-1"):
        hits = fed.hits(chosen)
        answered = align.range_select(hits, T0, T0 + 3 * DAY, DAY // 2, DAY, fed.keys)
        assert hits.count() == 15 and answered.count() == replace_samples(spark, fed, chosen, rows)
        shown = hits._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in shown and not [line for line in below_exchanges(hits) if "in_buckets" in line]
    spark.sql("DROP TABLE in_buckets")
    buckets.open_bucketed(spark, "opened", f"{tmp_path}/samples", 4)
    again = replace(fed, samples=buckets.read_bucketed(spark, "opened", T0 - 1, T0 + 3 * DAY))
    assert again.hits(chosen).count() == 15 and again.hits(chosen).filter(F.col("day") == "2024-03-18").count() == 5
    with pytest.raises(ValueError):
        buckets.write_bucketed(samples(spark, rows), "other", f"{tmp_path}/other", 4, mode="partitions")


def replace_samples(spark, fed, chosen, rows):
    """How many answers the same request has without a series table."""
    plain = Federation(samples(spark, rows), fed.sources)
    return align.range_select(plain.hits(chosen), T0, T0 + 3 * DAY, DAY // 2, DAY, plain.keys).count()


def test_buckets_follow_the_samples(spark, tmp_path, monkeypatch):
    """A bucket is one task's work, so a larger table has more of them."""
    from labelspark.sources import buckets

    rows = [("s", {"__name__": "up", "pod": f"p{i}"}, T0 + i, i) for i in range(600)]
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 50)
    assert buckets.buckets_for(samples(spark, rows[:10]), 4) == 4
    many = buckets.buckets_for(samples(spark, rows), 4)
    assert many == 12
    buckets.write_bucketed(samples(spark, rows), "many_buckets", f"{tmp_path}/samples", many)
    held = buckets.read_bucketed(spark, "many_buckets")
    per_file = held.groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in per_file) == 600 and max(r["count"] for r in per_file) < 150
    spark.sql("DROP TABLE many_buckets")
