"""Fixed cases for each operator."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from labelspark import Federation, Matcher, Selector
from labelspark.functions import labels as L
from labelspark.functions import steps, times
from labelspark.operators import align, catalog, discovery, projection, routing, series
from labelspark.operators.matchers import matching, selector
from labelspark.sources import config
from tests.helpers import expr_map, identified, label_sets, one, samples, sources

UP = selector(("__name__", "=", "up"))


# -- matchers ----------------------------------------------------------------


def test_selector_text():
    assert str(selector(("__name__", "=", "up"), ("job", "=~", "api|worker"))) == '{__name__="up", job=~"api|worker"}'
    assert str(Selector()) == '{__name__=~".+"}'
    assert str(selector(("job", "=", 'a"b\\c'))) == '{job="a\\"b\\\\c"}'


def test_unknown_matcher_type():
    with pytest.raises(ValueError):
        Matcher("==", "a", "b")


def test_merge_keeps_order_and_skips_repeats():
    base = selector(("__name__", "=", "up"), ("job", "=", "api"))
    merged = base.merge([Matcher("=", "job", "api"), Matcher("=", "instance", "server-1"), Matcher("!=", "job", "api")])
    assert [str(m) for m in merged] == ['__name__="up"', 'job="api"', 'instance="server-1"', 'job!="api"']


VALUES = ["api", "worker", "api\n", "", None, "web-1", "a.b"]


@pytest.mark.parametrize(
    ("op", "value", "accepted"),
    [
        ("=", "api", ["api"]),
        ("=", "", ["", None]),
        ("!=", "api", ["worker", "api\n", "", None, "web-1", "a.b"]),
        ("!=", "", ["api", "worker", "api\n", "web-1", "a.b"]),
        ("=~", "api|worker", ["api", "worker"]),
        ("=~", "api.*", ["api", "api\n"]),
        ("=~", "ap", []),
        ("=~", "a.b", ["a.b"]),
        ("=~", "(api)?", ["api", "", None]),
        ("=~", ".*", VALUES),
        ("=~", ".+", ["api", "worker", "api\n", "web-1", "a.b"]),
        ("=~", "", ["", None]),
        ("!~", "api|worker", ["api\n", "", None, "web-1", "a.b"]),
        ("!~", "w.*|", ["api", "api\n", "a.b"]),
        ("!~", ".+", ["", None]),
        ("!~", ".*", []),
    ],
)
@pytest.mark.parametrize("promoted", [False, True])
def test_matcher(spark, op, value, accepted, promoted):
    rows = [(i, {} if v is None else {"job": v}) for i, v in enumerate(VALUES)]
    df = spark.createDataFrame(rows, "i int, labels map<string,string>")
    if promoted:
        df = df.withColumn("label_job", F.col("labels")["job"])
    kept = {r.i for r in matching(df, selector(("job", op, value))).collect()}
    assert kept == {i for i, v in enumerate(VALUES) if v in accepted}


def test_empty_selector_wants_a_name_but_discovery_does_not(spark):
    df = samples(spark, [("s", {"__name__": "up"}, 1, 1), ("s", {"job": "x"}, 1, 1)])
    assert matching(df, Selector()).count() == 1
    assert matching(df, Selector(), on_empty="no filter").count() == 2


# -- label maps ----------------------------------------------------------------


def test_drop_keeps_the_rest(spark):
    labels = expr_map(__name__="up", __tenant_id__="t1", prometheus="p1")
    assert one(spark, L.drop(labels, ["__tenant_id__", ""])) == {"__name__": "up", "prometheus": "p1"}
    assert one(spark, L.drop(labels, [])) == {"__name__": "up", "__tenant_id__": "t1", "prometheus": "p1"}


def test_drop_names_of_a_list(spark):
    names = F.array(*map(F.lit, ["__name__", "__tenant_id__", "prometheus"]))
    assert one(spark, projection.drop_names(names, ["__tenant_id__"])) == ["__name__", "prometheus"]


def test_external_label_wins(spark):
    stored, external = expr_map(__name__="up", prometheus="stored"), expr_map(prometheus="external")
    assert one(spark, L.overlay(stored, external)) == {"__name__": "up", "prometheus": "external"}


def test_empty_external_label_removes_the_stored_one(spark):
    assert one(spark, L.overlay(expr_map(a="1", b="2"), expr_map(a=""))) == {"b": "2"}


def test_drop_beats_overlay_and_overlay_is_idempotent(spark):
    stored, external = expr_map(a="1", b="2"), expr_map(b="x", c="y")
    assert one(spark, L.final(stored, external, ["b", "c"])) == {"a": "1"}
    once = L.overlay(stored, external)
    assert one(spark, L.overlay(once, external)) == one(spark, once)


def test_text_and_canonical_order(spark):
    labels = F.create_map(F.lit("z"), F.lit('q"\n\\'), F.lit("a"), F.lit("1"), F.lit("x.y"), F.lit("2"))
    assert one(spark, L.text(labels)) == '{a="1", "x.y"="2", z="q\\"\\n\\\\"}'
    assert one(spark, L.text(L.no_labels())) == "{}"


def test_normalize_drops_empty_values(spark):
    labels = F.create_map(F.lit("z"), F.lit(""), F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2"))
    assert list(one(spark, L.normalize(labels)).items()) == [("a", "2"), ("b", "1")]


def test_layers(spark):
    merged = projection.layered(expr_map(a="config", b="config"), expr_map(b="static", c="static"), expr_map(c="derived"))
    assert one(spark, merged) == {"a": "config", "b": "static", "c": "derived"}


# -- times and steps ---------------------------------------------------------------


def test_millis(spark):
    utc = datetime.timezone.utc
    moment = one(spark, times.from_millis(F.lit(1710000000123))).astimezone()
    assert moment == datetime.datetime(2024, 3, 9, 16, 0, 0, 123000, utc)
    before = one(spark, F.unix_millis(times.from_millis(F.lit(-1))))
    assert before == -1
    ntz = F.lit("1969-12-31 23:59:59.9995").cast("timestamp_ntz")
    assert one(spark, times.to_millis(ntz)) == -1
    assert one(spark, F.unix_seconds(times.from_seconds(F.lit(-5)))) == -5


@pytest.mark.parametrize(
    ("hint", "step", "fallback", "wanted"),
    [
        (15_000, 60_000, 60 * 10**9, 15 * 10**9),
        (None, 30_000, 60 * 10**9, 30 * 10**9),
        (0, 0, 120 * 10**9, 120 * 10**9),
        (0, -1, 0, 60 * 10**9),
    ],
)
def test_step_choice(spark, hint, step, fallback, wanted):
    columns = [F.lit(v).cast("bigint") for v in (hint, step, fallback)]
    assert one(spark, steps.step_choice(*columns)) == wanted
    assert steps.plan_step(0, 3_600_000, hint or 0, step, fallback) == wanted


DAYS_28 = 28 * 86_400_000


@pytest.mark.parametrize(
    ("span", "hint", "cap", "wanted"),
    [
        (DAYS_28, 15_000, 11_000, 219_947_267_934),
        (3_600_000, 0, 11_000, 60 * 10**9),
        (DAYS_28, 0, 0, 60 * 10**9),
        (DAYS_28, 0, 1, DAYS_28 * 10**6),
        (0, 0, 11_000, 60 * 10**9),
    ],
)
def test_step_clamp(spark, span, hint, cap, wanted):
    assert steps.plan_step(0, span, hint_ms=hint, max_points=cap) == wanted
    step = steps.step_choice(F.lit(hint), F.lit(0), F.lit(steps.DEFAULT_STEP_NS))
    clamped = steps.step_clamped(step, F.lit(0).cast("bigint"), F.lit(span).cast("bigint"), F.lit(cap))
    assert one(spark, clamped) == wanted


# -- routing -----------------------------------------------------------------------


def test_route_in_and_out(spark):
    owned = sources(spark, {"a": {"prometheus": "p-a"}, "b": {"prometheus": "p-b"}, "c": {}, "d": {"prometheus": ""}})
    chosen = selector(("prometheus", "=", "p-a"), ("__name__", "=", "up"))
    assert {r.source for r in routing.routed(owned, chosen).collect()} == {"a", "c", "d"}
    assert {r.source for r in routing.unrouted(owned, chosen).collect()} == {"b"}


def test_every_selector_must_accept(spark):
    owned = sources(spark, {"a": {"p": "1", "r": "x"}, "b": {"p": "1", "r": "y"}})
    first, second = selector(("p", "=", "1")), selector(("r", "=", "y"))
    assert {r.source for r in routing.routed(owned, first, second).collect()} == {"b"}


ROWS = [
    ("a", {"__name__": "up", "job": "api", "prometheus": "stored"}, 1000, 1),
    ("b", {"__name__": "up", "job": "api", "prometheus": "p-a"}, 1000, 2),
    ("b", {"job": "nameless"}, 1000, 3),
    ("c", {"__name__": "up", "job": "api", "prometheus": "p-a"}, 1000, 4),
]
OWNERS = {"a": {"prometheus": "p-a"}, "b": {}, "c": {"prometheus": "p-c"}}


@pytest.mark.parametrize("names", [None, {"prometheus"}])
def test_external_matchers_are_stripped_for_owners_only(spark, names):
    chosen = selector(("prometheus", "=", "p-a"), ("__name__", "=", "up"))
    hits = routing.federate(samples(spark, ROWS), sources(spark, OWNERS), chosen, external_names=names)
    assert {(r.source, r.value) for r in hits.collect()} == {("a", 1.0), ("b", 2.0)}


def test_only_external_matchers_left(spark):
    chosen = selector(("prometheus", "=", "p-a"))
    rows = samples(spark, [*ROWS, ("a", {"job": "nameless"}, 1000, 5)])
    owners = sources(spark, OWNERS)
    named = routing.federate(rows, owners, chosen)
    assert {r.value for r in named.collect()} == {1.0, 2.0}
    everything = routing.federate(rows, owners, chosen, on_empty="no filter")
    assert {r.value for r in everything.collect()} == {1.0, 2.0, 5.0}
    with pytest.raises(ValueError, match="no matchers"):
        routing.require_own_matcher(owners, chosen)
    routing.require_own_matcher(owners, selector(("prometheus", "=", "elsewhere"), ("job", "=", "api")))


def test_a_missing_route_gives_nothing(spark):
    chosen = selector(("prometheus", "=", "nowhere"), ("__name__", "=", "up"))
    owners = sources(spark, {"a": {"prometheus": "p-a"}})
    assert routing.federate(samples(spark, ROWS), owners, chosen).count() == 0
    fed = Federation(samples(spark, ROWS), owners)
    assert fed.select_series(chosen, 0, 2000).count() == 0
    assert fed.label_values("job", chosen).count() == 0


def test_scalar_per_source(spark):
    owners = sources(spark, OWNERS)
    rows = routing.scalar_rows(owners, F.lit(7.0), 1000, selector(("prometheus", "!=", "p-c")))
    assert {(r.source, len(r.labels), r.ts_ms, r.value) for r in rows.collect()} == {("a", 0, 1000, 7.0), ("b", 0, 1000, 7.0)}


# -- series ---------------------------------------------------------------------


def test_two_samples_one_chunk(spark):
    df = identified(spark, [("s", {"job": "api"}, 2000, 2), ("s", {"job": "api"}, 1000, 1)])
    for chunks in (series.chunk_grid(df), series.chunk_raw(df)):
        row = chunks.first()
        assert chunks.count() == 1
        assert (row.min_time, row.max_time) == (1000, 2000)
        assert [tuple(s) for s in row.samples] == [(1000, 1.0), (2000, 2.0)]


@pytest.mark.parametrize("block_ms", [700, 10_000, 10**9])
def test_chunks_over_120_samples(spark, block_ms):
    rows = [("s", {"job": j}, t * 100, t) for j in ("a", "b") for t in range(301)]
    df = identified(spark, rows).repartition(5)
    for chunks in (series.chunk_grid(df), series.chunk_raw(df, block_ms=block_ms)):
        got = {(r.labels_c[0].value, r.chunk): r for r in chunks.collect()}
        assert sorted(got) == [(j, c) for j in "ab" for c in range(3)]
        for (_, chunk), row in got.items():
            wanted = range(chunk * 120, min(chunk * 120 + 120, 301))
            assert [s.value for s in row.samples] == [float(t) for t in wanted]
            assert (row.min_time, row.max_time) == (wanted[0] * 100, wanted[-1] * 100)


def test_ties_in_time_are_chunked_by_the_tiebreak(spark):
    df = identified(spark, [("s", {"j": "a"}, 1000, v) for v in range(250)]).withColumn("event_id", F.col("value"))
    chunks = series.chunk_raw(df, tiebreak="event_id").orderBy("chunk").collect()
    assert [[s.value for s in c.samples] for c in chunks] == [
        [float(v) for v in range(lo, min(lo + 120, 250))] for lo in (0, 120, 240)
    ]


def test_empty_series_are_skipped(spark):
    nested = spark.createDataFrame(
        [("s", {"job": "empty"}, []), ("s", {"job": "api"}, [(1000, 1.0)]), ("s", {"job": "none"}, None), ("s", None, [(1, 1.0)])],
        f"source string, labels map<string,string>, samples array<{series.SAMPLE}>",
    )
    series.require_matrix(nested)
    assert label_sets(series.skip_empty(nested)) == [{"job": "api"}]


def test_wrong_shapes_are_refused(spark):
    flat = samples(spark, ROWS)
    with pytest.raises(TypeError):
        series.require_matrix(flat)
    nested = series.nest(identified(spark, ROWS))
    with pytest.raises(TypeError):
        Federation(flat, sources(spark, OWNERS)).answer(nested)


def test_series_in_label_order_with_limit(spark):
    rows = [("s", {"job": j, "n": n}, 1000, 1) for j in ("z", "a") for n in ("2", "10")] + [("s", {"job": "a"}, 1000, 1)]
    found = series.series_metadata(identified(spark, rows))
    ordered = label_sets(series.limit_series(series.labels_back(found), 0))
    assert [(l["job"], l.get("n")) for l in ordered] == [("a", None), ("a", "10"), ("a", "2"), ("z", "10"), ("z", "2")]
    for limit, wanted in ((2, 2), (0, 5), (-1, 5), (9, 5)):
        assert label_sets(series.limit_series(series.labels_back(found), limit)) == ordered[:wanted]


def test_time_range(spark):
    df = samples(spark, [("s", {"a": "b"}, t, t) for t in (999, 1000, 1500, 2000, 2001)])
    assert {r.ts_ms for r in series.in_range(df, 1000, 2000).collect()} == {1000, 1500, 2000}
    for call in (series.in_range, series.overlapping):
        with pytest.raises(ValueError):
            call(df, 2, 1)


def test_series_request(spark):
    rows = [(s, {"__name__": "up", "job": j, "replica": r}, t, t) for s in "ab" for j in "yx" for r in "12" for t in (60_000, 120_000)]
    owners = sources(spark, {"a": {"region": "eu"}, "b": {"region": "us"}})
    fed = Federation(samples(spark, rows), owners, ("hidden",))
    got = fed.select_series(UP, 60_000, 180_000, replica=["replica"]).collect()
    assert [(r.labels["job"], r.labels["region"]) for r in got] == [("x", "eu")] * 2 + [("x", "us")] * 2 + [("y", "eu")] * 2 + [("y", "us")] * 2
    assert all(set(r.labels) == {"__name__", "job", "region"} for r in got)
    chunk = got[0].chunks[0]
    assert (chunk.min_time, chunk.max_time) == (60_000, 180_000)
    assert [tuple(s) for s in chunk.samples] == [(60_000, 60_000.0), (120_000, 120_000.0), (180_000, 120_000.0)]
    assert len(fed.select_series(UP, 60_000, 180_000, limit=3).collect()) == 3
    assert len(fed.series_metadata(UP, 60_000, 60_000, limit=5).collect()) == 5
    only_us = selector(("__name__", "=", "up"), ("region", "=", "us"))
    assert {r.source for r in fed.series_metadata(only_us, 0, 10**6).collect()} == {"b"}
    with pytest.raises(ValueError):
        fed.select_series(UP, 2, 1)
    with pytest.raises(ValueError, match="no matchers"):
        fed.select_series(selector(("region", "=", "us")), 0, 1)


# -- queries ------------------------------------------------------------------------


def test_instant_and_range_query(spark):
    rows = [("a", {"__name__": "up", "job": "api"}, t, v) for t, v in ((1_000, 1), (61_000, 2), (400_000, 3))]
    fed = Federation(samples(spark, rows), sources(spark, {"a": {"prometheus": "p"}}))
    chosen = selector(("__name__", "=", "up"), ("prometheus", "=", "p"))
    row = fed.query(chosen, 123).first()
    assert (row.labels, row.ts_ms, row.value) == ({"__name__": "up", "job": "api", "prometheus": "p"}, 123_000, 2.0)
    assert fed.query(chosen, 1).first().value == 1.0
    assert fed.query(chosen, 361, 300_000).count() == 0  # the sample at 61 s is just too old
    got = {r.ts_ms: r.value for r in fed.query_range(chosen, 0, 480, 60).collect()}
    assert got == {60_000: 1.0, **{t * 1000: 2.0 for t in range(120, 361, 60) if t < 361}, 420_000: 3.0, 480_000: 3.0}


def test_rate_over_a_restart(spark):
    points = [(100_000, 10), (115_000, 16), (130_000, 4), (145_000, 10)]
    rows = [("a", {"__name__": "hits"}, t, v) for t, v in points]
    fed = Federation(samples(spark, rows), sources(spark, {"a": {}}))
    chosen = selector(("__name__", "=", "hits"))
    rates = {r.ts_ms: r.value for r in fed.rate(chosen, 100, 200, 15, 300_000).collect()}
    assert rates[115_000] == pytest.approx(6 / 15)
    assert rates[130_000] == pytest.approx(10 / 30)
    assert rates[145_000] == rates[190_000] == pytest.approx(16 / 45)
    assert 100_000 not in rates
    last = {r.ts_ms: r.value for r in fed.irate(chosen, 100, 200, 15, 300_000).collect()}
    assert (last[115_000], last[130_000], last[145_000]) == (pytest.approx(0.4), pytest.approx(4 / 15), pytest.approx(0.4))


def test_bad_grids(spark):
    df = identified(spark, ROWS)
    for start, end, step, lookback in ((2, 1, 1, 1), (0, 1, 0, 1), (0, 1, 1, 0)):
        with pytest.raises(ValueError):
            align.range_select(df, start, end, step, lookback)


# -- discovery -----------------------------------------------------------------------


def test_label_names_need_a_hit(spark):
    rows = samples(spark, [("a", {"__name__": "up", "job": "x"}, 1, 1), ("b", {"__name__": "down", "zone": "1"}, 1, 1)])
    owners = sources(spark, {"a": {"prometheus": "p"}, "b": {"region": "eu"}})
    names = lambda **k: [r.name for r in discovery.label_names(rows, owners, **k).collect()]
    assert names() == ["__name__", "job", "prometheus", "region", "zone"]
    assert names(chosen=UP) == ["__name__", "job", "prometheus"]
    assert names(chosen=UP, dropped=["prometheus"], replica=["job"]) == ["__name__"]
    assert names(chosen=selector(("region", "=", "eu"))) == ["__name__", "region", "zone"]


OWNED = {"a": {"prometheus": "p-a"}, "b": {"prometheus": "p-b"}}


@pytest.mark.parametrize(
    ("matchers", "values"),
    [
        ([("__name__", "=", "bytes"), ("resource", "=", "none")], ["p-a", "p-b"]),
        ([("prometheus", "=", "p-b"), ("__name__", "=", "bytes")], ["p-b"]),
        ([], ["p-a", "p-b"]),
    ],
)
def test_owned_values_are_not_read(spark, matchers, values):
    failing = samples(spark, ROWS).withColumn("labels", F.when(F.raise_error(F.lit("read")).isNull(), F.col("labels")))
    owners = config.literal_sources(spark, OWNED)
    found = discovery.label_values(failing, owners, "prometheus", selector(*matchers))
    assert [r.value for r in found.collect()] == values


def test_stored_values_of_routed_sources(spark):
    rows = samples(spark, [("a", {"__name__": "bytes", "resource": "lb", "location": "global"}, 1, 1), ("b", {"__name__": "bytes", "resource": "container", "location": "global"}, 1, 1)])
    chosen = selector(("prometheus", "=", "p-a"), ("__name__", "=", "bytes"), ("location", "=", "global"))
    assert [r.value for r in discovery.label_values(rows, sources(spark, OWNED), "resource", chosen).collect()] == ["lb"]


def test_label_value_edges(spark):
    rows, owners = samples(spark, ROWS), sources(spark, OWNERS)
    with pytest.raises(ValueError):
        discovery.label_values(rows, owners, "")
    for hidden in ({"dropped": ["job"]}, {"replica": ["job"]}):
        assert discovery.label_values(rows, owners, "job", **hidden).count() == 0


# -- catalogue ---------------------------------------------------------------------


def test_announced_values(spark):
    values = spark.createDataFrame([("prom-b",), ("",), ("prom-a",), ("prom-a",), (None,)], "v string")
    assert label_sets(catalog.announce_values(values, "prometheus", F.col("v"))) == [{"prometheus": "prom-a"}, {"prometheus": "prom-b"}]


def test_announced_labels_are_not_crossed(spark):
    rows = samples(spark, [("a", {"p": "1", "q": "x"}, 1, 1), ("b", {"p": "1", "q": "y"}, 1, 1), ("b", {"q": ""}, 1, 1)])
    assert [r.labels_s for r in catalog.announce(rows, ["q", "p"]).collect()] == ['{p="1"}', '{q="x"}', '{q="y"}']
    assert len(catalog.announce(rows, ["q", "p"], "source").collect()) == 4
    with pytest.raises(ValueError):
        catalog.announce(rows, ["p", ""])


def test_catalogue(spark):
    owners = sources(spark, {"told": {"region": "global"}, "external": {"region": "eu"}, "bare": {}})
    announced = spark.createDataFrame([("told", {"prometheus": "a"}), ("told", {"prometheus": "b"})], "source string, labels map<string,string>")
    rows = {(r.source, L_text(r.labels)): r for r in catalog.catalog(owners, announced).collect()}
    assert sorted(rows) == [
        ("bare", "query-backend=bare"),
        ("external", "region=eu"),
        ("told", "prometheus=a,region=global"),
        ("told", "prometheus=b,region=global"),
    ]
    assert all((r.min_time, r.max_time) == (-(2**63), 2**63 - 1) for r in rows.values())
    assert rows["bare", "query-backend=bare"].bound_labels == {}
    assert rows["external", "region=eu"].bound_labels == {"region": "eu"}


def L_text(labels):
    return ",".join(f"{k}={v}" for k, v in sorted(labels.items()))


def test_lookback():
    hour = 3_600_000
    assert catalog.lookback_range(10 * hour, 6 * hour) == (4 * hour, 10 * hour)
    assert catalog.lookback_range(10 * hour, 0) is None
    with pytest.raises(ValueError):
        catalog.lookback_range(10 * hour, -1000)


# -- sources -----------------------------------------------------------------------


def test_source_lists(spark):
    none = config.literal_sources(spark, {})
    assert [tuple(r) for r in none.collect()] == [("backend", {})]
    some = sources(spark, {"a": {"x": "1"}, "b": None})
    assert {(r.source, L_text(r.external_labels)) for r in config.normalize_sources(some).collect()} == {("a", "x=1"), ("b", "")}
    assert [r.source for r in config.normalize_sources(some.filter("false")).collect()] == ["backend"]


def test_ids():
    assert config.ids_in_order(["team-1", " space ", "", "team-1"]) == ["team-1", "space"]


def test_sources_from_ids(spark):
    ids = spark.createDataFrame([("team-1",), (" space ",), ("  ",), ("team-1",)], "source string")
    got = config.sources_from_ids(ids, static={"prometheus": "x", "region": "eu"}, prefix="id-")
    assert {(r.source, L_text(r.external_labels)) for r in got.collect()} == {
        ("team-1", "prometheus=id-team-1,region=eu"),
        ("space", "prometheus=id-space,region=eu"),
    }


def test_external_labels_from_config(spark):
    docs = spark.createDataFrame(
        [
            ("a", '{"global": {"scrape_interval": "1m", "external_labels": {"prometheus": "tenant", "region": "eu"}}}'),
            ("b", '{"global": {}}'),
            ("c", "{}"),
        ],
        "source string, config string",
    )
    got = {r.source: r.external_labels for r in config.external_labels_from_config(docs).collect()}
    assert got == {"a": {"prometheus": "tenant", "region": "eu"}, "b": {}, "c": {}}
    broken = spark.createDataFrame([("a", "{not json")], "source string, config string")
    with pytest.raises(Exception, match="MALFORMED|alformed"):
        config.external_labels_from_config(broken).collect()


def test_tenants(spark):
    fields = spark.createDataFrame([(1, "tenant-a| tenant-b ||"), (2, " | "), (3, None), (4, "x")], "id int, tenant_field string")
    got = [(r.id, r.tenant) for r in config.split_tenants(fields).orderBy("id", "tenant").collect()]
    assert got == [(1, "tenant-a"), (1, "tenant-b"), (2, "backend"), (3, "backend"), (4, "x")]


def test_label_rules(spark):
    owners = sources(spark, {"a": {"region": "global"}, "b": {"invalid-name": "x"}, "c": {"": "x"}, "d": {"ok": " "}, "e": {"1a": "x"}})
    got = {r.source: r.problem for r in config.label_problems(owners, "external_labels", "source").collect()}
    assert got == {"b": "invalid name", "c": "empty name", "d": "empty value", "e": "invalid name"}
    assert one(spark, L.valid_any_name(F.lit("any text.")))
    assert not one(spark, L.valid_any_name(F.lit("")))
