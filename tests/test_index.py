"""The label index against plain filters, its plans, and exact discovery at the ends of a range."""

from __future__ import annotations

import random
import re
from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelspark import Federation
from labelspark.operators import routing, series
from labelspark.operators.matchers import Matcher, Selector, selector
from labelspark.sources import config, index, store
from tests.helpers import samples
from tests.test_store import plan

DAY = 86_400_000
T0 = 19_800 * DAY
OWNERS = {"a": {"region": "eu", "zone": ""}, "b": {"region": "us", "job": "owned"}, "c": {}}
CHOICES = {
    "__name__": ["up", "down", None],
    "job": ["api-server", "api-worker", "web", None],
    "pod": ["pod-é1", "pod-2", "x", None],
    "region": ["eu", "asia", None],
}


def random_rows(n=160, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        labels = {k: v for k, values in CHOICES.items() if (v := rng.choice(values)) is not None}
        rows.append((rng.choice("abc"), labels, T0 + rng.randrange(3 * DAY), 1.0))
    return rows


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("index"))
    rows = random_rows()
    for part in (rows[:60], rows[60:]):
        index.write_store(samples(spark, part), place, blocks=4)
    fed = Federation(
        store.read_samples(spark, f"{place}/samples"),
        config.literal_sources(spark, OWNERS),
        ("dropped",),
        external_names=frozenset({"region", "job", "zone"}),
        series=store.read_series(spark, f"{place}/series"),
        index=index.LabelIndex.read(spark, f"{place}/index"),
    )
    return place, fed


SELECTORS = [
    selector(("__name__", "=", "up")),
    selector(("__name__", "=", "up"), ("job", "=~", "api-.+")),
    selector(("job", "=~", ".*-worker|web")),
    selector(("job", "!=", "web")),
    selector(("job", "!~", "api-.*"), ("pod", "!=", "")),
    selector(("pod", "=", "")),
    selector(("pod", "=~", "pod-.[0-9]|"), ("__name__", "!=", "down")),
    selector(("region", "=", "eu")),
    selector(("region", "!=", "us"), ("job", "=", "owned")),
    selector(("region", "=~", "eu|us"), ("job", "=~", "owned|web")),
    selector(("job", "=", "owned"), ("region", "=", "us")),
    selector(("pod", "=", "pod-é1"), ("pod", "!~", ".*2"), ("nothing", "=", "")),
    selector(("pod", "=", "missing")),
    selector(("nothing", "!=", "")),
    selector(("job", "=~", ".+"), ("job", "!=", "web")),
    Selector(),
]


CASES = [(c, e, index.LISTED) for c in SELECTORS for e in (["all", "no filter"] if {"region", "job"} >= c.names() else ["all"])]


@pytest.mark.parametrize(("chosen", "on_empty", "listed"), [*CASES, (SELECTORS[1], "all", 0), (SELECTORS[8], "no filter", 1)])
def test_postings_resolve_as_filters_do(spark, made, chosen, on_empty, listed, monkeypatch):
    monkeypatch.setattr(index, "LISTED", listed)
    fed = made[1]
    keys = ["source", "day", *store.SERIES_ID]
    want = routing.federate(fed.series, fed.sources, chosen, external_names=fed.external_names, on_empty=on_empty)
    got = fed.index.resolve(fed.sources, chosen, owned=fed.owned, on_empty=on_empty)
    assert got.count() == got.distinct().count()
    assert set(map(tuple, got.collect())) == set(map(tuple, want.select(*keys).distinct().collect()))


RANGES = [(None, None), (T0 + DAY, T0 + 2 * DAY - 1), (T0 + DAY // 3, T0 + 2 * DAY + 5), (T0 + DAY + 5, T0 + DAY + DAY // 4), (T0 + 5 * DAY, None), (None, T0 + DAY // 2)]


@pytest.mark.parametrize("span", [RANGES[0], RANGES[2], RANGES[3]])
def test_discovery_by_index_by_series_and_by_samples(made, span):
    by_index = made[1]
    by_series = replace(by_index, index=None)
    by_samples = replace(by_series, series=None)
    for chosen in (SELECTORS[8], Selector()):
        told = [f.label_names(chosen, *span).collect() for f in (by_index, by_series, by_samples)]
        assert told[0] == told[1] == told[2]
        for label in ("job", "region"):
            told = [f.label_values(label, chosen, *span).collect() for f in (by_index, by_series, by_samples)]
            assert told[0] == told[1] == told[2]
    for chosen in (SELECTORS[4],):
        sets = [
            sorted((r.source, sorted(r.labels.items())) for r in f.series_metadata(chosen, *span).collect())
            for f in (by_index, by_series, by_samples)
        ]
        assert sets[0] == sets[1] == sets[2]


def test_requests_by_index(made):
    by_index = made[1]
    by_samples = replace(by_index, series=None, index=None)
    for chosen in (SELECTORS[9],):
        answers = [
            sorted((r.source, sorted(r.labels.items()), r.ts_ms, r.value) for r in f.query_range(chosen, T0 // 1000, T0 // 1000 + 259_200, 21_600, DAY).collect())
            for f in (by_index, by_samples)
        ]
        assert answers[0] == answers[1] and answers[0]


def folders_read(df):
    return set(re.findall(r"Location: InMemoryFileIndex.*?/(samples|series|values|postings|grams)\]", plan(df)))


def test_discovery_reads_no_samples(made):
    fed = made[1]
    without = replace(fed, index=None)
    chosen = SELECTORS[1]
    assert without.label_values("dropped", chosen).count() == 0
    for span in RANGES[:3]:
        assert folders_read(without.label_names(chosen, *span)) == {"series"}
        assert folders_read(without.label_values("pod", chosen, *span)) == {"series"}
        assert folders_read(without.series_metadata(chosen, *span)) == {"series"}
    for span in RANGES[:2]:
        assert folders_read(fed.label_names(chosen, *span)) <= {"values", "postings"}
        assert folders_read(fed.label_values("pod", chosen, *span)) == {"values", "postings"}
        assert folders_read(fed.label_names(Selector(), *span)) == {"values"}
    # Days cut by the range: ids and times of the series table, no label maps.
    shown = plan(fed.label_values("pod", chosen, *RANGES[2]))
    assert "samples]" not in shown and "labels:map" not in shown
    # A range within one day has to look at samples, but not at their labels or values.
    shown = plan(fed.label_names(chosen, *RANGES[3]))
    assert "samples]" in shown and "labels:map" not in shown and "value:double" not in shown


def test_a_pattern_becomes_ids(made):
    fed = made[1]
    shown = plan(fed.index.resolve(fed.sources, selector(("pod", "=~", "pod-.+")), owned=fed.owned))
    elsewhere = shown.replace("RLIKE(coalesce(external_labels", "")
    assert "RLIKE" not in elsewhere and "In(value_id, [" in shown and folders_read(fed.index.resolve(fed.sources, SELECTORS[0], owned=fed.owned)) == {"postings"}
    asked = fed.index.matching_values("pod", index.Term(Matcher("=~", "pod", "pod-.+"), False))
    shown = plan(asked)
    assert "grams]" in shown and "RLIKE" in shown and sorted(r.value for r in asked.collect()) == ["pod-2", "pod-é1"]


LITERALS = st.text("ab-.[]()|?*+{}\\^$ é1", max_size=12)


@settings(max_examples=300, deadline=None)
@given(LITERALS, st.text("ab- é1.", max_size=8))
def test_fixed_parts_are_in_every_match(pattern, value):
    try:
        whole = re.compile(f"(?s:{pattern})", re.ASCII)
    except (re.error, OverflowError):
        return
    if whole.fullmatch(value):
        assert all(part in value for part in index.fixed_parts(pattern))


@pytest.mark.parametrize(
    ("pattern", "parts"),
    [
        ("api-server", ["api-server"]), (".*worker.*", ["worker"]), ("abcd?", ["abc"]), ("abc{0}def", ["def"]), ("ab+cde", ["cde"]),
        ("a(bcd)?efg", ["efg"]), ("abc|def", []), ("x[abc]+yes", ["yes"]), ("(?i)abc", []), (r"a\.bc\d", ["a.bc"]), (r"\Qab\E", []),
        (r"\x41bcd", []), (r"abc\p{L}def", []), ("[a[b]]xyz", []), ("ab", []), ("abc(def|ghi)jkl", ["abc", "jkl"]),
    ],
)
def test_fixed_parts(pattern, parts):
    assert index.fixed_parts(pattern) == parts


def test_grams(spark):
    df = spark.createDataFrame([("abcabc",), ("éàü1",), ("ab",), ("",)], "v string")
    got = [r[0] for r in df.select(index.grams_of(F.col("v"))).collect()]
    assert got == [["abc", "bca", "cab"], ["éàü", "àü1"], [], []]


def test_postings_are_bounded_and_sorted(spark, tmp_path):
    rows = [("s", {"__name__": "up", "n": str(i)}, T0, 1.0) for i in range(600)]
    index.write_store(samples(spark, rows), str(tmp_path), blocks=16)
    postings = spark.read.parquet(f"{tmp_path}/index/postings")
    name = index.value_id(F.lit("__name__"), F.lit("up"))
    lists = [r.ids for r in postings.filter(F.col("value_id") == name).collect()]
    assert sum(map(len, lists)) == 600 and len(lists) == 16 and max(map(len, lists)) < 80
    assert all(ids == sorted(ids) for ids in lists)
    values = spark.read.parquet(f"{tmp_path}/index/values")
    assert values.filter("label = '__name__'").first().n == 600 and values.count() == 601


def test_a_repeated_write_does_no_harm(spark, tmp_path):
    rows = random_rows(30, seed=3)
    index.write_store(samples(spark, rows), str(tmp_path))
    table = store.read_series(spark, f"{tmp_path}/series")
    index.write_index(table, f"{tmp_path}/index")
    again = index.LabelIndex.read(spark, f"{tmp_path}/index")
    sources = config.literal_sources(spark, OWNERS)
    got = again.resolve(sources, SELECTORS[0])
    assert got.count() == got.distinct().count() == table.filter("labels['__name__'] = 'up'").count()
    assert again.grams.count() == again.grams.distinct().count()


def test_clashes_are_refused_before_writing(spark, tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="power of two"):
        index.write_index(spark.createDataFrame([], "source string"), str(tmp_path), blocks=3)
    rows = [("s", {"job": "a"}, T0, 1.0)]
    index.write_store(samples(spark, rows), str(tmp_path))
    counts = {n: spark.read.parquet(f"{tmp_path}/{n}").count() for n in ("samples", "series", "index/values")}
    monkeypatch.setattr(index, "value_id", lambda label, value: F.xxhash64(F.lit("job"), F.lit("a")))
    with pytest.raises(ValueError, match="share an id"):
        index.write_store(samples(spark, [("s", {"job": "b"}, T0, 1.0)]), str(tmp_path))
    monkeypatch.undo()
    monkeypatch.setattr(store, "with_series_id", lambda df: df.withColumn("id_hi", F.lit(0).cast("bigint")).withColumn("id_lo", F.lit(0).cast("bigint")))
    store.write_samples(samples(spark, rows), f"{tmp_path}/one")
    store.write_series(store.read_samples(spark, f"{tmp_path}/one"), f"{tmp_path}/clash")
    store.write_samples(samples(spark, [("s", {"job": "b"}, T0, 1.0)]), f"{tmp_path}/two")
    with pytest.raises(ValueError, match="share an id"):
        store.write_series(store.read_samples(spark, f"{tmp_path}/two"), f"{tmp_path}/clash")
    assert spark.read.parquet(f"{tmp_path}/clash").count() == 1
    assert counts == {n: spark.read.parquet(f"{tmp_path}/{n}").count() for n in counts}


def test_an_index_needs_a_series_table(made):
    with pytest.raises(ValueError, match="beside a series table"):
        replace(made[1], series=None)


def test_series_alive_within_a_day(spark):
    rows = [("a", {"n": "1"}, T0 + t, 1.0) for t in (0, 1000, 9000)] + [("a", {"n": "2"}, T0 + t, 1.0) for t in (0, 5000, 9000)]
    held = store.with_series_id(samples(spark, rows))
    table = series.series_table(held.withColumn("day", F.lit("2024-03-18").cast("date")), keys=("source", "day", *store.SERIES_ID, "labels"))
    for start, end, want in ((4000, 6000, 1), (4000, 4500, 0), (9000, 9000, 2), (1000, 8000, 2), (9001, 9500, 0)):
        got = series.alive(table, held, T0 + start, T0 + end, ["source", *store.SERIES_ID])
        assert got.count() == want


def test_series_are_sent_once_to_the_tasks_that_list_them(spark, tmp_path, monkeypatch):
    """One (source, day) with many series is listed by several tasks, and no posting is shuffled."""
    monkeypatch.setattr(index, "TASK_SERIES", 50)
    rows = [("s", {"__name__": "up", "pod": f"p{i % 7}", "n": f"{i}"}, T0 + i, 1.0) for i in range(400)]
    store.write_series(store.with_series_id(samples(spark, rows)), f"{tmp_path}/series")
    table = store.read_series(spark, f"{tmp_path}/series")
    lists = index._postings(table, 16)
    assert lists._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
    assert "Exchange" not in plan(lists).partition("Generate")[0]
    assert lists.select(F.spark_partition_id()).distinct().count() > 2
    held = [(r.label, r.value_id, r.block, [tuple(i) for i in r.ids]) for r in lists.collect()]
    want = {}
    for r in table.withColumn("ids", F.map_entries("labels")).select(
        "id_hi", "id_lo", F.explode(F.concat(F.array(F.struct(F.lit("").alias("key"), F.lit("").alias("value"))), "ids")).alias("p")
    ).select("id_hi", "id_lo", "p.key", index.value_id(F.col("p.key"), F.col("p.value")).alias("v")).collect():
        want.setdefault((r.key, r.v, (r.id_hi % 2**64) >> 60), []).append((r.id_hi, r.id_lo))
    assert len(held) == len(want) and {h[:3]: h[3] for h in held} == {k: sorted(v) for k, v in want.items()}
