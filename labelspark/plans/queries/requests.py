"""Whole requests through `Federation`."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.operators.catalog import MAX_TIME, MIN_TIME
from labelspark.operators.matchers import selector
from labelspark.operators.projection import with_text
from labelspark.operators.series import limit_series, unnest
from labelspark.plans.federation import Federation
from labelspark.plans.queries.discovery import SQL_NAMES
from labelspark.plans.queries.ranges import LOOKBACK, RATE_STEP, RATE_WINDOW, SERIES, SQL_IN_WINDOW, STEP, sql_grid
from labelspark.plans.registry import query
from labelspark.plans.tables import (
    DAY,
    DROPPED,
    END,
    EXTERNAL_NAMES,
    FINAL_TEXT,
    QUERY_TEXT,
    SQL_BOTH,
    SQL_EXTERNAL,
    SQL_TOTALS,
    SQL_VALUES,
    START,
    STORED_TEXT,
)
from labelspark.sources.buckets import buckets_for, read_bucketed, write_bucketed
from labelspark.sources.index import LabelIndex, write_store
from labelspark.sources.store import read_rollups, read_samples, read_series, write_rollups, write_samples, write_series
from labelspark.sources.folders import exists, shared_base, shared_dir

NOT_VIEW = selector(("__name__", "=", "event_value"), ("region", "=", "eu"), ("event_type", "!=", "view"))
SQL_NOT_VIEW = "metric = 'event_value' AND ext_region = 'eu' AND event_type <> 'view'"

SQL_RATES = f"""WITH {SQL_TOTALS.replace("s AS", "a AS", 1)}, {SQL_EXTERNAL},
    s AS (SELECT a.* FROM a JOIN x USING (source) WHERE ext_region = 'eu' AND event_type <> 'view'), {SQL_IN_WINDOW},
    r AS (SELECT {SERIES}, at_ms, min(ts_ms) AS t0, max(ts_ms) AS t1, coalesce(sum(CASE
            WHEN pt IS NULL OR pt <= at_ms - {RATE_WINDOW} THEN 0 WHEN value >= pv THEN value - pv ELSE value END), 0) AS gain
          FROM j GROUP BY ALL)
    SELECT source, {FINAL_TEXT} AS labels_s, at_ms AS ts_ms, round(gain / ((t1 - t0) / 1000.0), 9) AS value
    FROM r JOIN x USING (source) WHERE t1 > t0"""
RATES = selector(("__name__", "=", "events_total"), ("region", "=", "eu"), ("event_type", "!=", "view"))


def federation(t, dropped=DROPPED, samples=None):
    return Federation(
        t.samples() if samples is None else samples, t.sources(), tuple(dropped), external_names=EXTERNAL_NAMES
    )


def flat(df, *columns):
    return with_text(df).select("source", "labels_s", *columns)


# Label order is by name, then value, pair by pair, as in the sorted entries.
SQL_PAIRS = """list_filter([['__name__', metric], ['event_type', event_type],
    ['prometheus', coalesce(ext_prom, prom)], ['region', ext_region], ['user', usr]], lambda p: p[2] IS NOT NULL)"""


@query(
    f"""WITH {SQL_BOTH}, {SQL_EXTERNAL}, m AS (
      SELECT DISTINCT source, metric, tenant, event_type, prom, replica, usr, ext_prom, ext_region
      FROM s JOIN x USING (source) WHERE {SQL_NOT_VIEW})
    SELECT source, {FINAL_TEXT} AS labels_s FROM m"""
)
def series_sorted(t):
    """The flagship: matching series of all sources by final labels, duplicates kept."""
    return flat(federation(t).series_metadata(NOT_VIEW, START, END))


@query(
    f"""WITH {SQL_BOTH}, {SQL_EXTERNAL}, m AS (
      SELECT DISTINCT source, metric, tenant, event_type, prom, replica, usr, ext_prom, ext_region
      FROM s JOIN x USING (source) WHERE {SQL_NOT_VIEW}),
    o AS (SELECT source, {FINAL_TEXT} AS labels_s FROM m ORDER BY {SQL_PAIRS}, source LIMIT 300)
    SELECT source, labels_s FROM o"""
)
def series_limit(t):
    return flat(federation(t).series_metadata(NOT_VIEW, START, END, limit=300))


SQL_SELECT = f"""WITH {SQL_BOTH.replace("s AS (SELECT * FROM v", "a AS (SELECT * FROM v")}, {SQL_EXTERNAL},
    s AS (SELECT a.* FROM a JOIN x USING (source) WHERE {SQL_NOT_VIEW}), {sql_grid(SERIES, STEP, LOOKBACK)},
    n AS (SELECT *, (row_number() OVER (PARTITION BY {SERIES} ORDER BY at_ms) - 1) // 120 AS chunk FROM g)
    SELECT source, {FINAL_TEXT} AS labels_s, chunk, at_ms AS ts_ms, value,
           min(at_ms) OVER (PARTITION BY {SERIES}, chunk) AS min_time,
           max(at_ms) OVER (PARTITION BY {SERIES}, chunk) AS max_time
    FROM n JOIN x USING (source)"""


@query(SQL_SELECT)
def series_select(t):
    """A series request: routed, aligned to the capped step, chunked, in label order."""
    return flat_chunks(federation(t).select_series(NOT_VIEW, START, END))


def flat_chunks(found):
    chunks = with_text(found).select("source", "labels_s", F.posexplode("chunks").alias("chunk", "c"))
    rows = chunks.select("source", "labels_s", F.col("chunk").cast("bigint").alias("chunk"), "c.*")
    return unnest(rows)


@query(
    f"""WITH {SQL_BOTH}, {SQL_EXTERNAL}, i AS (
      SELECT {SERIES}, ext_prom, ext_region, arg_max(value, ts_ms) AS value FROM s JOIN x USING (source)
      WHERE {SQL_NOT_VIEW} AND ts_ms > {END - 31 * DAY} AND ts_ms <= {END} GROUP BY ALL)
    SELECT source, {QUERY_TEXT} AS labels_s, CAST({END} AS BIGINT) AS ts_ms, value FROM i"""
)
def instant_query(t):
    """Drops apply to queries, replica lists do not."""
    return flat(federation(t, DROPPED[:1]).query(NOT_VIEW, END // 1000, 31 * DAY), "ts_ms", "value")


@query(
    f"""WITH {SQL_BOTH.replace("s AS (SELECT * FROM v", "a AS (SELECT * FROM v")}, {SQL_EXTERNAL},
    s AS (SELECT a.* FROM a JOIN x USING (source) WHERE {SQL_NOT_VIEW}), {sql_grid(SERIES, 600_000, LOOKBACK)}
    SELECT source, {QUERY_TEXT} AS labels_s, at_ms AS ts_ms, value FROM g JOIN x USING (source)"""
)
def range_query(t):
    answer = federation(t, DROPPED[:1]).query_range(NOT_VIEW, START // 1000, END // 1000, 600)
    return flat(answer, "ts_ms", "value")


@query(
    f"""WITH {SQL_VALUES}, {SQL_EXTERNAL}, i AS (
      SELECT {SERIES}, ext_prom, ext_region, max(value) AS value FROM s JOIN x USING (source) GROUP BY ALL)
    SELECT source, {FINAL_TEXT} AS labels_s, CAST({END} AS BIGINT) AS ts_ms, value FROM i"""
)
def range_of_vector(t):
    """An answer of one sample per series is passed on as it is."""
    fed = federation(t)
    key = L.canonical(F.col("labels")).alias("labels_c")
    vector = t.values().groupBy("source", key).agg(F.max("value").alias("value"))
    return flat(fed.answer(vector.withColumn("ts_ms", F.lit(END).cast("bigint"))), "ts_ms", "value")


def rates(fed):
    answer = fed.rate(RATES, START // 1000, END // 1000, RATE_STEP // 1000, RATE_WINDOW)
    return flat(answer, "ts_ms", F.round("value", 9).alias("value"))


@query(SQL_RATES)
def rate_query(t):
    return rates(federation(t))


#: Folders that this session has written, by scale and content: several queries read the same store.
_WRITTEN: dict[tuple[str, ...], str] = {}


def written_once(t, what, write):
    """The folder of a store in the shared folder, written by the first query of the session that needs it."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, shared_base(t.spark), what)
    if key not in _WRITTEN or not exists(t.spark, _WRITTEN[key]):
        place = shared_dir(t.spark)
        write(place)
        _WRITTEN[key] = place
    return _WRITTEN[key]


def stored(t):
    """Both metrics as a sample table with its series table, in the shared folder."""

    def write(place):
        write_samples(t.samples(), f"{place}/samples", hot=["__name__", "event_type", "prometheus", "region"])
        write_series(read_samples(t.spark, f"{place}/samples", START - 1, END), f"{place}/series")

    place = written_once(t, "stored", write)
    return read_samples(t.spark, f"{place}/samples", START - 1, END), read_series(t.spark, f"{place}/series")


@query(SQL_RATES)
def stored_rate(t):
    """The same from stored samples: by series id, with labels from the series table."""
    samples, table = stored(t)
    return rates(replace(federation(t, samples=samples), series=table))


@query(f"WITH {SQL_BOTH}, {SQL_EXTERNAL}, " + SQL_NAMES.format(where="true", dropped="'__tenant_id__', 'replica'"))
def stored_label_names(t):
    """Label names from the series table."""
    return federation(t, samples=stored(t)[1]).label_names()


@query(
    f"""WITH {SQL_VALUES}, {SQL_EXTERNAL}, m AS (
      SELECT source, event_type, max(value) AS high FROM s JOIN x USING (source)
      WHERE ext_region = 'eu' AND coalesce(ext_prom, prom, '') <> 'prom-0' GROUP BY ALL)
    SELECT source, event_type, high FROM m"""
)
def composed_query(t):
    """Two selectors of one expression: only sources that both accept; grouping by stored labels."""
    high = selector(("__name__", "=", "event_value"), ("region", "=", "eu"))
    other = selector(("__name__", "=", "events_total"), ("prometheus", "!=", "prom-0"), ("region", "=~", ".+"))
    fed = federation(t).routed_for(high, other)
    return fed.hits(high).groupBy("source", F.col("labels")["event_type"].alias("event_type")).agg(
        F.max("value").alias("high")
    )


@query(
    f"""WITH {SQL_BOTH}, {SQL_EXTERNAL}, m AS (
      SELECT DISTINCT source, metric, event_type, prom, ext_prom, ext_region, CAST(NULL AS VARCHAR) AS usr
      FROM s JOIN x USING (source)),
    o AS (SELECT * FROM m ORDER BY {SQL_PAIRS}, source LIMIT 7)
    SELECT source, {FINAL_TEXT} AS labels_s FROM o"""
)
def series_limit_long(t):
    """The limit counts series before their samples are looked at."""
    key = F.map_filter("labels", lambda name, _: name.isin("__name__", "event_type", "prometheus"))
    few = t.samples().select("source", L.canonical(key).alias("labels_c")).distinct()
    fed = federation(t)
    return flat(limit_series(fed.finish(few), 7))


SQL_STORED_PAIRS = """list_filter([['__name__', metric], ['__tenant_id__', tenant], ['event_type', event_type],
    ['prometheus', prom], ['replica', replica], ['user', usr]], lambda p: p[2] IS NOT NULL)"""
SQL_METADATA = f"""WITH {SQL_BOTH}, {SQL_EXTERNAL}, m AS (
      SELECT DISTINCT source, metric, tenant, event_type, prom, replica, usr, ext_prom, ext_region
      FROM s JOIN x USING (source) WHERE {SQL_NOT_VIEW})
    SELECT source, {FINAL_TEXT} AS labels_s FROM m"""


@query(SQL_METADATA)
def metadata_unbounded(t):
    """The bounds that a store advertises for unlimited times."""
    return flat(federation(t).series_metadata(NOT_VIEW, MIN_TIME, MAX_TIME))


@query(SQL_METADATA)
def names_unlisted_external(t):
    """A list of external names that misses one: the source table knows better."""
    fed = replace(federation(t), external_names=frozenset({"prometheus"}))
    return flat(fed.series_metadata(NOT_VIEW, START, END))


@query(
    f"""WITH {SQL_VALUES}, {SQL_EXTERNAL}, m AS (
      SELECT DISTINCT source, metric, tenant, event_type, prom, replica, usr, ext_prom, ext_region FROM s JOIN x USING (source))
    SELECT source, {FINAL_TEXT} AS labels_s FROM m"""
)
def null_external(t):
    """A source whose external labels are null has none."""
    empty = F.size("external_labels") == 0
    gaps = t.sources().withColumn("external_labels", F.when(~empty, F.col("external_labels")))
    fed = replace(federation(t), sources=gaps)
    return flat(fed.series_metadata(selector(("__name__", "=", "event_value")), START, END))


SQL_SELECT_LIMIT = f"""WITH {SQL_BOTH.replace("s AS (SELECT * FROM v", "a AS (SELECT * FROM v")}, {SQL_EXTERNAL},
    s AS (SELECT a.* FROM a JOIN x USING (source) WHERE {SQL_NOT_VIEW}), {sql_grid(SERIES, STEP, LOOKBACK)},
    k AS (SELECT DISTINCT {SERIES}, ext_prom, ext_region FROM g JOIN x USING (source)),
    l AS (SELECT * FROM k ORDER BY {SQL_PAIRS}, source, {SQL_STORED_PAIRS} LIMIT 40),
    n AS (SELECT *, (row_number() OVER (PARTITION BY {SERIES} ORDER BY at_ms) - 1) // 120 AS chunk FROM g)
    SELECT source, {FINAL_TEXT} AS labels_s, chunk, at_ms AS ts_ms, value,
           min(at_ms) OVER (PARTITION BY {SERIES}, chunk) AS min_time,
           max(at_ms) OVER (PARTITION BY {SERIES}, chunk) AS max_time
    FROM n SEMI JOIN l ON {" AND ".join(f"n.{c} IS NOT DISTINCT FROM l.{c}" for c in SERIES.split(", "))} JOIN x USING (source)"""


@query(SQL_SELECT_LIMIT)
def series_select_limit(t):
    """The first series are chosen by their labels before any samples are chunked."""
    return flat_chunks(federation(t).select_series(NOT_VIEW, START, END, limit=40))


@query(SQL_SELECT)
def stored_select(t):
    """The series request from stored samples: the selector is resolved on the series table."""
    samples, table = stored(t)
    return flat_chunks(replace(federation(t, samples=samples), series=table).select_series(NOT_VIEW, START, END))


@query(
    f"""WITH {SQL_BOTH}, {SQL_EXTERNAL}, m AS (
      SELECT DISTINCT source, metric, tenant, event_type, prom, replica, usr, ext_prom, ext_region
      FROM s JOIN x USING (source) WHERE {SQL_NOT_VIEW}),
    o AS (SELECT source, {FINAL_TEXT} AS labels_s, row_number() OVER (ORDER BY {SQL_PAIRS}, source) - 1 AS place
      FROM (SELECT DISTINCT source, metric, event_type, prom, usr, ext_prom, ext_region FROM m))
    SELECT source, labels_s, place FROM o WHERE place < 100"""
)
def series_places(t):
    """The place of each of the first series in the order of the answer itself."""
    found = federation(t).series_metadata(NOT_VIEW, START, END)
    unlike = found.select("source", L.canonical(F.col("labels")).alias("labels_c")).distinct()
    first = limit_series(unlike.withColumn("labels", F.map_from_entries("labels_c")), 100)
    return flat(first.coalesce(1).withColumn("place", F.monotonically_increasing_id()), "place")


@query(f"WITH {SQL_BOTH} SELECT event_id, source, {STORED_TEXT} AS labels_s, ts_ms, value FROM s")
def store_append(t):
    """A store that is written in two halves by day holds both."""
    place, half = f"{shared_dir(t.spark)}/samples", START + 15 * DAY
    write_samples(t.samples().filter(F.col("ts_ms") < half), place)
    write_samples(t.samples().filter(F.col("ts_ms") >= half), place)
    stored_text = L.text(F.col("labels")).alias("labels_s")
    return read_samples(t.spark, place).select("event_id", "source", stored_text, "ts_ms", "value")


# -- the same by a label index


def indexed(t, samples=None):
    """Samples with their series table and label index, in the shared folder."""
    hot = ["__name__", "event_type"]
    if samples is None:
        place = written_once(t, "indexed", lambda place: write_store(t.samples(), place, hot=hot))
    else:
        place = shared_dir(t.spark)
        write_store(samples, place, hot=hot)
    found = read_samples(t.spark, f"{place}/samples", START - 1, END)
    return replace(
        federation(t, samples=found),
        series=read_series(t.spark, f"{place}/series"),
        index=LabelIndex.read(t.spark, f"{place}/index"),
    )


@query(
    f"WITH {SQL_BOTH}, {SQL_EXTERNAL}, "
    + SQL_NAMES.format(
        where=f"event_type <> 'view' AND usr LIKE 'u1%' AND ts_ms BETWEEN {START + 5 * DAY + 1} AND {START + 20 * DAY + DAY // 3}",
        dropped="'__tenant_id__', 'replica'",
    )
)
def indexed_names(t):
    """Label names off the index, for a range that begins and ends within a day."""
    chosen = selector(("event_type", "!=", "view"), ("user", "=~", "u1.*"))
    return indexed(t).label_names(chosen, START + 5 * DAY + 1, START + 20 * DAY + DAY // 3)


HOURS = (START + 9 * DAY + DAY // 4, START + 9 * DAY + DAY // 2)


@query(
    f"WITH {SQL_BOTH}, {SQL_EXTERNAL} SELECT DISTINCT usr AS value FROM s JOIN x USING (source) "
    f"WHERE ext_region = 'eu' AND (ext_prom IS NOT NULL OR coalesce(prom, '') <> 'prom-1') "
    f"AND regexp_full_match(event_type, '.*(lick|rchase)') AND ts_ms BETWEEN {HOURS[0]} AND {HOURS[1]}"
)
def indexed_values(t):
    """Label values off the index; some sources own a label of the selector, others do not; six hours of a day."""
    chosen = selector(("region", "=", "eu"), ("prometheus", "!=", "prom-1"), ("event_type", "=~", ".*(lick|rchase)"))
    return indexed(t).label_values("user", chosen, *HOURS)


@query(SQL_SELECT)
def indexed_select(t):
    """The series request, its selector resolved by postings."""
    return flat_chunks(indexed(t).select_series(NOT_VIEW, START, END))


@query(
    f"""WITH {SQL_BOTH}, {SQL_EXTERNAL} SELECT event_id, source, metric FROM s JOIN x USING (source)
    WHERE regexp_full_match(event_type, '.+urchas.') AND NOT regexp_full_match(usr, 'u[0-9]*[3-5]')
      AND NOT regexp_full_match(coalesce(replica, ''), 'a|c+') AND regexp_full_match(metric, 'event_(value|nothing)')"""
)
def matcher_re_dictionary(t):
    """Patterns are tried on the values of the dictionary; samples are read for the ids found."""
    chosen = selector(
        ("event_type", "=~", ".+urchas."), ("user", "!~", "u[0-9]*[3-5]"), ("replica", "!~", "a|c+"),
        ("__name__", "=~", "event_(value|nothing)"),
    )
    return indexed(t).hits(chosen).select("event_id", "source", F.col("name").alias("metric"))


@query(
    f"""WITH {SQL_VALUES}, {SQL_EXTERNAL}, m AS (
      SELECT DISTINCT source, metric, event_type, ext_prom, ext_region, CAST(NULL AS VARCHAR) AS usr, CAST(NULL AS VARCHAR) AS prom
      FROM s JOIN x USING (source) WHERE ts_ms BETWEEN {HOURS[0]} AND {HOURS[0] + 900_000})
    SELECT source, {FINAL_TEXT} AS labels_s FROM m"""
)
def metadata_exact(t):
    """Few series with samples all day long: those that pause for a quarter of an hour are not there for it."""
    few = t.by_type().drop("labels_c")
    return flat(indexed(t, few).series_metadata(selector(("__name__", "=", "event_value")), HOURS[0], HOURS[0] + 900_000))


@query(SQL_SELECT)
def stored_select_bucketed(t):
    """The series request by more ids than are sent to all tasks: samples in buckets stay where they lie."""
    place, name = shared_dir(t.spark), f"samples_{uuid.uuid4().hex}"
    buckets = buckets_for(t.samples(), 4)
    write_bucketed(t.samples(), name, f"{place}/samples", buckets, ["__name__", "event_type"])
    samples = read_bucketed(t.spark, name, START - 1, END)
    write_series(samples, f"{place}/series")
    fed = replace(federation(t, samples=samples), series=read_series(t.spark, f"{place}/series"), broadcast_ids=0, buckets=buckets)
    return flat_chunks(fed.select_series(NOT_VIEW, START, END))


# -- from stored hours


def rolled_up(t):
    samples, table = stored(t)
    place = written_once(t, "hours", lambda place: write_rollups(samples, place, START - DAY, END + DAY))
    return replace(federation(t, samples=samples), series=table, rollups=read_rollups(t.spark, place))


SHIFT = 1234
SQL_SHIFTED_RATES = SQL_RATES.replace(f"SELECT {START} + i", f"SELECT {START + 1000 * SHIFT} + i")


@query(SQL_SHIFTED_RATES)
def rate_from_blocks(t):
    """Rates from the summaries of hours; the grid cuts an hour in six, whose samples are read."""
    answer = rolled_up(t).rate(RATES, START // 1000 + SHIFT, END // 1000 + SHIFT, RATE_STEP // 1000, RATE_WINDOW)
    return flat(answer, "ts_ms", F.round("value", 9).alias("value"))


@query(SQL_RATES)
def rate_from_whole_blocks(t):
    """The grid is one of whole hours, so no samples are read."""
    return rates(rolled_up(t))


LATE = 7 * 3600


@query(
    f"""WITH {SQL_BOTH.replace("s AS (SELECT * FROM v", "a AS (SELECT * FROM v")}, {SQL_EXTERNAL},
    s AS (SELECT a.* FROM a JOIN x USING (source) WHERE {SQL_NOT_VIEW}), {sql_grid(SERIES, LATE * 1000, 2 * DAY)}
    SELECT source, {FINAL_TEXT} AS labels_s, at_ms AS ts_ms, value FROM g JOIN x USING (source)"""
)
def range_from_blocks(t):
    """The last samples of hours answer for a grid of seven hours and a lookback of two days."""
    return flat(rolled_up(t).query_range(NOT_VIEW, START // 1000, END // 1000, LATE, 2 * DAY), "ts_ms", "value")


# -- pages


SQL_PAGE = SQL_SELECT_LIMIT.replace("LIMIT 40", "LIMIT 15 OFFSET 15")


@query(SQL_PAGE)
def series_page_2(t):
    """The second page of a series request, from the cursor of the first."""
    fed = federation(t)
    first = fed.series_page(NOT_VIEW, START, END, 15)
    last = first.agg(F.max("cursor").alias("cursor")).first()["cursor"]
    return flat_chunks(fed.series_page(NOT_VIEW, START, END, 15, last))
