"""Matchers, selectors and time ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.operators import align, series
from labelspark.operators.matchers import Matcher, matching, selector
from labelspark.operators.routing import federate
from labelspark.plans.registry import query
from labelspark.plans.tables import DAY, END, SQL_BOTH, SQL_EXTERNAL, SQL_VALUES, START, STORED_TEXT

ROW = ("event_id", "ts_ms", "value")
SQL_ROW = "SELECT event_id, ts_ms, value FROM s WHERE"


@query(f"WITH {SQL_VALUES} {SQL_ROW} event_type = 'click'")
def matcher_eq(t):
    return matching(t.values(), selector(("event_type", "=", "click"))).select(*ROW)


@query(f"WITH {SQL_VALUES} {SQL_ROW} coalesce(prom, '') = ''")
def matcher_eq_absent(t):
    return matching(t.values(), selector(("prometheus", "=", ""))).select(*ROW)


@query(f"WITH {SQL_VALUES} {SQL_ROW} coalesce(prom, '') <> 'elsewhere' AND event_type <> 'view'")
def matcher_neq(t):
    chosen = selector(("prometheus", "!=", "elsewhere"), ("event_type", "!=", "view"))
    return matching(t.values(), chosen).select(*ROW)


@query(f"WITH {SQL_VALUES} {SQL_ROW} coalesce(prom, '') <> ''")
def matcher_neq_absent(t):
    return matching(t.values(), selector(("prometheus", "!=", ""))).select(*ROW)


@query(f"WITH {SQL_VALUES} {SQL_ROW} regexp_full_match(usr, 'u[13]\\d*', 's') AND event_type IN ('click', 'view')")
def matcher_re(t):
    chosen = selector(("user", "=~", r"u[13]\d*"), ("event_type", "=~", "click|view"))
    return matching(t.values(), chosen).select(*ROW)


@query(
    f"WITH {SQL_VALUES} {SQL_ROW} NOT regexp_full_match(coalesce(prom, ''), 'from-b.*x', 's') "
    "AND NOT regexp_full_match(usr, 'u.*7', 's') AND event_type NOT IN ('signup', 'error')"
)
def matcher_nre(t):
    chosen = selector(
        ("prometheus", "!~", "from-b.*x"), ("user", "!~", "u.*7"), ("event_type", "!~", "signup|error")
    )
    return matching(t.values(), chosen).select(*ROW)


@query(
    f"WITH {SQL_BOTH} SELECT event_id, metric, ts_ms, value FROM s WHERE metric = 'events_total' "
    "AND tenant <> 'tenant-0' AND regexp_full_match(event_type, 'c.*|p.*', 's') AND usr NOT IN ('u1', 'u3')"
)
def selector_and(t):
    chosen = selector(
        ("__name__", "=", "events_total"),
        ("__tenant_id__", "!=", "tenant-0"),
        ("event_type", "=~", "c.*|p.*"),
        ("user", "!~", "u1|u3"),
    )
    return matching(t.samples(), chosen).select("event_id", F.col("name").alias("metric"), "ts_ms", "value")


@query(f"WITH {SQL_VALUES} {SQL_ROW} event_type <> 'error'")
def selector_all(t):
    """An empty selector: every series that has a metric name."""
    return matching(t.values_partly_named(), selector()).select(*ROW)


@query(f"WITH {SQL_VALUES} {SQL_ROW} event_type = 'purchase' AND tenant = 'tenant-1'")
def selector_merge(t):
    base = selector(("event_type", "=", "purchase"))
    extra = [Matcher("=", "event_type", "purchase"), Matcher("=", "__tenant_id__", "tenant-1")]
    return matching(t.values(), base.merge(extra)).select(*ROW)


@query(
    f"WITH {SQL_VALUES}, {SQL_EXTERNAL} SELECT event_id, source, ts_ms, value FROM s JOIN x USING (source) "
    "WHERE ext_region = 'eu' AND event_type <> 'error'"
)
def query_select_all(t):
    """Only an external matcher: the sources that own the label give all named series."""
    hits = federate(t.values_partly_named(), t.sources(), selector(("region", "=", "eu")))
    return hits.select("event_id", "source", "ts_ms", "value")


LOW, HIGH = START + 7 * DAY, START + 21 * DAY


@query(f"WITH {SQL_VALUES} {SQL_ROW} ts_ms BETWEEN {LOW} AND {HIGH}")
def time_range(t):
    return series.in_range(t.values(), LOW, HIGH).select(*ROW)


@query(
    f"WITH {SQL_VALUES}, e AS (SELECT source, {STORED_TEXT} AS labels_s, count(*) AS n, min(ts_ms) AS first_ts, "
    f"max(ts_ms) AS last_ts FROM s GROUP BY ALL) SELECT * FROM e WHERE first_ts <= {HIGH} AND last_ts >= {LOW}"
)
def series_overlap(t):
    """The series table, and the series alive within a range."""
    alive = series.overlapping(series.series_table(series.with_identity(t.values())), LOW, HIGH)
    return alive.select("source", L.text_of_pairs(F.col("labels_c")).alias("labels_s"), "n", "first_ts", "last_ts")


STEP = DAY // 4


@query(
    f"""WITH {SQL_VALUES.replace("s AS", "r AS", 1)},
    s AS (SELECT source, event_type, 'event_value' AS metric, event_id, ts_ms, value FROM r),
    p AS (SELECT source, event_type, unnest(generate_series(
            greatest(0, -((({START}) - ts_ms) // {STEP})), (ts_ms + {DAY} - 1 - {START}) // {STEP})) AS i, ts_ms, value FROM s),
    g AS (SELECT source, event_type, i, arg_max(value, ts_ms) AS value FROM p
          WHERE i >= 0 AND {START} + i * {STEP} <= {END} AND {START} + i * {STEP} >= ts_ms
            AND {START} + i * {STEP} < ts_ms + {DAY} GROUP BY ALL)
    SELECT source, event_type, count(*) AS n, min({START} + i * {STEP}) AS first_ts,
           max({START} + i * {STEP}) AS last_ts
    FROM g WHERE value > 95 GROUP BY ALL"""
)
def skip_empty_series(t):
    """Nested series cut down to high values; those left without a sample go."""
    on_grid = align.range_select(t.by_type(), START, END, STEP, DAY, tiebreak="event_id")
    nested = series.labels_back(series.nest(on_grid))
    high = nested.withColumn("samples", F.filter("samples", lambda s: s["value"] > 95))
    left = series.skip_empty(high)
    times = F.col("samples.ts_ms")
    return left.select(
        "source",
        F.col("labels")["event_type"].alias("event_type"),
        F.size("samples").cast("bigint").alias("n"),
        F.array_min(times).alias("first_ts"),
        F.array_max(times).alias("last_ts"),
    )
