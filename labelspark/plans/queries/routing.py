"""Routing by external labels, and what comes out of many sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.operators import routing, series
from labelspark.operators.matchers import matching, selector
from labelspark.operators.projection import finish_labels, with_text
from labelspark.plans.registry import query
from labelspark.plans.tables import (
    DROPPED,
    END,
    EXTERNAL_NAMES,
    OVERLAID_TEXT,
    SQL_BOTH,
    SQL_EXTERNAL,
    SQL_SUPPLIERS,
    SQL_VALUES,
    SUPPLIER_TEXT,
    sql_text,
)
from labelspark.sources.config import normalize_sources

PLACE = selector(("region", "=~", "EUROPE|ASIA"), ("nation", "!=", "NATION_3"), ("flag", "=", "R"))
SQL_PLACE = (
    "(coalesce(region, '') = '' OR region IN ('EUROPE', 'ASIA')) AND (coalesce(nation, '') = '' OR nation <> 'NATION_3')"
)
OTHER = selector(("nation", "!~", "NATION_1.*"), ("status", "=", "O"))
SQL_OTHER = "(coalesce(nation, '') = '' OR NOT regexp_full_match(nation, 'NATION_1.*', 's'))"


def supplier_sources(t):
    return normalize_sources(t.suppliers())


def told(sources):
    return sources.select("source", L.text(F.col("external_labels")).alias("labels_s"))


@query(f"WITH {SQL_SUPPLIERS} SELECT source, {SUPPLIER_TEXT} AS labels_s FROM u WHERE {SQL_PLACE}")
def route_sources(t):
    return told(routing.routed(supplier_sources(t), PLACE))


@query(f"WITH {SQL_SUPPLIERS} SELECT source, {SUPPLIER_TEXT} AS labels_s FROM u WHERE NOT ({SQL_PLACE})")
def unrouted_sources(t):
    return told(routing.unrouted(supplier_sources(t), PLACE))


@query(f"WITH {SQL_SUPPLIERS} SELECT source, {SUPPLIER_TEXT} AS labels_s FROM u WHERE {SQL_PLACE} AND {SQL_OTHER}")
def route_multi_selector(t):
    return told(routing.routed(supplier_sources(t), PLACE, OTHER))


@query(
    f"WITH {SQL_SUPPLIERS} SELECT l_orderkey, l_linenumber, source, l_extendedprice AS value FROM lineitem "
    f"JOIN u ON s_suppkey = l_suppkey WHERE {SQL_PLACE}"
)
def route_semi(t):
    kept = routing.keep_routed(t.shipments(), supplier_sources(t), PLACE)
    return kept.select("l_orderkey", "l_linenumber", "source", "value")


@query(
    f"WITH {SQL_SUPPLIERS} SELECT l_orderkey, l_linenumber, source, l_extendedprice AS value FROM lineitem "
    "JOIN u ON s_suppkey = l_suppkey WHERE coalesce(region, '') IN ('EUROPE', 'ASIA') "
    "AND coalesce(nation, '') <> 'NATION_3' AND l_returnflag = 'R'"
)
def federated_select(t):
    """Routing, stripping and plain matching in one pass over line items.

    Suppliers without external labels are asked with all matchers, and their
    line items have no region.
    """
    hits = routing.federate(t.shipments(), supplier_sources(t), PLACE, external_names={"nation", "region"})
    return hits.select("l_orderkey", "l_linenumber", "source", "value")


@query(
    f"WITH {SQL_VALUES}, {SQL_EXTERNAL} SELECT event_id, source, ts_ms, value FROM s JOIN x USING (source) "
    "WHERE regexp_full_match(coalesce(ext_prom, prom, ''), 'prom-.|from-.*|', 's') AND coalesce(ext_region, '') <> 'us' "
    "AND event_type = 'click'"
)
def effective_match(t):
    """A source without the external label gets the matcher as a plain one."""
    chosen = selector(("prometheus", "=~", "prom-.|from-.*|"), ("region", "!=", "us"), ("event_type", "=", "click"))
    hits = routing.federate(t.values(), t.sources(), chosen, external_names=EXTERNAL_NAMES)
    return hits.select("event_id", "source", "ts_ms", "value")


@query(
    f"WITH {SQL_VALUES}, {SQL_EXTERNAL} SELECT event_id, source, ts_ms, value FROM s JOIN x USING (source) "
    "WHERE coalesce(ext_prom, prom, '') = 'from-backend' AND event_type <> 'click'"
)
def effective_match_stored(t):
    """src-0 stores this value too, but owns the label and so is routed out."""
    chosen = selector(("prometheus", "=", "from-backend"), ("event_type", "!=", "click"))
    return routing.federate(t.values(), t.sources(), chosen).select("event_id", "source", "ts_ms", "value")


@query(
    f"WITH {SQL_BOTH}, {SQL_EXTERNAL} SELECT event_id, source, {OVERLAID_TEXT} AS labels_s, ts_ms, value "
    "FROM s JOIN x USING (source)"
)
def attach_external(t):
    named = finish_labels(routing.attach_external(t.samples(), t.sources()))
    return with_text(named).select("event_id", "source", "labels_s", "ts_ms", "value")


@query(
    f"WITH {SQL_SUPPLIERS} SELECT source, '{{}}' AS labels_s, CAST({END} AS BIGINT) AS ts_ms, "
    f"(SELECT max(value) FROM events) AS value FROM u WHERE {SQL_PLACE}"
)
def scalar_per_source(t):
    """A scalar comes once per routed source."""
    highest = t.values().agg(F.max("value")).scalar()
    rows = routing.scalar_rows(supplier_sources(t), highest, END, PLACE)
    return with_text(rows).select("source", "labels_s", "ts_ms", "value")


UNION_TEXT = sql_text(
    ("__name__", "metric"),
    ("event_type", "event_type"),
    ("prometheus", "coalesce(ext_prom, prom)"),
    ("region", "ext_region"),
)


@query(
    f"""WITH {SQL_VALUES}, {SQL_EXTERNAL}, m AS (
      SELECT DISTINCT source, metric, tenant, event_type, prom, replica, usr FROM s UNION ALL
      SELECT DISTINCT 'src-' || (o_custkey % 4), 'order_price', NULL, o_orderstatus, NULL,
             CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END, 'c' || o_custkey FROM orders)
    SELECT source, {UNION_TEXT} AS labels_s FROM m JOIN x USING (source)"""
)
def federated_union_all(t):
    """Series of two tables; those that become equal by a drop stay separate rows."""
    columns = ("source", "labels_c")
    parts = [series.series_metadata(series.with_identity(p), columns) for p in (t.values(), t.order_totals())]
    both = series.labels_back(parts[0].unionByName(parts[1]))
    named = finish_labels(routing.attach_external(both, t.sources()), DROPPED, ["user"])
    return with_text(named).select("source", "labels_s")


@query(
    f"WITH {SQL_VALUES}, {SQL_EXTERNAL} SELECT r AS region, count(event_id) AS n FROM (VALUES ('mars'), ('eu')) g(r) "
    "LEFT JOIN (SELECT event_id, ext_region FROM s JOIN x USING (source)) ON ext_region = r GROUP BY ALL"
)
def no_route(t):
    """Where no source accepts the matcher the answer is empty and no error, beside one that has a route."""
    owners = t.sources().filter(F.col("external_labels")["region"].isNotNull())

    def count(region):
        chosen = selector(("region", "=", region), ("__name__", "=", "event_value"))
        hits = routing.federate(t.values(), owners, chosen)
        return hits.agg(F.count("*").alias("n")).select(F.lit(region).alias("region"), "n")

    return count("mars").unionByName(count("eu"))


@query(f"WITH {SQL_BOTH} SELECT source, metric, count(*) AS n FROM s WHERE usr <> '' GROUP BY ALL")
def scan_counts(t):
    """Counting reads no label map and no values."""
    rows = matching(t.samples(), selector(("__name__", "=~", ".+")))
    return rows.groupBy("source", F.col("name").alias("metric")).agg(F.count("*").alias("n"))
