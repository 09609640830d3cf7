"""Projections on label sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.operators import catalog, projection, routing
from labelspark.plans.registry import query
from labelspark.plans.queries.routing import supplier_sources
from labelspark.plans.tables import (
    DROPPED,
    FINAL_TEXT,
    OVERLAID_TEXT,
    SQL_EXTERNAL,
    SQL_SUPPLIERS,
    SQL_VALUES,
    SUPPLIER_TEXT,
    sql_text,
)
from labelspark.sources.config import sources_from_ids


def _named(t, dropped=(), replica=()):
    rows = routing.attach_external(t.values(), t.sources())
    return projection.with_text(projection.finish_labels(rows, dropped, replica)).select("event_id", "labels_s")


@query(f"WITH {SQL_VALUES}, {SQL_EXTERNAL} SELECT event_id, {OVERLAID_TEXT} AS labels_s FROM s JOIN x USING (source)")
def label_overlay(t):
    return _named(t)


DROP_TEXT = sql_text(
    ("__name__", "metric"),
    ("event_type", "event_type"),
    ("region", "ext_region"),
    ("replica", "replica"),
    ("user", "usr"),
)


@query(f"WITH {SQL_VALUES}, {SQL_EXTERNAL} SELECT event_id, {DROP_TEXT} AS labels_s FROM s JOIN x USING (source)")
def label_drop(t):
    """A drop beats an external label; an empty name in the list means nothing."""
    return _named(t, ["__tenant_id__", "prometheus", ""])


@query(f"WITH {SQL_VALUES}, {SQL_EXTERNAL} SELECT event_id, {FINAL_TEXT} AS labels_s FROM s JOIN x USING (source)")
def replica_drop(t):
    return _named(t, DROPPED[:1], DROPPED[1:])


@query(
    f"WITH {SQL_VALUES} SELECT event_id, CASE WHEN prom IS NULL THEN '__name__,event_type,user' "
    "ELSE '__name__,event_type,prometheus,user' END AS names FROM s"
)
def drop_names(t):
    names = F.array_sort(F.map_keys("labels"))
    kept = projection.drop_names(names, [*DROPPED, ""])
    return t.values().select("event_id", F.array_join(kept, ",").alias("names"))


@query(
    f"""WITH {SQL_VALUES}, e AS (SELECT DISTINCT source, unnest([
        {{'n': 'event_type', 'v': event_type}}, {{'n': 'user', 'v': usr}}]) AS p FROM s)
    SELECT source, {sql_text(("aaa", "CASE WHEN p.n = 'event_type' THEN NULL END"), ("event_type", "CASE WHEN p.n = 'event_type' THEN p.v END"),
    ("region", "'global'"), ("user", "CASE WHEN p.n = 'user' THEN p.v END"))} AS labels_s FROM e"""
)
def extend_label_sets(t):
    announced = catalog.announce(t.values(), ["event_type", "user"], "source")
    extended = projection.extend_label_sets(announced, L.label_map({"region": "global"}))
    return projection.with_text(extended).select("source", "labels_s")


PRECEDENCE_TEXT = sql_text(
    ("cluster", "'c1'"),
    ("nation", "nation"),
    ("prometheus", "'sup/' || s_suppkey"),
    ("region", "'global'"),
)


@query(f"WITH {SQL_SUPPLIERS} SELECT source, {PRECEDENCE_TEXT} AS labels_s FROM u")
def external_precedence(t):
    """Configured labels, then static ones over them, then a derived one over both."""
    static = L.label_map({"cluster": "c1", "prometheus": "static", "region": "global"})
    derived = F.create_map(F.lit("prometheus"), F.concat(F.lit("sup/"), "s_suppkey"))
    configured = F.coalesce("external_labels", L.no_labels())
    merged = t.suppliers().withColumn("labels", projection.layered(configured, static, derived))
    return projection.with_text(merged).select("source", "labels_s")


@query(
    r"""SELECT doc_id, '{lang="' || lang || '", source="' || source || '", text="' ||
    replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(9), '\t'), chr(13), '\r')
    || '"}' AS labels_s FROM documents"""
)
def labels_string(t):
    """Whole documents as label values, escaped."""
    labels = L.label_map({"text": F.col("text"), "source": F.col("source"), "lang": F.col("lang")})
    return t.table("documents").select("doc_id", L.text(labels).alias("labels_s"))


@query(f"WITH {SQL_SUPPLIERS} SELECT source, {SUPPLIER_TEXT} AS labels_s FROM u WHERE nation IS NOT NULL")
def source_label_sets(t):
    return projection.with_text(catalog.source_label_sets(supplier_sources(t))).select("source", "labels_s")


@query(
    f"WITH {SQL_SUPPLIERS} SELECT source, {SUPPLIER_TEXT} AS labels_s, "
    "CAST(CASE WHEN nation IS NULL THEN 0 ELSE 2 END AS BIGINT) AS n_labels FROM u"
)
def sources_normalized(t):
    sources = supplier_sources(t)
    size = F.size("external_labels").cast("bigint").alias("n_labels")
    return sources.select("source", L.text(F.col("external_labels")).alias("labels_s"), size)


@query(
    """SELECT 'user ' || user_id AS source, '{prometheus="id-user ' || user_id || '", region="global"}' AS labels_s
    FROM events WHERE user_id % 7 <> 0 GROUP BY user_id"""
)
def sources_from_data(t):
    """Ids with blanks around them, empty ones and many repeats."""
    padded = F.concat(F.lit("  user "), "user_id", F.lit(" "))
    ids = t.table("events").select(F.when(F.col("user_id") % 7 == 0, "  ").otherwise(padded).alias("source"))
    static = {"prometheus": "static", "region": "global"}
    sources = sources_from_ids(ids, static=static, prefix="id-")
    return sources.select("source", L.text(F.col("external_labels")).alias("labels_s"))
