"""Label names, label values and the catalogue of label sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.operators import catalog, discovery, series
from labelspark.operators.matchers import selector
from labelspark.plans.federation import Federation
from labelspark.plans.registry import query
from labelspark.plans.queries.routing import supplier_sources
from labelspark.plans.tables import (
    DAY,
    DROPPED,
    END,
    EXTERNAL_NAMES,
    SQL_BOTH,
    SQL_EXTERNAL,
    SQL_SUPPLIERS,
    SQL_VALUES,
    START,
    STORED_TEXT,
    SUPPLIER_TEXT,
    sql_text,
)

SQL_NAMES = """n AS (
  SELECT DISTINCT unnest(['__name__', '__tenant_id__', 'event_type', 'user',
    CASE WHEN prom IS NOT NULL OR ext_prom IS NOT NULL THEN 'prometheus' END,
    CASE WHEN ext_region IS NOT NULL THEN 'region' END,
    CASE WHEN replica IS NOT NULL THEN 'replica' END]) AS name
  FROM s JOIN x USING (source) WHERE {where})
SELECT name FROM n WHERE name IS NOT NULL AND name NOT IN ({dropped})"""


@query(f"WITH {SQL_BOTH}, {SQL_EXTERNAL}, " + SQL_NAMES.format(where="true", dropped="''"))
def label_names_all(t):
    return discovery.label_names(t.samples(), t.sources())


@query(
    f"WITH {SQL_BOTH}, {SQL_EXTERNAL}, "
    + SQL_NAMES.format(
        where="metric = 'events_total' AND coalesce(ext_region, '') IN ('', 'us')",
        dropped="'__tenant_id__', 'replica'",
    )
)
def label_names(t):
    """External names come from sources with a hit only, dropped ones never."""
    chosen = selector(("__name__", "=", "events_total"), ("region", "=~", "|us"))
    return discovery.label_names(
        t.samples(), t.sources(), chosen, dropped=DROPPED[:1], replica=DROPPED[1:], external_names=EXTERNAL_NAMES
    )


@query(f"WITH {SQL_BOTH} SELECT DISTINCT usr AS value FROM s WHERE metric = 'event_value' AND event_type = 'error'")
def label_values(t):
    chosen = selector(("__name__", "=", "event_value"), ("event_type", "=", "error"))
    return discovery.label_values(t.samples(), t.sources(), "user", chosen, external_names=EXTERNAL_NAMES)


@query(
    f"WITH {SQL_BOTH}, {SQL_EXTERNAL} SELECT ext_prom AS value FROM x WHERE ext_prom IS NOT NULL UNION "
    "SELECT prom FROM s JOIN x USING (source) WHERE ext_prom IS NULL AND prom IS NOT NULL AND event_type = 'click'"
)
def label_values_owned(t):
    """Configured values of owning sources, whatever the other matchers say, and stored ones of the rest."""
    chosen = selector(("event_type", "=", "click"))
    return discovery.label_values(t.samples(), t.sources(), "prometheus", chosen)


@query(
    f"WITH {SQL_SUPPLIERS} SELECT region AS value FROM u WHERE region IS NOT NULL AND region <> 'ASIA' GROUP BY 1"
)
def label_values_routed(t):
    """Suppliers own their region, so line items are asked only of the others, which have none."""
    chosen = selector(("region", "!=", "ASIA"), ("flag", "=", "R"))
    return discovery.label_values(
        t.shipments(), supplier_sources(t), "region", chosen, external_names={"nation", "region"}
    )


@query(
    f"WITH {SQL_VALUES} SELECT 'event_type' AS label, event_type AS value FROM s GROUP BY ALL "
    "UNION ALL SELECT 'user', usr FROM s GROUP BY ALL"
)
def label_values_dropped(t):
    """Values of three labels, of which the dropped one has none."""
    found = [
        discovery.label_values(t.values(), t.sources(), label, replica=["replica"]).select(
            F.lit(label).alias("label"), "value"
        )
        for label in ("event_type", "replica", "user")
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    f"WITH {SQL_BOTH}, {SQL_EXTERNAL}, "
    + SQL_NAMES.format(where=f"ts_ms >= {START + 29 * DAY} AND event_type = 'click'", dropped="'__tenant_id__'")
)
def label_names_since(t):
    """Only the start of the range is given."""
    fed = Federation(t.samples(), t.sources(), ("__tenant_id__",), external_names=EXTERNAL_NAMES)
    return fed.label_names(selector(("event_type", "=", "click")), start=START + 29 * DAY)


@query(f"WITH {SQL_BOTH} SELECT DISTINCT source, {STORED_TEXT} AS labels_s FROM s")
def series_metadata(t):
    found = series.series_metadata(series.with_identity(t.samples()))
    return found.select("source", L.text_of_pairs(F.col("labels_c")).alias("labels_s"))


ANNOUNCED = ("prometheus", "event_type", "region")
SQL_ANNOUNCED = """e AS (
  SELECT DISTINCT {by} unnest(['prometheus', 'event_type']) AS label, unnest([prom, event_type]) AS value
  FROM s {where})
SELECT {by} '{{' || label || '="' || value || '"}}' AS labels_s FROM e WHERE value <> ''"""


@query("SELECT DISTINCT '{prometheus=\"' || lang || '\"}' AS labels_s FROM documents WHERE lang <> ''")
def announce_values(t):
    return catalog.announce_values(t.table("documents"), "prometheus", F.col("lang")).select("labels_s")


@query(f"WITH {SQL_BOTH}, " + SQL_ANNOUNCED.format(by="source,", where=""))
def announce_labels(t):
    return catalog.announce(t.samples(), ANNOUNCED, "source").select("source", "labels_s")


@query(f"WITH {SQL_BOTH}, " + SQL_ANNOUNCED.format(by="", where=""))
def announce_sources(t):
    return catalog.announce(t.samples(), ANNOUNCED).select("labels_s")


@query(
    f"WITH {SQL_VALUES}, "
    + SQL_ANNOUNCED.format(by="", where=f"WHERE ts_ms BETWEEN {END - 10 * DAY} AND {END}")
)
def announce_lookback(t):
    recent = catalog.within_lookback(t.values(), END, 10 * DAY)
    return catalog.announce(recent, ANNOUNCED).select("labels_s")


BOUNDS = f"CAST({catalog.MIN_TIME} AS BIGINT) AS min_time, CAST({catalog.MAX_TIME} AS BIGINT) AS max_time"


def told(df):
    return df.select(
        "source",
        L.text(F.col("labels")).alias("labels_s"),
        L.text(F.col("bound_labels")).alias("bounds_s"),
        "min_time",
        "max_time",
    )


CATALOG_TEXT = sql_text(
    ("event_type", "CASE WHEN label = 'event_type' THEN value END"),
    ("prometheus", "coalesce(ext_prom, CASE WHEN label = 'prometheus' THEN value END)"),
    ("region", "ext_region"),
)


@query(
    f"""WITH {SQL_VALUES}, {SQL_EXTERNAL}, e AS (
      SELECT DISTINCT source, unnest(['prometheus', 'event_type']) AS label, unnest([prom, event_type]) AS value FROM s)
    SELECT source, {CATALOG_TEXT} AS labels_s, {CATALOG_TEXT} AS bounds_s, {BOUNDS}
    FROM e JOIN x USING (source) WHERE value <> ''"""
)
def catalog_announced(t):
    announced = catalog.announce(t.values(), ANNOUNCED, "source")
    return told(catalog.catalog(t.sources(), announced))


@query(
    f"WITH {SQL_SUPPLIERS} SELECT source, {SUPPLIER_TEXT} AS labels_s, {SUPPLIER_TEXT} AS bounds_s, {BOUNDS} "
    "FROM u WHERE nation IS NOT NULL"
)
def catalog_external(t):
    """Nothing announced: sources show their external labels."""
    return told(catalog.catalog(_placed(t), _nothing_announced(t)))


@query(
    f"""WITH {SQL_SUPPLIERS} SELECT source, '{{"query-backend"="' || source || '"}}' AS labels_s, '{{}}' AS bounds_s,
    {BOUNDS} FROM u WHERE nation IS NULL"""
)
def catalog_fallback(t):
    """Neither announced nor external labels: a set with the name of the source."""
    bare = supplier_sources(t).filter(F.size("external_labels") == 0)
    return told(catalog.catalog(bare, _nothing_announced(t)))


def _placed(t):
    return supplier_sources(t).filter(F.size("external_labels") > 0)


def _nothing_announced(t):
    """Line items carry no label of this name, so no source announces it."""
    return catalog.announce(t.shipments(), ["datacenter"], "source")
