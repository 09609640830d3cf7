"""Scalar rules: steps, times, tenants, configuration and label checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.functions import steps, times
from labelspark.plans.registry import query
from labelspark.plans.tables import START
from labelspark.sources import config as config_tables

SQL_REQUESTS = f"""q AS (
  SELECT event_id,
         CAST(CASE event_id % 3 WHEN 0 THEN 15000 WHEN 1 THEN 0 ELSE NULL END AS BIGINT) AS hint_ms,
         CAST(CASE event_id % 5 WHEN 0 THEN 30000 WHEN 1 THEN -1 ELSE 0 END AS BIGINT) AS step_ms,
         CASE event_id % 2 WHEN 0 THEN 120000000000 ELSE 0 END AS fallback_ns,
         {START} AS start_ms, epoch_us(ts) // 1000 - (user_id % 3) * 1296000000 AS end_ms,
         CASE event_id % 4 WHEN 0 THEN 11000 WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE user_id + 2 END AS max_points
  FROM events)"""


def requests(t):
    """One request per event; some ranges end before they start."""
    pick = F.col("event_id")
    return t.table("events").select(
        "event_id",
        F.when(pick % 3 == 0, 15_000).when(pick % 3 == 1, 0).cast("bigint").alias("hint_ms"),
        F.when(pick % 5 == 0, 30_000).when(pick % 5 == 1, -1).otherwise(0).cast("bigint").alias("step_ms"),
        F.when(pick % 2 == 0, 120_000_000_000).otherwise(0).cast("bigint").alias("fallback_ns"),
        F.lit(START).alias("start_ms"),
        (times.to_millis(F.col("ts")) - F.col("user_id") % 3 * 1_296_000_000).alias("end_ms"),
        F.when(pick % 4 == 0, 11_000)
        .when(pick % 4 == 1, 0)
        .when(pick % 4 == 2, 1)
        .otherwise(F.col("user_id") + 2)
        .alias("max_points"),
    )


SQL_STEP = (
    "CASE WHEN hint_ms > 0 THEN hint_ms * 1000000 WHEN step_ms > 0 THEN step_ms * 1000000 "
    "WHEN fallback_ns > 0 THEN fallback_ns ELSE 60000000000 END"
)
SQL_LEAST = (
    "CASE WHEN max_points <= 0 OR end_ms <= start_ms THEN 0 WHEN max_points = 1 THEN (end_ms - start_ms) * 1000000 "
    "ELSE ((end_ms - start_ms) * 1000000 + max_points - 2) // (max_points - 1) END"
)
CHOSEN = ("hint_ms", "step_ms", "fallback_ns")


@query(f"WITH {SQL_REQUESTS} SELECT event_id, CAST({SQL_STEP} AS BIGINT) AS step_ns FROM q")
def step_choice(t):
    return requests(t).select("event_id", steps.step_choice(*map(F.col, CHOSEN)).alias("step_ns"))


@query(f"WITH {SQL_REQUESTS} SELECT event_id, CAST({SQL_LEAST} AS BIGINT) AS step_ns FROM q")
def min_step(t):
    span = (F.col("end_ms") - F.col("start_ms")) * steps.NANOS
    return requests(t).select("event_id", steps.min_step(span, F.col("max_points")).alias("step_ns"))


@query(f"WITH {SQL_REQUESTS} SELECT event_id, CAST(greatest({SQL_STEP}, {SQL_LEAST}) AS BIGINT) AS step_ns FROM q")
def step_clamped(t):
    clamped = steps.step_clamped(
        steps.step_choice(*map(F.col, CHOSEN)), F.col("start_ms"), F.col("end_ms"), F.col("max_points")
    )
    return requests(t).select("event_id", clamped.alias("step_ns"))


STAMP = "yyyy-MM-dd HH:mm:ss.SSS"


@query(
    "SELECT event_id, m AS ts_ms, strftime(make_timestamp(m * 1000), '%Y-%m-%d %H:%M:%S.%g') AS stamp, m AS again_ms "
    f"FROM (SELECT event_id, epoch_us(ts) // 1000 - (event_id % 2) * {START + 2_500_000_000_000} AS m FROM events)"
)
def millis_time(t):
    """There and back again, half of the times before 1970."""
    ms = times.to_millis(F.col("ts")) - F.col("event_id") % 2 * (START + 2_500_000_000_000)
    rows = t.table("events").select("event_id", ms.alias("ts_ms"))
    moment = times.from_millis(F.col("ts_ms"))
    stamp = F.date_format(in_utc(moment), STAMP).alias("stamp")
    return rows.select("event_id", "ts_ms", stamp, F.unix_millis(moment).alias("again_ms"))


def in_utc(moment):
    """A timestamp that the session's time zone shows as UTC."""
    return F.to_utc_timestamp(moment, F.current_timezone())


@query(
    "SELECT event_id, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS stamp, s AS again_s "
    "FROM (SELECT event_id, epoch_us(ts) // 1000000 AS s FROM events)"
)
def seconds_time(t):
    seconds = times.floor_div(times.to_millis(F.col("ts")), 1000)
    moment = times.from_seconds(seconds)
    stamp = F.date_format(in_utc(moment), "yyyy-MM-dd HH:mm:ss").alias("stamp")
    return t.table("events").select("event_id", stamp, F.unix_seconds(moment).alias("again_s"))


@query(
    """WITH f AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'tenant-' || user_id || '| ' || event_type || ' ||'
        WHEN 1 THEN ' | ' ELSE event_type END AS field FROM events),
    p AS (SELECT event_id, unnest(list_filter(list_transform(string_split(field, '|'), lambda x: trim(x)), lambda x: x <> '')) AS tenant FROM f)
    SELECT event_id, tenant FROM p UNION ALL SELECT event_id, 'backend' FROM f WHERE trim(replace(field, '|', '')) = ''"""
)
def tenant_split(t):
    pick = F.col("event_id") % 3
    field = (
        F.when(pick == 0, F.concat(F.lit("tenant-"), "user_id", F.lit("| "), "event_type", F.lit(" ||")))
        .when(pick == 1, " | ")
        .otherwise(F.col("event_type"))
    )
    fields = t.table("events").select("event_id", field.alias("tenant_field"))
    return config_tables.split_tenants(fields).select("event_id", "tenant")


@query(
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{}' ELSE '{k="' || regexp_extract(props, '\\d+') || '", region="' ||
    event_type || '"}' END AS labels_s FROM events"""
)
def external_labels_from_config(t):
    """One configuration document per event; every third lacks the section."""
    section = F.concat(
        F.lit('{"global": {"scrape_interval": "1m", "external_labels": {"region": "'),
        "event_type",
        F.lit('", '),
        F.substring_index(F.substring_index("props", "{", -1), "}", 1),
        F.lit("}}}"),
    )
    config = F.when(F.col("event_id") % 3 == 0, '{"global": {"scrape_interval": "1m"}}').otherwise(section)
    configs = t.table("events").select("event_id", config.alias("config"))
    found = config_tables.external_labels_from_config(configs)
    return found.select("event_id", L.text(F.col("external_labels")).alias("labels_s"))


@query(
    """WITH l AS (SELECT p_partkey, unnest([p_name, lower(p_type), '']) AS name,
                         unnest([p_brand, CASE WHEN p_size % 5 = 0 THEN ' ' ELSE p_type END, 'x']) AS value FROM part)
    SELECT * FROM (SELECT p_partkey, name, value, CASE WHEN name = '' THEN 'empty name'
      WHEN NOT regexp_full_match(name, '[a-zA-Z_][a-zA-Z0-9_]*') THEN 'invalid name'
      WHEN trim(value) = '' THEN 'empty value' END AS problem FROM l) WHERE problem IS NOT NULL"""
)
def label_validity(t):
    """Part names hold blanks, some values are blank, and one name is empty."""
    labels = F.map_from_arrays(
        F.array(F.col("p_name"), F.lower("p_type"), F.lit("")),
        F.array(F.col("p_brand"), F.when(F.col("p_size") % 5 == 0, " ").otherwise(F.col("p_type")), F.lit("x")),
    )
    rows = t.table("part").select("p_partkey", labels.alias("external_labels"))
    return config_tables.label_problems(rows, "external_labels", "p_partkey")
