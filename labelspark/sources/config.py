"""The source table: ids, external labels, tenants, and checks of label rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelspark.functions import labels as L

# Fixed value: the name of the source where none is configured.
DEFAULT_SOURCE = "backend"
CONFIG_TYPE = "global struct<external_labels: map<string,string>>"


def literal_sources(spark: SparkSession, sources: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """A source table from configured external labels.

    Without any source there is one default source without external labels.
    """
    rows = [
        F.struct(F.lit(name).alias("source"), L.label_map(dict(labels)).alias("external_labels"))
        for name, labels in (sources or {DEFAULT_SOURCE: {}}).items()
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def normalize_sources(sources: DataFrame) -> DataFrame:
    """Missing external labels become the empty set; no row at all, one default source."""
    external = F.coalesce("external_labels", L.no_labels())
    given = sources.select("source", external.alias("external_labels"))
    default = given.sparkSession.range(0, 1, 1, 1).select(
        F.lit(DEFAULT_SOURCE).alias("source"), L.no_labels().alias("external_labels")
    )
    found = given.limit(1).exists()
    return given.unionByName(default.filter(~found))


def sources_from_ids(
    ids: DataFrame,
    id_column: str = "source",
    *,
    static: Mapping[str, str] | None = None,
    label: str = "prometheus",
    prefix: str = "",
) -> DataFrame:
    """One source per distinct trimmed id, with a derived label over static ones."""
    names = ids.select(F.trim(id_column).alias("source")).filter("source <> ''").distinct()
    derived = F.create_map(F.lit(label), F.concat(F.lit(prefix), F.col("source")))
    return names.withColumn("external_labels", L.overlay(L.label_map(dict(static or {})), derived))


def ids_in_order(ids: Sequence[str]) -> list[str]:
    """Configured ids, trimmed, without empty and repeated ones, in the order given."""
    return list(dict.fromkeys(i.strip() for i in ids if i.strip()))


def external_labels_from_config(configs: DataFrame, config: str = "config") -> DataFrame:
    """External labels out of each source's configuration document (JSON text).

    No such section gives the empty set; text that is no JSON is an error.
    """
    parsed = F.from_json(config, CONFIG_TYPE, {"mode": "FAILFAST"})
    found = F.coalesce(parsed["global"]["external_labels"], L.no_labels())
    return configs.withColumn("external_labels", found).drop(config)


def split_tenants(df: DataFrame, field: str = "tenant_field") -> DataFrame:
    """One row per tenant of a ``a|b`` field; none left, one default source."""
    parts = F.transform(F.split(F.coalesce(field, F.lit("")), r"[|]"), lambda p: F.trim(p))
    tenant = F.explode_outer(F.filter(parts, lambda p: p != ""))
    return df.withColumn("tenant", tenant).withColumn(
        "tenant", F.coalesce("tenant", F.lit(DEFAULT_SOURCE))
    )


def label_problems(df: DataFrame, labels: str = "external_labels", *carry: str) -> DataFrame:
    """Labels that break the rules of external labels, with the reason."""
    pairs = df.select(*carry, F.explode(labels).alias("name", "value"))
    return pairs.withColumn("problem", external_label_problem(F.col("name"), F.col("value"))).filter(
        "problem IS NOT NULL"
    )


def external_label_problem(name: Column, value: Column) -> Column:
    """Null for a good external label, else what is wrong with it."""
    return (
        F.when(F.trim(name) == "", "empty name")
        .when(~L.valid_plain_name(F.trim(name)), "invalid name")
        .when(F.coalesce(F.trim(value), F.lit("")) == "", "empty value")
        .when(~F.is_valid_utf8(value), "invalid value")
    )


SOURCES_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("external_labels", T.MapType(T.StringType(), T.StringType())),
    ]
)


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """A stored source table."""
    return normalize_sources(spark.read.schema(SOURCES_SCHEMA).parquet(path))
