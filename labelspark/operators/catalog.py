"""The catalogue of label sets that a store tells about itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.operators.routing import attach_external
from labelspark.operators.series import in_range

# The time bounds of a label set that nothing limits.
MIN_TIME = -(2**63)
MAX_TIME = 2**63 - 1
FALLBACK_LABEL = "query-backend"


def lookback_range(now_ms: int, lookback_ms: int) -> tuple[int, int] | None:
    """``(now - lookback, now)``; no bounds for a lookback of zero."""
    if lookback_ms < 0:
        raise ValueError("a lookback reaches back, so it is not negative")
    return (now_ms - lookback_ms, now_ms) if lookback_ms else None


def within_lookback(samples: DataFrame, now_ms: int, lookback_ms: int) -> DataFrame:
    bounds = lookback_range(now_ms, lookback_ms)
    return samples if bounds is None else in_range(samples, *bounds)


def check_names(names: Sequence[str]) -> None:
    for name in names:
        try:
            valid = bool(name) and bool(name.encode("utf-8"))
        except UnicodeEncodeError:
            valid = False
        if not valid:
            raise ValueError(f"{name!r} can be no label name")


def announced_pairs(df: DataFrame, names: Sequence[str], *carry: str) -> DataFrame:
    """Long form ``(label, value)`` of the announced labels, one row per sample and label."""
    check_names(names)
    pairs = F.array(*(F.struct(F.lit(n).alias("label"), F.col("labels")[n].alias("value")) for n in names))
    return df.select(*carry, F.inline(pairs)).filter(F.col("value") != "")


def as_label_sets(pairs: DataFrame) -> DataFrame:
    labels = F.create_map("label", "value")
    return pairs.withColumn("labels", labels).withColumn("labels_s", L.text(labels))


def announce(df: DataFrame, names: Sequence[str], *by: str) -> DataFrame:
    """One label set per announced label and value, distinct, sorted by text.

    ``by="source"`` keeps the sets of each source apart.
    """
    found = announced_pairs(df, names, *by).select(*by, "label", "value").distinct()
    return as_label_sets(found).select(*by, "labels", "labels_s").orderBy("labels_s", *by)


def announce_values(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The label sets of one label from a column of values; empty ones are left out."""
    check_names([name])
    found = df.select(F.lit(name).alias("label"), value.alias("value")).filter("value <> ''").distinct()
    return as_label_sets(found).select("labels", "labels_s").orderBy("labels_s")


def source_label_sets(sources: DataFrame) -> DataFrame:
    """The label sets of the sources that have any."""
    return sources.filter(F.size("external_labels") > 0).select(
        "source", F.col("external_labels").alias("labels")
    )


def catalog(sources: DataFrame, announced: DataFrame) -> DataFrame:
    """Label sets and time bounds per source.

    ``sources(source, external_labels)``, ``announced(source, labels)``.  A
    source shows its announced sets with the external labels laid over;
    without any, its external labels; without those, a fallback set with its
    name, whose bounds carry no labels.
    """
    external = F.coalesce("external_labels", L.no_labels())
    sources = sources.select("source", external.alias("external_labels"))
    told = attach_external(announced.select("source", "labels"), sources).select(
        "source", L.overlay(F.col("labels"), F.col("external_labels")).alias("labels"), F.lit(True).alias("bound")
    )
    silent = sources.join(announced.select("source").distinct(), "source", "left_anti")
    has_external = F.size("external_labels") > 0
    fallback = F.create_map(F.lit(FALLBACK_LABEL), F.col("source"))
    untold = silent.select(
        "source",
        F.when(has_external, F.col("external_labels")).otherwise(fallback).alias("labels"),
        has_external.alias("bound"),
    )
    return told.unionByName(untold).select(
        "source",
        "labels",
        F.when(F.col("bound"), F.col("labels")).otherwise(L.no_labels()).alias("bound_labels"),
        F.lit(MIN_TIME).cast("bigint").alias("min_time"),
        F.lit(MAX_TIME).cast("bigint").alias("max_time"),
    )
