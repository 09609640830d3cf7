"""Label work on whole frames and on lists of names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.functions import labels as L


def finish_labels(df: DataFrame, dropped: Iterable[str] = (), replica: Iterable[str] = ()) -> DataFrame:
    """Stored labels plus external ones, minus dropped names, as ``labels``.

    Rows that become equal stay separate rows.
    """
    names = L.drop_set(dropped, replica)
    return df.withColumn("labels", L.final(F.col("labels"), F.col("external_labels"), names)).drop(
        "external_labels"
    )


def with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("labels_s", L.text(F.col("labels")))


def extend_label_sets(df: DataFrame, external: Column) -> DataFrame:
    """Overlay external labels on a frame of label sets."""
    return df.withColumn("labels", L.overlay(F.col("labels"), external))


def layered(*layers: Column) -> Column:
    """Several external label maps in one; a later layer wins."""
    merged = layers[0]
    for layer in layers[1:]:
        merged = L.overlay(merged, layer)
    return merged


def drop_names(names: Column, dropped: Iterable[str]) -> Column:
    """An array of names without the dropped ones, order kept."""
    unwanted = L.drop_set(dropped)
    return F.filter(names, lambda name: ~name.isin(unwanted)) if unwanted else names
