"""Which label names and values are there, over all routed sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.operators.matchers import Selector
from labelspark.operators.routing import attach_external, federate, routed


def label_names(
    df: DataFrame,
    sources: DataFrame,
    chosen: Selector = Selector(),
    *,
    dropped: Iterable[str] = (),
    replica: Iterable[str] = (),
    external_names: Iterable[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Distinct label names, sorted; external ones only of sources with a hit.

    Rows are first reduced to the few distinct sets of names.
    """
    hits = federate(df, sources, chosen, external_names=external_names, on_empty="no filter", small=small)
    name_sets = hits.select(
        F.sort_array(F.map_keys("labels")).alias("own"),
        F.sort_array(F.map_keys("external_labels")).alias("external"),
    ).distinct()
    names = name_sets.filter(F.size("own") > 0).select(F.explode(F.array_union("own", "external")).alias("name"))
    return shown_names(names, dropped, replica)


def shown_names(names: DataFrame, dropped: Iterable[str], replica: Iterable[str]) -> DataFrame:
    """Distinct names without the dropped ones, sorted."""
    unwanted = L.drop_set(dropped, replica)
    names = names.distinct()
    return (names.filter(~F.col("name").isin(unwanted)) if unwanted else names).orderBy("name")


def indexed_names(
    told: DataFrame,
    sources: DataFrame,
    *,
    dropped: Iterable[str] = (),
    replica: Iterable[str] = (),
    small: bool | None = None,
) -> DataFrame:
    """`label_names` from the names that an index gives for each source, ``told(source, label)``."""
    placed = attach_external(told, sources, small=small)
    names = placed.select(F.explode(F.array_union(F.array("label"), F.map_keys("external_labels"))).alias("name"))
    return shown_names(names, dropped, replica)


def label_values(
    df: DataFrame,
    sources: DataFrame,
    label: str,
    chosen: Selector = Selector(),
    *,
    dropped: Iterable[str] = (),
    replica: Iterable[str] = (),
    external_names: Iterable[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Distinct values of one label, sorted.

    A source that owns the label answers with its configured value and is not
    read; the others are.  A dropped label has no values.
    """
    configured, others = owned_values(sources, label, chosen, dropped, replica)
    if others is None:
        return configured
    hits = federate(
        df,
        others,
        chosen,
        external_names=external_names,
        on_empty="no filter",
        small=small,
    )
    found = hits.select(L.stored(F.col("labels"), label).alias("value")).filter("value IS NOT NULL")
    return found.union(configured).distinct().orderBy("value")


def owned_values(
    sources: DataFrame, label: str, chosen: Selector, dropped: Iterable[str], replica: Iterable[str]
) -> tuple[DataFrame, DataFrame | None]:
    """The values that routed sources own, and the sources to be read for theirs; none of either for a dropped label."""
    if label == "":
        raise ValueError("a label needs a name")
    own = F.coalesce(F.col("external_labels")[label], F.lit(""))
    configured = routed(sources, chosen).filter(own != "").select(own.alias("value"))
    if label in L.drop_set(dropped, replica):
        return configured.limit(0), None
    return configured, sources.filter(own == "")
