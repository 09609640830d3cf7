"""Which sources take part in a request, and what their external labels do.

A source owns its external labels: a matcher on such a label is decided by the
source table alone, and never looks at the stored labels of that source.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from labelspark.functions import labels as L
from labelspark.operators.matchers import Selector, all_of, matching, selector, stored_column

# Up to this size a source table is broadcast.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 32 * 2**20

# Least copies of each row of a larger source table in the join to its samples, a power of two.
SALTS = 32


def routing_condition(*selectors: Selector) -> Column:
    """True for a source accepted by every matcher of every selector.

    Never null, and made of plain comparisons, from which Spark sees that it
    is worth pruning partitions by it.
    """
    checks = []
    for matcher in dict.fromkeys(m for chosen in selectors for m in chosen):
        own = F.coalesce(F.col("external_labels")[matcher.name], F.lit(""))
        checks.append((own == "") | matcher.accepts(own))
    return all_of(checks)


def routed(sources: DataFrame, *selectors: Selector) -> DataFrame:
    """The sources that take part; with several selectors all must accept."""
    return sources.filter(routing_condition(*selectors))


def unrouted(sources: DataFrame, *selectors: Selector) -> DataFrame:
    return sources.filter(~routing_condition(*selectors))


def fits_broadcast(sources: DataFrame) -> bool:
    """Whether the source table is small enough to be sent to every executor; fetches its count and size."""
    size = F.octet_length("source") + F.coalesce(F.octet_length(F.to_json("external_labels")), F.lit(0))
    rows, total = sources.agg(F.count("*"), F.sum(size)).first()
    return rows <= BROADCAST_ROWS and (total or 0) <= BROADCAST_BYTES


def owned_names(sources: DataFrame) -> frozenset[str]:
    """Every label name that some source owns."""
    names = sources.select(F.explode(F.map_keys("external_labels")).alias("name")).distinct()
    return frozenset(row["name"] for row in names.collect())


def known_externals(sources: DataFrame) -> DataFrame:
    """The source table with missing external labels as the empty set."""
    return sources.withColumn("external_labels", F.coalesce("external_labels", L.no_labels()))


def _salts(df: DataFrame) -> int:
    """A power of two that follows the number of shuffle partitions, which a user sets by the size of the data."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(SALTS, 1 << (wanted - 1).bit_length())


def by_source(df: DataFrame, sources: DataFrame, how: str = "inner", *, small: bool) -> DataFrame:
    """Join rows to the source table on the source.

    A source table of checked size is broadcast, which also lets Spark prune
    the partitions of sources that are not routed.  A larger one is joined by
    shuffle.  As one source may hold much of the data, its rows are then
    spread over several salts; this also keeps a later grouping from reusing a
    partitioning by source alone.
    """
    if small:
        return df.join(F.broadcast(sources), "source", how)
    plain = [f.name for f in df.schema if f.name != "source" and isinstance(f.dataType, AtomicType)]
    spread_on = next(([c] for c in ("ts_ms", "labels_c") if c in df.columns), plain)
    if not spread_on and "labels" in df.columns:
        spread_on = [L.canonical(F.col("labels"))]
    salts = _salts(df)
    salted_rows = df.withColumn("_salt", F.hash(*(spread_on or [F.lit(0)])).bitwiseAND(salts - 1))
    copies = sources.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(copies, ["source", "_salt"], how).drop("_salt")


def keep_routed(df: DataFrame, sources: DataFrame, *selectors: Selector, small: bool | None = None) -> DataFrame:
    """Rows of the routed sources only, without reading their labels."""
    chosen = routed(sources, *selectors).select("source", "external_labels")
    small = fits_broadcast(chosen) if small is None else small
    return by_source(df, chosen.select("source"), "left_semi", small=small)


def attach_external(df: DataFrame, sources: DataFrame, *, small: bool | None = None) -> DataFrame:
    """Each row with the external labels of its source beside it.

    ``small`` says whether the source table may be broadcast; left out, its
    size is checked.
    """
    small = fits_broadcast(sources) if small is None else small
    return by_source(df, known_externals(sources.select("source", "external_labels")), small=small)


def effective_condition(df: DataFrame, chosen: Selector) -> Column:
    """Matchers on what a routed row shows: external label if set, else stored."""
    external = F.col("external_labels")
    return all_of(
        m.accepts(L.effective(stored_column(df, m.name), external, m.name)) for m in chosen
    )


def federate(
    df: DataFrame,
    sources: DataFrame,
    chosen: Selector,
    *,
    external_names: Iterable[str] | None = None,
    on_empty: str = "all",
    small: bool | None = None,
) -> DataFrame:
    """Rows of all sources that fit the selector, with ``external_labels``.

    ``external_names`` may list label names that are owned by sources; names that
    the source table has besides are added.  Matchers on other names then become
    plain filters that reach the scan.  Without the list each matcher is checked
    after the join.  Whether the sources are broadcast hangs on the routed ones
    alone, so that few routed sources prune the others' partitions however many
    there are.

    A source left with no matcher of its own once external ones are taken out
    is read whole (``on_empty="no filter"``) or for all its named series
    (``"all"``).
    """
    owned = None if external_names is None else owned_names(sources) | set(external_names)
    plain = Selector(*(m for m in chosen if owned is not None and m.name not in owned))
    mixed = Selector(*(m for m in chosen if m not in plain))
    if plain:
        df = matching(df, plain)
    joined = attach_external(df, routed(sources, mixed), small=small)
    if mixed:
        joined = joined.filter(effective_condition(joined, mixed))
    if on_empty == "all" and not plain:
        named = selector((L.METRIC_NAME, "=~", ".+"))[0].accepts(stored_column(joined, L.METRIC_NAME))
        joined = joined.filter(~owns_all(chosen) | named)
    return joined


def owns_all(chosen: Selector) -> Column:
    """True for a source that owns the label of every matcher of the selector."""
    external = F.col("external_labels")
    return all_of(F.coalesce(external[name], F.lit("")) != "" for name in sorted(chosen.names()))


def require_own_matcher(sources: DataFrame, chosen: Selector) -> None:
    """Refuse a selector that leaves a routed source without a matcher.

    Looks at the source table only and fetches at most one row.
    """
    if routed(sources, chosen).filter(owns_all(chosen)).take(1):
        raise ValueError("no matchers left besides those on external labels")


def scalar_rows(sources: DataFrame, value: Column, ts_ms: int, *selectors: Selector) -> DataFrame:
    """A scalar answer: once per routed source, without labels.

    ``value`` is a literal or a scalar subquery (``one_row_frame.scalar()``).
    """
    return routed(sources, *selectors).select(
        "source",
        L.no_labels().alias("labels"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
        value.cast("double").alias("value"),
    )
