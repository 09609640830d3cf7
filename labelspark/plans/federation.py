"""Requests over many sources: series, labels, instant and range queries."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from labelspark.functions import steps
from labelspark.functions.times import bounded, days
from labelspark.operators import align, discovery, rollup, series
from labelspark.operators.matchers import Selector
from labelspark.operators.projection import finish_labels
from labelspark.operators.routing import (
    attach_external,
    federate,
    fits_broadcast,
    owned_names,
    require_own_matcher,
    routed,
    scalar_rows,
)
from labelspark.sources.index import LabelIndex
from labelspark.sources.store import SERIES_ID, series_labels

# Up to so many series, the ids of a selector are broadcast to the samples: 64 MB at most.
BROADCAST_IDS = 1_000_000

# Start and end of a request in milliseconds; None leaves an end open.
Span = tuple[int | None, int | None]
OPEN: Span = (None, None)


@dataclass(frozen=True)
class Federation:
    """Samples of several sources seen as one.

    ``samples(source, labels, ts_ms, value)``, ``sources(source,
    external_labels)``.  ``dropped`` are labels taken out of every answer.
    ``external_names`` may list the label names that sources own, see
    `routing.federate`.

    Stored samples carry series ids; given the ``series`` table beside them
    (`store.read_series`) the work is done by id: a selector is resolved on the
    series that were alive in the request's days, samples are read for the ids
    found, without their label map, and labels are looked up for results only.
    Metadata and label requests are answered from the series table alone; samples are read only
    where a request lies within one day, for the series that reach over both its ends.

    The ids of up to ``broadcast_ids`` series are sent to all tasks; more are joined by
    shuffle, which leaves the samples in place if they lie in so many ``buckets`` (`buckets.write_bucketed`).

    With stored ``rollups`` of the samples' hours (`store.write_rollups`) range and rate queries by steps of an hour or more read
    samples only for the hours that their windows cut.

    With the ``latest`` sample of each series (`latest.latest_samples`) an instant query reads samples only of those
    series that have a later one than the time asked for.

    Given the label ``index`` beside the series table (`index.write_index`), selectors, label names and label values
    are resolved by it and label maps are read for the series of an answer only.
    """

    samples: DataFrame
    sources: DataFrame
    dropped: tuple[str, ...] = ()
    external_names: frozenset[str] | None = None
    fallback_step_ns: int = steps.DEFAULT_STEP_NS
    max_points: int = steps.MAX_POINTS
    lookback_ms: int = steps.LOOKBACK_MS
    tiebreak: str | None = None
    series: DataFrame | None = None
    index: LabelIndex | None = None
    broadcast_ids: int = BROADCAST_IDS
    buckets: int = 0
    rollups: DataFrame | None = None
    latest: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.series is None and not (self.index is self.rollups is self.latest is None):
            raise ValueError("a label index, rollups and latest samples belong beside a series table")

    def routed_for(self, *selectors: Selector) -> Federation:
        """Only the sources that every selector of a composed expression accepts."""
        return replace(self, sources=routed(self.sources, *selectors))

    @cached_property
    def small(self) -> bool:
        """Whether the whole source table may be broadcast to finish results, looked up once."""
        return fits_broadcast(self.sources)

    @cached_property
    def owned(self) -> frozenset[str]:
        """The label names that sources own, looked up once."""
        return owned_names(self.sources) | (self.external_names or frozenset())

    def _alive(self, chosen: Selector, span: Span, on_empty: str = "all", exact: bool = False) -> DataFrame:
        """Rows of the series table that fit the selector and were alive in a range.

        Those are the rows whose times meet the range; with ``exact`` the ones that have a sample in it.
        """
        if exact:
            alive = series.alive(self.series, self.samples, *span, list(self.keys))
        else:
            alive = series.overlapping(self.series, *span)
        if self.index is None:
            return federate(alive, self.sources, chosen, external_names=self.external_names, on_empty=on_empty)
        found = self.index.between(*span).resolve(
            self.sources, chosen, owned=self.owned, on_empty=on_empty, small=self.small
        )
        return alive.join(found, ["day", *self.keys], "left_semi")

    def hits(self, chosen: Selector, samples: DataFrame | None = None, span: Span = OPEN) -> DataFrame:
        """Samples of the routed sources that fit the selector, with the identity of their series."""
        if self.series is not None:
            ids = self._ids(chosen, span)
            few = ids.limit(self.broadcast_ids + 1).count() <= self.broadcast_ids
            rows = self.samples if samples is None else samples
            if few:
                ids = F.broadcast(ids)
            elif self.buckets:
                # Dealt out as the buckets are, or Spark would rather deal both sides anew for more tasks.
                ids = ids.repartition(self.buckets, *self.keys)
            return rows.join(ids, list(self.keys), "left_semi")
        found = federate(
            self.samples if samples is None else samples,
            self.sources,
            chosen,
            external_names=self.external_names,
        )
        return series.with_identity(found)

    def _ids(self, chosen: Selector, span: Span) -> DataFrame:
        """The ids of the series that fit the selector on the days of a range, each once."""
        if self.index is None:
            return self._alive(chosen, span).select(*self.keys).distinct()
        found = self.index.between(*span).resolve(self.sources, chosen, owned=self.owned, small=self.small)
        return found.select(*self.keys).distinct()

    @property
    def keys(self) -> tuple[str, ...]:
        return align.KEYS if self.series is None else ("source", *SERIES_ID)

    def finish(
        self, df: DataFrame, replica: Iterable[str] = (), chosen: Selector = Selector(), span: Span = OPEN
    ) -> DataFrame:
        """From stored identity to final labels; both are looked up for results only.

        Selector and range, if given, bound what is read of the series table.
        """
        if self.series is None:
            stored = series.labels_back(df)
        else:
            stored = df.join(series_labels(self._alive(chosen, span)), list(self.keys))
        named = attach_external(stored, self.sources, small=self.small)
        return finish_labels(named, self.dropped, replica)

    # -- series requests ---------------------------------------------------

    def series_metadata(
        self,
        chosen: Selector,
        start: int | None = None,
        end: int | None = None,
        *,
        replica: Iterable[str] = (),
        limit: int = 0,
    ) -> DataFrame:
        """Label sets with a sample in the range, in label order; an end that is None is open."""
        require_own_matcher(self.sources, chosen)
        series.check_range(start, end)
        if self.series is None:
            hits = self.hits(chosen, series.in_range(self.samples, start, end), (start, end))
            found = self.finish(series.series_metadata(hits, self.keys), replica, chosen, (start, end))
        else:
            # The rows found have their labels with them.
            sets = series_labels(self._alive(chosen, (start, end), exact=True))
            found = finish_labels(attach_external(sets, self.sources, small=self.small), self.dropped, replica)
        return series.limit_series(found, limit).select("source", "labels")

    def select_series(
        self,
        chosen: Selector,
        start: int,
        end: int,
        *,
        hint_ms: int = 0,
        step_ms: int = 0,
        replica: Iterable[str] = (),
        limit: int = 0,
    ) -> DataFrame:
        """Series with their samples on the step grid, in chunks, in label order.

        The step is the first one given, raised to keep within the point cap.
        """
        series.check_range(start, end)
        require_own_matcher(self.sources, chosen)
        step_ns = steps.plan_step(start, end, hint_ms, step_ms, self.fallback_step_ns, self.max_points)
        step = steps.grid_step_ms(step_ns)
        span = (start - self.lookback_ms, end)
        hits = self.hits(chosen, span=span)
        if limit > 0:
            # The first series are found by their keys alone; samples are aligned and chunked for these only.
            answered = align.answered(hits, start, end, step, self.lookback_ms, self.keys)
            first = series.limit_series(self.finish(answered, replica, chosen, span), limit).select(*self.keys)
            hits = hits.join(first, list(self.keys), "left_semi")
        on_grid = align.range_select(hits, start, end, step, self.lookback_ms, self.keys, self.tiebreak)
        chunks = series.chunks_of_series(series.chunk_grid(on_grid, self.keys), self.keys)
        named = self.finish(chunks, replica, chosen, span)
        return series.limit_series(named, limit).select("source", "labels", "chunks")

    def series_page(
        self,
        chosen: Selector,
        start: int,
        end: int,
        size: int,
        after: Row | None = None,
        *,
        step_ms: int = 0,
        replica: Iterable[str] = (),
    ) -> DataFrame:
        """The next ``size`` series after a cursor, in label order, with a ``cursor`` on each row.

        The cursor of the last row of a page is where the next one goes on; series that come or leave in between
        move no other.  The order is found by keys alone, and samples are read for the series of the page.
        """
        if size < 1:
            raise ValueError("a page holds at least one series")
        series.check_range(start, end)
        require_own_matcher(self.sources, chosen)
        step = steps.grid_step_ms(steps.plan_step(start, end, 0, step_ms, self.fallback_step_ns, self.max_points))
        span = (start - self.lookback_ms, end)
        hits = self.hits(chosen, span=span)
        answered = align.answered(hits, start, end, step, self.lookback_ms, self.keys)
        page = series.page_of(self.finish(answered, replica, chosen, span), size, after)
        page = page.select(*self.keys, "labels", "cursor")
        few = hits.join(page.select(*self.keys), list(self.keys), "left_semi")
        on_grid = align.range_select(few, start, end, step, self.lookback_ms, self.keys, self.tiebreak)
        chunks = series.chunks_of_series(series.chunk_grid(on_grid, self.keys), self.keys)
        return page.join(chunks, list(self.keys)).orderBy("cursor").select("source", "labels", "chunks", "cursor")

    # -- label requests ----------------------------------------------------

    def label_names(
        self,
        chosen: Selector = Selector(),
        start: int | None = None,
        end: int | None = None,
        *,
        replica: Iterable[str] = (),
    ) -> DataFrame:
        if self.index is not None:
            known = self.index.between(start, end)
            told = known.names(self._exact_ids(chosen, start, end))
            placed = routed(self.sources, chosen)
            return discovery.indexed_names(told, placed, dropped=self.dropped, replica=replica, small=self.small)
        return discovery.label_names(
            self._between(start, end),
            self.sources,
            chosen,
            dropped=self.dropped,
            replica=replica,
            external_names=self.external_names,
        )

    def label_values(
        self,
        label: str,
        chosen: Selector = Selector(),
        start: int | None = None,
        end: int | None = None,
        *,
        replica: Iterable[str] = (),
    ) -> DataFrame:
        if self.index is not None:
            configured, others = discovery.owned_values(self.sources, label, chosen, self.dropped, replica)
            if others is None:
                return configured
            told = self.index.between(start, end).values_of(label, self._exact_ids(chosen, start, end))
            read = routed(others, chosen).select("source", "external_labels")
            found = attach_external(told, read, small=self.small).select("value")
            return found.union(configured).distinct().orderBy("value")
        return discovery.label_values(
            self._between(start, end),
            self.sources,
            label,
            chosen,
            dropped=self.dropped,
            replica=replica,
            external_names=self.external_names,
        )

    def _between(self, start: int | None, end: int | None) -> DataFrame:
        """What label requests look through: series with a sample in the range, or the samples themselves."""
        if self.series is None:
            return series.in_range(self.samples, start, end)
        return series.alive(self.series, self.samples, start, end, list(self.keys))

    def _exact_ids(self, chosen: Selector, start: int | None, end: int | None) -> DataFrame | None:
        """source, day and id of the series that fit and have a sample in the range; None for all series of all days."""
        series.check_range(start, end)
        if not chosen and series.whole_days(start, end):
            return None
        known = self.index.between(start, end)
        found = known.resolve(self.sources, chosen, owned=self.owned, on_empty="no filter", small=self.small)
        if series.whole_days(start, end):
            return found
        # Only the days at the ends of the range hold series that might lie outside of it.
        keys = list(self.keys)
        at_ends = series.edge_days(start, end)
        alive = series.alive(self.series.filter(at_ends), self.samples, start, end, keys).select("day", *keys).distinct()
        placed = found.join(alive.withColumn("inside", F.lit(True)), ["day", *keys], "left")
        return placed.filter(~at_ends | F.col("inside")).drop("inside")

    # -- queries: no order, no limit, replica labels stay --------------------

    def query(self, chosen: Selector, at_s: int, lookback_ms: int | None = None) -> DataFrame:
        """Latest sample per series at one time (whole seconds)."""
        lookback = self.lookback_ms if lookback_ms is None else lookback_ms
        at = at_s * 1000
        span = (at - lookback, at)
        if self.latest is None:
            found = align.instant_select(self.hits(chosen, span=span), at, lookback, self.keys, self.tiebreak)
            return self.answer(found, chosen, span)
        known = self.hits(chosen, bounded(self.latest, *span), span)
        found = align.instant_select(known, at, lookback, self.keys)
        later = self.latest.filter(F.col("ts_ms") > at).select(*self.keys)
        if not later.isEmpty():
            # These series may have samples within the lookback that are no longer their last.
            past = self.hits(chosen, span=span).join(later, list(self.keys), "left_semi")
            found = found.unionByName(align.instant_select(past, at, lookback, self.keys, self.tiebreak))
        return self.answer(found, chosen, span)

    def query_range(
        self, chosen: Selector, start_s: int, end_s: int, step_s: int, lookback_ms: int | None = None
    ) -> DataFrame:
        """Latest sample per series at each step; the step is taken as given."""
        lookback = self.lookback_ms if lookback_ms is None else lookback_ms
        grid, span = (start_s * 1000, end_s * 1000, step_s * 1000), (start_s * 1000 - lookback, end_s * 1000)
        hits = self.hits(chosen, span=span)
        if self._by_hours(grid[2]):
            found = rollup.range_select(self._hours(chosen, span), hits, *grid, lookback, self.keys, self.tiebreak)
        else:
            found = align.range_select(hits, *grid, lookback, self.keys, self.tiebreak)
        return self.answer(found, chosen, span)

    def _by_hours(self, step_ms: int) -> bool:
        return self.rollups is not None and step_ms >= rollup.HOUR_MS

    def _hours(self, chosen: Selector, span: Span) -> DataFrame:
        """The stored hours of the series that fit, on the days of a range and the one before."""
        after = None if span[0] is None else span[0] - rollup.HOUR_MS
        kept = [*days(after, span[1])]
        rows = self.rollups.filter(reduce(Column.__and__, kept)) if kept else self.rollups
        return self.hits(chosen, rows, span)

    def rate(self, chosen: Selector, start_s: int, end_s: int, step_s: int, window_ms: int) -> DataFrame:
        grid, span = (start_s * 1000, end_s * 1000, step_s * 1000), (start_s * 1000 - window_ms, end_s * 1000)
        hits = self.hits(chosen, span=span)
        if self._by_hours(grid[2]):
            found = rollup.counter_rate(self._hours(chosen, span), hits, *grid, window_ms, self.keys, self.tiebreak)
        else:
            found = align.counter_rate(hits, *grid, window_ms, self.keys, self.tiebreak)
        return self.answer(found, chosen, span)

    def irate(self, chosen: Selector, start_s: int, end_s: int, step_s: int, window_ms: int) -> DataFrame:
        grid, span = (start_s * 1000, end_s * 1000, step_s * 1000), (start_s * 1000 - window_ms, end_s * 1000)
        hits = self.hits(chosen, span=span)
        return self.answer(align.counter_irate(hits, *grid, window_ms, self.keys, self.tiebreak), chosen, span)

    def answer(self, vector: DataFrame, chosen: Selector = Selector(), span: Span = OPEN) -> DataFrame:
        """Rows of an instant or range answer with final labels.

        Takes an instant frame (one sample per series) or a range frame as it
        is; nested series are refused.
        """
        series.require_instant(vector)
        return self.finish(vector, (), chosen, span).select("source", "labels", "ts_ms", "value")

    def scalar(self, value: Column, ts_ms: int, *selectors: Selector) -> DataFrame:
        return scalar_rows(self.sources, value, ts_ms, *selectors)
