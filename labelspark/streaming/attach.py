"""Final labels on samples as they arrive."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelspark.functions.times import day_of
from labelspark.operators.matchers import Selector
from labelspark.operators.projection import finish_labels
from labelspark.operators.routing import federate
from labelspark.streaming.refresh import EXTERNAL_EVERY, refresh_external, started
from labelspark.streaming.versions import LogTable, VersionedTable, run_of

log = logging.getLogger(__name__)


def attached(spark: SparkSession, out: str, **settings) -> LogTable:
    """The labelled samples of finished batches, by day: ``attached(spark, out).current()``."""
    return LogTable(spark, out, by=("day",), **settings)


def stream_attach(
    samples: DataFrame,
    sources: VersionedTable,
    chosen: Selector,
    out: str,
    checkpoint: str,
    *,
    read_sources: Callable[[], DataFrame] | None = None,
    dropped: Iterable[str] = (),
    external_names: Iterable[str] | None = None,
    on_error: Callable[[str], None] = log.error,
    once: bool = False,
    every: str = EXTERNAL_EVERY,
) -> StreamingQuery:
    """Route arriving samples and give them their final labels.

    The source table is looked up for every batch, after a refresh if
    ``read_sources`` is given; a refresh that fails is handed to ``on_error``
    and the last good table is used.

    Output is a log of batches, see `attached`: the rows of a batch appear all at once, a batch killed half way leaves
    nothing to be seen, and one that runs again after it was committed adds nothing.  The folders of batches are merged
    into days as they come together.
    """
    dropped = tuple(dropped)

    def label(batch: DataFrame, batch_id: int) -> None:
        if attached(sources.spark, out).has(run_of(sources.spark, checkpoint), batch_id):
            return
        if read_sources is not None:
            error = refresh_external(sources, read_sources)
            if error is not None:
                on_error(error)
        known = sources.current()
        if known is None:
            raise ValueError("the source table has no version yet")
        hits = federate(batch, known, chosen, external_names=external_names)
        rows = finish_labels(hits, dropped).withColumn("day", day_of(F.col("ts_ms")))
        attached(sources.spark, out).append(rows, run_of(sources.spark, checkpoint), batch_id)

    return started(samples.writeStream.foreachBatch(label), checkpoint, once, every)
