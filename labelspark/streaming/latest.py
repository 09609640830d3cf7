"""The latest sample of each series, kept as samples arrive.

A log of batches holds one row per series and batch and is merged to the greatest time when read.  An instant request at the
present is answered from it; see `Federation.query`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelspark.sources.store import SERIES_ID, clean_samples
from labelspark.streaming.refresh import ANNOUNCED_EVERY, started
from labelspark.streaming.versions import LogTable, run_of


def latest_log(spark: SparkSession, path: str, **settings) -> LogTable:
    """``latest`` by source and series id: time, tiebreak and value of the last sample."""
    return LogTable(spark, path, ("source", *SERIES_ID), {"latest": F.max("latest")}, **settings)


def last_samples(samples: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """The rows of a batch for the log; of samples of one time the greatest tiebreak counts, then the greatest value."""
    tie = F.col(tiebreak) if tiebreak else F.lit(None)
    latest = F.struct("ts_ms", tie.cast("string" if tiebreak is None else samples.schema[tiebreak].dataType).alias("tie"), "value")
    clean = clean_samples(samples, ()).filter("ts_ms IS NOT NULL")
    return clean.groupBy("source", *SERIES_ID).agg(F.max(latest).alias("latest"))


def stream_latest(
    samples: DataFrame, table: LogTable, checkpoint: str, *, tiebreak: str | None = None, once: bool = False, every: str = ANNOUNCED_EVERY
) -> StreamingQuery:
    """Follow a stream of samples and keep the latest of each series.

    Late samples do no harm, as only the greatest time counts; a batch that runs again adds nothing.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        table.append(last_samples(batch, tiebreak), run_of(table.spark, checkpoint), batch_id)

    return started(samples.writeStream.foreachBatch(keep), checkpoint, once, every)


def latest_samples(table: LogTable) -> DataFrame:
    """source, id_hi, id_lo, ts_ms, value of the last sample of each series."""
    return table.current().select("source", *SERIES_ID, "latest.ts_ms", "latest.value")
