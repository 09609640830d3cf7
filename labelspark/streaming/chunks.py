"""Chunks that grow: samples that arrive later, in any order, are merged into the chunks that are stored.

The stored chunks of a series follow one another in time and all but the last are full, so they are what chunking all of its
samples at once would give.  New samples touch the chunks from the first one that ends at or after them, and the last one if it
is not full; these alone are taken apart, merged with the new samples in time order, and numbered on from the
first of them.  A log keeps the new form of each touched chunk; when read, the latest form of a chunk counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelspark.functions.steps import SAMPLES_PER_CHUNK
from labelspark.operators.series import chunk_raw, unnest
from labelspark.sources.store import SERIES_ID, with_series_id
from labelspark.streaming.refresh import ANNOUNCED_EVERY, started
from labelspark.streaming.versions import LogTable, run_of

KEYS = ("source", *SERIES_ID)


def chunk_log(spark: SparkSession, path: str, **settings) -> LogTable:
    """``held`` by series and chunk: the version that wrote it, its bounds, samples and the labels of the series."""
    return LogTable(spark, path, (*KEYS, "chunk"), {"held": F.max_by("held", "held.version")}, **settings)


def chunks_of(table: LogTable) -> DataFrame | None:
    """source, id_hi, id_lo, labels, chunk, min_time, max_time, samples."""
    held = table.current()
    if held is None:
        return None
    return held.select(*KEYS, "held.labels", "chunk", "held.min_time", "held.max_time", "held.samples")


def one_per_time(samples: DataFrame, tiebreak: str | None) -> DataFrame:
    """Of samples of one series and time the one with the greatest tiebreak, then the greatest value."""
    order = F.struct(*([tiebreak] if tiebreak else []), "value")
    known = with_series_id(samples.filter("ts_ms IS NOT NULL"))
    latest = known.groupBy(*KEYS, "ts_ms").agg(F.max(F.struct(order.alias("o"), "value")).alias("m"))
    return latest.select(*KEYS, "ts_ms", F.col("m.value").alias("value"))


def touched(stored: DataFrame, new: DataFrame, size: int) -> DataFrame:
    """The stored chunks that new samples belong to or come after without a full chunk between."""
    first = new.groupBy(*KEYS).agg(F.min("ts_ms").alias("first_new"))
    beside = stored.join(first, list(KEYS))
    return beside.filter((F.col("max_time") >= F.col("first_new")) | (F.size("samples") < size)).drop("first_new")


def merge_chunks(
    table: LogTable, samples: DataFrame, *, tiebreak: str | None = None, size: int = SAMPLES_PER_CHUNK, run: str = "", batch: int | None = None
) -> None:
    """Merge samples into the chunks of a table; those of a batch that is in it already are passed over.

    A sample of a time that is stored already replaces it.  Among the samples given, ``tiebreak`` decides.
    """
    if batch is not None and table.has(run, batch):
        return
    version = (table.last_version() if table.last_version() is not None else -1) + 1
    new = one_per_time(samples, tiebreak)
    labels = with_series_id(samples).groupBy(*KEYS).agg(F.first("labels").alias("labels"))
    stored = chunks_of(table)
    pool = new.withColumn("age", F.lit(1))
    begin = new.select(*KEYS).distinct().withColumn("begin", F.lit(0).cast("bigint"))
    if stored is not None:
        old = touched(stored, new, size)
        apart = unnest(old.select(*KEYS, "samples")).withColumn("age", F.lit(0))
        both = pool.unionByName(apart).groupBy(*KEYS, "ts_ms").agg(F.max_by("value", "age").alias("value"))
        full = stored.groupBy(*KEYS).agg(F.max("chunk").alias("last"))
        least = old.groupBy(*KEYS).agg(F.min("chunk").alias("least"))
        placed = begin.join(full, list(KEYS), "left").join(least, list(KEYS), "left")
        begin = placed.select(*KEYS, F.coalesce("least", F.col("last") + 1, F.lit(0)).cast("bigint").alias("begin"))
    else:
        both = pool.drop("age")
    chunks = chunk_raw(both, KEYS, size).join(begin, list(KEYS)).join(labels, list(KEYS))
    held = F.struct(F.lit(version).cast("bigint").alias("version"), "labels", "min_time", "max_time", "samples")
    rows = chunks.select(*KEYS, (F.col("chunk") + F.col("begin")).alias("chunk"), held.alias("held"))
    table.append(rows, run, batch)


def stream_chunks(
    samples: DataFrame, table: LogTable, checkpoint: str, *, tiebreak: str | None = None, once: bool = False, every: str = ANNOUNCED_EVERY
) -> StreamingQuery:
    """Follow a stream of samples and keep their chunks."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        merge_chunks(table, batch, tiebreak=tiebreak, run=run_of(table.spark, checkpoint), batch=batch_id)

    return started(samples.writeStream.foreachBatch(keep), checkpoint, once, every)
