"""Stored samples in buckets by series id, for selectors of more series than are sent to every task.

A table of buckets holds the samples of one series in one bucket, whatever the day.  Spark then knows where the ids
of a selector belong: these are dealt out by bucket, and the samples stay where they lie, through the join and
through all that is worked out per series after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.functions.times import bounded
from labelspark.sources.store import SERIES_ID, clean_samples

#: What a bucket is chosen by: all that a series is known by.
BUCKETED_BY = ("source", *SERIES_ID)

#: So many samples of a bucket are put in order by one task at most: some 200 MB with their labels.
BUCKET_ROWS = 300_000


def buckets_for(samples: DataFrame, least: int = 1) -> int:
    """The number of buckets that a table needs so that they hold about BUCKET_ROWS samples each."""
    return max(least, -(-samples.count() // BUCKET_ROWS))


def write_bucketed(
    samples: DataFrame, table: str, path: str, buckets: int, hot: Sequence[str] = (L.METRIC_NAME,), *, mode: str = "append"
) -> None:
    """Store samples as a table of the session's catalogue, by day and bucket, with its files below ``path``.

    Buckets are a matter of the whole table: a bucket is written, and read again, by one task, so their number follows
    the samples (`buckets_for`).  All writes must name the same number.  Spark sorts each bucket by series and time.
    """
    if mode not in ("append", "all"):
        raise ValueError("a bucketed table is added to or replaced")
    # The writer sorts by day, bucket, series and time by itself; a sort before it would be held beside that one.
    placed = clean_samples(samples, hot).repartition(buckets, *BUCKETED_BY)
    writer = placed.write.mode("append" if mode == "append" else "overwrite").option("path", path)
    writer.partitionBy("day").bucketBy(buckets, *BUCKETED_BY).sortBy(*BUCKETED_BY, "ts_ms").saveAsTable(table, format="parquet")


def open_bucketed(spark: SparkSession, table: str, path: str, buckets: int) -> None:
    """Make a bucketed table known to a session that has not written it."""
    kinds = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema}
    columns = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    by, order = ", ".join(BUCKETED_BY), ", ".join((*BUCKETED_BY, "ts_ms"))
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}' PARTITIONED BY (day) "
        f"CLUSTERED BY ({by}) SORTED BY ({order}) INTO {buckets} BUCKETS"
    )
    spark.catalog.recoverPartitions(table)


def read_bucketed(spark: SparkSession, table: str, after: int | None = None, until: int | None = None) -> DataFrame:
    """Samples of a bucketed table in ``(after, until]``; only the days of the range are read."""
    return bounded(spark.table(table), after, until)
