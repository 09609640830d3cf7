"""Stored samples: partitioned by source and day, with hot labels as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.functions.times import DAY_MS, bounded, day_of
from labelspark.operators import rollup
from labelspark.operators.series import series_table, with_identity


SERIES_ID = ("id_hi", "id_lo")


def samples_from(
    df: DataFrame,
    *,
    source: Column,
    labels: Column,
    ts_ms: Column,
    value: Column,
    promoted: Mapping[str, Column] | None = None,
    carry: Sequence[str | Column] = (),
) -> DataFrame:
    """Samples out of any table.

    ``promoted`` maps label names to plain columns that hold them, so that
    matchers on them reach the scan; ``__name__`` goes to the column ``name``.
    A raw timestamp carried as ``ts`` does the same for time ranges.
    """
    hot = [
        c.alias("name" if label == L.METRIC_NAME else f"label_{label}")
        for label, c in (promoted or {}).items()
    ]
    return df.select(
        source.alias("source"),
        *hot,
        labels.alias("labels"),
        ts_ms.cast("bigint").alias("ts_ms"),
        value.cast("double").alias("value"),
        *carry,
    )


def promote(samples: DataFrame, names: Sequence[str] = (L.METRIC_NAME,)) -> DataFrame:
    """Copy hot labels into columns of their own."""
    for name in names:
        column = "name" if name == L.METRIC_NAME else f"label_{name}"
        samples = samples.withColumn(column, F.col("labels")[name])
    return samples


def with_series_id(samples: DataFrame) -> DataFrame:
    """Add a 128-bit id of the label set, two plain numbers in place of a label list.

    Ids are unique per source; `write_series` checks that.
    """
    pairs = L.canonical(F.col("labels"))
    return samples.withColumn("id_hi", F.xxhash64(pairs)).withColumn("id_lo", F.xxhash64(F.lit(1), pairs))


# How a write treats what is stored: add to it, replace the (source, day) partitions written to, or replace all.
MODES = ("append", "partitions", "all")


def writer(df: DataFrame, mode: str) -> DataFrameWriter:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "partitions":
        return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return df.write.mode("append" if mode == "append" else "overwrite").option("partitionOverwriteMode", "static")


def write_samples(
    samples: DataFrame, path: str, hot: Sequence[str] = (L.METRIC_NAME,), *, mode: str = "append"
) -> None:
    """Store samples by source and day, labels cleaned, with series ids, sorted within files.

    ``mode`` says what becomes of the samples already there, see `MODES`.

    The rebalance lets Spark cut large (source, day) groups into several
    files of even size and put small ones together.
    """
    write_clean(clean_samples(samples, hot), path, hot, mode=mode)


def clean_samples(samples: DataFrame, hot: Sequence[str] = (L.METRIC_NAME,)) -> DataFrame:
    """Samples as they are stored: labels cleaned, with day, series id and hot labels."""
    clean = samples.withColumn("labels", L.normalize(F.col("labels"))).withColumn("day", day_of(F.col("ts_ms")))
    return promote(with_series_id(clean), hot)


def write_clean(clean: DataFrame, path: str, hot: Sequence[str] = (L.METRIC_NAME,), *, mode: str = "append") -> None:
    hot_columns = ["name" if n == L.METRIC_NAME else f"label_{n}" for n in hot]
    ordered = clean.hint("rebalance", "source", "day").sortWithinPartitions(
        "source", "day", *hot_columns, *SERIES_ID, "ts_ms"
    )
    writer(ordered, mode).partitionBy("source", "day").parquet(path)


def write_chunks(chunks: DataFrame, path: str, *, mode: str = "append") -> None:
    """Store chunks by source; a source with much data gets several files."""
    writer(chunks.hint("rebalance", "source"), mode).partitionBy("source").parquet(path)


def read_samples(
    spark: SparkSession, path: str, after: int | None = None, until: int | None = None
) -> DataFrame:
    """Stored samples in ``(after, until]``, either end open if None; only the days of the range are read."""
    return bounded(spark.read.option("mergeSchema", "false").parquet(path), after, until)


def write_series(samples: DataFrame, path: str, *, mode: str = "append") -> None:
    """The series table of stored samples: one row per source, day and label set (and per write, if appended).

    Label discovery and metadata read this instead of samples.  Two label
    sets of a source with the same id are refused before anything is written; of the rows stored already only the ids
    are read, and the labels of those that are met again.
    """
    add_series(series_rows(samples), path, mode=mode)


def series_rows(samples: DataFrame) -> DataFrame:
    """The rows of the series table for some samples with ids."""
    days = with_identity(samples).withColumn("day", day_of(F.col("ts_ms")))
    rows = series_table(days, keys=("source", "day", *SERIES_ID, "labels_c"))
    return rows.withColumn("labels", F.map_from_entries("labels_c")).drop("labels_c")


def add_series(rows: DataFrame, path: str, *, mode: str = "append") -> None:
    _refuse_clashes(rows, None if mode == "all" else stored(rows.sparkSession, path))
    writer(rows.hint("rebalance", "source", "day"), mode).partitionBy("source", "day").parquet(path)


def _refuse_clashes(named: DataFrame, before: DataFrame | None) -> None:
    """Fails if an id stands for two label sets of a source, among the new rows or beside stored ones."""
    new = series_labels(named, F.count("*").alias("sets"))
    clash = new.filter("sets > 1").select("source", *SERIES_ID)
    if before is not None:
        keys = ["source", *SERIES_ID]
        old = before.select(*keys, L.canonical(F.col("labels")).alias("other")).distinct()
        met = new.join(old, keys).filter(L.canonical(F.col("labels")) != F.col("other"))
        clash = clash.union(met.select(*keys))
    found = clash.take(1)
    if found:
        raise ValueError(f"two label sets share an id: {found[0]}")


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table below a path; none if nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def series_labels(series: DataFrame, *more: Column) -> DataFrame:
    """The labels of each series id, whatever the day."""
    sets = series.select("source", *SERIES_ID, L.canonical(F.col("labels")).alias("labels_c")).distinct()
    per_id = sets.groupBy("source", *SERIES_ID).agg(F.first("labels_c").alias("labels_c"), *more)
    return per_id.withColumn("labels", F.map_from_entries("labels_c")).drop("labels_c")


def write_rollups(samples: DataFrame, path: str, first: int, last: int, tiebreak: str | None = None) -> None:
    """Summaries of the hours of some days, which replace those stored: see `rollup.hourly`.

    ``first`` and ``last`` are times on the first and the last of the days.  Late samples change an hour as a whole, so the days that they
    came to are summed up anew from all their samples.
    """
    begin, end = first // DAY_MS * DAY_MS, (last // DAY_MS + 1) * DAY_MS
    hours = rollup.hourly(bounded(samples, begin, end), ("source", *SERIES_ID), tiebreak)
    hours = hours.withColumn("day", day_of(F.col("hour") * rollup.HOUR_MS))
    ordered = hours.hint("rebalance", "source", "day").sortWithinPartitions("source", "day", *SERIES_ID, "hour")
    writer(ordered, "partitions").partitionBy("source", "day").parquet(path)


def read_rollups(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
