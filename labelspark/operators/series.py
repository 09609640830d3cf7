"""Series-level results: label sets, nested samples, chunks, order and limit."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from labelspark.functions import labels as L
from labelspark.functions.steps import SAMPLES_PER_CHUNK
from labelspark.functions.times import DAY_MS, EPOCH, FIRST_MS, LAST_MS, LEAST, MOST, bounded, days, floor_div
from labelspark.operators.align import KEYS, MAX_BLOCK_MS, hashed

SAMPLE = "struct<ts_ms:bigint,value:double>"


def with_identity(df: DataFrame) -> DataFrame:
    """Add ``labels_c``, the comparable form of the stored labels."""
    return df.withColumn("labels_c", L.canonical(F.col("labels")))


def labels_back(df: DataFrame) -> DataFrame:
    """The label map again, from the identity carried through a shuffle."""
    return df.withColumn("labels", F.map_from_entries("labels_c"))


def check_range(start: int | None, end: int | None) -> None:
    if start is not None and end is not None and end < start:
        raise ValueError(f"the range ends ({end}) before it starts ({start})")


def in_range(df: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Samples between two times, both inclusive; of a series table, the series alive then.

    Either end may be left open by None or by the bound of a 64-bit number.
    """
    check_range(start, end)
    if "ts_ms" in df.columns:
        return bounded(df, None if start is None else start - 1, end)
    return overlapping(df, start, end)


def overlapping(series: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Rows of a series table that have been alive within a range; its ends may be open."""
    check_range(start, end)
    start = None if start is None or start <= LEAST else start
    end = None if end is None or end >= MOST else end
    alive = days(start, end) if "day" in series.columns else []
    if end is not None:
        alive.append(F.col("first_ts") <= end)
    if start is not None:
        alive.append(F.col("last_ts") >= start)
    return series.filter(reduce(Column.__and__, alive)) if alive else series


def _closed(start: int | None, end: int | None) -> tuple[int | None, int | None]:
    """The ends of a range that bound something."""
    return None if start is None or start <= FIRST_MS else start, None if end is None or end >= LAST_MS else end


def whole_days(start: int | None, end: int | None) -> bool:
    """Whether a range begins and ends with a day, or is open."""
    start, end = _closed(start, end)
    return (start is None or start % DAY_MS == 0) and (end is None or (end + 1) % DAY_MS == 0)


def edge_days(start: int | None, end: int | None) -> Column:
    """True for the days that a range holds in part."""
    start, end = _closed(start, end)
    cut = [t for t, whole in ((start, start is None or start % DAY_MS == 0), (end, end is None or (end + 1) % DAY_MS == 0)) if not whole]
    return F.col("day").isin([EPOCH.date() + timedelta(milliseconds=t) for t in cut])


def alive(series: DataFrame, samples: DataFrame, start: int | None, end: int | None, keys: list[str]) -> DataFrame:
    """Rows of a series table that have a sample within a range.

    The first and the last time of a row are times of samples.  So a row that meets the range and does not reach over
    both its ends has one inside; only rows that do are looked up among the samples of the range.  A row of one day
    cannot, unless the range begins and ends in the midst of that day.
    """
    met = overlapping(series, start, end)
    if start is None or end is None:
        return met
    if "day" in series.columns and (start // DAY_MS != end // DAY_MS or start % DAY_MS == 0 or (end + 1) % DAY_MS == 0):
        return met
    over = (F.col("first_ts") < start) & (F.col("last_ts") > end)
    inside = in_range(samples, start, end).select(*keys)
    return met.filter(~over).unionByName(met.filter(over).join(inside, keys, "left_semi"))


def series_table(samples: DataFrame, keys=KEYS) -> DataFrame:
    """One row per stored label set: sample count and first and last time."""
    return samples.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min("ts_ms").alias("first_ts"), F.max("ts_ms").alias("last_ts")
    )


def series_metadata(samples: DataFrame, keys=KEYS) -> DataFrame:
    """The distinct label sets; reads no times and no values."""
    return samples.select(*keys).distinct()


def skip_empty(series: DataFrame) -> DataFrame:
    """Nested series without missing ones and without those that hold no sample."""
    require_matrix(series)
    return series.filter(F.col("labels").isNotNull() & (F.coalesce(F.size("samples"), F.lit(0)) > 0))


def require_matrix(df: DataFrame) -> None:
    """A series answer must be nested series; anything else is an error."""
    field = next((f for f in df.schema if f.name == "samples"), None)
    if field is None or field.dataType.simpleString() != f"array<{SAMPLE}>":
        raise TypeError("a series answer needs a column samples ARRAY<STRUCT<ts_ms BIGINT, value DOUBLE>>")


def require_instant(df: DataFrame) -> None:
    """An instant answer has one sample per row, not nested series."""
    if not {"ts_ms", "value"} <= set(df.columns):
        raise TypeError("an instant answer needs the columns ts_ms and value")


def _samples_in_order() -> Column:
    return F.sort_array(F.collect_list(F.struct("ts_ms", "value")))


def nest(df: DataFrame, keys=KEYS) -> DataFrame:
    """One row per series with its samples in time order.

    For samples on a grid, whose number per series the point cap bounds.
    """
    return df.groupBy(*keys).agg(_samples_in_order().alias("samples"))


def unnest(series: DataFrame) -> DataFrame:
    """One row per sample again."""
    require_matrix(series)
    kept = [c for c in series.columns if c != "samples"]
    return series.select(*kept, F.inline("samples"))


def chunk_grid(df: DataFrame, keys=KEYS, size: int = SAMPLES_PER_CHUNK) -> DataFrame:
    """Chunks of at most ``size`` samples in time order, for samples on a grid.

    The point cap bounds the rows of a series, so one window per series does;
    the grouping reuses its partitioning.
    """
    df, series = hashed(df, keys)
    number = F.row_number().over(Window.partitionBy(*series).orderBy("ts_ms")) - 1
    numbered = df.withColumn("chunk", floor_div(number.cast("bigint"), size))
    chunks = numbered.groupBy(*series, "chunk").agg(
        F.min("ts_ms").alias("min_time"),
        F.max("ts_ms").alias("max_time"),
        _samples_in_order().alias("samples"),
    )
    return chunks.drop("_hash")


def chunk_raw(
    df: DataFrame,
    keys=KEYS,
    size: int = SAMPLES_PER_CHUNK,
    block_ms: int = MAX_BLOCK_MS,
    tiebreak: str | None = None,
) -> DataFrame:
    """The same chunks for raw samples, of which one series may hold very many.

    Samples are counted per series and time block; the running count of the
    earlier blocks gives each block its offset, and samples are put in order
    within their block only.  Each block then hands on its part of a chunk as
    one row, so a chunk is put together from few rows.
    """
    order = ["ts_ms", *([tiebreak] if tiebreak else [])]
    df, keys = hashed(df, keys)
    # Never null, or the join would filter only one of its sides and the other could not be reused.
    block = F.coalesce(floor_div(F.col("ts_ms"), block_ms), F.lit(0).cast("bigint"))
    blocked = df.filter("ts_ms IS NOT NULL").withColumn("block", block)
    in_block = Window.partitionBy(*keys, "block").orderBy(*order)
    numbered = blocked.withColumn("_row", F.row_number().over(in_block))
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The last row is taken with its value, so that both sides of the join need the same columns and Spark
    # reads and shuffles the samples once for both.
    offsets = (
        numbered.groupBy(*keys, "block")
        .agg(F.max(F.struct("_row", "value")).alias("_last"))
        .select(*keys, "block", F.coalesce(F.sum("_last._row").over(earlier), F.lit(0)).alias("_offset"))
    )
    placed = (
        numbered.join(offsets, [*keys, "block"])
        .withColumn("_place", F.col("_offset") + F.col("_row") - 1)
        .withColumn("chunk", floor_div(F.col("_place"), size))
    )
    sample = F.struct("_place", F.struct("ts_ms", "value").alias("sample"))
    parts = placed.groupBy(*keys, "block", "chunk").agg(
        F.min("ts_ms").alias("min_time"),
        F.max("ts_ms").alias("max_time"),
        F.collect_list(sample).alias("part"),
    )
    whole = F.sort_array(F.flatten(F.collect_list("part")))
    chunks = parts.groupBy(*keys, "chunk").agg(
        F.min("min_time").alias("min_time"),
        F.max("max_time").alias("max_time"),
        whole["sample"].alias("samples"),
    )
    return chunks.drop("_hash")


def chunks_of_series(chunks: DataFrame, keys=KEYS) -> DataFrame:
    """One row per series with its chunks in time order."""
    chunk = F.struct("min_time", "max_time", "samples")
    return chunks.groupBy(*keys).agg(F.sort_array(F.collect_list(chunk)).alias("chunks"))


TIES = ("labels_c", "id_hi", "id_lo")


def limit_series(series: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` of the sorted series; no limit if not positive.

    Stored labels, or the series id, decide between rows with equal final
    labels and source.
    """
    ties = [c for c in TIES if c in series.columns]
    ordered = series.withColumn("labels_f", L.canonical(F.col("labels"))).orderBy("labels_f", "source", *ties)
    return (ordered.limit(limit) if limit > 0 else ordered).drop("labels_f")


def page_of(series: DataFrame, size: int, after: Row | None = None) -> DataFrame:
    """The first ``size`` series after a cursor in the order of `limit_series`, with the cursor of each."""
    ties = [c for c in TIES if c in series.columns]
    placed = series.withColumn("cursor", F.struct(L.canonical(F.col("labels")).alias("labels_f"), "source", *ties))
    if after is not None:
        placed = placed.filter(F.col("cursor") > _literal(after, placed.schema["cursor"].dataType))
    return placed.orderBy("cursor").limit(size)


def _literal(value, kind: DataType) -> Column:
    """A nested value as a column."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    if isinstance(kind, ArrayType):
        return F.array(*[_literal(v, kind.elementType) for v in value]).cast(kind)
    return F.lit(value).cast(kind)
