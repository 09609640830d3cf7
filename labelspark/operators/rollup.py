"""Stored summaries of hours, from which range and rate requests are answered.

An hour holds the samples of a series in ``(h, h + 1 hour]``, as windows are open on the left.  Its summary is what
`align.summed_up` says of a block: first and last sample, and the gain between them.  Summaries that follow one
another merge into that of their samples together: the gains add up with the rise from the last value of one to the first of the next,
whatever is merged first.

An hour that no edge of a window cuts is taken as a whole; of the others the samples are read.  A grid of whole hours thus
reads no samples at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelspark.functions.times import bounded, ceil_div
from labelspark.operators import align
from labelspark.operators.align import KEYS, Blocks, hashed, summed_up

HOUR_MS = 3_600_000
SUMMARY = ("first_ts", "first_value", "last_ts", "last_value", "gain")


def hour_of(ts: Column) -> Column:
    """The number of the hour that a sample belongs to: the one that begins before it."""
    return ceil_div(ts, HOUR_MS) - 1


def hourly(samples: DataFrame, keys=KEYS, tiebreak: str | None = None) -> DataFrame:
    """One row per series and hour."""
    found, series = hashed(samples.filter("ts_ms IS NOT NULL"), keys)
    blocks = summed_up(found.withColumn("k", hour_of(F.col("ts_ms"))), series, tiebreak)
    return blocks.select(*keys, F.col("k").alias("hour"), *SUMMARY)


def merged(pieces: DataFrame, keys) -> DataFrame:
    """One row per series and block out of pieces that follow one another in time."""
    inside = Window.partitionBy(*keys, "k").orderBy("first_ts")
    rise = align._rise(F.lag("last_value").over(inside), F.col("first_value"))
    joined = pieces.withColumn("rise", align._sums(rise, lambda c: c))
    total = F.struct(*[F.sum(F.col("gain")[p] + F.col("rise")[p]).alias(p) for p in align.PARTS])
    return joined.groupBy(*keys, "k").agg(
        F.min("first_ts").alias("first_ts"),
        F.min_by("first_value", "first_ts").alias("first_value"),
        F.max("last_ts").alias("last_ts"),
        F.max_by("last_value", "last_ts").alias("last_value"),
        total.alias("gain"),
    )


def _whole(edges: Blocks, hour: Column) -> Column:
    """Whether no edge lies within an hour."""
    return edges.number(hour * HOUR_MS + 1) == edges.number((hour + 1) * HOUR_MS)


def _no_cuts(*edges: int) -> bool:
    return all(e % HOUR_MS == 0 for e in edges)


def cut_hours(samples: DataFrame, edges: Blocks, *on: int) -> DataFrame:
    """The samples of the hours that edges cut; none, and nothing is read, if all edges are whole hours."""
    if _no_cuts(*on):
        return samples.filter(F.lit(False))
    return samples.filter(~_whole(edges, hour_of(F.col("ts_ms"))))


def counter_rate(
    hours: DataFrame,
    samples: DataFrame,
    start: int,
    end: int,
    step: int,
    window: int,
    keys=KEYS,
    tiebreak: str | None = None,
) -> DataFrame:
    """`align.counter_rate` from the hours of the same samples; samples are read for cut hours only."""
    points = align._check_grid(start, end, step, window)
    last = start + (points - 1) * step
    edges = Blocks(start, step, window, longest=max(step, window))
    inside = (F.col("hour") * HOUR_MS >= start - window) & ((F.col("hour") + 1) * HOUR_MS <= last)
    known, series = hashed(hours.filter(inside & _whole(edges, F.col("hour"))), keys)
    known = known.withColumn("k", edges.number((F.col("hour") + 1) * HOUR_MS))
    cut = cut_hours(bounded(samples, start - window, last), edges, start, step, window)
    cut, _ = hashed(cut.withColumn("hour", hour_of(F.col("ts_ms"))), keys)
    # Put in order by block and hour, so that no more than an hour of a series meets in one place.
    numbered = cut.withColumn("k", F.struct(edges.number(F.col("ts_ms")).alias("k"), "hour"))
    pieces = summed_up(numbered, series, tiebreak).withColumn("k", F.col("k.k"))
    columns = [*series, "k", *SUMMARY]
    blocks = merged(known.select(columns).unionByName(pieces.select(columns)), series)
    return align.rates_of_blocks(blocks, edges, points, keys)


def range_select(
    hours: DataFrame,
    samples: DataFrame,
    start: int,
    end: int,
    step: int,
    lookback: int,
    keys=KEYS,
    tiebreak: str | None = None,
) -> DataFrame:
    """`align.range_select` from the hours of the same samples: the last sample of an hour stands for it, unless a grid time cuts the hour."""
    points = align._check_grid(start, end, step, lookback)
    last = start + (points - 1) * step
    edges = Blocks(start, step, step, longest=step)
    until = (F.col("hour") + 1) * HOUR_MS <= last
    ends = hours.filter(until & _whole(edges, F.col("hour"))).select(
        *keys, F.col("last_ts").alias("ts_ms"), F.col("last_value").alias("value")
    )
    cut = cut_hours(bounded(samples, start - lookback, last), edges, start, step)
    if tiebreak:
        cut = cut.groupBy(*keys, "ts_ms").agg(F.max_by("value", tiebreak).alias("value"))
    return align.range_select(ends.unionByName(cut.select(*keys, "ts_ms", "value")), start, end, step, lookback, keys)
