"""Samples on a time grid: instant and range selection, counter rates.

All times are integer milliseconds; windows are open on the left and closed on
the right.  A series is one value of ``keys``; it holds at most one sample per
millisecond (give ``tiebreak`` where that is not so: the greatest wins).

Samples are first reduced per series and time block, so that a series with a
large part of the data is spread over many tasks; only the reduced rows of a
series, bounded by the grid, meet in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelspark.functions.times import bounded, ceil_div, floor_div

KEYS = ("source", "labels_c")

# Longest time block in which single samples are put in order by one task.
MAX_BLOCK_MS = 3_600_000


def _check_grid(start: int, end: int, step: int, lookback: int) -> int:
    """The number of grid points."""
    if end < start:
        raise ValueError("end must not be before start")
    if step <= 0 or lookback <= 0:
        raise ValueError("step and lookback must be positive")
    return (end - start) // step + 1


def hashed(df: DataFrame, keys) -> tuple[DataFrame, tuple[str, ...]]:
    """The frame with a hash of the series in front of its keys.

    Sorts then mostly compare one number instead of label lists; the keys stay
    part of the grouping, so equal hashes do not merge series.
    """
    return df.withColumn("_hash", F.xxhash64(*keys)), ("_hash", *keys)


def _latest(value: str, tiebreak: str | None) -> Column:
    order = F.struct("ts_ms", tiebreak) if tiebreak else F.col("ts_ms")
    return F.max_by(value, order).alias(value)


def instant_select(df, at: int, lookback: int, keys=KEYS, tiebreak: str | None = None) -> DataFrame:
    """The latest sample of each series in ``(at - lookback, at]``, at time ``at``."""
    _check_grid(at, at, 1, lookback)
    latest = bounded(df, at - lookback, at).groupBy(*keys).agg(_latest("value", tiebreak))
    return latest.select(*keys, F.lit(at).cast("bigint").alias("ts_ms"), "value")


def range_select(
    df, start: int, end: int, step: int, lookback: int, keys=KEYS, tiebreak: str | None = None
) -> DataFrame:
    """For each grid time the latest sample within the lookback, if there is one.

    A sample can only be the answer from the first grid time at or after it,
    and among the samples with the same first grid time only the latest can.
    So one row per series and grid time is kept, before the shuffle, and each
    kept row is then copied to the grid times up to its successor.
    """
    points = _check_grid(start, end, step, lookback)
    ts, slot = F.col("ts_ms"), F.col("slot")
    last_time = start + (points - 1) * step
    seen = bounded(df, start - lookback, last_time)
    seen = seen.withColumn("slot", F.greatest(ceil_div(ts - start, step), F.lit(0).cast("bigint")))
    kept = seen.groupBy(*keys, "slot").agg(F.max("ts_ms").alias("seen_ms"), _latest("value", tiebreak))

    reach = floor_div(F.col("seen_ms") + (lookback - 1 - start), step)
    if lookback <= step:
        # No sample outlives its own grid time, so the successor is of no interest.
        on_grid = kept.filter(reach >= slot)
    else:
        # Shuffled by the plain keys, so that chunking and nesting need no shuffle of their own.
        kept, series = hashed(kept.repartition(*keys), keys)
        following = F.lead("slot").over(Window.partitionBy(*series).orderBy("slot"))
        last_slot = F.least(reach, F.coalesce(following - 1, F.lit(points - 1).cast("bigint")))
        on_grid = (
            kept.withColumn("last_slot", last_slot)
            .filter(F.col("last_slot") >= slot)
            .withColumn("slot", F.explode(F.sequence("slot", "last_slot")))
        )
    return on_grid.select(*keys, (F.lit(start) + slot * step).alias("ts_ms"), "value")


def answered(df, start: int, end: int, step: int, lookback: int, keys=KEYS) -> DataFrame:
    """The keys of the series that `range_select` would answer for; no samples are kept."""
    points = _check_grid(start, end, step, lookback)
    ts = F.col("ts_ms")
    seen = bounded(df, start - lookback, start + (points - 1) * step)
    slot = F.greatest(ceil_div(ts - start, step), F.lit(0).cast("bigint"))
    return seen.filter(floor_div(ts + (lookback - 1 - start), step) >= slot).select(*keys).distinct()


class Blocks:
    """Time blocks whose edges hold all edges of the windows, whatever step and window have in common.

    Windows begin and end at ``start + i * step`` or at ``start + i * step - window``.  These two kinds of edges cut
    each step into two parts (one if the window is a multiple of the step), and each part is cut evenly so that no
    block is longer than ``longest``, by default MAX_BLOCK_MS.  Block ``per_step * i`` ends at grid time ``i``, whose window is the
    ``per_window`` blocks up to that one.
    """

    def __init__(self, start: int, step: int, window: int, longest: int | None = None) -> None:
        longest = longest or MAX_BLOCK_MS
        self.start, self.step = start, step
        whole, rest = divmod(window, step)
        self.lengths = [step - rest, rest] if rest else [step]
        self.pieces = [-(-length // longest) for length in self.lengths]
        self.per_step = sum(self.pieces)
        self.per_window = whole * self.per_step + (self.pieces[1] if rest else 0)

    def number(self, ts: Column) -> Column:
        interval = ceil_div(ts - self.start, self.step) - 1
        inside = ts - self.start - interval * self.step  # 1 to step
        first, n = self.lengths[0], self.pieces[0]
        place = ceil_div(inside * n, first)
        if len(self.lengths) > 1:
            later = ceil_div((inside - first) * self.pieces[1], self.lengths[1]) + n
            place = F.when(inside <= first, place).otherwise(later)
        return interval * self.per_step + place


def _counter_blocks(
    df: DataFrame, start: int, end: int, step: int, window: int, keys, tiebreak: str | None = None
) -> DataFrame:
    """Counter samples summed up per series and time block, with the series hash.

    ``gain`` is the increase from the first to the last sample of the block,
    with a fall of the value taken as a restart from zero; ``before_*`` is the
    last sample but one.  Increases that are no finite numbers are counted apart.
    """
    points = _check_grid(start, end, step, window)
    df, keys = hashed(df, keys)
    seen = bounded(df, start - window, start + (points - 1) * step)
    return summed_up(seen.withColumn("k", Blocks(start, step, window).number(F.col("ts_ms"))), keys, tiebreak)


def summed_up(seen: DataFrame, keys, tiebreak: str | None = None) -> DataFrame:
    """One row per series and block ``k`` with what a rate needs to know of its samples."""
    in_block = Window.partitionBy(*keys, "k").orderBy("ts_ms", *([tiebreak] if tiebreak else []))
    if tiebreak:
        following = F.lead("ts_ms").over(in_block)
        seen = seen.withColumn("_next", following).filter("_next IS NULL OR _next > ts_ms")
    # The last sample of a block has seen the others, so no second table of the blocks is held beside the sort.
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pairs = seen.select(
        *keys,
        "k",
        F.first("ts_ms").over(so_far).alias("first_ts"),
        F.first("value").over(so_far).alias("first_value"),
        F.col("ts_ms").alias("last_ts"),
        F.col("value").alias("last_value"),
        F.lag("ts_ms").over(in_block).alias("before_ts"),
        F.lag("value").over(in_block).alias("before_value"),
        F.lead(F.lit(1)).over(in_block).alias("_more"),
        *(["ts_ms", tiebreak] if tiebreak else ["ts_ms"]),
    )
    gains = _sums(_rise(F.col("before_value"), F.col("last_value")), lambda c: F.sum(c).over(so_far))
    return pairs.withColumn("gain", gains).filter("_more IS NULL").select(
        *keys, "k", "first_ts", "first_value", "last_ts", "last_value", "before_ts", "before_value", "gain"
    )


INFINITY = float("inf")
#: Of a set of numbers: the sum of the finite ones, and how many are not a number, positive and negative infinity.
PARTS = ("finite", "nan", "up", "down")
TOTAL = "struct<finite: double, nan: bigint, up: bigint, down: bigint>"
#: A block while it is the last or the first one that windows hold, and until which grid time.
LAST_SEEN = f"struct<until: bigint, total: {TOTAL}, last_ts: bigint>"
FIRST_SEEN = f"struct<until: bigint, total: {TOTAL}, first_ts: bigint>"


def _sums(value: Column, total) -> Column:
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < INFINITY)
    found = {
        "finite": F.coalesce(total(F.when(finite, value).otherwise(0.0)), F.lit(0.0)),
        "nan": F.coalesce(total(F.isnan(value).cast("bigint")), F.lit(0)),
        "up": F.coalesce(total((value == INFINITY).cast("bigint")), F.lit(0)),
        "down": F.coalesce(total((value == -INFINITY).cast("bigint")), F.lit(0)),
    }
    return F.struct(*[found[p].alias(p) for p in PARTS])


def _combined(a: Column, b: Column, sign: int = 1) -> Column:
    return F.struct(*[(a[p] + sign * b[p]).alias(p) for p in PARTS])


def _number(parts: Column) -> Column:
    """What adding up the numbers would give."""
    unclear = (parts["nan"] > 0) | ((parts["up"] > 0) & (parts["down"] > 0))
    return (
        F.when(unclear, float("nan"))
        .when(parts["up"] > 0, INFINITY)
        .when(parts["down"] > 0, -INFINITY)
        .otherwise(parts["finite"])
    )


def _rise(before: Column, after: Column) -> Column:
    """Increase between two readings of a counter; null without the first."""
    return F.when(after >= before, after - before).when(after < before, after)


def counter_rate(
    df, start: int, end: int, step: int, window: int, keys=KEYS, tiebreak: str | None = None
) -> DataFrame:
    """Increase per second over the trailing window, at each grid time.

    From the first to the last sample in the window, with restarts corrected
    and no extrapolation to the window's edges; needs two samples.  A value that
    is no finite number shows in the windows that hold it, and in no other.
    """
    points = _check_grid(start, end, step, window)
    found = _counter_blocks(df, start, end, step, window, keys, tiebreak)
    return rates_of_blocks(found, Blocks(start, step, window), points, keys)


def rates_of_blocks(blocks: DataFrame, edges: Blocks, points: int, keys) -> DataFrame:
    """The rates at the grid times, from the rows of `summed_up` with their hash, one per series and block."""
    start, step, per_step, per_window = edges.start, edges.step, edges.per_step, edges.per_window
    k = F.col("k")
    in_series = Window.partitionBy("_hash", *keys).orderBy("k")
    crossing = _rise(F.lag("last_value").over(in_series), F.col("first_value"))
    blocks = blocks.withColumn("crossing", crossing)
    blocks = blocks.withColumn("with_crossing", _combined(F.col("gain"), _sums(F.col("crossing"), lambda c: c)))
    running = [F.sum(F.col("with_crossing")[p]).over(in_series).alias(p) for p in PARTS]
    blocks = blocks.withColumn("total", F.struct(*running))

    # Grid time i sees the blocks i*per_step - per_window + 1 .. i*per_step.
    # A block is the last one seen until its successor is, and the first one
    # seen once its predecessor is not.
    zero = F.lit(0).cast("bigint")
    opens = F.greatest(ceil_div(k, per_step), zero)
    closes = F.least(floor_div(k + (per_window - 1), per_step), F.lit(points - 1).cast("bigint"))
    succ = floor_div(F.lead("k").over(in_series) - 1, per_step)
    pred = floor_div(F.lag("k").over(in_series) + (per_window - 1), per_step)
    lasts = F.struct(
        opens.alias("from"),
        F.least(closes, F.coalesce(succ, closes)).alias("until"),
        F.struct(F.least(closes, F.coalesce(succ, closes)).alias("until"), "total", "last_ts").alias("last"),
        F.lit(None).cast(FIRST_SEEN).alias("first"),
    )
    total_at_first = _combined(F.col("total"), F.col("gain"), -1).alias("total")
    firsts = F.struct(
        F.greatest(opens, F.coalesce(pred + 1, opens)).alias("from"),
        closes.alias("until"),
        F.lit(None).cast(LAST_SEEN).alias("last"),
        F.struct(closes.alias("until"), total_at_first, "first_ts").alias("first"),
    )
    roles = blocks.select("_hash", *keys, lasts.alias("as_last"), firsts.alias("as_first"))
    roles = roles.select("_hash", *keys, F.inline(F.array("as_last", "as_first"))).filter("from <= until")

    # The blocks seen first and last change where a role begins, so a role's start answers for the grid times up to
    # the next start.  Rows are copied to their grid times after that: none of the copies is sorted or held.
    by_start = Window.partitionBy("_hash", *keys).orderBy("from")
    rows_so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = roles.select(
        *keys,
        "from",
        F.last("last", ignorenulls=True).over(rows_so_far).alias("last"),
        F.last("first", ignorenulls=True).over(rows_so_far).alias("first"),
        (F.lead("from").over(by_start) - 1).alias("next"),
    )
    reach = F.least("last.until", "first.until")
    reach = F.least(reach, F.coalesce("next", reach))
    held = seen.filter(F.col("last").isNotNull() & F.col("first").isNotNull())
    held = held.withColumn("reach", reach).filter("from <= reach AND last.last_ts > first.first_ts")
    seconds = (F.col("last.last_ts") - F.col("first.first_ts")) / 1000.0
    rate = _number(_combined(F.col("last.total"), F.col("first.total"), -1)) / seconds
    answers = held.select(*keys, "from", "reach", rate.alias("value"))
    slots = answers.select(*keys, "value", F.explode(F.sequence("from", "reach")).alias("slot"))
    return slots.select(*keys, (F.lit(start) + F.col("slot") * step).alias("ts_ms"), "value")


def counter_irate(
    df, start: int, end: int, step: int, window: int, keys=KEYS, tiebreak: str | None = None
) -> DataFrame:
    """Increase per second between the last two samples in the window, at each grid time."""
    points = _check_grid(start, end, step, window)
    blocks = Blocks(start, step, window)
    per_step, per_window = blocks.per_step, blocks.per_window
    in_series = Window.partitionBy("_hash", *keys).orderBy("k")
    blocks = _counter_blocks(df, start, end, step, window, keys, tiebreak)
    k = F.col("k")
    opens = F.greatest(ceil_div(k, per_step), F.lit(0).cast("bigint"))
    closes = F.least(floor_div(k + (per_window - 1), per_step), F.lit(points - 1).cast("bigint"))
    succ = floor_div(F.lead("k").over(in_series) - 1, per_step)
    lasts = blocks.select(
        *keys,
        "last_ts",
        "last_value",
        F.coalesce("before_ts", F.lag("last_ts").over(in_series)).alias("before_ts"),
        F.coalesce("before_value", F.lag("last_value").over(in_series)).alias("before_value"),
        opens.alias("opens"),
        F.least(closes, F.coalesce(succ, closes)).alias("last_until"),
    )
    on_grid = lasts.filter("opens <= last_until").withColumn("slot", F.explode(F.sequence("opens", "last_until")))
    at = F.lit(start) + F.col("slot") * step
    seconds = (F.col("last_ts") - F.col("before_ts")) / 1000.0
    return on_grid.filter(F.col("before_ts") > at - window).select(
        *keys,
        at.alias("ts_ms"),
        (_rise(F.col("before_value"), F.col("last_value")) / seconds).alias("value"),
    )
