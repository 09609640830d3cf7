"""Choice of the step of a range request, as columns and for one request.

Steps are nanoseconds; the ranges come in milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS = 1_000_000

# The defaults of a series request.
DEFAULT_STEP_NS = 60_000_000_000
MAX_POINTS = 11_000
SAMPLES_PER_CHUNK = 120
LOOKBACK_MS = 300_000


def _nanos(ms: Column) -> Column:
    return ms.cast("bigint") * NANOS


def step_choice(hint_ms: Column, step_ms: Column, fallback_ns: Column) -> Column:
    """The first positive of hint, request step and fallback; else one minute."""
    return F.coalesce(
        F.when(hint_ms > 0, _nanos(hint_ms)),
        F.when(step_ms > 0, _nanos(step_ms)),
        F.when(fallback_ns > 0, fallback_ns),
        F.lit(DEFAULT_STEP_NS),
    ).cast("bigint")


def min_step(range_ns: Column, max_points: Column) -> Column:
    """The least step that keeps a range within ``max_points``; 0 if not limited."""
    gaps = F.when(max_points > 1, (max_points - 1).cast("bigint"))
    whole = F.call_function("div", range_ns, gaps)
    rounded_up = whole + F.when(range_ns % gaps != 0, 1).otherwise(0)
    return (
        F.when((max_points <= 0) | (range_ns <= 0), 0)
        .when(max_points == 1, range_ns)
        .otherwise(rounded_up)
        .cast("bigint")
    )


def step_clamped(step_ns: Column, start_ms: Column, end_ms: Column, max_points: Column) -> Column:
    """The step, raised as far as the point cap asks for."""
    return F.greatest(step_ns, min_step(_nanos(end_ms - start_ms), max_points))


def plan_step(
    start_ms: int,
    end_ms: int,
    hint_ms: int = 0,
    step_ms: int = 0,
    fallback_ns: int = DEFAULT_STEP_NS,
    max_points: int = MAX_POINTS,
) -> int:
    """The same rules for one request, in nanoseconds."""
    step = next((s for s in (hint_ms * NANOS, step_ms * NANOS, fallback_ns) if s > 0), DEFAULT_STEP_NS)
    span = (end_ms - start_ms) * NANOS
    if max_points <= 0 or span <= 0:
        return step
    least = span if max_points == 1 else -(-span // (max_points - 1))
    return max(step, least)


def grid_step_ms(step_ns: int) -> int:
    """A step on the millisecond grid: rounded up, so that a cap still holds."""
    return -(-step_ns // NANOS)
