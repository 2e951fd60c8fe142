"""As-of joins: forward strict (to a spine), backward, and nearest within a tolerance.

Both sides are united and walked once in time order per key, remembering the last row of the other side: one
shuffle, no range join.  The walk is in two levels (``scan``), so a hot key is spread over its days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import CHUNK_US, last_seen

KEYS = ("exchange", "symbol")


def _united(left: DataFrame, right: DataFrame, keys, left_ts: str, right_ts: str, payload, left_first: bool) -> DataFrame:
    """Left rows as ``l`` and right payloads as ``r``, with a time and a side that orders ties."""
    first, second = (0, 1) if left_first else (1, 0)
    a = left.select(
        *keys,
        F.col(left_ts).alias("__t"),
        F.lit(first).alias("__side"),
        F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("__l"),
    )
    b = right.select(
        *keys, F.col(right_ts).alias("__t"), F.lit(second).alias("__side"), F.struct(F.col(right_ts).alias("__rt"), *payload).alias("__r")
    )
    return a.unionByName(b, allowMissingColumns=True)


def align_to_spine(
    events: DataFrame,
    spine: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = "ts_event_us",
    spine_ts: str = "ts_spine_us",
    direction: str = "forward",
    chunk_us: int = CHUNK_US,
) -> DataFrame:
    """Adds ``spine_ts`` to every event: the first spine point after the event's time (strictly), else null.

    An event on a spine point belongs to the next one.  With ``direction='backward'`` it is the last point at
    or before the event.  No event is lost or repeated; the order of rows is the caller's.
    """
    forward = direction == "forward"
    if direction not in ("forward", "backward"):
        raise ValueError(f"direction is forward or backward, not {direction!r}")
    # Backward in time, an event at a point's time must be met before the point; forward in time, after it.
    points = spine.select(*keys, spine_ts).where(F.col(spine_ts).isNotNull()).distinct()
    both = _united(events, points, keys, ts, spine_ts, [], left_first=False)
    seen = last_seen(both, keys, ("__t", "__side"), F.col("__r.__rt"), spine_ts, descending=forward, chunk_us=chunk_us)
    kept = seen.where("__l is not null")
    columns = [c for c in events.columns if c != spine_ts]
    return kept.select(*(F.col("__l")[c].alias(c) for c in columns), spine_ts)


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    columns: Sequence[str],
    tie: Sequence[str] = (),
    suffix: str = "",
    chunk_us: int = CHUNK_US,
) -> DataFrame:
    """Adds ``columns`` of the latest right row at or before each left row's time; null where there is none.

    Of right rows at one time the last by ``tie`` counts.
    """
    best = right
    if tie:
        one = right.groupBy(*keys, right_ts).agg(
            F.max_by(F.struct(*(F.col(c) for c in columns)), F.struct(*tie)).alias("__x")
        )
        best = one.select(*keys, right_ts, *(F.col("__x")[c].alias(c) for c in columns))
    both = _united(left, best, keys, left_ts, right_ts, [F.col(c) for c in columns], left_first=False)
    seen = last_seen(both, keys, ("__t", "__side"), F.col("__r"), "__hit", chunk_us=chunk_us)
    return seen.where("__l is not null").select(
        *(F.col("__l")[c].alias(c) for c in left.columns), *(F.col("__hit")[c].alias(f"{c}{suffix}") for c in columns)
    )


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    columns: Sequence[str],
    tolerance_us: int,
    chunk_us: int = CHUNK_US,
) -> DataFrame:
    """Adds ``columns`` and ``gap_us`` of the right row nearest in time within the tolerance, else nulls.

    Of two equally near the earlier one counts.
    """
    both = _united(left, right, keys, left_ts, right_ts, [F.col(c) for c in columns], left_first=False)
    down = last_seen(both, keys, ("__t", "__side"), F.col("__r"), "__before", chunk_us=chunk_us)
    up = last_seen(down, keys, ("__t", "__side"), F.col("__r"), "__after", descending=True, chunk_us=chunk_us)
    back, ahead = F.col("__t") - F.col("__before.__rt"), F.col("__after.__rt") - F.col("__t")
    hit = F.when(ahead.isNull() | (back <= ahead), F.col("__before")).otherwise(F.col("__after"))
    found = up.where("__l is not null").withColumn("__hit", hit).withColumn("gap_us", F.least(back, ahead))
    near = F.col("gap_us") <= tolerance_us
    return found.select(
        *(F.col("__l")[c].alias(c) for c in left.columns),
        *(F.when(near, F.col("__hit")[c]).alias(c) for c in columns),
        F.when(near, F.col("gap_us")).alias("gap_us"),
    )
