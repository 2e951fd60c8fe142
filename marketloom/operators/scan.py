"""Running sums and last-seen values in two levels, so that one hot key is many tasks.

Rows are windowed inside a chunk of time of their key.  What a chunk inherits from those before it is worked
out from one small row per chunk and enters the chunk as a row of its own, ahead of all others.  So the rows
themselves are shuffled once and joined with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A chunk of time: one day.
CHUNK_US = 86_400_000_000
_CHUNK, _REAL = "__chunk", "__real"


def chunk_of(ts: str | Column, chunk_us: int = CHUNK_US) -> Column:
    """Start of the chunk of a time, exact for any long."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return column - F.pmod(column, F.lit(chunk_us).cast("long"))


def _inside(keys: Sequence[str], order: Sequence[Column]):
    sort = [F.asc(_REAL), *order]
    return Window.partitionBy(*keys, _CHUNK).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measure: Column, output: str, chunk_us: int = CHUNK_US
) -> DataFrame:
    """Adds ``output``: the decimal(38,0) sum of ``measure`` up to and with each row.  ``order[0]`` is the time."""
    rows = df.withColumns({_CHUNK: chunk_of(order[0], chunk_us), "__m": measure.cast("decimal(38,0)"), _REAL: F.lit(True)})
    totals = rows.groupBy(*keys, _CHUNK).agg(F.sum("__m").alias("__m"))
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, _CHUNK, F.sum("__m").over(before).alias("__m"), F.lit(False).alias(_REAL))
    both = rows.unionByName(carried.where("__m is not null"), allowMissingColumns=True)
    total = F.sum("__m").over(_inside(keys, [F.asc(c) for c in order])).cast("decimal(38,0)")
    return both.withColumn(output, total).where(_REAL).drop(_CHUNK, "__m", _REAL)


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: dict[str, Column], chunk_us: int = CHUNK_US, peers: bool = False
) -> DataFrame:
    """``running_sum`` of several measures at once, named by the keys of ``measures``.  With ``peers`` a row's sums hold
    all rows that are equal to it in the order, as in a RANGE frame."""
    held = {name: f"__m{i}" for i, name in enumerate(measures)}
    rows = df.withColumns({_CHUNK: chunk_of(order[0], chunk_us), _REAL: F.lit(True), **{held[n]: m.cast("decimal(38,0)") for n, m in measures.items()}})
    totals = rows.groupBy(*keys, _CHUNK).agg(*(F.sum(h).alias(h) for h in held.values()))
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, _CHUNK, *(F.sum(h).over(before).alias(h) for h in held.values()), F.lit(False).alias(_REAL))
    both = rows.unionByName(carried, allowMissingColumns=True)
    frame = _inside(keys, [F.asc(c) for c in order])
    if peers:
        frame = frame.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = both.withColumns({name: F.sum(h).over(frame).cast("decimal(38,0)") for name, h in held.items()})
    return sums.where(_REAL).drop(_CHUNK, _REAL, *held.values())


def trailing_sums(
    df: DataFrame, keys: Sequence[str], ts: str, measures: dict[str, Column], width_us: int, chunk_us: int = CHUNK_US
) -> DataFrame:
    """Adds sums of ``measures`` over a key's rows of the last ``width_us`` up to and with each row's time.

    A row enters the running sums at its time and leaves them, with its sign turned, just after its time is out of
    reach; so a frame of any length costs two rows and no walk over its rows.
    """
    held = {name: f"__x{i}" for i, name in enumerate(measures)}
    rows = df.withColumns({held[n]: F.coalesce(m.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")) for n, m in measures.items()})
    rows = rows.withColumn("__in", F.lit(True))
    leaving = rows.select(*keys, (F.col(ts) + width_us + 1).alias(ts), *((-F.col(h)).cast("decimal(38,0)").alias(h) for h in held.values()), F.lit(False).alias("__in"))
    both = rows.unionByName(leaving, allowMissingColumns=True)
    sums = running_sums(both, keys, (ts,), {n: F.col(h) for n, h in held.items()}, chunk_us, peers=True)
    return sums.where("__in").drop("__in", *held.values())


def last_seen(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    output: str,
    descending: bool = False,
    chunk_us: int = CHUNK_US,
) -> DataFrame:
    """Adds ``output``: the last non-null ``value`` up to and with each row, walking ``order`` up or down."""
    rows = df.withColumns({_CHUNK: chunk_of(order[0], chunk_us), "__v": value, _REAL: F.lit(True)})
    place = F.when(F.col("__v").isNotNull(), F.struct(*order))
    latest = (F.min_by if descending else F.max_by)("__v", place)
    chunks = rows.groupBy(*keys, _CHUNK).agg(latest.alias("__v"))
    by_chunk = Window.partitionBy(*keys).orderBy(F.desc(_CHUNK) if descending else F.asc(_CHUNK))
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(*keys, _CHUNK, F.last("__v", ignorenulls=True).over(before).alias("__v"), F.lit(False).alias(_REAL))
    both = rows.unionByName(carried.where("__v is not null"), allowMissingColumns=True)
    sort = [F.desc(c) if descending else F.asc(c) for c in order]
    seen = both.withColumn(output, F.last("__v", ignorenulls=True).over(_inside(keys, sort)))
    return seen.where(_REAL).drop(_CHUNK, "__v", _REAL)


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, output: str, chunk_us: int = CHUNK_US
) -> DataFrame:
    """Adds ``output``: ``value`` of the row before, null in the first row of each key, across all chunks.

    The value must not be null: a chunk hands on its last one.
    """
    rows = df.withColumns({_CHUNK: chunk_of(order[0], chunk_us), "__v": value, _REAL: F.lit(True)})
    ends = rows.groupBy(*keys, _CHUNK).agg(F.max_by("__v", F.struct(*order)).alias("__v"))
    carried = ends.select(*keys, _CHUNK, F.lag("__v").over(Window.partitionBy(*keys).orderBy(_CHUNK)).alias("__v"), F.lit(False).alias(_REAL))
    both = rows.unionByName(carried.where("__v is not null"), allowMissingColumns=True)
    walk = Window.partitionBy(*keys, _CHUNK).orderBy(F.asc(_REAL), *(F.asc(c) for c in order))
    return both.withColumn(output, F.lag("__v").over(walk)).where(_REAL).drop(_CHUNK, "__v", _REAL)
