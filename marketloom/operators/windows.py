"""Offsets and rolling windows over bars, per key in time order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..core.numeric import divide
from ..core.storage import kept
from .scan import CHUNK_US, running_sum

#: Consecutive rows of a key that one task walks.
STRETCH = 1 << 16


def by(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def lagged(column: str | Column, k: int, w) -> Column:
    return F.lag(column, k).over(w)


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    back: int = 0,
    ahead: int = 0,
    stretch: int = STRETCH,
    index: str | None = None,
    chunk: int = CHUNK_US,
) -> DataFrame:
    """Adds ``columns(w)``, where ``w`` is the window of a key's rows in order, a key being many tasks.

    The rows of a key are numbered (by a running count, or by ``index`` if it is 0, 1, ... already) and cut into
    stretches; a stretch has the last ``back`` rows of the one before and the first ``ahead`` rows of the next as a
    halo, which is left out of the result.  The columns may look no further than that.  ``order`` starts with a long,
    whose chunks of ``chunk`` are counted in one task each, and must tell all rows of a key apart.
    """
    stretch = max(stretch, back, ahead)
    if index is None:
        df = running_sum(df, keys, order, F.lit(1), "__i", chunk).withColumn("__i", F.col("__i").cast("long") - 1)
    else:
        df = df.withColumn("__i", F.col(index))
    own, place = F.floor(F.col("__i") / stretch), F.pmod("__i", F.lit(stretch))
    parts = F.array(own, F.when(place >= stretch - back, own + 1), F.when((place < ahead) & (own > 0), own - 1))
    dealt = df.select("*", own.alias("__own"), F.explode(F.array_compact(parts)).alias("__part"))
    w = Window.partitionBy(*keys, "__part").orderBy("__i")
    return dealt.withColumns(columns(w)).where("__part = __own").drop("__i", "__own", "__part")


def returns(df: DataFrame, keys, order, price: str = "close", steps: Sequence[int] = (1, 3, 5, 10)) -> DataFrame:
    """Returns over ``steps`` rows; a key with most rows is many tasks."""
    columns = lambda w: {f"ret_{k}bar": divide(F.col(price), lagged(price, k, w)) - 1 for k in steps}
    return windowed(df, keys, order, columns, back=max(steps))


def forward_returns(df: DataFrame, keys, order, price: str = "close", steps: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """Returns over the next ``steps`` rows; a key with most rows is many tasks."""
    columns = lambda w: {f"fwd_ret_{k}bar": divide(F.lead(price, k).over(w), F.col(price)) - 1 for k in steps}
    return windowed(df, keys, order, columns, ahead=max(steps))


def rolling_mean(column: str, n: int, w, least: int | None = None) -> Column:
    """Mean of the last n rows; null until ``least`` (all n, if not given) values are there."""
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(column).over(frame) >= (n if least is None else least), F.avg(column).over(frame))


def rolling_std(column: str, n: int, w) -> Column:
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(column).over(frame) >= n, F.stddev_samp(column).over(frame))


def rolling_median(column: str, n: int, w) -> Column:
    """Median of the last n rows; null until all n are there.  Spark's ``median`` takes no frame."""
    values = F.sort_array(F.collect_list(column).over(w.rowsBetween(1 - n, 0)))
    low, high = (n - 1) // 2 + 1, n // 2 + 1
    middle = (F.try_element_at(values, F.lit(low)) + F.try_element_at(values, F.lit(high))) / 2
    return F.when(F.size(values) >= n, middle)


def diff(column: str, w) -> Column:
    return F.col(column) - F.lag(column).over(w)


def changed(column: str, w) -> Column:
    """Whether the value differs from the one before; null in the first row."""
    return F.col(column) != F.lag(column).over(w)


def persistence(column: str, w) -> Column:
    return F.col(column) * F.lag(column).over(w)


def row_index(df: DataFrame, order: Sequence[str], output: str = "row_index") -> DataFrame:
    """Adds 0, 1, ... in the order of the columns, which must tell all rows apart.

    Rows are dealt in ranges and numbered inside each; the ranges' counts, a row each, give the offsets.  The numbers
    are kept, so that they do not change when the result is read again.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged = kept(ranged.withColumn("__own", F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    offsets = ranged.groupBy("__range").count().select("__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    out = ranged.join(F.broadcast(offsets), "__range").withColumn(output, (F.col("__own") + F.col("__offset")).cast("long"))
    return out.select(*df.columns, output)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, columns) of the first row of each key by ``order``; combined on the way, so no key is sorted."""
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("__x"))
    return first.select(*keys, *(F.col("__x")[c].alias(c) for c in columns))


def order_check(df: DataFrame, keys: Sequence[str] = ("exchange", "symbol"), ts: str = "ts_event_us") -> DataFrame:
    """(keys, n_backwards): keys whose time goes back in file order."""
    w = Window.partitionBy(*keys, "file_id").orderBy("file_seq")
    steps = df.select(*keys, (F.col(ts) - F.lag(ts).over(w)).alias("d"))
    return steps.where("d < 0").groupBy(*keys).agg(F.count("*").alias("n_backwards"))
