"""Fixed-point numbers, and division that gives null instead of an error.

``div`` and ``floor`` of decimals lose digits in Spark (``div`` wraps, a quotient is rounded to six digits first),
so whole-number division of decimals takes the remainder away first.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import log10

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .specs import SCALE, spec


def to_fixed(value: Column, scale: int = SCALE) -> Column:
    """Double to fixed-point long, half to even."""
    return F.rint(value.cast("double") * F.lit(float(scale))).cast("long")


def from_fixed(value: Column, scale: int = SCALE) -> Column:
    return F.round(value.cast("double") / F.lit(float(scale)), round(log10(scale)))


def wide(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def whole_quotient(value: Column, by: int) -> Column:
    """value // by for non-negative decimals of scale 0, exact, as decimal(38,0)."""
    value = value.cast("decimal(38,0)")
    return ((value - value % F.lit(by).cast("decimal(38,0)")) / F.lit(by).cast("decimal(38,0)")).cast("decimal(38,0)")


def notional(price: Column, qty: Column) -> Column:
    """abs(price) * abs(qty) // 10^9 as decimal(38,0), exact."""
    return whole_quotient((wide(F.abs(price)) * wide(F.abs(qty))).cast("decimal(38,0)"), SCALE)


def divide(a: Column, b: Column) -> Column:
    """a / b as double; null where b is 0 or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def decode_scaled(
    df: DataFrame, table: str, columns: Iterable[str] | None = None, in_place: bool = False, suffix: str = "_decoded"
) -> DataFrame:
    """Fixed-point columns as doubles, in place or beside the originals; nulls stay null."""
    scaled = spec(table).scaled
    wanted = [c for c in scaled if c in df.columns] if columns is None else list(columns)
    if bad := [c for c in wanted if c not in scaled]:
        raise ValueError(f"{table}: not fixed-point columns: {bad}")
    if bad := [c for c in wanted if c not in df.columns]:
        raise ValueError(f"{table}: columns are missing: {bad}")
    if not in_place and not suffix:
        raise ValueError("a suffix is needed unless decoding in place")
    return df.withColumns({c if in_place else f"{c}{suffix}": from_fixed(F.col(c), scaled[c]) for c in wanted})


def decode_ladders(df: DataFrame, prices: Iterable[str], scale: int = SCALE) -> DataFrame:
    """Price ladders (arrays of fixed-point longs) as arrays of doubles; quantity ladders are not scaled."""
    return df.withColumns({c: F.transform(c, lambda x: from_fixed(x, scale)) for c in prices})
