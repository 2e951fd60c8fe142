"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One or more of space, tab, LF, VT, FF, CR; everything else belongs to a word.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="spark-checkpoint-")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` from reliable storage, so that a lost executor replays nothing."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def remainder(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null where the id is null."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def held_out(id_col: str | Column, modulus: int) -> Column:
    """True where the remainder is 0.  A null id has no remainder: not held out, not learned from."""
    return F.coalesce(remainder(id_col, modulus) == 0, F.lit(False))


def learned(id_col: str | Column, modulus: int) -> Column:
    return F.coalesce(remainder(id_col, modulus) != 0, F.lit(False))


def utf8(text_col: str) -> Column:
    """The whole text as UTF-8 bytes; null stays null."""
    return F.col(text_col).cast("string").cast("binary")


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in ascending order, by a sort: several times faster than by the hash table of ``np.unique``."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values
