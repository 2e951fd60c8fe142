"""Reading vendor files, and what their paths tell."""

from __future__ import annotations

import gzip
import hashlib
import os
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Streams of the archive names, and exchange codes.
STREAM_TABLES = {"order_new": "cn_order_events", "tick_new": "cn_tick_events", "L2_new": "cn_l2_snapshots"}
ARCHIVE_EXCHANGES = {"SZ": "szse", "SH": "sse"}
ARCHIVE = r"^(order_new|tick_new|L2_new|L1_new)_(STK|ConFI)_(SZ|SH)_([0-9]{8})\.7z$"
PARTITION = r"exchange=([^/]+)/type=([^/]+)/date=([0-9-]+)/symbol=([^/]+)/[^/]+\.csv(\.gz)?$"


def read_csv_typed(spark: SparkSession, paths, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and a given schema, and the path of each row's file; types are not inferred."""
    return spark.read.csv(paths, header=True, schema=schema).select("*", F.col("_metadata.file_path").alias("bronze_path"))


def read_csv_strings(spark: SparkSession, paths) -> DataFrame:
    """CSV with a header, all columns as text, and the path of each row's file."""
    rows = spark.read.csv(paths, header=True, inferSchema=False)
    return rows.select("*", F.col("_metadata.file_path").alias("bronze_path"))


def with_file_seq(df: DataFrame, by: str = "bronze_path", output: str = "file_seq") -> DataFrame:
    """Adds 1..n in the order of reading.  Compressed CSV is not split, so that is the order of lines."""
    order = Window.partitionBy(by).orderBy("__row")
    return df.withColumn("__row", F.monotonically_increasing_id()).withColumn(output, F.row_number().over(order).cast("long")).drop("__row")


#: Bytes of a file that a task holds at a time.
BLOCK = 8 << 20


def open_stream(path: str) -> BinaryIO:
    """A file's bytes as a stream, from local disks, HDFS or object stores that Arrow reads.

    Spark gives some paths with their odd characters escaped, some without; both are found.
    """
    from urllib.parse import unquote

    from pyarrow import fs

    if path.startswith("file:"):
        name = path.removeprefix("file:").replace("///", "/", 1)
        return open(name if os.path.exists(name) else unquote(name), "rb")
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_stream(name, buffer_size=BLOCK)


def digest(path: str, opened: Callable[[str], BinaryIO] = open_stream) -> str:
    """SHA-256 of a file, read in blocks."""
    found = hashlib.sha256()
    with opened(path) as stream:
        while block := stream.read(BLOCK):
            found.update(block)
    return found.hexdigest()


def fault(path: str, opened: Callable[[str], BinaryIO] = open_stream) -> str | None:
    """What keeps a file from being read to its end, or None; ``.gz`` is unpacked as it is read."""
    try:
        with opened(path) as stream:
            inner = gzip.GzipFile(fileobj=stream) if path.endswith(".gz") else stream
            while inner.read(BLOCK):
                pass
    except Exception as e:  # whatever zlib or a store raises is this file's fault alone
        return f"{type(e).__name__}: {e}"
    return None


def each_file(paths: DataFrame, function: Callable[[str], str | None], output: str, column: str = "bronze_path") -> DataFrame:
    """Adds ``function(path)``; files are dealt to tasks by their path, and a task has one open at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(**{output: [function(p) for p in frame[column]]})

    kinds = ", ".join(f"`{n}` {t}" for n, t in [*paths.dtypes, (output, "string")])
    tasks = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number is not made smaller: rows are few, files may not be
    return paths.repartition(tasks, column).mapInPandas(run, kinds)


def list_files(
    spark: SparkSession, folder: str, pattern: str = "*", hashes: bool = False, opened: Callable[[str], BinaryIO] = open_stream
) -> DataFrame:
    """(bronze_path, file_size_bytes, last_modified, sha256?) of a folder, subfolders included.

    Empty files are not listed.  Contents are read only for hashes, in blocks of ``BLOCK`` bytes, so files may be of any size; ``opened`` reaches
    stores that Arrow does not know.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    out = files.select(F.col("path").alias("bronze_path"), F.col("length").alias("file_size_bytes"), F.col("modificationTime").alias("last_modified"))
    return each_file(out, lambda path: digest(path, opened), "sha256") if hashes else out


def discover_partitions(files: DataFrame, exchange: str | None = None, data_type: str | None = None, limit: int | None = None) -> DataFrame:
    """(bronze_path, exchange, data_type, date, symbol) of paths like exchange=/type=/date=/symbol=/x.csv.gz."""
    part = lambda i: F.regexp_extract("bronze_path", PARTITION, i)
    rows = files.where(F.col("bronze_path").rlike(PARTITION)).select(
        "bronze_path",
        F.lower(part(1)).alias("exchange"),
        part(2).alias("data_type"),
        F.try_to_timestamp(part(3), F.lit("yyyy-MM-dd")).cast("date").alias("date"),
        part(4).alias("symbol"),
    )
    if exchange is not None:
        rows = rows.where(F.col("exchange") == exchange.strip().lower())
    if data_type is not None:
        rows = rows.where(F.col("data_type") == data_type)
    return rows if limit is None else rows.orderBy("bronze_path").limit(limit)


def parse_archive_names(df: DataFrame, column: str = "name") -> DataFrame:
    """Adds stream, market, exchange, trading_date, table and error of archive names."""
    part = lambda i: F.nullif(F.regexp_extract(column, ARCHIVE, i), F.lit(""))

    def mapped(pairs: dict[str, str], key: Column) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key)

    out = df.withColumns(
        {
            "stream": part(1),
            "market": part(2),
            "exchange": mapped(ARCHIVE_EXCHANGES, part(3)),
            "trading_date": F.try_to_timestamp(part(4), F.lit("yyyyMMdd")).cast("date"),
            "table": mapped(STREAM_TABLES, part(1)),
        }
    )
    error = F.when(F.col("stream").isNull(), "invalid archive name").when(F.col("table").isNull(), "unsupported stream")
    return out.withColumn("error", error)


def member_symbol(path: Column) -> Column:
    """Symbol of an archive member: the name of a .csv; null for anything else."""
    return F.nullif(F.trim(F.regexp_extract(path, r"(?i)([^/]*)\.csv$", 1)), F.lit(""))
