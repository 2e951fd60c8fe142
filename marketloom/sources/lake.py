"""Event and dimension tables as Parquet folders under one root."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.specs import TableSpec, event_spec, spec, validate_schema
from ..core.timeutil import bounds, date_bounds
from ..operators.dimension import as_of as valid_at
from ..operators.dimension import validate
from ..operators.validation import REASON
from .manifest import latest

LINEAGE = ("file_id", "file_seq")


def read_table(spark: SparkSession, root: str, table: str, with_path: bool = False) -> DataFrame:
    """The table with its own types, and the ``path`` of each row's file if asked; an empty one where nothing was
    written yet."""
    s = spec(table)
    try:
        rows = spark.read.schema(s.schema).parquet(f"{root}/{table}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return s.empty(spark).withColumn("path", F.lit("")) if with_path else s.empty(spark)
    return rows.select(*s.names, *([F.col("_metadata.file_path").alias("path")] if with_path else []))


def _file_system(spark: SparkSession, path: str):
    """(the path for Hadoop, its file system)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder, if it is there."""
    hadoop, fs = _file_system(spark, path)
    fs.delete(hadoop, True)


def _projection(s: TableSpec, columns: Sequence[str] | None, include_lineage: bool) -> list[str]:
    if columns is None:
        return [n for n in s.names if include_lineage or n not in LINEAGE]
    if unknown := [c for c in columns if c not in s.names]:
        raise ValueError(f"{s.name} has no columns {unknown}")
    return list(columns) + [c for c in LINEAGE if include_lineage and c not in columns]


def select_events(
    df: DataFrame,
    table: str,
    exchange: str,
    symbols: str | Iterable[str],
    start,
    end,
    columns: Sequence[str] | None = None,
    include_lineage: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Rows of [start, end) of an exchange's symbols.

    The dates that the window can touch in the exchange's zone are added as a predicate on the partition
    column, so other partitions are not read.  ``ordered=False`` spares the sort by tie-break keys.
    """
    s = event_spec(table)
    a, b = bounds(start, end)
    exchange = exchange.strip().lower()
    first, last = date_bounds(a, b, exchange)
    names = [symbols] if isinstance(symbols, str) else list(symbols)
    chosen = _projection(s, columns, include_lineage)
    rows = df.where(
        (F.col("exchange") == exchange)
        & F.col("trading_date").between(F.lit(first), F.lit(last))
        & F.col("symbol").isin(*names)
        & (F.col("ts_event_us") >= a)
        & (F.col("ts_event_us") < b)
    ).select(*dict.fromkeys((*chosen, *s.tie_break_keys)))
    return (rows.orderBy(*s.tie_break_keys) if ordered else rows).select(*chosen)


def load_events(spark: SparkSession, root: str, table: str, exchange: str, symbol: str, start, end, **options) -> DataFrame:
    return select_events(read_table(spark, root, event_spec(table).name), table, exchange, symbol, start, end, **options)


TRADE_COLUMNS = ("exchange", "symbol", "symbol_id", "ts_event_us", "file_id", "file_seq", "price", "qty")


def load_trades_multi(df: DataFrame, exchange: str, symbols: Iterable[str], start, end, ordered: bool = True) -> DataFrame:
    """Trades of several symbols: eight columns, by exchange, symbol, time and place in the file."""
    rows = select_events(df, "trades", exchange, symbols, start, end, TRADE_COLUMNS, ordered=False)
    return rows.orderBy("exchange", "symbol", "ts_event_us", "file_id", "file_seq") if ordered else rows


DISCOVERY = ("symbol_id", "exchange", "exchange_symbol", "canonical_symbol", "market_type", "base_asset", "quote_asset")


def load_symbol_meta(
    dim: DataFrame, exchange: str, symbols: Iterable[str] | None = None, as_of: int | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Versions of an exchange's symbols, current or valid at a time; by symbol, latest start first."""
    if columns is not None and (unknown := [c for c in columns if c not in dim.columns]):
        raise ValueError(f"the dimension has no columns {unknown}")
    rows = valid_at(dim.where(F.col("exchange") == exchange.strip().lower()), as_of)
    if symbols is not None:
        rows = rows.where(F.col("exchange_symbol").isin(*dict.fromkeys(s.strip() for s in symbols)))
    return rows.orderBy(F.asc("exchange_symbol"), F.desc("valid_from_ts_us")).select(*(columns or dim.columns))


def discover_symbols(
    dim: DataFrame, exchange: str, q: str | None = None, as_of: int | None = None, include_meta: bool = False, limit: int = 50
) -> DataFrame:
    """Up to ``limit`` symbols whose names or base asset hold ``q``, in any case, as literal text."""
    if limit <= 0:
        raise ValueError("limit must be > 0")
    rows = valid_at(dim.where(F.col("exchange") == exchange.strip().lower()), as_of)
    if q and q.strip():
        needle = F.lit(q.strip().lower())
        hit = [F.coalesce(F.lower(c).contains(needle), F.lit(False)) for c in ("exchange_symbol", "canonical_symbol", "base_asset")]
        rows = rows.where(hit[0] | hit[1] | hit[2])
    rows = rows.orderBy(F.asc("exchange_symbol"), F.desc("valid_from_ts_us")).limit(limit)
    return rows if include_meta else rows.select(*DISCOVERY)


def append_events(df: DataFrame, root: str, table: str) -> None:
    """Appends rows, dealt in ranges of symbol and time inside each partition, so that a reader of one symbol skips the
    files and row groups of others by their statistics, and one symbol's day is as many files as it needs."""
    s = event_spec(table)
    validate_schema(df, s)
    order = [*s.partition_by, "symbol", "ts_event_us"]
    df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode("append").partitionBy(*s.partition_by).parquet(f"{root}/{table}")


def save_dim(df: DataFrame, root: str) -> None:
    """Replaces the dimension: a new version's folder; readers take the latest one that is complete.

    Of two writers at once one fails, since the folder of a version is written once.
    """
    spark = df.sparkSession
    validate_schema(df, "dim_symbol")
    versions = _versions(spark, root)
    validate(df).write.parquet(f"{root}/dim_symbol/v={(versions[-1] if versions else 0) + 1:010d}")


def load_dim(spark: SparkSession, root: str) -> DataFrame:
    versions = _versions(spark, root)
    if not versions:
        return spec("dim_symbol").empty(spark)
    return spark.read.schema(spec("dim_symbol").schema).parquet(f"{root}/dim_symbol/v={versions[-1]:010d}")


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Versions whose write was committed."""
    path, fs = _file_system(spark, f"{root}/dim_symbol")
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path)]
    done = [p for p in found if p.getName().startswith("v=") and fs.exists(_file_system(spark, f"{p}/_SUCCESS")[0])]
    return sorted(int(p.getName()[2:]) for p in done)


def quarantine_rows(rejected: DataFrame, table: str, logged_at_us: int) -> DataFrame:
    """Rejected rows as rows of ``validation_log``; ``logged_at_ts_us`` adds the row's place in its file."""
    have = set(rejected.columns)
    optional = {"file_seq": "long", "ts_event_us": "long", "symbol": "string", "symbol_id": "long"}
    made = {c: (F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in optional.items()}
    offset = F.coalesce(F.col("file_seq") - 1, F.lit(0)) if "file_seq" in have else F.lit(0)
    return rejected.select(
        "file_id",
        F.col(REASON).alias("rule_name"),
        F.lit("error").alias("severity"),
        (F.lit(logged_at_us) + offset).cast("long").alias("logged_at_ts_us"),
        made["file_seq"],
        F.lit(None).cast("string").alias("field_name"),
        F.lit(None).cast("string").alias("field_value"),
        made["ts_event_us"],
        made["symbol"],
        made["symbol_id"],
        F.lit(f"quarantined:{table}").alias("message"),
    )


def append_quarantine(rejected: DataFrame, root: str, table: str, logged_at_us: int) -> None:
    quarantine_rows(rejected, table, logged_at_us).write.mode("append").parquet(f"{root}/validation_log")


def write_output(df: DataFrame, path: str, kind: str = "parquet", limit: int | None = None) -> None:
    rows = df if limit is None else df.limit(limit)
    if kind == "csv":
        rows.write.option("header", True).csv(path)
    elif kind in ("json", "parquet"):
        getattr(rows.write, kind)(path)
    else:
        raise ValueError(f"unknown format {kind!r}")


def write_features(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


#: A folder that is being swapped lists its old files here; names that begin like this are not read as data.
_SWAP, _NEW = "_swap", "_new-"


def finish_swap(spark: SparkSession, folder: str) -> None:
    """Ends a swap that a crash has stopped: forward if the old files were already listed, back if not."""
    path, fs = _file_system(spark, folder)
    if not fs.exists(path):
        return
    marker, _ = _file_system(spark, f"{folder}/{_SWAP}")
    new = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith(_NEW)]
    if not fs.exists(marker):
        for p in new:
            fs.delete(p, False)
        return
    listed = fs.open(marker)
    names = spark._jvm.org.apache.commons.io.IOUtils.toString(listed, "UTF-8").split()
    listed.close()
    for name in names:
        fs.delete(_file_system(spark, f"{folder}/{name}")[0], False)
    for p in new:
        fs.rename(p, _file_system(spark, f"{folder}/{p.getName().removeprefix(_NEW)}")[0])
    fs.delete(marker, False)


def swap_files(spark: SparkSession, staged: str, folder: str) -> None:
    """Puts the data files of ``staged`` in the place of those of ``folder``.

    New files are moved in under names that readers skip; then the old ones are listed, from where on a crash is
    mended forward by ``finish_swap``; then the old ones go and the new ones get their names.
    """
    source, fs = _file_system(spark, staged)
    target, _ = _file_system(spark, folder)
    old = [s.getPath().getName() for s in fs.listStatus(target)]
    for s in fs.listStatus(source):
        if (name := s.getPath().getName()).endswith(".parquet"):
            fs.rename(s.getPath(), _file_system(spark, f"{folder}/{_NEW}{name}")[0])
    out = fs.create(_file_system(spark, f"{folder}/{_SWAP}")[0])
    out.write(bytearray("\n".join(n for n in old if n.endswith(".parquet") and n[0] not in "._"), "utf-8"))
    out.close()
    finish_swap(spark, folder)


def compact_partitions(
    spark: SparkSession,
    root: str,
    table: str,
    partitions: Sequence[dict],
    target_bytes: int = 128 << 20,
    min_small_files: int = 8,
    dry_run: bool = False,
    continue_on_error: bool = True,
    at_once: int = 4,
) -> DataFrame:
    """Rewrites each partition that has at least ``min_small_files`` small files; returns a report.

    (partition, files_before, files_after, bytes_before, skipped, error).  Rows are written to a staged folder and
    swapped in, so a failure leaves the old files or, after the next call, the new ones; the staged folder goes in
    either case.  A partition with rows of a pending file waits until that one's ingest has ended.  ``at_once``
    partitions are worked on at a time.  Errors are reported and others go on, unless ``continue_on_error`` is off.
    """
    s = event_spec(table)
    if bad := [p for p in partitions if set(p) != set(s.partition_by)]:
        raise ValueError(f"{table}: partition keys must be {s.partition_by}, not {bad}")
    wanted = sorted({tuple((k, str(p[k])) for k in s.partition_by) for p in partitions})
    open_files = latest(read_table(spark, root, "ingest_manifest")).where("status = 'pending'").select("file_id")

    def one(values) -> tuple:
        name = "/".join(f"{k}={v}" for k, v in values)
        path, staged = f"{root}/{table}/{name}", f"{root}/_staged/{uuid4().hex}"
        sizes: list[int] = []
        try:
            if not dry_run:
                finish_swap(spark, path)
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
            sizes = [r["length"] for r in files.select("length").collect()]  # one number per file of one partition
            small = [n for n in sizes if n < target_bytes]
            after, columns = max(1, -(-sum(sizes) // target_bytes)), [c for c in s.names if c not in s.partition_by]
            skipped = "dry_run" if dry_run else "below_min_small_files" if len(small) < min_small_files else None
            if skipped is None:
                rows = spark.read.schema(s.schema).parquet(path).select(*columns)
                if not rows.join(open_files, "file_id", "left_semi").isEmpty():
                    skipped = "pending_ingest"
                else:
                    order = [k for k in s.tie_break_keys if k in columns]
                    rows.repartition(after).sortWithinPartitions(*order).write.parquet(staged)
                    swap_files(spark, staged, path)
            return name, len(sizes), after if skipped is None else len(sizes), sum(sizes), skipped, None
        except Exception as e:  # whatever stops one partition is its report
            if not continue_on_error:
                raise
            return name, len(sizes), len(sizes), sum(sizes), None, str(e).split("\n")[0]
        finally:
            delete(spark, staged)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        report = list(pool.map(one, wanted))
    return spark.createDataFrame(
        report, "partition string, files_before long, files_after long, bytes_before long, skipped string, error string"
    )
