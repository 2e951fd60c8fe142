"""Batch ingest: many raw files of one data type in one job.

Rows are normalised by a parser, marked by the rules, given the symbol version valid at their time, and
written as events or as quarantine; counts per file become the ledger's rows.  Every row of a file that has a
parse error is left out and the file is failed; other files go on.

Raw files are read and parsed once: marked rows go to a staged folder, and all else reads that.  The ledger has the
files as pending before anything else is written.  If the reading or parsing of a batch breaks, the files are looked
through, those that cannot be read to their end are failed, and the others go on without them; what still breaks is
halved until the file is found that does it, so one bad file fails alone.  After a crash the next run over the same files finds them pending,
takes away what the broken run had written for them (whole files, since a run writes its own) and starts anew.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.specs import normalize, spec
from ..core.storage import kept
from ..core.timeutil import trading_date
from ..operators.dimension import pit_coverage
from ..operators.validation import REASON, mark
from . import cn, crypto, files as raw_files, lake, manifest
from .crypto import ERROR

#: Files whose own batch broke, after which the fault is taken to lie elsewhere.
MOST_BROKEN = 20

#: Names of data types, and their tables.
ALIASES = {
    "trades": "trades",
    "quotes": "quotes",
    "orderbook_updates": "orderbook_updates",
    "incremental_book_L2": "orderbook_updates",
    "incremental_book_l2": "orderbook_updates",
    "derivative_ticker": "derivative_ticker",
    "liquidations": "liquidations",
    "options_chain": "options_chain",
    "cn_order_events": "cn_order_events",
    "order_new": "cn_order_events",
    "l3_orders": "cn_order_events",
    "cn_tick_events": "cn_tick_events",
    "tick_new": "cn_tick_events",
    "l3_ticks": "cn_tick_events",
    "cn_l2_snapshots": "cn_l2_snapshots",
    "L2_new": "cn_l2_snapshots",
    "l2_new": "cn_l2_snapshots",
}
_COUNTS = (
    "file_id long, rows_total long, rows_written long, rows_quarantined long, trading_date_min date, trading_date_max date, reasons string, error string"
)
Parser = Callable[[DataFrame], DataFrame]
Writer = Callable[[DataFrame, str], None]
#: Parsers by table; a caller may add its own or pass one.
PARSERS: dict[str, Parser] = {
    "trades": crypto.trades,
    "quotes": crypto.quotes,
    "orderbook_updates": crypto.book,
    "derivative_ticker": crypto.ticker,
    "liquidations": crypto.liquidations,
    "options_chain": crypto.options,
}


def table_of(data_type: str) -> str:
    try:
        return ALIASES[data_type]
    except KeyError:
        raise ValueError(f"unsupported data type {data_type!r}; there are {sorted(ALIASES)}") from None


def parser_of(table: str, exchange: str | None = None) -> Parser:
    by_exchange = {"cn_order_events": cn.orders, "cn_tick_events": cn.ticks, "cn_l2_snapshots": cn.snapshots}
    if table in by_exchange:
        if exchange is None:
            raise ValueError(f"{table}: the exchange must be given")
        return lambda df: by_exchange[table](df, exchange)
    return PARSERS[table]


@dataclass(frozen=True)
class Marked:
    """Rows with file_id, file_seq, all table columns, parse_error, file_failed and quarantine_reason."""

    rows: DataFrame
    table: str

    @property
    def valid(self) -> DataFrame:
        return normalize(self.rows.where(f"not file_failed and {REASON} is null"), self.table)

    @property
    def rejected(self) -> DataFrame:
        return self.rows.where(f"not file_failed and {REASON} is not null")

    def counts(self) -> DataFrame:
        """Per file: rows, written, quarantined, dates, reasons and error."""
        good = F.col(REASON).isNull() & ~F.col("file_failed")
        return self.rows.groupBy("file_id").agg(
            F.count("*").alias("rows_total"),
            F.count_if(good).alias("rows_written"),
            F.count_if(F.col(REASON).isNotNull() & ~F.col("file_failed")).alias("rows_quarantined"),
            F.min(F.when(good, F.col("trading_date"))).alias("trading_date_min"),
            F.max(F.when(good, F.col("trading_date"))).alias("trading_date_max"),
            F.concat_ws("+", F.array_sort(F.collect_set(REASON))).alias("reasons"),
            F.min(ERROR).alias("error"),
        )


def marked_rows(raw: DataFrame, table: str, dim: DataFrame, parser: Parser | None = None, exchange: str | None = None) -> DataFrame:
    """Parsed rows with dates, parse errors, reasons and symbol ids; each row by itself."""
    parsed = (parser or parser_of(table, exchange))(raw)
    if ERROR not in parsed.columns:
        parsed = parsed.withColumn(ERROR, F.lit(None).cast("string"))
    dated = parsed.withColumn("trading_date", trading_date(F.col("ts_event_us"), F.col("exchange")))
    unknown = F.when(F.col("trading_date").isNull(), F.lit("unknown exchange"))
    dated = dated.withColumn(ERROR, F.coalesce(F.col(ERROR), unknown))
    return pit_coverage(mark(dated, table), dim)


def with_failed(rows: DataFrame, table: str) -> Marked:
    """Marks all rows of a file as failed that has a parse error."""
    failed = rows.where(F.col(ERROR).isNotNull()).select(F.col("file_id").alias("__f")).distinct()
    flagged = rows.join(failed, F.col("file_id") == F.col("__f"), "left").withColumn("file_failed", F.col("__f").isNotNull())
    return Marked(flagged.drop("__f"), table)


def mark_rows(raw: DataFrame, data_type: str, dim: DataFrame, parser: Parser | None = None, exchange: str | None = None) -> Marked:
    """``raw`` must have file_id and file_seq (numbered while reading, before any rule)."""
    table = table_of(data_type)
    return with_failed(marked_rows(raw, table, dim, parser, exchange), table)


def ledger_rows(files: DataFrame, counts: DataFrame, now_us: int) -> DataFrame:
    """Rows of ``ingest_manifest`` for files (identity and file_id) and their counts."""
    both = files.join(counts, "file_id", "left")
    if "fault" not in both.columns:
        both = both.withColumn("fault", F.lit(None).cast("string"))
    total = F.coalesce("rows_total", F.lit(0).cast("long"))
    written = F.coalesce("rows_written", F.lit(0).cast("long"))
    status = F.when(F.col("fault").isNotNull() | F.col("error").isNotNull() | (total == 0), "failed").when(written == 0, "quarantined").otherwise("success")
    reason = (
        F.when(F.col("fault").isNotNull(), F.concat(F.lit("pipeline_error: "), F.col("fault")))
        .when(F.col("error").isNotNull(), F.concat(F.lit("parser_error: "), F.col("error")))
        .when(total == 0, "empty_parse")
        .otherwise(F.nullif(F.col("reasons"), F.lit("")))
    )
    rows = both.withColumns(
        {
            "status": status,
            "rows_total": total,
            "rows_written": F.when(F.col("error").isNull(), written).otherwise(0).cast("long"),
            "rows_quarantined": F.coalesce("rows_quarantined", F.lit(0).cast("long")),
            "created_at_ts_us": F.coalesce("created_at_ts_us", F.lit(now_us)).cast("long"),
            "processed_at_ts_us": F.lit(now_us).cast("long"),
            "status_reason": reason,
        }
    )
    return normalize(rows, "ingest_manifest")


def staged_rows(
    spark: SparkSession, folder: str, paths: list[str], write: Callable[[list[str], str], None], look: Callable[[DataFrame], DataFrame]
) -> tuple[list[str], dict[str, str]]:
    """Writes the rows of ``paths`` to folders under ``folder``; returns the folders, and the faults of files left out.

    One job for all, as long as none breaks.  When one does, ``look`` tells once which files cannot be read to their
    end; after that a group that breaks is halved.  A file whose own job breaks has that as its fault.
    """
    groups, done, faults, looked, broken = [paths], [], {}, False, 0
    while groups:
        group = groups.pop()
        out = f"{folder}/{len(done)}-{uuid4().hex}"
        try:
            write(group, out)
            done.append(out)
            continue
        except Exception as e:
            lake.delete(spark, out)
            if len(group) == 1:
                broken += 1
                if broken > MOST_BROKEN:
                    raise
                faults[group[0]] = _message(e)
                continue
        if not looked:
            looked = True
            table = look(spark.createDataFrame([(p,) for p in group], "bronze_path string"))
            faults |= {r["bronze_path"]: r["fault"] for r in table.where("fault is not null").collect()}
            rest = [p for p in group if p not in faults]
            if len(rest) < len(group):
                groups += [rest] if rest else []
                continue
        groups += [group[len(group) // 2 :], group[: len(group) // 2]]
    return done, faults


def _message(e: Exception) -> str:
    text = str(e).strip() or type(e).__name__
    return text.splitlines()[0][:500]


def pending_rows(files: DataFrame, now_us: int) -> DataFrame:
    """Rows of ``ingest_manifest`` for files that a run is about to work on, later than all that was known of them."""
    none = {c: F.lit(None).cast("long") for c in ("rows_total", "rows_written", "rows_quarantined", "processed_at_ts_us")}
    none |= {c: F.lit(None) for c in ("trading_date_min", "trading_date_max", "status_reason")}
    return normalize(files.withColumns({"status": F.lit("pending"), "created_at_ts_us": F.lit(now_us)} | none), "ingest_manifest")


def take_back(spark: SparkSession, root: str, table: str, ids: DataFrame, unfinished: DataFrame) -> int:
    """Deletes files of the table and of the quarantine that a run over ``ids`` wrote before it broke off.

    A run writes files of its own, and all of its ids are among the ``unfinished`` ones; so a file goes if it holds rows
    of ``ids`` and of no finished file.  Compaction leaves them alone.  Returns the number of files.
    """
    gone = []
    for name in (table, "validation_log"):
        rows = lake.read_table(spark, root, name, with_path=True).select("file_id", "path")
        held = [r["path"] for r in rows.join(ids, "file_id", "left_semi").select("path").distinct().collect()]
        if held:
            own = spark.read.parquet(*held).select("file_id", F.col("_metadata.file_path").alias("path"))
            finished = own.join(unfinished, "file_id", "left_anti").select("path").distinct()
            gone += set(held) - {r["path"] for r in finished.collect()}
    for path in gone:
        lake.delete(spark, path)
    return len(gone)


def ingest(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    read: Callable[[list[str]], DataFrame],
    data_type: str,
    dim: DataFrame,
    parser: Parser | None = None,
    exchange: str | None = None,
    force: bool = False,
    dry_run: bool = False,
    now_us: int | None = None,
    writer: Writer | None = None,
    look: Callable[[DataFrame], DataFrame] = lambda paths: raw_files.each_file(paths, raw_files.fault, "fault"),
) -> DataFrame:
    """Ingests files (identity columns) that the ledger has not as success; returns their ledger rows.

    ``read`` turns paths into raw rows with bronze_path and file_seq; the driver lists the paths, as for any read.
    ``look`` tells the faults of raw files, (bronze_path) to (bronze_path, fault); it runs only when a batch breaks.
    A file that cannot be read, or whose rows break the job, is failed as ``pipeline_error`` and writes nothing; the
    others go on.  If ``MOST_BROKEN`` readable files break one by one, the error is raised.
    ``writer`` (valid rows, table) takes the place of the event store; it must bear a retry itself.  ``dry_run``
    writes nothing to the lake and numbers files 0.  ``force`` takes files that have succeeded as well, and writes
    their rows once more.  Two runs over the same files at the same time are not supported.
    """
    now, table = now_us or time.time_ns() // 1000, table_of(data_type)
    ledger = lake.read_table(spark, root, "ingest_manifest")
    pending = files if force else manifest.filter_pending(files, ledger)
    if dry_run:
        pending = pending.withColumns({"file_id": F.lit(0).cast("long"), "created_at_ts_us": F.lit(now).cast("long")})
    else:
        pending = manifest.assign_ids(pending, ledger)
    staged = f"{root}/_staged/{uuid4().hex}"
    try:
        pending.write.parquet(f"{staged}/files")  # fixed before anything else is written
        pending = spark.read.parquet(f"{staged}/files")
        paths = [r["bronze_path"] for r in pending.select("bronze_path").collect()]
        if not paths:
            return spec("ingest_manifest").empty(spark)
        if not dry_run:
            unfinished = manifest.latest(ledger).where("status = 'pending'").select("file_id")
            broken = unfinished.join(pending.select("file_id"), "file_id", "left_semi")
            if not broken.isEmpty():
                take_back(spark, root, table, broken, unfinished)
            pending_rows(pending, now).coalesce(1).write.mode("append").parquet(f"{root}/ingest_manifest")

        def write(group: list[str], out: str) -> None:
            numbered = read(group).join(pending.select("bronze_path", "file_id"), "bronze_path")
            found = marked_rows(numbered, table, dim, parser, exchange)
            normalize(found, table)  # wrong types are the batch's fault now, not the writer's later
            found.write.parquet(out)

        folders, faults = staged_rows(spark, f"{staged}/rows", paths, write, look)
        if folders:
            marked = with_failed(spark.read.parquet(*folders), table)
            counts = marked.counts()
        else:
            counts = spark.createDataFrame([], _COUNTS)
        told = spark.createDataFrame(list(faults.items()), "bronze_path string, fault string")
        rows = ledger_rows(pending.join(told, "bronze_path", "left"), counts, now)
        if dry_run:
            return kept(rows)
        if folders:
            lake.append_quarantine(marked.rejected, root, table, now)
            if writer is None:
                lake.append_events(marked.valid, root, table)
            else:
                writer(marked.valid, table)
        rows.coalesce(1).write.mode("append").parquet(f"{root}/ingest_manifest")
        done = kept(lake.read_table(spark, root, "ingest_manifest").where(F.col("processed_at_ts_us") == now).join(pending.select("file_id"), "file_id", "left_semi"))
        return done.select(*spec("ingest_manifest").names)
    finally:
        lake.delete(spark, staged)
