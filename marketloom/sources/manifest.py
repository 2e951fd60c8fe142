"""The ingest ledger: file identities, ids, what is pending, and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import row_index

IDENTITY = ("vendor", "data_type", "bronze_path", "file_hash")


def latest(manifest: DataFrame) -> DataFrame:
    """The last state of each file id; the ledger is appended to, never rewritten.

    A processed state is later than the pending one of the same moment.
    """
    names = [c for c in manifest.columns if c != "file_id"]
    done = F.col("processed_at_ts_us")
    state = F.max_by(F.struct(*names), F.struct(F.greatest(done, "created_at_ts_us"), done.isNotNull(), "status"))
    return manifest.groupBy("file_id").agg(state.alias("s")).select("file_id", *(F.col("s")[c].alias(c) for c in names))


def filter_pending(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Candidates whose identity has not succeeded; any other status is tried again."""
    done = latest(manifest).where("status = 'success'").select(*IDENTITY)
    return candidates.join(done, list(IDENTITY), "left_anti")


def assign_ids(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Adds ``file_id`` and ``created_at_ts_us``: those of a known identity, else the next numbers in order of path.

    The numbers are kept, so that they do not change when the result is read again.
    """
    known = manifest.groupBy(*IDENTITY).agg(F.min("file_id").alias("__id"), F.min("created_at_ts_us").alias("__at"))
    both = candidates.join(known, list(IDENTITY), "left")
    top = manifest.agg(F.coalesce(F.max("file_id"), F.lit(0)).alias("__top"))
    fresh = both.where("__id is null").select(*IDENTITY).distinct()
    numbered = row_index(fresh, IDENTITY, "__n").withColumn("__n", F.col("__n") + 1)
    joined = both.join(numbered, list(IDENTITY), "left").crossJoin(F.broadcast(top))  # one row
    return joined.withColumns(
        {"file_id": F.coalesce("__id", (F.col("__top") + F.col("__n")).cast("long")), "created_at_ts_us": F.col("__at")}
    ).drop("__id", "__at", "__n", "__top")


def manifest_diff(files: DataFrame, manifest: DataFrame, vendor: str) -> DataFrame:
    """Files on disk whose path the vendor's ledger lacks."""
    return files.join(manifest.where(F.col("vendor") == vendor).select("bronze_path").distinct(), "bronze_path", "left_anti")


def manifest_summary(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("vendor", "data_type", "status").agg(
        F.count("*").alias("n_files"), F.sum("rows_written").alias("rows_written"), F.sum("rows_quarantined").alias("rows_quarantined")
    )


def manifest_list(
    manifest: DataFrame, status: str | None = None, vendor: str | None = None, data_type: str | None = None, limit: int | None = None
) -> DataFrame:
    """Entries by equality on what is given, newest id first."""
    rows = manifest
    for column, value in (("status", status), ("vendor", vendor), ("data_type", data_type)):
        if value is not None:
            rows = rows.where(F.col(column) == value)
    rows = rows.orderBy(F.desc("file_id"))
    return rows if limit is None else rows.limit(limit)


def manifest_show(manifest: DataFrame, file_id: int) -> DataFrame:
    return manifest.where(F.col("file_id") == file_id)
