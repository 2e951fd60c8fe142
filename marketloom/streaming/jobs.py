"""Incremental ingest and bars on a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..core.storage import kept
from ..operators.bars import decoded, exact_sum, first_by_order, last_by_order
from ..sources import ingest as batch
from ..sources.files import with_file_seq


def stream_time_bars(trades: DataFrame, width: str = "1 minute", late: str = "1 minute") -> DataFrame:
    """Bars of a stream of trades, each emitted once when the watermark has passed it (append mode).

    Rows later than the watermark are dropped by Spark; closed bars equal those of ``time_bars``.
    """
    stamped = trades.withColumn("event_time", F.timestamp_micros("ts_event_us")).withWatermark("event_time", late)
    bars = stamped.groupBy("exchange", "symbol", F.window("event_time", width).alias("w")).agg(
        decoded(first_by_order("price")).alias("open"),
        decoded(F.max("price")).alias("high"),
        decoded(F.min("price")).alias("low"),
        decoded(last_by_order("price")).alias("close"),
        decoded(exact_sum(F.col("qty"))).alias("volume"),
        F.count("*").alias("trade_count"),
    )
    return bars.select(
        "exchange", "symbol", F.unix_micros("w.start").alias("bar_start_us"), "open", "high", "low", "close", "volume", "trade_count"
    )


def stream_trade_clusters(trades: DataFrame, gap: str = "1 second", late: str = "1 minute") -> DataFrame:
    """Runs of trades with at most ``gap`` between neighbours, each emitted once when the watermark has passed its end.

    State is one row for each open run.  Closed runs equal those of ``microstructure.trade_clusters``.
    """
    stamped = trades.withColumn("event_time", F.timestamp_micros("ts_event_us")).withWatermark("event_time", late)
    bought = F.when(F.col("side") == "buy", F.col("qty").cast("decimal(19,0)"))
    runs = stamped.groupBy("exchange", "symbol", F.session_window("event_time", gap).alias("w")).agg(
        F.min("ts_event_us").alias("start_us"),
        F.max("ts_event_us").alias("end_us"),
        F.count("*").alias("n"),
        exact_sum(F.col("qty")).cast("long").alias("qty"),
        F.try_divide(F.coalesce(F.sum(bought), F.lit(0)).cast("double"), exact_sum(F.col("qty")).cast("double")).alias("buy_share"),
    )
    return runs.select("exchange", "symbol", "start_us", "end_us", "n", "qty", "buy_share")


def stream_ingest(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    root: str,
    vendor: str,
    data_type: str,
    dim: Callable[[], DataFrame],
    checkpoint: str,
    exchange: str | None = None,
) -> StreamingQuery:
    """Ingests CSV files as they appear under ``folder``; the ledger keeps restarts from writing a file twice.

    A file is known by its path and by a digest of its rows, so another content under an old path is another file.
    """

    def each(rows: DataFrame, _: int) -> None:
        rows = kept(rows)
        columns = [F.col(f"`{c}`") for c in rows.columns if c != "bronze_path"]
        sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (1, 2)]
        found = rows.groupBy("bronze_path").agg(F.concat_ws(":", F.count("*"), *sums).alias("digest"))
        files = found.select(
            F.lit(vendor).alias("vendor"), F.lit(data_type).alias("data_type"), "bronze_path", F.sha2("digest", 256).alias("file_hash")
        )

        def read(paths: list[str]) -> DataFrame:
            asked = spark.createDataFrame([(p,) for p in paths], "bronze_path string")
            return with_file_seq(rows.join(asked, "bronze_path", "left_semi"))

        batch.ingest(spark, root, files, read, data_type, dim(), exchange=exchange)

    source = spark.readStream.schema(schema).option("header", True).csv(folder).select("*", F.col("_metadata.file_path").alias("bronze_path"))
    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
