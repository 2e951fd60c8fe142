"""Co-trading: symbols whose trades fall together, as a weighted graph."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..core.numeric import divide, wide
from ..core.storage import kept
from .bars import decoded

TOLERANCE_US = 1_000
#: Trades of a block, about: what one task looks at at a time.
CROWDED = 100_000

_ORDER = ["ts", "symbol", "file_id", "file_seq", "qty"]


def _blocks(trades: DataFrame, tolerance_us: int) -> DataFrame:
    """(block, own, ts, symbol, file_id, file_seq, qty): the distinct trades in blocks of their order, with a halo.

    A block is a range of the order, so a crowded time, as at an opening auction, is several blocks.  Of the trades
    around a block its own can only be nearest to the last ones of each symbol before it and the first ones behind it,
    so its halo (``own`` is false) has at most two rows of a symbol, however many trades the tolerance spans.
    """
    one = trades.select(F.col("ts_event_us").alias("ts"), "symbol", "file_id", "file_seq", F.col("qty").cast("long").alias("qty"))
    one = one.where(F.col("ts").isNotNull() & F.col("symbol").isNotNull())
    n = max(1, ceil(one.count() / CROWDED))
    rows = kept(one.repartitionByRange(n, *_ORDER).withColumn("block", F.spark_partition_id()).distinct())  # equal rows share a block
    # The ends of each block's symbols: a row for a block and symbol from here on.
    ident = ("file_id", "file_seq", "qty")
    backward = F.struct(F.bitwise_not("ts").alias("down"), *ident)  # the latest time first, but the smallest id of it
    ends = rows.groupBy("block", "symbol").agg(F.min(F.struct("ts", *ident)).alias("first"), F.min(backward).alias("last"))
    by_block = Window.partitionBy("symbol").orderBy("block")
    ends = ends.select(
        "symbol", "first", F.struct(F.bitwise_not("last.down").alias("ts"), *(f"last.{c}" for c in ident)).alias("last"), "block",
        F.coalesce(F.lag("block").over(by_block), F.lit(0)).alias("since"), F.coalesce(F.lead("block").over(by_block), F.lit(n - 1)).alias("until"),
    )
    # An end is seen by the blocks up to its symbol's next one, that one included.
    behind = ends.where("block < until").select("symbol", F.col("last").alias("x"), F.explode(F.sequence(F.col("block") + 1, "until")).alias("block"))
    ahead = ends.where("since < block").select("symbol", F.col("first").alias("x"), F.explode(F.sequence("since", F.col("block") - 1)).alias("block"))
    spans = rows.groupBy("block").agg(F.min("ts").alias("start"), F.max("ts").alias("stop"))
    halo = behind.unionByName(ahead).select("block", "symbol", "x.*").join(spans, "block")
    halo = halo.where((F.col("ts") >= F.col("start") - tolerance_us) & (F.col("ts") <= F.col("stop") + tolerance_us))
    # Trades of a symbol at one time may be spread over blocks: all ends there give the first one of them.
    together = Window.partitionBy("symbol", "ts")
    halo = halo.withColumn("x", F.min(F.struct(*ident)).over(together)).select("block", "ts", "symbol", "x.*")
    return rows.withColumn("own", F.lit(True)).unionByName(halo.distinct().withColumn("own", F.lit(False)))


def _nearest(block: pa.Table, tolerance_us: int) -> Iterator[tuple[pa.Table, np.ndarray, int, pa.Array, np.ndarray, np.ndarray]]:
    """(own trades, their symbols' numbers, j, symbols, places i, places j) for each symbol j: its trade (a row of
    ``block`` sorted) that is nearest to each own trade of a smaller symbol (a row of the own ones)."""
    symbols = block.column("symbol").combine_chunks().dictionary_encode()
    order = pc.sort_indices(symbols.dictionary).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    code = number[symbols.indices.to_numpy()]
    ts, own = block.column("ts").to_numpy(), block.column("own").to_numpy()
    mine = np.flatnonzero(own)
    my_ts, my_code = ts[mine], code[mine]
    by_symbol = np.argsort(code, kind="stable")
    cuts = np.searchsorted(code[by_symbol], np.arange(len(order) + 1))
    names = symbols.dictionary.take(pa.array(order))
    for j in range(1, len(order)):
        # Rows come by time and id, so the first one of a time is the one of the smallest id.
        held = by_symbol[cuts[j] : cuts[j + 1]]
        held = held[np.r_[True, ts[held][1:] != ts[held][:-1]]]
        t = ts[held]
        # Own trades within the tolerance of one of j's at least: stretches of the time, joined where they overlap.
        start, stop = np.searchsorted(my_ts, t - tolerance_us, "left"), np.searchsorted(my_ts, t + tolerance_us, "right")
        start = np.maximum(start, np.r_[0, stop[:-1]])
        long = stop - start
        i = np.repeat(start - np.r_[0, np.cumsum(long)[:-1]], long) + np.arange(long.sum())
        i = i[my_code[i] < j]
        after = np.searchsorted(t, my_ts[i], "left")
        before, after = np.maximum(after - 1, 0), np.minimum(after, len(t) - 1)
        earlier = np.abs(my_ts[i] - t[before]) <= np.abs(t[after] - my_ts[i])
        yield mine, my_code, j, names, i, held[np.where(earlier, before, after)]


def _sorted(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    block = pa.Table.from_batches(batches)
    keys = [(c, "ascending") for c in ("ts", "file_id", "file_seq", "qty")]
    return block.take(pc.sort_indices(block, sort_keys=keys, null_placement="at_start"))


def matched_trades(trades: DataFrame, tolerance_us: int = TOLERANCE_US) -> DataFrame:
    """(sym_i, sym_j, ts_i, id_i, qty_i, qty_j): each trade of the smaller symbol with the other's nearest trade.

    Of trades as near as each other the earlier one counts, and of those the one of the smallest id.  Trades are dealt
    in blocks of time, and a block finds its matches by binary search, so no pair is formed that is no match.
    """
    ids = [StructField(c, trades.schema[c].dataType) for c in ("file_id", "file_seq")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _sorted(batches)
        for mine, my_code, j, names, i, k in _nearest(block, tolerance_us):
            left = block.take(pa.array(mine[i]))
            columns = {
                "sym_i": names.take(pa.array(my_code[i])), "sym_j": names.take(pa.array(np.full(len(i), j))), "ts_i": left["ts"],
                "file_id": left["file_id"], "file_seq": left["file_seq"], "qty_i": left["qty"], "qty_j": block["qty"].take(pa.array(k)),
            }
            yield from pa.table(columns).to_batches()

    texts = [StructField(c, trades.schema["symbol"].dataType) for c in ("sym_i", "sym_j")]
    schema = StructType([*texts, StructField("ts_i", LongType()), *ids, StructField("qty_i", LongType()), StructField("qty_j", LongType())])
    found = _blocks(trades, tolerance_us).groupBy("block").applyInArrow(run, schema)
    return found.select("sym_i", "sym_j", "ts_i", F.struct("file_id", "file_seq").alias("id_i"), "qty_i", "qty_j")


def _shared(trades: DataFrame, tolerance_us: int) -> DataFrame:
    """(sym_i, sym_j, matches, shared): the matches' smaller quantities summed, in halves of 32 bits inside a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _sorted(batches)
        qty = block.column("qty")
        most = np.iinfo(np.int64).max
        known, q = pc.is_valid(qty).to_numpy(), qty.fill_null(most).to_numpy()  # the smaller of two is the known one
        for mine, my_code, j, names, i, k in _nearest(block, tolerance_us):
            least, stated = np.minimum(q[mine[i]], q[k]), known[mine[i]] | known[k]
            least = np.where(stated, least, 0)
            met, group = np.unique(my_code[i], return_inverse=True)
            sums = np.zeros((4, len(met)), np.int64)
            for total, value in zip(sums, (np.ones(len(i), np.int64), stated.astype(np.int64), least >> 32, least & 0xFFFFFFFF), strict=True):
                np.add.at(total, group, value)
            columns = [names.take(pa.array(met)), names.take(pa.array(np.full(len(met), j))), *map(pa.array, sums)]
            yield pa.RecordBatch.from_arrays(columns, names=["sym_i", "sym_j", "n", "stated", "high", "low"])

    kind = trades.schema["symbol"].dataType.simpleString()
    schema = f"sym_i {kind}, sym_j {kind}, n long, stated long, high long, low long"
    found = _blocks(trades, tolerance_us).groupBy("block").applyInArrow(run, schema)
    both = F.sum(wide(F.col("high"))) * F.lit(1 << 32).cast("decimal(10,0)") + F.sum(wide(F.col("low")))
    return found.groupBy("sym_i", "sym_j").agg(F.sum("n").alias("matches"), F.when(F.sum("stated") > 0, both).alias("shared"))


def similarity(trades: DataFrame, tolerance_us: int = TOLERANCE_US, by_volume: bool = True) -> DataFrame:
    """(sym_i, sym_j, matches, similarity), i < j: shared volume (or matches) over the root of both totals.

    The result, a row for a pair, is kept: whatever reads it again does not read the trades again.
    """
    pairs = _shared(trades, tolerance_us)
    totals = trades.groupBy("symbol").agg(F.sum(wide(F.col("qty"))).alias("v"), F.count("*").alias("n"))
    size = decoded(F.col("v")) if by_volume else F.col("n").cast("double")
    i = totals.select(F.col("symbol").alias("sym_i"), size.alias("size_i"))
    j = totals.select(F.col("symbol").alias("sym_j"), size.alias("size_j"))
    shared = decoded(F.col("shared")) if by_volume else F.col("matches").cast("double")
    similar = pairs.join(i, "sym_i").join(j, "sym_j")
    return kept(similar.select("sym_i", "sym_j", "matches", divide(shared, F.sqrt(F.col("size_i") * F.col("size_j"))).alias("similarity")))


def edges(similar: DataFrame, n_symbols: int, top_k: int = 5) -> DataFrame:
    """Undirected edges: pairs above mean + deviation of all pairs that are among a node's k strongest.

    Pairs that never traded together count as 0 in the mean and the (population) deviation.
    """
    pairs = n_symbols * (n_symbols - 1) // 2
    sums = similar.agg(F.sum("similarity").alias("s"), F.sum(F.col("similarity") * F.col("similarity")).alias("q"))
    mean = F.col("s") / F.lit(max(1, pairs))
    limit = sums.select((mean + F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.lit(max(1, pairs)) - mean * mean))).alias("__limit"))
    ends = similar.select("sym_i", "sym_j", "similarity")
    both = ends.unionByName(ends.select(F.col("sym_j").alias("sym_i"), F.col("sym_i").alias("sym_j"), "similarity"))
    strongest = Window.partitionBy("sym_i").orderBy(F.desc("similarity"), "sym_j")
    top = both.crossJoin(F.broadcast(limit)).where("similarity > __limit")  # one row
    top = top.withColumn("r", F.row_number().over(strongest)).where(F.col("r") <= top_k)
    return top.select(F.least("sym_i", "sym_j").alias("node_a"), F.greatest("sym_i", "sym_j").alias("node_b"), "similarity").distinct()


def centrality(graph: DataFrame) -> DataFrame:
    """(node, degree, weighted_degree)."""
    ends = graph.select(F.col("node_a").alias("node"), "similarity").unionByName(graph.select(F.col("node_b").alias("node"), "similarity"))
    return ends.groupBy("node").agg(F.count("*").alias("degree"), F.sum("similarity").alias("weighted_degree"))


def clusters(similar: DataFrame, k: int, iterations: int = 20) -> DataFrame:
    """(symbol, cluster) by power iteration clustering over the similarities."""
    from pyspark.ml.clustering import PowerIterationClustering

    names = similar.select(F.explode(F.array("sym_i", "sym_j")).alias("symbol")).distinct()
    ids = names.withColumn("id", F.xxhash64("symbol"))
    links = (
        similar.where("similarity > 0")
        .join(ids.select(F.col("symbol").alias("sym_i"), F.col("id").alias("src")), "sym_i")
        .join(ids.select(F.col("symbol").alias("sym_j"), F.col("id").alias("dst")), "sym_j")
        .select("src", "dst", F.col("similarity").alias("weight"))
    )
    found = PowerIterationClustering(k=k, maxIter=iterations, initMode="degree", weightCol="weight").assignClusters(links)
    return found.join(ids, "id").select("symbol", "cluster")
