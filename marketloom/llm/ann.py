"""Approximate nearest neighbours by several shifted Hilbert curves.

Vectors are lengthened by one component so that the largest inner product is the smallest distance, projected
with fixed random rotations, shifted, quantised and put in Hilbert order; once per curve.  Vectors of about the same
length are a band with curves of its own, so that one very long vector does not squeeze all others into one place.
Each curve is cut into windows at keys of a bounded sample.  A query looks at its own window and the neighbouring
ones of every curve; the inner products with all rows there are exact, and the nearest of all windows are merged.

Windows in a row are dealt to a task together while they are small; a crowded window is dealt to several tasks by its
ids.  A query is one row for each task that holds some of its windows, and the task walks them in fixed blocks.

How many windows a query needs depends on the data, so ``calibrate`` measures it: on the sample it takes the
smallest share of each curve that reaches the recall asked for.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

CURVES = 4
#: Components that vectors are projected to, and bits of each; together they make the key.
DIMS = 8
DEPTH = 6
#: Rows of one window, about, where the sample has at least so many rows for each window.
WINDOW_ROWS, WINDOW_SAMPLE = 2048, 4
#: Tasks of one curve at least, and rows that one task holds, about.
SPANS, SPAN_ROWS = 8, 1 << 17
#: Bands of lengths: those beyond the sample, and each half as long as the one before.
BANDS = 8
#: Rows and queries of the calibration sample at most.
SAMPLE_ROWS = 12_000
SAMPLE_QUERIES = 200
#: Recall that the calibration asks for on its sample.
RECALL = 0.95
SHARES = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.75, 1.0)
#: Rows and queries that meet in one matrix product, and candidates kept beside those asked for.
ROW_BLOCK, QUERY_BLOCK, SPARE = 4096, 512, 6
_SHORTEST, _LONGEST = 1e-150, 1e150


def hilbert_keys(cells: np.ndarray, depth: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (n, dims), components in 0 .. 2^depth - 1.

    The walk goes from the coarsest bit to the finest.  At every level the orthant's Gray code gives the next
    digits of the key, and the finer bits are reflected and exchanged so that neighbouring orthants meet.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(depth - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(dims):
            set_ = (x[i] >> bit & 1).astype(bool)
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    parity = np.zeros_like(x[0])
    for bit in range(depth - 1, 0, -1):
        parity ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= parity
    key = np.zeros_like(x[0])
    for bit in range(depth - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.sqrt((vectors**2).sum(axis=1)), _SHORTEST, _LONGEST)


@dataclass
class Curves:
    """``count`` curves over vectors of ``size`` components."""

    size: int
    count: int = CURVES
    dims: int = DIMS
    depth: int = DEPTH
    seed: int = 11

    def __post_init__(self):
        self.dims = min(self.dims, self.size + 1)
        rng = np.random.default_rng(self.seed)
        self.turns = [np.linalg.qr(rng.normal(size=(self.size + 1, self.size + 1)))[0][:, : self.dims] for _ in range(self.count)]
        self.shifts = rng.uniform(0, 1, (self.count, self.dims))

    def keys(self, vectors: np.ndarray, scales: np.ndarray | None = None) -> np.ndarray:
        """(count, n) keys.  A row's added component fills it up to its band's scale; a query has none and length 1."""
        own = lengths_of(vectors)
        rest = np.zeros(len(vectors)) if scales is None else np.sqrt(np.maximum(0.0, scales**2 - own**2))
        full = np.c_[vectors, rest] / (own if scales is None else scales)[:, None]
        out = np.empty((self.count, len(vectors)), np.int64)
        width = 3.0 / np.sqrt(self.size + 1)  # of a random unit vector's components, few are beyond
        for c, turn in enumerate(self.turns):
            place = ((full @ turn) / width + 1) / 2 + (self.shifts[c] - 0.5) / (1 << (self.depth - 1))
            cells = np.clip(np.floor(place * (1 << self.depth)), 0, (1 << self.depth) - 1)
            out[c] = hilbert_keys(cells, self.depth)
        return out


@dataclass
class Bands:
    """Bands of vector lengths: 0 is beyond ``top``, band b is up to top / 2^(b - 1); the last one takes the rest."""

    top: float
    longest: float

    def of(self, lengths: np.ndarray) -> np.ndarray:
        halves = np.clip(np.floor(np.log2(self.top / lengths)), 0, BANDS - 2).astype(np.int64)
        return np.where(lengths > self.top, 0, 1 + halves)

    def scales(self, band: np.ndarray) -> np.ndarray:
        return np.where(band == 0, self.longest, self.top / np.exp2(np.maximum(band, 1) - 1.0))


def calibrate(
    curves: Curves, bands: Bands, rows: np.ndarray, queries: np.ndarray, k: int, recall: float = RECALL
) -> list[float]:
    """Share of each curve, on either side together, that a query needs in each band.

    All of a band that the sample does not tell of; the least share of one that holds next to no neighbours.
    """
    shares = [1.0] * BANDS
    if len(rows) <= 2 * k or not len(queries):
        return shares
    band = bands.of(lengths_of(rows))
    row_keys, query_keys = curves.keys(rows, bands.scales(band)), curves.keys(queries)
    products = queries @ rows.T
    nearest = np.argpartition(-products, k, axis=1)[:, :k]
    for b in range(BANDS):
        own = np.flatnonzero(band == b)
        if len(own) <= 2 * k:
            continue
        query, at = np.nonzero(band[nearest] == b)
        if len(query) < 0.005 * nearest.size:
            shares[b] = SHARES[0]
            continue
        far = np.full(len(query), np.inf)
        for c in range(curves.count):
            order = own[np.argsort(row_keys[c][own], kind="stable")]
            rank = np.empty(len(rows), np.int64)
            rank[order] = np.arange(len(order))
            place = np.searchsorted(row_keys[c][order], query_keys[c])
            far = np.minimum(far, np.abs(rank[nearest[query, at]] - place[query]) / len(order))
        shares[b] = next((s for s in SHARES if (far <= s / 2).mean() >= recall), 1.0)
    return shares


@dataclass
class Windows:
    """Windows of all bands and curves, numbered in order; and, once rows are counted, the tasks that hold them.

    Line b * curves + c is the curve c of band b.
    """

    cuts: list[np.ndarray]
    sides: list[int]

    def __post_init__(self):
        self.sizes = np.array([len(c) + 1 for c in self.cuts])
        self.base = np.r_[0, np.cumsum(self.sizes)]

    def of(self, line: int, keys: np.ndarray) -> np.ndarray:
        return self.base[line] + np.searchsorted(self.cuts[line], keys, side="right")

    def around(self, line: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last window of queries; near the ends of a curve as many as elsewhere."""
        side, n = self.sides[line], self.sizes[line]
        low = np.clip(np.searchsorted(self.cuts[line], keys, side="right") - side, 0, max(0, n - 2 * side - 1))
        return self.base[line] + low, self.base[line] + np.minimum(low + 2 * side, n - 1)

    def deal(self, counts: dict[int, int], span_rows: int) -> None:
        """``task`` is each window's first task, ``parts`` the number of tasks that it is dealt to by id, ``rows`` each line's."""
        self.rows = np.zeros(len(self.cuts), np.int64)
        self.task, self.parts, task = np.zeros(self.base[-1], np.int64), np.ones(self.base[-1], np.int64), -1
        for line in range(len(self.cuts)):
            held = np.inf
            for w in range(self.base[line], self.base[line + 1]):
                n = counts.get(w, 0)
                self.rows[line] += n
                if held + n > span_rows:
                    task, held = task + int(self.parts[w - 1] if w else 1), 0
                    self.parts[w] = max(1, -(-n // span_rows))
                held += n
                self.task[w] = task
                if w > self.base[line] and self.task[w] == self.task[w - 1]:
                    self.parts[w] = self.parts[w - 1]


def _spread(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(33)).astype(np.int64)


def _matrix(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.float64).reshape(-1, size)


class _Held:
    """Rows of one task in order of their windows, and the best of them for blocks of queries."""

    def __init__(self, windows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.windows, self.ids, self.vectors = windows, ids, vectors

    def best(self, low: np.ndarray, high: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, product) of the k best rows of each query's windows, ties to smaller ids.

        A product is summed anew over one pair's components, so it does not depend on the block it was found in.
        """
        keep = k + SPARE
        score, row = np.full((len(queries), keep), -np.inf), np.zeros((len(queries), keep), np.int64)
        for at in range(0, len(self.ids), ROW_BLOCK):
            part = slice(at, at + ROW_BLOCK)
            asked = np.flatnonzero((low <= self.windows[part][-1]) & (high >= self.windows[part][0]))
            if not len(asked):
                continue
            products = queries[asked] @ self.vectors[part].T
            columns = self._ahead(products, keep)
            new = np.take_along_axis(products, columns, axis=1)
            both = np.c_[score[asked], new]
            rows = np.c_[row[asked], columns + at]
            order = np.lexsort((self.ids[rows], -both), axis=1)[:, :keep]
            score[asked], row[asked] = np.take_along_axis(both, order, axis=1), np.take_along_axis(rows, order, axis=1)
        query, place = np.nonzero(score > -np.inf)
        row = row[query, place]
        exact = np.empty(len(row))
        for at in range(0, len(row), 1 << 14):
            part = slice(at, at + (1 << 14))
            exact[part] = (queries[query[part]] * self.vectors[row[part]]).sum(axis=1)
        order = np.lexsort((self.ids[row], -exact, query))
        query, row, exact = query[order], row[order], exact[order]
        first = np.arange(len(query)) - np.searchsorted(query, query) < k
        return query[first], row[first], exact[first]

    @staticmethod
    def _ahead(products: np.ndarray, keep: int) -> np.ndarray:
        """Columns of at least the ``keep`` best of each line; all that tie with the last of them are among them."""
        if products.shape[1] <= keep:
            return np.broadcast_to(np.arange(products.shape[1]), products.shape)
        edge = -np.partition(-products, keep - 1, axis=1)[:, keep - 1]
        width = int((products >= edge[:, None]).sum(axis=1).max())
        if width >= products.shape[1]:
            return np.broadcast_to(np.arange(products.shape[1]), products.shape)
        return np.argpartition(-products, width - 1, axis=1)[:, :width]


def search(
    rows: DataFrame,
    is_query,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    curves: int = CURVES,
    window_rows: int = WINDOW_ROWS,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which ``is_query`` holds.

    Rows whose id or vector is null, whose vector is zero, holds nulls or non-finite components, or is not
    of the most frequent length take no part.  A query's own id is not a candidate.  Of rows with equal
    vectors only the k + 2 smallest ids can be among anyone's k nearest, so a group of copies is that many
    candidates, and queries with equal vectors are one search.  An empty table returns no rows.
    """
    spark = rows.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    sound = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.exists("v", lambda x: x != 0)
    )
    lengths = sound.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    size, total = lengths[0]["d"], lengths[0]["n"]
    sound = sound.where(F.size("v") == size)
    longest = sound.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()["m"] ** 0.5
    shape = Curves(size, curves)

    # Only hashes that can be among the first are sorted: about four times the sample, however many rows there are.
    place = F.xxhash64("id", F.lit(3))
    near = sound.where(place <= int(min(2.0**63 - 1024, -(2.0**63) + 2.0**64 * 4 * SAMPLE_ROWS / total)))
    sample = near.orderBy(place, "id").limit(SAMPLE_ROWS).select("v").toPandas()["v"]
    known = np.array([list(map(float, v)) for v in sample])
    bands = Bands(float(lengths_of(known).max()), min(longest, _LONGEST))
    asked = known[:: max(1, len(known) // SAMPLE_QUERIES)][:SAMPLE_QUERIES]
    shares = calibrate(shape, bands, known, asked, k + 1, recall)
    known_bands = bands.of(lengths_of(known))
    known_keys = shape.keys(known, bands.scales(known_bands))
    cuts, sides = [], []
    for b in range(BANDS):
        own = np.flatnonzero(known_bands == b)
        # Windows follow the rows that the sample stands for, but a window needs some of the sample.
        n = max(1, min(round(total * len(own) / len(known) / window_rows), len(own) // WINDOW_SAMPLE))
        for c in range(curves):
            keys = np.sort(known_keys[c][own])
            cuts.append(keys[[len(own) * i // n for i in range(1, n)]])
            sides.append(int(np.ceil(shares[b] * n / 2)))
    windows = Windows(cuts, sides)

    def key_rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size) + 0.0  # -0 is 0
            raw = [r.tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                    pa.array(raw, pa.binary()),
                ],
                names=["id", "q", "same", "v"],
            )

    keyed = checkpointed(sound.select("id", "v", "q").mapInArrow(key_rows, "id long, q boolean, same binary, v binary"))
    by_vector = Window.partitionBy("same").orderBy("id")
    once = keyed.select("id", "same", "v").dropDuplicates(["same", "id"])  # repeated rows are one candidate
    distinct_ids = once.withColumn("i", F.row_number().over(by_vector)).where(F.col("i") <= k + 2).drop("i")
    asking = keyed.where("q").groupBy("same").agg(F.min("id").alias("id"), F.first("v").alias("v"))

    def windows_of(x: np.ndarray) -> np.ndarray:
        """(curves, n) windows of rows."""
        band = bands.of(lengths_of(x))
        keys = shape.keys(x, bands.scales(band))
        out = np.empty(keys.shape, np.int64)
        for b in np.unique(band):
            own = band == b
            for c in range(curves):
                out[c, own] = windows.of(b * curves + c, keys[c, own])
        return out

    def count(batches):
        for batch in batches:
            if batch.num_rows:
                w, n = np.unique(windows_of(_matrix(batch.column(0), size)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(n)], names=["w", "n"])

    # A row per window: bounded by the sample.
    counted = distinct_ids.select("v").mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    windows.deal({r["w"]: r["n"] for r in counted.collect()}, min(SPAN_ROWS, max(window_rows, total // SPANS)))
    names = ["task", "q", "w", "last", "id", "v"]

    def deal_rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            w = windows_of(_matrix(batch.column(1), size)).ravel()
            pick = np.tile(np.arange(batch.num_rows), curves)
            ids = batch.column(0).to_numpy(zero_copy_only=False)[pick]
            task = windows.task[w] + _spread(ids) % windows.parts[w]
            columns = [pa.array(task), pa.array(np.zeros(len(w), bool)), pa.array(w), pa.array(w), pa.array(ids)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1).take(pa.array(pick))], names=names)

    def deal_queries(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keys = shape.keys(_matrix(batch.column(1), size))
            for line in np.flatnonzero(windows.rows).tolist():
                low, high = windows.around(line, keys[line % curves])
                first = windows.task[low]
                tasks = windows.task[high] + windows.parts[high] - first
                step = max(1, (1 << 16) // int(tasks.max()))
                for at in range(0, len(ids), step):
                    n = tasks[at : at + step]
                    pick = at + np.repeat(np.arange(len(n)), n)
                    task = first[pick] + np.arange(len(pick)) - np.repeat(np.cumsum(n) - n, n)
                    columns = [pa.array(task), pa.array(np.ones(len(pick), bool)), pa.array(low[pick]), pa.array(high[pick]), pa.array(ids[pick])]
                    yield pa.RecordBatch.from_arrays([*columns, batch.column(1).take(pa.array(pick))], names=names)

    def compare(batches):
        """Tasks follow each other; each one's rows are sorted by window, ahead of its queries."""
        task, parts, held = None, [], None
        for batch in batches:
            t, q = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cut = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (q[1:] != q[:-1])])
            for a, b in zip(cut, [*cut[1:], len(t)], strict=True):
                if t[a] != task:
                    task, parts, held = t[a], [], None
                own = batch.slice(a, b - a)
                if not q[a]:
                    w, ids = (own.column(i).to_numpy(zero_copy_only=False) for i in (2, 4))
                    parts.append((w, ids, _matrix(own.column(5), size)))
                    continue
                if held is None:
                    if not parts:
                        continue
                    held, parts = _Held(*map(np.concatenate, zip(*parts, strict=True))), []
                for at in range(0, b - a, QUERY_BLOCK):
                    block = own.slice(at, QUERY_BLOCK)
                    low, high, ids = (block.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
                    query, row, product = held.best(low, high, _matrix(block.column(5), size), k + 2)
                    columns = [pa.array(ids[query]), pa.array(held.ids[row]), pa.array(product)]
                    yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    dealt_schema = "task long, q boolean, w long, last long, id long, v binary"
    candidates = distinct_ids.select("id", "v").mapInArrow(deal_rows, dealt_schema)
    queries = asking.select("id", "v").mapInArrow(deal_queries, dealt_schema)
    found = (
        candidates.unionByName(queries)
        .repartition("task")
        .sortWithinPartitions("task", "q", "w")
        .mapInArrow(compare, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 2)
    members = keyed.where("q").select("id", "same").distinct()
    leaders = asking.select(F.col("id").alias("leader"), "same")
    answers = (
        members.join(leaders, "same")
        .join(best, F.col("leader") == F.col("query_id"))
        .where("id <> vec_id")
        .select(F.col("id").alias("query_id"), "vec_id", "score")
    )
    return (
        answers.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
