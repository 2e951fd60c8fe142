"""SimHash near-duplicates: fingerprints, then bit-sliced comparison inside pigeonhole blocks.

1. ``fingerprints``: 64-bit SimHash of word shingles, whole texts.
2. ``links``: a fingerprint is cut into ``radius + 2`` parts.  Two fingerprints at ``radius`` or fewer
   differing bits agree on at least two parts, so every pair of parts is a bucket key and no link is
   missed.  Buckets above ``chunk`` members are cut into chunks and every pair of chunks is a task of
   its own.  Inside a task the fingerprints are stored as vertical bit planes; carry-save counters add
   up the differing bits of many pairs at once, and blocks whose pairs all exceed the radius are left.
   A task returns a spanning forest of its links, never all pairs.
3. ``near_duplicates``: components of the links.
4. ``without_near_copies``: one row of each group of texts whose shingle sets are similar.  Such texts differ in
   up to a quarter of the fingerprint's bits, where ranges of bits name nearly all pairs; so there the buckets are
   min-hash bands, the same bit-sliced comparison leaves the pairs of a bucket within a wide radius, and the exact
   similarity of their shingle sets decides.  What is compared never leaves its bucket.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, distinct, utf8
from .components import connected_components
from .groups import first_groups, labelled, once, part_name, second_groups

BITS = 64
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Shingles hashed at a time, so that a very long text needs no more memory than this many.
STEP = 1 << 16


def simhash(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text: a bit is set if it is set in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # both touch ASCII only
    if not words:
        return 0
    total, counts = max(1, len(words) - shingle + 1), np.zeros(BITS, np.int64)
    for at in range(0, total, STEP):
        part = words[at : min(at + STEP, total) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
        hashes = np.fromiter((xxh64_intdigest(g, seed) for g in grams), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row per input row; fp is the fingerprint as a signed long, 0 for null or no words."""

    def run(batches):
        for batch in batches:
            marks = [simhash(t.as_py() or b"", shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(marks, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t")).mapInArrow(
        run, "doc_id long, fp long"
    )


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, ceil(n/64)) words: plane b holds bit b of every value, 64 values to a word."""
    words = -(-len(values) // BITS)
    padded = np.zeros(words * BITS, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(queries: np.ndarray, planes: np.ndarray, n: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query rows, hit words): for each query that has hits, the bit set of values within ``radius``.

    Counters are bit-sliced: ``low[i]`` is bit i of the counts of all pairs, ``over`` marks pairs whose
    count has left the counters' range.  Queries are dropped as soon as all their pairs are over.
    """
    width, rows = radius.bit_length(), np.arange(len(queries))
    over = np.zeros((len(queries), planes.shape[1]), np.uint64)
    if n % BITS:  # padding is never near
        over[:, -1] = ALL << np.uint64(n % BITS)
    low = [np.zeros_like(over) for _ in range(width)]
    for b in range(BITS):
        flip = np.where((queries[rows] >> np.uint64(b)) & np.uint64(1), ALL, np.uint64(0))
        carry = planes[b][None, :] ^ flip[:, None]
        for i in range(width):
            low[i], carry = low[i] ^ carry, low[i] & carry
        over |= carry
        if b >= 8 and b % 4 == 0:
            alive = (over != ALL).any(axis=1)
            if not alive.all():
                rows, over, low = rows[alive], over[alive], [x[alive] for x in low]
                if not len(rows):
                    break
    more, equal = np.zeros_like(over), np.full_like(over, ALL)
    for i in reversed(range(width)):  # counts above the radius that fit the counters
        if radius >> i & 1:
            equal &= low[i]
        else:
            more |= equal & low[i]
            equal &= ~low[i]
    hits = ~(over | more)
    some = hits.any(axis=1)
    return rows[some], hits[some]


def pairs_within(values: np.ndarray, radius: int, bucket: np.ndarray | None = None, side: int = 4096):
    """(row, rows near it) for every row that has others within ``radius``, of its own bucket if buckets are given."""
    n = len(values)
    for left in range(0, n, side):
        planes, size = bit_planes(values[left : left + side]), min(side, n - left)
        for top in range(0, n, 512):
            rows, hits = within(values[top : top + 512], planes, size, radius)
            if not len(rows):
                continue
            near = np.unpackbits(np.ascontiguousarray(hits).astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :size]
            if bucket is not None:
                near &= bucket[rows + top][:, None] == bucket[left : left + size][None, :]
            count = near.sum(axis=1, dtype=np.int64)
            for k, row in enumerate(rows + top):
                if count[k] > (left <= row < left + size):  # more than itself
                    yield row, left + np.flatnonzero(near[k])


def forest(values: np.ndarray, radius: int, bucket: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, smallest member) of the components that links within ``radius`` form."""
    if bucket is None:
        values = np.unique(values)
    n = len(values)
    label = np.arange(n)
    for row, near in pairs_within(values, radius, bucket):
        seen = np.unique(np.append(label[near], label[row]))
        if len(seen) > 1:
            label[np.isin(label, seen)] = seen[0]
    signed = values.view(np.int64)
    lowest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(lowest, label, signed)
    far = signed != lowest[label]
    return signed[far], lowest[label][far]


def _compare(radius: int, block: int, apart: bool):
    def run(batches):
        keys, held = [], []

        def edges(key, values):
            u, v = forest(values.view(np.uint64), radius, key if apart else None)
            return pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

        for batch in batches:
            keys.append(batch.column(0).to_numpy(zero_copy_only=False))
            held.append(batch.column(1).to_numpy(zero_copy_only=False))
            if sum(map(len, held)) < block:
                continue
            key, fp = np.concatenate(keys), np.concatenate(held)
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            at = 0
            while starts[-1] - at >= block:  # whole buckets only; the last one may go on in the next batch
                to = starts[np.searchsorted(starts, at + block)]
                yield edges(key[at:to], fp[at:to])
                at = to
            keys, held = [key[at:]], [fp[at:]]
        if held and sum(map(len, held)):
            yield edges(np.concatenate(keys), np.concatenate(held))

    return run


def links(marks: DataFrame, radius: int = 3, chunk: int = 2048, block: int = 1024) -> DataFrame:
    """Edges (u, v) that connect just those distinct fingerprints of ``marks.fp`` that links connect."""
    parts = radius + 2
    cuts = [round(i * BITS / parts) for i in range(parts + 1)]

    def part(i: int):
        return F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1))

    keys = [
        F.xxhash64(F.lit(t), part(i), part(j)).alias(f"k{t}") for t, (i, j) in enumerate(combinations(range(parts), 2))
    ]
    # More members in a task than its two chunks cost time, never a link: any pair compared is a true link.
    return bucket_links(marks.select("fp", F.explode(F.array(*keys)).alias("k")), radius, chunk, block)


def in_chunks(members: DataFrame, group: str, chunks, own) -> DataFrame:
    """A row of ``members`` for each pair of its group's chunks that has its own; ``group`` becomes the pair's key.

    ``chunks`` is the number of chunks of the row's group and ``own`` a column that is spread evenly.
    """
    rest = [c for c in members.columns if c != group]
    dealt = members.withColumns({"__c": chunks.cast("int"), "__own": F.pmod(own, chunks).cast("int")})
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("__c") - 1)).alias("__other"))
    return dealt.select(F.xxhash64(group, F.least("__own", "__other"), F.greatest("__own", "__other")).alias(group), *rest)


def bucket_links(keyed: DataFrame, radius: int, chunk: int = 2048, block: int = 1024, apart: bool = False) -> DataFrame:
    """Edges (u, v) that connect the fingerprints of ``keyed`` (k, fp) that are linked inside a bucket k.

    With ``apart`` only fingerprints of one bucket are linked; without it a task may link any two that it meets.
    """
    crowded = keyed.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(crowded, "k")
    members = in_chunks(met, "k", F.ceil(F.col("n") / F.lit(chunk)), F.xxhash64("fp", F.lit(7))).select("k", "fp")
    return (
        members.repartition("k").sortWithinPartitions("k").mapInArrow(_compare(radius, block, apart), "u long, v long").distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Rows link when their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest
    doc_id that links reach, the row's own included.  Null, empty and word-less texts share fingerprint 0
    and link like any other.  Repeated rows each return a row.  A null doc_id is kept and never becomes a
    component's id; a component with null ids alone has a null component_id.  Extra columns are ignored.
    """
    marks = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    distinct = checkpointed(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = connected_components(links(distinct, radius))
    grouped = distinct.join(labels, distinct.fp == labels.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    lowest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = grouped.join(lowest, "component").select("fp", "component_id")
    return marks.join(classes, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(column: str = "fp"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


#: Words of a shingle and the least similarity of near-copies; bits that their fingerprints may differ in (texts at
#: 0.8 differ in 10, with a deviation of 3), and bands of min-hashes (at 0.8 a band is shared in 0.41 of cases).
NEAR_WORDS, NEAR_SIMILARITY, NEAR_BITS, BANDS, BAND_ROWS = 5, 0.8, 20, 12, 4
#: Rows and shingles of a chunk of a group, about: a task compares two chunks.
CHUNK_ROWS, CHUNK_SHINGLES = 2048, 4_000_000
#: Rows of a side that is broadcast, at most; larger ones are shuffled.
BROADCAST_ROWS = 300_000
_TURN = np.random.default_rng(5).integers(0, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX, _MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Shingles:
    """Sets of shingle hashes of texts, as sorted arrays; words are hashed once while they are in the table."""

    KEPT = 400_000

    def __init__(self, words: int = NEAR_WORDS):
        self.words, self.known = words, {}

    def __call__(self, data: bytes) -> np.ndarray:
        """Fewer words than a shingle are one shingle; no words are the empty set."""
        from xxhash import xxh64_intdigest

        words = data.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > self.KEPT:
            self.known = {}
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(words))
        out = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            out = (out ^ h[i : i + len(out)]) * _MIX
            out ^= out >> np.uint64(29)
        return distinct(out)


def set_fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a set of hashes; 0 for none."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), STEP):
        part = hashes[at : at + STEP]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def bands(hashes: np.ndarray) -> np.ndarray:
    """Keys of the set's bands, each of ``BAND_ROWS`` smallest hashes; one fixed key each for the empty set."""
    least = np.full(len(_TURN), ALL)
    for at in range(0, len(hashes), STEP // 16):
        turned = hashes[None, at : at + STEP // 16] * _TURN[:, None]
        least = np.minimum(least, (turned ^ (turned >> np.uint64(32))).min(axis=1))
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, BAND_ROWS).T:
        keys = (keys ^ row) * _MIX_2
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of sorted sets; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return both / (len(a) + len(b) - both)


def _sketched(shingle: int):
    """(tk, ok, doc_id) as they are, with fingerprint, bands and size of the text's shingle set."""

    def run(batches):
        shingles = Shingles(shingle)
        for batch in batches:
            sets = [shingles(t.as_py() or b"") for t in batch.column(3)]
            marks = np.array([set_fingerprint(s) for s in sets], np.uint64).view(np.int64)
            keys = np.concatenate([np.empty(0, np.int64), *map(bands, sets)])
            columns = [*batch.columns[:3], pa.array(marks), pa.FixedSizeListArray.from_arrays(pa.array(keys), BANDS).cast(pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([len(s) for s in sets], pa.int64())], names=["tk", "ok", "doc_id", "fp", "bands", "n"])

    return run


def _parts(radius: int, block: int = 1024):
    """(k, node, rep): the nodes of each bucket that pairs within ``radius`` connect, under the part's name and with its
    smallest node; rows (k, node, fp) come sorted by bucket, buckets of few rows are compared together."""

    def parts(keys, nodes, marks):
        label = np.arange(len(keys))
        for row, near in pairs_within(marks.view(np.uint64), radius, keys):
            seen = np.unique(np.append(label[near], label[row]))
            if len(seen) > 1:
                label[np.isin(label, seen)] = seen[0]
        order = np.argsort(label, kind="stable")
        found = [np.unique(nodes[p]) for p in np.split(order, np.flatnonzero(np.diff(label[order])) + 1) if len(p) > 1]
        sizes = [len(p) for p in found]
        columns = [np.repeat(np.array([f(p) for p in found], np.int64), sizes) for f in (part_name, np.min)]
        columns.insert(1, np.concatenate([np.empty(0, np.int64), *found]))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["k", "node", "rep"])

    def run(batches):
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
            key = held[0]
            if len(key) < block:
                continue
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            at = 0
            while starts[-1] - at >= block:  # whole buckets only; the last one may go on in the next batch
                to = starts[np.searchsorted(starts, at + block)]
                yield parts(*(h[at:to] for h in held))
                at = to
            held = [h[at:] for h in held]
        if len(held[0]):
            yield parts(*held)

    return run


def _verified(shingle: int, radius: int, least: float):
    """Edges of a spanning forest of the similar pairs of different labels of each group; rows (g, node, label, fp, t)
    come sorted by group."""

    def run(batches):
        shingles = Shingles(shingle)
        group, nodes, labels, marks, sets = None, {}, [], [], []

        def edges():
            label = np.unique(labels, return_inverse=True)[1]
            names = list(nodes)
            u, v = [], []
            for row, near in pairs_within(np.array(marks, np.int64).view(np.uint64), radius):
                for other in near[label[near] != label[row]].tolist():
                    if label[other] == label[row]:
                        continue
                    a, b = sorted((len(sets[row]), len(sets[other])))
                    if a >= least * b and similarity(sets[row], sets[other]) >= least:
                        label[label == label[other]] = label[row]
                        u.append(names[row])
                        v.append(names[other])
            return pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

        for batch in batches:
            for g, node, label, fp, text in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column(4), strict=True):
                if g != group:
                    if len(sets) > 1:
                        yield edges()
                    group, nodes, labels, marks, sets = g, {}, [], [], []
                if node not in nodes:
                    nodes[node] = len(nodes)
                    labels.append(label)
                    marks.append(fp)
                    sets.append(shingles(text.as_py() or b""))
        if len(sets) > 1:
            yield edges()

    return run


def without_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = NEAR_WORDS,
    least: float = NEAR_SIMILARITY,
    radius: int = NEAR_BITS,
) -> DataFrame:
    """One row, with all columns of ``docs``, of each group of texts that are equal or near-copies.

    Two texts are near-copies if the sets of their ``shingle``-word shingles have a Jaccard similarity of ``least``
    or more (words split at white space, A-Z in lower case; a text of fewer words is one shingle); groups are what
    such links connect.  Null, empty and word-less texts are one group.  The row with the smallest id stays, null
    ids last; of rows with that id one that is fixed by its content.  Rows are told apart by all of their columns,
    never by their id: different texts under one id are different rows.  Equal rows are one.  Extra columns, whatever
    their names, are kept; an empty table gives none.

    Equal texts are one class before anything is compared.  Inside a band's bucket, in pairs of bounded chunks, the
    fingerprints leave the classes that pairs of at most ``radius`` differing bits connect; such a part of a bucket is
    what meets for the exact similarity, first each class under the smallest one it meets, then what is still apart.
    A link at 0.8 is missed in 0.2 % of cases (no band shared), closer ones hardly ever.
    """
    columns = docs.columns
    others = [c for c in columns if c != text_col]
    text = F.col(f"`{text_col}`").cast("string")
    # A null text has a key of its own, so that a row is found again by it.
    tk = F.unhex(F.md5(F.coalesce(F.concat(F.lit("t"), text), F.lit("")).cast("binary")))
    ok = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in others)))) if others else F.lit(0).cast("long")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), tk.alias("tk"), ok.alias("ok"), text.cast("binary").alias("t"), F.col(f"`{id_col}`").cast("long").alias("doc_id"))
    rows = keyed.select("tk", "ok", "doc_id", "t").mapInArrow(
        _sketched(shingle), "tk binary, ok long, doc_id long, fp long, bands array<long>, n long"
    )
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk", "ok", "copies")
    rows = rows.groupBy("tk", "ok", "doc_id").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("n").alias("n"), F.count("*").alias("copies"))
    # Classes are known by a number from here on, fixed by writing it.
    classes = checkpointed(
        rows.groupBy("tk")
        .agg(F.min(first).alias("first"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("n").alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    buckets = classes.select(F.explode("bands").alias("k"), "node", "fp")
    crowded = buckets.groupBy("k").agg(F.count("*").alias("rows")).where("rows > 1")
    dealt = in_chunks(buckets.join(crowded, "k"), "k", F.ceil(F.col("rows") / F.lit(CHUNK_ROWS)), F.xxhash64("node"))
    dealt = dealt.select("k", "node", "fp").repartition("k").sortWithinPartitions("k")
    met = checkpointed(dealt.mapInArrow(_parts(radius), "k long, node long, rep long").distinct())
    keys = classes.select("node", "fp", F.col("first.tk").alias("tk"), F.col("first.ok").alias("ok"))

    def similar(groups: DataFrame) -> DataFrame:
        """Edges (u, v) inside ``groups`` (g, node, label), whose texts are fetched."""
        asked = checkpointed(groups.join(keys, "node").select("tk", "ok", "g", "node", "label", "fp"))
        few = asked.count() <= BROADCAST_ROWS
        texts = keyed.select("tk", "ok", "t").join(F.broadcast(asked) if few else asked, ["tk", "ok"])
        texts = texts.select("g", "node", "label", "fp", "t").mapInArrow(once, "g long, node long, label long, fp long, t binary")
        verified = texts.repartition("g").sortWithinPartitions("g").mapInArrow(_verified(shingle, radius, least), "u long, v long")
        return checkpointed(verified)

    links_ = similar(first_groups(met, classes, CHUNK_ROWS, CHUNK_SHINGLES))
    links_ = links_.unionByName(similar(second_groups(labelled(met.select("k", "node"), links_), CHUNK_ROWS)))
    found = connected_components(links_)
    one = (
        classes.join(found.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"), "left")
        .groupBy(F.coalesce("component", "node").alias("c"))
        .agg(F.min("first").alias("x"))
    )
    stay = checkpointed(one.select("x.tk", "x.ok", "x.copies"))
    kept = keyed.join(stay, ["tk", "ok"]).select("tk", "ok", "row", "copies")
    out = kept.where("copies = 1").select("row")
    if not stay.where("copies > 1").isEmpty():  # rows that are equal in all columns
        out = out.unionByName(kept.where("copies > 1").dropDuplicates(["tk", "ok"]).select("row"))
    return out.select(*(F.col("row")[c].alias(c) for c in columns))
