"""Exact Jaccard join of documents' sets of word n-grams, with signature trees.

A document's set is one node, whatever its copies.  Two sets that link share one of the first few elements of each, in
any order that all sets keep to, so those elements are the buckets and no link is missed.  Elements that a sample finds
common come last in the order; the sample decides how much work there is, never the result.

1. Sets, their prefixes and their signatures (a bitmap of the elements); then ``met``: prefix elements of two sets
   or more whose sizes, and places of the element, allow a link.  They are found in ranges of (element, set), so that a
   common one is spread over many tasks.
2. First turn: every set goes to one group, under the smallest set that it meets; links found there join most of what
   belongs together.
3. Second turn: only elements between sets that are still apart.

In both turns the signatures alone leave the sets that may have a partner, and only their texts are sent.

Inside a group sets are the leaves of a signature tree.  A node holds the OR of its bitmaps and the range of its
sizes; two nodes are compared from the roots down, and a pair is left where the most that any two sets below can have
in common is too little.  Pairs of leaves that remain are decided exactly, unless links have joined them already, so a
task gives a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, utf8
from .groups import SEEN, first_groups, gathered, labelled, once, part_name, second_groups
from .simhash import Shingles

WORDS, PERCENT = 4, 85
#: Rows whose shingles are counted for the order, about, and shingles that come last in it, at most.
SAMPLE_ROWS, COMMON = 8_000, 200_000
#: Sets and shingles of a group, about: larger groups are cut.
CHUNK, CHUNK_SHINGLES = 1024, 4_000_000
#: Rows of a side that is broadcast, at most; larger ones are shuffled.
BROADCAST_ROWS = 500_000
FAN, BLOCK = 8, 1 << 21
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Nodes of a key that are compared by size and place, each with each.
NEIGHBOURS = 16


def least_common(a, b, percent: int = PERCENT):
    """Elements that sets of ``a`` and ``b`` elements must share to link."""
    return -(-percent * (a + b) // (100 + percent))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Bitmap of a set, of a bit an element or more, and behind it the parity of the elements of each bit.

    Wider ones fold onto narrower ones, by OR and by XOR of their halves.  Bitmaps are what nodes of the tree combine;
    parities, of which an element turns one bit whatever the others, tell two sets apart more sharply.
    """
    width = max(64, 1 << (len(hashes) - 1).bit_length())
    counts = np.bincount((hashes >> np.uint64(20)).astype(np.int64) & (width - 1), minlength=width)
    return np.packbits(np.concatenate([counts > 0, counts % 2 == 1]), bitorder="little").view("<u8")


def folded(signatures: np.ndarray) -> np.ndarray:
    """Signatures, a row each, at half their width."""
    a, b, c, d = np.split(signatures, 4, axis=1)
    return np.concatenate([a | b, c ^ d], axis=1)


class Tree:
    """Signatures of one width, the leaves, and nodes of ``FAN`` neighbours over them up to one root.

    A level has the OR of the bitmaps, the least and greatest size, and the greatest number of elements of a set
    that share a bit with another element of it.
    """

    def __init__(self, signatures: np.ndarray, sizes: np.ndarray, height: int):
        bits, self.parity = np.split(signatures, 2, axis=1)
        crowd = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, crowd)]
        for _ in range(height):
            bits, low, high, crowd = self.levels[-1]
            cut = np.arange(0, len(bits), FAN)
            up = (np.bitwise_or, bits), (np.minimum, low), (np.maximum, high), (np.maximum, crowd)
            self.levels.append(tuple(f.reduceat(x, cut, axis=0) for f, x in up))


def _possible(a: Tree, b: Tree, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets below nodes ``i`` of ``a`` and ``j`` of ``b``, both of one level, can link."""
    (bits_a, low_a, high_a, crowd_a), (bits_b, low_b, high_b, crowd_b) = a.levels[level], b.levels[level]
    keep = (100 * high_a[i] >= percent * low_b[j]) & (100 * high_b[j] >= percent * low_a[i])
    at = np.flatnonzero(keep)
    need = least_common(low_a[i], low_b[j], percent)
    for block in np.array_split(at, max(1, len(at) * bits_a.shape[1] // BLOCK)):
        x, y = i[block], j[block]
        both = np.bitwise_count(bits_a[x] & bits_b[y]).sum(axis=1, dtype=np.int64)
        most = both + np.minimum(crowd_a[x], crowd_b[y])
        if level == 0:  # a parity that differs takes an element that differs
            differ = np.bitwise_count(a.parity[x] ^ b.parity[y]).sum(axis=1, dtype=np.int64)
            most = np.minimum(most, (low_a[x] + low_b[y] - differ) // 2)
        keep[block] = most >= need[block]
    return keep


def traverse(a: Tree, b: Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that may link, from the roots down; of one tree with itself each pair once."""
    i = j = np.zeros(1, np.int64)
    for level in reversed(range(len(a.levels))):
        keep = _possible(a, b, level, i, j, percent)
        i, j = i[keep], j[keep]
        if level:
            step = np.arange(FAN)
            i = np.repeat((i[:, None] * FAN + step).ravel(), FAN)
            j = np.repeat(j[:, None] * FAN + step, FAN, axis=0).ravel()
            inside = (i < len(a.levels[level - 1][0])) & (j < len(b.levels[level - 1][0]))
            if a is b:
                inside &= (i < j) if level == 1 else (i <= j)
            i, j = i[inside], j[inside]
        elif a is b:
            i, j = i[i < j], j[i < j]
    return i, j


def candidates(sizes: np.ndarray, signatures: list[np.ndarray], near: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of a group that may link, by dual traversal of the trees of their widths.

    Sets that link are of one width or of neighbouring ones.  ``near`` orders the leaves: equal values are likely alike.
    """
    width = np.array([len(s) for s in signatures])
    order = np.lexsort((sizes, near))
    for words in np.unique(width):
        own = order[width[order] == words]
        wider = order[width[order] == 2 * words]
        bits = np.stack([signatures[m] for m in own])
        height = 0
        while FAN**height < max(len(own), len(wider)):
            height += 1
        tree = Tree(bits, sizes[own], height)
        i, j = traverse(tree, tree, percent)
        yield own[i], own[j]
        if len(wider):
            halves = folded(np.stack([signatures[m] for m in wider]))
            i, j = traverse(tree, Tree(halves, sizes[wider], height), percent)
            yield own[i], wider[j]


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets link."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
    """(group, its other columns by node), of groups of two nodes or more; rows come sorted by the first column, of one node the first one counts."""
    group, rows = None, {}
    for batch in batches:
        *columns, last = batch.columns  # the last one is long: its values are taken one by one
        for g, node, *rest in zip(*(c.to_pylist() for c in columns), last, strict=True):
            if g != group:
                if len(rows) > 1:
                    yield group, rows
                group, rows = g, {}
            if node not in rows:
                rows[node] = (*rest[:-1], rest[-1].as_py())
    if len(rows) > 1:
        yield group, rows


def _forest(words: int, percent: int):
    """Edges of a spanning forest of each group's links between sets of different labels."""

    def run(batches):
        shingles = Shingles(words)
        for _, rows in _by_group(batches):
            nodes, sets = list(rows), [shingles(t or b"") for _, t in rows.values()]
            label = np.unique([x for x, _ in rows.values()], return_inverse=True)[1]
            sizes, least = np.array([len(s) for s in sets]), np.array([s[0] for s in sets])
            u, v = [], []
            for left, right in candidates(sizes, [signature(s) for s in sets], least, percent):
                order = np.argsort(left, kind="stable")
                left, right = left[order], right[order]
                for part in np.split(right, np.flatnonzero(np.diff(left)) + 1) if len(left) else ():
                    one = left[0]
                    left = left[len(part) :]
                    for other in part[label[part] != label[one]].tolist():
                        if label[other] != label[one] and similar(sets[one], sets[other], percent):
                            label[label == label[other]] = label[one]
                            u.append(nodes[one])
                            v.append(nodes[other])
            if u:
                yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _pairs_of_few(rows: list[tuple], percent: int) -> tuple[list[int], list[int]]:
    """Pairs of a few (label, size, near, signature) of different labels that may link: all pairs, by their parities."""
    parities, left, right = [], [], []
    for label, size, _, data in rows:
        half = len(data) // 2
        parities.append((label, size, half, int.from_bytes(data[half:], "little")))
    for i, (label, size, half, parity) in enumerate(parities):
        for j in range(i):
            other, other_size, other_half, other_parity = parities[j]
            if label == other or 100 * min(size, other_size) < percent * max(size, other_size):
                continue
            a, b, narrow = parity, other_parity, min(half, other_half)
            if half != other_half:  # the wider one folds; sizes allow one step
                low = (1 << 8 * narrow) - 1
                a, b = ((x & low) ^ (x >> 8 * narrow) for x in (a, b))
            if size + other_size - (a ^ b).bit_count() >= 2 * least_common(size, other_size, percent):
                left.append(i)
                right.append(j)
    return left, right


def _hopeful(percent: int):
    """(g, node, label): sets of a group that may link across labels, in the parts that such pairs connect.

    A part is named by its nodes, so that what many elements have in common is the same group from each of them.
    """

    def pairs(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        if len(rows) <= FAN:  # one node of a tree
            return tuple(np.array(x, np.int64) for x in _pairs_of_few(rows, percent))
        label, size, near = (np.array([r[c] for r in rows]) for c in range(3))
        found = list(candidates(size, [np.frombuffer(r[3], "<u8") for r in rows], near, percent))
        left, right = (np.concatenate(x) for x in zip(*found, strict=True))
        apart = label[left] != label[right]
        return left[apart], right[apart]

    def run(batches):
        out = [], [], []

        def given():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out], names=["g", "node", "label"])

        for _, rows in _by_group(batches):
            nodes, values = np.array(list(rows), np.int64), list(rows.values())
            for part in gathered(*pairs(values), len(values)):
                name = part_name(nodes[part])
                for column, x in zip(out, (np.full(len(part), name), nodes[part], [values[i][0] for i in part]), strict=True):
                    column.append(x)
            if len(out[0]) > 1_000:
                yield given()
                out = [], [], []
        yield given()

    return run


def _counted(words: int):
    def run(batches):
        shingles = Shingles(words)
        for batch in batches:
            sets = [shingles(t.as_py() or b"") for t in batch.column(0)]
            values, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["x", "n"])

    return run


def common(docs: DataFrame, text_col: str, words: int, rows: int = SAMPLE_ROWS, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes in ascending order, their counts) of the commonest shingles of about ``rows`` rows."""
    step = max(1, docs.count() // rows)
    sample = docs.where(F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)), F.lit(step)) == 0).select(utf8(text_col).alias("t"))
    counts = sample.mapInArrow(_counted(words), "x long, n long").groupBy("x").agg(F.sum("n").alias("n")).where("n > 2")
    found = counts.orderBy(F.desc("n"), "x").limit(most).toPandas()
    hashes = found["x"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found["n"].to_numpy(np.int64)[order]


def prefix(hashes: np.ndarray, known: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first elements of a sorted set, one of which every set that links with it has among its own first ones.

    Elements that are not ``known`` come first, by hash, then the known ones by count and hash.
    """
    n = len(hashes)
    size = n - -(-percent * n // 100) + 1
    at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
    old = known[at] == hashes if len(known) else np.zeros(n, bool)
    rare = hashes[~old][:size]
    if len(rare) == size:
        return rare
    rest, often = hashes[old], counts[at[old]]
    return np.concatenate([rare, rest[np.lexsort((rest, often))][: size - len(rare)]])


def _sketched(words: int, percent: int, known: np.ndarray, counts: np.ndarray):
    """Set, size and, the first time that the task meets the set, prefix and signature."""

    def run(batches):
        from xxhash import xxh3_64_intdigest

        shingles, seen = Shingles(words), set()
        for batch in batches:
            nodes, sizes, keys, bits = [], [], [], []
            for t in batch.column(2):
                s = shingles(t.as_py() or b"")
                node = int(np.uint64(xxh3_64_intdigest(s.tobytes())).view(np.int64)) if len(s) else None
                nodes.append(node)
                sizes.append(len(s))
                new = node is not None and node not in seen
                keys.append(prefix(s, known, counts, percent).view(np.int64) if new else None)
                bits.append(signature(s).tobytes() if new else None)
                if new:
                    if len(seen) >= SEEN:
                        seen = set()
                    seen.add(node)
            columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["doc_id", "rk", "node", "n", "keys", "bits"])

    return run


def _runs(percent: int):
    """(k, node, rep) of keys with two nodes or more that may link, in a sorted range of (k, node, n, place).

    Here ``k`` becomes a name of the key's nodes, so that sets which share many elements meet once.  ``place`` is the key's in the set: at the first element that two sets share, neither has more in common than what
    it has from there on.  Keys of more than ``NEIGHBOURS`` nodes are given whole, and so are the range's first and
    last key, as their other nodes may be in another range.  ``rep`` is the smallest node that a node may link with.
    """

    def given(rows, first, last):
        k, v, n, place = rows
        new = np.r_[True, (k[1:] != k[:-1]) | (v[1:] != v[:-1])]
        k, v, n, place = (x[new] for x in (k, v, n, place))
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        length = np.diff(np.r_[starts, len(k)])
        crowd = np.repeat(length > NEIGHBOURS, length)
        keep, rep = crowd.copy(), np.where(crowd, np.repeat(v[starts], length), v)
        rest = n - place
        for d in range(1, min(NEIGHBOURS, len(k))):
            i = np.flatnonzero((k[d:] == k[:-d]) & ~crowd[d:])
            if not len(i):
                break
            j = i + d
            fits = np.minimum(rest[i], rest[j]) >= least_common(n[i], n[j], percent)
            i, j = i[fits], j[fits]
            keep[i] = keep[j] = True
            rep[j] = np.minimum(rep[j], v[i])
        edge = np.zeros(len(k), bool)
        edge[: length[0]] = first
        edge[len(k) - length[-1] :] |= last
        keep |= edge
        k, v, rep, edge = (x[keep] for x in (k, v, rep, edge))
        if len(k):
            starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            h = v.view(np.uint64) * _GOLD
            name = np.add.reduceat((h ^ (h >> np.uint64(31))) * _GOLD, starts).view(np.int64)
            k = np.where(edge, k, np.repeat(name, np.diff(np.r_[starts, len(k)])))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (k, v, rep)], names=["k", "node", "rep"])

    def run(batches):
        held, first = [np.empty(0, np.int64)] * 4, True
        for batch in batches:
            held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
            k = held[0]
            if len(k) and k[0] != k[-1]:
                cut = int(np.searchsorted(k, k[-1]))  # the last run may go on
                yield given([h[:cut] for h in held], first, False)
                held, first = [h[cut:] for h in held], False
        if len(held[0]):
            yield given(held, first, True)

    return run


def _linked(docs: DataFrame, groups: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (u, v) inside ``groups`` (g, node, label): the signatures first, then the texts of what they leave."""
    met = groups.join(sets.select("node", "n", "near", "bits"), "node").select("g", "node", "label", "n", "near", "bits")
    hopeful = met.repartition("g").sortWithinPartitions("g").mapInArrow(_hopeful(percent), "g long, node long, label long")
    dealt = checkpointed(hopeful.distinct().join(sets.select("node", "rk"), "node").select("g", "node", "label", "rk"))
    rows = docs.select(_row_key(docs).alias("rk"), utf8("text").alias("t"))
    few = dealt.count() <= BROADCAST_ROWS
    texts = rows.join(F.broadcast(dealt) if few else dealt, "rk").select("g", "node", "label", "t")
    texts = texts.mapInArrow(once, "g long, node long, label long, t binary").repartition("g").sortWithinPartitions("g")
    return checkpointed(texts.mapInArrow(_forest(words, percent), "u long, v long"))


def _row_key(docs: DataFrame):
    return F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    A set holds the distinct ``words``-word shingles of the text, A-Z in lower case, split at white space; fewer words
    are one shingle.  Rows link when the intersection has ``percent`` % of the union or more; ``component_id`` is the
    smallest doc_id that links reach, the row's own included.  Null, empty and word-less texts have an empty set and
    link with nothing, each other included.  Repeated rows are a row each.  A null doc_id never becomes a component's
    id, unless there is no other.  Other columns, whatever their names, take no part; no rows give none.  Shingles and
    sets are told apart by 64-bit hashes.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known, counts = common(docs, "text", words)
    marks = checkpointed(
        docs.select("doc_id", _row_key(docs).alias("rk"), utf8("text").alias("t")).mapInArrow(
            _sketched(words, percent, known, counts), "doc_id long, rk long, node long, n long, keys array<long>, bits binary"
        )
    )
    given = marks.where("keys is not null")
    keyed = given.select("node", "n", F.posexplode("keys").alias("place", "k")).select("k", "node", "n", F.col("place").cast("long").alias("place"))
    ranged = keyed.repartitionByRange("k", "node").sortWithinPartitions("k", "node")
    met = ranged.mapInArrow(_runs(percent), "k long, node long, rep long")
    met = checkpointed(met.groupBy("k", "node").agg(F.min("rep").alias("rep")))
    # A set that several tasks have met has a row from each, equal but for the row that it was met in.
    sets = checkpointed(given.select("node", "rk", "n", F.element_at("keys", 1).alias("near"), "bits").dropDuplicates(["node"]))

    edges = _linked(docs, checkpointed(first_groups(met, sets, CHUNK, CHUNK_SHINGLES)), sets, words, percent)
    apart = checkpointed(second_groups(labelled(met.select("k", "node"), edges), CHUNK))
    edges = edges.unionByName(_linked(docs, apart, sets, words, percent))

    firsts = marks.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    grouped = labelled(firsts, edges)
    lowest = grouped.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = grouped.join(lowest, "label").select("node", "component_id")
    columns = "doc_id", F.col("n").alias("n_shingles")
    linked = marks.where("node is not null").join(classes, "node").select(*columns, "component_id")
    return linked.unionByName(marks.where("node is null").select(*columns, F.col("doc_id").alias("component_id")))
