"""Merkle manifest of a table: a leaf for each row, a tree for each group, a tree over the groups' roots, and proofs.

H is the lowercase hex SHA-256 of its inputs' concatenation, digests as hex text.  Every two consecutive nodes become
their H; a last node without partner becomes the H of itself alone.

1. ``placed``: a row's place in its group, by ranges and their counts, so that a group is spread over many tasks.
2. ``tree``: 4,096 consecutive nodes of a level are one task's group, which builds twelve levels above them; the next
   turn does the same with what remains, a 4,096th.  A node keeps the digest of its sibling as its segment.
3. ``proofs``: pointer jumping.  Every node points to its parent and holds the segment towards it.  A self-join of the
   nodes with those that they point at concatenates the two segments and doubles the distance, until every leaf
   points at the root.  After a turn of distance d only levels divisible by 2d are pointed at, so the others leave.
   High nodes are pointed at by many leaves, so they meet them by blocks of 4,096 leaves, never by a single key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

#: Levels of the tree that a task builds at a time; a block has 2 ** STRIDE leaves.
STRIDE = 12
_NODES = "g string, n long, level int, idx long, digest binary, segment binary"


def leaf(columns: Sequence[Column]) -> Column:
    """H of the values: ``-`` for null, else the number of UTF-8 bytes, a colon and the value; integers in decimal."""

    def part(column: Column) -> Column:
        value = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, columns)).cast("binary"), 256))


def parent(digests: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def depth(n: int) -> int:
    """Levels between a leaf and the root of a tree of ``n`` leaves."""
    return max(0, (n - 1).bit_length())


def has_sibling(idx: int, level: int, n: int) -> bool:
    return bool(idx & 1) or idx + 1 < -(-n >> level)


def fold(digest: bytes, pos: int, n: int, segment: bytes) -> bytes:
    """The root that a leaf at ``pos`` of ``n`` and its siblings' digests, from below to above, give."""
    at = 0
    for level in range(depth(n)):
        idx, pair = pos >> level, [digest]
        if has_sibling(idx, level, n):
            pair.insert(0 if idx & 1 else 1, segment[at : at + 32])
            at += 32
        digest = parent(pair)
    return digest


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (0, 1, ... inside ``g`` by ``order``) and ``n``, the rows of ``g``.  Rows that are equal
    in all columns of the order must be equal altogether."""
    ranged = checkpointed(rows.repartitionByRange("g", *order).withColumn("range", F.spark_partition_id()))
    counts = ranged.groupBy("g", "range").agg(F.count("*").alias("c"))
    ahead = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = counts.select(
        "g", "range", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("offset"), F.sum("c").over(Window.partitionBy("g")).alias("n")
    )
    own = ranged.withColumn("own", F.row_number().over(Window.partitionBy("g", "range").orderBy(*order)))
    found = own.join(offsets, ["g", "range"])
    return found.select(*rows.columns, (F.col("own") - 1 + F.col("offset")).alias("pos"), "n")


def _subtree(stride: int):
    """The nodes of up to ``stride`` levels over a block of consecutive nodes, and the one above them."""

    def built(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        g, n, base, first = (table[c][0].as_py() for c in ("g", "n", "level", "idx"))
        digests, out = table["digest"].to_pylist(), {"level": [], "idx": [], "digest": [], "segment": []}
        top = min(stride, depth(n) - base)
        for up in range(top + 1):
            idx = first >> up
            for i, digest in enumerate(digests):
                out["level"].append(base + up)
                out["idx"].append(idx + i)
                out["digest"].append(digest)
                # The topmost node's sibling is in another block: the next turn, or nothing if it is the root.
                other = digests[i ^ 1] if (i ^ 1) < len(digests) else b""
                out["segment"].append(other if up < top else None)
            digests = [parent(digests[i : i + 2]) for i in range(0, len(digests), 2)]
        size = len(out["idx"])
        schema = pa.schema([("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.binary()), ("segment", pa.binary())])
        nodes = pa.table(out, schema)
        return nodes.add_column(0, "n", pa.array([n] * size, pa.int64())).add_column(0, "g", pa.array([g] * size, pa.string()))

    return built


def levels(n: Column | str) -> Column:
    """``depth`` of a column."""
    n = F.col(n) if isinstance(n, str) else n
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def tree(leaves: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(nodes below the roots, roots, greatest depth) over ``leaves`` (g, pos, n, digest).

    Nodes have (g, n, level, idx, digest, segment), the segment being the sibling's digest, or empty; roots have
    (g, digest).
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    base = leaves.select("g", "n", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest")
    nodes = roots = None
    for _ in range(max(1, -(-depth(most) // STRIDE))):
        block = F.shiftright("idx", STRIDE).alias("block")
        built = checkpointed(base.groupBy("g", block).applyInArrow(_subtree(STRIDE), _NODES))
        below, above = built.where("segment is not null"), built.where("segment is null")
        done = above.where(F.col("level") == levels("n")).select("g", "digest")
        nodes, roots = (below, done) if nodes is None else (nodes.unionByName(below), roots.unionByName(done))
        base = above.where(F.col("level") < levels("n")).drop("segment")
    return nodes, roots, depth(most)


def _blocks(level: Column, idx: Column, n: Column) -> Column:
    """Blocks of leaves under a node, one row each."""
    first = F.expr("shiftleft(idx, level)")
    last = F.least(F.expr("shiftleft(idx + 1, level)"), F.col("n")) - 1
    return F.explode(F.sequence(F.shiftright(first, STRIDE), F.shiftright(last, STRIDE)))


def proofs(nodes: DataFrame, depth_: int) -> DataFrame:
    """(g, pos, segment) of every leaf that is not a root: its siblings' digests up to its root, by pointer jumping."""
    held, distance = nodes.select("g", "n", "level", "idx", "segment"), 1
    while distance < depth_:
        kept = held.where(F.col("level") % (2 * distance) == 0)
        kept = kept.withColumn("block", F.shiftright(F.expr("shiftleft(idx, level)"), STRIDE))
        target = held.where(F.col("level") % (2 * distance) == distance).select(
            "g",
            (F.col("level") - distance).alias("level"),
            F.col("idx").alias("ancestor"),
            _blocks(F.col("level"), F.col("idx"), F.col("n")).alias("block"),
            F.col("segment").alias("rest"),
        )
        joined = kept.withColumn("ancestor", F.shiftright("idx", distance)).join(target, ["g", "level", "ancestor", "block"], "left")
        onward = F.concat("segment", F.coalesce("rest", F.lit(b"")))  # none: the segment ends at the root
        held = checkpointed(joined.select("g", "n", "level", "idx", onward.alias("segment")))
        distance *= 2
    return held.where("level = 0").select("g", F.col("idx").alias("pos"), "segment")



def manifest(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (g, digest and others) with subroot, root, pos, n, segment, place, groups and upper.

    ``pos`` of ``n`` is the row's leaf in the tree of its group ``g`` (never null), ``place`` of ``groups`` that of
    the group's root in the upper tree, by ``g``; ``segment`` and ``upper`` are the siblings' digests in both.
    Rows that are equal in ``order`` must be equal altogether; repeated rows are a leaf each.  No rows give none.
    """
    leaves = checkpointed(placed(rows, order))
    nodes, roots, deep = tree(leaves)
    within = proofs(nodes, deep)
    over = checkpointed(placed(roots.select(F.lit("").alias("g"), F.col("g").alias("group"), "digest"), ["group"]))
    top, root, high = tree(over)
    upper = proofs(top, high)
    root = root.select(F.col("g"), F.col("digest").alias("root"))  # one row
    tops = over.join(upper, ["g", "pos"], "left").join(root, "g").select(
        F.col("group").alias("g"),
        F.col("digest").alias("subroot"),
        "root",
        F.col("pos").alias("place"),
        F.col("n").alias("groups"),
        F.coalesce("segment", F.lit(b"")).alias("upper"),
    )
    # The last jump, from a group's root to the root: a group meets its leaves by blocks.
    counts = leaves.groupBy("g").agg(F.max("n").alias("n"))
    blocks = tops.join(counts, "g").select(
        *tops.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, STRIDE))).alias("block")
    )
    proven = leaves.join(within, ["g", "pos"], "left").withColumn("block", F.shiftright("pos", STRIDE))
    proven = proven.withColumn("segment", F.coalesce("segment", F.lit(b"")))
    return proven.join(blocks, ["g", "block"]).drop("block")


def _folded(batches):
    for batch in batches:
        roots = [
            fold(fold(digest, pos, n, segment), place, groups, upper)
            for digest, pos, n, segment, place, groups, upper in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(roots, pa.binary())], names=["row", "folded"])


def group_key(column: str) -> Column:
    """A key without nulls whose order is null first, then by UTF-8 bytes."""
    value = F.col(f"`{column}`").cast("string")
    return F.coalesce(F.concat(F.lit("1"), value), F.lit("0"))


def verified_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "lang",
    id_col: str = "doc_id",
    changed: dict[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), digests as hex text, a row for each row.

    A row's leaf is the H of ``columns``; leaves ascend by id in their group, nulls first, rows of one id by leaf.
    ``proof_sha256`` is the H of its siblings.  ``folded_root`` is worked out anew from the row as it is later (where
    ``where`` holds, with the ``changed`` columns; else unchanged) and its original siblings; ``verified`` tells
    whether it is the root.  A null is a value of its own in a leaf, a null group a group, empty texts texts; repeated
    rows are a leaf each; a table of one row has it as subroot and, with one group, as root; an empty table gives none.
    Other columns, whatever their names, take no part.
    """
    original = [F.col(f"`{c}`") for c in columns]
    now = [(changed or {}).get(c, F.col(f"`{c}`")) for c in columns]
    later = F.when(F.coalesce(where if where is not None else F.lit(bool(changed)), F.lit(False)), leaf(now))
    rows = docs.select(
        group_key(group_col).alias("g"), F.col(f"`{id_col}`").alias("doc_id"), leaf(original).alias("digest"), later.alias("later")
    )
    found = manifest(rows, ["doc_id", "digest"])
    row = F.struct("doc_id", "digest", "subroot", "root", "segment", "upper").alias("row")
    proof = F.sha2(F.lower(F.hex(F.concat("row.segment", "row.upper"))).cast("binary"), 256)
    folded = found.select(row, F.coalesce("later", "digest").alias("digest"), "pos", "n", "segment", "place", "groups", "upper")
    kind = folded.schema["row"].dataType.simpleString()
    folded = folded.mapInArrow(_folded, f"row {kind}, folded binary")

    def text(column: str) -> Column:
        return F.lower(F.hex(column))

    return folded.select(
        "row.doc_id",
        text("row.digest").alias("leaf"),
        text("row.subroot").alias("subroot"),
        text("row.root").alias("root"),
        proof.alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("row.root")).alias("verified"),
    )
