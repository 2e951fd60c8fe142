"""Groups in which nodes are compared: parts of buckets, chunks of large ones, and two turns over them.

In the first turn every node is in one group, under the smallest node that it meets, and the links found there join most
of what belongs together.  The second turn has only keys between nodes that are still apart.  So what many keys have
in common is compared once, and no key is a group by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components

#: Rows that a task knows it has already given; the table starts anew when it is full.
SEEN = 500_000


def gathered(left: np.ndarray, right: np.ndarray, n: int) -> list[np.ndarray]:
    """Members of the parts that pairs of 0, ..., n - 1 connect."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        if (low == label[left]).all() and (low == label[right]).all():
            break
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
    met = np.unique(np.concatenate([left, right]))
    order = met[np.argsort(label[met], kind="stable")]
    return np.split(order, np.flatnonzero(np.diff(label[order])) + 1) if len(met) else []


def part_name(nodes: np.ndarray) -> int:
    """A name that a set of nodes has wherever it is met."""
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(np.sort(nodes).tobytes())).view(np.int64))


def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose first two columns this task has not given yet: repeated rows leave a task about once."""
    seen = set()
    for batch in batches:
        keep = []
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keep.append(pair not in seen)
            if len(seen) >= SEEN:
                seen = set()
            seen.add(pair)
        yield batch.filter(pa.array(keep, pa.bool_()))


def labelled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` with their component as ``label``; the node itself without edges."""
    found = connected_components(edges).select("node", F.col("component").alias("label"))
    return nodes.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))


def first_groups(met: DataFrame, sets: DataFrame, chunk: int, shingles: int) -> DataFrame:
    """(g, node, label): every node of ``met`` (k, node, rep) under the smallest node that it meets, ``rep``; that one is
    in each chunk of its group.  ``sets`` has the sizes ``n`` of the nodes."""
    under = met.groupBy("node").agg(F.min("rep").alias("rep")).where("rep <> node").join(sets.select("node", "n"), "node")
    sizes = under.groupBy("rep").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    sizes = sizes.withColumn("chunks", F.ceil(F.greatest(F.col("rows") / chunk, F.col("shingles") / shingles)))
    members = under.join(sizes, "rep").select("rep", F.pmod(F.xxhash64("node"), "chunks").alias("chunk"), "node")
    heads = sizes.select("rep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.col("rep").alias("node"))
    return members.unionByName(heads).select(F.xxhash64("rep", "chunk").alias("g"), "node", F.col("node").alias("label"))


def second_groups(met: DataFrame, chunk: int) -> DataFrame:
    """(g, node, label): nodes of ``met`` (k, node, label) that share a key and are apart, in pairs of chunks of the key's.

    The nodes of a key's largest component meet the others only, never each other.
    """
    parts = met.groupBy("k", "label").agg(F.count("*").alias("rows"))
    keys = parts.groupBy("k").agg(
        F.count("*").alias("labels"), F.sum("rows").alias("rows"), F.max(F.struct("rows", "label")).alias("main")
    ).where("labels > 1")
    rows = met.join(keys, "k").withColumn("chief", F.col("label") == F.col("main.label"))
    own, rest = F.ceil(F.col("main.rows") / chunk), F.ceil((F.col("rows") - F.col("main.rows")) / chunk)
    rows = rows.select("k", "node", "label", "chief", own.alias("own"), rest.alias("rest"), F.xxhash64("node", F.lit(3)).alias("h"))

    def upto(column: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1)).alias("other")

    chief, others = rows.where("chief"), rows.where("not chief")
    across = chief.select("k", "node", "label", F.pmod("h", "own").alias("c"), upto("rest")).unionByName(
        others.select("k", "node", "label", upto("own"), F.pmod("h", "rest").alias("c")).select("k", "node", "label", F.col("other").alias("c"), F.col("c").alias("other"))
    )
    within = others.select("k", "node", "label", F.pmod("h", "rest").alias("c"), upto("rest")).select(
        "k", "node", "label", F.least("c", "other").alias("c"), (-1 - F.greatest("c", "other")).alias("other")
    )
    return across.unionByName(within).select(F.xxhash64("k", "c", "other").alias("g"), "node", "label")
