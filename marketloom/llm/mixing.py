"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the words of its source up to and with it, in a shuffled order,
divided by the source's target.  A source whose target is above its size goes round again, up to ``repeats``
times.  All passes of all documents are put in order of finish time and taken while the budget lasts.

Both running sums (inside a source, and over finish times) have three levels: sums of small ranges, sums of a
few thousand ranges together, a running sum over those, and then windows inside each of them and inside each range.
So one source with a third of all rows, or all of them, is spread over many tasks, and no task has all ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, checkpointed

#: Ranges of a running sum at least, and rows that one range holds, about; a digit more is 16 times the ranges.
LEAST_RANGES, RANGE_ROWS = 4096, 2000
#: Columns that the mix adds.
ADDED = ("size", "source_size", "target", "taken")


def word_count(text_col: str = "text"):
    """Number of runs that are not space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    Sources in code-point order, null last, take ``weights`` in turn and share the total of all sizes.  A
    target stops at ``repeats`` times its source's size; the excess goes to the others by weight until none
    is above.  In order of cap / weight the capped sources come first, so one pass over running sums finds
    where sharing stops; no loop is needed.
    """
    n = len(weights)
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("i") - 1, F.lit(n)) + 1).cast("int"))
    base = sources.withColumn("i", F.row_number().over(ordered)).withColumn("w", weight)
    base = base.withColumn("cap", F.col("source_size") * repeats)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", "i")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        base.withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("w").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("cap_before")) / (F.col("weights") - F.col("w_before")))
    )
    # The first source whose cap holds its share sets the level; those before it are at their caps.
    free = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "i", "level"))).over(everything)
    return level.withColumn("free", free).select(
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        F.when(
            F.col("free").isNull() | (F.struct("ratio", "i") < F.struct("free.ratio", "free.i")), F.col("cap").cast("double")
        )
        .otherwise(F.col("w") * F.col("free.level"))
        .alias("target"),
    )


def shuffle_key(id_col: str = "doc_id", seed: str = "mix"):
    """A fixed shuffle: md5 of the id, null as an empty text."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"|{seed}")).cast("binary"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[float, ...] = (1, 2, 3),
    repeats: int = 3,
    ranges: int | None = None,
    size: Column | None = None,
) -> DataFrame:
    """(``docs`` columns, size, source_size, target, taken): one row per input row.

    Input columns of those four names are replaced.  ``size`` is the column of sizes, where they are known; by
    default the words of the text are counted.

    ``taken`` counts the words that the mix takes of the row, over at most ``repeats`` passes.  Null texts
    have size 0 and take nothing; a null source is a source of its own, after all others; rows that tie in
    id and size are interchangeable.  The budget is the total size; a document that would pass it ends the
    mix.  An empty table returns no rows.  ``ranges`` is the number of ranges of each running sum; by default
    it follows the rows, so that a range stays small enough for one task.
    """
    columns = [c for c in docs.columns if c not in ADDED]
    sized = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.col(f"`{id_col}`").alias("id"),
        (word_count(text_col) if size is None else F.coalesce(size.cast("long"), F.lit(0).cast("long"))).alias("size"),
    ).withColumn("h", shuffle_key("id"))
    narrow = checkpointed(sized.select("source", "id", "size", "h"))
    if ranges is None:
        ranges = LEAST_RANGES
        rows = narrow.count()
        while ranges * RANGE_ROWS < rows:
            ranges *= 16
    shares = checkpointed(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats))

    # Distinct (source, id, size) with the number of copies: repeated rows are one entry of the queue.
    entries = narrow.groupBy("source", "h", "id", "size").agg(F.count("*").alias("copies"))
    placed = _running(entries, ranges).join(
        shares.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))
    )
    placed = checkpointed(placed.drop("s"))
    taken = _take(placed, repeats, ranges).select(
        F.col("source").alias("k_source"), F.col("id").alias("k_id"), F.col("size").alias("k_size"), "source_size", "target", "taken", "copies"
    )
    joined = sized.join(
        taken,
        F.col("source").eqNullSafe(F.col("k_source")) & F.col("id").eqNullSafe(F.col("k_id")) & (F.col("size") == F.col("k_size")),
    )
    return joined.select(
        *(F.col("row")[c].alias(c) for c in columns), "size", "source_size", "target", "taken"
    )


def _ahead(sums: DataFrame, keys: list[str], order: str, coarse: Column) -> DataFrame:
    """Adds ``ahead``: the sum of ``words`` of the rows before each, by ``order``, in two levels; ``coarse`` follows the order."""
    cut = sums.withColumn("__c", coarse)
    before = Window.partitionBy(*keys).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    upper = cut.groupBy(*keys, "__c").agg(F.sum("words").alias("__w"))
    upper = upper.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__c").alias("__d"), F.coalesce(F.sum("__w").over(before), F.lit(0)).alias("__a"))
    inside = Window.partitionBy(*keys, "__c").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    on = F.col("__c") == F.col("__d")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    own = cut.withColumn("__o", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    return own.join(upper, on).withColumn("ahead", F.col("__a") + F.col("__o")).select(*sums.columns, "ahead")


def _running(entries: DataFrame, ranges: int) -> DataFrame:
    """Adds ``before``: the words of the entry's source ahead of it, by (h, id, size)."""
    digits = max(1, len(f"{ranges - 1:x}"))
    cut = entries.withColumn("r", F.substring("h", 1, digits))
    sums = cut.groupBy("source", "r").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    # Three digits less make one of 4,096 ranges.
    starts = _ahead(sums, ["source"], "r", F.substring("r", 1, max(0, digits - 3)))
    starts = starts.select(F.col("source").alias("s"), F.col("r").alias("q"), F.col("ahead").alias("start"))
    inside = Window.partitionBy("source", "r").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    own = cut.withColumn("own", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
    joined = own.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("r") == F.col("q")))
    return joined.select("source", "h", "id", "size", "copies", (F.col("start") + F.col("own")).alias("before"))


def _take(placed: DataFrame, repeats: int, ranges: int) -> DataFrame:
    """Adds ``taken`` per copy.  Entries without words take nothing and stand outside the queue."""
    finish = (F.col("pass") * F.col("source_size") + F.col("before") + F.col("size") * F.col("copies")) / F.col("target")
    queue = (
        placed.where("size > 0 and target > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("pass"))
        .withColumn("finish", finish)
        .withColumn("words", F.col("size") * F.col("copies"))
    )
    # A finish time of 1 is a source's whole target; no source with passes left is far behind it.
    span = F.least(F.floor(F.col("finish") * F.lit(ranges // 2)), F.lit(ranges * 4)).cast("long")
    ranged = queue.withColumn("f", span)
    sums = ranged.groupBy("f").agg(F.sum("words").alias("words"))
    total = placed.agg(F.coalesce(F.sum(F.col("size") * F.col("copies")), F.lit(0)).alias("budget"))
    steps = _ahead(sums, [], "f", F.floor(F.col("f") / 4096)).crossJoin(F.broadcast(total))  # one row
    # The range in which the budget ends, with the words before it: one row.
    last = steps.where("ahead + words > budget").agg(F.min(F.struct("f", "ahead", "budget")).alias("x"))
    last = last.select("x.f", "x.ahead", "x.budget").withColumnRenamed("f", "edge")
    inside = Window.orderBy("finish", "h", "source", "id", "size", "pass").rowsBetween(Window.unboundedPreceding, 0)
    border = (
        ranged.crossJoin(F.broadcast(last))
        .where("f = edge")
        .withColumn("upto", F.col("ahead") + F.sum("words").over(inside))
    )
    first_out = border.where("upto > budget").agg(
        F.min(F.struct("finish", "h", "source", "id", "size", "pass")).alias("out")
    )  # one row; null when the budget holds everything
    order = F.struct("finish", "h", "source", "id", "size", "pass")
    passes = (
        ranged.crossJoin(F.broadcast(first_out))
        .where(F.col("out").isNull() | (order < F.col("out")))
        .groupBy(F.col("source").alias("s"), F.col("id").alias("d"), F.col("size").alias("z"))
        .agg(F.count("*").alias("passes"))
    )
    back = placed.join(
        passes, F.col("source").eqNullSafe(F.col("s")) & F.col("id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("z")), "left"
    )
    return back.withColumn("taken", F.col("size") * F.coalesce("passes", F.lit(0))).drop("s", "d", "z", "passes")
