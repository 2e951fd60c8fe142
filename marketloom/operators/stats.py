"""Descriptive statistics, standardised labels, rank correlation and null reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.numeric import divide
from ..core.storage import kept

#: Ranges of values that a group is ranked in.
RANGES = 64


#: Values that one task sorts; larger intervals are cut into ranges first.
SORTED_ROWS = 1 << 17
#: Parts that a group's facts are laid out in, so that rows of one group meet them in many tasks.
PARTS = 32


def beside(rows: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` with the few ``facts`` of their key; null keys match.  A key with most rows is met in ``PARTS`` parts."""
    dealt = rows.withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)))
    laid = facts.select(
        *(F.col(k).alias(f"__{k}") for k in keys),
        *(c for c in facts.columns if c not in keys),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).alias("__other"),
    )
    on = F.col("__part") == F.col("__other")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return dealt.join(laid, on, how).drop("__part", "__other", *(f"__{k}" for k in keys))


def quantiles(df: DataFrame, column: str, shares: dict[str, float], by: Sequence[str] = (), small: int = SORTED_ROWS) -> DataFrame:
    """(by, names of ``shares``): exact quantiles, linear between neighbours; null for a group without values.

    A quantile lies between two ranks.  Ranks are looked for in intervals of values, at first a group's whole range: an
    interval of more than ``small`` rows is cut into ranges, whose rows are counted, and those with a wanted rank are
    the next intervals.  Then the values of the small intervals are counted and ranked.  No buffer holds the values
    of a group, and a group with most rows is many tasks.  The rows are read once, to narrow ones that are kept.
    """
    by = list(by)
    base = df.select(*by, F.col(column).cast("double").alias("__v"))
    rows = kept(base.where("__v is not null"))
    groups = rows.groupBy(*by).agg(F.count("*").alias("__n"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    at = {name: (F.col("__n") - 1) * F.lit(float(p)) for name, p in shares.items()}
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(a), F.ceil(a)) for a in at.values()))))
    wanted = kept(groups.select(*by, "__n", F.explode(ranks).alias("__rank")))
    spans = kept(groups.select(*by, "__low", "__high", F.lit(0).cast("long").alias("__below"), F.col("__n").alias("__size")))
    done = None
    inside = F.col("__v").between(F.col("__low"), F.col("__high"))
    span = [*by, "__low", "__high", "__below"]
    while True:
        wide = spans.where((F.col("__size") > small) & (F.col("__low") < F.col("__high")))
        settled = spans.where((F.col("__size") <= small) | (F.col("__low") == F.col("__high")))
        done = settled if done is None else done.unionByName(settled)
        if wide.isEmpty():
            break
        met = beside(rows, wide, by).where(inside)
        cuts = met.groupBy(*span).agg(F.percentile_approx("__v", [i / RANGES for i in range(1, RANGES)], 1000).alias("__cuts"))
        placed = beside(rows, cuts, by).where(inside)
        # Values that are a cut are a range of their own, so that a common value does not keep its neighbours.
        place = F.size(F.filter("__cuts", lambda x: x < F.col("__v"))) + F.size(F.filter("__cuts", lambda x: x <= F.col("__v")))
        parts = placed.groupBy(*span, place.alias("__r")).agg(
            F.count("*").alias("__size"), F.min("__v").alias("__from"), F.max("__v").alias("__to")
        )
        ahead = Window.partitionBy(*span).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # two for each cut
        start = F.col("__below") + F.coalesce(F.sum("__size").over(ahead), F.lit(0))
        nexts = parts.select(*by, F.col("__from").alias("__low"), F.col("__to").alias("__high"), start.alias("__below"), "__size")
        spans = kept(_holding(nexts, wanted, by).select(*nexts.columns).distinct())
    done = _holding(done, wanted, by).select(*span).distinct()
    counts = beside(rows, done, by).where(inside).groupBy(*span, "__v").agg(F.count("*").alias("__size"))
    before = Window.partitionBy(*span).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    values = counts.select(*by, "__v", (F.col("__below") + F.coalesce(F.sum("__size").over(before), F.lit(0))).alias("__below"), "__size")
    found = _holding(values, wanted, by).groupBy(*by, "__n").agg(F.map_from_entries(F.collect_set(F.struct("__rank", "__v"))).alias("__at"))

    def value(a: Column) -> Column:
        low, high = F.element_at("__at", F.floor(a)), F.element_at("__at", F.ceil(a))
        return low + (high - low) * (a - F.floor(a))

    out = found.select(*by, *(value(a).alias(name) for name, a in at.items()))
    if not by:
        one = df.sparkSession.range(1).select(F.lit(1).alias("__one"))
        return one.join(out.withColumn("__one", F.lit(1)), "__one", "left").drop("__one")
    every = base.groupBy(*by).agg(F.count("*").alias("__all"))
    return beside_once(every, out, by).drop("__all")


def beside_once(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two tables of one row a key; null keys match."""
    named = right.select(*(F.col(k).alias(f"__{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(named, on, "left").drop(*(f"__{k}" for k in keys))


def _holding(spans: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Spans of ranks (``__below``, ``__size``) with each wanted rank that is in them; a group has few of either."""
    named = wanted.select(*(F.col(k).alias(f"__{k}") for k in by), "__rank", "__n")
    on = (F.col("__rank") >= F.col("__below")) & (F.col("__rank") < F.col("__below") + F.col("__size"))
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return spans.join(named, on).drop(*(f"__{k}" for k in by))


def correlation(x: str, y: str) -> Column:
    """Pearson's correlation of rows in which both are there; null where one of them does not vary."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def distribution(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """min, quartiles (linear between neighbours), mean and max; no group's values are held in one buffer."""
    by, names = list(by), ("min", "q25", "median", "mean", "q75", "max")
    df = kept(df.select(*by, column))
    base = df.groupBy(*by).agg(F.min(column).alias("min"), F.avg(column).alias("mean"), F.max(column).alias("max"))
    quarters = quantiles(df, column, {"q25": 0.25, "median": 0.5, "q75": 0.75}, by)
    return (beside_once(base, quarters, by) if by else base.crossJoin(F.broadcast(quarters))).select(*by, *names)  # one row each


def zscore(df: DataFrame, column: str, output: str) -> DataFrame:
    """(x - mean) / sample deviation over the frame; null if the deviation is 0."""
    one = df.agg(F.avg(column).alias("__mean"), F.stddev_samp(column).alias("__std"))
    out = df.crossJoin(F.broadcast(one))  # one row
    return out.withColumn(output, divide(F.col(column) - F.col("__mean"), F.col("__std"))).drop("__mean", "__std")


def null_inf_report(df: DataFrame, columns: Sequence[str], limit: float = 0.05) -> DataFrame:
    """(column, null_share, flagged, n_infinite), from one pass."""
    numeric = {c for c, t in df.dtypes if t in ("double", "float")}
    infinite = lambda c: F.count_if(F.abs(c) == float("inf")) if c in numeric else F.lit(0).cast("long")
    one = df.agg(
        *(
            F.struct(
                F.lit(c).alias("column"), F.avg(F.col(c).isNull().cast("double")).alias("null_share"), infinite(c).alias("n_infinite")
            ).alias(c)
            for c in columns
        )
    )
    rows = one.select(F.inline(F.array(*columns)))
    return rows.select("column", "null_share", (F.col("null_share") > limit).alias("flagged"), "n_infinite")


def value_places(df: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """(groups, column, below, same): for each value of a group the rows with smaller values, and with this one.

    Nulls are smaller than all.  Counts per value are summed first; then values are placed in ``RANGES`` ranges of
    each group, so that one group is many tasks.
    """
    counts = df.groupBy(*groups, column).agg(F.count("*").alias("same"))
    cuts = counts.groupBy(*groups).agg(F.percentile_approx(column, [i / RANGES for i in range(1, RANGES)], 1000).alias("__cuts"))
    ranged = counts.join(cuts, list(groups)).withColumn("__r", F.coalesce(F.size(F.filter("__cuts", lambda x: x < F.col(column))), F.lit(0)))
    ahead = Window.partitionBy(*groups).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*groups, "__r").agg(F.sum("same").alias("__t"))
    starts = sums.select(*groups, "__r", F.coalesce(F.sum("__t").over(ahead), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*groups, "__r").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("__in", F.coalesce(F.sum("same").over(inside), F.lit(0))).join(starts, [*groups, "__r"])
    return placed.select(*groups, column, (F.col("__start") + F.col("__in")).alias("below"), "same")


def percent_ranks(df: DataFrame, groups: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Adds for each column, under its output name, the share of a group's other rows that are smaller; 0 in a group
    of one.  ``df`` is kept with a number for each row; all columns are ranked in one pass, a row for each value."""
    base = kept(df.withColumn("__id", F.monotonically_increasing_id()))
    values = F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns))
    long = base.select("__id", *groups, F.explode(values).alias("x")).select("__id", *groups, F.col("x.c").alias("__c"), F.col("x.v").alias("__v"))
    places = value_places(long, [*groups, "__c"], "__v").join(base.groupBy(*groups).agg(F.count("*").alias("__n")), list(groups))
    share = F.coalesce(divide(F.col("below"), F.col("__n") - 1), F.lit(0.0)).alias("share")
    known = places.select(*(F.col(g).alias(f"__{g}") for g in groups), F.col("__c").alias("__d"), F.col("__v").alias("__w"), share)
    on = (F.col("__c") == F.col("__d")) & F.col("__v").eqNullSafe(F.col("__w"))
    for g in groups:
        on = on & (F.col(g) == F.col(f"__{g}"))
    ranks = long.join(known, on).groupBy("__id").agg(*(F.max(F.when(F.col("__c") == c, F.col("share"))).alias(o) for c, o in columns.items()))
    return base.join(ranks, "__id").drop("__id")


def rank_ic(
    df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = (), least: int = 100
) -> DataFrame:
    """(by, feature, ic, t_stat, p_value, n): Spearman correlation of each feature with the label.

    Rows where either is null are left out, and groups of fewer than ``least`` rows.  A value's rank is the
    number of rows below it plus the mean place among its equals.  ``df`` is read once, to narrow rows that are
    kept.
    """
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features))
    long = df.select(*by, F.col(label).cast("double").alias("y"), F.explode(pairs).alias("p"))
    long = kept(long.select(*by, "p.feature", "p.x", "y").where("x is not null and y is not null"))
    groups = (*by, "feature")

    def ranks(c: str) -> DataFrame:
        """The rank of each value of a group."""
        mean = F.col("below") + (F.col("same") + 1) / 2
        return value_places(long, groups, c).select(*groups, c, mean.alias(f"r{c}"))

    # Rows of a common value are one key here; adaptive execution splits such a partition, as the sides are only joined.
    both = long.join(ranks("x"), [*groups, "x"]).join(ranks("y"), [*groups, "y"])
    both = both.groupBy(*groups).agg(correlation("rx", "ry").alias("ic"), F.count("*").alias("n"))
    t = divide(F.col("ic") * F.sqrt(F.col("n") - 2.0), F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("ic") * F.col("ic"))))
    found = both.where(F.col("n") >= least).select(*groups, "ic", t.alias("t_stat"), "n")
    return found.select(*groups, "ic", "t_stat", p_value(F.col("t_stat"), F.col("n") - 2).alias("p_value"), "n")


def p_value(t_stat: Column, freedom: Column) -> Column:
    """Two-sided p-value of Student's t: the normal tail at the value that stands for t at so many degrees of freedom.

    z = t (1 - 1 / 4f) / sqrt(1 + t^2 / 2f), within 0.003 of the exact value from 8 degrees on and 0.0001 from 100 on.
    The complementary error function is a rational approximation (absolute error below 1.5e-7).
    """
    z = F.abs(t_stat) * (1 - 1 / (4.0 * freedom)) / F.sqrt(1 + t_stat * t_stat / (2.0 * freedom))
    x = z / F.sqrt(F.lit(2.0))
    k = 1 / (1 + 0.3275911 * x)
    poly = k * (0.254829592 + k * (-0.284496736 + k * (1.421413741 + k * (-1.453152027 + k * 1.061405429))))
    return poly * F.exp(-x * x)
