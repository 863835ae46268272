"""Order-aware relational operators, DataFrame to DataFrame.

First-wins and order-dependent results always follow an explicit order column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.scratch import materialize


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key; null keys are one key.

    As an aggregate, rows are reduced before the shuffle, so a hot key costs one
    row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: n_rows, n_distinct, n_duplicates."""
    g = df.groupBy(*keys).agg(F.count("*").alias("c"))
    out = g.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_distinct"))
    return out.withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def value_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts per value, nulls left out."""
    return df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("n"))


def upper_median(column: str) -> Column:
    """Aggregate: the upper median of a date column, nulls left out."""
    # The middle of the descending order is the upper one of two.
    return F.date_from_unix_date(F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_date(`{column}`) DESC)").cast("int"))


def interpolated_median(df: DataFrame, by: Sequence[str], value: str, cuts: int = 256) -> DataFrame:
    """(by, median): the exact interpolated median of each group; nulls and NaN are left out.

    Both middle values are found in passes: a quantile sketch of the values that
    are left proposes a short range about the rank, then the values below, at,
    within and beyond its ends are counted exactly, and the part that holds the
    rank is left.  Sketches and counts are merged, so no task holds a group's
    values; every pass leaves about one value in `cuts`.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rows = materialize(rows, "median-values")
    ends = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    ranks = F.explode(F.array_distinct(F.array(F.expr("(_n - 1) div 2"), F.expr("_n div 2")))).alias("_rank")
    todo = materialize(ends.select(*by, ranks, F.lit(0).cast("long").alias("_below"), "_n", "_lo", "_hi"), "median-ranks")
    found = [todo.where("_lo = _hi")]

    def within(target: DataFrame, *columns: str) -> DataFrame:
        """The values within each target's range, with the target's columns."""
        there = target.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], "_rank", "_lo", "_hi", *columns)
        same = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
        for i, c in enumerate(by):
            same = same & F.col(c).eqNullSafe(F.col(f"_b{i}"))
        return rows.join(there, same)

    while True:
        todo = todo.where("_lo < _hi")
        if todo.isEmpty():
            break
        sketch = within(todo, "_below", "_n").groupBy(*by, "_rank", "_below", "_n", "_lo", "_hi").agg(F.percentile_approx("_v", [i / cuts for i in range(cuts + 1)], 10 * cuts).alias("_c"))
        at = F.floor((F.col("_rank") - F.col("_below") + 0.5) / F.col("_n") * cuts).cast("int")
        sketch = materialize(sketch.select(*by, "_rank", "_below", "_lo", "_hi", F.get("_c", at).alias("_from"), F.get("_c", at + 1).alias("_to")), "median-ranges")
        part = F.when(F.col("_v") < F.col("_from"), 0).when(F.col("_v") == F.col("_from"), 1).when(F.col("_v") < F.col("_to"), 2).when(F.col("_v") == F.col("_to"), 3).otherwise(4)
        counts = within(sketch, "_below", "_from", "_to").groupBy(*by, "_rank", "_below", part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = F.col("_below") + F.sum("_n").over(W.partitionBy(*by, "_rank").orderBy("_part")) - F.col("_n")
        placed = counts.withColumn("_start", before).where((F.col("_start") <= F.col("_rank")) & (F.col("_rank") < F.col("_start") + F.col("_n")))
        todo = materialize(placed.select(*by, "_rank", F.col("_start").alias("_below"), "_n", "_lo", "_hi"), "median-ranks")
        found.append(todo.where("_lo = _hi"))
    return reduce(DataFrame.unionByName, found).groupBy(*by).agg((F.min("_lo") / 2 + F.max("_lo") / 2).alias("median"))


def top_k(df: DataFrame, k: int, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first k rows of each group in the order."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")


def share_of_total(df: DataFrame, n: str, by: Sequence[str], total: str = "total", share: str = "share") -> DataFrame:
    w = W.partitionBy(*by)
    return df.withColumn(total, F.sum(n).over(w)).withColumn(share, F.col(n) / F.col(total))


def missing_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of left that right lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def require_complete(left: DataFrame, right: DataFrame, key: str) -> None:
    """Raise with the first five keys of left that right lacks."""
    gone = [r[0] for r in missing_ids(left, right, key).orderBy(key).limit(5).collect()]
    if gone:
        raise ValueError(f"ids without a partner, the first: {gone}")


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], column: str = "ord", size: str | None = None) -> DataFrame:
    """df with column: each group's rows numbered from 1 in the order, and, if asked, the group's size.

    Rows are dealt out by ranges of group and order and numbered where they lie;
    only counts per range and group are added up, so a group of any size is
    spread over tasks.  The numbers don't depend on the ranges if the order
    tells all rows of a group apart.
    """
    names = [f"_o{i}" for i in range(len(order))]
    rows = df.withColumns({n: F.col(o) if isinstance(o, str) else o for n, o in zip(names, order)})
    rows = rows.repartitionByRange(*by, *names).sortWithinPartitions(*by, *names).drop(*names).withColumn("_at", F.monotonically_increasing_id())
    rows = materialize(rows, "numbered").withColumn("_range", F.shiftright("_at", 33))
    counts = rows.groupBy(*by, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    every = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_n").over(every.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_before", before).withColumn("_size", F.sum("_n").over(every))
    there = counts.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], F.col("_range").alias("_r"), "_first", "_before", "_size")
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_b{i}"))
    out = rows.join(there, same).withColumn(column, (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("int"))
    return out.select(*[c for c in df.columns if c != column], column, *([F.col("_size").alias(size)] if size else []))


def pinned_order(df: DataFrame, key: str, first: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, ord, key): distinct keys sorted by name behind the pinned one, which is added where it's missing."""
    ids = df.select(*by, key).distinct()
    groups = ids.select(*by).distinct() if by else None
    pinned = (groups if by else df.sparkSession.range(1).drop("id")).select(*by, F.lit(first).alias(key))
    both = ids.unionByName(pinned).distinct()
    return numbered(both, by, [(F.col(key) != first).cast("int"), key]).select(*by, "ord", key)


def permute(df: DataFrame, seeds: int, key: str, is_ref: str, by: Sequence[str] = ()) -> DataFrame:
    """Every row once per seed, in a seeded order with the reference on top: columns seed and new_ord.

    Equal seeds give equal orders on any cluster; groups of one row are an error.
    """
    rows = df.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
    out = numbered(rows, [*by, "seed"], [(~F.col(is_ref)).cast("int"), F.xxhash64("seed", key), key], "new_ord", "_size")
    place = F.when(F.col("_size") < 2, F.raise_error(F.lit("a permutation needs two rows")).cast("int")).otherwise(F.col("new_ord"))
    return out.withColumn("new_ord", place).drop("_size")


def sample_rows(df: DataFrame, k: int, key: str, is_ref: str, by: Sequence[str], seed: int = 0) -> DataFrame:
    """Up to k rows beside the reference per group, by seeded hash.

    The limit stands alone in its filter, so that Spark applies it in every task
    before the shuffle: a group sends at most k rows a task.
    """
    w = W.partitionBy(*by).orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)
    drawn = df.where(~F.col(is_ref)).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")
    return df.where(is_ref).unionByName(drawn)


def interval_join(points: DataFrame, intervals: DataFrame, by: Sequence[str], pos: str = "pos", start: str = "start", end: str = "end", width: int = 256) -> DataFrame:
    """Points with the intervals of their group that hold them, start included, end excluded.

    Both sides meet in bins of the given width, an interval in each one that it
    touches, so the join is an equality and a group's points are spread.
    """
    cells = F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))
    wide = intervals.where(F.col(end) > F.col(start)).withColumn("_bin", F.explode(cells))
    return points.withColumn("_bin", F.floor(F.col(pos) / width)).join(wide, [*by, "_bin"]).where((F.col(pos) >= F.col(start)) & (F.col(pos) < F.col(end))).drop("_bin")


def dense_counts(df: DataFrame, by: Sequence[str], column: str, values: Sequence[str], n: str = "n") -> DataFrame:
    """Counts for every group and every one of the fixed values, 0 where there are none: one pass, no join."""
    wide = df.groupBy(*by).agg(*[F.count_if(F.col(column) == v).alias(f"_v{i}") for i, v in enumerate(values)])
    cells = F.array(*[F.struct(F.lit(v).alias(column), F.col(f"_v{i}").alias(n)) for i, v in enumerate(values)])
    return wide.select(*by, F.inline(cells))


def pivot_counts(df: DataFrame, by: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """One column of counts per fixed value."""
    return df.groupBy(*by).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0, list(values))


def histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, bin, n, pct): right-closed last bin; values outside count in the share's base only."""
    x = F.col(column)
    b = F.when(x == hi, bins).when((x >= lo) & (x < hi), F.width_bucket(x, F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)))
    g = df.where(x.isNotNull()).groupBy(*by, b.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(*by)) if by else F.sum("n").over(W.partitionBy(F.lit(0)))
    return g.withColumn("pct", 100.0 * F.col("n") / total).where(F.col("bin").isNotNull())


def union_in_order(frames: Sequence[DataFrame], order: str = "ord") -> DataFrame:
    """Rows of all frames; the frame's number leads the order."""
    out = None
    for i, df in enumerate(frames):
        part = df.withColumn(order, F.struct(F.lit(i).alias("frame"), F.col(order).cast("long").alias("row")))
        out = part if out is None else out.unionByName(part)
    return out


def same_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, with the side; empty where the sets are equal."""
    a = missing_ids(left, right, key).select(key, F.lit("left").alias("side"))
    return a.unionByName(missing_ids(right, left, key).select(key, F.lit("right").alias("side")))
