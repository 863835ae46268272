"""Costs of all subtrees by tree contraction: rake leaves, compress chains.

A node's cost is its own plus, for each child, the least of the child's cost and
the change between both.  Raking adds finished children to their parents.  Where
only one child is left, that is a linear map of the child's cost over (min, +),
an n x n matrix; maps of a chain are composed by pointer doubling.  The number
of jobs grows with the logarithm of the tree's size, whatever its depth.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import discard, materialize


def least(values: Sequence[Column]) -> Column:
    return F.least(*values) if len(values) > 1 else values[0]


def at(m: Column | str, i: int) -> Column:
    return F.get(m, F.lit(i))


def unit(n: int) -> Column:
    """The matrix of one for every change."""
    return F.array(*[F.lit(int(i != j)) for i in range(n) for j in range(n)])


def times(a: Column | str, b: Column | str, n: int) -> Column:
    """Product of two matrices over (min, +)."""
    return F.array(*[least([at(a, i * n + k) + at(b, k * n + j) for k in range(n)]) for i in range(n) for j in range(n)])


def apply(m: Column | str, v: Column | str, n: int) -> Column:
    """A matrix applied to a vector over (min, +)."""
    return F.array(*[least([at(m, i * n + k) + at(v, k) for k in range(n)]) for i in range(n)])


def add(a: Column | str, b: Column | str, n: int) -> Column:
    return F.array(*[at(a, i) + at(b, i) for i in range(n)])


def gift(cost: Column | str) -> Column:
    """What a node's costs cost its neighbour, state by state: stay, or change once."""
    cost = F.col(cost) if isinstance(cost, str) else cost
    low = F.array_min(cost)
    return F.transform(cost, lambda c: F.least(c, low + 1))


def follow(links: DataFrame, by: Sequence[str], join: Column, name: str = "links") -> DataFrame:
    """links (by, node, to, map) with `to` where no link leads further and map the composition on the way, by pointer doubling.

    join: the map of a link and the one it leads to, named `map` and `_map`,
    composed.  Every row knows whether its `to` leads further, so that no round
    is needed to find out that all are done.
    """
    links = links.select(*by, "node", "to", "map")
    more = links.select(*by, F.col("node").alias("to"), F.lit(True).alias("_open"))
    now = materialize(links.join(more, [*by, "to"], "left").select(*by, "node", "to", "map", F.coalesce("_open", F.lit(False)).alias("_open")), name)
    while not now.where("_open").isEmpty():
        next_ = now.select(*by, F.col("node").alias("to"), F.col("to").alias("_far"), F.col("map").alias("_map"), F.col("_open").alias("_more"))
        rows = now.join(next_, [*by, "to"], "left")
        longer = rows.select(*by, "node", F.coalesce("_far", "to").alias("to"), F.when(F.col("_open"), join).otherwise(F.col("map")).alias("map"), F.coalesce("_more", F.lit(False)).alias("_open"))
        longer = materialize(longer, name)
        discard(now)
        now = longer
    return now.drop("_open")


def subtree_costs(rows: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """(by, node, cost): every node's least cost of its subtree by its own state.

    rows: by, node, parent, base: an array of n costs of the node's own states.
    """
    by = list(by)
    kids = rows.where("parent is not null").groupBy(*by, F.col("parent").alias("node")).agg(F.count("*").cast("int").alias("open"))
    live = rows.join(kids, [*by, "node"], "left").select(*by, "node", "parent", "base", F.coalesce("open", F.lit(0)).alias("open"), F.lit(None).cast("array<int>").alias("edge"))
    live = materialize(live, "contract")
    finished, chains, stored = [], [], [live]
    while True:
        tips = live.where("open = 0")
        finished.append(tips.select(*by, "node", F.col("base").alias("cost")))
        given = tips.where("parent is not null").select(*by, F.col("parent").alias("node"), F.when(F.col("edge").isNull(), gift("base")).otherwise(apply("edge", "base", n)).alias("_g"))
        sums = given.groupBy(*by, "node").agg(F.count("*").cast("int").alias("_k"), F.array(*[F.sum(at("_g", i)).cast("int") for i in range(n)]).alias("_sum"))
        left = live.where("open > 0").join(sums, [*by, "node"], "left")
        left = materialize(left.select(*by, "node", "parent", F.when(F.col("_k").isNull(), F.col("base")).otherwise(add("base", "_sum", n)).alias("base"), (F.col("open") - F.coalesce("_k", F.lit(0))).alias("open"), "edge"), "contract")
        stored.append(left)
        some, single = left.agg(F.count("*"), F.count_if(F.col("open") == 1)).first()
        if not some:
            break
        live = _compress(left, by, n, chains) if single else left
        stored.append(live)
    done = materialize(reduce(DataFrame.unionByName, finished), "costs")
    discard(*stored)
    for chain in reversed(chains):
        ends = done.select(*by, F.col("node").alias("to"), "cost")
        more = materialize(done.unionByName(chain.join(ends, [*by, "to"]).select(*by, "node", apply("map", "cost", n).alias("cost"))), "costs")
        discard(done)
        done = more
    return done


def _compress(left: DataFrame, by: list[str], n: int, chains: list[DataFrame]) -> DataFrame:
    """left without the nodes that have one open child, where such nodes follow each other; chains gets their maps to the chain's end."""
    single = left.where("open = 1")
    child = left.where("parent is not null").select(*by, F.col("node").alias("to"), F.col("parent").alias("node"), F.coalesce("edge", unit(n)).alias("_e"), (F.col("open") == 1).alias("_long"))
    each = single.join(child, [*by, "node"])
    own = F.array(*[at("base", i) + at("_e", i * n + j) for i in range(n) for j in range(n)])
    links = materialize(each.select(*by, "node", "to", own.alias("map"), "_long"), "chains")
    if links.where("_long").isEmpty():
        return left
    done = follow(links, by, times("map", "_map", n), name="chains")
    chains.append(done)
    tops = single.select(*by, "node", "parent", F.coalesce("edge", unit(n)).alias("_e")).join(single.select(*by, F.col("node").alias("parent")), [*by, "parent"], "left_anti")
    hung = tops.join(done, [*by, "node"]).select(*by, F.col("to").alias("node"), F.col("parent").alias("_up"), F.when(F.col("parent").isNotNull(), times("_e", "map", n)).alias("_edge"), F.lit(True).alias("_hung"))
    rest = left.where("open <> 1").join(hung, [*by, "node"], "left")
    pick = lambda new, old: F.when(F.col("_hung"), F.col(new)).otherwise(F.col(old)).alias(old)
    return materialize(rest.select(*by, "node", pick("_up", "parent"), "base", "open", pick("_edge", "edge")), "contract")
