"""Unit-cost parsimony on edge lists, and the cheapest histories of a graph of trees.

Costs are arrays with one entry per state.  Subtrees are added up by tree
contraction, what comes from above by pointer doubling, so that the number of
jobs follows the logarithm of the tree's size, not its depth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import discard, materialize
from .contraction import add, apply, at, follow, gift, subtree_costs, times

INF = 1_000_000


def leaf_costs(nodes: DataFrame, states: Sequence[str], state: str = "state") -> DataFrame:
    """nodes with cost: 0 for the observed state; 0 for all where it is null or none of the states."""
    known = F.col(state).isin(*states)
    return nodes.withColumn("cost", F.array(*[F.when(~F.coalesce(known, F.lit(False)) | (F.col(state) == s), 0).otherwise(INF) for s in states]))


def _zeros(n: int) -> Column:
    return F.array(*[F.lit(0)] * n)


def _leaf_rows(edges: DataFrame, leaf_states: DataFrame, states: Sequence[str]) -> DataFrame:
    """(tree_id, node, parent, base): the costs of the leaves' states, zeros for inner nodes."""
    rows = edges.select("tree_id", "node", "parent")
    tips = rows.join(rows.select("tree_id", F.col("parent").alias("node")), ["tree_id", "node"], "left_anti").select("tree_id", "node").join(leaf_states, ["tree_id", "node"], "left")
    costs = leaf_costs(tips, states).select("tree_id", "node", "cost")
    return rows.join(costs, ["tree_id", "node"], "left").select("tree_id", "node", "parent", F.coalesce("cost", _zeros(len(states))).alias("base"))


def states_of(rows: DataFrame, costs: DataFrame, by: Sequence[str], states: Sequence[str]) -> DataFrame:
    """(by, node, state): every state that the node has in some cheapest history, a row each.

    rows: by, node, parent; costs: by, node, cost of the subtree.  What the rest
    of the tree costs a node is, over (min, +), linear in what it costs the
    parent; these maps are composed up to the root.
    """
    n = len(states)
    costed = materialize(rows.select(*by, "node", "parent").join(costs, [*by, "node"]), "costed")
    up = costed.select(*by, F.col("node").alias("parent"), F.col("cost").alias("_up"))
    rest = lambda j: at("_up", j) - at("_gift", j)
    map_ = F.array(*[rest(j) + int(i != j) for i in range(n) for j in range(n)])
    links = costed.withColumn("_gift", gift("cost")).join(up, [*by, "parent"]).select(*by, "node", F.col("parent").alias("to"), map_.alias("map"))
    above = follow(links, by, times("map", "_map", n), name="above").select(*by, "node", apply("map", _zeros(n), n).alias("out"))
    total = costed.join(above, [*by, "node"], "left").withColumn("_t", add("cost", F.coalesce("out", _zeros(n)), n))
    names = F.array(*map(F.lit, states))
    best = F.filter(F.arrays_zip(names.alias("s"), F.col("_t").alias("t")), lambda x: x["t"] == F.array_min("_t"))
    return total.select(*by, "node", F.explode(F.transform(best, lambda x: x["s"])).alias("state"))


def ancestral_states(edges: DataFrame, leaf_states: DataFrame, states: Sequence[str]) -> DataFrame:
    """(tree_id, node, state) for all nodes; leaf_states: tree_id, node, state; leaves without one may have any."""
    rows = materialize(_leaf_rows(edges, leaf_states, states), "leaf-costs")
    return states_of(rows, subtree_costs(rows, ["tree_id"], len(states)), ["tree_id"], states)


def parsimony_score(edges: DataFrame, leaf_states: DataFrame, states: Sequence[str]) -> DataFrame:
    """(tree_id, score): the least number of changes."""
    rows = materialize(_leaf_rows(edges, leaf_states, states), "leaf-costs")
    costs = subtree_costs(rows, ["tree_id"], len(states))
    return rows.where("parent is null").join(costs, ["tree_id", "node"]).select("tree_id", F.array_min("cost").alias("score"))


BASES = ("A", "C", "G", "T")
MUTATIONS = "array<struct<ref:string,pos:int,alt:string>>"


def ancestors(edges: DataFrame, marked: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(tree_id, node, keep): marked (tree_id, node, keep) and all their ancestors, each once.

    In round k everything found so far is joined with the ancestors at distance
    2**k, so it takes log2(depth) rounds, over rows that are all in the result.
    """
    found = materialize(marked.select("tree_id", "node", *keep).distinct(), "ancestors")
    jumps = materialize(edges.where("parent is not null").select("tree_id", "node", F.col("parent").alias("jump")), "jumps")
    while True:
        up = found.join(jumps, ["tree_id", "node"]).select("tree_id", F.col("jump").alias("node"), *keep)
        more = materialize(found.unionByName(up).distinct(), "ancestors")
        discard(found)
        found = more
        far = jumps.select("tree_id", F.col("node").alias("jump"), F.col("jump").alias("_far"))
        longer = materialize(jumps.join(far, ["tree_id", "jump"]).select("tree_id", "node", F.col("_far").alias("jump")), "jumps")
        discard(jumps)
        jumps = longer
        if jumps.isEmpty():
            return found


def assign_mutations(edges: DataFrame, sites: DataFrame) -> DataFrame:
    """edges (tree_id, node, parent, muts) with the cheapest mutations for variant sites.

    sites: tree_id, node (a leaf), pos, ref, base, only where a leaf differs
    from the reference; other leaves have the reference's base, and any base
    that isn't A, C, G or T may be each of them.  A node keeps its parent's base
    where that is cheapest; the root keeps the reference's where it can.

    Of a site only the ancestors of leaves that differ are looked at.  Any other
    subtree costs its parent one for each base but the reference's, and goes
    back to the reference at its first node that has no single child.
    """
    n, by = len(BASES), ["tree_id", "pos"]
    # n stands for any other character of the reference.
    index = lambda c: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, BASES)), F.col(c)), F.lit(0)).cast("int") - 1, F.lit(n))
    tree = materialize(edges.select("tree_id", "node", "parent"), "site-tree")
    kids = materialize(tree.where("parent is not null").groupBy("tree_id", F.col("parent").alias("node")).agg(F.count("*").alias("n_kids"), F.min("node").alias("only")), "site-kids")
    sites = materialize(sites.join(tree.join(kids, ["tree_id", "node"], "left_anti").select("tree_id", "node"), ["tree_id", "node"], "left_semi").select("tree_id", "node", "pos", "ref", "base"), "sites")
    ref = sites.groupBy(*by).agg(F.min("ref").alias("ref"))
    found = ancestors(edges, sites, ["pos"])
    rows = found.join(tree, ["tree_id", "node"])
    seen = rows.where("parent is not null").groupBy(*by, F.col("parent").alias("node")).agg(F.count("*").alias("n_seen"))
    own = leaf_costs(sites, BASES, "base").select(*by, "node", "cost")
    rows = rows.join(kids, ["tree_id", "node"], "left").join(seen, [*by, "node"], "left").join(ref, by).join(own, [*by, "node"], "left")
    others = (F.coalesce("n_kids", F.lit(0)) - F.coalesce("n_seen", F.lit(0))).cast("int")
    rows = materialize(rows.select(*by, "node", "parent", "ref", F.coalesce("cost", F.array(*[F.when(F.col("ref") == b, 0).otherwise(others) for b in BASES])).alias("base")), "site-rows")
    costs = subtree_costs(rows.select(*by, "node", "parent", "base"), by, n)
    costed = rows.drop("base").join(costs, [*by, "node"])
    # The base that a node takes, by its parent's.
    price = lambda b: F.array(*[F.struct((at("cost", s) + int(s != b)).alias("p"), F.lit(s != b).alias("moved"), F.lit(s).alias("s")) for s in range(n)])
    costed = materialize(costed.select(*by, "node", "parent", "ref", F.array(*[F.array_min(price(b))["s"] for b in range(n + 1)]).alias("map")), "site-maps")
    top = costed.where("parent is null").select(*by, F.col("node").alias("to"), F.get("map", index("ref")).alias("_top"))
    links = costed.where("parent is not null").select(*by, "node", F.col("parent").alias("to"), "map")
    ends = follow(links, by, F.array(*[F.get("map", at("_map", b)) for b in range(n + 1)]), name="site-bases")
    took = ends.join(top, [*by, "to"]).select(*by, "node", F.get("map", F.col("_top")).alias("_b")).unionByName(top.select(*by, F.col("to").alias("node"), F.col("_top").alias("_b")))
    based = costed.select(*by, "node", "parent", "ref").join(took, [*by, "node"])
    based = materialize(based.withColumn("base", F.get(F.array(*map(F.lit, BASES)), F.col("_b"))).drop("_b"), "site-bases")
    from_ = based.select(*by, F.col("node").alias("parent"), F.col("base").alias("_from"))
    moved = based.join(from_, [*by, "parent"], "left").withColumn("_from", F.coalesce("_from", "ref")).where("base != _from").select(*by, "node", F.col("_from").alias("ref"), F.col("base").alias("alt"))
    back = based.where((F.col("base") != F.col("ref")) & F.col("ref").isin(*BASES)).select(*by, F.col("node").alias("parent"), F.col("base").alias("_b"), "ref")
    back = back.join(tree, ["tree_id", "parent"]).join(found, [*by, "node"], "left_anti").select(*by, "node", F.col("_b").alias("ref"), F.col("ref").alias("alt"))
    single = kids.where("n_kids = 1").select("tree_id", "node", F.col("only").alias("to"), F.lit(0).alias("map"))
    if not single.isEmpty():
        low = follow(single, ["tree_id"], F.lit(0), name="single").select("tree_id", "node", "to")
        back = back.join(low, ["tree_id", "node"], "left").select(*by, F.coalesce("to", "node").alias("node"), "ref", "alt")
    muts = moved.unionByName(back).groupBy("tree_id", "node").agg(F.sort_array(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), "ref", "alt"))).alias("_m"))
    out = tree.join(muts, ["tree_id", "node"], "left")
    return out.withColumn("muts", F.coalesce(F.transform("_m", lambda m: F.struct(m["ref"].alias("ref"), m["pos"].alias("pos"), m["alt"].alias("alt"))), F.array().cast(MUTATIONS))).drop("_m")


# --- graphs of trees ---------------------------------------------------------------------------------------------


def trim(graph: DataFrame, root: str) -> DataFrame:
    """The edges of cheapest histories below root.

    graph: node, clade, child, weight; a history takes one child per clade of
    each node that it holds.  Costs go from the leaves up, as soon as all
    children of a node are known, and the edges kept are those that reach the
    least of their clade and hang below the root.
    """
    graph = materialize(graph, "graph")
    known = materialize(graph.select(F.col("child").alias("node")).join(graph.select("node"), "node", "left_anti").distinct().withColumn("best", F.lit(0).cast("long")), "best")
    while True:
        open_ = graph.join(known.select("node"), "node", "left_anti")
        costs = open_.join(known.select(F.col("node").alias("child"), "best"), "child", "left")
        ready = costs.groupBy("node", "clade").agg(F.min(F.col("weight") + F.col("best")).alias("c"), F.count_if(F.col("best").isNull()).alias("u")).groupBy("node").agg(F.sum("c").alias("best"), F.sum("u").alias("u")).where("u = 0").select("node", "best")
        ready = materialize(ready, "ready")
        if ready.isEmpty():
            break
        known = materialize(known.unionByName(ready), "best")
    priced = graph.join(known.select(F.col("node").alias("child"), "best"), "child").withColumn("cost", F.col("weight") + F.col("best")).drop("best")
    least = priced.groupBy("node", "clade").agg(F.min("cost").alias("_c"))
    keep = materialize(priced.join(least, ["node", "clade"]).where("cost = _c").select("node", "clade", "child", "weight"), "kept")
    return reachable(keep, root)


def reachable(graph: DataFrame, root: str) -> DataFrame:
    """Edges below root."""
    seen = front = materialize(graph.sparkSession.range(1).select(F.lit(root).alias("node")), "seen")
    while True:
        front = materialize(graph.join(front, "node", "left_semi").select(F.col("child").alias("node")).distinct().join(seen, "node", "left_anti"), "front")
        if front.isEmpty():
            return graph.join(seen, "node", "left_semi")
        seen = materialize(seen.unionByName(front), "seen")
