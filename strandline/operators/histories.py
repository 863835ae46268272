"""Many trees as one graph of histories: merging, exact counts, uniform samples.

A node of the graph is a set of leaves, a genome and the split of the leaves
among its children; trees that agree on all three share it.  A history takes one
child for each clade of every node that it holds, from the root down.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import discard, materialize
from .tree import clades

#: The node above all trees' roots.
TOP = "top"
#: Genome sums are kept modulo this prime, so that they stay within a long.
MODULUS = (1 << 61) - 1
#: So many groups multiply a node's clades before their products are multiplied.
PRODUCT_GROUPS = 256


def genomes(edges: DataFrame) -> DataFrame:
    """(tree_id, node, g1, g2): a hash of the node's differences from the reference.

    Every mutation adds the hash of its new base and takes off that of the old
    one, so the sum along a path depends on the bases reached, not on the way;
    the sums are gathered by pointer doubling.
    """
    h = lambda seed, m, b: F.pmod(F.xxhash64(F.lit(seed), m["pos"], m[b]), F.lit(MODULUS))
    own = lambda seed: F.aggregate("muts", F.lit(0).cast("long"), lambda a, m: F.pmod(a + h(seed, m, "alt") - h(seed, m, "ref"), F.lit(MODULUS)))
    now = materialize(edges.select("tree_id", "node", F.col("parent").alias("jump"), own(1).alias("g1"), own(2).alias("g2")), "genomes")
    while not now.where("jump is not null").isEmpty():
        far = now.select("tree_id", F.col("node").alias("jump"), F.col("jump").alias("_far"), F.col("g1").alias("_g1"), F.col("g2").alias("_g2"))
        sum_ = lambda c: F.pmod(F.col(c) + F.coalesce(f"_{c}", F.lit(0).cast("long")), F.lit(MODULUS)).alias(c)
        longer = materialize(now.join(far, ["tree_id", "jump"], "left").select("tree_id", "node", F.col("_far").alias("jump"), sum_("g1"), sum_("g2")), "genomes")
        discard(now)
        now = longer
    return now.drop("jump")


def history_graph(edges: DataFrame) -> DataFrame:
    """(node, clade, child, weight, n_trees): the edges of all trees' nodes, each once, below one node TOP.

    edges: tree_id, node, parent, muts; the trees share their leaves' names.
    weight is the number of mutations on the edge, the least where trees differ.
    """
    named = clades(edges).drop("n_leaves").join(genomes(edges), ["tree_id", "node"])
    named = materialize(named, "named")
    rows = edges.join(named, ["tree_id", "node"])
    split = rows.where("parent is not null").groupBy("tree_id", F.col("parent").alias("node")).agg(F.sum(F.xxhash64("clade").cast("decimal(38,0)")).alias("_s"), F.count("*").alias("_n"))
    id_ = F.sha2(F.concat_ws(":", "clade", "g1", "g2", F.coalesce("_s", F.lit(0)), F.coalesce("_n", F.lit(0))), 256)
    ids = materialize(rows.join(split, ["tree_id", "node"], "left").select("tree_id", "node", "parent", "clade", F.size("muts").alias("weight"), id_.alias("id")), "ids")
    up = ids.select("tree_id", F.col("node").alias("parent"), F.col("id").alias("_up"))
    each = ids.join(up, ["tree_id", "parent"], "left").select("tree_id", F.coalesce("_up", F.lit(TOP)).alias("node"), F.when(F.col("_up").isNull(), "").otherwise(F.col("clade")).alias("clade"), F.col("id").alias("child"), "weight")
    return each.groupBy("node", "clade", "child").agg(F.min("weight").alias("weight"), F.countDistinct("tree_id").alias("n_trees"))


def primes(n: int) -> list[int]:
    """The n largest primes below 2**31."""
    small = [p for p in range(2, 46_342) if all(p % q for q in range(2, math.isqrt(p) + 1))]
    out, x = [], (1 << 31) - 1
    while len(out) < n:
        if all(x % p for p in small):
            out.append(x)
        x -= 2
    return out


def from_residues(residues: Sequence[int], moduli: Sequence[int]) -> int:
    """The number below the product of the moduli with these residues."""
    x, m = 0, 1
    for r, p in zip(residues, moduli):
        x += m * ((r - x) * pow(m, -1, p) % p)
        m *= p
    return x


@dataclass(frozen=True)
class Counts:
    """nodes: node, log_n (natural), residues of the number of histories below it modulo the moduli, which hold any count of the graph."""

    nodes: DataFrame
    moduli: list[int]

    def exact(self, node: str = TOP) -> int:
        row = self.nodes.where(F.col("node") == node).first()
        return from_residues(row.residues, self.moduli) if row else 0


def count_histories(graph: DataFrame) -> Counts:
    """The number of histories below every node of the graph (node, clade, child, ...), exact.

    Counts are residues modulo so many primes that no count can be lost: a
    history is a choice for every node's clades, so the product of the numbers
    of choices bounds them.  Nodes are done once all their children are.
    """
    graph = materialize(graph.select("node", "clade", "child").distinct(), "graph")
    bits = graph.groupBy("node", "clade").agg(F.count("*").alias("k")).agg(F.coalesce(F.sum(F.log2("k")), F.lit(0.0))).first()[0]
    moduli = primes(int(bits / 30.99) + 2)
    ps, ones = F.array(*[F.lit(p) for p in moduli]).cast("array<long>"), F.array_repeat(F.lit(1).cast("long"), len(moduli))
    product = lambda lists: F.aggregate(lists, ones, lambda a, x: F.transform(a, lambda v, i: v * F.get(x, i) % F.get(ps, i)))
    leaves = graph.select(F.col("child").alias("node")).join(graph.select("node"), "node", "left_anti").distinct()
    known = materialize(leaves.select("node", F.lit(0.0).alias("log_n"), ones.alias("residues")), "counts")
    while True:
        children = known.select(F.col("node").alias("child"), "log_n", "residues")
        rows = graph.join(known.select("node"), "node", "left_anti").join(children, "child", "left")
        tops = rows.groupBy("node", "clade").agg(F.max("log_n").alias("_top"), F.count_if(F.col("residues").isNull()).alias("_open"))
        ready = tops.join(tops.groupBy("node").agg(F.sum("_open").alias("_o")).where("_o = 0"), "node", "left_semi")
        each = rows.join(ready, ["node", "clade"])
        sums = each.groupBy("node", "clade", "_top").agg(F.sum(F.exp(F.col("log_n") - F.col("_top"))).alias("_e"), F.array(*[F.sum(F.get("residues", F.lit(i))) % p for i, p in enumerate(moduli)]).alias("_r"))
        parts = sums.withColumn("_b", F.pmod(F.xxhash64("clade"), F.lit(PRODUCT_GROUPS))).groupBy("node", "_b").agg(F.sum(F.col("_top") + F.log("_e")).alias("log_n"), product(F.collect_list("_r")).alias("_r"))
        found = materialize(parts.groupBy("node").agg(F.sum("log_n").alias("log_n"), product(F.collect_list("_r")).alias("residues")), "counts")
        if found.isEmpty():
            return Counts(known, moduli)
        known = materialize(known.unionByName(found), "counts")


def sample_histories(graph: DataFrame, counts: Counts, seeds: DataFrame, root: str = TOP) -> DataFrame:
    """(seed, node, clade, child, weight): one history below root per seed, every history as likely as any other.

    A clade's child is drawn in proportion to the histories below it: the first
    of exponential waiting times, made from a hash of the seed and the place, so
    equal seeds give equal histories on any cluster.
    """
    graph = materialize(graph.select("node", "clade", "child", "weight").join(counts.nodes.select(F.col("node").alias("child"), "log_n"), "child"), "weighed")
    u = (F.pmod(F.xxhash64("seed", "node", "clade", "child"), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    wait = F.log(-F.log(u)) - F.col("log_n")
    front = seeds.select("seed", F.lit(root).alias("node"))
    out = None
    while True:
        drawn = front.join(graph, "node").groupBy("seed", "node", "clade").agg(F.min_by(F.struct("child", "weight"), F.struct(wait, F.col("child"))).alias("x"))
        drawn = materialize(drawn.select("seed", "node", "clade", "x.child", "x.weight"), "drawn")
        if out is not None and drawn.isEmpty():
            return out
        out = drawn if out is None else out.unionByName(drawn)
        front = drawn.select("seed", F.col("child").alias("node"))
