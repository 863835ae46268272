"""Algebra on trees kept as edge lists: tree_id, node, parent (null at the root), muts.

Everything that follows ancestors doubles its jump pointers, so a tree of depth
d takes log2(d) rounds; each round is a join whose result is stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import discard, materialize


#: Inner nodes up to so many are sent to all tasks; more are merged with the rows that look for them.
BROADCAST_NODES = 1 << 16


def _met(nodes: DataFrame, n: int) -> DataFrame:
    """n inner nodes as one side of a join, by their count: a stored table's files say little, as names pack well."""
    return nodes.hint("broadcast" if n <= BROADCAST_NODES else "merge")


def _double(rows: DataFrame, cols: Mapping[str, tuple[Callable, Callable]], keep: Sequence[str] = ()) -> DataFrame:
    """cols of every node put together over its whole subtree.

    rows: tree_id, node, parent, cols, keep (stays as it is), and, if known, _in:
    whether a node has children.  cols: by name the aggregate over the jumping
    nodes, and what adds it, null where there are none, to what a node has.
    """
    rows = rows if "_in" in rows.columns else rows.withColumn("_in", F.lit(True))
    now = materialize(rows.select("tree_id", "node", F.col("parent").alias("jump"), "_in", *cols, *keep), "jumps")
    n = now.where("_in").count()
    while True:
        # Only inner nodes are jumped to: the others neither gather nor tell where to go.
        inner = now.where("_in")
        up = now.where("jump is not null").groupBy("tree_id", F.col("jump").alias("node")).agg(*[agg(c).alias(f"_{c}") for c, (agg, _) in cols.items()])
        got = inner.join(up.hint("merge"), ["tree_id", "node"], "left").unionByName(now.where("not _in"), allowMissingColumns=True)
        far = inner.select("tree_id", F.col("node").alias("jump"), F.col("jump").alias("_far"))
        nxt = got.join(_met(far, n), ["tree_id", "jump"], "left").select("tree_id", "node", F.col("_far").alias("jump"), "_in", *[add(F.col(c), F.col(f"_{c}")).alias(c) for c, (_, add) in cols.items()], *keep)
        nxt = materialize(nxt, "jumps")
        discard(now)
        now = nxt
        if now.where("jump is not null").isEmpty():
            return now.drop("jump")


_SUM = (F.sum, lambda own, more: F.when(more.isNull(), own).otherwise(own + more))
_MIN = (F.min, F.least)


def depths(edges: DataFrame) -> DataFrame:
    """edges with depth, 0 at the root."""
    now = materialize(edges.select("tree_id", "node", F.col("parent").alias("jump"), F.col("parent").isNotNull().cast("int").alias("depth")), "depths")
    while not now.where("jump is not null").isEmpty():
        far = now.select("tree_id", F.col("node").alias("jump"), F.col("jump").alias("_far"), F.col("depth").alias("_d"))
        nxt = now.join(far, ["tree_id", "jump"], "left")
        now = materialize(nxt.select("tree_id", "node", F.col("_far").alias("jump"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth")), "depths")
    return edges.join(now.select("tree_id", "node", "depth"), ["tree_id", "node"])


def leaves(edges: DataFrame) -> DataFrame:
    return edges.select("tree_id", "node").join(edges.select("tree_id", F.col("parent").alias("node")), ["tree_id", "node"], "left_anti")


def paths(edges: DataFrame) -> DataFrame:
    """(tree_id, node, steps): from the root to every node, an array of (node, muts)."""
    now = materialize(edges.select("tree_id", "node", F.col("parent").alias("jump"), F.array(F.struct("node", "muts")).alias("steps")), "paths")
    while not now.where("jump is not null").isEmpty():
        far = now.select("tree_id", F.col("node").alias("jump"), F.col("jump").alias("_far"), F.col("steps").alias("_s"))
        nxt = now.join(far, ["tree_id", "jump"], "left")
        now = materialize(nxt.select("tree_id", "node", F.col("_far").alias("jump"), F.when(F.col("_s").isNull(), F.col("steps")).otherwise(F.concat("_s", "steps")).alias("steps")), "paths")
    return now.drop("jump")


def path_text(steps: Column | str) -> Column:
    """`node:mut,mut node:mut ...` of path steps."""
    s = F.col(steps) if isinstance(steps, str) else steps
    mut = lambda m: F.concat(m["ref"], m["pos"].cast("string"), m["alt"])
    return F.array_join(F.transform(s, lambda x: F.concat(x["node"].cast("string"), F.lit(":"), F.array_join(F.transform(x["muts"], mut), ","))), " ")


def below(edges: DataFrame, marked: DataFrame) -> DataFrame:
    """(tree_id, node, n): how many marked nodes (tree_id, node) each subtree holds."""
    rows = edges.join(marked.select("tree_id", "node", F.lit(1).cast("long").alias("n")).distinct(), ["tree_id", "node"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    return _double(rows, {"n": _SUM}).drop("_in")


def induced(edges: DataFrame, samples: DataFrame, collapse: bool = True) -> DataFrame:
    """The subtree of the samples (tree_id, node) and all their ancestors; internal nodes without mutations are contracted when asked."""
    kept = below(edges, samples).where("n > 0").select("tree_id", "node")
    sub = materialize(edges.join(kept, ["tree_id", "node"], "left_semi"), "subtree")
    return contract(sub) if collapse else sub


def contract(edges: DataFrame) -> DataFrame:
    """Internal nodes whose edge has no mutation go; their children move up to the nearest node that stays."""
    tips = leaves(edges).withColumn("_tip", F.lit(True))
    rows = edges.join(tips, ["tree_id", "node"], "left").withColumn("_gone", F.col("parent").isNotNull() & F.col("_tip").isNull() & (F.size("muts") == 0)).drop("_tip")
    rows = materialize(rows, "contract")
    # Where a node that goes points to; pointers to nodes that stay are final.
    now = materialize(rows.where("_gone").select("tree_id", "node", F.col("parent").alias("to")), "to")
    while True:
        far = now.select("tree_id", F.col("node").alias("to"), F.col("to").alias("_far"))
        if now.join(far, ["tree_id", "to"], "left_semi").isEmpty():
            break
        now = materialize(now.join(far, ["tree_id", "to"], "left").select("tree_id", "node", F.coalesce("_far", "to").alias("to")), "to")
    moved = now.select("tree_id", F.col("node").alias("parent"), F.col("to").alias("_to"))
    return rows.where("not _gone").join(moved, ["tree_id", "parent"], "left").select("tree_id", "node", F.coalesce("_to", "parent").alias("parent"), "muts")


def reroot(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Trees rooted at the given nodes (tree_id, root): edges on the way to the old root are turned, their mutations reversed.

    Trees without a row, or with a null root, stay as they are.
    """
    marked = roots.where("root is not null").select("tree_id", F.col("root").alias("node"))
    way = below(edges, marked).where("n > 0").select("tree_id", "node")
    on = materialize(edges.join(way, ["tree_id", "node"], "left_semi"), "way")
    back = lambda m: F.transform(F.reverse(m), lambda x: F.struct(x["alt"].alias("ref"), x["pos"].alias("pos"), x["ref"].alias("alt")))
    turned = on.where("parent is not null").select("tree_id", F.col("parent").alias("node"), F.col("node").alias("parent"), back(F.col("muts")).alias("muts"))
    top = on.join(marked, ["tree_id", "node"], "left_semi").select("tree_id", "node", F.lit(None).cast(edges.schema["parent"].dataType).alias("parent"), F.filter("muts", lambda m: F.lit(False)).alias("muts"))
    rest = edges.join(way, ["tree_id", "node"], "left_anti").select("tree_id", "node", "parent", "muts")
    return rest.unionByName(turned).unionByName(top)


def newick(edges: DataFrame) -> DataFrame:
    """(tree_id, newick): children in order of their text; tips keep their id, inner nodes get `internal_` before it.

    Built level by level from below; a tree's text is one value, so this is for
    trees that fit one.
    """
    rows = materialize(depths(edges), "levels")
    tips = leaves(edges).withColumn("_tip", F.lit(True))
    rows = materialize(rows.join(tips, ["tree_id", "node"], "left").withColumn("name", F.when(F.col("_tip"), F.col("node").cast("string")).otherwise(F.concat(F.lit("internal_"), F.col("node").cast("string")))), "levels")
    deepest = rows.agg(F.max("depth")).first()[0]
    text = None
    for d in range(deepest or 0, -1, -1):
        level = rows.where(F.col("depth") == d)
        if text is not None:
            kids = text.groupBy("tree_id", F.col("parent").alias("node")).agg(F.concat(F.lit("("), F.array_join(F.sort_array(F.collect_list("t")), ","), F.lit(")")).alias("_k"))
            level = level.join(kids, ["tree_id", "node"], "left")
        else:
            level = level.withColumn("_k", F.lit(None).cast("string"))
        text = materialize(level.select("tree_id", "node", "parent", F.concat(F.coalesce("_k", F.lit("")), "name").alias("t")), "newick")
    return text.select("tree_id", F.concat("t", F.lit(";")).alias("newick"))


def export_rows(edges: DataFrame, meta: DataFrame, columns: Sequence[str], key: str = "isolate_id") -> DataFrame:
    """(tree_id, node, json): one line per node with its parent, mutations and, for isolates, metadata columns."""
    rows = edges.join(meta.select(F.col(key).alias("node"), *columns), "node", "left")
    return rows.select("tree_id", "node", F.to_json(F.struct("node", "parent", "muts", *columns)).alias("json"))


# --- many trees as one graph -------------------------------------------------------------------------------------


def _named(edges: DataFrame, key: Column | None = None, keep: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """(tree_id, node, _in, clade, n_leaves, first_leaf, keep), stored, and the number of inner nodes."""
    inner = materialize(edges.where("parent is not null").select("tree_id", F.col("parent").alias("node")).distinct(), "inner")
    n = inner.count()
    rows = edges.join(_met(inner.withColumn("_p", F.lit(True)), n), ["tree_id", "node"], "left").withColumn("_in", F.coalesce("_p", F.lit(False)))
    h = lambda seed: F.when(~F.col("_in"), F.xxhash64(F.lit(seed), F.col("node"))).otherwise(F.lit(0).cast("long")).cast("decimal(38,0)")
    cols = {"h1": _SUM, "h2": _SUM, "n_leaves": _SUM} | ({} if key is None else {"first_leaf": _MIN})
    own = [h(1).alias("h1"), h(2).alias("h2"), (~F.col("_in")).cast("long").alias("n_leaves")] + ([] if key is None else [key.alias("first_leaf")])
    done = _double(rows.select("tree_id", "node", "parent", "_in", *own, *[F.col(c).alias(f"_keep_{c}") for c in keep]), cols, [f"_keep_{c}" for c in keep])
    clade = F.sha2(F.concat_ws(":", "h1", "h2", "n_leaves"), 256).alias("clade")
    return done.select("tree_id", "node", "_in", clade, "n_leaves", *(["first_leaf"] if key is not None else []), *[F.col(f"_keep_{c}").alias(c) for c in keep]), n


def clades(edges: DataFrame) -> DataFrame:
    """(tree_id, node, clade, n_leaves): clade names the set of leaves below, alike in all trees."""
    return _named(edges)[0].select("tree_id", "node", "clade", "n_leaves")


def merge_trees(edges: DataFrame, key: Column | None = None) -> DataFrame:
    """(clade, child, weight, n_trees): edges of all trees between clades, each once, with its number of mutations.

    With a key of the leaves' rows, by which inner nodes are null, also n_leaves
    and first_leaf (the least key below) of the clade, and child_n_leaves and
    child_first_leaf.
    """
    rows, n = _named(edges.withColumn("weight", F.size("muts")), key, ["parent", "weight"])
    told = ["n_leaves", "first_leaf"] if key is not None else []
    up = rows.where("_in").select("tree_id", F.col("node").alias("parent"), F.unhex("clade").alias("_up"), *[F.col(c).alias(f"_up_{c}") for c in told])
    rows = rows.withColumn("_clade", F.unhex("clade")).join(_met(up, n), ["tree_id", "parent"])
    # A clade's leaves are the same wherever it stands.
    same = [F.min(a).alias(b) for c in told for a, b in ((f"_up_{c}", c), (c, f"child_{c}"))]
    out = rows.groupBy("_up", "_clade", "weight").agg(F.countDistinct("tree_id").alias("n_trees"), *same)
    text = lambda c: F.lower(F.hex(c))
    return out.select(text("_up").alias("clade"), text("_clade").alias("child"), "weight", "n_trees", *[b for c in told for b in (c, f"child_{c}")])


def tree_statistics(edges: DataFrame) -> DataFrame:
    """Per tree: nodes, leaves, mutations (its parsimony score)."""
    tip = leaves(edges).groupBy("tree_id").agg(F.count("*").alias("n_leaves"))
    return edges.groupBy("tree_id").agg(F.count("*").alias("n_nodes"), F.sum(F.size("muts").cast("long")).alias("parsimony")).join(tip, "tree_id")
