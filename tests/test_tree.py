import random
import time

import pytest
from pyspark.sql import functions as F

from strandline.operators import histories, parsimony, tree

SCHEMA = "tree_id int, node string, parent string, muts array<struct<ref:string,pos:int,alt:string>>"
M = lambda r, p, a: {"ref": r, "pos": p, "alt": a}


@pytest.fixture(scope="module")
def edges(spark):
    data = [(1, "R", None, []), (1, "i", "R", [M("A", 1, "C")]), (1, "j", "i", []), (1, "x", "i", [M("G", 2, "T")]), (1, "y", "j", [M("C", 1, "G")]), (1, "z", "j", []), (1, "w", "R", [])]
    return spark.createDataFrame(data, SCHEMA)


def pairs(df):
    return {r.node: r.parent for r in df.collect()}


def test_paths_and_depths(edges):
    p = {r.node: r.t for r in tree.paths(edges).select("node", tree.path_text("steps").alias("t")).collect()}
    assert p["y"] == "R: i:A1C j: y:C1G"
    assert {r.node: r.depth for r in tree.depths(edges).collect()} == {"R": 0, "i": 1, "w": 1, "j": 2, "x": 2, "y": 3, "z": 3}


def test_deep_chain(spark):
    n = 150
    e = spark.createDataFrame([(1, f"n{i}", f"n{i - 1}" if i else None, []) for i in range(n)], SCHEMA)
    assert tree.depths(e).agg(F.max("depth")).first()[0] == n - 1


def test_induced_and_contracted(spark, edges):
    chosen = spark.createDataFrame([(1, "y"), (1, "z")], "tree_id int, node string")
    assert pairs(tree.induced(edges, chosen, collapse=False)) == {"R": None, "i": "R", "j": "i", "y": "j", "z": "j"}
    assert pairs(tree.induced(edges, chosen)) == {"R": None, "i": "R", "y": "i", "z": "i"}


def test_reroot_there_and_back(spark, edges):
    at = lambda n: spark.createDataFrame([(1, n)], "tree_id int, root string")
    turned = tree.reroot(edges, at("y"))
    got = pairs(turned)
    assert got["y"] is None and got["j"] == "y" and got["i"] == "j" and got["R"] == "i" and got["w"] == "R"
    muts = {r.node: [tuple(m) for m in r.muts] for r in turned.collect()}
    assert muts["j"] == [("G", 1, "C")] and muts["R"] == [("C", 1, "A")]
    assert pairs(tree.reroot(turned, at("R"))) == pairs(edges)
    assert pairs(tree.reroot(edges, at(None))) == pairs(edges)


def test_newick_and_statistics(edges):
    assert tree.newick(edges).first().newick == "(((y,z)internal_j,x)internal_i,w)internal_R;"
    s = tree.tree_statistics(edges).first()
    assert (s.n_nodes, s.n_leaves, s.parsimony) == (7, 4, 3)


def test_merged_trees_share_clades(spark, edges):
    two = edges.unionByName(edges.withColumn("tree_id", F.lit(2)))
    merged = tree.merge_trees(two)
    assert merged.count() == 6 and {r.n_trees for r in merged.collect()} == {2}


def test_many_nodes_are_merged_not_broadcast(spark, edges, monkeypatch):
    """However small their files are: the names of millions of nodes pack into a few MB."""
    two = edges.unionByName(edges.withColumn("tree_id", F.lit(2)))
    key = F.when(F.col("node").isin("w", "x", "y", "z"), F.ascii("node"))
    few = tree.merge_trees(two, key).orderBy("child").collect()
    monkeypatch.setattr(tree, "BROADCAST_NODES", 0)
    merged = tree.merge_trees(two, key)
    assert merged.orderBy("child").collect() == few
    assert {(r.first_leaf, r.n_leaves, r.child_first_leaf, r.child_n_leaves) for r in few} == {(119, 4, 119, 1), (119, 4, 120, 3), (120, 3, 120, 1), (120, 3, 121, 2), (121, 2, 121, 1), (121, 2, 122, 1)}
    assert "Broadcast" not in merged._jdf.queryExecution().executedPlan().toString()


def test_parsimony_of_a_polytomy(spark):
    e = spark.createDataFrame([(1, "R", None, [])] + [(1, f"l{i}", "R", []) for i in range(4)], SCHEMA)
    leaf = spark.createDataFrame([(1, "l0", "a"), (1, "l1", "a"), (1, "l2", "b"), (1, "l3", "b")], "tree_id int, node string, state string")
    assert parsimony.parsimony_score(e, leaf, ["a", "b", "c"]).first().score == 2
    got = {(r.node, r.state) for r in parsimony.ancestral_states(e, leaf, ["a", "b", "c"]).collect()}
    assert got == {("R", "a"), ("R", "b"), ("l0", "a"), ("l1", "a"), ("l2", "b"), ("l3", "b")}


def test_score_does_not_depend_on_the_root(spark, edges):
    leaf = spark.createDataFrame([(1, "x", "a"), (1, "y", "b"), (1, "z", "a"), (1, "w", "b")], "tree_id int, node string, state string")
    inner = spark.createDataFrame([(1, "j")], "tree_id int, root string")
    assert parsimony.parsimony_score(edges, leaf, ["a", "b"]).first().score == parsimony.parsimony_score(tree.reroot(edges, inner), leaf, ["a", "b"]).first().score


def test_assigned_mutations_give_the_leaves_back(spark, edges):
    sites = spark.createDataFrame([(1, "y", 5, "A", "G"), (1, "z", 5, "A", "G"), (1, "x", 6, "C", "T")], "tree_id int, node string, pos int, ref string, base string")
    out = {r.node: [tuple(m) for m in r.muts] for r in parsimony.assign_mutations(edges, sites).collect()}
    assert out["j"] == [("A", 5, "G")] and out["x"] == [("C", 6, "T")] and sum(map(len, out.values())) == 2


def random_tree(rng, n, kind):
    """(node, parent) with names in random order."""
    name = [f"n{i}" for i in rng.sample(range(n * 3), n)]
    up = {"ladder": lambda i: i - 1 if i % 2 else max(0, i - 2), "random": lambda i: rng.randrange(i), "deep": lambda i: max(0, i - rng.randrange(1, 4)), "star": lambda i: 0, "chain": lambda i: i - 1}[kind]
    return [(name[i], name[up(i)] if i else None) for i in range(n)]


def brute_costs(tree_rows, leaf, states):
    """(cost of each node's subtree by state, states in some cheapest history), by recursion over sorted nodes."""
    kids = {}
    for node, parent in tree_rows:
        kids.setdefault(parent, []).append(node)
    order, n = [], len(states)
    todo = list(kids[None])
    while todo:
        v = todo.pop()
        order.append(v)
        todo += kids.get(v, [])
    gift = lambda c: [min(x, min(c) + 1) for x in c]
    cost, out, up = {}, {}, dict(tree_rows)
    for v in reversed(order):
        own = [0 if leaf.get(v) not in states or leaf[v] == s else parsimony.INF for s in states] if v not in kids else [0] * n
        for w in kids.get(v, []):
            own = [a + b for a, b in zip(own, gift(cost[w]))]
        cost[v] = own
    for v in order:
        p = up[v]
        out[v] = [0] * n if p is None else gift([a + b - c for a, b, c in zip(cost[p], out[p], gift(cost[v]))])
    best = set()
    for v in order:
        t = [a + b for a, b in zip(cost[v], out[v])]
        best |= {(v, s) for s, x in zip(states, t) if x == min(t)}
    return min(cost[order[0]]), best


SHAPES = [("ladder", 61), ("random", 80), ("deep", 90), ("star", 30), ("chain", 40), ("random", 1), ("random", 25)]


def test_contraction_equals_brute_force(spark):
    rng, states = random.Random(7), ["a", "b", "c"]
    rows = {t: random_tree(rng, n, kind) for t, (kind, n) in enumerate(SHAPES)}
    leaf = {t: {v: rng.choice([*states, None, "?"]) for v, _ in r if v not in {p for _, p in r} and rng.random() < 0.9} for t, r in rows.items()}
    e = spark.createDataFrame([(t, v, p, []) for t, r in rows.items() for v, p in r], SCHEMA)
    marks = spark.createDataFrame([(t, v, s) for t, r in leaf.items() for v, s in r.items()], "tree_id int, node string, state string")
    score = {r.tree_id: r.score for r in parsimony.parsimony_score(e, marks, states).collect()}
    got = {(r.tree_id, r.node, r.state) for r in parsimony.ancestral_states(e, marks, states).collect()}
    want = {t: brute_costs(r, leaf[t], states) for t, r in rows.items()}
    assert score == {t: w[0] for t, w in want.items()}
    assert got == {(t, *x) for t, w in want.items() for x in w[1]}


def test_a_ladder_of_two_thousand_levels(spark):
    rng, states = random.Random(3), ["a", "b", "c", "d"]
    rows = random_tree(rng, 4001, "ladder")
    inner = {p for _, p in rows}
    leaf = {v: rng.choice(states) for v, _ in rows if v not in inner}
    e = spark.createDataFrame([(1, v, p, []) for v, p in rows], SCHEMA).repartition(4)
    marks = spark.createDataFrame([(1, v, s) for v, s in leaf.items()], "tree_id int, node string, state string")
    began = time.monotonic()
    score = parsimony.parsimony_score(e, marks, states).first().score
    assert time.monotonic() - began < 60
    assert score == brute_costs(rows, leaf, states)[0]


def brute_mutations(tree_rows, ref, base):
    """Mutations (node, from, to) of one site: every node costed, then bases from the root down."""
    kids = {}
    for node, parent in tree_rows:
        kids.setdefault(parent, []).append(node)
    cost, out = {}, set()
    order = []
    todo = list(kids[None])
    while todo:
        v = todo.pop()
        order.append(v)
        todo += kids.get(v, [])
    for v in reversed(order):
        own = [0] * 4
        if v not in kids:
            b = base.get(v, ref)
            own = [0 if b not in "ACGT" or b == s else parsimony.INF for s in "ACGT"]
        for w in kids.get(v, []):
            own = [a + min(x, min(cost[w]) + 1) for a, x in zip(own, cost[w])]
        cost[v] = own
    took, up = {}, dict(tree_rows)
    for v in order:
        f = took.get(up[v], ref)
        took[v] = min((c + (s != f), s != f, s) for c, s in zip(cost[v], "ACGT"))[2]
        if took[v] != f:
            out.add((v, f, took[v]))
    return out


def test_sparse_mutations_equal_brute_force(spark):
    rng = random.Random(11)
    edges, sites, want = [], [], set()
    for t, (kind, n) in enumerate(SHAPES):
        rows = random_tree(rng, n, kind)
        if kind == "random":  # stretches of single children, below which all leaves may have the reference's base
            rows += [(f"s{i}", rows[rng.randrange(n)][0] if i % 3 == 0 else f"s{i - 1}") for i in range(30)]
        edges += [(t, v, p, []) for v, p in rows]
        inner = {p for _, p in rows}
        tips = [v for v, _ in rows if v not in inner]
        for pos in range(1, 13):
            ref = rng.choice("ACGT") if pos < 12 else "N"
            base = {v: b for v in tips if rng.random() < rng.choice((0.1, 0.5, 0.9)) and (b := rng.choice("ACGTN")) != ref}
            sites += [(t, v, pos, ref, b) for v, b in base.items()]
            if base and ref != "N":
                want |= {(t, pos, *m) for m in brute_mutations(rows, ref, base)}
    out = parsimony.assign_mutations(spark.createDataFrame(edges, SCHEMA), spark.createDataFrame(sites, "tree_id int, node string, pos int, ref string, base string")).collect()
    assert len(out) == len(edges)
    assert {(r.tree_id, m.pos, r.node, m.ref, m.alt) for r in out for m in r.muts if m.pos < 12} == want


def test_sparse_mutations_look_at_ancestors_only(spark):
    rows = random_tree(random.Random(5), 400, "random")
    e = spark.createDataFrame([(1, v, p, []) for v, p in rows], SCHEMA)
    up, inner = dict(rows), {p for _, p in rows}
    tips = [v for v, _ in rows if v not in inner][:3]
    want = set()
    for v in tips:
        while v is not None:
            want.add(v)
            v = up[v]
    got = parsimony.ancestors(e, spark.createDataFrame([(1, v, 7) for v in tips], "tree_id int, node string, pos int"), ["pos"])
    assert sorted(r.node for r in got.collect()) == sorted(want)


def test_trim_keeps_the_cheapest(spark):
    g = spark.createDataFrame([("u", "1", "p", 0), ("u", "1", "q", 1), ("p", "1", "a", 3), ("p", "2", "b", 0), ("q", "1", "a", 1), ("q", "2", "b", 0)], "node string, clade string, child string, weight int")
    assert {(r.node, r.child) for r in parsimony.trim(g, "u").collect()} == {("u", "q"), ("q", "a"), ("q", "b")}
    tie = parsimony.trim(g.withColumn("weight", F.when(F.col("child") == "a", 2).otherwise(0)), "u")
    history = histories.sample_histories(tie, histories.count_histories(tie), spark.createDataFrame([(3,)], "seed int"), "u")
    assert history.groupBy("node", "clade").count().where("count > 1").isEmpty() and history.count() == 3
