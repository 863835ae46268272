"""Merged trees, counts and samples of histories against brute force."""

import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strandline.operators import histories, parsimony

SEED = 12
SCHEMA = "tree_id int, node string, parent string, muts array<struct<ref:string,pos:int,alt:string>>"


def random_binary(rng, tips, site_states):
    """Edges (node, parent, muts) of a random tree; inner genomes are those of a random leaf below."""
    parts = [(t, dict(site_states[t])) for t in tips]
    kids, name = {}, itertools.count()
    genome = {t: dict(site_states[t]) for t in tips}
    while len(parts) > 1:
        rng.shuffle(parts)
        n = 3 if len(parts) > 2 and rng.random() < 0.2 else 2
        taken, parts = parts[:n], parts[n:]
        v = f"i{next(name)}"
        kids[v] = [x for x, _ in taken]
        genome[v] = dict(rng.choice(taken)[1])
        parts.append((v, genome[v]))
    root, up = parts[0][0], {}
    for v, ws in kids.items():
        up |= dict.fromkeys(ws, v)
    ref = {p: "A" for p in next(iter(site_states.values()))}
    muts = lambda v: [{"ref": (genome[up[v]] if v in up else ref)[p], "pos": p, "alt": b} for p, b in sorted(genome[v].items()) if b != (genome[up[v]] if v in up else ref)[p]]
    return [(v, up.get(v), muts(v)) for v in [*tips, *kids]], root


def brute_graph(trees):
    """The same graph made by hand: nodes are (leaves, genome, split), edges (node, clade, child): (weight, trees)."""
    out = defaultdict(lambda: [None, set()])
    for t, rows in trees.items():
        kids, muts = defaultdict(list), {}
        for v, p, m in rows:
            kids[p].append(v)
            muts[v] = m

        def build(v, genome, t=t, kids=kids, muts=muts):
            genome = dict(genome)
            for m in muts[v]:
                genome[m["pos"]] = m["alt"]
                if m["alt"] == "A":
                    del genome[m["pos"]]
            made = [build(w, genome) for w in kids.get(v, [])]
            leaves = frozenset([v]) if not made else frozenset().union(*[x[0] for x in made])
            id_ = (leaves, frozenset(genome.items()), frozenset(x[0] for x in made))
            for w, x in zip(kids.get(v, []), made):
                edge = out[id_, x[0], x]
                edge[0] = len(muts[w]) if edge[0] is None else min(edge[0], len(muts[w]))
                edge[1].add(t)
            return id_

        top = build(kids[None][0], {})
        edge = out["top", "", top]
        edge[0] = len(muts[kids[None][0]])
        edge[1].add(t)
    return {k: (w, len(t)) for k, (w, t) in out.items()}


def brute_histories(graph, node):
    """All histories below a node as sorted tuples of edges, and their cost."""
    clades = defaultdict(list)
    for (v, clade, child), (w, _) in graph.items():
        if v == node:
            clades[clade].append((child, w))
    choices = [[(w + cost, ((node, clade, child), *edges)) for child, w in options for cost, edges in brute_histories(graph, child)] for clade, options in clades.items()]
    return [(sum(c for c, _ in pick), tuple(e for _, es in pick for e in es)) for pick in itertools.product(*choices)]


def two_halves(rng, tips, states):
    """A tree whose root parts the leaves always alike, with a random tree on either side; roots have the reference's genome or another."""
    rows, top = [], rng.choice(([], [{"ref": "A", "pos": 1, "alt": "C"}]))
    for side, part in enumerate((tips[:4], tips[4:])):
        half, root = random_binary(rng, part, states)
        flip = lambda m, v, root=root: [x for x in _from_root(m, top)] if v == root else m
        rows += [(v if v in tips else f"{v}{side}", "R" if p is None else f"{p}{side}", flip(m, v)) for v, p, m in half]
    return [*rows, ("R", None, top)]


def _from_root(muts, top):
    """muts of a node under the reference, for a parent with the mutations of top."""
    base = {m["pos"]: m["alt"] for m in top}
    want = {m["pos"]: m["alt"] for m in muts}
    return [{"ref": base.get(p, "A"), "pos": p, "alt": want.get(p, "A")} for p in sorted({*base, *want}) if base.get(p, "A") != want.get(p, "A")]


@pytest.fixture(scope="module")
def trees():
    rng = random.Random(SEED)
    tips = [f"t{i}" for i in range(8)]
    states = {t: {p: rng.choice("AAAC") for p in (1, 2)} for t in tips}
    return {t: two_halves(rng, tips, states) for t in range(10)}


@pytest.fixture(scope="module")
def graph(spark, trees):
    e = spark.createDataFrame([(t, v, p, m) for t, rows in trees.items() for v, p, m in rows], SCHEMA)
    g = histories.history_graph(e).persist()
    yield g
    g.unpersist()


def test_merged_graph_equals_brute_force(graph, trees):
    want = brute_graph(trees)
    rows = graph.collect()
    assert Counter((r.weight, r.n_trees) for r in rows) == Counter(want.values())
    assert len({r.node for r in rows}) == len({k[0] for k in want})
    assert sum(r.n_trees for r in rows) == sum(len(rows) for rows in trees.values())


def test_counts_and_least_score_equal_brute_force(spark, graph, trees):
    want = brute_graph(trees)
    all_ = brute_histories(want, "top")
    counts = histories.count_histories(graph)
    assert counts.exact() == len(all_) > 10
    row = counts.nodes.where(F.col("node") == "top").first()
    assert math.isclose(row.log_n, math.log(len(all_)), abs_tol=1e-9)
    least = parsimony.trim(graph.select("node", "clade", "child", "weight"), histories.TOP)
    low = min(c for c, _ in all_)
    assert histories.count_histories(least).exact() == sum(c == low for c, _ in all_)


def test_counts_that_no_long_holds(spark):
    rows = [("top", f"c{i}", f"n{i}_{k}", 0) for i in range(400) for k in range(3 + i % 5)]
    g = spark.createDataFrame(rows, "node string, clade string, child string, weight int")
    assert histories.count_histories(g).exact() == math.prod(3 + i % 5 for i in range(400)) > 1 << 600
    assert histories.count_histories(g.where("false")).exact() == 0


def test_histories_are_drawn_alike(spark, graph, trees):
    want = brute_graph(trees)
    n, all_ = 2000, brute_histories(want, "top")
    counts = histories.count_histories(graph)
    seeds = spark.range(n).withColumnRenamed("id", "seed")
    drawn = histories.sample_histories(graph, counts, seeds).persist()
    rows = drawn.collect()
    per = defaultdict(list)
    for r in rows:
        per[r.seed].append((r.node, r.clade, r.child))
    assert len(per) == n and all(len({(v, c) for v, c, _ in x}) == len(x) for x in per.values())
    seen = Counter(tuple(sorted(x)) for x in per.values())
    assert len(seen) <= len(all_)
    expected = n / len(all_)
    chi = sum((k - expected) ** 2 / expected for k in seen.values()) + expected * (len(all_) - len(seen))
    df = len(all_) - 1
    assert chi < df + 4 * math.sqrt(2 * df), (chi, df)
    cost = Counter(sum(w for w in ws) for ws in _weights(rows).values())
    assert set(cost) <= {c for c, _ in all_}
    again = histories.sample_histories(graph.repartition(3), counts, seeds.where("seed < 20")).collect()
    assert {(r.seed, r.node, r.child) for r in again} == {(r.seed, r.node, r.child) for r in rows if r.seed < 20}
    drawn.unpersist()


def _weights(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.seed].append(r.weight)
    return out


def test_residues():
    ps = histories.primes(5)
    assert ps[0] == 2**31 - 1 and len(set(ps)) == 5
    x = 3**90
    assert histories.from_residues([x % p for p in ps], ps) == x
