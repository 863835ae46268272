"""Centroid clustering, line deduplication and conversation repair against brute force, with nulls, ties, repeats and long texts."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import linededup, lloyd, queries, turns

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", ["op11_centroids", "op12_line_dedup", "op13_turn_repair"])
def test_queries_give_the_rows_of_their_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.queries()[name](spark, str(DATA))
    result = duck.execute(queries.oracle_sql()[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(str(r[c]) for c in names) for r in df.collect()) == sorted(tuple(map(str, r)) for r in result.fetchall())


# --- centroids ---------------------------------------------------------------------------------------------------


def brute_lloyd(rows, p):
    kept = [(i, [math.floor(x * p.scale) for x in v]) for i, v in rows if v is not None and len(v) == p.dimensions and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-lloyd.LIMIT, min(lloyd.LIMIT, x)) for x in v]) for i, v in kept]
    name = lambda i: hashlib.sha256(f"{p.seed}:{'' if i is None else i}".encode()).hexdigest()
    at = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[: p.centroids]]
    far = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(at))
    for _ in range(p.rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[far(v)[1]].append(v)
        for k, vs in groups.items():
            at[k] = [sum(x) // len(vs) for x in zip(*vs)]
    return sorted((str(i), far(v)[1], far(v)[0]) for i, v in kept), at


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(5)
    p = lloyd.LloydParams(centroids=6, dimensions=4, rounds=4)
    rows = [(i, [rng.choice((-1, 0, 2)) + rng.random() for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)] + [rows[3], rows[3], (None, [0.0] * 4), (None, [1.0] * 4)]  # a hot vector, repeats, null ids
    rows += [(200, None), (201, []), (202, [1.0] * 3), (203, [1.0, None, 1.0, 1.0]), (204, [1.0, math.nan, 1.0, 1.0]), (205, [math.inf, 0.0, 0.0, 0.0])]
    return p, rows + [(206, [1e30, -1e300, 0.0, 0.0]), ((1 << 60) + 1, [0.001, -0.001, 1 / 256, -1 / 256])]


def test_clustering_equals_brute_force(spark, vectors):
    p, rows = vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "vec", "cluster", "distance")}).repartition(5)
    found = lloyd.cluster(df, p)
    want, at = brute_lloyd(rows, p)
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.assigned.collect()) == want
    table = {r.cluster: r for r in found.centroids.collect()}
    assert [table[k].centroid for k in range(len(at))] == at
    sums = Counter()
    for _, c, d in want:
        sums[c] += d
    assert all(table[c].cluster_inertia == sums[c] and table[c].inertia == sum(sums.values()) for c in sums)


def test_clustering_of_few_and_of_no_vectors(spark, vectors):
    p, rows = vectors
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert sorted(r.distance for r in lloyd.cluster(few, p).assigned.collect()) == [0, 0, 0]
    none = lloyd.cluster(few.where("false"), p)
    assert none.assigned.count() == 0 and none.centroids.count() == 0


def test_nearest_takes_the_lowest_number_of_equal_ones():
    to, far = lloyd.nearest(np.array([[0, 0], [5, 5]], np.int64), np.array([[1, 0], [-1, 0], [0, 1], [5, 4], [5, 6]], np.int64))
    assert to.tolist() == [0, 3] and far.tolist() == [1, 1]


# --- lines -------------------------------------------------------------------------------------------------------

ASCII_LOW = {c: c + 32 for c in range(65, 91)}


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOW)


def brute_lines(rows, p):
    rank = lambda i: (i is not None, i or 0)
    docs, last = Counter(), {}
    for i, text in rows:
        for k in {line_key(x) for x in (text or "").split("\n")}:
            if len(k) >= p.min_chars:
                docs[k] += 1
                last[k] = max(last.get(k, (False, 0)), rank(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if docs[line_key(x)] < p.min_docs or last[line_key(x)] == rank(i)]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    common = [f"A line that many documents hold, number {k}" for k in range(12)] + ["É" * 20, "é" * 20, "short", "x" * 19, "y" * 20, "  Y" + "y" * 18 + "Y\r"]
    rows = [(i, "\n".join(rng.choice(("", "  ", "\t")) + rng.choice(common) + rng.choice(("", " \x0b", "\r")) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    rows += [(i, rng.choice(common).swapcase() + "\n\n" + f"only here and nowhere else {i}") for i in range(60, 90)]
    rows += [(None, common[0] + "\n" + common[1]), (None, common[0]), (90, None), (91, ""), (92, "\n"), (93, "\n\n" + common[2] + "\n"), rows[4], rows[4], (7, common[3] + "\n" + common[3])]
    return rows + [(5000, "\n".join(common[k % 12] if k % 3 else f"line {k} of a very long text" for k in range(30_000)))]


@pytest.mark.parametrize("p", [linededup.LineParams(), linededup.LineParams(batches=5, fanout=2), linededup.LineParams(min_docs=2, batches=1), linededup.LineParams(min_docs=40, batches=7, fanout=3)])
def test_lines_equal_brute_force(spark, texts, p):
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("h1", "h2", "pos", "n", "last", "_doc", "_text", "kept", "n_lines")})
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in linededup.dedup_lines(df, p).collect())
    assert got == brute_lines(texts, p)


def test_lines_of_an_empty_table(spark, texts):
    assert linededup.dedup_lines(spark.createDataFrame(texts[:1], "doc_id long, text string").where("false")).count() == 0


def test_runs_are_compacted_and_known_lines_add_nothing(spark):
    p = linededup.LineParams(fanout=3)
    runs = linededup.LineRuns(p)
    shape = []
    for b in range(10):  # later batches hold smaller ids; line 0 is in all of them
        runs.add(spark.createDataFrame([(0, 0, 50, 100 - b), (b + 1, 0, 1, 100 - b)], "h1 long, h2 long, n long, last long"))
        shape.append([len(level) for level in runs.levels])
    assert shape[:4] == [[1], [2], [0, 1], [1, 1]] and shape[8] == [0, 0, 1] and shape[9] == [1, 0, 1]
    rows = [r for run in runs.runs() for r in run.collect()]
    assert [r.n for r in rows if r.h1 == 0] == [50] and len(rows) == 11
    assert [tuple(r) for r in runs.frequent().collect()] == [(0, 0, 100)]
    runs.add(spark.createDataFrame([(0, 0, 1, 500)], "h1 long, h2 long, n long, last long"))  # a larger id is kept
    assert [tuple(r) for r in runs.frequent().collect()] == [(0, 0, 500)]


def test_folding_tells_all_but_the_case_of_a_to_z(spark):
    rng = random.Random(2)
    letters = [chr(c) for c in (65, 97, 90, 122, 64, 91, 0xC0, 0xE0, 0xC9, 0xE9, 0xD0, 0xF0, 0xD7, 0xF7, 0xDF, 0x130, 0x131, 0x3A3, 0x3C2, 0x41F, 0x43F, 0x1E9E, 0x2160, 0x2170, 0x3042, 0xFF21, 0xFF41, 0x10400, 0x10428, 0x1F600)]
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 4))) for _ in range(3000)})
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", linededup.folded(F.col("w")).alias("k")).collect()
    keys = {r.k: r.w.translate(ASCII_LOW) for r in got}
    assert all(keys[r.k] == r.w.translate(ASCII_LOW) for r in got) and len(keys) == len({w.translate(ASCII_LOW) for w in words})


# --- turns -------------------------------------------------------------------------------------------------------


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def brute_repair(rows):
    """(cost, audit, repaired) by trying all edits, shortest path first."""
    fault = faults_of(rows)
    need = lambda s: "assistant" if s == 2 else "user"
    step = lambda s, x: 1 if s == 0 and x == "s" else 2 if s != 2 and x == "u" else 3 if s == 2 and x == "a" else None
    limit = 4 * len(rows)
    found = []

    def go(i, s, cost, audit, kept, inserts):
        if cost > limit:
            return
        if i == len(rows) and s in (0, 3):
            found.append((cost, audit, kept))
        if inserts < 3:
            go(i, step(s, need(s)[0]), cost + 3, audit + "I", kept + [need(s) + ":"], inserts + 1)
        if i < len(rows):
            role, text = rows[i]
            more = 3 if fault[i] == 3 else 0
            go(i + 1, s, cost + 4, audit + "D", kept, 0)
            if fault[i] in (0, 3):
                if step(s, role[:1]) is not None:
                    go(i + 1, step(s, role[:1]), cost + more, audit + "K", kept + [f"{role}:{text}"], 0)
                for to in ("user", "assistant"):
                    if step(s, to[0]) is not None:
                        go(i + 1, step(s, to[0]), cost + 3 + more, audit + "R", kept + [f"{to}:{text}"], 0)

    go(0, 0, 0, "", [], 0)
    return min(found, key=lambda f: (f[0], f[1]))


TEXTS = ["Good.", "Why?", "cut short", "", " \t", "Yes! \n", "é", "ok."]


@pytest.fixture(scope="module")
def chats():
    rng = random.Random(4)
    out = []
    for conv in range(150):
        for turn in range(rng.randrange(0, 6)):
            out.append((conv, turn if rng.random() < 0.9 else None, rng.choice(("user", "assistant", "system", "user", "assistant", "tool", "User", "", None)), rng.choice([*TEXTS, f"Number {turn}.", None])))
    out += [(None, 0, "user", "Hi."), (None, 5, "assistant", "Ho."), (500, 0, "user", "A."), (500, 1, "assistant", "B."), (500, 1, "assistant", "B."), (501, 3, "system", "Only this.")]
    return out


def ordered(spark, rows):
    """Conversations in repair's order: turn, nulls first, then role and the text's hashes."""
    df = spark.createDataFrame(rows, "c long, t long, r string, x string").select("c", "t", F.coalesce("r", F.lit(" ")).alias("r"), F.coalesce("x", F.lit(" ")).alias("x"))
    out = defaultdict(list)
    for r in df.orderBy("c", "t", "r", F.xxhash64("x"), F.xxhash64(F.lit(1), "x")).collect():
        out[r.c].append((r.t, r.r, r.x))
    return out


def test_repair_equals_brute_force(spark, chats):
    more = [(9000, None, None, None), (9001, 1, "user", "x")]
    df = spark.createDataFrame(chats, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("_conv", "_turn", "seq", "summary", "edit", "_code")}).repartition(4)
    everyone = spark.createDataFrame(chats + more, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in turns.digest(turns.repair(df, everyone)).collect()}
    want = ordered(spark, chats)
    assert set(got) == set(want) | {9000, 9001}
    empty = hashlib.sha256(b"").hexdigest()
    for c in (9000, 9001):
        assert tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    for c, rows in want.items():
        fault = Counter(faults_of([x[1:] for x in rows]))
        cost, audit, kept = brute_repair([x[1:] for x in rows])
        numbers = [t for t, _, _ in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        assert tuple(got[c]) == (c, gaps, fault[1], fault[2], fault[3], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()), rows


def test_repaired_rows_follow_the_grammar_and_long_conversations_stream(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(("user", "assistant", "tool")), f"Turn {t}{rng.choice('.?x')}") for t in range(50_000)] + [(2, 0, "assistant", "y" * 5_000_000 + ".")]
    fixed = turns.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    done = defaultdict(list)
    for r in fixed.where("seq >= 0").select("conv_id", "seq", "edit", "role", F.length("text").alias("n")).orderBy("conv_id", "seq").collect():
        done[r.conv_id].append(r)
    for c, edits in done.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in edits if r.edit != "D")), c
    assert sum(r.edit != "I" for r in done[1]) == 50_000
    assert [(r.edit, r.role, r.n) for r in done[2]] in ([("D", None, None)], [("I", "user", 0), ("K", "assistant", 5_000_001)])
    assert fixed.where("seq < 0").count() == 2


def test_damage_follows_the_checksum(spark, chats):
    rows = spark.createDataFrame(chats, "conv_id long, turn long, role string, text string")
    want = Counter()
    for c, t, role, text in chats:
        z = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if z == 1 else re.sub("[.!?]", "", text) if z == 2 else text
        want[c, t, "user" if z == 4 else role, text] += 0 if z == 0 else 2 if z == 3 else 1
    assert Counter(tuple(r) for r in queries.damaged(rows).collect()) == +want


def test_repair_of_an_empty_table(spark, chats):
    assert turns.digest(turns.repair(spark.createDataFrame(chats[:1], "conv_id long, turn long, role string, text string").where("false"))).count() == 0
