import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from strandline.operators import curate, relational, samples, variants


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_wins_with_ties_and_null_keys(spark):
    df = spark.createDataFrame([(2, "a", "x"), (1, "a", "y"), (3, None, "p"), (4, None, "q")], "ord int, k string, v string")
    assert sorted(((r.k or "", r.v) for r in relational.first_wins(df, ["k"], ["ord"]).collect())) == [("", "p"), ("a", "y")]
    assert tuple(relational.duplicate_count(df, ["k"]).first()) == (4, 2, 2)


@pytest.mark.parametrize(("days", "want"), [([1, 2, 3], 2), ([1, 2, 3, 4], 3), ([5], 5)])
def test_upper_median(spark, days, want):
    df = spark.createDataFrame([(datetime.date(2020, 1, x),) for x in days] + [(None,)], "d date")
    assert df.agg(relational.upper_median("d")).first()[0] == datetime.date(2020, 1, want)


def test_pinned_order_adds_the_root_once(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "root"), ("h", "c")], "grp string, id string")
    got = relational.pinned_order(df, "id", "root", ["grp"]).orderBy("grp", "ord").collect()
    assert [(r.grp, r.ord, r.id) for r in got] == [("g", 1, "root"), ("g", 2, "a"), ("g", 3, "b"), ("h", 1, "root"), ("h", 2, "c")]


def test_permutations(spark):
    df = spark.createDataFrame([(f"s{i}", i == 3) for i in range(30)], "id string, is_ref boolean")
    got = relational.permute(df, 3, "id", "is_ref").collect()
    orders = [[r.id for r in sorted((r for r in got if r.seed == s), key=lambda r: r.new_ord)] for s in range(3)]
    assert all(o[0] == "s3" and sorted(o) == sorted(f"s{i}" for i in range(30)) for o in orders)
    assert len({tuple(o) for o in orders}) == 3
    again = relational.permute(df.repartition(7), 3, "id", "is_ref").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    with pytest.raises(Exception, match="two rows"):
        relational.permute(df.where("is_ref"), 1, "id", "is_ref").collect()


def test_histogram_edges(spark):
    df = spark.createDataFrame([(70.0,), (100.0,), (69.0,), (None,)], "x double")
    assert rows(relational.histogram(df, "x", 70, 100, 50)) == [(1, 1, pytest.approx(100 / 3)), (50, 1, pytest.approx(100 / 3))]


def test_set_operators(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "k string") for v in (["x", "y"], ["y", "z"]))
    assert rows(relational.same_keys(a, b, "k")) == [("x", "left"), ("z", "right")]
    with pytest.raises(ValueError, match="x"):
        relational.require_complete(a, b, "k")
    u = relational.union_in_order([a.withColumn("ord", F.lit(5)), b.withColumn("ord", F.lit(1))])
    assert [r.k for r in u.orderBy("ord", "k").collect()] == ["x", "y", "y", "z"]


def test_quality_reasons(spark):
    data = [(0, "ref", "ACGTACGTAC", True), (1, "dup", "ACGTACGTAC", False), (2, "gaps", "ACG-ACGTAC", False), (3, "tips", "---TACGTAC", False), (4, "amb", "ACGRACGTAC", False), (5, "ok", "ACGTACGTAA", False)]
    msa = spark.createDataFrame(data, "ord int, id string, seq string, is_ref boolean").withColumn("grp", F.lit("g"))
    judged = curate.quality_reason(curate.measure(msa))
    assert {r.id: r.reason for r in judged.collect()} == {"ref": None, "dup": "failed_duplicate", "gaps": "failed_gap_fraction", "tips": "failed_terminal_gaps", "amb": "failed_ambig_fraction", "ok": None}
    filled = curate.measure(msa, t=curate.Thresholds(replace_gaps_with_ref=True))
    assert {r.id: r.masked for r in filled.collect()}["gaps"] == "ACGTACGTAC"
    stats = curate.quality_stats(judged).first()
    assert stats.total_processed == 6 and stats.passed_quality_filters == 2


def test_missing_raw_sequence_is_an_error(spark):
    cur = spark.createDataFrame([("g", "a", "ATGTAA", False)], "grp string, id string, masked string, is_ref boolean")
    genes = spark.createDataFrame([("g", 1, "M", [(1, 6)])], "grp string, gene_idx int, gene_name string, cds array<struct<start:int,end:int>>")
    ins = spark.createDataFrame([], "grp string, id string, ins array<struct<pos:int,nucs:string>>")
    with pytest.raises(Exception, match="no raw sequence"):
        curate.gene_results(cur, genes, spark.createDataFrame([], "grp string, id string, raw string"), ins, 0).collect()
    raw = spark.createDataFrame([("g", "a", "xxATGTAAxx")], "grp string, id string, raw string")
    got = curate.keep_valid(curate.gene_results(cur, genes, raw, ins, 0)).first()
    assert got.cds_seq == "ATGTAA" and got.row_ok and got.reason is None


def test_consensus_ties_go_to_the_first_tree(spark):
    df = spark.createDataFrame([("a", 1, "AC"), ("a", 2, "GC"), ("a", 3, "TT")], "leaf string, tree int, seq string")
    assert rows(variants.consensus(df)) == [("a", "AC")]


def test_root_sequence(spark):
    one = lambda r: spark.createDataFrame([("g", r)], "grp string, root string")
    ref = spark.createDataFrame([("g", "ref", "ACGT")], "grp string, ref_id string, ref_seq string")
    paths = spark.createDataFrame([("g", 0, "s", "n:A1T")], "grp string, ord int, sample string, path string")
    msa = spark.createDataFrame([("g", "s", "TC-T")], "grp string, id string, seq string")
    assert tuple(variants.root_sequence(ref, paths, msa, one("s")).first()) == ("g", "s", "TCGT", 1)
    assert tuple(variants.root_sequence(ref, paths, msa, one(None)).first()) == ("g", "ref", "ACGT", 0)
    with pytest.raises(Exception, match="disagrees"):
        variants.root_sequence(ref, paths, msa.withColumn("seq", F.lit("GCGT")), one("s")).collect()


def test_metadata_needs_its_columns(spark):
    with pytest.raises(KeyError):
        samples.select_metadata(spark.range(1))
    with pytest.raises(ValueError, match="no valid dates"):
        samples.global_median_date(spark.createDataFrame([("2009",)], "collection_date string"))


def test_numbering_in_ranges(spark):
    rng = random.Random(6)
    rows = [(rng.choice(("a", "a", "a", "b", None)), i) for i in rng.sample(range(10_000), 500)]
    df = spark.createDataFrame(rows, "grp string, x int").repartition(5)
    want = sorted((g, x, 1 + sum(h == g and y < x for h, y in rows), sum(h == g for h, _ in rows)) for g, x in rows if g) + [(None, x, 1 + sum(h is None and y < x for h, y in rows), sum(h is None for h, _ in rows)) for g, x in sorted(rows, key=lambda r: r[1]) if g is None]
    for d in (df, df.repartition(9, "x")):
        got = [tuple(r) for r in relational.numbered(d, ["grp"], ["x"], "ord", "n").orderBy(F.col("grp").asc_nulls_last(), "x").collect()]
        assert got == want
    plain = relational.numbered(df.select("x"), [], [-F.col("x")]).orderBy("ord").collect()
    assert [r.x for r in plain] == sorted((x for _, x in rows), reverse=True) and [r.ord for r in plain] == list(range(1, 501))
    assert relational.numbered(df.where("false"), ["grp"], ["x"]).count() == 0


def test_samples_are_cut_before_the_shuffle(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("grp"), F.col("id").cast("string").alias("id"), (F.col("id") < 2).alias("is_ref")).repartition(4)
    drawn = relational.sample_rows(df, 10, "id", "is_ref", ["grp"])
    assert {(r.grp, r.n) for r in drawn.groupBy("grp").agg(F.count("*").alias("n")).collect()} == {(0, 11), (1, 11)}
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, relational.sample_rows(df.repartition(3), 10, "id", "is_ref", ["grp"]).collect()))
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("WindowGroupLimit") :]


def test_points_in_intervals(spark):
    rng = random.Random(2)
    points = [(rng.randrange(3), rng.randrange(-50, 900)) for _ in range(300)]
    spans = [(rng.randrange(3), k, a := rng.randrange(-50, 900), a + rng.randrange(-3, 400)) for k in range(60)]
    got = relational.interval_join(spark.createDataFrame(points, "grp int, pos int"), spark.createDataFrame(spans, "grp int, k int, start int, end int"), ["grp"], width=64)
    assert sorted((r.grp, r.pos, r.k) for r in got.collect()) == sorted((g, x, k) for g, x in points for h, k, a, b in spans if g == h and a <= x < b)


def test_exact_medians(spark):
    rng = random.Random(13)
    groups = {
        "even": [rng.random() for _ in range(500)], "odd": [rng.gauss(0, 1e6) for _ in range(301)], "one": [4.25], "hot": [1.5] * 400 + [rng.random() for _ in range(99)], "wide": [rng.choice((-1, 1)) * 10.0 ** rng.randrange(-300, 300) for _ in range(400)],
        "two": [1.0, 2.0], None: [3.0, 1.0, 2.0, 10.0], "far": [-1.7e308, 1.7e308, 0.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("even", None), ("odd", float("nan")), ("nothing", None)]
    rng.shuffle(rows)
    got = {r.grp: r.median for r in relational.interpolated_median(spark.createDataFrame(rows, "grp string, v double"), ["grp"], "v").collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        assert got[g] == pytest.approx(statistics.median(vs), rel=1e-12), g
    plain = relational.interpolated_median(spark.createDataFrame([(v,) for v in groups["even"]], "v double"), [], "v").first()
    assert plain.median == pytest.approx(statistics.median(groups["even"]))
