"""Variants, the raw audit, and genes with insertions."""

import random

import pytest

from strandline.operators import curate, variants


def test_vcf_document_is_read_back(spark):
    rng = random.Random(4)
    ref = "".join(rng.choice("ACGT") for _ in range(40)) + "N-"
    rows = [("g", 0, "ref", ref, True)] + [("g", i, f"s{i}", "".join(rng.choice("ACGTN-") if rng.random() < 0.15 else c for c in ref), False) for i in range(1, 14)] + [("h", 0, "r", "ACGT", True), ("h", 1, "same", "ACGT", False)]
    msa = spark.createDataFrame(rows, "grp string, ord int, id string, seq string, is_ref boolean")
    doc = variants.vcf_document(msa)
    text = [r.line for r in doc.where("grp = 'g'").orderBy("ord").collect()]
    assert text[0] == "##fileformat=VCFv4.2" and text[3].split("\t")[9:] == [f"s{i}" for i in range(1, 14)]
    for line in text[4:]:
        cells = line.split("\t")
        pos, alts = int(cells[1]), cells[4].split(",")
        want = ["0" if s[pos - 1] in (cells[3], "-") else "." if s[pos - 1] == "N" else str(alts.index(s[pos - 1]) + 1) for _, _, _, s, r in rows[1:14]]
        assert cells[3] == ref[pos - 1] and cells[9:] == want
    assert [r.line.split("\t")[-1] for r in doc.where("grp = 'h'").orderBy("ord").collect()][3:] == ["same"]
    back = sorted((r.id, r.pos, r.ref, r.base) for r in variants.read_vcf(doc).collect())
    assert back == sorted((i, p + 1, a, b) for g, _, i, s, r in rows[1:14] for p, (a, b) in enumerate(zip(ref, s)) if a != b and "-" not in (a, b))


def test_vcf_document_is_the_same_in_small_blocks(spark, monkeypatch):
    rng = random.Random(5)
    seq = lambda: "".join(rng.choice("ACGTN-") for _ in range(rng.randrange(30)))
    rows = [(g, i, f"s{i}", "".join(rng.choice("ACGTN-") for _ in range(21)) if i == 0 else seq(), i == 0) for g in "gh" for i in range(18)]
    doc = variants.vcf_document(spark.createDataFrame(rows, "grp string, ord int, id string, seq string, is_ref boolean"))
    whole = sorted(map(tuple, doc.collect()))
    monkeypatch.setattr(variants, "BLOCK", 4)
    monkeypatch.setattr(variants, "SEGMENT", 5)
    again = variants.vcf_document(spark.createDataFrame(rows, "grp string, ord int, id string, seq string, is_ref boolean"))
    assert sorted(map(tuple, again.collect())) == whole and len(whole) > 30


def test_plans_shuffle_no_sequences(spark):
    rows = [("g", 0, "ref", "ACGT" * 50, True)] + [("g", i, f"s{i}", "ACGA" * 50, False) for i in range(1, 5)]
    msa = spark.createDataFrame(rows, "grp string, ord int, id string, seq string, is_ref boolean")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = variants.variant_sites(msa)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert all("seq" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_raw_audit_needs_every_raw_sequence(spark):
    rows = spark.createDataFrame([("g", "ref", True, "AC-T"), ("g", "a", False, "a-CG"), ("g", "b", False, "TT")], "grp string, id string, is_ref boolean, seq string")
    raw = spark.createDataFrame([("g", "a", "xxACGyy"), ("g", "b", "ACG")], "grp string, id string, raw string")
    assert {r.id: r.found for r in curate.validate_against_raw(rows, raw).collect()} == {"ref": None, "a": True, "b": False}
    with pytest.raises(Exception, match="no raw sequence for b"):
        curate.validate_against_raw(rows, raw.where("id = 'a'")).collect()


@pytest.mark.parametrize(("offset", "start", "end", "at"), [(0, 1, 18, 12), (57, 58, 76, 70)])
def test_codon_insertion_is_put_back(spark, offset, start, end, at):
    curated = spark.createDataFrame([("g", "s", "ATG---CGATCG---TAA", False)], "grp string, id string, masked string, is_ref boolean")
    raw = spark.createDataFrame([("g", "s", "NNNNATGCGATCGAAATAANNNN")], "grp string, id string, raw string")
    genes = spark.createDataFrame([("g", 1, "HA", [(start, end)])], "grp string, gene_idx int, gene_name string, cds array<struct<start:int,end:int>>")
    ins = spark.createDataFrame([("g", "s", [(at, "AAA")])], "grp string, id string, ins array<struct<pos:int,nucs:string>>")
    for legacy in (False, True):
        r = curate.gene_results(curated, genes, raw, ins, offset, legacy=legacy).first()
        assert (r.cds_seq, r.fragments_ok, r.reason) == ("ATGCGATCGAAATAA", True, None)


def test_consensus_of_differences_equals_the_positionwise_vote(spark):
    rng = random.Random(3)
    ref, rows, whole = "ACGTACGTAC", [], []
    for leaf in range(40):
        for tree in rng.sample(range(6), 5):
            seq = "".join(rng.choice("ACGT") if rng.random() < 0.4 else c for c in ref)
            rows.append((f"l{leaf}", tree, [(a, p + 1, b) for p, (a, b) in enumerate(zip(ref, seq)) if a != b]))
            whole.append((f"l{leaf}", tree, seq))
    found = variants.consensus_differences(spark.createDataFrame(rows, "leaf string, tree int, muts array<struct<ref:string,pos:int,alt:string>>"))
    want = {r.leaf: r.consensus for r in variants.consensus(spark.createDataFrame(whole, "leaf string, tree int, seq string")).collect()}
    got = variants.ordered_consensus(found, "l7", ref).orderBy("ord").collect()
    assert {r.leaf: r.seq for r in got} == want
    assert [r.leaf for r in got] == ["l7", *sorted(set(want) - {"l7"})]
    with pytest.raises(Exception, match="l99 is not among"):
        variants.ordered_consensus(found, "l99", ref).collect()
