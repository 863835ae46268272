"""Literal vectors for the sequence and metadata expressions."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.functions import metadata as M
from strandline.functions import sequence as S


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


L = F.lit
INS = lambda *x: F.array(*[F.struct(L(p).alias("pos"), L(n).alias("nucs")) for p, n in x]) if x else F.array().cast(S.INSERTIONS)

def cases():
    return [
        (S.slice_seq(L("ACGTACGTACGT"), 3, 8), "GTACGT"),
        (S.slice_seq(L("ACGTACGTACGT"), 3, 3), "G"),
        (S.sanitize_id(L("A/H1N1[2023]:variant.1")), "A/H1N12023variant1"),
        (S.n_gaps(L("ACGT--ACGT")), 2),
        (S.n_ambiguous(L("ACGT--NNNACGT")), 3),
        (S.n_ambiguous(L("acgt")), 4),
        (S.fraction(S.n_gaps(L("ACGT--ACGT")), L("ACGT--ACGT")), 0.2),
        (S.fraction(S.n_gaps(L("")), L("")), None),
        (S.terminal_gaps(L("---ACGT")), True),
        (S.terminal_gaps(L("ACGT---")), True),
        (S.terminal_gaps(L("ACG---ACG")), False),
        (S.mask(L("ACGTRYWACGT")), "ACGTNNNACGT"),
        (S.fill_gaps(L("ACGT--GT"), L("ACGTACGT")), "ACGTACGT"),
        (S.insert(L("ACGTACGT"), INS((6, "TTT"), (3, "AAA"))), "ACGAAATACTTTGT"),
        (S.insert(L("ACGT"), INS((0, "GG"))), "GGACGT"),
        (S.insert(L("ACGTACGT"), INS((8, "TT"))), "ACGTACGTTT"),
        (S.degap(S.insert(L("ACTC------ATTGC"), INS((11, "GGG")))), "ACTCAGGGTTGC"),
        (S.cds_failure(L("ATGCGATCGTAA")), None),
        (S.cds_failure(L("atgcgatcgtag")), None),
        (S.cds_failure(L("ATGCGATCGTAAA")), "wrong_length"),
        (S.cds_failure(L("ATG")), "too_short"),
        (S.cds_failure(L("")), "too_short"),
        (S.cds_failure(L("CTGCGATCGTAA")), "missing_start_codon"),
        (S.cds_failure(L("ATGCGATCGTAC")), "missing_stop_codon"),
        (S.attribute_value(L("ID=a;Name=b"), "Name"), "b"),
        (S.attribute_value(L("gene_ID=a"), "ID"), "a"),
        (S.attribute_value(L("ID=a"), "Name"), None),
        (S.ha_na(L("A_/_H5N1"), 1), "H5"),
        (S.ha_na(L("H1N1pdm"), 2), "N1"),
        (S.ha_na(L("mixed"), 1), None),
        (S.group_key(L("PB2"), L("mixed")), "all"),
        (S.apply_mutations(L("ACGT"), S.parse_path(L("n1:A1T,C2G n2:T1C n3:"))), "CGGT"),
        (S.mutation_warnings(L("ACGT"), S.parse_path(L("n1:A1T n2:A1C"))), 1),
        (S.identity_pct(L("AC-T"), L("AG-T")), 75.0),
        (M.geographic_group(L("\t Europe / France")), "europe"),
        (M.geographic_group(L("South America / Peru")), "other"),
        (M.geographic_group(L("")), "other"),
        (M.geographic_group(L(None).cast("string")), "other"),
        (M.parse_date(L(" 2009-3-1 ")), datetime.date(2009, 3, 1)),
        (M.parse_date(L("2009")), None),
        (M.parse_date(L("2009-02-30")), None),
        (M.iso_or_na(M.parse_date(L("x"))), "N/A"),
        (M.strip_type_prefix(L("A / H5N1")), "H5N1"),
        (M.strip_type_prefix(L("H5N1")), "H5N1"),
        (M.magnitude(L("1" + "0" * 70)), 70),
    ]


def test_vectors(spark):
    all_ = cases()
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(all_)]).first()
    assert [row[i] for i in range(len(all_))] == [w for _, w in all_]


def test_parse_insertions(spark):
    assert [tuple(x) for x in value(spark, S.parse_insertions(L("3:AAA, 6:TTT,,")))] == [(6, "TTT"), (3, "AAA")]
    assert value(spark, S.parse_insertions(L(None).cast("string"))) == []
    for bad in ("3:A:C", "x:A"):
        with pytest.raises(Exception):  # noqa: B017
            value(spark, S.parse_insertions(L(bad)))


def test_insertion_window(spark):
    ins = INS((500, "D"), (499, "C"), (100, "B"), (99, "A"))
    legacy = value(spark, S.insertions_in_cds(ins, L(100), L(500), 99, legacy=True))
    assert [tuple(x) for x in legacy] == [(400, "C"), (1, "B")]
    fragment = value(spark, S.insertions_in_cds(INS((120, "A")), L(110), L(500), 99))
    assert [tuple(x) for x in fragment] == [(11, "A")]


def test_insertions_of_a_later_fragment(spark):
    """In fragment coordinates an insertion lands behind its base; in the legacy ones it is misplaced."""
    cds = F.array(F.struct(L(1).alias("start"), L(3).alias("end")), F.struct(L(7).alias("start"), L(12).alias("end")))
    ins = INS((9, "TT"))
    assert value(spark, S.gene_fragments(L("ATGCCCAAACCC"), cds, ins, 0)) == ["ATG", "AAATTCCC"]
    assert value(spark, S.gene_fragments(L("ATGCCCAAACCC"), cds, ins, 0, legacy=True)) == ["ATG", "AAACCCTT"]


@pytest.mark.parametrize(
    ("host", "group"),
    [
        (None, "other"), ("Environment", "other"), ("Laboratory derived", "other"), ("HUMAN", "human"), ("pig", "swine"), ("Sus scrofa domesticus", "swine"), ("Horse", "other"),
        ("Dairy cow", "bovine"), ("canis lupus", "other"), ("Felis catus", "other"), ("walrus", "other"), ("bat", "other"), ("Mallard duck", "avian"), ("great tit", "avian"),
        ("Gallus gallus", "avian"), ("cattle egret", M.UNRECOGNIZED), ("", M.UNRECOGNIZED),
    ],
)
def test_hosts(spark, host, group):
    assert value(spark, M.host_group(L(host).cast("string"), strict=False)) == group


def test_strict_host(spark):
    with pytest.raises(Exception, match="unrecognized host"):
        value(spark, M.host_group(L("dragon")))


def test_root_check(spark):
    assert tuple(value(spark, S.root_check(L("AC-T"), L("ACGT")))) == (True, 1, 0, 0)
    assert tuple(value(spark, S.root_check(L("AC-T"), L("AGNTA")))) == (False, 1, 1, 2 - 1 + 0)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text("ACGT-N[]:.x", max_size=30))
def test_properties(spark, text):
    row = spark.range(1).select(S.sanitize_id(L(text)).alias("a"), S.sanitize_id(S.sanitize_id(L(text))).alias("b"), S.mask(L(text)).alias("m"), S.mask(S.mask(L(text))).alias("n")).first()
    assert row.a == row.b and row.m == row.n and len(row.m) == len(text)
