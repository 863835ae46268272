import gzip
import lzma
import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import curate
from strandline.sources import fasta
from strandline.sources import tables as T

TEXT = ">EPI1|HA|n|EPI_ISL_1|H1N1\nACGT\nAC\n>b with more\n\nGG\n>empty\n"


@pytest.mark.parametrize(("name", "opener"), [("a.fasta", open), ("a.fasta.gz", gzip.open), ("a.fasta.xz", lzma.open)])
def test_read_fasta(spark, tmp_path, name, opener):
    with opener(tmp_path / name, "wt") as f:
        f.write(TEXT)
    got = [(r.id, r.description, r.seq) for r in T.read_fasta(spark, str(tmp_path / name)).orderBy("ord").collect()]
    assert got == [("EPI1|HA|n|EPI_ISL_1|H1N1", "EPI1|HA|n|EPI_ISL_1|H1N1", "ACGTAC"), ("b", "b with more", "GG"), ("empty", "empty", "")]
    assert T.first_record(T.read_fasta(spark, str(tmp_path))).first().id == "EPI1|HA|n|EPI_ISL_1|H1N1"


@pytest.mark.parametrize("packed", ["none", "xz", "gzip"])
def test_fasta_round_trip(spark, tmp_path, packed):
    df = spark.createDataFrame([(i, f"s{i}", "ACGT" * i) for i in range(40)], "ord int, id string, seq string")
    T.write_fasta(df, str(tmp_path / "out"), packed, single=True)
    back = T.read_fasta(spark, str(tmp_path / "out")).orderBy("ord").collect()
    assert [(r.id, r.seq) for r in back] == [(f"s{i}", "ACGT" * i) for i in range(40)]
    with pytest.raises(Exception):  # noqa: B017
        T.read_fasta(spark, str(tmp_path / "none")).collect()


def test_records_without_header():
    assert list(fasta.records([b"ACGT\n"])) == [] and list(fasta.records([])) == []


def whole(data):
    """(offset, id, description, sequence) of all records of a text, line by line."""
    out, at = [], 0
    for line in data.splitlines(keepends=True):
        if line.startswith(b">"):
            head = line[1:].decode().rstrip("\r\n")
            out.append([at, (head.split(None, 1) or [""])[0], head, ""])
        elif out:
            out[-1][3] += "".join(line.decode().split())
        at += len(line)
    return [tuple(r) for r in out]


@pytest.mark.parametrize("seed", range(6))
def test_any_split_gives_the_same_records(seed):
    rng = random.Random(seed)
    pieces = [">", ">a", "\n", "\r\n", "ACGT", ">b c\n", "\n>d\n", "x>y", " ", "N" * 50, "\n\n"]
    data = ("" if seed % 2 else ">first\nA") + "".join(rng.choice(pieces) for _ in range(120))
    data = data.encode()
    for n in (1, 2, 3, 7, 64, len(data) + 1):
        cuts = list(range(0, len(data), n)) or [0]
        got = []
        for a, b in zip(cuts, [*cuts[1:], None]):
            chunks = (data[i : i + rng.randrange(1, 9)] for i in [a])  # the first chunk may be short
            head = next(chunks)
            got += fasta.records([head, data[a + len(head) :]], a, b)
        assert got == whole(data), n


@pytest.mark.parametrize("packed", ["none", "xz", "gzip"])
def test_splits_of_a_file(spark, tmp_path, packed):
    rng = random.Random(1)
    parts = ["".join(f">r{k}_{i} some text\n{''.join(rng.choice('ACGT') for _ in range(rng.randrange(0, 3000)))}\n" for i in range(60)).encode() for k in range(12)]
    data = b"".join(parts)
    cut = [data[a : a + 40_000] for a in range(0, len(data), 40_000)]  # blocks end inside records
    name = tmp_path / f"a.fasta{ {'none': '', 'xz': '.xz', 'gzip': '.gz'}[packed] }"
    name.write_bytes(data if packed == "none" else gzip.compress(data) if packed == "gzip" else b"".join(lzma.compress(c) + (b"\0" * 4 if i % 3 == 0 else b"") for i, c in enumerate(cut)))
    read = lambda n: T.read_fasta(spark, f"file://{name}", split_bytes=str(n))
    few, many = read(1 << 30), read(100_000)
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == (1 if packed == "gzip" else -(-len(data) // 100_000) if packed == "none" else -(-len(cut) // 3))
    rows = lambda df: sorted((r.ord, r.id, r.description, r.seq) for r in df.collect())
    assert rows(few) == rows(many) == whole(data)


def test_a_large_file_is_read_in_many_tasks(tmp_path):
    line = b"ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACG\n" * 4000
    with open(tmp_path / "big.fasta", "wb") as f:
        for i in range(4400):
            f.write(b">s%d\n" % i + line)
    parts = fasta.ranges(str(tmp_path / "big.fasta"), 0, "none", fasta.SPLIT_BYTES)
    assert f"{(tmp_path / 'big.fasta').stat().st_size / 1e9:.1f}" == "1.1" and len(parts) == 8
    ids = [name for part in parts for _, name, _, _ in fasta.records(part.chunks(), part.start, part.end)]
    (tmp_path / "big.fasta").unlink()
    assert ids == [f"s{i}" for i in range(4400)]


def test_grouped_files_are_seen_when_committed(spark, tmp_path):
    rows = [(i, f"s{i}", "ACGT" * (i % 5), "HA" if i % 3 else "N/A", i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "ord int, id string, seq string, segment string, grp int").repartition(3)
    out = str(tmp_path / "g")
    T.write_fasta(df, out, "gzip", by=["segment", "grp"])
    back = T.read_fasta(spark, out).select(T.folder_value("segment"), T.folder_value("grp"), "id", "seq").collect()
    assert sorted(map(tuple, back)) == sorted((g, str(k), i, s) for _, i, s, g, k in rows)
    assert len(fasta.list_files(out)) <= 3 * 8
    bad = df.withColumn("seq", F.when(F.col("ord") == 150, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("seq")))
    with pytest.raises(Exception, match="broken"):
        T.write_fasta(bad, out, "gzip", by=["segment", "grp"])
    assert T.read_fasta(spark, out).count() == 200
    T.write_fasta(df.limit(5), out, by=["segment", "grp"], mode="overwrite")
    assert T.read_fasta(spark, out).count() == 5


def test_gff_and_gene_model(spark, tmp_path):
    lines = ["#c", "s\tx\tgene\t11\t40\t.\t+\t.\tID=g", "s\tx\tCDS\t31\t40\t.\t+\t0\tgene=M2;protein_id=P", "s\tx\tCDS\t11\t20\t.\t+\t0\tgene=M2;protein_id=P", "s\tx\tmRNA\t1\t2\t.\t+\t.\tx", "short\tline"]
    (tmp_path / "a.gff").write_text("\n".join(lines))
    feats = T.require_features(T.read_gff(spark, str(tmp_path / "a.gff")))
    assert [(r.type, r.start, r.end, r.name) for r in feats.orderBy("ord").collect()] == [("gene", 11, 40, "g"), ("CDS", 31, 40, "CDS_feature"), ("CDS", 11, 20, "CDS_feature")]
    assert tuple(curate.feature_span(feats, []).first()) == (11, 40)
    gene = curate.gene_model(feats, []).first()
    assert gene.gene_name == "M2" and gene.protein_id == "P" and [tuple(c) for c in gene.cds] == [(11, 20), (31, 40)]
    gff = [r.line for r in curate.shifted_gff(feats, 11).orderBy("ord").collect()]
    assert gff[:3] == ["##gff-version 3", "##sequence-region Reference 1 30", "Reference\tCurated\tgene\t1\t30\t.\t+\t.\tID=g"]
    gtf = [r.line for r in curate.shifted_gtf(feats, 11).orderBy("ord").collect()]
    assert gtf[0].endswith('gene_id "g"; transcript_id "g_transcript"; gene_name "g";')
    with pytest.raises(ValueError):
        T.require_features(feats.where("false"))


def test_insertions_and_paths(spark, tmp_path):
    text = "seqName\tx\tinsertions\na.1\t0\t3:AA,9:C\nb\t0\t\na1\t0\t5:G\n"
    (tmp_path / "i.tsv").write_text(text)
    with lzma.open(tmp_path / "i.tsv.xz", "wt") as f:
        f.write(text)
    for name in ("i.tsv", "i.tsv.xz"):
        got = T.read_insertions(spark, str(tmp_path / name)).collect()
        assert [(r.id, [tuple(x) for x in r.ins]) for r in got] == [("a1", [(5, "G")])]
    (tmp_path / "p.txt").write_text("s1\tn:A1T\nempty\t\ns2\tn:C2G n2:\n")
    assert sorted(r["sample"] for r in T.read_paths(spark, str(tmp_path / "p.txt")).collect()) == ["s1", "s2"]


def test_metadata_csv_and_logs(spark, tmp_path):
    (tmp_path / "m.csv").write_text("isolate_id,host\na,NA\nb,Human\nc,\n")
    assert {r.isolate_id: r.host for r in T.read_metadata(spark, str(tmp_path / "m.csv")).collect()} == {"a": None, "b": "Human", "c": None}
    folder = tmp_path / "logs" / "HA" / "H1" / "randomized_2"
    folder.mkdir(parents=True)
    (folder / "t.log").write_text("Min parsimony score in DAG: 5")
    got = T.read_logs(spark, str(tmp_path / "logs/*/*/*/*.log")).first()
    assert (got.segment, got.grp, got.randomized) == ("HA", "H1", 2)


def test_complete_dirs(tmp_path):
    for name, files in (("a", ["x.fasta", "m.xls"]), ("b", ["x.fasta"]), ("c", [])):
        (tmp_path / name).mkdir()
        for f in files:
            (tmp_path / name / f).write_text("")
    assert T.complete_dirs([str(tmp_path / n) for n in "abcd"]) == [str(tmp_path / "a")]


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "ord int, line string")
    T.write_lines(df, str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["a", "b"]
    T.write_groups(df.withColumn("segment", F.lit("HA")).withColumn("grp", F.lit("H1")), str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g")).where("segment = 'HA' and grp = 'H1'").count() == 2
    T.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    assert '"reference":"r.fasta"' in T.aligner_config(spark, "/x/r.fasta", "/x/r.gff").first().json
