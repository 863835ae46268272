"""Variants of alignments, root sequences and consensus over several trees."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..plans.scratch import materialize
from .relational import numbered


#: References up to so many characters together are broadcast.
REFERENCE_CHARS = 64 << 20
#: So many samples and positions are turned into columns at once.
BLOCK, SEGMENT = 1024, 2048
#: Stands for the one empty character of an empty sequence.
EMPTY = "!"


def with_reference(rows: DataFrame, ref: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """rows with their group's reference: broadcast, so that no sequence is shuffled, where all of them are small; else joined."""
    ref = materialize(ref, "references")
    size = ref.agg(F.coalesce(F.sum(F.length(column)), F.lit(0))).first()[0]
    return rows.join(F.broadcast(ref) if size <= REFERENCE_CHARS else ref, list(by))


def differences(rows: DataFrame, keep: Sequence[str], seq: str = "seq", ref: str = "_ref") -> DataFrame:
    """(keep, pos from 1, ref, alt): a row for each position at which two sequences differ and neither has a gap.

    Positions are exploded and filtered within one generated stage, before
    anything is shuffled.
    """
    pairs = F.arrays_zip(F.split(seq, "").alias("alt"), F.split(ref, "").alias("ref"))
    each = rows.select(*keep, F.posexplode(pairs).alias("_p", "_v")).where("_v.alt <> _v.ref and _v.alt <> '-' and _v.ref <> '-'")
    return each.select(*keep, (F.col("_p") + 1).alias("pos"), F.col("_v.ref").alias("ref"), F.col("_v.alt").alias("alt"))


def variant_sites(msa: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """(by, pos, ref, alts, n_alt, n_missing): sites at which any row differs from its group's reference.

    msa: by, id, seq, is_ref.  Ambiguous characters are N and count as missing;
    sites with nothing but N stay.  Only positions that differ are counted, before
    the shuffle, which therefore grows with the variation, not with the
    alignment; sequences stay where they are.
    """
    rows = msa.select(*by, "is_ref", S.mask("seq").alias("seq"))
    ref = rows.where("is_ref").select(*by, F.col("seq").alias("_ref"))
    each = differences(with_reference(rows.where(~F.col("is_ref")), ref, by, "_ref"), by)
    votes = each.groupBy(*by, "pos", "ref", "alt").agg(F.count("*").alias("n"))
    alts = F.array_join(F.sort_array(F.collect_set(F.when(F.col("alt") != "N", F.col("alt")))), ",")
    return votes.groupBy(*by, "pos", "ref").agg(alts.alias("alts"), F.coalesce(F.sum(F.when(F.col("alt") != "N", F.col("n"))), F.lit(0)).alias("n_alt"), F.coalesce(F.sum(F.when(F.col("alt") == "N", F.col("n"))), F.lit(0)).alias("n_missing"))


def vcf_lines(sites: DataFrame, chrom: str = "Reference") -> DataFrame:
    """(pos, line): VCF body text of variant sites."""
    alt = F.when(F.col("alts") == "", ".").otherwise(F.col("alts"))
    return sites.select("pos", F.concat_ws("\t", F.lit(chrom), F.col("pos").cast("string"), F.concat("ref", F.col("pos").cast("string"), alt), "ref", alt, F.lit("."), F.lit("."), F.lit(".")).alias("line"))


def call_blocks(msa: DataFrame, samples: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, pos, ref, n, block, alts, calls): where rows of a block of samples differ from their group's reference.

    samples: by, ord, sample from 1, n (of the group).  calls has a character
    for each of BLOCK samples in order: the base that differs, a dot for N, else
    0; alts are its bases.  An empty sequence has one empty character, EMPTY.
    Sequences are cut behind their reference's end, go to the shuffle as text, in
    segments, and each block of them is turned into columns at once, so that no
    row stands for a single call.
    """
    shown = lambda text: F.when(F.length(text) == 0, EMPTY).otherwise(text)
    ref = msa.where("is_ref").select(*by, shown(S.mask("seq")).alias("_ref")).join(samples.groupBy(*by).agg(F.first("n").alias("n")), list(by))
    ref = materialize(ref, "references")
    size = F.broadcast(ref.select(*by, F.length("_ref").alias("_len")))  # a row per group
    rows = msa.where(~F.col("is_ref")).join(size, list(by)).select(*by, "ord", shown(S.mask(F.left("seq", F.col("_len")))).alias("_text"))
    # Merged at every size, as the numbers of many samples are no small side.
    rows = rows.where("_text is not null").join(samples.hint("merge"), [*by, "ord"])
    cut = lambda df, *cols: df.select(*by, *cols, "n", "_text", F.explode(F.sequence(F.lit(0), F.expr(f"int((length(_text) - 1) div {SEGMENT})"))).alias("_seg")).withColumn("_text", F.substr("_text", F.col("_seg") * SEGMENT + 1, F.lit(SEGMENT)))
    pieces = cut(rows, F.expr(f"int((sample - 1) div {BLOCK})").alias("block"), F.expr(f"int((sample - 1) % {BLOCK})").alias("_at"))
    # Every block gets the reference.
    every = ref.withColumnRenamed("_ref", "_text").withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"int((n - 1) div {BLOCK})"))))
    pieces = pieces.unionByName(cut(every, "block", F.lit(-1).alias("_at")))
    kinds = [f"`{c}` {msa.schema[c].dataType.simpleString()}" for c in by]
    out_schema = ", ".join([*kinds, "pos long, ref string, n int, block int, alts string, calls binary"])

    def turn(piece: pa.Table) -> pa.Table:
        grid = np.full((BLOCK + 1, SEGMENT), ord("-"), np.uint8)  # the reference is the last row
        for i, text in zip(piece["_at"].to_pylist(), piece["_text"].cast(pa.binary()).to_pylist()):
            grid[i, : len(text)] = np.frombuffer(text, np.uint8)
        calls, first = grid[:-1], grid[-1]
        calls[(calls == first) | (calls == ord("-")) | (first == ord("-"))] = ord("0")
        calls[calls == ord("N")] = ord(".")
        at = np.flatnonzero((calls != ord("0")).any(axis=0))
        columns = np.ascontiguousarray(calls[:, at].T)
        found = [(columns == ord(c)).any(axis=1) for c in EMPTY + "ACGT"]
        same = {c: piece[c].take(pa.array(np.zeros(len(at), np.int64))) for c in [*by, "n", "block"]}
        seg = piece["_seg"][0].as_py()
        return pa.table(
            {c: same[c] for c in by}
            | {"pos": pa.array(at.astype(np.int64) + 1 + seg * SEGMENT), "ref": pa.array([chr(x).replace(EMPTY, "") for x in first[at]], pa.string()), "n": same["n"], "block": same["block"]}
            | {"alts": pa.array(["".join(c for c, f in zip(EMPTY + "ACGT", row) if f) for row in zip(*found)], pa.string()), "calls": pa.array([x.tobytes() for x in columns], pa.binary())}
        )

    return pieces.groupBy(*by, "block", "_seg").applyInArrow(turn, out_schema)


def vcf_document(msa: DataFrame, by: Sequence[str] = ("grp",), chrom: str = "Reference") -> DataFrame:
    """(by, ord, line): a VCF document per group: header, sample names, and a line per variant site with a genotype for each sample.

    Genotypes are 0 for the reference's base (and for gaps), the number of the
    alternative, or a dot for N; an empty sequence makes an alternative, but has
    none.  A line is put together from its blocks of
    samples; those in which nothing differs are not shuffled.
    """
    samples = materialize(numbered(msa.where(~F.col("is_ref")).select(*by, "ord", "id"), by, ["ord"], "sample", "n").withColumn("n", F.col("n").cast("int")), "samples")
    found = call_blocks(msa, samples.drop("id"), by)
    kinds = [f"`{c}` {msa.schema[c].dataType.simpleString()}" for c in by]

    def join(site: pa.Table) -> pa.Table:
        pos, ref, n = (site[c][0].as_py() for c in ("pos", "ref", "n"))
        alts = sorted(set("".join(site["alts"].to_pylist())))
        code = np.arange(256, dtype=np.uint8)
        for i, a in enumerate(alts):
            code[ord(a)] = ord("0") if a == EMPTY else ord("1") + i
        cells = np.full((n + BLOCK, 2), ord("0"), np.uint8)
        cells[:, 0] = ord("\t")
        for b, calls in zip(site["block"].to_pylist(), site["calls"].to_pylist()):
            cells[b * BLOCK : (b + 1) * BLOCK, 1] = code[np.frombuffer(calls, np.uint8)]
        alt = ",".join(alts).replace(EMPTY, "") if alts else "."
        line = "\t".join([chrom, str(pos), f"{ref}{pos}{alt}", ref, alt, ".", ".", ".", "GT"]) + cells[:n].tobytes().decode()
        return pa.table({c: site[c].take(pa.array([0])) for c in by} | {"ord": pa.array([pos], pa.int64()), "line": pa.array([line], pa.string())})

    body = found.groupBy(*by, "pos").applyInArrow(join, ", ".join([*kinds, "ord long, line string"]))
    part = samples.groupBy(*by, F.expr(f"int((sample - 1) div {BLOCK})").alias("_b")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("sample", "id"))), lambda x: x["id"]), "\t").alias("_ids"))
    names = part.groupBy(*by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_b", "_ids"))), lambda x: x["_ids"]), "\t").alias("ids"))
    columns = F.concat_ws("\t", F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"), "ids")
    texts = [F.lit("##fileformat=VCFv4.2"), F.lit('##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">'), F.lit(f"##contig=<ID={chrom}>"), columns]
    head = F.array(*[F.struct(F.lit(i - len(texts)).cast("long").alias("ord"), t.alias("line")) for i, t in enumerate(texts)])
    return body.unionByName(names.select(*by, F.inline(head)))


def read_vcf(lines: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """(by, id, pos, ref, base): every call of VCF lines that isn't the reference's base; a missing one is N."""
    p = F.split("line", "\t")
    named = lines.where(F.col("line").startswith("#CHROM")).select(*by, F.slice(p, 10, F.size(p)).alias("ids"))
    rows = lines.where(~F.col("line").startswith("#")).select(*by, F.get(p, F.lit(1)).cast("int").alias("pos"), F.get(p, F.lit(3)).alias("ref"), F.split(F.get(p, F.lit(4)), ",").alias("alts"), F.slice(p, 10, F.size(p)).alias("g"))
    each = rows.select(*by, "pos", "ref", "alts", F.posexplode("g").alias("i", "g")).where("g <> '0'").join(named, list(by))
    base = F.when(F.col("g") == ".", "N").otherwise(F.get("alts", F.col("g").try_cast("int") - 1))
    return each.select(*by, F.get("ids", F.col("i")).alias("id"), "pos", "ref", base.alias("base"))


def root_sequence(reference: DataFrame, paths: DataFrame, msa: DataFrame, new_root: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """(by, root, root_seq, gap_fills, mismatches): each group's reference mutated along the path to its new root.

    reference: by, ref_id, ref_seq; paths: by, ord, sample, path; new_root: by,
    root (null: none).  Without a new root the reference stays.  A root without
    a path or alignment row, and one that disagrees with its alignment row, is
    an error.
    """
    first = paths.groupBy(*by, "sample").agg(F.min_by("path", "ord").alias("path"))
    rows = reference.join(new_root, list(by), "left")
    rows = rows.join(first.withColumnRenamed("sample", "root"), [*by, "root"], "left").join(msa.select(*by, F.col("id").alias("root"), F.col("seq").alias("_msa")), [*by, "root"], "left")
    inferred = S.apply_mutations("ref_seq", S.parse_path("path"))
    rows = rows.withColumn("_seq", F.when(F.col("root").isNotNull() & F.col("path").isNotNull(), inferred)).withColumn("_check", F.when(F.col("_seq").isNotNull() & F.col("_msa").isNotNull(), S.root_check("_msa", "_seq")))
    bad = F.col("root").isNotNull() & (F.col("_check").isNull() | ~F.col("_check.length_ok") | (F.col("_check.bad_fills") > 0) | (F.col("_check.mismatches") > 0))
    seq = F.when(F.col("root").isNull(), F.col("ref_seq")).when(bad, F.raise_error(F.concat(F.lit("the inferred root disagrees with its alignment row: "), F.col("root"))).cast("string")).otherwise(F.col("_seq"))
    return rows.select(*by, F.coalesce("root", "ref_id").alias("root"), seq.alias("root_seq"), F.coalesce("_check.gap_fills", F.lit(0)).alias("gap_fills"))


def consensus(rows: DataFrame, by: Sequence[str] = ("leaf",), tree: str = "tree", seq: str = "seq") -> DataFrame:
    """(by, consensus): the most frequent base of each position over trees; ties go to the earliest tree."""
    each = rows.select(*by, tree, F.posexplode(F.split(seq, "")).alias("pos", "base")).where("base != ''")
    votes = each.groupBy(*by, "pos", "base").agg(F.count("*").alias("n"), F.min(tree).alias("first"))
    best = votes.groupBy(*by, "pos").agg(F.max_by("base", F.struct("n", -F.col("first"))).alias("base"))
    return best.groupBy(*by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "").alias("consensus"))


def consensus_differences(leaves: DataFrame, leaf: str = "leaf", tree: str = "tree") -> DataFrame:
    """(leaf, muts): where the most frequent base over trees isn't the reference's, in order of position; ties go to the earliest tree.

    leaves: leaf, tree, muts (ref, pos, alt), a leaf's differences from the
    reference in each tree.  Only these are exploded and shuffled; trees that
    have none at a position vote for the reference's base there.
    """
    all_ = leaves.groupBy(leaf).agg(F.sort_array(F.collect_set(tree)).alias("_trees"))
    each = leaves.select(leaf, F.col(tree).alias("_t"), F.inline("muts"))
    sites = each.groupBy(leaf, "pos").agg(F.min("ref").alias("ref"), F.collect_list(F.struct("_t", "alt")).alias("_d")).join(all_, leaf)
    silent = F.array_except("_trees", F.transform("_d", lambda x: x["_t"]))
    vote = lambda base, trees: F.struct((-F.size(trees)).alias("n"), F.array_min(trees).alias("first"), base.alias("base"))
    named = lambda a: F.transform(F.filter("_d", lambda x: x["alt"] == a), lambda x: x["_t"])
    votes = F.transform(F.array_distinct(F.transform("_d", lambda x: x["alt"])), lambda a: vote(a, named(a)))
    votes = F.concat(votes, F.when(F.size(silent) > 0, F.array(vote(F.col("ref"), silent))).otherwise(F.filter(votes, lambda v: F.lit(False))))
    best = sites.withColumn("alt", F.array_min(votes)["base"]).where("alt <> ref")
    muts = best.groupBy(leaf).agg(F.sort_array(F.collect_list(F.struct("pos", "ref", "alt"))).alias("_m"))
    return all_.join(muts, leaf, "left").select(leaf, F.coalesce(F.transform("_m", lambda m: F.struct(m["ref"].alias("ref"), m["pos"].alias("pos"), m["alt"].alias("alt"))), F.array().cast("array<struct<ref:string,pos:int,alt:string>>")).alias("muts"))


def ordered_consensus(consensus: DataFrame, reference_id: str, reference: str, leaf: str = "leaf") -> DataFrame:
    """(ord, leaf, seq): the reference's leaf first, the others by name; it is an error if the reference's leaf is missing."""
    rows = numbered(consensus, [], [(F.col(leaf) != reference_id).cast("int"), leaf])
    lacks = (F.col("ord") == 1) & (F.col(leaf) != reference_id)
    seq = F.when(lacks, F.raise_error(F.lit(f"the reference {reference_id} is not among the leaves")).cast("string")).otherwise(S.apply_mutations(F.lit(reference), "muts"))
    return rows.select("ord", leaf, seq.alias("seq"))


def leaf_sets_differ(rows: DataFrame, tree: str = "tree", leaf: str = "leaf") -> DataFrame:
    """Leaves that some tree lacks, with the number of trees that have them."""
    n = rows.select(tree).distinct().count()
    return rows.groupBy(leaf).agg(F.countDistinct(tree).alias("n_trees")).where(F.col("n_trees") != n)


def leaf_haplotypes(leaves: DataFrame, reference: str) -> DataFrame:
    """leaves (leaf, muts) with their sequences, and how many mutations don't name the reference's base."""
    ref = F.lit(reference)
    off = F.size(F.filter("muts", lambda m: F.substr(ref, m["pos"], F.lit(1)) != m["ref"]))
    return leaves.withColumn("seq", S.apply_mutations(ref, "muts")).withColumn("n_mismatched", off)
