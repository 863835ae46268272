"""Sequence expressions, Column to Column; all stay in the JVM.

Sequences are strings, positions are 1-based and inclusive, `-` is a gap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that identifiers must not hold for downstream tools.
ID_CHARS = "[]():;,'."

STOP_CODONS = ("TAA", "TAG", "TGA")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sanitize_id(c: Column | str) -> Column:
    return F.translate(col(c), ID_CHARS, "")


def checked_id(c: Column | str) -> Column:
    """The sanitized id; a blank in it is an error."""
    clean = sanitize_id(c)
    return F.when(clean.contains(" "), F.raise_error(F.concat(F.lit("identifier contains spaces: "), col(c)))).otherwise(clean)


def attribute_value(attrs: Column | str, name: str) -> Column:
    """Text after the first `name=`, wherever it stands, up to the next `;` or the end; null without it."""
    a, key = col(attrs), f"{name}="
    after = F.substr(a, F.instr(a, key) + len(key))
    return F.when(F.instr(a, key) > 0, F.substring_index(after, ";", 1))


def ha_na(subtype: Column | str, part: int) -> Column:
    """The H (1) or N (2) part of `H1N1...` or `A_/_H1N1...`; null where it can't be read."""
    s = col(subtype)
    s = F.when(s.contains("_/_"), F.split_part(s, F.lit("_/_"), F.lit(2))).otherwise(s)
    return F.nullif(F.regexp_extract(s, r"^(H\d+)(N\d+)", part), F.lit(""))


def group_key(segment: Column | str, subtype: Column | str) -> Column:
    """H part for HA, N part for NA, else `all`."""
    seg = col(segment)
    return F.when(seg == "HA", ha_na(subtype, 1)).when(seg == "NA", ha_na(subtype, 2)).otherwise(F.lit("all"))


def slice_seq(seq: Column | str, start: Column | int, end: Column | int) -> Column:
    start, end = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    return F.substr(col(seq), start, end - start + 1)


def n_gaps(seq: Column | str) -> Column:
    s = col(seq)
    return F.length(s) - F.length(F.replace(s, F.lit("-"), F.lit("")))


def n_ambiguous(seq: Column | str) -> Column:
    """Characters beside A, C, G, T and `-`; lower case counts as ambiguous."""
    return F.length(F.regexp_replace(col(seq), "[ACGT-]", ""))


def fraction(n: Column, seq: Column | str) -> Column:
    """n as a share of the length; null for the empty sequence."""
    return F.try_divide(n.cast("double"), F.length(col(seq)).cast("double"))


def mask(seq: Column | str) -> Column:
    return F.regexp_replace(col(seq), "[^ACGT-]", "N")


def terminal_gaps(seq: Column | str) -> Column:
    s = col(seq)
    return (F.left(s, F.lit(3)) == "---") | (F.right(s, F.lit(3)) == "---")


def fill_gaps(seq: Column | str, ref: Column | str) -> Column:
    """Gaps replaced by the reference's bases; the reference must have none."""
    both = F.zip_with(F.split(col(seq), ""), F.split(col(ref), ""), lambda a, b: F.when(a == "-", b).otherwise(a))
    return F.when(col(ref).contains("-"), F.raise_error(F.lit("reference contains gaps"))).otherwise(F.array_join(both, ""))


def degap(seq: Column | str) -> Column:
    return F.replace(col(seq), F.lit("-"), F.lit(""))


INSERTIONS = "array<struct<pos:int,nucs:string>>"


def parse_insertions(text: Column | str) -> Column:
    """`pos:nucs,pos:nucs` as structs, highest first; blank items are skipped, malformed ones are an error."""
    items = F.filter(F.transform(F.split(F.coalesce(col(text), F.lit("")), ","), F.trim), lambda x: x != "")
    one = lambda x: F.when(F.size(F.split(x, ":")) == 2, F.struct(F.element_at(F.split(x, ":"), 1).cast("int").alias("pos"), F.element_at(F.split(x, ":"), 2).alias("nucs"))).otherwise(F.raise_error(F.concat(F.lit("bad insertion: "), x)))
    return F.sort_array(F.transform(items, one).cast(INSERTIONS), asc=False)


def insert(seq: Column | str, insertions: Column | str) -> Column:
    """seq with each text put behind its position, from the highest down; 0 puts it in front."""
    return F.aggregate(col(insertions), col(seq), lambda a, i: F.concat(F.substr(a, F.lit(1), i["pos"]), i["nucs"], F.substr(a, i["pos"] + 1, F.length(a))))


def insertions_in_cds(insertions: Column | str, start: Column, end: Column, offset: Column | int, legacy: bool = False) -> Column:
    """Insertions with start <= pos < end, highest first.

    Positions become relative to the fragment; legacy leaves them relative to
    the whole curated alignment.
    """
    base = offset if legacy else start - 1
    inside = F.filter(col(insertions), lambda i: (i["pos"] >= start) & (i["pos"] < end))
    return F.sort_array(F.transform(inside, lambda i: F.struct((i["pos"] - base).cast("int").alias("pos"), i["nucs"].alias("nucs"))), asc=False)


def cds_fragment(seq: Column | str, start: Column, end: Column, offset: Column | int) -> Column:
    """Aligned fragment of original coordinates; the alignment starts behind offset."""
    return slice_seq(seq, start - offset, end - offset)


def gene_fragments(seq: Column | str, cds: Column | str, insertions: Column | str, offset: Column | int, legacy: bool = False) -> Column:
    """Each CDS part sliced, with its insertions, without gaps: an array in the order of cds."""
    piece = lambda f: degap(insert(cds_fragment(seq, f["start"], f["end"], offset), insertions_in_cds(insertions, f["start"], f["end"], offset, legacy)))
    return F.transform(col(cds), piece)


def cds_failure(seq: Column | str) -> Column:
    """First reason why a coding sequence is invalid, null where it is valid."""
    s = F.upper(col(seq))
    n = F.length(s)
    return (
        F.when(n % 3 != 0, "wrong_length").when(n < 6, "too_short").when(~s.startswith("ATG"), "missing_start_codon")
        .when(~F.right(s, F.lit(3)).isin(*STOP_CODONS), "missing_stop_codon")
    )


# --- mutations ---------------------------------------------------------------------------------------------------

MUTATION = "struct<ref:string,pos:int,alt:string>"


def parse_mutation(m: Column) -> Column:
    """`A12T` as ref, 1-based pos, alt."""
    return F.struct(F.left(m, F.lit(1)).alias("ref"), F.substr(m, F.lit(2), F.length(m) - 2).cast("int").alias("pos"), F.right(m, F.lit(1)).alias("alt"))


def parse_path(path: Column | str) -> Column:
    """Mutations of `node:mut,mut node:mut ...` in order."""
    nodes = F.filter(F.split(F.trim(col(path)), r"\s+"), lambda x: x != "")
    muts = F.flatten(F.transform(nodes, lambda x: F.split(F.split_part(x, F.lit(":"), F.lit(2)), ",")))
    return F.transform(F.filter(muts, lambda m: m != ""), parse_mutation)


def apply_mutations(seq: Column | str, muts: Column | str) -> Column:
    """seq after all mutations in order; later ones at a site win."""
    return F.aggregate(col(muts), col(seq), lambda a, m: F.overlay(a, m["alt"], m["pos"], F.lit(1)))


def mutation_warnings(seq: Column | str, muts: Column | str) -> Column:
    """How many mutations don't find their reference base in the running sequence."""
    start = F.struct(col(seq).alias("s"), F.lit(0).alias("n"))
    step = lambda a, m: F.struct(F.overlay(a["s"], m["alt"], m["pos"], F.lit(1)).alias("s"), (a["n"] + (F.substr(a["s"], m["pos"], F.lit(1)) != m["ref"]).cast("int")).alias("n"))
    return F.aggregate(col(muts), start, step, lambda a: a["n"])


def root_check(msa: Column | str, inferred: Column | str) -> Column:
    """Struct (length_ok, gap_fills, bad_fills, mismatches) of an inferred sequence against its alignment row."""
    a, b = col(msa), col(inferred)
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    n = lambda f: F.size(F.filter(pairs, f))
    return F.struct(
        (F.length(a) == F.length(b)).alias("length_ok"), n(lambda p: p["x"] == "-").alias("gap_fills"),
        n(lambda p: (p["x"] == "-") & ~F.coalesce(p["y"], F.lit("")).isin("A", "C", "G", "T")).alias("bad_fills"),
        n(lambda p: (p["x"] != "-") & ~p["x"].eqNullSafe(p["y"])).alias("mismatches"),
    )


def identity_pct(seq: Column | str, ref: Column | str) -> Column:
    """Per cent of the reference's positions at which seq has the same character, gaps included."""
    same = F.zip_with(F.split(col(seq), ""), F.split(col(ref), ""), lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    return F.try_divide(F.lit(100.0) * F.aggregate(same, F.lit(0), lambda a, x: a + x), F.length(col(ref)).cast("double"))
