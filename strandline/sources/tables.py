"""Tables and text files: metadata, insertions, GFF, mutation paths, logs, configuration, and the text sinks."""

from __future__ import annotations

import glob
import lzma
import os
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators.relational import numbered
from ..operators.samples import METADATA_COLUMNS
from .fasta import list_files, local_path, register

# Texts that mean a missing value in metadata files.
MISSING = ("", "NA", "N/A", "NULL", "None", "nan", "NaN", "null", "n/a", "<NA>", "#N/A")


def normalize_missing(df: DataFrame) -> DataFrame:
    """String columns with the texts for missing values as null."""
    return df.select(*[F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def complete_dirs(dirs: Sequence[str]) -> list[str]:
    """Folders with sequences and metadata both; others are left out."""
    return [d for d in dirs if glob.glob(os.path.join(local_path(d), "*.fasta")) and (glob.glob(os.path.join(local_path(d), "*.xls*")) or glob.glob(os.path.join(local_path(d), "*.csv")))]


def read_fasta(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """FASTA, plain, gz or xz by suffix, in splits; ord is the order of the files by name and of the records in them."""
    register(spark)
    return spark.read.format("fasta").options(**options).load(path)


def first_record(fasta: DataFrame) -> DataFrame:
    return fasta.agg(F.min_by("id", "ord").alias("id"), F.min_by("seq", "ord").alias("seq"))


def read_metadata(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header, all columns as text, missing texts as null; ord follows files by name, then rows."""
    rows = spark.read.option("header", True).option("multiLine", True).csv(path)
    rows = normalize_missing(rows).withColumn("_file", F.input_file_name()).withColumn("_row", F.monotonically_increasing_id())
    return rows.withColumn("ord", F.struct("_file", "_row")).drop("_file", "_row")


def read_excel(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of each workbook, where an engine for them is installed; the required columns as text, with ord."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        for files in batches:
            for name, content in zip(files["path"], files["content"]):
                sheet = pd.read_excel(io.BytesIO(content), sheet_name=0, dtype=str)[list(METADATA_COLUMNS)]
                yield sheet.where(sheet.notna(), None).assign(_file=name, _row=range(len(sheet)))

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = ", ".join(f"{c} string" for c in METADATA_COLUMNS) + ", _file string, _row long"
    return files.mapInPandas(parse, schema).withColumn("ord", F.struct("_file", "_row")).drop("_file", "_row")


def read_insertions(spark: SparkSession, path: str) -> DataFrame:
    """(id, ins) of an alignment report, tab-separated, plain, gz or xz: sanitized ids, the last row with insertions of each."""
    if path.endswith(".xz"):

        def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for files in batches:
                for content in files["content"]:
                    lines = lzma.decompress(content).decode().splitlines()
                    at = [lines[0].split("\t").index(c) for c in ("seqName", "insertions")]
                    cells = [x.split("\t") for x in lines[1:]]
                    yield pd.DataFrame({"seqName": [c[at[0]] for c in cells], "insertions": [c[at[1]] if len(c) > at[1] else None for c in cells], "ord": range(len(cells))})

        rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(unpack, "seqName string, insertions string, ord long")
    else:
        rows = spark.read.option("header", True).option("sep", "\t").csv(path).select("seqName", "insertions").withColumn("ord", F.monotonically_increasing_id())
    parsed = rows.select(S.sanitize_id("seqName").alias("id"), S.parse_insertions("insertions").alias("ins"), "ord").where(F.size("ins") > 0)
    return parsed.groupBy("id").agg(F.max_by("ins", "ord").alias("ins"))


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """(ord, seqid, source, type, start, end, score, strand, phase, attributes, id, name) of gene and CDS lines; none at all is an error."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("ord", "line"))
    return parse_gff(lines)


def parse_gff(lines: DataFrame) -> DataFrame:
    """lines (ord, line) parsed; comments and lines of another form are left out."""
    p = F.split("line", "\t")
    names = ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes")
    rows = lines.where(~F.col("line").startswith("#")).withColumn("_p", p).where((F.size("_p") == 9) & F.get("_p", F.lit(3)).rlike(r"^\d+$") & F.get("_p", F.lit(4)).rlike(r"^\d+$"))
    rows = rows.select("ord", *[F.trim(F.get("_p", F.lit(i))).alias(n) for i, n in enumerate(names)]).where(F.lower("type").isin("gene", "cds"))
    fid = S.attribute_value("attributes", "ID")
    name = F.coalesce(F.nullif(S.attribute_value("attributes", "Name"), F.lit("")), F.nullif(fid, F.lit("")), F.concat("type", F.lit("_feature")))
    return rows.withColumn("start", F.col("start").cast("int")).withColumn("end", F.col("end").cast("int")).withColumn("id", fid).withColumn("name", name)


def require_features(features: DataFrame) -> DataFrame:
    if features.isEmpty():
        raise ValueError("no gene or CDS features")
    return features


def read_paths(spark: SparkSession, path: str) -> DataFrame:
    """(ord, sample, path) of the lines with exactly two fields."""
    return parse_paths(spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.col("value").alias("line")))


def parse_paths(lines: DataFrame) -> DataFrame:
    rows = lines.withColumn("_p", F.split(F.regexp_replace("line", r"^\s+|\s+$", ""), "\t")).where(F.size("_p") == 2)
    return rows.select("ord", F.get("_p", F.lit(0)).alias("sample"), F.get("_p", F.lit(1)).alias("path"))


def read_logs(spark: SparkSession, glob_path: str) -> DataFrame:
    """(segment, grp, randomized, path, text) of logs under .../segment/group/[randomized_N/]name.log; absent files are just not there."""
    rows = spark.read.text(glob_path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    rx = r"/([^/]+)/([^/]+)/(?:randomized_(\d+)/)?[^/]+$"
    part = lambda i: F.nullif(F.regexp_extract("path", rx, i), F.lit(""))
    return rows.select(part(1).alias("segment"), part(2).alias("grp"), part(3).cast("int").alias("randomized"), "path", "text")


# --- configuration -----------------------------------------------------------------------------------------------


@dataclass
class Config:
    segments: list[str] = field(default_factory=list)
    ha_subtypes: list[str] = field(default_factory=list)
    na_subtypes: list[str] = field(default_factory=list)
    references: dict[str, str] = field(default_factory=dict)
    reroot: dict[str, str] = field(default_factory=dict)
    max_frac_gaps: float = 0.03
    max_frac_ambig: float = 0.0
    n_randomizations: int = 10


def combinations(spark: SparkSession, config: Config) -> DataFrame:
    """(ord, segment, grp, accession): HA subtypes, NA subtypes, other segments as `all`; those without an accession are left out."""
    pairs = [("HA", x) for x in config.ha_subtypes if "HA" in config.segments] + [("NA", x) for x in config.na_subtypes if "NA" in config.segments] + [(s, "all") for s in config.segments if s not in ("HA", "NA")]
    rows = [(i, s, g, config.references.get(f"{s}_{g}")) for i, (s, g) in enumerate(pairs)]
    return spark.createDataFrame(rows, "ord int, segment string, grp string, accession string").where("accession is not null")


def lookup(df: DataFrame, mapping: Mapping[str, str], out: str, default: str = "") -> DataFrame:
    """df (segment, grp, ...) with the configured value of `SEGMENT_GRP`, or the default."""
    key = F.concat_ws("_", "segment", "grp")
    value = F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), key) if mapping else F.lit(None).cast("string")
    return df.withColumn(out, F.coalesce(value, F.lit(default)))


def aligner_config(spark: SparkSession, fasta: str, gff: str) -> DataFrame:
    """One row, json: the configuration document for the external aligner."""
    files = F.struct(F.lit(os.path.basename(gff)).alias("genomeAnnotation"), F.lit("pathogen.json").alias("pathogenJson"), F.lit(os.path.basename(fasta)).alias("reference"))
    doc = F.struct(F.lit("3.0.0").alias("schemaVersion"), files.alias("files"), F.struct(F.lit(0.1).alias("minSeedCover")).alias("alignmentParams"))
    return spark.range(1).select(F.to_json(doc).alias("json"))


# --- sinks -------------------------------------------------------------------------------------------------------


def write_groups(df: DataFrame, path: str, by: Sequence[str] = ("segment", "grp")) -> None:
    """Parquet, one folder per group; rows of a group are spread over tasks, so a large group is no single file."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_fasta(df: DataFrame, path: str, compression: str = "none", single: bool = False, by: Sequence[str] = (), mode: str = "append") -> None:
    """id and seq as FASTA, in the order of ord where there is one; by: columns that become folders.

    A group's rows may come from several tasks, each with a file of its own, so
    that no group has to fit one task.
    """
    register(df.sparkSession)
    rows = df.coalesce(1) if single else df
    order = [*by, *(["ord"] if "ord" in df.columns else [])]
    rows = rows.sortWithinPartitions(*order) if order else rows
    rows.select("id", "seq", *by).write.format("fasta").mode(mode).option("compression", compression).option("by", ",".join(by)).save(path)


def folder_value(column: str, file: str = "file") -> Column:
    """Value of the folder `column=value` in a file's path."""
    return F.url_decode(F.regexp_extract(file, f"/{column}=([^/]*)/", 1))


def write_lines(df: DataFrame, path: str, line: str = "line", order: str | None = "ord", compression: str = "none") -> None:
    """Text, one line per row, in one ordered file where an order is given."""
    rows = df.orderBy(order).coalesce(1) if order else df
    rows.select(line).write.mode("overwrite").option("compression", compression).text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks at the ends of values stay."""
    df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def with_row_order(df: DataFrame, *columns: str) -> DataFrame:
    """df with ord: rows numbered by the columns, in ranges, not in one task."""
    return numbered(df, [], columns)
