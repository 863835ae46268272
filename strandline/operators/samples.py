"""Metadata augmentation and sample lists for all groups at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..functions import sequence as S
from .relational import first_wins, pinned_order, upper_median

# Metadata columns that an input must have.
METADATA_COLUMNS = ("Isolate_Id", "Isolate_Name", "Subtype", "Clade", "Passage_History", "Location", "Host", "Collection_Date")


def select_metadata(df: DataFrame) -> DataFrame:
    """The required columns in lower case; a missing one is an error."""
    gone = [c for c in METADATA_COLUMNS if c not in df.columns]
    if gone:
        raise KeyError(f"metadata lacks {gone}")
    extra = ["ord"] if "ord" in df.columns else []
    return df.select(*extra, *[F.col(c).alias(c.lower()) for c in METADATA_COLUMNS])


def combine_metadata(df: DataFrame) -> DataFrame:
    """First row of each isolate, by ord."""
    return first_wins(df, ["isolate_id"], ["ord"])


def global_median_date(df: DataFrame, date_col: str = "collection_date"):
    """The upper median of all dates; without any date it is an error."""
    d = df.select(M.parse_date(date_col).alias("d")).where("d is not null").agg(upper_median("d").alias("m")).first()["m"]
    if d is None:
        raise ValueError("no valid dates in collection_date")
    return d


def augment(df: DataFrame, strict: bool = True) -> DataFrame:
    """df with host_group, geographic_group and temporal_group; the date split is one for the whole table."""
    median = F.lit(global_median_date(df))
    return (
        df.withColumn("host_group", M.host_group("host", strict)).withColumn("geographic_group", M.geographic_group("location"))
        .withColumn("temporal_group", M.temporal_group(M.parse_date("collection_date"), median))
    )


def parse_records(records: DataFrame, segments: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) of sequence records (ord, id, seq) with ids of five fields.

    kept: ord, segment, grp, id, seq, the first record of each segment, group
    and isolate.  rejected: ord, id, reason.
    """
    parts = F.split("id", r"\|")
    rows = records.withColumn("_p", parts).withColumn("segment", F.get("_p", F.lit(1))).withColumn("epi_isl", F.get("_p", F.lit(3))).withColumn("grp", S.group_key("segment", F.get("_p", F.lit(4))))
    wanted = F.lit(True) if segments is None else F.col("segment").isin(*segments)
    reason = F.when(F.size("_p") != 5, "malformed").when(~wanted, "segment").when(F.col("grp").isNull(), "subtype")
    rows = rows.withColumn("reason", reason)
    kept = rows.where("reason is null").select("ord", "segment", "grp", F.col("epi_isl").alias("id"), "seq")
    return first_wins(kept, ["segment", "grp", "id"], ["ord"]), rows.where("reason is not null").select("ord", "id", "reason")


def value_samples(msa: DataFrame, meta: DataFrame, column: str, root: str, by: Sequence[str] = ("grp",)) -> DataFrame:
    """(value, by, ord, id): for every value of a metadata column, the aligned isolates of it behind the root; unknown columns are an error.

    msa: by, id, is_ref; ids of the metadata are sanitized before they are matched.
    """
    if column not in meta.columns:
        raise KeyError(f"metadata has no column {column}")
    m = meta.select(S.sanitize_id("isolate_id").alias("id"), F.col(column).alias("value")).where("value is not null").distinct()
    hits = msa.where(~F.col("is_ref")).select(*by, "id").distinct().join(m, "id")
    return pinned_order(hits, "id", root, ["value", *by])


def temporal_samples(msa: DataFrame, meta: DataFrame, root: str, by: Sequence[str] = ("grp",)) -> DataFrame:
    """(value, by, ord, id): early and late isolates of each tree, by the upper median of its own dates, behind the root.

    A tree without dates has lists of the root alone.
    """
    m = meta.select(S.sanitize_id("isolate_id").alias("id"), M.parse_date("collection_date").alias("d"))
    rows = msa.where(~F.col("is_ref")).select(*by, "id").distinct().join(m, "id", "left")
    median = rows.groupBy(*by).agg(upper_median("d").alias("m"))
    split = rows.join(median, list(by)).select(*by, "id", M.temporal_group("d", F.col("m")).alias("value"))
    groups = median.select(*by).withColumn("value", F.explode(F.array(F.lit("early"), F.lit("late"))))
    hits = split.where("value != 'unknown'").select("value", *by, "id").unionByName(groups.select("value", *by, F.lit(root).alias("id")))
    return pinned_order(hits, "id", root, ["value", *by])


def root_samples(spark, reference: str, new_root: str) -> DataFrame:
    """(ord, id): the reference, then the new root."""
    return spark.createDataFrame([(1, reference), (2, new_root)], "ord int, id string")


def host_annotation(meta: DataFrame) -> DataFrame:
    return meta.select("isolate_id", "host_group")
