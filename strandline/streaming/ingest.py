"""Extension: continuous ingest of sequence records (the batch workflow has none).

Records are parsed like in the batch form; first-wins holds over the stream by
the arrival of each segment, group and isolate within the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S


def parse_stream(records: DataFrame) -> DataFrame:
    """records (id, seq, ts) with segment, grp and epi_isl; ids of another form, and unreadable subtypes, are left out."""
    p = F.split("id", r"\|")
    rows = records.withColumn("_p", p).where(F.size("_p") == 5)
    rows = rows.select("ts", F.get("_p", F.lit(1)).alias("segment"), F.get("_p", F.lit(3)).alias("epi_isl"), F.get("_p", F.lit(4)).alias("_sub"), "seq")
    return rows.withColumn("grp", S.group_key("segment", "_sub")).where("grp is not null").drop("_sub")


def first_arrivals(parsed: DataFrame, late: str = "1 day") -> DataFrame:
    """The first arrival of each isolate in its group; state older than the watermark is dropped."""
    return parsed.withWatermark("ts", late).dropDuplicatesWithinWatermark(["segment", "grp", "epi_isl"])


def group_counts(parsed: DataFrame, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Records per group and window of arrival."""
    return parsed.withWatermark("ts", late).groupBy(F.window("ts", window), "segment", "grp").agg(F.count("*").alias("n"))
