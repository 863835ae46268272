"""Report tables: the ones behind figures and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..functions import sequence as S
from ..plans.scratch import materialize
from .relational import dense_counts, interpolated_median, top_k, upper_median, value_counts
from .variants import with_reference


def composition(msa: DataFrame, meta: DataFrame, column: str, values: Sequence[str], by: Sequence[str] = ("grp",)) -> DataFrame:
    """(by, value, count, total, fraction): every group and category; the base is the number of aligned isolates."""
    ids = msa.where(~F.col("is_ref")).select(*by, "id").distinct()
    rows = ids.join(meta.select(S.sanitize_id("isolate_id").alias("id"), F.col(column).alias("value")), "id", "left")
    total = rows.groupBy(*by).agg(F.countDistinct("id").alias("total"))
    out = dense_counts(rows, by, "value", values, "count").join(total, list(by))
    return out.withColumn("fraction", F.col("count") / F.col("total"))


def temporal_summary(msa: DataFrame, meta: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """(by, total, valid, missing, median, n_early, n_late); the median is N/A without dates."""
    ids = msa.where(~F.col("is_ref")).select(*by, "id").distinct()
    rows = ids.join(meta.select(S.sanitize_id("isolate_id").alias("id"), M.parse_date("collection_date").alias("d")), "id", "left")
    median = rows.groupBy(*by).agg(upper_median("d").alias("m"))
    g = rows.join(median, list(by)).groupBy(*by).agg(
        F.count("*").alias("total"), F.count("d").alias("valid"), F.first("m").alias("m"),
        F.count_if(F.col("d") <= F.col("m")).alias("n_early"), F.count_if(F.col("d") > F.col("m")).alias("n_late"),
    )
    return g.select(*by, "total", "valid", (F.col("total") - F.col("valid")).alias("missing"), M.iso_or_na("m").alias("median"), "n_early", "n_late")


def identity(msa: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """(by, id, identity): per cent of the reference's positions, per row beside the reference."""
    ref = msa.where("is_ref").select(*by, F.col("seq").alias("_ref"))
    return with_reference(msa.where(~F.col("is_ref")), ref, by, "_ref").select(*by, "id", S.identity_pct("seq", "_ref").alias("identity"))


def identity_summary(identities: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """(by, n, median_identity): rows of each group and their exact interpolated median."""
    rows = materialize(identities.select(*by, "identity"), "identities")
    medians = interpolated_median(rows, by, "identity").withColumnRenamed("median", "median_identity")
    return rows.groupBy(*by).agg(F.count("*").alias("n")).join(medians, list(by), "left")


def host_subtypes(meta: DataFrame, hosts: Sequence[str], k: int = 10) -> DataFrame:
    """(host, subtype, count, total, fraction): the k most frequent subtypes of each host, ties by name, and the host's share of each."""
    rows = meta.select("host_group", M.strip_type_prefix("subtype").alias("subtype")).where("subtype is not null")
    n = rows.groupBy("host_group", "subtype").agg(F.count("*").alias("count"))
    n = n.withColumn("total", F.sum("count").over(W.partitionBy("subtype"))).withColumn("fraction", F.col("count") / F.col("total"))
    top = top_k(n.where(F.col("host_group").isin(*hosts)), k, ["host_group"], [F.col("count").desc(), F.col("subtype")])
    return top.withColumnRenamed("host_group", "host")


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return value_counts(df, column).orderBy(F.col("n").desc(), column).limit(k)


def formatted(df: DataFrame, counts: Sequence[str] = (), shares: Sequence[str] = ()) -> DataFrame:
    """Counts with thousands separators and shares with three decimals, as text."""
    return df.withColumns({c: F.format_number(c, 0) for c in counts} | {c: F.format_number(c, 3) for c in shares})


def curation_log(logs: DataFrame) -> DataFrame:
    """logs (label, text) with total, passed, failed and frac_passed."""
    n = lambda key: F.regexp_replace(F.regexp_extract("text", key + r": ([\d,]+)", 1), ",", "").try_cast("long")
    out = logs.select("label", n("Total sequences processed").alias("total"), n("Passed quality filters").alias("passed"), n("Failed quality filters").alias("failed"))
    return out.withColumn("frac_passed", F.try_divide(F.col("passed").cast("double"), F.col("total").cast("double")))


def graph_log(logs: DataFrame) -> DataFrame:
    """logs (label, kind, text) with min_parsimony, max_parsimony, tree_count (text) and its magnitude; rows without scores are left out."""
    get = lambda rx: F.nullif(F.regexp_extract("text", rx, 1), F.lit(""))
    one = F.col("kind") == "individual"
    low = F.when(one, get(r"Min parsimony score in DAG:\s*(\d+)")).otherwise(get(r"parsimony_min:\s*score:(\d+)"))
    high = F.when(one, get(r"Max parsimony score in DAG:\s*(\d+)")).otherwise(get(r"parsimony_max:\s*score:(\d+)"))
    count = F.when(one, get(r"Total trees in DAG:\s*(\d+)")).otherwise(get(r"tree_count:\s*(\d+)"))
    out = logs.select("label", "kind", low.try_cast("long").alias("min_parsimony"), high.try_cast("long").alias("max_parsimony"), count.alias("tree_count"))
    out = out.where("min_parsimony is not null and max_parsimony is not null and (kind != 'individual' or tree_count is not null)")
    return out.withColumn("magnitude", M.magnitude("tree_count"))


def improvements(stats: DataFrame) -> DataFrame:
    """(label, best_individual, merged, improvement) of groups that have both kinds."""
    best = F.min(F.when(F.col("kind") == "individual", F.col("min_parsimony")))
    merged = F.min(F.when(F.col("kind") == "merged", F.col("min_parsimony")))
    g = stats.groupBy("label").agg(best.alias("best_individual"), merged.alias("merged")).where("best_individual is not null and merged is not null")
    return g.withColumn("improvement", F.col("merged") - F.col("best_individual"))
