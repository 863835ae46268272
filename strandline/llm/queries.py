"""The operators applied to the tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, licenses, linededup, lloyd, njoin, packing, quality, secrets, sharding, turns, urls, warc
from .common import read_table
from .oracles import oracle_sql

URL_RULES = (
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)

def packed(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with their places, ids reduced to their checksum."""
    pieces = packing.tokenize(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents"))

def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    back = warc.read_warc(warc.write_warc(pages))
    digest = F.when(F.col("payload").isNotNull(), F.sha2("payload", 256)).otherwise(F.col("digest"))
    return back.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", digest.alias("payload_digest"), F.col("type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"))

def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, bad): a page shows the document that its path names; bad where that is labelled toxic or of low quality."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"^[^?#]*/([0-9]{1,18})[^/?#]*/?(?:[?#]|$)", 1).alias("_d"))
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("_d"), F.greatest(F.col("toxic"), 1 - F.col("quality")).alias("bad"))
    return pages.join(labels, "_d").select("page_id", "bad")

def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages"), page_labels(spark, sf_dir), URL_RULES)

def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return njoin.join_components(read_table(spark, sf_dir, "documents"))

def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents")).drop("host_rate", "host_kept")

def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_chats(turns.unionByName(more)))

def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))

def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), near=False)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")

def proximity_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's proximity matches, apart from op9's columns, which SQL checks."""
    found = decontam.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.size("near_items").cast("long").alias("n_near_items"), F.array_join("near_items", ",").alias("near_items"))

def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "net")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))

def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lloyd.cluster(read_table(spark, sf_dir, "embeddings"))
    table = found.centroids.select("cluster", "cluster_inertia", "inertia", F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256).alias("centroid_sha256"))
    return found.assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row per centroid

def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

def damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user by a checksum of their place; nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    z = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    text = F.when(z == 1, "").when(z == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    times = F.when(z == 0, 0).when(z == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(z == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")

def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turns.digest(turns.repair(damaged(rows), everyone=rows))

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_sharding, op3_warc, op4_url_filter, op5_ngram_join, op6_quality, op7_chat, op8_licenses, op9_decontamination, op10_secrets, op11_centroids, op12_line_dedup, op13_turn_repair, proximity_matches)}


__all__ = ["oracle_sql", "packed", "queries"]
