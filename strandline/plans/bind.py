"""Domain tables derived from the star-schema tables, in Spark and, for the oracle, in SQL.

Both forms of a table are written separately and must give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOSTS = (
    "Human", "Avian", "Swine", "Dairy cow", "Bovine", "Environment", "Laboratory derived", "Pig", "Sus scrofa domesticus", "Horse", "Equine", "Dog", "Canis lupus",
    "Cat", "Felis catus", "Seal", "Sea lion", "Ferret", "Mink", "Bat", "Mallard duck", "Wild bird", "Chicken", "Great tit", "Gallus gallus", "Anas platyrhynchos",
    "Larus argentatus", "Passer montanus", "Water sample", "Muscovy duck", "Common tern", "Cattle",
)
LOCATIONS = ("North America / United States / Iowa", "Europe / Germany", "Asia / China / Hunan", "South America / Peru", "  Europe\t/ France", "asia / India", "", "Africa", "Asia", "North America")
SEGMENTS = ("PB2", "PB1", "PA", "HA", "NP", "NA", "MP", "NS")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz .,"
_HALF = "ACCTACGCTGATCNGATCGTACTGAC"
BASES_OF = _HALF + _HALF + "A-N"
#: States of the tree's leaves, by market segment in alphabetical order.
STATES = ("avian", "bovine", "human", "other", "swine")
MARKETS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ROOT = "EPI_ISL_root"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, key):
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values)).cast("int") + 1)


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, several per isolate: the columns of a metadata sheet, dates as text, and ord."""
    o = table(spark, sf_dir, "orders")
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    date = F.when(k % 17 == 0, F.left(day, F.lit(4))).when(k % 19 == 0, F.lit(None)).when(k % 23 == 0, F.concat(F.lit(" "), day, F.lit("  "))).otherwise(day)
    return o.select(
        k.alias("ord"), F.concat(F.lit("EPI_ISL_"), F.col("o_custkey").cast("string")).alias("Isolate_Id"), F.concat(F.lit("A/x/"), k.cast("string")).alias("Isolate_Name"),
        F.concat(F.lit("A / H"), (k % 16 + 1).cast("string"), F.lit("N"), (F.col("o_custkey") % 9 + 1).cast("string")).alias("Subtype"), F.col("o_orderstatus").alias("Clade"),
        F.col("o_orderpriority").alias("Passage_History"), F.when(k % 13 != 0, _pick(LOCATIONS, k)).alias("Location"), F.when(k % 37 != 0, _pick(HOSTS, k)).alias("Host"), date.alias("Collection_Date"),
    )


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''").replace("\t", "'||chr(9)||'") + "'" for v in values) + "]"


RAW_METADATA = f"""raw_meta AS (SELECT o_orderkey AS ord, 'EPI_ISL_' || o_custkey AS isolate_id, 'A/x/' || o_orderkey AS isolate_name,
  'A / H' || (o_orderkey % 16 + 1) || 'N' || (o_custkey % 9 + 1) AS subtype, o_orderstatus AS clade, o_orderpriority AS passage_history,
  CASE WHEN o_orderkey % 13 <> 0 THEN {sql_list(LOCATIONS)}[CAST(o_orderkey % {len(LOCATIONS)} AS INT) + 1] END AS location,
  CASE WHEN o_orderkey % 37 <> 0 THEN {sql_list(HOSTS)}[CAST(o_orderkey % {len(HOSTS)} AS INT) + 1] END AS host,
  CASE WHEN o_orderkey % 17 = 0 THEN strftime(o_orderdate, '%Y') WHEN o_orderkey % 19 = 0 THEN NULL
       WHEN o_orderkey % 23 = 0 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') || '  ' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS collection_date
  FROM orders)"""
#: The first row of each isolate.
METADATA = RAW_METADATA + ", meta AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY isolate_id ORDER BY ord) AS rn FROM raw_meta) WHERE rn = 1)"
#: meta with parsed dates (d).
DATED = METADATA + ", dated AS (SELECT *, CASE WHEN regexp_full_match(trim(collection_date), '\\d{4}-\\d{1,2}-\\d{1,2}') THEN TRY_CAST(trim(collection_date) AS DATE) END AS d FROM meta)"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sequence record per order: ord, id (of five fields, mostly), seq."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    sub = F.when(k % 31 == 0, "mixed").when(k % 7 == 0, F.concat(F.lit("A_/_H"), (k % 16 + 1).cast("string"), F.lit("N"), (k % 9 + 1).cast("string"))).otherwise(F.concat(F.lit("H"), (k % 16 + 1).cast("string"), F.lit("N"), (k % 9 + 1).cast("string"), F.lit("pdm")))
    fields = [F.concat(F.lit("EPI"), k.cast("string")), _pick(SEGMENTS, k), F.col("o_orderstatus"), F.concat(F.lit("EPI_ISL_"), F.col("o_custkey").cast("string"))]
    name = F.when(k % 29 == 0, F.concat_ws("|", *fields)).otherwise(F.concat_ws("|", *fields, sub))
    return o.select(k.alias("ord"), name.alias("id"), F.translate("o_orderpriority", ALPHABET, BASES_OF).alias("seq"))


RECORDS = f"""recs AS (SELECT o_orderkey AS ord, {sql_list(SEGMENTS)}[CAST(o_orderkey % 8 AS INT) + 1] AS segment, 'EPI_ISL_' || o_custkey AS id, o_orderkey % 29 = 0 AS malformed,
  CASE WHEN o_orderkey % 31 <> 0 THEN 'H' || (o_orderkey % 16 + 1) END AS h, CASE WHEN o_orderkey % 31 <> 0 THEN 'N' || (o_orderkey % 9 + 1) END AS n,
  translate(o_orderpriority, '{ALPHABET}', '{BASES_OF}') AS seq FROM orders),
grouped AS (SELECT *, CASE segment WHEN 'HA' THEN h WHEN 'NA' THEN n ELSE 'all' END AS grp FROM recs)"""


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as aligned sequences: ord, id, grp (language), seq, is_ref (the first of its group)."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    first = d.groupBy(F.col("lang").alias("_lang")).agg(F.min("doc_id").alias("_first"))  # a row per language, none among them, however many documents
    seq = F.translate("text", ALPHABET, BASES_OF)
    return d.join(F.broadcast(first), F.col("lang").eqNullSafe(F.col("_lang"))).select(F.col("doc_id").alias("ord"), F.concat(F.lit("EPI_ISL_"), F.col("doc_id").cast("string")).alias("id"), F.col("lang").alias("grp"), seq.alias("seq"), (F.col("doc_id") == F.col("_first")).alias("is_ref"))


ALIGNMENT = f"""msa AS (SELECT doc_id AS ord, 'EPI_ISL_' || doc_id AS id, lang AS grp, translate(text, '{ALPHABET}', '{BASES_OF}') AS seq,
  doc_id = min(doc_id) OVER (PARTITION BY lang) AS is_ref FROM documents WHERE text IS NOT NULL)"""


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, nation, customer as one tree: tree_id, node, parent, muts."""
    none = F.filter(F.array(F.struct(F.lit("A").alias("ref"), F.lit(1).alias("pos"), F.lit("C").alias("alt"))), lambda x: F.lit(False))
    base = lambda c: F.substr(F.lit("ACGT"), (c % 4 + 1).cast("int"), F.lit(1))
    mut = lambda k: F.struct(base(k).alias("ref"), (k % 50 + 1).cast("int").alias("pos"), base(k + 1).alias("alt"))
    edge = lambda df, node, parent, key, every: df.select(F.lit(1).alias("tree_id"), node.alias("node"), parent.alias("parent"), F.when(key % every == 0, none).otherwise(F.array(mut(key))).alias("muts"))
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    root = spark.range(1).select(F.lit(1).alias("tree_id"), F.lit("root").alias("node"), F.lit(None).cast("string").alias("parent"), none.alias("muts"))
    return (
        root.unionByName(edge(table(spark, sf_dir, "region"), name("r", "r_regionkey"), F.lit("root"), F.col("r_regionkey"), 2))
        .unionByName(edge(table(spark, sf_dir, "nation"), name("n", "n_nationkey"), name("r", "n_regionkey"), F.col("n_nationkey"), 3))
        .unionByName(edge(table(spark, sf_dir, "customer"), name("c", "c_custkey"), name("n", "c_nationkey"), F.col("c_custkey"), 5))
    )


def _mut(key: str, every: int) -> str:
    return f"CASE WHEN {key} % {every} = 0 THEN '' ELSE substr('ACGT', CAST({key} % 4 AS INT) + 1, 1) || ({key} % 50 + 1) || substr('ACGT', CAST(({key} + 1) % 4 AS INT) + 1, 1) END"


TREE = f"""edges AS (SELECT 'root' AS node, NULL AS parent, '' AS mut, 0 AS depth
  UNION ALL SELECT 'r' || r_regionkey, 'root', {_mut('r_regionkey', 2)}, 1 FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, {_mut('n_nationkey', 3)}, 2 FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, {_mut('c_custkey', 5)}, 3 FROM customer)"""


def leaf_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tree_id, node, state of each customer; every eleventh is unknown."""
    c = table(spark, sf_dir, "customer")
    m = F.create_map(*[F.lit(x) for kv in zip(MARKETS, STATES) for x in kv])
    return c.select(F.lit(1).alias("tree_id"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"), F.when(F.col("c_custkey") % 11 != 0, F.element_at(m, F.col("c_mktsegment"))).alias("state"))


def gene_features(spark: SparkSession) -> DataFrame:
    """GFF lines of a region with a plain gene, and a spliced one of two parts."""
    lines = [
        "##gff-version 3", "seg\tx\tgene\t4\t93\t.\t+\t.\tID=g1;Name=M1;gene=M1", "seg\tx\tCDS\t4\t33\t.\t+\t0\tID=c1;gene=M1;protein_id=P1",
        "seg\tx\tCDS\t64\t93\t.\t+\t0\tID=c3;gene=M2;protein_id=P2", "seg\tx\tCDS\t4\t24\t.\t+\t0\tID=c2;gene=M2;protein_id=P2", "not a line",
    ]
    return spark.createDataFrame(list(enumerate(lines)), "ord int, line string")


def consensus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as trees of one leaf each: leaf, tree (turn), seq."""
    c = table(spark, sf_dir, "conversations").where("text is not null")
    return c.select(F.col("conv_id").alias("leaf"), F.col("turn").alias("tree"), F.translate("text", ALPHABET, BASES_OF).alias("seq"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log texts, one per event: label, kind, text."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    seg = _pick(SEGMENTS, k)
    sub = F.when(seg == "HA", F.concat(F.lit("H"), (k % 5 + 1).cast("string"))).when(seg == "NA", F.concat(F.lit("N"), (k % 5 + 1).cast("string"))).otherwise("all")
    kind = F.when(k % 11 == 3, "merged").otherwise("individual")
    big = F.concat((k % 9 + 1).cast("string"), F.repeat(F.lit("0"), (k % 60).cast("int")))
    text = F.when(kind == "merged", F.format_string("x\nparsimony_min: score:%d\nparsimony_max: score:%d\ntree_count: %s\n", 1000 + k % 97, 2000 + k % 89, big)).otherwise(
        F.format_string("Min parsimony score in DAG: %d\nMax parsimony score in DAG: %d\nTotal trees in DAG: %s\n", 1000 + k % 83, 2000 + k % 79, big)
    )
    n = 1000 + k % 5000
    curated = F.format_string("Total sequences processed: %s\nPassed quality filters: %s\nFailed quality filters: %s\n", F.format_number(n, 0), F.format_number(n - k % 700, 0), F.format_number(k % 700, 0))
    return e.select(k.alias("event_id"), F.concat_ws("_", seg, sub).alias("label"), kind.alias("kind"), text.alias("text"), curated.alias("curated"))


LOGS = f"""log_rows AS (SELECT event_id AS k, {sql_list(SEGMENTS)}[CAST(event_id % 8 AS INT) + 1] AS seg FROM events),
labelled AS (SELECT k, seg || '_' || CASE seg WHEN 'HA' THEN 'H' || (k % 5 + 1) WHEN 'NA' THEN 'N' || (k % 5 + 1) ELSE 'all' END AS label,
  CASE WHEN k % 11 = 3 THEN 'merged' ELSE 'individual' END AS kind FROM log_rows)"""


