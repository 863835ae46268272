"""A corpus pipeline of five stages, each applying one operator to all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontam, njoin, quality, secrets
from strandline.llm.common import materialize, read_table, release, scratch_path, written
from strandline.llm.queries import packed

#: Near copies in this stage share 80 % of their five-word shingles.
NEAR_COPIES = njoin.JoinParams(words=5, percent=80, short=64, sampled=0.33)

_SCRATCH: dict[str, list[str]] = {}


#: Rows that may go are found again through so many hash buckets, the fixed bound of what is broadcast for it.
BUCKETS = 1 << 20


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """(docs with a key column, its name): the id (null ones last) and a hash of the text; what it doesn't tell apart gets one verdict."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    key = [F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")]
    return docs.withColumn(name, F.struct(*key)), name


def _bucket(row: str) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(BUCKETS)).cast("int")


def _parted(docs: DataFrame, keys: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose bucket holds no key, the others): only the others, with their texts, need a shuffle to be told apart."""
    some = F.broadcast(keys.select(_bucket(row).alias("_b")).distinct())  # BUCKETS rows at most
    there = _bucket(row) == some["_b"]
    return docs.join(some, there, "left_anti"), docs.join(some, there, "left_semi")


def _without(docs: DataFrame, gone: DataFrame, row: str) -> DataFrame:
    """docs but the rows whose key is in gone."""
    gone = materialize(gone.select(F.col(row)).distinct(), "gone")
    clear, maybe = _parted(docs, gone, row)
    return clear.unionByName(maybe.join(gone, docs[row] == gone[row], "left_anti"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules, or their host's verdict, reject go; null and short texts among them.

    Rows are judged one by one, whatever their ids: each is stored with its
    measures, hosts are judged by sums of these, and only rows whose host shares
    a bucket with a rejected one are joined with the rejected hosts; the others'
    texts stay where they are.  A null source is a host of its own; very long
    texts are measured whole; an empty table stays empty.
    """
    rules = quality.HostRules()
    rows = docs.select(F.struct("*").alias("row"), "text", "source")
    measures = materialize(quality.measure(rows, "row"), "quality")
    bad = materialize(quality.host_verdicts(measures, rules).where("not host_kept").select("_host"), "rejected-hosts")
    clear, maybe = _parted(measures.where(~quality.base_failed(rules)).select(F.col("_id").alias("row"), "_host"), bad, "_host")
    return clear.unionByName(maybe.join(bad, "_host", "left_anti")).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked rows the one with the smallest id, then text hash, stays; of rows with one id and text, one.

    Rows without words link with nothing and stay; so do different texts under
    one id that aren't linked.  Null ids come last; very long texts are compared
    whole; an empty table stays empty; other columns go through.
    """
    rows, row = _keyed(docs)
    found = materialize(njoin.join_components(rows, NEAR_COPIES, id_col=row).where("n_shingles > 0"), "linked")
    first = F.col(row) == F.col("component_id")
    repeated = materialize(found.where(first).groupBy(row).agg(F.count("*").alias("k")).where("k > 1").select(row), "repeated")
    out = _without(rows, found.where(~first), row)
    if not repeated.isEmpty():
        clear, maybe = _parted(out, repeated, row)
        again = maybe[row] == repeated[row]
        out = clear.unionByName(maybe.join(repeated, again, "left_anti")).unionByName(maybe.join(repeated, again, "left_semi").dropDuplicates([row]))
    return out.drop(row)


def keep_clean_of_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated rows go, with all their copies and only those that share both id and text.

    Null texts and an empty benchmark are clean; very long texts are searched
    whole; an empty table stays empty; other columns go through.
    """
    rows, row = _keyed(docs)
    found = decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), near=False).where("contaminated")
    gone = found.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_h").alias("h")).alias(row))
    return _without(rows, gone, row).drop(row)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become a mark; the documents stay, null and empty texts and an empty table as they are."""
    return secrets.redact(docs, secrets.train(docs))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in training sequences; a null text is a piece of one end mark.

    Repeated rows give their own pieces, very long texts several; an empty table gives none.
    """
    return packed(docs)


def _stage(f: Callable) -> Callable:
    """f, which first deletes what the stage before it left in the scratch area: its result is stored by then."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        release(spark, _SCRATCH.pop(app, []))
        before = set(written(spark))
        out = f(spark, docs, sf_dir)
        _SCRATCH[app] = [p for p in written(spark) if p not in before]
        return out

    run_stage.__name__, run_stage.__doc__ = f.__name__, f.__doc__
    return run_stage


STAGES = [
    ("quality", _stage(keep_quality)),
    ("near_copies", _stage(keep_one_of_each)),
    ("decontamination", _stage(keep_clean_of_tests)),
    ("secrets", _stage(without_secrets)),
    ("packing", _stage(into_sequences)),
]

#: Packing, the network and the components can't be written in SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each result stored as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    old = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if old:
            release(spark, [old])
        old = path
    return docs
