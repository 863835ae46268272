"""Benchmark decontamination with a distributed positional inverted index.

Test windows are looked up from their rarest terms: corpus frequencies of the
test terms are counted, the positions of the rarest ones are stored as postings,
the lists are intersected after subtracting each term's offset in the window,
and the documents that are left are compared word by word.  All of it is
DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import alnum_words, materialize


#: Sets of terms up to this count, checked before each join, are broadcast; larger ones are joined by a shuffle.
MAX_BROADCAST_TERMS = 500_000


#: Documents that may match are found again through so many hash buckets, the fixed bound of what is broadcast for it.
MATCH_BUCKETS = 1 << 20


@dataclass(frozen=True)
class IndexParams:
    """window words make one test window; rare of its terms must meet before words are compared; slop is for proximity matches.

    A document that matches many items is compared in rows of about
    items_per_row items, and for proximity in chunks of chunk_words words.
    """

    window: int = 13
    rare: int = 2
    slop: int = 5
    items_per_row: int = 1000
    chunk_words: int = 4096


def test_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, text_words): items with words; repeated rows once.  item is "i" and the id, or "" for a null id, so that joins keep it."""
    return items.select(F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("")).alias("item"), alnum_words(F.col(text_col)).alias("text_words")).where(F.size("text_words") > 0).distinct()


def listed(items):
    """Sorted ids of items; null ids aren't listed."""
    return F.sort_array(F.array_distinct(F.transform(F.filter(items, lambda i: i != ""), lambda i: F.substr(i, F.lit(2)))))


def term_frequencies(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(term, n): how often each test term stands in all documents; docs has _words."""
    terms = materialize(items.select(F.explode("text_words").alias("term")).distinct(), "test-terms")
    each = docs.select(F.explode("_words").alias("term"))
    if terms.count() <= MAX_BROADCAST_TERMS:
        seen = each.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    else:  # sums per task are shuffled, not words
        seen = each.groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(seen, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def anchors(items: DataFrame, frequencies: DataFrame, p: IndexParams) -> DataFrame:
    """(item, text_words, start, offset, term): the rarest positions of each window, by corpus frequency.

    Windows start at every word that has enough behind it; shorter items are one
    window.  offset counts from the item's first word.
    """
    each = items.select("item", "text_words", F.posexplode("text_words").alias("offset", "term")).join(frequencies, "term")
    start = F.explode(F.sequence(F.greatest(F.lit(0), F.col("offset") - p.window + 1), F.greatest(F.lit(0), F.least(F.col("offset"), F.size("text_words") - p.window))))
    order = W.partitionBy("item", "text_words", "start").orderBy("n", "term", "offset")  # a window's words at most
    return each.withColumn("start", start).withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= p.rare).select("item", "text_words", "start", "offset", "term")


def build_postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index: (term, _key, pos) of every occurrence of the terms, word numbers from 0; docs has _key and _words."""
    terms = F.broadcast(terms) if terms.count() <= MAX_BROADCAST_TERMS else terms
    return materialize(docs.select("_key", F.posexplode("_words").alias("pos", "term")).join(terms, "term", "left_semi"), "postings")


def phrase_candidates(postings: DataFrame, anchor: DataFrame, p: IndexParams) -> DataFrame:
    """(_key, item, diag): documents and items of which enough anchors meet after subtracting their offsets; diag is where the item would start."""
    places = anchor.groupBy("item", "offset", "term").agg(F.min(F.least(F.size("text_words"), F.lit(p.rare))).alias("need"))
    met = postings.join(places, "term").groupBy("_key", "item", (F.col("pos") - F.col("offset")).alias("diag")).agg(F.count("*").alias("_met"), F.min("need").alias("need"))
    return met.where("_met >= need").select("_key", "item", "diag")


def proximity_matches(postings: DataFrame, anchor: DataFrame, p: IndexParams) -> DataFrame:
    """(_key, item, start, at): all distinct anchor terms of a window within its length plus slop words, in any order; at is the first."""
    need = anchor.groupBy("item", "start").agg(F.countDistinct("term").alias("_need"))
    hits = postings.join(anchor.select("item", "start", "term").distinct(), "term").select("_key", "item", "start", "pos", "term")
    span = W.partitionBy("_key", "item", "start").orderBy("pos").rangeBetween(0, p.window + p.slop - 1)
    near = hits.withColumn("_terms", F.size(F.collect_set("term").over(span)))
    return near.join(need, ["item", "start"]).where("_terms = _need").groupBy("_key", "item", "start").agg(F.min("pos").alias("at"))


def near_candidates(postings: DataFrame, anchor: DataFrame, p: IndexParams) -> DataFrame:
    """(_key, item, _text, starts, pos): where the anchor terms of an item's windows, which begin at starts, meet from pos on.

    Windows with equal anchor terms are one; every proximity match holds such a place.
    """
    sets = anchor.groupBy("item", F.xxhash64("text_words").alias("_text"), "start").agg(F.sort_array(F.collect_set("term")).alias("_set"))
    sets = materialize(sets.groupBy("item", "_text", "_set").agg(F.sort_array(F.collect_list("start")).alias("starts")), "anchor-sets")
    hits = postings.join(sets.select("item", "_text", "starts", F.size("_set").alias("_need"), F.explode("_set").alias("term")), "term")
    span = W.partitionBy("_key", "item", "_text", "starts").orderBy("pos").rangeBetween(0, p.window + p.slop - 1)  # words of one document
    near = hits.withColumn("_terms", F.size(F.collect_set("term").over(span)))
    return near.where("_terms = _need").select("_key", "item", "_text", "starts", "pos")


def _near(words, test, starts, pos, p: IndexParams):
    """Whether all words of a window of the item that begins at one of starts stand, in any order, within its length plus slop around pos."""
    w = F.least(F.size(test), F.lit(p.window))
    reach = w + p.slop
    low = F.greatest(F.lit(0), pos - reach + 1)
    lacks = lambda i, at, n: F.size(F.array_except(F.slice(test, i + 1, w), F.slice(words, at + 1, n)))
    return F.exists(starts, lambda i: F.when(lacks(i, low, 2 * reach) == 0, F.exists(F.sequence(low, pos), lambda at: lacks(i, at, reach) == 0)).otherwise(False))


def near_matches(index: Index, p: IndexParams = IndexParams()) -> DataFrame:
    """(_key, near_items): items of which all words of a window stand in any order within the window's length plus slop words of the document.

    Exact matches are among them.  A word that a window has twice counts once.
    """
    chunk = F.floor(F.col("pos") / p.chunk_words).cast("int").alias("_chunk")
    found = near_candidates(index.postings, index.anchors, p).groupBy("_key", "item", "_text", chunk).agg(F.collect_list(F.struct("starts", "pos")).alias("_at"))
    tests = index.items.select("item", F.xxhash64("text_words").alias("_text"), "text_words")
    found = materialize(found.join(tests, ["item", "_text"]).drop("_text"), "near")
    bucket = F.pmod(F.xxhash64("_key"), F.lit(MATCH_BUCKETS)).alias("_bucket")
    some = F.broadcast(found.select(bucket).distinct())  # MATCH_BUCKETS rows at most
    reach = p.window + p.slop
    first = lambda c: F.greatest(F.lit(0), c * p.chunk_words - reach)
    last = F.floor(F.greatest(F.lit(0), F.size("_words") - 1) / p.chunk_words).cast("int")
    rows = index.words.select("_key", "_words", bucket).join(some, "_bucket", "left_semi").select("_key", "_words", F.explode(F.sequence(F.lit(0), last)).alias("_chunk"))
    rows = rows.select("_key", "_chunk", F.slice("_words", first(F.col("_chunk")) + 1, F.lit(p.chunk_words + 2 * reach)).alias("_words")).join(found, ["_key", "_chunk"])
    rows = rows.where(F.exists("_at", lambda a: _near(F.col("_words"), F.col("text_words"), a["starts"], a["pos"] - first(F.col("_chunk")), p)))
    return rows.groupBy("_key").agg(listed(F.collect_set("item")).alias("near_items"))


@dataclass
class Index:
    items: DataFrame
    anchors: DataFrame
    postings: DataFrame
    words: DataFrame  # the forward index: _key, n_words, _words


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows by id and text hash: repeated rows share a key and a result; other columns aren't read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))
    return docs.select(key.alias("_key"), alnum_words(text).alias("_words")).select("_key", F.size("_words").cast("long").alias("n_words"), "_words")


def build_index(docs: DataFrame, items: DataFrame, p: IndexParams = IndexParams(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> Index:
    tests = materialize(test_items(items, item_col, item_text_col), "test-items")
    rows = materialize(keyed(docs, id_col, text_col), "words")
    anchor = materialize(anchors(tests, materialize(term_frequencies(rows, tests), "term-frequencies"), p), "anchors")
    postings = build_postings(rows, materialize(anchor.select("term").distinct(), "anchor-terms"))
    return Index(tests, anchor, postings, rows)


def _matching(words, test, diag, p: IndexParams):
    """Word numbers of the document that lie in a window of the item, where both are laid over each other at diag."""
    n = F.size(test)
    w = F.least(n, F.lit(p.window))
    same = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(F.get(words, diag + i) == F.get(test, i), "1").otherwise("0")), "")
    starts = F.filter(F.sequence(F.lit(0), n - w), lambda i: F.substr(same, i + 1, w) == F.repeat(F.lit("1"), w))
    return F.flatten(F.transform(starts, lambda i: F.sequence(diag + i, diag + i + w - 1)))


def exact_matches(index: Index, p: IndexParams = IndexParams()) -> DataFrame:
    """(_key, n_hit, items): words of each matching document inside any window, and the items whose windows stand in it."""
    parts = max(1, index.items.count() // p.items_per_row)
    found = phrase_candidates(index.postings, index.anchors, p).join(index.items, "item")
    found = found.groupBy("_key", F.pmod(F.xxhash64("item"), F.lit(parts)).alias("_part")).agg(F.collect_list(F.struct("item", "text_words", "diag")).alias("_c"))
    found = materialize(found, "matches")
    bucket = F.pmod(F.xxhash64("_key"), F.lit(MATCH_BUCKETS)).alias("_bucket")
    some = F.broadcast(found.select(bucket).distinct())  # MATCH_BUCKETS rows at most
    rows = index.words.select("_key", "_words", bucket).join(some, "_bucket", "left_semi").join(found, "_key")
    hits = F.filter(F.transform("_c", lambda c: F.struct(c["item"].alias("item"), _matching(F.col("_words"), c["text_words"], c["diag"], p).alias("at"))), lambda c: F.size(c["at"]) > 0)
    rows = rows.select("_key", hits.alias("_c")).where(F.size("_c") > 0)
    rows = rows.select("_key", F.array_distinct(F.flatten(F.transform("_c", lambda c: c["at"]))).alias("at"), F.array_distinct(F.transform("_c", lambda c: c["item"])).alias("items"))
    rows = rows.groupBy("_key").agg(F.flatten(F.collect_list("at")).alias("at"), F.flatten(F.collect_list("items")).alias("items"))  # word numbers of one document
    return rows.select("_key", F.size(F.array_distinct("at")).cast("long").alias("n_hit"), listed(F.col("items")).alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, p: IndexParams = IndexParams(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", near: bool = True) -> DataFrame:
    """(id, _h, n_words, n_hit, items, contaminated, near_items) of every row of docs.

    near_items, left out without near, are the proximity matches; they don't make a document contaminated.

    Null and empty texts have no words and are clean; items without words have
    no windows; items with a null id match but aren't listed; repeated rows get equal results, by id and text; very
    long texts are read whole; an empty table of documents gives no rows, one of
    items no hits; other columns aren't read.
    """
    index = build_index(docs, items, p, id_col, text_col, item_col, item_text_col)
    hits = materialize(exact_matches(index, p).dropDuplicates(["_key"]), "hits")
    out = index.words.select("_key", "n_words").join(hits, "_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    none = F.array().cast("array<string>")
    cols = [F.col("_key.id").alias(id_col), F.col("_key.h").alias("_h"), "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated")]
    if near:
        out = out.join(materialize(near_matches(index, p), "near-items"), "_key", "left")
        cols.append(F.coalesce("near_items", none).alias("near_items"))
    return out.select(*cols)
