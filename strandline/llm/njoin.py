"""N-gram Jaccard join by multiple global orders.

A document is its set of word shingles, as 64-bit hashes; equal sets are one
class.  Two classes that link must share a token among their first ones under
every global order, so candidates share prefix tokens under several orders at
once, and must agree in length, before their whole sets are compared.  The
orders put rare tokens first, so a token of one document only never leaves the
document's counts, and a common passage stands behind them.

A first pass over sampled tokens finds the few classes that can link at all; the
prefix filter is then applied to their whole sets.  Only components are wanted,
so pairs inside a component that is already known are never made: rounds compare each class with one hub per shared token, links
are contracted, and the last round makes every pair that is still open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, give_back, materialize, sliced

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
#: Random values of the 256 bytes, and odd bases, of two polynomial hashes of words.
_BYTES = np.random.default_rng(20).integers(0, 2**64, (2, 256), np.uint64)
_BASES = _MIX[:2] | np.uint64(1)
#: Bytes of text whose words are in memory at once.
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class JoinParams:
    """Link when 100 * intersection >= percent * union of sets of `words`-word shingles.

    short: sets up to this size are joined on all their tokens; larger ones on
    the tokens whose hash is in the first `sampled` of all hashes, which come
    before the others in every order (their other tokens follow by hash).
    orders: global orders that a candidate must pass.  hubs: sets per token that
    a round compares the others with.  hub_rounds bounds the
    linear rounds before the last one, which makes all open pairs.  rare: tokens
    of up to so many sets are told from common ones.
    """

    words: int = 4
    percent: int = 85
    short: int = 128
    sampled: float = 0.25
    orders: int = 3
    hubs: int = 3
    hub_rounds: int = 6
    rare: int = 16


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[1]
    h = (h ^ (h >> np.uint64(29))) * _MIX[2]
    return h ^ (h >> np.uint64(32))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of strings: two polynomials over random byte values, mixed together."""
    words = words.cast(pa.large_string())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data, n = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0] : at[-1]], np.diff(at)
    full = np.flatnonzero(n)
    start = (at - at[0])[:-1][full]
    place = np.arange(len(data)) - np.repeat(start, n[full])
    out = n.astype(np.uint64) * _MIX[3]
    for values, base in zip(_BYTES, _BASES):
        powers = np.full(int(n.max(initial=0)) + 1, base)
        powers[0] = 1
        sums = np.zeros(len(n), np.uint64)
        if len(full):
            sums[full] = np.add.reduceat(values[data] * np.cumprod(powers)[place], start)
        out = _mixed(out ^ sums)
    return out


def _shingled(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k successive ones of the word hashes w."""
    n = len(w) - k + 1
    h = np.full(n, k * int(_MIX[7]) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(k):
        h = (h ^ (h >> np.uint64(29))) * _MIX[(i + 3) % 8] + w[i : i + n] * _MIX[i % 8]
    return _mixed(h)


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; words are split, and distinct ones hashed, for all texts at once."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, at = lists.flatten(), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    real = pc.binary_length(words).to_numpy() > 0  # white space at an end leaves an empty word
    names = words.dictionary_encode()
    w = word_hashes(names.dictionary)[names.indices.to_numpy(zero_copy_only=False)][real] if len(words) else np.zeros(0, np.uint64)
    at = np.concatenate([[0], np.cumsum(real)])[at]
    h = _shingled(w, k) if len(w) >= k else np.zeros(0, np.uint64)
    return [np.unique(h[a : b - k + 1] if b - a >= k else _shingled(w[a:b], b - a) if b > a else w[:0]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def set_digest(h: np.ndarray) -> bytes:
    """128-bit name of a set of hashes."""
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def _half(digest: bytes, side: int = 0) -> int:
    """Half of a digest; its lowest bit is the side of the index, 0 in the name of the class."""
    return int.from_bytes(digest[:8], "little", signed=True) & ~1 | side


def need_of(n: np.ndarray | int, percent: int):
    """Shared tokens that any linked set of size >= need shares with a set of size n."""
    return -(-percent * n // 100)


def _emit(h: np.ndarray, p: JoinParams) -> list[tuple[np.ndarray, int]]:
    """(tokens, side) of what a set puts into the index, for the short (0) and the long side (1); a token's lowest bit is its side."""
    n = len(h)
    out = []
    if 0 < n <= p.short * 100 // p.percent + 1:
        out.append((h & ~np.uint64(1), 0))
    if n > p.short:
        first = n - int(need_of(n, p.percent)) + 1
        inside = int(np.searchsorted(h, np.uint64(int(p.sampled * 2.0**64))))
        out.append((h[: max(inside, first)] | np.uint64(1), 1))  # sorted: sampled hashes first, then the others by hash
    return out


def shingle(docs: DataFrame, p: JoinParams, id_col: str, text_col: str) -> DataFrame:
    """(_id, n, set, half, room): the size and the 128-bit digest of each row's set, null for the empty set, half of the digest, and what _room says."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1, SLICE_BYTES):
            sets = shingle_sets(batch.column(1), p.words)
            names = [set_digest(h) if len(h) else None for h in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(h) for h in sets], pa.int64()), pa.array(names, pa.binary()), pa.array([x and _half(x) for x in names], pa.int64()), pa.array([_room(h, p) for h in sets], pa.list_(pa.int64()))], ["_id", "n", "set", "half", "room"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, n long, set binary, half long, room array<long>")


def _room(h: np.ndarray, p: JoinParams) -> list[int | None]:
    """Of the short and the long side: how much longer a set's prefix is than what it puts into the index; null where it puts nothing there."""
    out: list[int | None] = [None, None]
    for tokens, side in _emit(h, p):
        out[side] = len(h) - int(need_of(len(h), p.percent)) + 1 - len(tokens)
    return out


def index_rows(docs: DataFrame, p: JoinParams, text_col: str) -> DataFrame:
    """(half, tokens): what each class puts into the index, the side being half's lowest bit; a task leaves out sets that it has just given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[bytes] = set()
        for batch in sliced(batches, 0, SLICE_BYTES):
            halves, tokens = [], []
            for h in shingle_sets(batch.column(0), p.words):
                if not len(h):
                    continue
                d = set_digest(h)
                if d in given:
                    continue
                if len(given) > 100_000:
                    given.clear()
                given.add(d)
                for x, side in _emit(h, p):
                    halves.append(_half(d, side))
                    tokens.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(halves, pa.int64()), _arrays(tokens)], ["half", "tokens"])

    return docs.select(F.col(text_col).alias("_text")).mapInArrow(run, "half long, tokens array<long>")


def candidates(rows: DataFrame, classes: DataFrame, p: JoinParams) -> DataFrame:
    """(half): classes that share a prefix token, of the tokens in the index, with another class.

    Every token row is shuffled once, with nothing but half of its class's
    digest; the whole digest tells classes apart from the next step on, and of
    classes with one half the longest prefix is taken.  Only tokens of two
    classes or more go on from there; those of one class are just counted, being
    first in the order.
    """
    each = rows.select("half", F.explode("tokens").alias("token")).repartition("token").dropDuplicates(["token", "half"])
    shared = each.withColumn("df", F.count("*").over(W.partitionBy("token"))).where("df > 1")
    lists = shared.groupBy("half").agg(F.collect_list(F.struct("df", "token")).alias("t"))
    room = classes.select("half", F.posexplode("room").alias("side", "room")).where("room is not null")
    room = room.groupBy((F.col("half") + F.col("side")).alias("half")).agg(F.max("room").alias("room"))
    lists = lists.join(room, "half").withColumn("r", (F.col("room") + F.size("t")).cast("int")).where("r > 0")
    first = F.slice(F.sort_array("t"), F.lit(1), F.col("r"))
    posts = lists.select(F.col("half").bitwiseAND(F.lit(-2)).alias("half"), F.explode(F.transform(first, lambda x: x["token"])).alias("token"))
    posts = materialize(posts, "sampled-prefixes")
    many = posts.groupBy("token").agg(F.count("*").alias("_c")).where("_c > 1").select("token")
    near = materialize(posts.join(many, "token", "left_semi").select("half").distinct(), "candidates")
    discard(posts)
    return near


def prefixes(sets: DataFrame, p: JoinParams) -> DataFrame:
    """(set, n, lo, alone, p0, p1, ...): prefix tokens of each candidate under every order, now from its whole set.

    p0 is an array of (token, hi): with lo, the sizes of partners that may share
    it as their first token.  Tokens of no other candidate can't be shared.  If
    the first shared token is in more than p.rare sets, no rarer one is shared
    either, which leaves much less for large partners.
    """
    each = sets.select("at", F.explode("hashes").alias("token")).repartition("token")
    shared = each.withColumn("df", F.count("*").over(W.partitionBy("token"))).where("df > 1")
    lists = shared.groupBy("at").agg(F.collect_list(F.struct("df", "token")).alias("t"), F.count_if(F.col("df") > p.rare).cast("int").alias("common"))
    lists = lists.join(sets.select("at", "set", "n"), "at")
    lo = F.ceil(F.col("n") * p.percent / 100).cast("int")
    hi = lambda left: F.least(F.floor(F.col("n") * 100 / p.percent), F.floor(left * (100 + p.percent) / p.percent) - F.col("n")).cast("int")
    lists = lists.withColumn("lo", lo).withColumn("r", F.size("t") - F.col("lo") + 1).where("r > 0")
    lists = lists.withColumn("_hi", hi(F.size("t"))).withColumn("_hi_common", hi(F.col("common")))
    # The first order is by frequency; the others are by hash within ever wider bands of frequency, so they agree in little but that rare tokens come first.
    band = lambda k, df: df if k == 0 else F.floor(F.log2(df) / (k + 1))
    rank = lambda k: F.slice(F.sort_array(F.transform("t", lambda x: F.struct(band(k, x["df"]), F.xxhash64(x["token"], F.lit(k)), x["token"].alias("token")))), F.lit(1), F.col("r"))
    p0 = F.filter(F.transform(rank(0), lambda x: F.struct(x["token"].alias("token"), F.when(x["df"] > p.rare, F.col("_hi_common")).otherwise(F.col("_hi")).alias("hi"))), lambda x: x["hi"] >= F.col("lo"))
    alone = F.round(1 - F.col("common") / F.col("n"), 2)  # share of tokens that few other candidates have
    return lists.select("set", "n", "lo", alone.alias("alone"), p0.alias("p0"), *[F.transform(rank(k), lambda x: x["token"]).alias(f"p{k}") for k in range(1, p.orders)]).where(F.size("p0") > 0)


# --- components --------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component, for all nodes of edges (a, b); alternating large and small stars."""
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        old, now = now, materialize(small, "stars")
        discard(old)
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(row):
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        mark = tuple(row)


# --- the join ----------------------------------------------------------------------------------------------------

_BITS = 23


def _bitmap(ids: DataFrame) -> bytes:
    """2**_BITS bits, one set for each id's hash: the fixed bound of what is sent to all tasks, whatever the number of ids."""
    at = F.pmod(F.xxhash64("_id"), F.lit(1 << _BITS))
    rows = ids.select((at + 1).alias("_b")).groupBy(F.bitmap_bucket_number("_b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_b")).alias("bits")).collect()
    out = bytearray((1 << _BITS) // 8)
    for r in rows:
        start = (r["k"] - 1) * 4096
        out[start : start + 4096] = bytes(r["bits"])
    return bytes(out)


def _arrays(rows: list[np.ndarray]) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum([len(x) for x in rows])]) if rows else [0]
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)))


def full_sets(docs: DataFrame, wanted: DataFrame, p: JoinParams, id_col: str, text_col: str) -> DataFrame:
    """(set, n, hashes) of the classes in wanted (set, _id), from their documents; the bitmap only spares work."""
    bits = _bitmap(wanted)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.frombuffer(bits, np.uint8)
        for batch in batches:
            at = batch.column(1).to_numpy(zero_copy_only=False)
            yield batch.take(pa.array(np.flatnonzero(mine[at // 8] >> (at % 8).astype(np.uint8) & 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(chosen(batches), 0, SLICE_BYTES):
            found = [h for h in shingle_sets(batch.column(0), p.words) if len(h)]
            yield pa.RecordBatch.from_arrays([pa.array([set_digest(h) for h in found], pa.binary()), pa.array([len(h) for h in found], pa.int32()), _arrays(found)], ["set", "n", "hashes"])

    rows = docs.select(F.col(text_col).alias("_text"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << _BITS)).alias("_b"))
    found = rows.mapInArrow(run, "set binary, n int, hashes array<long>").join(wanted.select("set"), "set", "left_semi")
    return found.groupBy("set").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes"))


def _verify(pairs: DataFrame, sets: DataFrame, p: JoinParams) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (u, i), (v, j) = ((c.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(c).to_numpy())])) for c in (batch.column(2), batch.column(3)))
            keep = []
            for k in range(batch.num_rows):
                x, y = u[i[k] : i[k + 1]], v[j[k] : j[k + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= p.percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])
        give_back()

    pairs = materialize(pairs.select("a", "b"), "passed")  # what few pairs are left can be sent to the sets, not the sets to them
    of = lambda c, to: sets.select(F.col("set").alias(c), F.col("hashes").alias(to)).join(pairs.select(c).distinct(), c, "left_semi")
    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def _pass_orders(pairs: DataFrame, table: DataFrame, p: JoinParams) -> DataFrame:
    """Pairs (a, b) that share prefix tokens under the other orders too."""
    if p.orders < 2:
        return pairs
    more = [f"p{k}" for k in range(1, p.orders)]
    left = table.select(F.col("set").alias("a"), *[F.col(c).alias(f"a_{c}") for c in more])
    right = table.select(F.col("set").alias("b"), *[F.col(c).alias(f"b_{c}") for c in more])
    out = pairs.join(left, "a").join(right, "b")
    for c in more:
        out = out.where(F.arrays_overlap(f"a_{c}", f"b_{c}"))
    return out.select("a", "b")


def _relabel(labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """labels (set, label) after the components of the links' labels became one."""
    of = lambda c: labels.select(F.col("set").alias(c), F.col("label").alias(f"l{c}"))
    merged = components(links.join(of("a"), "a").join(of("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
    return materialize(labels.join(merged.select(F.col("node").alias("label"), F.col("label").alias("_new")), "label", "left").select("set", F.coalesce("_new", "label").alias("label")), name)


def link_classes(docs: DataFrame, classes: DataFrame, p: JoinParams, id_col: str, text_col: str) -> DataFrame | None:
    """(set, label) of the classes that may link with others; None where there are none."""
    near = candidates(index_rows(docs, p, text_col), classes, p)
    wanted = materialize(classes.join(near, "half", "left_semi").select("set", F.col("rep").alias("_id")), "wanted")
    if wanted.isEmpty():
        return None
    # Stored numbers of the sets are half as long as their names.
    sets = materialize(full_sets(docs, wanted, p, id_col, text_col).withColumn("at", F.monotonically_increasing_id()), "sets")
    table = materialize(prefixes(sets, p), "prefixes")
    posts = materialize(table.select("set", "n", "lo", "alone", F.inline("p0")), "postings")
    labels = table.select("set", F.col("set").alias("label"))
    fits = F.col("na").between(F.col("lob"), F.col("hib")) & F.col("nb").between(F.col("loa"), F.col("hia"))
    tested, settled, n_classes = None, False, table.count()
    for turn in range(p.hub_rounds + 1):
        rows = posts.join(labels, "set")
        # A row stays open where its token has another component, and a set of a size that it can link with.
        seen = rows.groupBy("token").agg(F.min("label").alias("_a"), F.max("label").alias("_z"), F.min("n").alias("_lo"), F.max("n").alias("_hi")).where("_a != _z")
        rows = materialize(rows.join(seen, "token").where("lo <= _hi and hi >= _lo").select("token", "set", "n", "lo", "hi", "alone", "label"), "open")
        size = rows.groupBy("token", "label").agg(F.count("*").alias("c")).groupBy("token").agg(F.sum("c").alias("s"), F.sum(F.col("c").cast("double") * F.col("c")).alias("q")).agg(F.sum("s").alias("rows"), F.sum((F.pow("s", F.lit(2)) - F.col("q")) / 2).alias("pairs")).first()
        if not size["pairs"]:
            break
        last = settled or turn == p.hub_rounds or size["pairs"] <= 4 * size["rows"] + 1000
        side = lambda c: rows.select("token", F.col("set").alias(c), *[F.col(x).alias(x + c) for x in ("n", "lo", "hi", "label")])
        ordered = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        if last:
            pairs = side("a").join(side("b"), "token").where("labela < labelb").where(fits).select(*ordered).distinct()
        else:
            # Hubs are the most central sets, those with the fewest tokens of their own; some per token, so rows stay in proportion.
            part = F.pmod(F.xxhash64("set", F.lit(-turn)), F.lit(p.hubs))
            hub = rows.groupBy("token", part.alias("_p")).agg(F.min(F.struct(F.when(F.lit(turn % 2 == 0), F.col("alone")).otherwise(0.0).alias("_s"), F.xxhash64("set", F.lit(turn)).alias("_h"), F.col("set").alias("b"), *[F.col(x).alias(x + "b") for x in ("n", "lo", "hi", "label")])).alias("_hub")).select("token", *[f"_hub.{x}b" for x in ("", "n", "lo", "hi", "label")])
            pairs = side("a").join(hub, "token").where("labela != labelb").where(fits).select(*ordered).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        links = materialize(_verify(_pass_orders(pairs, table, p), sets, p), "links")
        found, old = links.count(), labels
        labels = _relabel(labels, links, "labels")
        discard(rows, links, old)
        if last:
            break
        settled = found * 50 < n_classes  # hubs find little more: what is open now is there to be refuted
        tested = pairs if tested is None else tested.unionByName(pairs)
    return labels


def join_components(docs: DataFrame, p: JoinParams = JoinParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for each row of docs: the smallest id that links reach.

    Texts with fewer words than a shingle have the whole sequence as their only
    one; null texts, and those without words, have none and link with nothing,
    so their component is their own id.  Repeated rows and equal sets are one
    class and never compared.  An empty table gives no rows; other columns
    aren't read.  Long texts are read whole, alone.  Sets are compared by 64-bit
    hashes of their shingles; classes are 128-bit digests.
    """
    rows = materialize(shingle(docs, p, id_col, text_col), "classes")
    classes = rows.where(F.col("set").isNotNull()).groupBy("set").agg(F.first("half").alias("half"), F.first("room").alias("room"), F.min("_id").alias("rep"), F.count("*").alias("k"))
    classes = materialize(classes, "reps")
    labels = link_classes(docs, classes, p, id_col, text_col)
    if labels is None:
        found = classes.where("k > 1").select("set", F.col("rep").alias("_component"))
    else:
        named = classes.join(labels, "set", "left").withColumn("label", F.coalesce("label", "set"))
        ids = named.groupBy("label").agg(F.min("rep").alias("_component"), F.sum("k").alias("_k")).where("_k > 1")
        found = named.join(ids, "label").select("set", "_component")
    found = materialize(found, "component-ids")  # sets in components of several rows only
    out = rows.join(found, "set", "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("_component", "_id").alias("component_id"))
