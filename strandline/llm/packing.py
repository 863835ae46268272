"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become token ids, long ones are cut into full pieces, and the other
pieces are dealt at random into blocks of bounded size.  On each block several
islands evolve packings: crossover injects whole well-filled bins of one parent
into the other, dissolves the bins that hold their items twice, and best-fits
the displaced pieces.  Between epochs each island's elite migrates to the next.
"""

from __future__ import annotations

import base64
import heapq
import json
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, held, materialize, sliced


@dataclass(frozen=True)
class PackParams:
    """block_items bounds what one task holds; the rest is the search's size.

    generations: crossovers of an island in each epoch.  inject, mutate: bins
    that one takes over, and others that it dissolves, at most.  tries: items
    that are tried as the first of three that fill a room.
    """

    capacity: int = 2048
    block_items: int = 8192
    islands: int = 2
    epochs: int = 2
    population: int = 6
    generations: int = 1000
    inject: int = 3
    mutate: int = 4
    tries: int = 16
    well_filled: float = 0.995
    dissolve_below: float = 0.98
    seed: int = 5


# --- token ids ---------------------------------------------------------------------------------------------------

#: A text with two blanks in a row, or one before another white space or at an end, has chunks that don't stand alone.
_ODD = r" (?:[\s\p{Z}\x0b\x1c-\x1f\x{85}]|$)|^ "
#: Where a long text may be cut: before a single blank between visible characters.
_CUT = re.compile(r"\S (?=\S)")
#: Bytes of text whose chunks are in memory at once.
SLICE_BYTES = 6 << 20
SECTION_CHARS = 2_000_000


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


class ChunkEncoder:
    """Ids of many texts at once: each distinct blank-delimited chunk of a slice is encoded once.

    ranks_path names the same vocabulary as ranks; with it, chunks are encoded
    by the faster library, to the same ids.

    A byte-level BPE of this family never joins what stands before a single
    blank with what follows it, so chunks between blanks have the ids that they
    have in the whole text.  Texts for which that can't be told, and those that
    hold a special token's string, are encoded whole.  Nothing is kept between
    calls, so memory follows the slice.
    """

    def __init__(self, path: str, ranks_path: str | None = None):
        self.path, self.loaded = path, None
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.plain = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
            self.bytes_of[list(ranks.values())] = [len(x) for x in ranks]
            self.plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @property
    def tokenizer(self):
        """Loaded when the first text needs it."""
        if self.loaded is None:
            from tokenizers import Tokenizer

            self.loaded = Tokenizer.from_file(self.path)
        return self.loaded

    def whole(self, text: str) -> np.ndarray:
        if self.plain is not None and not any(s in text for s in self.special):
            return np.array(self.plain(text), np.uint32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def long(self, text: str, end_id: int) -> np.ndarray:
        """Ids of a text of any length, by sections that begin at blanks between visible characters."""
        cuts, at = [0], SECTION_CHARS
        while at < len(text) and (m := _CUT.search(text, at)):
            cuts.append(m.start() + 1)
            at = cuts[-1] + SECTION_CHARS
        cuts.append(len(text))
        parts = [self.encode(pa.array([text[a + (a > 0) : b]]), None, a > 0)[0] for a, b in zip(cuts, cuts[1:])]
        return np.append(_joined(parts), np.uint32(end_id))

    def encode(self, texts: pa.Array, end_id: int | None, after_blank: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of each text and end_id, one text after another; null texts are empty."""
        n, lead = len(texts), " " if after_blank else ""
        end = [] if end_id is None else [end_id]
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        if self.plain is None:
            odd = pa.array([True] * n)
        lists = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        flat, at = lists.flatten(), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        body = np.ones(len(flat), bool)
        body[at[:-1]] = False
        chunks = flat.filter(pa.array(body)).dictionary_encode()
        ids, lengths = self._of_chunks(chunks.dictionary)
        if lengths is None:
            odd, at, chunks_at = pa.array([True] * n), np.arange(n + 1), np.zeros(0, np.int64)
            ids, lengths, body = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(n, bool)
        else:
            chunks_at = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = flat.take(pa.array(at[:-1])).to_pylist() if lengths is not None and n else []
        heads = [self.whole(lead + t.as_py()) if o and len(t.as_py()) + after_blank else np.array(self.plain(lead + h) if h or after_blank else [], np.uint32) if not o else np.zeros(0, np.uint32) for t, o, h in zip(texts, odd.to_pylist(), firsts or [""] * n)]
        # One table of ids: chunks, then heads, then the end; each text is a head, its chunks and the end.
        table = _joined([ids, *heads, np.array(end, np.uint32)])
        size = np.concatenate([lengths, [len(h) for h in heads], [len(end)]]).astype(np.int64)
        start, k = np.cumsum(size) - size, len(lengths)
        entry = np.zeros(int(at[-1]) + n, np.int64)
        first, last = at[:-1] + np.arange(n), at[1:] + np.arange(n)
        inner = np.ones(len(entry), bool)
        inner[first] = inner[last] = False
        entry[first], entry[last], entry[inner] = k + np.arange(n), k + n, chunks_at
        counts = size[entry]
        ends = np.cumsum(counts)
        out = table[np.repeat(start[entry] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return out, np.concatenate([[0], ends[last]]) if n else np.zeros(1, np.int64)

    def _of_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
        """(ids, how many of each) of distinct chunks, each behind a blank, in one call; token byte lengths tell where each ends."""
        if not len(chunks):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), " ")[0].as_py()
        ids = np.array(self.plain(" " + text), np.uint32)
        reach, ends = np.cumsum(self.bytes_of[ids]), np.cumsum(pc.binary_length(chunks).to_numpy().astype(np.int64) + 1)
        last = np.searchsorted(reach, ends)
        if not np.array_equal(reach[last], ends):  # a token across a blank: not a vocabulary of this family
            return ids, None
        return ids, np.diff(last, prepend=-1)


def tokenize(docs: DataFrame, path: str | None = None, ranks_path: str | None = None, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Pieces of each document: id, piece, start, length and ids (little-endian unsigned 32-bit).

    A document is its ids and end_id; null and empty texts are end_id alone.
    Only longer ones than capacity are cut, from the end, so the first piece may
    be shorter.  Very long texts are encoded by sections.  Repeated rows give
    their own pieces, an empty table none, other columns aren't read.
    """
    if path is None:
        path, ranks_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(("encoder", path, ranks_path), lambda: ChunkEncoder(path, ranks_path))
        for batch in sliced(batches, 1, SLICE_BYTES):
            if batch.num_rows == 1 and batch.column(1).nbytes > SLICE_BYTES:
                ids = encoder.long(batch.column(1)[0].as_py() or "", end_id)
                at = np.array([0, len(ids)])
            else:
                ids, at = encoder.encode(batch.column(1), end_id)
            n = np.diff(at)
            k = -(-n // capacity)
            rows = np.repeat(np.arange(len(n)), k)
            piece = np.arange(len(rows)) - np.repeat(np.cumsum(k) - k, k)
            first = ((n - 1) % capacity + 1)[rows]
            start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
            cuts = np.append(at[rows] + start, at[-1]) * 4
            data = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(np.where(piece == 0, first, capacity), pa.int64()), data.cast(pa.binary())], ["_id", "piece", "start", "length", "ids"])

    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, piece int, start long, length long, ids binary")
    return out.withColumnRenamed("_id", id_col)


# --- the search on one block -------------------------------------------------------------------------------------


class _Bins:
    """Open bins by room, so that the best fit is the lowest set bit of a mask."""

    def __init__(self, capacity: int):
        self.rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, b: int, room: int) -> None:
        self.rooms[room].append(b)
        self.mask |= 1 << room

    def take(self, length: int) -> tuple[int, int]:
        """(bin, its room) of the best fit, taken out; (-1, 0) if none is wide enough."""
        m = self.mask >> length
        if not m:
            return -1, 0
        room = length + (m & -m).bit_length() - 1
        b = self.rooms[room].pop()
        if not self.rooms[room]:
            self.mask ^= 1 << room
        return b, room


def best_fit(lens: list[int], order: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """bins with the items of order put into the fullest bin that takes each, in that order."""
    open_, bins = _Bins(capacity), [list(b) for b in bins]
    for i, b in enumerate(bins):
        open_.add(i, capacity - sum(lens[x] for x in b))
    for x in order:
        b, room = open_.take(lens[x])
        if b < 0:
            b, room = len(bins), capacity
            bins.append([])
        bins[b].append(x)
        open_.add(b, room - lens[x])
    return bins


def lower_bound(lens: np.ndarray, capacity: int) -> int:
    """The larger of the volume bound and the bounds that count items too large to share a bin apart, for every limit k."""
    count = np.bincount(lens, minlength=capacity + 1)
    n, volume = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    half = capacity // 2
    k = np.arange(half + 1)
    big = n[-1] - n[capacity - k]  # longer than capacity - k
    mid, mid_volume = n[capacity - k] - n[half], volume[capacity - k] - volume[half]
    small = volume[half] - np.where(k > 0, volume[k - 1], 0)  # from k to half
    return int((big + mid + np.maximum(0, -(-(small - (mid * capacity - mid_volume)) // capacity))).max())


def quality(bins: list[list[int]], lens: list[int], capacity: int) -> tuple[int, int]:
    """Sorts packings: fewer bins, then fills as unequal as can be."""
    return len(bins), -sum(sum(lens[x] for x in b) ** 2 for b in bins)


class _Free:
    """Displaced items by length; two masks of the lengths there are, one reversed, find items that fill a room exactly."""

    def __init__(self, items: list[int], lens: list[int], capacity: int):
        self.capacity, self.by = capacity, {}
        for i in items:
            self.by.setdefault(lens[i], []).append(i)
        self.mask = sum(1 << n for n in self.by)
        self.back = sum(1 << (capacity - n) for n in self.by)

    def take(self, n: int) -> int:
        here = self.by[n]
        if len(here) == 1:
            del self.by[n]
            self.mask ^= 1 << n
            self.back ^= 1 << (self.capacity - n)
            return here[0]
        return here.pop()

    def put(self, n: int, item: int) -> None:
        if n not in self.by:
            self.by[n] = []
            self.mask |= 1 << n
            self.back |= 1 << (self.capacity - n)
        self.by[n].append(item)

    def pair(self, room: int, rng: random.Random) -> int:
        """A length of which another item's fills the rest of room; 0 if there is none."""
        m = self.mask & (self.back >> (self.capacity - room))
        if room % 2 == 0 and m >> room // 2 & 1 and len(self.by[room // 2]) < 2:
            m ^= 1 << room // 2
        if not m:
            return 0
        high = m >> rng.randrange(room)
        return (m.bit_length() - high.bit_length()) + (high & -high).bit_length() - 1 if high else m.bit_length() - 1

    def fill(self, room: int, rng: random.Random, tries: int) -> list[int]:
        """Items for a room: one, two or three that fill it exactly, else the longest that fits and so on."""
        out = []
        while room and self.mask & ((2 << room) - 1):
            if self.mask >> room & 1:
                return [*out, self.take(room)]
            a = self.pair(room, rng)
            if a:
                return [*out, self.take(a), self.take(room - a)]
            rest, left = self.mask & ((1 << room) - 1), tries
            while rest and left:
                n = rest.bit_length() - 1
                rest ^= 1 << n
                left -= 1
                item = self.take(n)
                a = self.pair(room - n, rng)
                if a:
                    return [*out, item, self.take(a), self.take(room - n - a)]
                self.put(n, item)
            n = (self.mask & ((1 << room) - 1)).bit_length() - 1
            out.append(self.take(n))
            room -= n
        return out


def refill(items: list[int], lens: list[int], p: PackParams, rng: random.Random) -> list[list[int]]:
    """Bins of the items, each around the longest that is left."""
    free, out = _Free(items, lens, p.capacity), []
    while free.mask:
        n = free.mask.bit_length() - 1
        first = free.take(n)
        out.append([first, *free.fill(p.capacity - n, rng, p.tries)])
    return out


class Packing:
    """Bins with their fills, the bin of each item, the bins with room, and the sum of squared fills; a child changes a copy of them."""

    def __init__(self, bins: list[list[int]], lens: list[int], capacity: int):
        self.bins = bins
        self.fills = [sum(lens[i] for i in b) for b in bins]
        self.where = [0] * len(lens)
        for k, b in enumerate(bins):
            for i in b:
                self.where[i] = k
        self.loose = {k for k, f in enumerate(self.fills) if f < capacity}
        self.squares = sum(f * f for f in self.fills)

    def copy(self) -> Packing:
        new = object.__new__(Packing)
        new.bins, new.fills, new.where, new.loose, new.squares = self.bins[:], self.fills[:], self.where[:], set(self.loose), self.squares
        return new

    @property
    def quality(self) -> tuple[int, int]:
        return len(self.bins), -self.squares

    def set(self, k: int, items: list[int], fill: int, capacity: int) -> None:
        """Put a bin at number k, the next one or one that is no longer needed there."""
        if k == len(self.bins):
            self.bins.append(items)
            self.fills.append(fill)
        else:
            self.squares -= self.fills[k] ** 2
            self.bins[k], self.fills[k] = items, fill
        self.squares += fill * fill
        for i in items:
            self.where[i] = k
        (self.loose.add if fill < capacity else self.loose.discard)(k)

    def replace(self, gone: set[int], made: list[list[int]], lens: list[int], capacity: int) -> None:
        """Put the bins made in the place of those gone; where they are fewer, the last bins move up."""
        free = sorted(gone, reverse=True)
        for items in made:
            self.set(free.pop() if free else len(self.bins), items, sum([lens[i] for i in items]), capacity)
        for k in free:  # the highest first, so what moves into its place stays
            last = len(self.bins) - 1
            self.squares -= self.fills[k] ** 2
            self.fills[k] = 0
            if k < last:
                self.set(k, self.bins[last], self.fills[last], capacity)
                self.squares -= self.fills[last] ** 2
            self.bins.pop()
            self.fills.pop()
            self.loose.discard(last)


def crossover(a: Packing, b: Packing, lens: list[int], p: PackParams, rng: random.Random) -> Packing:
    """A child of b into which some well-filled bins of a are injected whole.

    Bins of b that hold their items twice are dissolved, and with them its
    emptiest bins and a few others (mutation).  The displaced items fill bins
    exactly as far as that works; those of the emptiest new bin are best-fitted
    into what is left of the others.
    """
    take, inside = [], set()
    for _ in range(4 * p.inject):
        x = rng.randrange(len(a.bins))
        if a.fills[x] >= p.well_filled * p.capacity and inside.isdisjoint(a.bins[x]):
            take.append(a.bins[x])
            inside.update(a.bins[x])
        if len(take) >= p.inject:
            break
    gone = {b.where[i] for i in inside}
    gone.update(heapq.nsmallest(1 + rng.randrange(p.mutate), b.loose, key=b.fills.__getitem__))
    gone.update(rng.randrange(len(b.bins)) for _ in range(rng.randrange(p.mutate)))
    made = refill([i for k in gone for i in b.bins[k] if i not in inside], lens, p, rng)
    if made:
        fill = [sum([lens[i] for i in x]) for x in made]
        least = min(range(len(made)), key=fill.__getitem__)
        rest = [x for k, x in enumerate(made) if k != least and fill[k] < p.capacity]
        made = [x for k, x in enumerate(made) if fill[k] == p.capacity] + (best_fit(lens, sorted(made[least], key=lens.__getitem__, reverse=True), rest, p.capacity) if fill[least] < p.capacity else rest)
    child = b.copy()
    child.replace(gone, take + made, lens, p.capacity)
    return child


def evolve(lens: list[int], p: PackParams, seed: int, migrant: list[list[int]] | None = None) -> list[list[int]]:
    """The best packing that one island finds; it ends early at the lower bound."""
    rng = random.Random(seed)
    down = sorted(range(len(lens)), key=lens.__getitem__, reverse=True)
    people = [Packing(best_fit(lens, down, [], p.capacity), lens, p.capacity)] + ([Packing(migrant, lens, p.capacity)] if migrant else [])
    least = lower_bound(np.array(lens), p.capacity)
    if min(x.quality for x in people)[0] > least:
        while len(people) < p.population:
            people.append(Packing(refill(down, lens, p, rng), lens, p.capacity))
        for _ in range(p.generations):
            i, j = rng.sample(range(len(people)), 2)
            child = crossover(people[i], people[j], lens, p, rng)
            if child.quality <= people[j].quality:
                people[j] = child
                if child.quality[0] <= least:
                    break
    return min(people, key=lambda x: x.quality).bins


def _as_bins(numbers: list[int]) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for i, b in enumerate(numbers):
        out.setdefault(b, []).append(i)
    return list(out.values())


# --- islands on blocks -------------------------------------------------------------------------------------------

_STATE = "block long, island int, n_bins int, score double, bin array<int>, offset array<int>, fill array<int>"


def _epoch(states: DataFrame, p: PackParams, epoch: int) -> DataFrame:
    """states: block, island, lens, migrant (bin numbers of the items, or null)."""

    ints = pa.list_(pa.int32())
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), ints, ints, ints)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # one block at a time becomes Python's
                block, island, lens, migrant = (c[row].as_py() for c in batch.columns)
                bins = evolve(lens, p, p.seed + 1000 * epoch + 10 * island + 7919 * block % 1_000_003, _as_bins(migrant) if migrant else None)
                number, offset, fill = [0] * len(lens), [0] * len(lens), [0] * len(lens)
                for b, items in enumerate(bins):
                    at = 0
                    for i in items:
                        number[i], offset[i] = b, at
                        at += lens[i]
                    for i in items:
                        fill[i] = at
                found = (block, island, *quality(bins, lens, p.capacity), number, offset, fill)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(found, kinds)], ["block", "island", "n_bins", "score", "bin", "offset", "fill"])
        give_back()

    return states.select("block", "island", "lens", "migrant").mapInArrow(run, _STATE)


def _pack_blocks(items: DataFrame, p: PackParams, n_blocks: int, name: str) -> DataFrame:
    """items (_row, length, ...) with block, bin, offset and fill."""
    cols = items.columns
    dealt = items.withColumn("block", F.pmod(F.xxhash64("_row", F.lit(p.seed)), F.lit(n_blocks)))
    blocks = materialize(dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("_row", *[c for c in cols if c != "_row"]))).alias("items")), name)
    lens = blocks.select("block", F.transform("items", lambda x: x["length"].cast("int")).alias("lens"))
    islands = lens.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(p.islands - 1))))
    elites = None
    for epoch in range(p.epochs):
        if elites is None:
            states = islands.withColumn("migrant", F.lit(None).cast("array<int>"))
        else:  # each elite moves on to the next island of its block
            moved = elites.select("block", F.pmod(F.col("island") + 1, F.lit(p.islands)).cast("int").alias("island"), F.col("bin").alias("migrant"))
            states = islands.join(moved, ["block", "island"], "left")
        elites = materialize(_epoch(states, p, epoch), f"{name}-elites")
    best = elites.groupBy("block").agg(F.min_by(F.struct("bin", "offset", "fill"), F.struct("n_bins", "score", "island")).alias("best"))
    rows = blocks.join(best, "block").select("block", F.inline(F.arrays_zip(F.col("items"), F.col("best.bin").alias("bin"), F.col("best.offset").alias("offset"), F.col("best.fill").alias("fill"))))
    return rows.select("block", *[F.col("items")[c].alias(c) for c in cols], "bin", "offset", "fill")


def pack(pieces: DataFrame, p: PackParams = PackParams(), length_col: str = "length") -> DataFrame:
    """pieces with sequence_id and offset: each sequence holds p.capacity tokens at most, without gaps.

    Pieces of full length stand alone.  The rest is dealt into blocks by row
    number, so repeated rows and hot documents spread evenly; bins that a block
    left underfull are dissolved and packed again with those of other blocks,
    if that makes them fewer.
    An empty table gives no rows; pieces longer than the capacity are an error.
    Columns named sequence_id or offset are replaced.
    """
    cols = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    inner = [f"_c{i}" for i in range(len(cols))]
    table = materialize(pieces.select(*[F.col(c).alias(i) for c, i in zip(cols, inner)], F.assert_true(F.col(length_col).between(1, p.capacity)).cast("string").alias("_ok"), F.col(length_col).alias("length"), F.monotonically_increasing_id().alias("_row")).drop("_ok"), "pieces")
    full = table.where(F.col("length") == p.capacity).select(*inner, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = table.where(F.col("length") < p.capacity)
    n = items.count()
    if not n:
        return full.select(*[F.col(i).alias(c) for c, i in zip(cols, inner)], "sequence_id", "offset")
    first = materialize(_pack_blocks(items, p, max(1, -(-n // p.block_items)), "blocks"), "packed")
    shape = lambda df, level: df.select(*inner, ((F.col("block") * 2 + level) * (1 << 20) + F.col("bin")).alias("sequence_id"), F.col("offset").cast("long").alias("offset"))
    is_loose = F.col("fill") < p.dissolve_below * p.capacity
    m = first.where(is_loose).count() if n > p.block_items else 0
    packed = shape(first, 0)
    if m:
        bins = lambda df: df.where("offset = 0").count()
        loose = first.where(is_loose)
        again = materialize(_pack_blocks(loose.select(*items.columns), p, max(1, -(-m // p.block_items)), "loose"), "packed-again")
        if bins(again) < bins(loose):
            packed = shape(first.where(~is_loose), 0).unionByName(shape(again, 1))
    return packed.unionByName(full).select(*[F.col(i).alias(c) for c, i in zip(cols, inner)], "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and ids: the training sequences themselves, from placed pieces with their ids (binary)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most a capacity of tokens each
    return placed.groupBy("sequence_id").agg(parts.alias("_p")).select("sequence_id", F.aggregate("_p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
