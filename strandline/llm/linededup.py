"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches, the largest ids first.  The distinct lines of a batch
are merge-anti-joined with the runs: lines that the runs already know to be
frequent add nothing, the others become a sorted run of their own.  As soon as a
level holds `fanout` runs they are compacted into one run of the next level.

Main path: DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, scratch_path

#: Stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"

KEY = ["h1", "h2"]


@dataclass(frozen=True)
class LineParams:
    """Keys of min_chars code points or more that stand in min_docs documents or more are dropped but for the last document."""

    min_chars: int = 20
    min_docs: int = 3
    batches: int = 8
    fanout: int = 4


class LineRuns:
    """Levels of sorted runs (h1, h2, n, last): a key's documents, counted until it is known to be frequent, and the largest id among them.

    n is exact below min_docs and at least min_docs otherwise; last is always
    exact, as an entry is only left out where the runs know its key with as
    large an id.
    """

    def __init__(self, p: LineParams):
        self.p = p
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, entries: DataFrame) -> None:
        """Take in a batch's entries (h1, h2, n, last), a key once."""
        if self.runs():
            known = reduce(DataFrame.unionByName, self.runs()).where(F.col("n") >= self.p.min_docs).select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("last").alias("_last"))
            same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & (F.col("last").isNull() | (F.col("_last") >= F.col("last")))
            entries = entries.join(known.hint("merge"), same, "left_anti")
        self._put(0, materialize(entries.sortWithinPartitions(*KEY), "run"))

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        here = self.levels[level]
        here.append(run)
        if len(here) == self.p.fanout:
            merged = materialize(self._merged(here).sortWithinPartitions(*KEY), "run")
            discard(*here)
            here.clear()
            self._put(level + 1, merged)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        if len(runs) == 1:
            return runs[0]
        return reduce(DataFrame.unionByName, runs).groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def frequent(self) -> DataFrame:
        """(h1, h2, last) of the keys that stand in min_docs documents or more."""
        return self._merged(self.runs()).where(F.col("n") >= self.p.min_docs).select(*KEY, "last")


def folded(line: Column) -> Column:
    """A text that two lines share if and only if they are equal but for the case of A-Z.

    The line's bytes are read as one character each and lower-cased: that folds
    A-Z, and of other letters' bytes only the leading ones, which the number of
    bytes behind them still tells apart.  Hashing the lines of 10,000 documents
    takes 1.5 s; with translate(), and a sort by a lambda, it took 2.7 s.
    """
    return F.lower(F.decode(line.cast("binary"), "ISO-8859-1"))


def _hashed(text: Column, p: LineParams) -> Column:
    """A text's long lines as an array of (h1, h2, pos), in order of their hashes."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    keys = F.transform(lines, lambda x: F.when(F.length(x) >= p.min_chars, folded(x)))
    each = F.transform(keys, lambda k, i: F.when(k.isNotNull(), F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"), i.alias("pos"))))
    return F.sort_array(F.filter(each, lambda x: x.isNotNull()))


def hashed_lines(docs: DataFrame, p: LineParams, id_col: str, text_col: str) -> DataFrame:
    """(_doc, _text, h1, h2, pos, first, _batch), a row per long line; first: the text's first line with that key; _batch: 0 has the largest ids."""
    bounds = [b for b in docs.agg(F.percentile_approx(id_col, [i / p.batches for i in range(1, p.batches)])).first()[0] or []]
    batch = reduce(lambda a, b: a + b, [(F.coalesce(F.col(id_col) <= b, F.lit(True))).cast("int") for b in bounds], F.lit(0))
    text = F.coalesce(F.col(text_col), F.lit(""))
    one = docs.select(F.col(id_col).alias("_doc"), F.xxhash64(text).alias("_text"), batch.alias("_batch"), F.array(_hashed(text, p)).alias("_all"))
    # The outer array of one holds the lines, so that a lambda can name them without making them again.
    before = lambda a, i: F.get(a, i - 1)
    marked = F.transform("_all", lambda a: F.transform(a, lambda x, i: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["pos"].alias("pos"), ((i == 0) | (before(a, i)["h1"] != x["h1"]) | (before(a, i)["h2"] != x["h2"])).alias("first"))))
    return one.select("_doc", "_text", "_batch", F.inline(F.get(marked, F.lit(0))))


def _kept(text: Column, gone: Column) -> Column:
    """text without the lines at the sorted positions gone: the stretches between them, joined."""
    none = F.lit(-1)
    join = lambda s: F.array_join(F.flatten(F.zip_with(F.concat(F.array(none), gone), F.concat(gone, F.array(F.size(s))), lambda a, b: F.slice(s, a + 2, b - a - 1))), "\n")
    return F.get(F.transform(F.array(F.split(text, "\n")), join), F.lit(0))


def dedup_lines(docs: DataFrame, p: LineParams = LineParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept): every row's text without the lines that min_docs documents share.

    A frequent key's lines stay in the document with the largest id only, all of
    them, and in every row with that id.  Each row is a document of its own, also
    when rows repeat.  Null ids come before all others; a null or empty text is
    one empty line; very long texts are handled whole; a text that loses all
    lines is empty; an empty table gives no rows.  Equal 128-bit hashes count as
    equal lines.  Other columns are not read.
    """
    path = scratch_path(docs.sparkSession, "lines")
    hashed_lines(docs, p, id_col, text_col).write.option("compression", "zstd").partitionBy("_batch").parquet(path)
    lines = docs.sparkSession.read.schema(f"_doc {docs.schema[id_col].dataType.simpleString()}, _text long, h1 long, h2 long, pos int, first boolean, _batch int").parquet(path)
    lines._scratch_path = path
    runs = LineRuns(p)
    for b in range(p.batches):
        runs.add(lines.where((F.col("_batch") == b) & F.col("first")).groupBy(*KEY).agg(F.count("*").alias("n"), F.max("_doc").alias("last")))
    frequent = materialize(runs.frequent(), "frequent")
    discard(*runs.runs())
    # Merge joins at every size: a frequent line's rows are split by skew, and texts are shuffled once, never broadcast against.
    goes = lines.join(frequent.hint("merge"), KEY).where(~F.col("_doc").eqNullSafe(F.col("last")))
    gone = materialize(goes.groupBy("_doc", "_text").agg(F.sort_array(F.collect_set("pos")).alias("_gone")), "dropped-lines")
    discard(lines, frequent)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_whole"))
    out = rows.join(gone.hint("merge"), F.col("_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("_whole") == F.col("_text")), "left")
    n_lines = F.length("_whole") - F.length(F.translate("_whole", "\n", "")) + 1
    return out.select(F.col("_id").alias(id_col), n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"), F.when(F.col("_gone").isNull(), F.col("_whole")).otherwise(_kept(F.col("_whole"), F.col("_gone"))).alias("kept"))
