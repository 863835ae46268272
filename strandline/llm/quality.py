"""Quality rules with host-level verdicts.

Each document is measured alone; failures of each rule are then summed by host,
every host's failure rates are shrunk towards empirical beta priors, one a rule,
and the host's verdict is joined back to its documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import materialize, sliced

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: White space that ends a word: the blank and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class HostRules:
    """min_words and max_repeat_pct decide base failures; the others are counted against the host only.

    A host goes where it is certain, by `z` standard deviations of its posterior,
    that the odds of failing some rule are over max_odds times those of all
    documents, and that at least least_rate of its documents fail it: where fewer
    do, the others are worth keeping.
    """

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbols_pct: int = 10
    max_dup_line_pct: int = 30
    z: float = 3.0
    max_odds: float = 4.0
    least_rate: float = 0.3


def measure_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of one whole text."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split on exactly the blanks above
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeated = 0
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) < len(grams):
        times, end = Counter(grams), 0
        for i, gram in enumerate(grams):
            if times[gram] > 1:
                repeated += i + 3 - max(end, i)
                end = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    for batch in sliced(batches, 2, 8 << 20):
        rows = [measure_text(t) for t in batch.column(2).to_pylist()]
        cols = list(zip(*rows)) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in cols)], ["_id", "_host", *names])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row of measures per row of docs (_id, _host and the counts); a null host is the empty one."""
    narrow = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("_host"), F.col(text_col).alias("_text"))
    counts = StructType.fromDDL(f"_host string, {MEASURES}, n_lines long")
    return narrow.mapInArrow(_measure_batches, StructType([narrow.schema["_id"], *counts.fields]))


def base_failed(rules: HostRules) -> Column:
    return (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))


def failures(rules: HostRules) -> dict[str, Column]:
    """Whether a document fails each rule, or any of them."""
    each = {
        "short": F.col("n_words") < rules.min_words,
        "repeats": 100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > rules.max_symbols_pct * F.col("n_words"),
        "lines": 100 * F.col("n_dup_lines") > rules.max_dup_line_pct * F.greatest(F.col("n_lines"), F.lit(1)),
    }
    return each | {"any": each["short"] | each["repeats"] | each["symbols"] | each["lines"]}


#: Weight of a prior where hosts differ by no more than chance: every rate is the overall one.
CERTAIN = 1e18


def beta_prior(n: int, f: int, k: int, f2: float, n2: float) -> tuple[float, float]:
    """(mean, weight) by moments: the overall rate, and a weight from how much the rates of k hosts differ beyond chance.

    n and f are the documents and the failures, f2 and n2 the sums over hosts of
    failures^2 / documents and documents^2.
    """
    m = (f + 0.5) / (n + 1.0)
    scale = n - n2 / n if n else 0.0
    between = (f2 - f * f / n - (k - 1) * m * (1 - m)) / scale if k > 1 and scale > 0 else 0.0
    return m, max(2.0, m * (1 - m) / between - 1) if between > 0 else CERTAIN


def host_verdicts(measures: DataFrame, rules: HostRules) -> DataFrame:
    """host, n_docs, n_<rule>, rate_<rule> (shrunk) and host_kept, one row per host."""
    failed = failures(rules)
    sums = [F.sum(c.cast("long")).alias(f"n_{name}") for name, c in failed.items()]
    hosts = materialize(measures.groupBy("_host").agg(F.count("*").alias("n_docs"), *sums), "hosts")
    moments = [F.sum("n_docs").alias("n"), F.count("*").alias("k"), F.sum(F.pow(F.col("n_docs"), F.lit(2))).alias("n2")]
    for name in failed:
        moments += [F.sum(f"n_{name}").alias(f"f_{name}"), F.sum(F.pow(F.col(f"n_{name}"), F.lit(2)) / F.col("n_docs")).alias(f"f2_{name}")]
    row = hosts.agg(*moments).first()  # one row of sums
    kept = F.lit(True)
    for name in failed:
        m, weight = beta_prior(row["n"] or 0, row[f"f_{name}"] or 0, row["k"], row[f"f2_{name}"] or 0.0, row["n2"] or 0.0)
        rate = (F.col(f"n_{name}") + F.lit(m * weight)) / (F.col("n_docs") + F.lit(weight))
        least = rate - rules.z * F.sqrt(rate * (1 - rate) / (F.col("n_docs") + F.lit(weight + 1)))
        limit = max(rules.least_rate, rules.max_odds * m / (1 - m + rules.max_odds * m))
        hosts = hosts.withColumn(f"rate_{name}", rate)
        kept = kept & (least <= limit)
    return hosts.withColumn("host_kept", kept)


def judge(docs: DataFrame, rules: HostRules = HostRules(), id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Measures, base_failed, kept, host, its shrunk rate of any failure and host_kept for every row of docs.

    Null and empty texts have no words and fail; long texts are measured whole.
    Repeated rows and ids are judged row by row, an empty table gives none, and
    other columns of docs are neither read nor returned.  Only the measures are
    stored and shuffled; sums by host are combined map-side, so a host with a
    third of all rows is no hot key, and the join reads the host table, which
    Spark broadcasts only below its own size threshold (beyond it, AQE splits
    the skewed side of the sort-merge join).
    """
    measures = materialize(measure(docs, id_col, text_col, host_col), "quality")
    hosts = host_verdicts(measures, rules)
    out = measures.join(hosts.select("_host", F.col("rate_any").alias("host_rate"), "host_kept"), "_host", "left")
    failed = base_failed(rules)
    return out.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("host_kept")).alias("kept"), F.col("_host").alias("host"), "host_rate", "host_kept")
