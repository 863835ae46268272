"""Centroid clustering by plain Lloyd rounds on integer vectors.

Every round broadcasts the centroids, a bounded table, and each task adds up its
own vectors by nearest centroid; only these sums are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Scaled components lie within this, so that a squared distance of 64 components fits a long.
LIMIT = 1 << 27


@dataclass(frozen=True)
class LloydParams:
    """seed goes into the hash that picks the first centroids."""

    centroids: int = 40
    dimensions: int = 64
    rounds: int = 5
    scale: int = 256
    seed: int = 2


@dataclass(frozen=True)
class Clustering:
    """assigned: id, cluster, distance, a row per kept vector; centroids: cluster, centroid, size, cluster_inertia, inertia, a row each."""

    assigned: DataFrame
    centroids: DataFrame


def scaled(vectors: DataFrame, p: LloydParams = LloydParams(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec): the vectors of the right length without null or non-finite components, as integers floor(scale * x)."""
    x = F.col(vec_col).cast("array<double>")
    good = (F.size(vec_col) == p.dimensions) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.least(F.greatest(v * p.scale, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    return vectors.where(good).select(F.col(id_col).alias("id"), whole.alias("vec"))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, its squared distance) of each row; of equal ones the lowest number."""
    far = np.empty((len(x), len(centroids)), np.int64)
    for c, at in enumerate(centroids):
        d = x - at
        far[:, c] = np.einsum("ij,ij->i", d, d)
    best = far.argmin(axis=1)
    return best, far[np.arange(len(x)), best]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.int64)


def first_centroids(rows: DataFrame, p: LloydParams) -> list[list[int]]:
    """The vectors with the smallest hashes of `seed:id`, in that order; the bound is a parameter, the rows come by a top-k."""
    mark = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [r.vec for r in rows.select(mark.alias("mark"), "vec").orderBy("mark", "vec").limit(p.centroids).collect()]


def one_round(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after every vector went to its nearest: floored means; those without vectors stay."""
    k, dims = len(centroids), len(centroids[0])
    shared = rows.sparkSession.sparkContext.broadcast(np.array(centroids, np.int64))

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for frame in frames:
            if len(frame):
                x = _matrix(frame["vec"])
                to, _ = nearest(x, shared.value)
                np.add.at(total, to, x)
                n += np.bincount(to, minlength=k)
        some = np.flatnonzero(n)
        if len(some):
            yield pd.DataFrame({"cluster": some.astype(np.int32), "n": n[some], "s": [total[c] for c in some]})

    parts = rows.select("vec").mapInPandas(sums, "cluster int, n long, s array<long>")
    # Sums of sums may pass a long; a decimal holds them.
    added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("s", F.lit(i)).cast("decimal(38,0)")) for i in range(dims)]).alias("s"))
    out = list(centroids)
    for r in added.collect():  # a row per centroid at most
        out[r.cluster] = [int(v) // r.n for v in r.s]
    shared.unpersist()
    return out


def cluster(vectors: DataFrame, p: LloydParams = LloydParams(), id_col: str = "vec_id", vec_col: str = "embedding") -> Clustering:
    """Lloyd's clustering of all kept vectors.

    Vectors of another length, null ones and those with a null, NaN or infinite
    component are left out.  Repeated rows count each; rows without an id hash
    as an empty one; equal hashes are ordered by their vector.  With fewer
    vectors than centroids all of them start one; ties of distance go to the
    lower number.  An empty table gives no rows.  Components beyond 2**27 after
    scaling count as that much, as no long would hold their distances; an
    inertia that no long holds is null.  Other columns are not read.
    """
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType
    rows = materialize(scaled(vectors, p, id_col, vec_col), "vectors")
    at = first_centroids(rows, p)
    for _ in range(p.rounds if at else 0):
        at = one_round(rows, at)
    shared = spark.sparkContext.broadcast(np.array(at, np.int64))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                to, far = nearest(_matrix(frame["vec"]), shared.value)
                yield pd.DataFrame({"id": frame["id"], "cluster": to.astype(np.int32), "distance": far})

    # Ids travel as text: pandas would turn numbers with nulls among them into floats.
    told = rows.select(F.col("id").cast("string").alias("id"), "vec").mapInPandas(assign, "id string, cluster int, distance long")
    assigned = materialize(told.select(F.col("id").cast(kind).alias(id_col), "cluster", "distance"), "assigned")
    sizes = assigned.groupBy("cluster").agg(F.count("*").alias("size"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("_i"))
    found = {r["cluster"]: (r["size"], int(r["_i"])) for r in sizes.collect()}
    fits = lambda v: v if v < 1 << 63 else None
    total = fits(sum(i for _, i in found.values()))
    table = [(c, [int(v) for v in at[c]], found.get(c, (0, 0))[0], fits(found.get(c, (0, 0))[1]), total) for c in range(len(at))]
    return Clustering(assigned, spark.createDataFrame(table, "cluster int, centroid array<long>, size long, cluster_inertia long, inertia long"))
