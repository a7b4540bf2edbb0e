"""What the vector searches share: usable rows, bounded samples, pivots, merging of partial answers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(df: DataFrame, id_col: str, vector_col: str, not_zero: bool) -> DataFrame:
    """vec_id and vector (array<double>), one row per identifier, of the prevailing length.

    Null vectors and those with null or non-finite components are left out, and
    zero vectors if ``not_zero``. Of rows that share an identifier the largest
    vector counts. Vectors of another than the most frequent length are left out.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & sound)
    if not_zero:
        rows = rows.where(F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    rows = rows.where(F.size("vector") == (lengths[0] if lengths else 0))
    return rows.groupBy("vec_id").agg(F.max("vector").alias("vector"))


def sample(rows: DataFrame, most: int) -> np.ndarray:
    """The vectors of at most ``most`` rows, those whose identifiers hash lowest."""
    table = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("vector").toArrow()
    return matrix(table.column("vector").combine_chunks())


def matrix(vectors: pa.Array) -> np.ndarray:
    n = len(vectors)
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's centres of a sample; empty centres keep their place."""
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = nearest(points, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, weights=points[:, d], minlength=len(centres)) for d in range(points.shape[1])], axis=1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray, chunk: int = 1 << 14) -> np.ndarray:
    half = (centres * centres).sum(axis=1) / 2
    parts = [np.argmax(points[a : a + chunk] @ centres.T - half, axis=1) for a in range(0, len(points), chunk)]
    return np.concatenate([*parts, np.empty(0, np.int64)]).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to smaller identifiers, in order."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def merged(partial: DataFrame, k: int) -> DataFrame:
    """The k best of the partial answers (query_id, vec_id, score) of every query, ranked from 1."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

