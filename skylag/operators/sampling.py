"""Exact-size reproducible samples without a global sort.

Rows are ranked by the md5 of their identifier and the seed. Counting rows per
leading digits of that hash shows in which digit bucket the wanted rank falls;
the bucket is narrowed until few rows are left, and the row at the wanted rank
becomes the cut-off. The sample itself is then a plain filter: no join, no
shuffle, and the same rows again after a lost executor.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import require

_DIGITS = 3
_HASH_LENGTH = 32
COUNT_SINGLY = 5_000


def hash_key(id_column: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f"|{seed}")))


def _prefix_counts(rows: DataFrame, key: Column, digits: int, *extra: Column) -> list:
    prefix = F.substring(key, 1, digits).alias("prefix")
    counted = rows.groupBy(prefix).agg(F.count(F.lit(1)).alias("n"), *extra).collect()
    if any(r["prefix"] is None for r in counted):
        raise ValueError("the identifier of a sampled row is NULL")
    return sorted(counted, key=lambda r: r["prefix"])


def _narrow(rows: DataFrame, id_column: str, key: Column, counts: list[tuple[str, int]], n: int) -> Column:
    """Filter for the first ``n`` rows by (hash, identifier); 0 < n < rows."""
    before, digits = 0, _DIGITS
    while True:
        for prefix, size in counts:
            if before + size >= n:
                break
            before += size
        need = n - before
        if need == size:
            return F.substring(key, 1, digits) <= prefix
        bucket = rows.where(F.substring(key, 1, digits) == prefix)
        if size <= COUNT_SINGLY:
            first = bucket.select(key.alias("k"), F.col(id_column).alias("i")).orderBy("k", "i").limit(need + 1).collect()
            last, following = first[need - 1], first[need]
            if (last["k"], last["i"]) == (following["k"], following["i"]):
                raise ValueError(f"{id_column} is not unique")
            # most rows are told by the first test, which hashes them once
            return (key <= last["k"]) & ((key < last["k"]) | (F.col(id_column) <= F.lit(last["i"])))
        digits += _DIGITS
        if digits > _HASH_LENGTH:
            raise ValueError(f"{id_column} is not unique")
        counts = [(r["prefix"], r["n"]) for r in _prefix_counts(bucket, key, digits)]


def first_rows(
    df: DataFrame, id_column: str, size: int | Callable[[int], int], seed: int
) -> Column:
    """Filter that keeps ``size`` rows; a callable gets the row count."""
    require(df, [id_column])
    key = hash_key(id_column, seed)
    counts = [(r["prefix"], r["n"]) for r in _prefix_counts(df, key, _DIGITS)]
    total = sum(n for _, n in counts)
    n = size(total) if callable(size) else size
    if n >= total or n <= 0:
        return F.lit(n > 0)
    return _narrow(df, id_column, key, counts, n)


def capped_sample(df: DataFrame, id_column: str = "FLIGHT_ID", max_rows: int = 100_000, seed: int = 42) -> DataFrame:
    """At most ``max_rows`` rows without replacement."""
    return df.where(first_rows(df, id_column, max_rows, seed))


def mark_split(
    df: DataFrame, id_column: str = "FLIGHT_ID", test_size: float = 0.2, seed: int = 48, name: str = "part"
) -> DataFrame:
    """Label every row ``train`` or ``test``; ceil(test_size * n) rows are test."""
    chosen = first_rows(df, id_column, lambda n: math.ceil(round(test_size * n, 9)), seed)
    return df.withColumn(name, F.when(chosen, "test").otherwise("train"))


def train_test_split(
    df: DataFrame, id_column: str = "FLIGHT_ID", test_size: float = 0.2, seed: int = 48
) -> tuple[DataFrame, DataFrame]:
    """The two disjoint parts of :func:`mark_split`."""
    marked = mark_split(df, id_column, test_size, seed, "_part")
    return tuple(marked.where(F.col("_part") == part).drop("_part") for part in ("train", "test"))


def balance_by_delay(
    df: DataFrame, id_column: str = "FLIGHT_ID", delay: str = "ARR_DELAY", seed: int = 48
) -> DataFrame:
    """All non-zero delays and as many zero delays, or all zeros if fewer.

    A missing delay counts as non-zero.
    """
    require(df, [id_column, delay])
    zero = F.coalesce(F.col(delay) == 0, F.lit(False))
    key = hash_key(id_column, seed)
    counted = _prefix_counts(df, key, _DIGITS, F.count_if(zero).alias("zeros"))
    zeros = [(r["prefix"], r["zeros"]) for r in counted if r["zeros"]]
    available = sum(n for _, n in zeros)
    other = sum(r["n"] for r in counted) - available
    if other >= available:
        return df
    if other == 0:
        return df.where(~zero)
    return df.where(~zero | _narrow(df.where(zero), id_column, key, zeros, other))
