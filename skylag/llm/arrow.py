"""Arrow and numpy helpers that the operators share inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shared_dir

SLICE_BYTES = 8 << 20
NARROW_SLICE = 2 << 20  # for steps that keep many times their texts
WIDE_SLICE = 24 << 20  # for steps that keep little besides the texts: fewer words are met anew in each slice


def lean(df: DataFrame, id_col: str, text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Identifier and text alone, under fixed names; a null text is empty. Columns to ``carry`` come as one struct ``rest``."""
    rest = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rest")] if carry else []
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *rest)


def with_rest(kind: str, df: DataFrame) -> StructType:
    """The columns of ``kind``, and ``rest`` if ``df`` has it."""
    return StructType([*StructType.fromDDL(kind).fields, *[f for f in df.schema.fields if f.name == "rest"]])


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder that the cluster names."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@cache
def _trim() -> Callable[[int], int] | None:
    """glibc's call that returns freed pages; other C libraries have none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks, and what idle ones hold counts for the executor too."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def sliced(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batches whose ``column`` holds at most ``limit`` bytes (one row may hold more)."""
    for batch in batches:
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(size, dtype=np.int64), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(start, end - start)
            give_back()
            start = end


@dataclass
class Words:
    """Words of some texts: ``codes[offsets[i]:offsets[i + 1]]`` are those of text i, numbered in ``vocab``."""

    offsets: np.ndarray
    codes: np.ndarray
    vocab: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def owner(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Maximal runs of anything but ASCII white space."""
    texts = texts.fill_null("")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    filled = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False), dtype=np.int64)])
    encoded = flat.filter(filled).dictionary_encode()
    return Words(kept[bounds - bounds[0]], encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary)


def hashes(values: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each string."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(v, seed) for v in values.cast(pa.binary()).to_pylist()), np.uint64, len(values))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that sums and products of hashes spread well."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` neighbouring values; position i covers i .. i + width - 1."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + values[k : k + n]
    return mixed(out)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of start .. start + length - 1 for every pair."""
    ends = np.cumsum(lengths, dtype=np.int64)
    out = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    out += np.repeat(starts - (ends - lengths), lengths)
    return out


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def per_text(fn: Callable[[pa.RecordBatch], pa.RecordBatch], limit: int = SLICE_BYTES):
    """Lift a function of one bounded slice to a ``mapInArrow`` function."""

    def run(batches):
        for part in sliced(batches, limit=limit):
            out = fn(part)
            if out.num_rows:
                yield out

    return run


def per_group(fn: Callable[[pa.Table], pa.Table]):
    """Lift a function of one bounded group to an ``applyInArrow`` function."""

    def run(table: pa.Table) -> pa.Table:
        out = fn(table)
        give_back()
        return out

    return run
