"""Product codes of vectors by Lloyd's rounds that look at active entries only.

Every part of a vector keeps its entry and the exact distance to it. When the
entries have moved, a part whose own entry stayed compares nothing but the
moved ones with that distance; only parts whose entry moved scan the whole
codebook. All arithmetic is in whole numbers, so codes are the same however
the rows are dealt. The state between rounds is a table in the shared folder.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .arrow import record_batch
from .vectors import matrix

_CELLS = 1 << 20  # components compared at once


def _usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, int]:
    """vec_id, label and vector (array<double>) of the rows that take part, and the vectors' length."""
    rows = df.select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & sound & (F.size("vector") > 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    length = lengths[0] if lengths else 0
    return rows.where(F.size("vector") == length), length


def whole_numbers(vectors: np.ndarray, scale: int, parts: int) -> np.ndarray:
    """floor(scale * x) as (row, part, component), filled up with zeros to equal parts.

    Components are held where a row's squared distance still fits in 64 bits.
    """
    n, length = vectors.shape
    width = -(-length // parts)
    most = math.isqrt((1 << 62) // max(1, width * parts)) // 2
    out = np.zeros((n, width * parts), np.int64)
    out[:, :length] = np.clip(np.floor(scale * vectors), -most, most)
    return out.reshape(n, parts, width)


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    out = np.empty((len(points), len(entries)), np.int64)
    step = max(1, _CELLS // max(1, entries.size))
    for a in range(0, len(points), step):
        gap = points[a : a + step, None, :] - entries[None, :, :]
        out[a : a + step] = np.einsum("nkw,nkw->nk", gap, gap)
    return out


def reassign(points: np.ndarray, code: np.ndarray, near: np.ndarray, books: np.ndarray, moved: np.ndarray) -> int:
    """Bring ``code`` and ``near`` (row, part) up to date in place; returns how many distances were computed."""
    work = 0
    for p in range(points.shape[1]):
        active = np.flatnonzero(moved[p])
        if not len(active):
            continue
        loose = moved[p][code[:, p]]
        rows = np.flatnonzero(loose)
        if len(rows):
            distance = _distances(points[rows, p], books[p])
            code[rows, p] = distance.argmin(axis=1)
            near[rows, p] = distance.min(axis=1)
            work += distance.size
        rows = np.flatnonzero(~loose)
        if len(rows):
            distance = _distances(points[rows, p], books[p][active])
            entry, least = active[distance.argmin(axis=1)], distance.min(axis=1)
            own, held = code[rows, p], near[rows, p]
            better = (least < held) | ((least == held) & (entry < own))
            code[rows[better], p] = entry[better]
            near[rows[better], p] = least[better]
            work += distance.size
    return work


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n = len(values)
    flat = values.reshape(-1)
    width = len(flat) // n if n else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(flat, kind))


def _tallied(state: DataFrame, parts: int, entries: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and component sums of every used (part, entry): a bounded number of rows."""

    def run(batches):
        total = None
        for batch in batches:
            points = matrix(batch.column("point")).reshape(batch.num_rows, parts, -1).astype(np.int64)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
            cells = (np.arange(parts) * entries + code).reshape(-1)
            flat = points.reshape(-1, points.shape[2])
            if total is None:
                total = np.zeros((parts * entries, flat.shape[1] + 1), np.int64)
            order = np.argsort(cells, kind="stable")
            used, firsts = np.unique(cells[order], return_index=True)
            if len(used):
                total[used, 1:] += np.add.reduceat(flat[order], firsts, axis=0)
                total[used, 0] += np.diff([*firsts, len(order)])
        if total is not None:
            cell, place = np.nonzero(total)
            kind = pa.schema([("cell", pa.int32()), ("place", pa.int32()), ("total", pa.int64())])
            yield record_batch(kind, cell.astype(np.int32), place.astype(np.int32), total[cell, place])

    sums = state.select("point", "code").mapInArrow(run, "cell int, place int, total bigint")
    rows = sums.groupBy("cell", "place").agg(F.sum("total").alias("total")).collect()
    by_cell: dict[int, dict[int, int]] = {}
    for r in rows:
        by_cell.setdefault(r["cell"], {})[r["place"]] = r["total"]
    return {divmod(c, entries): (v[0], v) for c, v in by_cell.items()}


class _State:
    """The table between two rounds; its predecessor is removed once it is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.rows = spark, None, None

    def store(self, rows: DataFrame) -> None:
        path, old = fresh_path(self.spark, "product-codes"), self.path
        rows.write.parquet(path)
        self.path, self.rows = path, self.spark.read.schema(rows.schema).parquet(path)
        if old:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(old)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def _books_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> DataFrame:
    """Columns vec_id, label, code (hex, two digits a part), error, label_error and codebooks_sha256.

    The first codebooks are the parts of the ``entries`` rows of smallest
    identifier (ties to the smaller vector, null identifiers last); of fewer
    rows all. ``rounds`` times parts go to their nearest entry, ties to the
    lower index, and entries to the floor of their parts' mean; then parts are
    assigned again. error is the row's squared distance in whole numbers,
    label_error its sum over rows of the same label, null labels together (null
    where that exceeds 64 bits).

    Every row has its own result, repeated rows too. Left out are vectors that are null,
    empty, hold null or non-finite components or have another than the most
    frequent length. Lengths that ``parts`` does not divide are filled up with
    zeros. Components beyond about 2^27 after scaling (64 components) count as
    that. An empty table gives no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows, length = _usable(df, id_col, vector_col, label_col)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    width = -(-length // parts)
    start = np.array([r[0] for r in first], np.float64).reshape(len(first), length)
    books = whole_numbers(start, scale, parts).transpose(1, 0, 2).copy() if first else np.zeros((parts, 1, width), np.int64)
    used = books.shape[1]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, point array<int>, code binary, near array<bigint>"

    def assigned(books: np.ndarray, moved: np.ndarray, fresh: bool):
        def run(batches):
            for batch in batches:
                n = batch.num_rows
                if fresh:
                    points = whole_numbers(matrix(batch.column("vector")).reshape(n, length), scale, parts)
                    code, near = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
                else:
                    points = matrix(batch.column("point")).reshape(n, parts, width).astype(np.int64)
                    code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts).copy()
                    near = matrix(batch.column("near")).reshape(n, parts).copy()
                if n:
                    reassign(points, code, near, books, moved)
                    columns = [
                        batch.column("vec_id"),
                        batch.column("label"),
                        _lists(points.astype(np.int32), pa.int32()),
                        pa.array([c.tobytes() for c in code], pa.binary()),
                        _lists(near, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "point", "code", "near"])

        return run

    state, moved = _State(spark), np.ones((parts, used), bool)
    state.store(rows.mapInArrow(assigned(books, moved, True), schema))
    for _ in range(rounds):
        after = books.copy()
        for (p, e), (count, sums) in _tallied(state.rows, parts, used).items():
            after[p, e] = [sums.get(i + 1, 0) // count for i in range(width)]
        moved = (after != books).any(axis=2)
        books = after
        if not moved.any():
            break
        state.store(state.rows.mapInArrow(assigned(books, moved, False), schema))
    coded = state.rows.select(
        "vec_id",
        "label",
        F.lower(F.hex("code")).alias("code"),
        F.aggregate("near", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"),
    )
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(F.try_sum("error").alias("label_error"))
    digest = hashlib.sha256(_books_text(books).encode()).hexdigest()
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
