"""Approximate nearest neighbours by an inverted multi-index.

Each half of the vectors is quantised by itself; a cell is a pair of
centroids. A query walks the pairs in order of their summed nearness with a
heap until the cells hold enough points. Equal vectors are one point with the
smallest identifiers that can be answers, and equal queries ask once, so copies
take no share of what a query visits. Cells with the same first centroid form
a shard, dealt in blocks of bounded size, to which the queries are sent once
with the cells that they visit; the entries there are reranked exactly.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vectors as V
from .arrow import checkpointed, ranges

LEAST_CENTROIDS = 64
SAMPLE = 20_000
VISIT = 0.5
BLOCK = 4000


@dataclass
class MultiIndex:
    """Centroids of both halves and the number of points in every cell."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray

    def cells(self, points: np.ndarray) -> np.ndarray:
        middle = points.shape[1] // 2
        return V.nearest(points[:, :middle], self.first) * len(self.second) + V.nearest(points[:, middle:], self.second)

    def walk(self, query: np.ndarray, wanted: float) -> list[int]:
        """Cells by falling summed inner product of the centroids until they hold ``wanted`` points."""
        middle = len(query) // 2
        a, b = self.first @ query[:middle], self.second @ query[middle:]
        rows, columns = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
        heap, seen, held, out = [(-(a[rows[0]] + b[columns[0]]), 0, 0)], {(0, 0)}, 0, []
        while heap and held < wanted:
            _, i, j = heappop(heap)
            cell = rows[i] * len(self.second) + columns[j]
            if self.counts[cell]:
                held += self.counts[cell]
                out.append(cell)
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(rows) and y < len(columns) and (x, y) not in seen:
                    seen.add((x, y))
                    heappush(heap, (-(a[rows[x]] + b[columns[y]]), x, y))
        return out


def _celled(points: DataFrame, index: MultiIndex) -> DataFrame:
    shared = points.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for part in batches:
            found = V.matrix(part.column("vector"))
            cells = shared.value.cells(found) if len(found) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells)], names=["vec_id", "vector", "ids", "cell"])

    return points.select("vec_id", "vector", "ids").mapInArrow(run, "vec_id long, vector array<double>, ids array<long>, cell long")


def _points(rows: DataFrame, most: int) -> DataFrame:
    """Distinct vectors with their ``most`` smallest identifiers; vec_id is the least. The limit acts before the shuffle, too."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("place", place).where(F.col("place") <= most)
    points = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return points.select(F.col("ids")[0].alias("vec_id"), "vector", "ids")


def search(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
    centroids: int | None = None, visit: float = VISIT, block: int = BLOCK,
) -> DataFrame:
    """The k rows of largest inner product found for each row where ``is_query`` (over vec_id) holds.

    Returns query_id, rank, vec_id, score. The centroids of a half, at least ``LEAST_CENTROIDS`` and
    growing with the fourth root of the number of points, are fitted on at most
    ``SAMPLE`` points; every row is indexed, and a query visits the nearest cells
    that hold at least ``visit`` of all distinct vectors and at least k + 1 of them, or all cells where
    there are fewer. Scores are exact in double
    precision; ties go to the smaller vec_id; a row is no answer to itself. See
    ``vectors.usable`` for the rows that take no part. No rows give no rows.
    """
    rows = V.usable(df, id_col, vector_col, True)
    known = checkpointed(_points(rows, k + 1))
    points = V.sample(known, SAMPLE)
    if not len(points):
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    middle = points.shape[1] // 2
    number = centroids or max(LEAST_CENTROIDS, int(4 * known.count() ** 0.25))
    index = MultiIndex(V.kmeans(points[:, :middle], number), V.kmeans(points[:, middle:], number), np.empty(0))
    entries = checkpointed(_celled(known, index))
    index.counts = np.zeros(len(index.first) * len(index.second), np.int64)
    for r in entries.groupBy("cell").count().collect():  # cells grow with the square root of the points
        index.counts[r["cell"]] = r["count"]
    total, width = int(index.counts.sum()), len(index.second)
    wanted = max(visit * total, k + 1)
    queries = rows.where(is_query)
    askers = checkpointed(queries.groupBy("vector").agg(F.min("vec_id").alias("asker")))
    asked = askers.count()
    blocks = np.maximum(1, -(-index.counts.reshape(len(index.first), width).sum(axis=1) // block))
    shared = df.sparkSession.sparkContext.broadcast((index, blocks))
    turns = max(1, -(-asked // block))

    def sent(batches):
        """One row for each block of each shard that a query visits."""
        own, blocks = shared.value
        for part in batches:
            ids, shards, numbers, visits, place = [], [], [], [], []
            points = V.matrix(part.column("vector"))
            for i, query in enumerate(points):
                by_shard: dict[int, list[int]] = {}
                for cell in own.walk(query, wanted):
                    by_shard.setdefault(cell // width, []).append(cell)
                for shard, cells in by_shard.items():
                    for b in range(int(blocks[shard])):
                        place.append(i)
                        shards.append(shard)
                        numbers.append(b)
                        visits.append(cells)
            place = pa.array(place, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(place), part.column("vector").take(place), pa.array(shards, pa.int64()), pa.array(numbers, pa.int64()), pa.array(visits, pa.list_(pa.int64()))],
                names=["vec_id", "vector", "shard", "block", "cells"],
            )

    kinds = "vec_id long, vector array<double>, shard long, block long, cells array<long>"
    number = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), (F.col("shard") + 1).cast("int"))
    dealt = entries.withColumn("shard", F.floor(F.col("cell") / width)).withColumn("block", F.pmod(F.xxhash64("vec_id"), number))
    turn = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(turns))
    every = F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))
    held = dealt.select("vec_id", "vector", "ids", "shard", "block", F.array("cell").alias("cells"), F.lit(False).alias("asks"), every.alias("turn"))
    asks = askers.select(F.col("asker").alias("vec_id"), "vector").mapInArrow(sent, kinds)
    asks = asks.select("*", F.array("vec_id").alias("ids"), F.lit(True).alias("asks"), turn.cast("int").alias("turn"))

    def solve(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, cells = table.column("vec_id").to_numpy(), table.column("cells").combine_chunks()
        points, named = V.matrix(table.column("vector").combine_chunks()), table.column("ids").combine_chunks()
        names, bounds = named.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(named).to_numpy())])
        here = np.flatnonzero(~asks)
        cell_of = cells.take(pa.array(here)).flatten().to_numpy()
        members = {int(c): here[cell_of == c] for c in np.unique(cell_of)}
        out = ([], [], [])
        for q in np.flatnonzero(asks).tolist():
            found = [members[c] for c in cells[q].as_py() if c in members]
            if not found:
                continue
            near = np.concatenate(found)
            scores = (points[near] * points[q]).sum(axis=1)
            # the k + 1 best identifiers are among those of the k + 1 best points
            top = V.best(scores, ids[near], k + 1)
            size = (bounds[1:] - bounds[:-1])[near[top]]
            answers, scores = names[ranges(bounds[:-1][near[top]], size)], np.repeat(scores[top], size)
            top = V.best(scores, answers, k + 1)
            out[0].append(np.full(len(top), ids[q]))
            out[1].append(answers[top])
            out[2].append(scores[top])
        flat = [np.concatenate([*x, np.empty(0)]) for x in out]
        return pa.table({"query_id": flat[0].astype(np.int64), "vec_id": flat[1].astype(np.int64), "score": flat[2]})

    grouped = held.unionByName(asks).groupBy("shard", "block", "turn")
    best = V.merged(grouped.applyInArrow(solve, "query_id long, vec_id long, score double"), k + 1)
    # every query with the answers to its vector, less itself
    lists = best.groupBy(F.col("query_id").alias("asker")).agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    answered = queries.join(askers, "vector").join(lists, "asker").select(F.col("vec_id").alias("query_id"), "found")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = answered.select("query_id", F.posexplode(others).alias("place", "x"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), "x.vec_id", "x.score")
