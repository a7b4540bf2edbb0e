"""Exact largest inner products by a Voronoi kNN join.

Rows and queries are grouped by their nearest pivot. Each group is summarised
by its size and radius. Inner products between two groups are bounded by their
pivots and radii, so the summaries tell a score that the k-th answer of every
query of a group reaches at least, and which groups may hold a better one: to
those alone the queries are sent. Queries are dealt in turns by their groups,
and rows are copied only to the turns in which some query may need their group.
There every query leaves out the groups that its own bound rules out and the
rest is solved in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .arrow import checkpointed, ranges

PIVOT_SAMPLE = 10_000
MOST_PIVOTS = 1024
BLOCK = 4000
CHUNK = 256


def _grouped(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for part in batches:
            points = V.matrix(part.column("vector")).astype(float)
            group = V.nearest(points, shared.value) if len(points) else np.empty(0, np.int64)
            far = np.linalg.norm(points - shared.value[group], axis=1) if len(points) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(group), pa.array(far)], names=["vec_id", "vector", "cell", "far"])

    return rows.select("vec_id", "vector").mapInArrow(run, "vec_id long, vector array<long>, cell long, far double")


def needed_groups(pivots, sizes, radii, query_radii, k: int) -> np.ndarray:
    """Whether group h may hold one of the k best answers of some query in group g: [g, h].

    By q = p_g + a and x = p_h + b with |a| <= query radius and |b| <= radius.
    """
    centre = pivots @ pivots.T
    norm = np.linalg.norm(pivots, axis=1)
    slack = np.outer(norm, radii) + np.outer(query_radii, norm) + np.outer(query_radii, radii)
    slack = slack + 1e-6 * (1 + np.abs(centre) + slack)
    upper, lower = centre + slack, centre - slack
    out = np.zeros(centre.shape, bool)
    for g in range(len(pivots)):
        order = np.argsort(-lower[g], kind="stable")
        # one more than k: the query itself may be among those counted
        enough = np.searchsorted(np.cumsum(sizes[order]), k + 1)
        least = lower[g, order[enough]] if enough < len(order) else -np.inf
        out[g] = (upper[g] >= least) & (sizes > 0)
    return out


def dealt_turns(asked: np.ndarray, order: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The first turn of each query group and over how many turns its queries are dealt.

    Neighbouring groups (by ``order``) share a turn of about ``block`` queries; a larger group has turns of its own.
    """
    first, number = np.zeros(len(asked), np.int64), np.ones(len(asked), np.int64)
    turn, held = 0, 0.0
    for g in np.argsort(order, kind="stable").tolist():
        if held and held + asked[g] > block:
            turn, held = turn + 1, 0.0
        first[g], number[g] = turn, max(1, -(-int(asked[g]) // block))
        held += asked[g]
        if number[g] > 1:
            turn, held = turn + int(number[g]), 0.0
    return first, number


def turns_needed(needed: np.ndarray, asked: np.ndarray, first: np.ndarray, number: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each data group the ranges of turns in which some query group needs it, without overlaps."""
    out: list[list[tuple[int, int]]] = []
    for h in range(needed.shape[1]):
        spans: list[tuple[int, int]] = []
        for a, b in sorted({(int(first[g]), int(first[g] + number[g] - 1)) for g in np.flatnonzero(needed[:, h] & (asked > 0))}):
            if spans and a <= spans[-1][1] + 1:
                spans[-1] = spans[-1][0], max(b, spans[-1][1])
            else:
                spans.append((a, b))
        out.append(spans)
    return out


def search(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
    scale: int = 64, block: int = BLOCK, pivots: int | None = None,
) -> DataFrame:
    """The k rows of largest inner product for each row where ``is_query`` (over vec_id) holds, exactly.

    Components x count as floor(scale * x). Returns query_id, rank, vec_id,
    score (long). Ties go to the smaller vec_id; a row is no answer to itself.
    See ``vectors.usable`` for the rows that take no part; zero vectors take
    part. No rows give no rows.
    """
    sound = V.usable(df, id_col, vector_col, False)
    rows = checkpointed(sound.select("vec_id", F.transform("vector", lambda x: F.floor(x * scale).cast("long")).alias("vector")))
    n = rows.count()
    points = V.sample(rows, PIVOT_SAMPLE).astype(float)
    if not len(points):
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    number = pivots or min(MOST_PIVOTS, max(1, int(n**0.5 / 2)))
    centres = V.kmeans(points, number, 5)
    entries = checkpointed(_grouped(rows, centres))
    summary = entries.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), F.max(F.when(is_query, F.col("far"))).alias("query_far"),
        F.count(F.when(is_query, 1)).alias("asked"),
    )
    sizes, radii, query_radii, query_sizes = (np.zeros(len(centres)) for _ in range(4))
    for r in summary.collect():  # a row per pivot
        sizes[r["cell"]], radii[r["cell"]], query_radii[r["cell"]] = r["n"], r["far"], r["query_far"] or 0.0
        query_sizes[r["cell"]] = r["asked"]
    needed = needed_groups(centres, sizes, radii, query_radii, k)
    # neighbouring groups share a task up to its size; larger groups are dealt in blocks
    shard, held, blocks = np.zeros(len(centres), np.int64), 0, []
    for h in np.argsort(centres @ centres.mean(axis=0), kind="stable").tolist():
        if not blocks or held + sizes[h] > block:
            blocks.append(0)
            held = 0
        held += sizes[h]
        shard[h], blocks[-1] = len(blocks) - 1, max(1, -(-int(held) // block))
    turn_of, turns_of = dealt_turns(query_sizes, shard, block)
    heard = turns_needed(needed, query_sizes, turn_of, turns_of)
    shared = df.sparkSession.sparkContext.broadcast((centres, radii, needed, shard, np.array(blocks)))

    def sent(batches):
        """One row for each block of each shard that may hold an answer of the query's group."""
        _, _, needed, shard, blocks = shared.value
        targets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for part in batches:
            groups = part.column("cell").to_numpy()
            for g in np.unique(groups).tolist():
                if g not in targets:
                    met = np.unique(shard[needed[g]])
                    targets[g] = np.repeat(met, blocks[met]), ranges(np.zeros(len(met), np.int64), blocks[met])
            place = np.repeat(np.arange(len(groups)), np.array([len(targets[g][0]) for g in groups.tolist()], np.int64))
            shards, numbers = (np.concatenate([*(targets[g][i] for g in groups.tolist()), np.empty(0, np.int64)]).astype(np.int64) for i in (0, 1))
            rows = part.take(pa.array(place))
            columns = [*(rows.column(c) for c in ("vec_id", "vector", "cell")), pa.array(shards), pa.array(numbers)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "cell", "shard", "block"])

    def of_group(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (F.col("cell") + 1).cast("int"))

    place = F.struct(of_group(shard.tolist(), "long").alias("shard"), of_group([blocks[s] for s in shard], "long").alias("blocks"))
    # a row goes to the turns whose queries may need its group: ranges of turns, as many as there are groups at most
    spans = df.sparkSession.createDataFrame([(h, a, b) for h, own in enumerate(heard) for a, b in own], "cell long, first long, last long")
    every = F.explode(F.sequence("first", "last")).alias("turn")
    data = entries.withColumn("place", place).join(F.broadcast(spans), "cell").select(
        "vec_id", "vector", "cell", "place.shard", F.pmod(F.xxhash64("vec_id"), F.col("place.blocks")).alias("block"), F.lit(False).alias("asks"), every
    )
    asks = entries.where(is_query).mapInArrow(sent, "vec_id long, vector array<long>, cell long, shard long, block long")
    turn = of_group(turn_of.tolist(), "long") + F.pmod(F.xxhash64("vec_id", F.lit(1)), of_group(turns_of.tolist(), "long"))
    asks = asks.select("*", F.lit(True).alias("asks"), turn.alias("turn"))

    def solve(table: pa.Table) -> pa.Table:
        centres, radii, needed, _, _ = shared.value
        asks, ids, cell = (table.column(c).to_numpy() for c in ("asks", "vec_id", "cell"))
        points = V.matrix(table.column("vector").combine_chunks())
        here, questions = np.flatnonzero(~asks), np.flatnonzero(asks)
        here = here[np.argsort(cell[here], kind="stable")]
        groups, starts = np.unique(cell[here], return_index=True)
        ends = np.append(starts[1:], len(here))
        # float products are exact while every partial sum stays below 2 ** 53
        largest = np.abs(points).max(initial=0).astype(float)
        exact = points.astype(float) if largest * largest * points.shape[1] < 2.0**53 else points
        out = ([], [], [])
        for at in range(0, len(questions), CHUNK):
            q = questions[at : at + CHUNK]
            scores = exact[q] @ exact[here].T if len(here) else np.empty((len(q), 0))
            reach = exact[q].astype(float) @ centres[groups].T + np.linalg.norm(exact[q].astype(float), axis=1)[:, None] * radii[groups]
            reach = reach + 1e-6 * (1 + np.abs(reach))
            for i, x in enumerate(q.tolist()):
                # groups by falling bound until the bound falls below the k-th score in hand
                keep, least = [], -np.inf
                hold: list = []
                for g in np.argsort(-reach[i], kind="stable").tolist():
                    if reach[i, g] < least:
                        break
                    if not needed[cell[x], groups[g]]:
                        continue
                    rows = np.arange(starts[g], ends[g])
                    rows = rows[ids[here[rows]] != ids[x]]
                    keep.append(rows)
                    hold = np.concatenate([hold, scores[i, rows]])
                    if len(hold) >= k:
                        hold = np.partition(hold, len(hold) - k)[len(hold) - k :]
                        least = hold.min()
                rows = np.concatenate([*keep, np.empty(0, np.int64)]).astype(np.int64)
                top = rows[V.best(scores[i, rows], ids[here[rows]], k)]
                out[0].append(np.full(len(top), ids[x]))
                out[1].append(ids[here[top]])
                out[2].append(scores[i, top])
        flat = [np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in out]
        return pa.table({"query_id": flat[0], "vec_id": flat[1], "score": flat[2]})

    grouped = data.unionByName(asks).groupBy("shard", "block", "turn")
    return V.merged(grouped.applyInArrow(solve, "query_id long, vec_id long, score long"), k)
