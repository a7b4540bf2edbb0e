"""Exact quantiles by radix selection over stored columns.

The doubles of a column are read as whole numbers of the same order. Each pass
counts the values of the still open intervals in buckets of 11 leading bits (a
bounded partial result per task), and a window over the bucket counts settles,
on the executors, the bucket each wanted rank falls into. A bucket of equal values ends its rank at
once, as heavily repeated values do; when few values are left in the open
intervals, they are counted one by one. So 64 bits need at most six passes.
"""

from __future__ import annotations


from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, materialise
from .partials import Part, merged, merged_moments, moments, sweep, wide

BUCKETS = 2048
HELD_ROWS = 10_000
COUNT_SINGLY = 20_000


@dataclass
class ColumnSummary:
    group: object
    column: str
    count: int
    mean: float | None
    std: float | None
    low: float | None
    high: float | None
    quantiles: list[float | None]


@dataclass
class Held:
    """A table of settings that later steps read more than once.

    Up to ``HELD_ROWS`` rows are kept here, enter plans as a local relation
    and passes with the function; a larger one is checkpointed and joined.
    """

    table: DataFrame
    rows: list[Row] | None

    def left(self) -> int:
        """How many values the open intervals hold; none are open at zero."""
        g = ["g"] if "g" in self.table.columns else []
        if self.rows is None:
            intervals = self.table.where("low < high").select(*g, "i", "low", "inside").distinct()
            return intervals.agg(F.sum("inside")).first()[0] or 0
        return sum({(*[r[c] for c in g], r["i"], r["low"]): r["inside"] for r in self.rows if r["low"] < r["high"]}.values())

    def settings(self, kind: str, *fields: str) -> tuple[list | dict | None, DataFrame | None]:
        """What a pass of ``kind`` is given, as rows or as a table."""
        if self.rows is not None and "g" not in self.table.columns:
            return [(r["i"], *[r[f] for f in fields]) for r in self.rows], None
        if self.rows is not None:
            by_group: dict = {}
            for r in self.rows:
                by_group.setdefault(r["g"], []).append((r["i"], *[r[f] for f in fields]))
            return by_group, None
        named = [F.col(f).alias(n) for f, n in zip(fields, "abc")] + [F.lit(None).cast("double").alias(n) for n in "abc"[len(fields) :]]
        return None, self.table.select("g", F.lit(kind).alias("kind"), "i", *named)


def held(df: DataFrame) -> Held:
    # group values of other types may differ between the collected and the Arrow form
    plain = "g" not in df.columns or isinstance(df.schema["g"].dataType, (T.StringType, T.IntegralType, T.BooleanType, T.DateType))
    rows = df.limit(HELD_ROWS + 1).collect() if plain else []
    if not plain or len(rows) > HELD_ROWS:
        return Held(cut_lineage(df), None)
    return Held(df.sparkSession.createDataFrame(rows, df.schema), rows)


def _wanted(probabilities: Sequence[float]) -> str:
    """SQL array of the ranks around each probability's place among n values."""
    lows = [f"CAST(floor({p!r}D * (n - 1)) AS BIGINT)" for p in probabilities]
    return "array_distinct(flatten(array(" + ", ".join(f"array({low}, least({low} + 1, n - 1))" for low in lows) + ")))"


def open_ranks(totals: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(g, i, rank, before, inside, low, high) of every wanted rank: at first anywhere."""
    keys = [c for c in ("g",) if c in totals.columns]
    ranks = totals.where("n > 0").withColumn("rank", F.explode(F.expr(_wanted(probabilities))))
    ends = [F.lit(end).cast("double").alias(name) for name, end in (("low", "-Infinity"), ("high", "Infinity"))]
    return ranks.select(*keys, "i", "rank", F.lit(0).cast("bigint").alias("before"), F.col("n").alias("inside"), *ends)


def rank_part(state: Held, buckets: int, singly: bool) -> tuple[Part, DataFrame | None]:
    """The next pass over the open intervals."""
    g = ["g"] if "g" in state.table.columns else []
    intervals = state.table.where("low < high").select(*g, "i", "low", "high").distinct()
    rows = state.rows and [Row(**dict(t)) for t in dict.fromkeys(tuple((c, r[c]) for c in (*g, "i", "low", "high")) for r in state.rows if r["low"] < r["high"])]
    own, table = Held(intervals, rows).settings("ranks", "low", "high")
    return Part("ranks", {"buckets": buckets, "singly": singly}, own), table


def narrowed(state: DataFrame, partials: DataFrame) -> DataFrame:
    """The state after a pass: every open rank in the bucket that holds it."""
    keys = [c for c in ("g", "i") if c in state.columns]
    counted = merged(partials, "ranks", "x")
    cumulative = Window.partitionBy(*keys, "x").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.select(
        *[F.col(c).alias(f"p_{c}") for c in keys], "x", "n", F.col("low").alias("p_low"), F.col("high").alias("p_high"),
        F.sum("n").over(cumulative).alias("up_to"),
    )
    same = F.col("low") == F.col("x")
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"p_{c}"))
    here = (F.col("rank") - F.col("before") < F.col("up_to")) & (F.col("rank") - F.col("before") >= F.col("up_to") - F.col("n"))
    found = state.where("low < high").join(placed, same & here)
    rows = found.select(
        *keys, "rank", (F.col("before") + F.col("up_to") - F.col("n")).alias("before"), F.col("n").alias("inside"),
        F.col("p_low").alias("low"), F.col("p_high").alias("high"),
    )
    return state.where("low = high").unionByName(rows)


def settled(rows: DataFrame, state: Held, buckets: int = BUCKETS, count_singly: int = COUNT_SINGLY) -> DataFrame:
    """Passes over the stored rows until every rank has its value (low = high)."""
    while left := state.left():
        part, settings = rank_part(state, buckets, left <= count_singly)
        state = held(narrowed(state.table, sweep(rows, part, settings=settings)))
    return state.table


def interpolated(totals: DataFrame, state: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """``totals`` with the linearly interpolated ``quantiles``; null where there are no values."""
    keys = [c for c in ("g", "i") if c in totals.columns]
    values = state.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "low"))).alias("at"))
    values = values.select(*[F.col(c).alias(f"v_{c}") for c in keys], "at")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"v_{c}"))
    cells = []
    for p in probabilities:
        place = f"({p!r}D * (n - 1))"
        low = f"CAST(floor({place}) AS BIGINT)"
        a, b, share = f"at[{low}]", f"at[least({low} + 1, n - 1)]", f"({place} - floor({place}))"
        cells.append(f"CASE WHEN {a} = {b} OR {share} = 0 THEN {a} ELSE {a} + ({b} - {a}) * {share} END")
    joined = totals.join(values, same, "left")
    return joined.select(*totals.columns, F.expr(f"array({', '.join(cells)})").alias("quantiles"))


def quantile_table(
    rows: DataFrame, probabilities: Sequence[float], buckets: int = BUCKETS, count_singly: int = COUNT_SINGLY
) -> DataFrame:
    """(g, i, n, mean, std, low, high, quantiles) of stored rows in the form of ``partials.wide``.

    The first pass gives the moments and the first buckets together.
    """
    first = cut_lineage(sweep(rows, moments(), Part("ranks", {"buckets": buckets, "singly": False})))
    totals = held(totals_of(first)).table
    state = held(narrowed(open_ranks(totals, probabilities), first))
    return interpolated(totals, settled(rows, state, buckets, count_singly), probabilities)


def totals_of(partials: DataFrame) -> DataFrame:
    """(g, i, n, mean, std, low, high) from the moments of a sweep."""
    std = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("xx"), F.lit(0.0)) / (F.col("n") - 1)))
    found = merged_moments(partials.where("i = j"))
    return found.select(*[c for c in ("g", "i") if c in found.columns], "n", F.col("x").alias("mean"), std.alias("std"), "low", "high")


def summarise(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    by: str | None = None,
    buckets: int = BUCKETS,
    count_singly: int = COUNT_SINGLY,
) -> list[ColumnSummary]:
    """Count, mean, sample deviation, extremes and linear-interpolated quantiles, on the driver.

    One summary per column with values, and per group: ``by`` should then be a
    column of few values. ``quantile_table`` gives the same as a table for any
    number of groups. The needed columns are stored once for the passes.
    """
    rows = materialise(wide(df, columns, by), "columns")
    table = quantile_table(rows, probabilities, buckets, count_singly).collect()
    out = [
        ColumnSummary(r["g"] if by else None, columns[r["i"]], r["n"], r["mean"], r["std"], r["low"], r["high"], list(r["quantiles"]))
        for r in table
    ]
    return sorted(out, key=lambda s: (str(s.group), s.column))
