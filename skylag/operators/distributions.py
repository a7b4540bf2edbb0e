"""Histograms, density curves, box statistics and clock points.

The needed columns are stored once. A pass over them fits what a table needs
(extremes, deviations, quartiles), a second one counts or sums with it; both
are sweeps of mergeable partial results.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schema import complete, present, require
from ..session import materialise
from .cleaning import clip_columns
from .partials import Part, merged, merged_moments, moments, sweep, wide
from .quantiles import held, quantile_table, totals_of

# Display ranges of the charts.
DELAY_RANGE = (-60.0, 180.0)
BOX_RANGES = {
    "CRS_ELAPSED_TIME": (0.0, 400.0),
    "DISTANCE": (0.0, 3000.0),
    "ARR_DELAY": (-60.0, 300.0),
    "AVG_SPEED": (1.0, 6.0),
}
NUMERIC = ("CRS_ELAPSED_TIME", "DISTANCE", "AVG_SPEED", "ARR_DELAY")


def _matched(fits: DataFrame, found: DataFrame, *more: str) -> DataFrame:
    """Every row of ``fits`` beside what a pass found for it, or nulls."""
    keys = [c for c in ("g", "i") if c in fits.columns] + list(more)
    other = found.select(*[F.col(c).alias(f"f_{c}") for c in keys], *[F.col(c).alias(f"found_{c}") for c in ("n", "x", "low", "high")])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"f_{c}"))
    return fits.join(other, same, "left")


def named(columns: Sequence[str]):
    """The column's name from its number."""
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1)


def bin_edges(totals: DataFrame, bins: int) -> DataFrame:
    """(i, lo, width) of equal bins between the extremes; a constant has a bin width around it."""
    flat = F.col("low") == F.col("high")
    lo, hi = F.col("low") - F.when(flat, 0.5).otherwise(0.0), F.col("high") + F.when(flat, 0.5).otherwise(0.0)
    return totals.select("i", lo.alias("lo"), ((hi - lo) / F.lit(float(bins))).alias("width"))


def binned(edges: DataFrame, partials: DataFrame, columns: Sequence[str], bins: int, name: str = "bins") -> DataFrame:
    """The histogram table of counted bins, empty ones with zero."""
    grid = edges.withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    low = F.col("lo") + F.col("width") * F.col("j")
    return _matched(grid, merged(partials, name), "j").select(
        named(columns).alias("column"),
        F.col("j").cast("int").alias("bin"),
        low.alias("bin_low"),
        (F.col("lo") + F.col("width") * (F.col("j") + 1)).alias("bin_high"),
        F.coalesce("found_n", F.lit(0)).alias("n"),
    )


def histogram(
    df: DataFrame,
    columns: Sequence[str] = ("ARR_DELAY",),
    bins: int = 80,
    ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Equal-width counts between the extremes of each (clipped) column.

    Empty bins are listed with zero; the last bin is closed on both sides.
    """
    require(df, columns)
    df = clip_columns(df, {c: r for c, r in (ranges or {}).items() if c in columns})
    rows = materialise(wide(df, columns), "columns")
    edges = held(bin_edges(merged_moments(sweep(rows, moments())), bins))
    own, _ = edges.settings("bins", "lo", "width")
    return binned(edges.table, sweep(rows, Part("bins", {"bins": bins}, own)), columns, bins)


def delay_histogram(df: DataFrame, bins: int = 80, clip: tuple[float, float] = DELAY_RANGE) -> DataFrame:
    return histogram(df, ["ARR_DELAY"], bins, {"ARR_DELAY": clip})


def numeric_histograms(df: DataFrame, columns: Sequence[str] = NUMERIC, bins: int = 40) -> DataFrame:
    """Histograms of the listed columns that exist, delay clipped."""
    return histogram(df, present(df, columns), bins, {"ARR_DELAY": DELAY_RANGE})


def curve_fits(totals: DataFrame, grid: int, cut: float, rule: str) -> DataFrame:
    """(g, i, n, lo, step, bw) of every curve with a bandwidth, from counts, deviations, extremes and quartiles.

    ``scott`` takes the deviation, ``nrd0`` the lesser of deviation and quartile distance / 1.34.
    """
    keys = [c for c in ("g", "i") if c in totals.columns]
    shrink = F.pow(F.col("n").cast("double"), F.lit(-0.2))
    std = F.coalesce("std", F.lit(0.0))
    if rule == "scott":
        width = std * shrink
    elif rule == "nrd0":
        spread = (F.col("quantiles")[1] - F.col("quantiles")[0]) / 1.34
        least = F.least(std, spread)
        width = F.when(least > 0, least).otherwise(std) * 0.9 * shrink
    else:
        raise ValueError("bandwidth rule must be 'scott' or 'nrd0'")
    fits = totals.where("n > 0").select(*keys, "n", "low", "high", width.alias("bw")).where("bw > 0")
    lo, hi = F.col("low") - cut * F.col("bw"), F.col("high") + cut * F.col("bw")
    return fits.select(*keys, "n", lo.alias("lo"), ((hi - lo) / F.lit(grid - 1)).alias("step"), "bw")


def curve_points(fits: DataFrame, partials: DataFrame, grid: int, name: str = "curves") -> DataFrame:
    """(g, i, point, x, density): every grid point, zero where no value reaches it."""
    keys = [c for c in ("g", "i") if c in fits.columns]
    points = fits.withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(grid - 1).cast("bigint"))))
    norm = F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))
    return _matched(points, merged(partials, name), "j").select(
        *keys,
        F.col("j").cast("int").alias("point"),
        (F.col("lo") + F.col("step") * F.col("j")).alias("x"),
        (F.coalesce("found_x", F.lit(0.0)) / norm).alias("density"),
    )


def _densities(rows: DataFrame, grid: int, cut: float, rule: str) -> DataFrame:
    """Curves of all columns of stored rows: a pass for the fits (more for quartiles), one for the sums."""
    if rule == "nrd0":
        totals = quantile_table(rows, (0.25, 0.75))
    else:
        totals = totals_of(sweep(rows, moments()))
    fits = held(curve_fits(totals, grid, cut, rule))
    own, table = fits.settings("curves", "lo", "step", "bw")
    return curve_points(fits.table, sweep(rows, Part("curves", {"grid": grid}, own), settings=table), grid)


def density(
    df: DataFrame,
    column: str = "ARR_DELAY",
    by: str | None = None,
    grid: int = 200,
    cut: float = 0.0,
    rule: str = "scott",
    clip: tuple[float, float] | None = None,
    resolution: float | None = None,
) -> DataFrame:
    """Gaussian kernel density on an even grid, per group when ``by`` is given.

    Every task adds its values' kernels up on the grid; the sums of all tasks
    are merged, so what is shuffled does not grow with the rows. There may be
    any number of groups. ``resolution`` snaps values to a step first, so that
    more of them are equal and cost one kernel.
    """
    require(df, [column, *([by] if by else [])])
    df = df.select(*([by] if by else []), F.col(column).cast("double").alias(column))
    df = complete(df)
    if clip:
        df = clip_columns(df, {column: clip})
    if resolution:
        df = df.withColumn(column, F.round(F.col(column) / F.lit(resolution)) * F.lit(resolution))
    out = _densities(materialise(wide(df, [column], by), "columns"), grid, cut, rule).drop("i")
    return out.withColumnRenamed("g", by) if by else out


def delay_density(df: DataFrame, grid: int = 200, clip: tuple[float, float] = DELAY_RANGE, rule: str = "scott") -> DataFrame:
    return density(df, "ARR_DELAY", None, grid, 0.0, rule, clip)


def numeric_densities(df: DataFrame, columns: Sequence[str] = NUMERIC, grid: int = 200, rule: str = "scott") -> DataFrame:
    """One density curve per listed column that exists, delay clipped; all curves share their passes."""
    columns = present(df, columns)
    if not columns:
        raise ValueError("none of the columns exists")
    df = clip_columns(df, {"ARR_DELAY": DELAY_RANGE} if "ARR_DELAY" in columns else {})
    out = _densities(materialise(wide(df, columns), "columns"), grid, 0.0, rule)
    return out.select(named(columns).alias("column"), "point", "x", "density")


def fences(quartiles: DataFrame) -> DataFrame:
    """Quartiles with the places 1.5 interquartile distances beyond them."""
    q = F.col("quantiles")
    reach = F.lit(1.5) * (q[2] - q[0])
    keys = [c for c in ("g", "i") if c in quartiles.columns]
    return quartiles.select(
        *keys, q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"), (q[0] - reach).alias("fence_low"), (q[2] + reach).alias("fence_high"), "n"
    )


def whiskers(boxes: DataFrame, partials: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The box table: quartiles, extreme values inside the fences, and how many lie beyond."""
    g = ["g"] if "g" in boxes.columns else []
    return _matched(boxes, merged(partials, "whiskers")).select(
        *g, named(columns).alias("column"), "q1", "median", "q3", F.col("found_low").alias("whisker_low"),
        F.col("found_high").alias("whisker_high"), F.col("found_n").alias("outliers"), "n",
    )


def box_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    ranges: dict[str, tuple[float, float]] | None = None,
    by: str | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and the count beyond them.

    Exact quartiles come from radix selection, and the whiskers from the same
    stored columns; ``approximate`` replaces the quartiles by one sketch pass
    for a first look at very large columns. There may be any number of groups.
    """
    columns = present(df, columns or NUMERIC)
    if not columns:
        raise ValueError("none of the columns exists")
    require(df, [by] if by else [])
    df = clip_columns(df, {c: r for c, r in (BOX_RANGES if ranges is None else ranges).items() if c in columns})
    rows = wide(df, columns, by)
    rows = materialise(rows.where(F.col("g").isNotNull()) if by else rows, "columns")
    if approximate:
        cells = [F.struct(F.lit(i).alias("i"), F.count(f"c{i}").alias("n"), F.percentile_approx(f"c{i}", [0.25, 0.5, 0.75], 10_000).alias("quantiles")) for i in range(len(columns))]
        quartiles = rows.groupBy(*(["g"] if by else [])).agg(F.array(*cells).alias("all")).select(*(["g"] if by else []), F.inline("all"))
    else:
        quartiles = quantile_table(rows, (0.25, 0.5, 0.75))
    boxes = held(fences(quartiles.where("n > 0")))
    own, table = boxes.settings("whiskers", "fence_low", "fence_high")
    out = whiskers(boxes.table, sweep(rows, Part("whiskers", {}, own), settings=table), columns)
    return out.withColumnRenamed("g", by) if by else out


def season_box(df: DataFrame) -> DataFrame:
    return box_stats(df, ["ARR_DELAY"], {"ARR_DELAY": DELAY_RANGE}, by="SEASON")


def season_density(df: DataFrame, grid: int = 100, cut: float = 2.0) -> DataFrame:
    """Violin outline per season: the curve runs two bandwidths past the data."""
    return density(df, "ARR_DELAY", "SEASON", grid, cut, clip=DELAY_RANGE)


def cyclical_points(df: DataFrame, prefixes: Sequence[str] = ("CRS_DEP_TIME", "CRS_ARR_TIME")) -> DataFrame:
    """Distinct clock positions with their counts: at most 1,440 per time column."""
    out = None
    for prefix in prefixes:
        if {f"{prefix}_sin", f"{prefix}_cos"} <= set(df.columns):
            pair = complete(df.select(F.col(f"{prefix}_sin").alias("s"), F.col(f"{prefix}_cos").alias("c")))
            minute = C.clock_minute(F.col("s"), F.col("c"))
            part = pair.select(F.lit(prefix).alias("time_column"), minute.alias("minute"))
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no encoded time columns")
    counted = out.groupBy("time_column", "minute").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "time_column", "minute", C.clock_sin(F.col("minute")).alias("sin"), C.clock_cos(F.col("minute")).alias("cos"), "n"
    )
