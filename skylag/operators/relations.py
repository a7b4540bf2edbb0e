"""Correlations and covariances from merged co-moments, and straight-line fits, each in one scan."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.student_t import upper_critical
from ..schema import CORRELATED_COLUMNS, complete, present, require
from ..session import cut_lineage, materialise
from .cleaning import clip_columns
from .distributions import DELAY_RANGE
from .partials import merged_moments, moments, sweep, wide


def _real(name: str) -> Column:
    return F.col(name).cast("double")


@dataclass(frozen=True)
class CoMoments:
    """Counts, means and centred sums of products of every two columns over the rows in which both are known.

    ``means[i][j]`` is the mean of column i, ``squares[i][j]`` its centred sum
    of squares, over the rows in which column j is known too.
    """

    columns: list[str]
    counts: np.ndarray
    means: np.ndarray
    squares: np.ndarray
    products: np.ndarray

    def covariance(self, i: int, j: int) -> float | None:
        return self.products[i, j] / (self.counts[i, j] - 1) if self.counts[i, j] > 1 else None

    def correlation(self, i: int, j: int) -> float | None:
        """None beside a constant column: a mean square that is rounding noise of the mean counts as zero."""
        n, x, y = self.counts[i, j], self.squares[i, j], self.squares[j, i]
        if not (x > n * (abs(self.means[i, j]) * 1e-14) ** 2 and y > n * (abs(self.means[j, i]) * 1e-14) ** 2):
            return None
        return 1.0 if i == j else self.products[i, j] / (math.sqrt(x) * math.sqrt(y))


def comoments(partials: DataFrame, columns: Sequence[str], numbers: Sequence[int] | None = None) -> CoMoments:
    """The merged pair moments of a sweep: columns squared rows, as matrices.

    ``numbers`` are the swept columns to take, all by default.
    """
    numbers = list(range(len(columns)) if numbers is None else numbers)
    place = {k: i for i, k in enumerate(numbers)}
    counts, means, squares, products = (np.zeros((len(numbers),) * 2) for _ in range(4))
    for r in merged_moments(partials.where(F.col("i").isin(numbers) & F.col("j").isin(numbers))).collect():
        at = place[r["i"]], place[r["j"]]
        counts[at], means[at], squares[at], products[at] = r["n"], r["x"], max(r["xx"], 0.0), r["xy"]
    # both halves alike to the last bit
    products = np.triu(products) + np.triu(products, 1).T
    return CoMoments(list(columns), counts, means, squares, products)


def pair_moments(df: DataFrame, columns: Sequence[str]) -> CoMoments:
    """One scan: every task keeps counts, means and centred products, and those of all tasks are merged."""
    return comoments(sweep(wide(df, columns), moments(pairs=True)), columns)


def _matrix_table(df: DataFrame, found: CoMoments, cell: Callable[[int, int], float | None], value: str) -> DataFrame:
    rows = [(a, b, None if (v := cell(i, j)) is None else float(v)) for i, a in enumerate(found.columns) for j, b in enumerate(found.columns)]
    return df.sparkSession.createDataFrame(rows, f"var1 string, var2 string, {value} double")


def correlation_table(df: DataFrame, found: CoMoments) -> DataFrame:
    return _matrix_table(df, found, found.correlation, "corr")


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED_COLUMNS) -> DataFrame:
    """Pearson matrix over pairwise complete rows, from one scan; NULL beside a constant column."""
    columns = present(df, columns)
    if not columns:
        raise ValueError("none of the columns exists")
    return correlation_table(df, pair_moments(df, columns))


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample covariances over pairwise complete rows, from one scan; NULL below two rows."""
    require(df, columns)
    found = pair_moments(df, columns)
    return _matrix_table(df, found, found.covariance, "cov")


def fit_line(
    df: DataFrame, x: str, y: str = "ARR_DELAY", clip: tuple[float, float] | None = DELAY_RANGE
) -> DataFrame:
    """Least-squares line of the clipped ``y`` on ``x`` with standard errors."""
    require(df, [x, y])
    if clip:
        df = clip_columns(df, {y: clip})
    a, b = _real(y), _real(x)
    sums = df.agg(
        F.regr_count(a, b).alias("n"),
        F.regr_slope(a, b).alias("slope"),
        F.regr_intercept(a, b).alias("intercept"),
        F.regr_r2(a, b).alias("r2"),
        F.regr_sxx(a, b).alias("sxx"),
        F.regr_syy(a, b).alias("syy"),
        F.regr_avgx(a, b).alias("mean_x"),
        F.min(F.when(a.isNotNull(), b)).alias("min_x"),
        F.max(F.when(a.isNotNull(), b)).alias("max_x"),
    )
    return _with_errors(sums)


def line_of(df: DataFrame, found: CoMoments, x: int, y: int, low: float | None, high: float | None) -> DataFrame:
    """The row of :func:`fit_line` from merged co-moments; x is null where y is, low and high are its extremes."""
    n, sxx, syy, sxy = int(found.counts[x, y]), found.squares[x, y], found.squares[y, x], found.products[x, y]
    mean_x, mean_y = found.means[x, y], found.means[y, x]
    slope = sxy / sxx if n > 1 and sxx > 0 else None
    intercept = None if slope is None else mean_y - slope * mean_x
    r2 = None if slope is None else (sxy * sxy / (sxx * syy) if syy > 0 else 1.0)
    row = [None if v is None else float(v) for v in (slope, intercept, r2, sxx, syy, mean_x, low, high)]
    schema = "n bigint, slope double, intercept double, r2 double, sxx double, syy double, mean_x double, min_x double, max_x double"
    return _with_errors(df.sparkSession.createDataFrame([(n, *row)], schema))


def _with_errors(sums: DataFrame) -> DataFrame:
    residual = F.greatest(F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx"), F.lit(0.0))
    fitted = sums.withColumn(
        "residual_se", F.when(F.col("n") > 2, F.sqrt(F.try_divide(residual, F.col("n") - 2)))
    )
    centre = F.try_divide(F.col("mean_x") * F.col("mean_x"), F.col("sxx"))
    return fitted.withColumns(
        {
            "slope_se": F.col("residual_se") * F.sqrt(F.try_divide(F.lit(1.0), F.col("sxx"))),
            "intercept_se": F.col("residual_se") * F.sqrt(F.try_divide(F.lit(1.0), F.col("n")) + centre),
        }
    )


def line_band(
    df: DataFrame, x: str, y: str = "ARR_DELAY", points: int = 80, clip: tuple[float, float] | None = DELAY_RANGE
) -> DataFrame:
    """The fitted line on an even grid with its 95 % confidence band."""
    line = fit_line(df, x, y, clip).where(F.col("n") > 2)
    step = (F.col("max_x") - F.col("min_x")) / F.lit(float(points - 1))
    grid = line.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = grid.withColumn("x", F.col("min_x") + step * F.col("point"))
    middle = F.col("intercept") + F.col("slope") * F.col("x")
    offset = F.col("x") - F.col("mean_x")
    error = F.col("residual_se") * F.sqrt(F.lit(1.0) / F.col("n") + offset * offset / F.col("sxx"))
    half = upper_critical(F.col("n") - F.lit(2)) * error
    return grid.select("point", "x", middle.alias("fit"), (middle - half).alias("low"), (middle + half).alias("high"))


# Poisson(1) cumulative probabilities times 2^32; a draw's weight is how many of them it reaches.
_POISSON = [round(2**32 * math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1))) for k in range(11)]


def _weight_seeds(id_column: str, seed: int) -> list[Column]:
    """Two 32-bit numbers of the row's md5: replicate r draws (first + r * second) mod 2^32, second odd.

    Draws of different rows are independent, those of one row in two
    replicates pairwise so; the same row weighs the same however rows are dealt.
    """
    digest = F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(f"|{seed}")))
    number = lambda start: F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
    return [number(1).alias("a"), number(9).bitwiseOR(F.lit(1)).alias("b")]


def _replicate_sums(rows: DataFrame, replicates: int, mean_x: float, mean_y: float) -> np.ndarray:
    """Weighted count and sums of x, y, xx, xy about the means for every replicate, in one scan."""

    def run(batches):
        total = np.zeros((replicates, 5))
        steps = np.arange(replicates, dtype=np.int64)
        for batch in batches:
            a, b, x, y = (batch.column(c).to_numpy() for c in ("a", "b", "x", "y"))
            x, y = x - mean_x, y - mean_y
            values = np.stack([np.ones(len(x)), x, y, x * x, x * y], axis=1)
            for at in range(0, len(x), 4096):
                draws = (a[at : at + 4096, None] + b[at : at + 4096, None] * steps) & 0xFFFFFFFF
                weight = np.searchsorted(_POISSON, draws.reshape(-1), "right").reshape(draws.shape)
                total += weight.T.astype(np.float64) @ values[at : at + 4096]
        out = {"replicate": pa.array(steps, pa.int32())} | {f"s{k}": pa.array(total[:, k]) for k in range(5)}
        yield pa.RecordBatch.from_pydict(out)

    partial = rows.mapInArrow(run, "replicate int, s0 double, s1 double, s2 double, s3 double, s4 double")
    merged_ = partial.groupBy("replicate").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(5)])
    out = np.zeros((replicates, 5))
    for r in merged_.collect():
        out[r["replicate"]] = [r[f"s{k}"] for k in range(5)]
    return out


def resampled_band(
    df: DataFrame,
    x: str,
    y: str = "ARR_DELAY",
    points: int = 80,
    clip: tuple[float, float] | None = DELAY_RANGE,
    id_column: str = "FLIGHT_ID",
    replicates: int = 200,
    level: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """The fitted line on an even grid with a band from a Poisson bootstrap.

    Every row has a Poisson(1) weight in each replicate, drawn from the md5 of
    its identifier. All replicates' sums come from one scan; the band lies
    between the interpolated quantiles of the replicates' lines at each point.
    Replicates without a line (all rows alike or none) are left out; no rows, or
    a constant x, give no band.
    """
    require(df, [x, y, id_column])
    if clip:
        df = clip_columns(df, {y: clip})
    rows = complete(df.select(*_weight_seeds(id_column, seed), _real(x).alias("x"), _real(y).alias("y")), ["x", "y"])
    rows = materialise(rows, "resampled")
    partials = cut_lineage(sweep(wide(rows, ["x", "y"]), moments(pairs=True)))
    found = comoments(partials, ["x", "y"])
    schema = "point int, x double, fit double, low double, high double"
    if found.counts[0, 0] < 2 or found.squares[0, 0] <= 0:
        return df.sparkSession.createDataFrame([], schema)
    ends = partials.where("i = 0 AND j = 0").agg(F.min("low"), F.max("high")).first()
    mean_x, mean_y = found.means[0, 0], found.means[1, 1]
    n, sx, sy, sxx, sxy = _replicate_sums(rows, replicates, float(mean_x), float(mean_y)).T
    with np.errstate(all="ignore"):
        slope = (sxy - sx * sy / n) / (sxx - sx * sx / n)
        at_mean = mean_y + sy / n - slope * sx / n
    sound = np.isfinite(slope)
    grid = ends[0] + (ends[1] - ends[0]) / (points - 1) * np.arange(points)
    lines = at_mean[sound, None] + slope[sound, None] * (grid - mean_x)
    fit = mean_y + found.products[0, 1] / found.squares[0, 0] * (grid - mean_x)
    low, high = np.quantile(lines, ((1 - level) / 2, (1 + level) / 2), axis=0) if sound.any() else (np.full(points, np.nan),) * 2
    table = [(i, *[None if math.isnan(v) else float(v) for v in row]) for i, row in enumerate(zip(grid, fit, low, high))]
    return df.sparkSession.createDataFrame(table, schema)


def point_counts(
    df: DataFrame, x: str, y: str = "ARR_DELAY", clip: tuple[float, float] | None = DELAY_RANGE
) -> DataFrame:
    """The points of a scatter chart, equal points merged and counted."""
    require(df, [x, y])
    if clip:
        df = clip_columns(df, {y: clip})
    return complete(df.select(x, y)).groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))
