"""Principal components of a handful of columns over any number of rows.

The data-sized work is one scan of the complete rows, whose tasks keep means
and centred products that are then merged. The eigenvectors of the resulting columns-by-columns matrix are found on
the driver, and scores are plain column arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import label_view
from ..schema import COMPONENT_DEFAULTS, complete, present, require
from .relations import pair_moments

# Columns whose values colour the component views.
LABEL_VIEWS = {
    "Delay": "ARR_DELAY",
    "Peak Morning": "PEAK_MORNING",
    "Peak Evening": "PEAK_EVENING",
    "Season": "SEASON",
    "Month": "FL_MONTH",
    "Day of Week": "FL_DAY_OF_WEEK",
}


@dataclass(frozen=True)
class Components:
    columns: list[str]
    means: list[float]
    variances: list[float]
    loadings: list[list[float]]

    @property
    def ratios(self) -> list[float]:
        total = sum(self.variances)
        return [v / total if total else 0.0 for v in self.variances]


def fit_components(df: DataFrame, columns: Sequence[str] | None = None) -> Components:
    """All components, largest variance first.

    Data are centred, not scaled. In every component the first loading of
    largest magnitude is positive, which settles the sign.
    """
    columns = present(df, columns or COMPONENT_DEFAULTS)
    if len(columns) < 2:
        raise ValueError("at least two feature columns are needed")
    rows = complete(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    found = pair_moments(rows, columns)
    n = found.counts[0, 0]
    if n < 2:
        raise ValueError("at least two complete rows are needed")
    matrix = found.products / (n - 1)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1]
    loadings = []
    for position in order:
        vector = vectors[:, position]
        size = np.abs(vector)
        lead = int(np.argmax(size >= size.max() - 1e-9))
        loadings.append([float(x) for x in (vector if vector[lead] > 0 else -vector)])
    variances = [float(max(values[p], 0.0)) for p in order]
    return Components(columns, [float(m) for m in found.means.diagonal()], variances, loadings)


def variance_table(df: DataFrame, fitted: Components) -> DataFrame:
    rows, running = [], 0.0
    for i, (variance, ratio) in enumerate(zip(fitted.variances, fitted.ratios), start=1):
        running += ratio
        rows.append((f"PC{i}", variance, ratio, running))
    return df.sparkSession.createDataFrame(
        rows, "component string, variance double, ratio double, cumulative double"
    )


def loading_table(df: DataFrame, fitted: Components) -> DataFrame:
    rows = [
        (f"PC{i}", column, value)
        for i, vector in enumerate(fitted.loadings, start=1)
        for column, value in zip(fitted.columns, vector)
    ]
    return df.sparkSession.createDataFrame(rows, "component string, feature string, loading double")


def component_scores(df: DataFrame, fitted: Components, components: int = 2) -> DataFrame:
    """Centred scores beside all other columns of the row."""
    require(df, fitted.columns)
    scores = {}
    for i, vector in enumerate(fitted.loadings[:components], start=1):
        total = F.lit(0.0)
        for column, mean, weight in zip(fitted.columns, fitted.means, vector):
            total = total + (F.col(column).cast("double") - F.lit(mean)) * F.lit(weight)
        scores[f"PC{i}"] = total
    return complete(df, fitted.columns).withColumns(scores)


def labelled_scores(scores: DataFrame, column: str, mode: str) -> DataFrame:
    """Score points with a label as delay category, plain category or number."""
    require(scores, ["PC1", "PC2", column])
    return scores.select("PC1", "PC2", label_view(F.col(column), mode).alias("label"))


def label_summary(scores: DataFrame, views: dict[str, str] | None = None) -> DataFrame:
    """Centroid and count per label of every view.

    Components are fitted once and each row carries all its labels, so the
    views share one scan and one shuffle.
    """
    views = {k: c for k, c in (views or LABEL_VIEWS).items() if c in scores.columns}
    labels = []
    for view, column in views.items():
        mode = "delay_categorical" if column == "ARR_DELAY" else "generic_categorical"
        labels.append(F.struct(F.lit(view).alias("view"), label_view(F.col(column), mode).alias("label")))
    return (
        scores.select("PC1", "PC2", F.inline(F.array(*labels)))
        .groupBy("view", "label")
        .agg(F.avg("PC1").alias("mean_pc1"), F.avg("PC2").alias("mean_pc2"), F.count(F.lit(1)).alias("n"))
    )
