"""Preview and summary statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import numeric_columns, require, text_columns
from .quantiles import summarise


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order; only those rows leave the executors."""
    require(df, order_by)
    return df.orderBy(*order_by).limit(rows)


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, one row per column.

    The quartiles are exact unless ``approximate`` asks for one sketch pass.
    """
    columns = list(columns or numeric_columns(df))
    require(df, columns)
    schema = "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    if not approximate:
        rows = [
            (s.column, s.count, s.mean, s.std, s.low, *s.quantiles, s.high) for s in summarise(df, columns)
        ]
        empty = set(columns) - {r[0] for r in rows}
        rows += [(c, 0, *[None] * 7) for c in sorted(empty)]
        return df.sparkSession.createDataFrame(rows, schema)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    value = F.col("value")
    quartiles = F.percentile_approx(value, [0.25, 0.5, 0.75], 10_000)
    return (
        long.groupBy("column")
        .agg(
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            quartiles.alias("q"),
            F.max(value).alias("max"),
        )
        .select("column", "count", "mean", "std", "min", *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))], "max")
    )


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per column.

    Values are counted per column first, so repeated values never travel; the
    alphabetically first value wins a tie.
    """
    columns = list(columns or text_columns(df))
    require(df, columns)
    counts = (
        df.select(*columns)
        .unpivot([], columns, "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("negated"), F.col("value").alias("value")))
    return (
        counts.groupBy("column")
        .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("best"))
        .select("column", "count", "unique", F.col("best.value").alias("top"), (-F.col("best.negated")).alias("freq"))
    )


def table_schema(df: DataFrame) -> DataFrame:
    """Column names and types as a table; metadata only."""
    return df.sparkSession.createDataFrame(
        [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)], "position int, column string, type string"
    )


def full_summary(df: DataFrame) -> DataFrame:
    """Shape, types, missing values and statistics of all columns, one row per column.

    ``rows`` and ``columns`` are the table's shape. Numeric columns have mean,
    deviation, extremes and quartiles, text columns distinct values, the most
    frequent one and its frequency; what does not apply is NULL.
    """
    numbers = numeric_columns(df)
    texts = text_columns(df)
    others = [c for c in df.columns if c not in (*numbers, *texts)]
    sizes = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(others)]).first()
    counted = {c: sizes[f"n{i}"] for i, c in enumerate(others)}
    known = {r["column"]: r for r in describe_numeric(df, numbers).collect()} if numbers else {}
    worded = {r["column"]: r for r in describe_text(df, texts).collect()} if texts else {}
    measures = ("mean", "std", "min", "q25", "q50", "q75", "max")
    rows = []
    for i, (name, kind) in enumerate(df.dtypes):
        number, text = known.get(name), worded.get(name)
        count = counted.get(name, 0) if name in others else (number or text or {"count": 0})["count"]
        said = (text["unique"], text["top"], text["freq"]) if text else (0 if name in texts else None, None, None)
        rows.append(
            (i, name, kind, sizes["rows"], len(df.columns), sizes["rows"] - count, count, *said, *[number[m] if number else None for m in measures])
        )
    return df.sparkSession.createDataFrame(
        rows,
        "position int, column string, type string, rows bigint, columns int, missing bigint, count bigint, unique bigint, top string, "
        "freq bigint, " + ", ".join(f"{m} double" for m in measures),
    )
