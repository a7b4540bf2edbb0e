"""Column drops, row filters and the missing-value report."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schema import LEAKAGE_COLUMNS, complete


def drop_columns(df: DataFrame, columns: Iterable[str] = LEAKAGE_COLUMNS) -> DataFrame:
    """Drop leakage columns; absent ones are ignored."""
    return df.drop(*columns)


def filter_completed(df: DataFrame, flags: tuple[str, str] = ("CANCELLED", "DIVERTED")) -> DataFrame:
    """Keep flights that were neither cancelled nor diverted, then drop the flags.

    Nothing happens unless both flags exist.
    """
    if not set(flags) <= set(df.columns):
        return df
    keep = (F.col(flags[0]) == 0) & (F.col(flags[1]) == 0)
    return df.where(keep).drop(*flags)


def clean_na(df: DataFrame) -> DataFrame:
    """Complete cases only."""
    return complete(df)


def fix_negative_delays(df: DataFrame, column: str = "ARR_DELAY") -> DataFrame:
    """Early arrivals count as zero; a missing delay stays missing."""
    if column not in df.columns:
        return df
    return df.withColumn(column, C.clip(F.col(column), 0.0, None))


def clip_columns(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Bound the listed columns that exist."""
    bounded = {c: C.clip(F.col(c), *r) for c, r in ranges.items() if c in df.columns}
    return df.withColumns(bounded) if bounded else df


def missing_measures(df: DataFrame) -> list[Column]:
    """Rows, missing per column, incomplete rows, flag totals and negative delays, as doubles."""
    any_missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns])
    measures = [F.count(F.lit(1)).cast("double").alias("rows")]
    measures += [F.count_if(F.col(c).isNull()).cast("double").alias(f"missing {c}") for c in df.columns]
    measures += [F.count_if(any_missing).cast("double").alias("rows with missing")]
    for flag, label in (("CANCELLED", "cancelled"), ("DIVERTED", "diverted")):
        if flag in df.columns:
            measures.append(F.sum(flag).cast("double").alias(label))
    if "ARR_DELAY" in df.columns:
        measures.append(F.count_if(F.col("ARR_DELAY") < 0).cast("double").alias("negative delays"))
    return measures


def missing_report(df: DataFrame) -> DataFrame:
    """``(metric, value)``: rows, missing per column, incomplete rows, flag totals.

    One aggregate over one scan; the single row is turned into a long table.
    """
    wide = df.agg(*missing_measures(df))
    share = F.try_divide(F.col("rows with missing") * 100, F.col("rows"))
    wide = wide.withColumn("percent with missing", share)
    return wide.unpivot([], wide.columns, "metric", "value")


def observed_missing(df: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The table, to be written or read in full once, and what makes its :func:`missing_report` of that very scan.

    Nothing between the table and the sink may shuffle, so that every task is counted once.
    """
    seen = Observation()
    watched = df.observe(seen, *missing_measures(df))

    def report() -> DataFrame:
        found = dict(seen.get)
        found["percent with missing"] = 100 * found["rows with missing"] / found["rows"] if found["rows"] else None
        return df.sparkSession.createDataFrame([(k, None if v is None else float(v)) for k, v in found.items()], "metric string, value double")

    return watched, report
