"""Grouped delay tables.

All of them are plain hash aggregates: rows are combined before the shuffle,
so a key that holds a large share of the rows costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schema import complete, require

DELAY = "ARR_DELAY"


def mean_delay(df: DataFrame, keys: Sequence[str], delay: str = DELAY) -> DataFrame:
    """Mean delay and row count per key; rows with a missing key are left out."""
    require(df, [*keys, delay])
    return (
        complete(df, keys)
        .groupBy(*keys)
        .agg(F.avg(delay).alias("avg_delay"), F.count(F.lit(1)).alias("flights"))
    )


def delay_rate(df: DataFrame, keys: Sequence[str], delay: str = DELAY) -> DataFrame:
    """Percentage of delayed rows and row count per key."""
    require(df, [*keys, delay])
    rate = F.avg(C.delayed(F.col(delay))) * F.lit(100.0)
    return (
        complete(df, keys)
        .groupBy(*keys)
        .agg(rate.alias("delay_rate"), F.count(F.lit(1)).alias("flights"))
    )


def delay_by_weekday(df: DataFrame) -> DataFrame:
    return mean_delay(df, ["FL_DAY_OF_WEEK"])


def delay_rate_by_weekday(df: DataFrame) -> DataFrame:
    return delay_rate(df, ["FL_DAY_OF_WEEK"])


def delay_by_month(df: DataFrame) -> DataFrame:
    return mean_delay(df, ["FL_MONTH"])


def delay_by_weekday_and_month(df: DataFrame) -> DataFrame:
    return mean_delay(df, ["FL_DAY_OF_WEEK", "FL_MONTH"])


def delay_month_matrix(df: DataFrame, delay: str = DELAY) -> DataFrame:
    """Weekday rows by month columns; listing the months saves the distinct job."""
    require(df, ["FL_DAY_OF_WEEK", "FL_MONTH", delay])
    wide = (
        complete(df, ["FL_DAY_OF_WEEK", "FL_MONTH"])
        .groupBy("FL_DAY_OF_WEEK")
        .pivot("FL_MONTH", list(range(1, 13)))
        .agg(F.avg(delay))
    )
    names = [F.col(str(m)).alias(f"month_{m:02d}") for m in range(1, 13)]
    return wide.select("FL_DAY_OF_WEEK", *names)


def delay_grouping_sets(df: DataFrame, delay: str = DELAY) -> DataFrame:
    """Weekday, month, weekday by month and season tables from a single scan."""
    keys = ["FL_DAY_OF_WEEK", "FL_MONTH", "SEASON"]
    require(df, [*keys, delay])
    day, month, season = (F.col(k) for k in keys)
    # Collapsing to the finest key first lets the four-way expansion run over
    # at most 84 sums per task instead of over every row.
    finest = complete(df, keys).groupBy(*keys).agg(
        F.sum(delay).alias("total"),
        F.count(delay).alias("known"),
        F.sum(C.delayed(F.col(delay))).alias("late"),
        F.count(F.lit(1)).alias("rows"),
    )
    sets = finest.groupingSets([[day], [month], [day, month], [season]], day, month, season)
    return sets.agg(
        F.grouping_id(*keys).cast("int").alias("grouping_id"),
        F.try_divide(F.sum("total"), F.sum("known")).alias("avg_delay"),
        F.try_divide(F.sum("late") * F.lit(100.0), F.sum("rows")).alias("delay_rate"),
        F.sum("rows").alias("flights"),
    )


def _departure_bin(prefix: str, bins: int) -> Column:
    minute = C.clock_minute(F.col(f"{prefix}_sin"), F.col(f"{prefix}_cos"))
    return C.time_bin(minute, bins)


def delay_by_time_and_month(
    df: DataFrame, bins: int = 24, prefix: str = "CRS_DEP_TIME", delay: str = DELAY
) -> DataFrame:
    """Mean delay per time-of-day bin and month over complete rows."""
    needed = [f"{prefix}_sin", f"{prefix}_cos", "FL_MONTH", delay]
    require(df, needed)
    rows = complete(df.select(*needed))
    return (
        rows.groupBy(_departure_bin(prefix, bins).alias("bin"), "FL_MONTH")
        .agg(F.avg(delay).alias("avg_delay"), F.count(F.lit(1)).alias("flights"))
        .select(C.bin_label(F.col("bin")).alias("time_bin"), "FL_MONTH", "avg_delay", "flights")
    )


def delay_by_time_of_day(
    df: DataFrame, bins: int = 24, prefix: str = "CRS_DEP_TIME", delay: str = DELAY
) -> DataFrame:
    """Mean delay per time-of-day bin; empty bins are kept with no mean."""
    needed = [f"{prefix}_sin", f"{prefix}_cos", delay]
    require(df, needed)
    rows = complete(df.select(*needed))
    found = rows.groupBy(_departure_bin(prefix, bins).alias("time_bin")).agg(
        F.avg(delay).alias("avg_delay"), F.count(F.lit(1)).alias("flights")
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("time_bin"))
    return every.join(found, "time_bin", "left").select(
        "time_bin", "avg_delay", F.coalesce("flights", F.lit(0)).alias("flights")
    )


def route_delay_rate(df: DataFrame, top_n: int = 15, min_flights: int = 3000) -> DataFrame:
    """Delay rate of the busiest routes; ties are settled by route name."""
    busy = delay_rate(df, ["ROUTE"]).where(F.col("flights") >= min_flights)
    return busy.orderBy(F.desc("flights"), "ROUTE").limit(top_n)


def volume_and_delay(df: DataFrame, key: str = "ORIGIN_CITY", min_flights: int = 2000) -> DataFrame:
    """Mean delay beside traffic for every place above the floor."""
    return mean_delay(df, [key]).where(F.col("flights") >= min_flights)


def top_by_mean_delay(df: DataFrame, key: str, top_n: int = 15, min_flights: int = 2000) -> DataFrame:
    """Keys with the highest mean delay above the traffic floor, key as text."""
    ranked = volume_and_delay(df, key, min_flights)
    ranked = ranked.orderBy(F.desc("avg_delay"), key).limit(top_n)
    return ranked.select(F.col(key).cast("string").alias(key), "avg_delay", "flights")


def top_airlines(df: DataFrame, top_n: int = 15, min_flights: int = 5000) -> DataFrame:
    return top_by_mean_delay(df, "DOT_CODE", top_n, min_flights)


def top_origins(df: DataFrame, top_n: int = 15, min_flights: int = 2000) -> DataFrame:
    return top_by_mean_delay(df, "ORIGIN_CITY", top_n, min_flights)


def top_destinations(df: DataFrame, top_n: int = 15, min_flights: int = 2000) -> DataFrame:
    return top_by_mean_delay(df, "DEST_CITY", top_n, min_flights)
