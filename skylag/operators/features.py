"""Derived columns.

Every operator leaves the table alone when its inputs are absent and keeps a
derived column that already exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def _derive(df: DataFrame, name: str, inputs: tuple[str, ...], value: Column) -> DataFrame:
    if name in df.columns or not set(inputs) <= set(df.columns):
        return df
    return df.withColumn(name, value)


def add_date_features(df: DataFrame, column: str = "FL_DATE") -> DataFrame:
    """Year, month and ISO weekday; the date itself is dropped."""
    if column not in df.columns:
        return df
    kind = dict(df.dtypes)[column]
    day = F.try_to_date(F.col(column)) if kind == "string" else F.col(column).cast("date")
    return df.withColumns(
        {
            "FL_YEAR": F.year(day),
            "FL_MONTH": F.month(day),
            "FL_DAY_OF_WEEK": C.iso_weekday(day),
        }
    ).drop(column)


def add_season(df: DataFrame) -> DataFrame:
    return _derive(df, "SEASON", ("FL_MONTH",), C.season(F.col("FL_MONTH")))


def add_weekend(df: DataFrame) -> DataFrame:
    return _derive(df, "IS_WEEKEND", ("FL_DAY_OF_WEEK",), C.weekend(F.col("FL_DAY_OF_WEEK")))


def add_route(df: DataFrame) -> DataFrame:
    value = C.route(F.col("ORIGIN_CITY"), F.col("DEST_CITY"))
    return _derive(df, "ROUTE", ("ORIGIN_CITY", "DEST_CITY"), value)


def add_avg_speed(df: DataFrame) -> DataFrame:
    """Miles per scheduled minute; NULL for a zero duration."""
    value = F.try_divide(F.col("DISTANCE"), F.col("CRS_ELAPSED_TIME"))
    return _derive(df, "AVG_SPEED", ("DISTANCE", "CRS_ELAPSED_TIME"), value)


def _whole(df: DataFrame, column: str) -> Column:
    """Scheduled time as a number; unreadable text becomes NULL."""
    value = F.col(column)
    return value.try_cast("double").try_cast("bigint") if dict(df.dtypes).get(column) == "string" else value


def add_dep_hour(df: DataFrame, time_encoding: str = "hhmm") -> DataFrame:
    value = C.hour(_whole(df, "CRS_DEP_TIME"), time_encoding)
    return _derive(df, "DEP_HOUR", ("CRS_DEP_TIME",), value)


def add_arr_hour(df: DataFrame, time_encoding: str = "hhmm") -> DataFrame:
    value = C.hour(_whole(df, "CRS_ARR_TIME"), time_encoding)
    return _derive(df, "ARR_HOUR", ("CRS_ARR_TIME",), value)


def add_peak_morning(df: DataFrame) -> DataFrame:
    value = C.within_hours(F.col("DEP_HOUR"), C.MORNING_PEAK)
    return _derive(df, "PEAK_MORNING", ("DEP_HOUR",), value)


def add_peak_evening(df: DataFrame) -> DataFrame:
    value = C.within_hours(F.col("DEP_HOUR"), C.EVENING_PEAK)
    return _derive(df, "PEAK_EVENING", ("DEP_HOUR",), value)


def add_cyclical_times(
    df: DataFrame, columns: tuple[str, ...] = ("CRS_DEP_TIME", "CRS_ARR_TIME")
) -> DataFrame:
    """Replace each scheduled time by its point on the unit circle."""
    for name in columns:
        if name in df.columns:
            minutes = C.hhmm_minutes(_whole(df, name))
            df = df.withColumns(
                {f"{name}_sin": C.clock_sin(minutes), f"{name}_cos": C.clock_cos(minutes)}
            ).drop(name)
    return df


def add_origin_state(df: DataFrame) -> DataFrame:
    return _derive(df, "ORIGIN_STATE", ("ORIGIN_CITY",), C.last_comma_part(F.col("ORIGIN_CITY")))


def add_dest_state(df: DataFrame) -> DataFrame:
    return _derive(df, "DEST_STATE", ("DEST_CITY",), C.last_comma_part(F.col("DEST_CITY")))


def add_delay_category(df: DataFrame, column: str = "ARR_DELAY") -> DataFrame:
    return _derive(df, "DELAY_CATEGORY", (column,), C.delay_category(F.col(column)))
