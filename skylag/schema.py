"""Column names, types and guards of the flight tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns removed before modelling because they are known only
# after the flight or repeat another column.
LEAKAGE_COLUMNS = (
    "DEP_DELAY",
    "DELAY_DUE_CARRIER",
    "DELAY_DUE_WEATHER",
    "DELAY_DUE_SECURITY",
    "DELAY_DUE_NAS",
    "DELAY_DUE_LATE_AIRCRAFT",
    "ARR_TIME",
    "DEP_TIME",
    "WHEELS_OFF",
    "WHEELS_ON",
    "TAXI_OUT",
    "TAXI_IN",
    "ELAPSED_TIME",
    "AIR_TIME",
    "CANCELLATION_CODE",
    "AIRLINE",
    "AIRLINE_CODE",
    "AIRLINE_DOT",
    "FL_NUMBER",
    "ORIGIN",
    "DEST",
)

# Columns that are z-scored when present.
SCALED_COLUMNS = (
    "CRS_DEP_TIME",
    "CRS_ARR_TIME",
    "DISTANCE",
    "CRS_ELAPSED_TIME",
    "AVG_SPEED",
    "DEP_HOUR",
    "ARR_HOUR",
)

# Columns of the correlation matrix.
CORRELATED_COLUMNS = (
    "DISTANCE",
    "CRS_ELAPSED_TIME",
    "ARR_DELAY",
    "AVG_SPEED",
    "PEAK_MORNING",
    "PEAK_EVENING",
    "CRS_DEP_TIME_sin",
    "CRS_DEP_TIME_cos",
    "CRS_ARR_TIME_sin",
    "CRS_ARR_TIME_cos",
)

# Default and full feature lists of the component analysis and
# of the neighbour graph.
COMPONENT_DEFAULTS = ("AVG_SPEED", "DISTANCE", "CRS_ELAPSED_TIME")
COMPONENT_FEATURES = COMPONENT_DEFAULTS + (
    "CRS_DEP_TIME_sin",
    "CRS_DEP_TIME_cos",
    "CRS_ARR_TIME_sin",
    "CRS_ARR_TIME_cos",
)
NEIGHBOUR_FEATURES = COMPONENT_FEATURES + (
    "FL_MONTH",
    "FL_DAY_OF_WEEK",
    "SEASON",
    "PEAK_MORNING",
    "PEAK_EVENING",
)

_TEXT = T.StringType()
_REAL = T.DoubleType()
_WHOLE = T.LongType()

# Type of every column a raw file may carry; all columns accept NULL.
RAW_TYPES: dict[str, T.DataType] = {
    "FLIGHT_ID": _TEXT,
    "FL_DATE": T.DateType(),
    "AIRLINE": _TEXT,
    "AIRLINE_DOT": _TEXT,
    "AIRLINE_CODE": _TEXT,
    "DOT_CODE": _WHOLE,
    "FL_NUMBER": _WHOLE,
    "ORIGIN": _TEXT,
    "ORIGIN_CITY": _TEXT,
    "DEST": _TEXT,
    "DEST_CITY": _TEXT,
    "CRS_DEP_TIME": _WHOLE,
    "DEP_TIME": _REAL,
    "DEP_DELAY": _REAL,
    "TAXI_OUT": _REAL,
    "WHEELS_OFF": _REAL,
    "WHEELS_ON": _REAL,
    "TAXI_IN": _REAL,
    "CRS_ARR_TIME": _WHOLE,
    "ARR_TIME": _REAL,
    "ARR_DELAY": _REAL,
    "CANCELLED": _REAL,
    "CANCELLATION_CODE": _TEXT,
    "DIVERTED": _REAL,
    "CRS_ELAPSED_TIME": _REAL,
    "ELAPSED_TIME": _REAL,
    "AIR_TIME": _REAL,
    "DISTANCE": _REAL,
    "DELAY_DUE_CARRIER": _REAL,
    "DELAY_DUE_WEATHER": _REAL,
    "DELAY_DUE_NAS": _REAL,
    "DELAY_DUE_SECURITY": _REAL,
    "DELAY_DUE_LATE_AIRCRAFT": _REAL,
}

# Columns of a cleaned table whose text form must be typed on re-read.
CLEAN_TYPES: dict[str, T.DataType] = {
    **{
        name: T.IntegerType()
        for name in (
            "FL_YEAR",
            "FL_MONTH",
            "FL_DAY_OF_WEEK",
            "SEASON",
            "IS_WEEKEND",
            "DEP_HOUR",
            "ARR_HOUR",
            "PEAK_MORNING",
            "PEAK_EVENING",
        )
    },
    **{
        name: _REAL
        for name in (
            "AVG_SPEED",
            "CRS_DEP_TIME_sin",
            "CRS_DEP_TIME_cos",
            "CRS_ARR_TIME_sin",
            "CRS_ARR_TIME_cos",
        )
    },
    "ROUTE": _TEXT,
    "ORIGIN_STATE": _TEXT,
    "DEST_STATE": _TEXT,
}


def require(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise when a column an aggregate needs is absent (no job is run)."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The requested columns that exist, in the requested order."""
    return [name for name in columns if name in df.columns]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def is_known(columns: Iterable[str]) -> Column:
    """True where none of the columns is NULL (scans turn NaN into NULL).

    One condition per column, unlike ``dropna``: each can be pushed to the
    scan on its own, and columns that cannot be NULL cost nothing.
    """
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def complete(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows in which all (or the listed) columns are known."""
    return df.where(is_known(df.columns if columns is None else columns))
