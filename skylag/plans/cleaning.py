"""The preprocessing chain as one lazy plan."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame

from ..operators import cleaning as K
from ..operators import features as X


def row_steps(time_encoding: str = "hhmm") -> list:
    """The steps in the order that keeps their inputs alive.

    Hours need the raw scheduled times, so they come before the cyclical
    conversion, which drops them. No step shuffles, so the whole chain is one
    stage over the scan, on a batch or on a stream.
    """
    return [
        K.drop_columns,
        K.filter_completed,
        K.clean_na,
        X.add_date_features,
        X.add_season,
        X.add_weekend,
        X.add_route,
        X.add_avg_speed,
        partial(X.add_dep_hour, time_encoding=time_encoding),
        partial(X.add_arr_hour, time_encoding=time_encoding),
        X.add_peak_morning,
        X.add_peak_evening,
        X.add_cyclical_times,
        X.add_origin_state,
        X.add_dest_state,
        K.fix_negative_delays,
    ]


def clean_flights(raw: DataFrame, time_encoding: str = "hhmm") -> DataFrame:
    return reduce(DataFrame.transform, row_steps(time_encoding), raw)
