"""How the report's tables are compared: their key columns, and their values with the digits that count."""

from __future__ import annotations

_MEAN = {"avg_delay": 6, "flights": 0}
_RATE = {"delay_rate": 6, "flights": 0}
_LINE = {"n": 0, "slope": 9, "intercept": 6, "r2": 9, "residual_se": 6, "slope_se": 9, "intercept_se": 6}
_BINS = {"bin_low": 6, "bin_high": 6, "n": 0}
_CURVE = {"x": 6, "density": 9}
_BOX = {"q1": 6, "median": 6, "q3": 6, "whisker_low": 6, "whisker_high": 6, "outliers": 0, "n": 0}

REPORT = {
    "describe_numeric": (("column",), {"count": 0, "mean": 6, "std": 6, "min": 6, "q25": 6, "q50": 6, "q75": 6, "max": 6}),
    "describe_text": (("column", "top"), {"count": 0, "unique": 0, "freq": 0}),
    "delay_histogram": (("column", "bin"), _BINS),
    "delay_density": (("point",), _CURVE),
    "numeric_histograms": (("column", "bin"), _BINS),
    "numeric_densities": (("column", "point"), _CURVE),
    "box_stats": (("column",), _BOX),
    "cyclical_points": (("time_column", "minute"), {"sin": 6, "cos": 6, "n": 0}),
    "correlation_matrix": (("var1", "var2"), {"corr": 6}),
    "delay_by_weekday": (("FL_DAY_OF_WEEK",), _MEAN),
    "delay_rate_by_weekday": (("FL_DAY_OF_WEEK",), _RATE),
    "delay_by_month": (("FL_MONTH",), _MEAN),
    "delay_vs_distance": ((), _LINE),
    "delay_vs_elapsed": ((), _LINE),
    "delay_by_weekday_and_month": (("FL_DAY_OF_WEEK", "FL_MONTH"), _MEAN),
    "delay_by_time_and_month": (("time_bin", "FL_MONTH"), _MEAN),
    "delay_by_time_of_day": (("time_bin",), _MEAN),
    "route_delay_rate": (("ROUTE",), _RATE),
    "season_box": (("SEASON", "column"), _BOX),
    "season_density": (("SEASON", "point"), _CURVE),
    "origin_volume": (("ORIGIN_CITY",), _MEAN),
    "top_airlines": (("DOT_CODE",), _MEAN),
    "top_origins": (("ORIGIN_CITY",), _MEAN),
    "top_destinations": (("DEST_CITY",), _MEAN),
}
