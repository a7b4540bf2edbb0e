"""Edge rows of cleaning and derived columns."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skylag.functions import columns as C
from skylag.operators import cleaning as K
from skylag.operators import features as X
from skylag.plans.cleaning import clean_flights
from skylag.schema import LEAKAGE_COLUMNS, require
from skylag.sources.files import normalise_missing

from .conftest import SMALL, column, plan


def test_missing_delay_survives_bounds(spark):
    df = spark.createDataFrame([(None,), (-100.0,), (5.0,), (999.0,)], "ARR_DELAY double")
    assert column(K.clip_columns(df, {"ARR_DELAY": (-60, 180)}), "ARR_DELAY") == [None, -60.0, 5.0, 180.0]
    assert column(K.fix_negative_delays(df), "ARR_DELAY") == [None, 0.0, 5.0, 999.0]


def test_nan_is_missing_after_the_scan(spark):
    df = normalise_missing(spark.createDataFrame([(float("nan"),), (1.0,)], "ARR_DELAY double"))
    assert column(df, "ARR_DELAY") == [None, 1.0]
    assert K.clean_na(df).count() == 1


def test_drop_ignores_absent_columns(spark):
    df = spark.createDataFrame([(1, 2)], "AIR_TIME int, DISTANCE int")
    assert K.drop_columns(df).columns == ["DISTANCE"]
    assert len(LEAKAGE_COLUMNS) == 21


def test_filter_needs_both_flags(spark):
    both = spark.createDataFrame([(0.0, 0.0, 1), (1.0, 0.0, 2), (0.0, 1.0, 3), (None, 0.0, 4)], "CANCELLED double, DIVERTED double, x int")
    kept = K.filter_completed(both)
    assert kept.columns == ["x"] and column(kept, "x") == [1]
    one = both.drop("DIVERTED")
    assert K.filter_completed(one) is one


def test_calendar(spark):
    days = [dt.date(2023, 1, 1), dt.date(2024, 2, 29), dt.date(2023, 12, 4)]
    df = spark.createDataFrame([(d,) for d in days], "FL_DATE date")
    out = X.add_weekend(X.add_season(X.add_date_features(df)))
    assert [tuple(r) for r in out.select("FL_YEAR", "FL_MONTH", "FL_DAY_OF_WEEK", "SEASON", "IS_WEEKEND").collect()] == [
        (2023, 1, 7, 1, 1),
        (2024, 2, 4, 1, 0),
        (2023, 12, 1, 1, 0),
    ]
    assert "FL_DATE" not in out.columns


def test_unreadable_date_becomes_null(spark):
    df = spark.createDataFrame([("2023-05-06",), ("never",)], "FL_DATE string")
    assert column(X.add_date_features(df), "FL_YEAR") == [2023, None]


def test_season_outside_the_year_is_null(spark):
    df = spark.createDataFrame([(0,), (13,), (None,)], "FL_MONTH int")
    assert column(X.add_season(df), "SEASON") == [None, None, None]


def test_clock_round_trip_and_bins(spark):
    codes = [h * 100 + m for h in range(24) for m in range(60)] + [2400]
    df = spark.createDataFrame([(c,) for c in codes], "CRS_DEP_TIME bigint")
    out = X.add_cyclical_times(df.withColumn("code", F.col("CRS_DEP_TIME")))
    minute = C.clock_minute(F.col("CRS_DEP_TIME_sin"), F.col("CRS_DEP_TIME_cos"))
    rows = out.select("code", minute.alias("m"), C.time_bin(minute, 24).alias("b"), C.bin_label(C.time_bin(minute, 24)).alias("l")).collect()
    for r in rows:
        expected = ((r["code"] // 100) * 60 + r["code"] % 100) % 1440
        assert r["m"] == expected
        assert r["b"] == (0 if expected == 0 else -(-expected // 60) - 1)
    found = {r["code"]: (r["b"], r["l"]) for r in rows}
    assert found[0] == (0, "00:00") and found[2359] == (23, "23:00") and found[2400] == (0, "00:00")


def test_hour_readings(spark):
    df = spark.createDataFrame([(955,), (1000,), (2359,)], "CRS_DEP_TIME bigint")
    assert column(X.add_dep_hour(df), "DEP_HOUR") == [9, 10, 23]
    assert column(X.add_dep_hour(df, "minutes"), "DEP_HOUR") == [15, 16, 39]
    with pytest.raises(ValueError):
        X.add_dep_hour(df, "seconds")


def test_peaks_are_inclusive(spark):
    df = spark.createDataFrame([(h,) for h in (6, 7, 10, 11, 16, 19, 20, None)], "DEP_HOUR int")
    out = X.add_peak_evening(X.add_peak_morning(df))
    assert column(out, "PEAK_MORNING") == [0, 1, 1, 0, 0, 0, 0, 0]
    assert column(out, "PEAK_EVENING") == [0, 0, 0, 0, 1, 1, 0, 0]


def test_states(spark):
    df = spark.createDataFrame([("X, Y, TX",), ("Guam",), ("Boston,\tMA ",), (None,)], "ORIGIN_CITY string")
    assert column(X.add_origin_state(df), "ORIGIN_STATE") == ["TX", "Guam", "MA", None]


def test_routes(spark):
    df = spark.createDataFrame([("B", "A"), ("A", "B"), ("A_X", "B"), (None, "B")], "ORIGIN_CITY string, DEST_CITY string")
    routed = X.add_route(df)
    assert column(routed, "ROUTE") == ["B_A", "A_B", "A_X_B", None]
    assert column(routed.select(C.canonical_route(F.col("ROUTE")).alias("r")), "r") == ["A_B", "A_B", "A_X_B", None]


def test_zero_duration_gives_no_speed(spark):
    df = spark.createDataFrame([(100.0, 0.0), (100.0, 50.0)], "DISTANCE double, CRS_ELAPSED_TIME double")
    assert column(X.add_avg_speed(df), "AVG_SPEED") == [None, 2.0]


def test_delay_categories(spark):
    df = spark.createDataFrame([(float(d),) for d in (-5, 0, 1, 15, 16, 60, 61)] + [(None,)], "ARR_DELAY double")
    assert column(X.add_delay_category(df), "DELAY_CATEGORY") == [
        "On-time / Early", "On-time / Early", "Minor delay", "Minor delay", "Moderate delay", "Moderate delay", "Long delay", "Long delay",
    ]


def test_existing_columns_are_kept_and_absent_inputs_ignored(spark):
    df = spark.createDataFrame([(1, 9)], "FL_MONTH int, SEASON int")
    assert X.add_season(df) is df
    assert X.add_weekend(df) is df and X.add_route(df) is df and X.add_avg_speed(df) is df


def test_required_columns(spark):
    with pytest.raises(ValueError, match="ARR_DELAY"):
        require(spark.range(1), ["id", "ARR_DELAY"])


def test_chain_is_one_stage_without_python(spark):
    from skylag.sources import star

    text = plan(clean_flights(star.table(spark, SMALL, "lineitem").selectExpr("l_shipdate AS FL_DATE", "l_quantity AS ARR_DELAY", "l_partkey AS CRS_DEP_TIME")))
    assert "Exchange" not in text and "Python" not in text and "ReadSchema" in text
    assert "IsNotNull(l_quantity)" in text


def test_clean_has_no_missing_values(clean):
    row = K.missing_report(clean).where("metric = 'rows with missing'").first()
    assert row["value"] == 0
    assert clean.where("ARR_DELAY < 0").count() == 0


def test_chain_keeps_hours_before_dropping_times(clean):
    assert {"DEP_HOUR", "ARR_HOUR"} <= set(clean.columns)
    assert "CRS_DEP_TIME" not in clean.columns
