"""Date, clock, text and conditional expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MINUTES = 1440
_TURN = 2.0 * math.pi

# Delay categories and their upper bounds in minutes.
ON_TIME, MINOR, MODERATE, LONG = "On-time / Early", "Minor delay", "Moderate delay", "Long delay"
MINOR_LIMIT, MODERATE_LIMIT = 15, 60

# Inclusive hour ranges of the two peaks.
MORNING_PEAK = (7, 10)
EVENING_PEAK = (16, 19)


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Bound a value; a missing value stays missing."""
    out = value
    if high is not None:
        out = F.when(value > F.lit(float(high)), F.lit(float(high))).otherwise(out)
    if low is not None:
        out = F.when(value < F.lit(float(low)), F.lit(float(low))).otherwise(out)
    return out


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + F.lit(1)


def season(month: Column) -> Column:
    """Winter 1, spring 2, summer 3, autumn 4; NULL outside 1..12."""
    return (
        F.when(month.isin(12, 1, 2), 1)
        .when(month.between(3, 5), 2)
        .when(month.between(6, 8), 3)
        .when(month.between(9, 11), 4)
    )


def weekend(weekday: Column) -> Column:
    return F.when(weekday.isin(6, 7), 1).otherwise(0)


def hhmm_hour(code: Column) -> Column:
    return F.floor(code / F.lit(100)).cast("int")


def hhmm_minutes(code: Column) -> Column:
    """Minutes since midnight of an HHMM integer."""
    return F.floor(code / F.lit(100)) * F.lit(60) + F.pmod(code, F.lit(100))


def hour(code: Column, encoding: str) -> Column:
    """Hour of a scheduled time read as ``hhmm`` or as ``minutes`` since midnight."""
    if encoding == "hhmm":
        return hhmm_hour(code)
    if encoding == "minutes":
        return F.floor(code / F.lit(60)).cast("int")
    raise ValueError("time encoding must be 'hhmm' or 'minutes'")


def clock_sin(minutes: Column) -> Column:
    return F.sin(F.lit(_TURN) * minutes / F.lit(float(DAY_MINUTES)))


def clock_cos(minutes: Column) -> Column:
    return F.cos(F.lit(_TURN) * minutes / F.lit(float(DAY_MINUTES)))


def clock_minute(sine: Column, cosine: Column) -> Column:
    """Whole minute of the day recovered from its point on the unit circle."""
    raw = F.round(F.atan2(sine, cosine) * F.lit(DAY_MINUTES / _TURN)).cast("int")
    return F.pmod(raw, F.lit(DAY_MINUTES))


def time_bin(minute: Column, bins: int) -> Column:
    """Right-closed bin of the day, the first bin also holding midnight."""
    edge = F.ceil(minute * F.lit(bins) / F.lit(float(DAY_MINUTES))).cast("int") - F.lit(1)
    return F.when(minute == 0, F.lit(0)).otherwise(edge)


def bin_label(index: Column) -> Column:
    padded = F.when(index < 10, F.concat(F.lit("0"), index.cast("string")))
    return F.concat(padded.otherwise(index.cast("string")), F.lit(":00"))


def within_hours(hour_value: Column, hours: tuple[int, int]) -> Column:
    return F.when(hour_value.between(*hours), 1).otherwise(0)


def last_comma_part(text: Column) -> Column:
    """Text after the last comma without surrounding white space."""
    return F.btrim(F.substring_index(text, ",", -1), F.lit(" \t\r\n\f\v"))


def route(origin: Column, destination: Column) -> Column:
    return F.concat(origin, F.lit("_"), destination)


def canonical_route(value: Column) -> Column:
    """The same text for A_B and B_A; other part counts stay as they are."""
    parts = F.split(value, "_")
    return F.when(F.size(parts) == 2, F.array_join(F.array_sort(parts), "_")).otherwise(value)


def delayed(delay: Column) -> Column:
    """1 for a positive delay; a missing delay counts as not delayed."""
    return F.when(delay > 0, 1).otherwise(0)


def delay_category(delay: Column) -> Column:
    """A missing delay falls through to the longest category."""
    return (
        F.when(delay <= 0, ON_TIME)
        .when(delay <= MINOR_LIMIT, MINOR)
        .when(delay <= MODERATE_LIMIT, MODERATE)
        .otherwise(LONG)
    )


def label_view(value: Column, mode: str) -> Column:
    """A label as category of delay, as plain category or as number."""
    if mode == "delay_categorical":
        return delay_category(value)
    if mode == "generic_categorical":
        return value.cast("string")
    if mode == "continuous":
        return value
    raise ValueError(
        "label mode must be 'delay_categorical', 'generic_categorical' or 'continuous'"
    )
