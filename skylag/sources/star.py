"""Flights derived from the order tables of the test data.

Customers join the narrow ``orders`` rows before those meet the fact table, so
the wide rows of ``lineitem`` are moved once for ``orders`` and, only when the
supplier table is too large for an automatic broadcast, once more for it. The
places come last, by nation number: a lookup of 25 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_YEARS_FORWARD = 24
_WEEK_SAFE_MONTHS = 12 * _YEARS_FORWARD


# Types of the columns used here; stating them saves a schema job per table.
_TYPES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_shipdate timestamp_ntz"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_TYPES[name]).parquet(f"{folder}/{name}.parquet")


def _place(nation: DataFrame, region: DataFrame, key: str, city: str) -> DataFrame:
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    name = F.concat(F.replace("n_name", F.lit("_"), F.lit(" ")), F.lit(", "), F.col("r_name"))
    return joined.select(F.col("n_nationkey").alias(key), name.alias(city))


def _hhmm(hour_source: Column, minute_source: Column) -> Column:
    return ((hour_source % 24) * 100 + (minute_source % 12) * 5).cast("bigint")


def flights(spark: SparkSession, folder: str) -> DataFrame:
    """The raw flight table, one row per line item."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    orders = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    rows = (
        table(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_place(nation, region, "origin_key", "ORIGIN_CITY"), F.col("s_nationkey") == F.col("origin_key"))
        .join(_place(nation, region, "dest_key", "DEST_CITY"), F.col("c_nationkey") == F.col("dest_key"))
    )
    order, line, part, supplier = (
        F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    remainder = (order + line) % 50
    base = ((order * 7 + part * 13 + line * 31) % 97 - 48).cast("double")
    tail = F.when((order + part) % 40 == 0, 200.0).otherwise(0.0)
    return rows.select(
        F.concat_ws(
            "-",
            order.cast("string"),
            line.cast("string"),
            part.cast("string"),
            supplier.cast("string"),
            F.round(price * 100).cast("bigint").cast("string"),
        ).alias("FLIGHT_ID"),
        F.add_months(F.col("l_shipdate").cast("date"), _WEEK_SAFE_MONTHS).alias("FL_DATE"),
        (supplier % 18).cast("bigint").alias("DOT_CODE"),
        "ORIGIN_CITY",
        "DEST_CITY",
        _hhmm(part, order).alias("CRS_DEP_TIME"),
        _hhmm(part + quantity.cast("bigint"), supplier).alias("CRS_ARR_TIME"),
        F.when(~remainder.isin(0, 1), base + tail).alias("ARR_DELAY"),
        F.when(remainder == 0, 1.0).otherwise(0.0).alias("CANCELLED"),
        F.when(remainder == 1, 1.0).otherwise(0.0).alias("DIVERTED"),
        F.when((order + part) % 501 != 0, (40 + quantity * 7).cast("double")).alias("CRS_ELAPSED_TIME"),
        (F.floor(price / 40) + 60).cast("double").alias("DISTANCE"),
    )
