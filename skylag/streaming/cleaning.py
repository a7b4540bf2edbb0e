"""Clean newly arrived flight files.

Every step of the cleaning chain looks at one row, so the same plan runs on a
stream without state, watermark or shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.cleaning import clean_flights
from ..sources.files import normalise_missing


def read_arrivals(spark: SparkSession, folder: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """Parquet files appearing in a folder, a bounded number per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def clean_stream(arrivals: DataFrame, time_encoding: str = "hhmm") -> DataFrame:
    return clean_flights(normalise_missing(arrivals), time_encoding)


def write_available(cleaned: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived so far, each file exactly once."""
    return (
        cleaned.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
