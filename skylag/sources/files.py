"""CSV and Parquet scans and sinks of flight tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from ..schema import CLEAN_TYPES, RAW_TYPES

_ENCODING = "ISO-8859-1"


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN becomes NULL once, at the scan, so that later rules see one kind."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            nan_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, floats) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


CORRUPT = "_corrupt_record"


def _typed_scan(
    spark: SparkSession, path: str, types: dict[str, T.DataType] | None, encoding: str, date_format: str, infer: bool, corrupt: bool
) -> tuple[DataFrame, dict[str, T.DataType]]:
    """The rows as scanned, whole numbers still doubles, and the wanted type of every column."""
    options = {"header": True, "encoding": encoding, "mode": "PERMISSIVE", "dateFormat": date_format}
    if infer:
        wanted = {f.name: f.dataType for f in spark.read.options(**options, inferSchema=True).csv(path).schema.fields}
    else:
        known = types or {**RAW_TYPES, **CLEAN_TYPES}
        wanted = {name: known.get(name, T.StringType()) for name in spark.read.options(**options).csv(path).columns}
    whole = (T.LongType, T.IntegerType)
    fields = [T.StructField(name, T.DoubleType() if isinstance(kind, whole) else kind) for name, kind in wanted.items()]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    reader = spark.read.options(**options, columnNameOfCorruptRecord=CORRUPT)
    return reader.schema(T.StructType(fields)).csv(path), wanted


def _retyped(rows: DataFrame, wanted: dict[str, T.DataType]) -> DataFrame:
    whole = (T.LongType, T.IntegerType)
    rows = normalise_missing(rows)
    return rows.select(
        *[F.col(name).try_cast(kind).alias(name) if isinstance(kind, whole) else F.col(name) for name, kind in wanted.items()]
    )


def read_flights_csv(
    spark: SparkSession,
    path: str,
    types: dict[str, T.DataType] | None = None,
    encoding: str = _ENCODING,
    date_format: str = "yyyy-MM-dd",
    infer: bool = False,
) -> DataFrame:
    """Header CSV with types looked up by column name.

    Only the header line is read to learn the column order; a malformed field
    becomes NULL and unknown columns stay text. Whole numbers are parsed as
    doubles first so that ``1155.0`` reads like ``1155``. ``infer`` lets Spark
    find the types instead, by one more scan.
    """
    rows, wanted = _typed_scan(spark, path, types, encoding, date_format, infer, False)
    return _retyped(rows, wanted)


def split_malformed(
    spark: SparkSession,
    path: str,
    types: dict[str, T.DataType] | None = None,
    encoding: str = _ENCODING,
    date_format: str = "yyyy-MM-dd",
) -> tuple[DataFrame, DataFrame]:
    """The well-formed rows of a header CSV, and the others.

    A row is malformed if it has too few or too many fields or one that does
    not parse as its type. Of those the second table has the raw ``line``, its
    ``file``, and ``null_columns``: the columns that are NULL in what could be read.
    """
    rows, wanted = _typed_scan(spark, path, types, encoding, date_format, False, True)
    empty = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in wanted]))
    bad = rows.where(F.col(CORRUPT).isNotNull())
    bad = bad.select(F.col(CORRUPT).alias("line"), F.col("_metadata.file_path").alias("file"), empty.alias("null_columns"))
    return _retyped(rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), wanted), bad


def load_flights_csv(spark: SparkSession, path: str, stored: str, quarantine: str, **options) -> DataFrame:
    """Store the well-formed rows as Parquet and set the malformed ones aside; returns (part, rows).

    Both counts are observed while the tables are written, without scans of their own.
    """
    counts = []
    for part, rows, target in zip(("kept", "set aside"), split_malformed(spark, path, **options), (stored, quarantine)):
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(target)
        counts.append((part, seen.get["rows"]))
    return spark.createDataFrame(counts, "part string, rows bigint")


def read_flights_parquet(spark: SparkSession, path: str) -> DataFrame:
    return normalise_missing(spark.read.parquet(path))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """A folder of header CSV parts in the encoding the reader expects."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("encoding", _ENCODING)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
    return path


def write_parquet(
    df: DataFrame, path: str, partition_by: str | None = "FL_YEAR", mode: str = "errorifexists"
) -> str:
    """Parquet, split by year by default so that era filters prune folders."""
    writer = df.write.mode(mode)
    if partition_by and partition_by in df.columns:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path


def read_with_row_id(spark: SparkSession, path: str, id_column: str = "FLIGHT_ID") -> DataFrame:
    """A stored Parquet table with a unique and repeatable row identifier.

    Sampling ranks rows by a hash of their identifier. Where the data bring
    none, the position of a row in its stored file serves: it needs no shuffle
    and does not change when a task runs again.
    """
    stored = spark.read.parquet(path)
    if id_column in stored.columns:
        return normalise_missing(stored)
    part = F.regexp_extract(F.col("_metadata.file_path"), "((?:[^/]+=[^/]+/)*[^/]+)$", 1)
    keyed = stored.withColumn(id_column, F.concat_ws("-", part, F.col("_metadata.row_index")))
    return normalise_missing(keyed)
