"""Documents for training: graded, cleaned of repeats, and packed into sequences."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm import jaccard, line_dedup, packing, quality, substring_dedup
from skylag.llm.arrow import checkpointed
from skylag.llm.queries import GRADE, TOP_GRADE, table, tokenizer_file
from skylag.session import fresh_path

ORACLE_SQL = None  # a fitted classifier and hashed boundaries have no SQL form; tests compare with brute force


FIXED = ("doc_id", "text", "n_chars")
HASHED = (1 << 62) - 1


def _own_columns(stage: Callable) -> Callable:
    """The stage with all but the fixed columns under neutral names, so that none clashes with a column it adds."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        neutral = [c if c in FIXED else f"c{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*neutral), sf_dir).toDF(*docs.columns)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """With ``_key``: the identifier or, in rows without one, a number made of the text, above usual identifiers.

    So rows without an identifier come last among the documents, and those of one text count as repeated rows.
    """
    of_text = F.lit(1 << 62) + F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(HASHED))
    return docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), of_text)).withColumn("_null", F.col("text").isNull())


def _carried(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "text"] + ["_null"]


def _with_texts(docs: DataFrame, out: DataFrame, new: str) -> DataFrame:
    """The documents with changed texts; those that lost all their words are gone, unchanged ones keep their text."""
    gone = F.col("n_removed") > 0
    left = out.where(~gone | F.col(new).rlike(r"[^\x20\x09-\x0D]"))
    text = F.when(gone, F.col(new)).when(~F.col("rest._null"), F.col("text"))
    given = {c: F.col(f"rest.`{c}`") for c in docs.columns if c != "text"} | {"text": text}
    if "n_chars" in given:
        given["n_chars"] = F.when(gone, F.length(new)).otherwise(given["n_chars"]).cast("long")
    return left.select(*[given[c].alias(c) for c in docs.columns])


@_own_columns
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted on the rated ones, gives the top grade."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), GRADE, top=TOP_GRADE)
    return quality.grade_texts(docs, model).where("keep").select(*docs.columns)


@_own_columns
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without multi-line chunks that occur earlier; documents left without words go."""
    return _with_texts(docs, line_dedup.dedup_lines(_keyed(docs), "_key", carry=_carried(docs)), "text")


@_own_columns
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates, in one row.

    Different texts of one identifier are documents of their own: the greatest
    keeps the identifier as its key, the others come after all identifiers.
    """
    rows = _keyed(docs)
    often = checkpointed(rows.groupBy("_key").count().where("count > 1").select("_key"))
    if not often.isEmpty():
        rest = F.struct(*[f"`{c}`" for c in rows.columns if c not in ("text", "_key")])
        texts = rows.join(often, "_key", "left_semi").groupBy("_key", "text").agg(F.max(rest).alias("r"))
        greatest = texts.groupBy("_key").agg(F.max("text").alias("greatest"))
        other = F.lit(1 << 62) + F.xxhash64("_key", "text").bitwiseAND(F.lit(HASHED))
        key = F.when(F.col("text").eqNullSafe(F.col("greatest")), F.col("_key")).otherwise(other).alias("_key")
        one = texts.join(greatest, "_key").select(key, "text", "r.*")
        rows = rows.join(often, "_key", "left_anti").unionByName(one)
    found = jaccard.near_duplicates(rows, "_key")
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_key"))
    return rows.join(gone, "_key", "left_anti").select(*docs.columns)


@_own_columns
def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without word windows that occur earlier; documents left without words go."""
    return _with_texts(docs, substring_dedup.remove_repeats(_keyed(docs), "_key", carry=_carried(docs)), "kept")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    placed = packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", drop_passages),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
