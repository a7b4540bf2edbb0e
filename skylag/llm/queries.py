"""One query for each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import active_lloyd, ann, bpe, html_text, jaccard, language_id, line_dedup, lm_scoring, packing, periodic_runs, quality
from . import substring_dedup, topk

Query = Callable[[SparkSession, str], DataFrame]

# Harmful below poor below good.
GRADE = "CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 2 END"
TOP_GRADE = 2
LEARNS = "crc32(cast(cast(doc_id AS string) AS binary)) % 7 <> 2"
CRC = "crc32(cast(cast(doc_id AS string) AS binary))"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def maxent(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, folder, "documents"), LEARNS)


def best_fit(spark: SparkSession, folder: str) -> DataFrame:
    placed = packing.pack_documents(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def suffix_trees(spark: SparkSession, folder: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"), width=3, percent=90, by_parts=True)


def ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"), GRADE, top=TOP_GRADE)
    return quality.grade_texts(docs.select("doc_id", "text"), model).drop("text")


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents")
    return bpe.round_trip(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def voronoi(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def bitmask_language(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without an identifier are learned from."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.expr(f"{CRC} % 4 = 2"), F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs, model, held_out=held_out)


def lloyd_codes(spark: SparkSession, folder: str) -> DataFrame:
    return active_lloyd.compress(table(spark, folder, "embeddings")).drop("label")


def lyndon_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without an identifier keep their text as it is."""
    found = periodic_runs.find_runs(table(spark, folder, "documents"), seed=F.expr(CRC))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, folder)


def queries() -> dict[str, Query]:
    return {
        "op1_line_chunks": line_chunks,
        "op2_maxent_lm": maxent,
        "op3_best_fit_packing": best_fit,
        "op4_multi_index": multi_index,
        "op5_suffix_trees": suffix_trees,
        "op6_ngram_jaccard": ngram_jaccard,
        "op7_ordinal_quality": ordinal_quality,
        "op8_byte_bpe": byte_bpe,
        "op9_html_text": html_extraction,
        "op10_voronoi_topk": voronoi,
        "op11_bitmask_language": bitmask_language,
        "op12_active_lloyd": lloyd_codes,
        "op13_lyndon_runs": lyndon_runs,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_voronoi_topk": VORONOI_SQL, "op6_ngram_jaccard": JACCARD_SQL, "op12_active_lloyd": lloyd_sql()}


VORONOI_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
  FROM rows q JOIN rows r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 90 * (x.n + y.n - shared)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id AS node, doc_id AS least FROM documents
  UNION
  SELECT both_ways.b, reached.least FROM reached JOIN both_ways ON both_ways.a = reached.node WHERE reached.least < both_ways.b
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.least) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reached r ON r.node = d.doc_id
GROUP BY d.doc_id, s.n
"""


def lloyd_sql(rounds: int = 6) -> str:
    """Plain Lloyd's rounds, each a full comparison."""
    steps = [
        """WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, len(embedding) // 8 AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, w, CAST(g.range AS INTEGER) AS p, v[g.range * w + 1 : g.range * w + w] AS x FROM kept, range(8) g
), book0 AS MATERIALIZED (
  SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS INTEGER) AS e, x FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""gaps{r} AS (
  SELECT a.vec_id, a.label, a.p, b.e, a.x, list_sum(list_transform(range(1, a.w + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i]))) AS d
  FROM parts a JOIN book{r} b ON a.p = b.p
), near{r} AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) AS place FROM gaps{r}) WHERE place = 1
)""")
        if r < rounds:
            steps.append(f"""sums{r} AS (
  SELECT p, e, i, CAST(floor(CAST(sum(c) AS DOUBLE) / count(*)) AS BIGINT) AS c
  FROM (SELECT p, e, unnest(x) AS c, unnest(range(1, len(x) + 1)) AS i FROM near{r}) GROUP BY p, e, i
), book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(s.x, b.x) AS x
  FROM book{r} b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS x FROM sums{r} GROUP BY p, e) s ON s.p = b.p AND s.e = b.e
)""")
    return ",\n".join(steps) + f""", coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id, label
), digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest
"""
