"""The corpus pipeline on the smallest tables, each stage against brute force on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from skylag.llm import line_dedup

from ..conftest import SMALL
from .test_operators import near_classes, windows_removed


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        rows = {r["doc_id"]: r for r in docs.collect()}
        given = [(r["doc_id"], r["text"], "") for r in before.collect()]
        if name != "best-fit packing":
            assert docs.columns == columns and set(rows) <= {i for i, _, _ in given}
        if name == "quality classifier":
            rated = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
            good = [i for i, r in rated.items() if r["quality"] == 1 and r["toxic"] == 0]
            assert sum(i in rows for i in good) >= 0.95 * len(good)
            # so few ratings teach only some of the words; test_quality measures held-out accuracy
            assert sum(i in rows for i, r in rated.items() if r["toxic"] == 1) <= 0.5 * sum(r["toxic"] for r in rated.values())
        elif name == "line dedup":
            seen = set()
            for i, text, _ in sorted(given):
                left = []
                for chunk in line_dedup.chunks_of(text):
                    if "\n" in chunk and not chunk.isspace():
                        if chunk in seen:
                            continue
                        seen.add(chunk)
                    left.append(chunk)
                assert rows[i]["text"] == "\n".join(left) if i in rows else not "\n".join(left).split()
        elif name == "n-gram Jaccard join":
            assert set(rows) == {i for i, (_, c) in near_classes(given, 5, 80).items() if i == c}
        elif name == "substring dedup":
            for i, (n, gone, left) in windows_removed(given, 20).items():
                assert rows[i]["text"].split() == left.split() if i in rows else gone == n
        else:
            assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {i for i, _, _ in given}
        kept[name] = len(rows)
    assert kept["n-gram Jaccard join"] < kept["quality classifier"]


def test_repeated_rows_and_rows_without_identifier(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = sorted(r["doc_id"] for r in labels.where("quality = 1 AND toxic = 0").collect())
    nameless, often = good[::9], good[1::9]
    lost = F.when(F.col("doc_id").isin(nameless), F.lit(None)).otherwise(F.col("doc_id")).cast("long")
    given = docs.withColumn("doc_id", lost)
    given = given.union(given.where("doc_id IS NULL")).union(given.where(F.col("doc_id").isin(often))).union(given.where(F.col("doc_id").isin(often)))
    given.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    named = Counter((r["doc_id"], r["piece"]) for r in got if r["doc_id"] is not None)
    assert set(named.values()) == {1} and {i for i, _ in named} & set(often)
    unnamed = Counter((r["piece"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] is None)
    assert set(unnamed.values()) == {1}


def test_stages_keep_rows_in_number(spark):
    text = "\n".join(f"line {i} of a text with a few words {i * 7}" for i in range(12))
    rows = [(1, text, 5), (1, text, 5), (None, "alone\nhere", 10), (None, None, 0), (4, text + "\nmore", 7), (None, "alone\nhere", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    for stage in (corpus_pipeline.drop_lines, corpus_pipeline.drop_passages):
        got = Counter((r["doc_id"], r["text"]) for r in stage(spark, docs, SMALL).collect())
        assert got[1, text] == 2 and got[None, "alone\nhere"] == 2 and got[None, None] == 1 and sum(got.values()) <= 6
    near = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, SMALL).collect())
    assert near == {(1, text): 1, (None, "alone\nhere"): 1, (None, None): 1}


def test_own_columns_and_several_texts_of_one_identifier(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = ["keep", "_key", "_null", "rated", "grade", "rest", "n_removed", "kept", "c0"]
    clash = docs.select("*", *[F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in names])
    plain = docs
    for stage in (corpus_pipeline.keep_good, corpus_pipeline.drop_lines, corpus_pipeline.drop_near_copies, corpus_pipeline.drop_passages):
        got = stage(spark, clash, SMALL)
        assert got.columns == clash.columns
        rows = got.collect()
        assert rows and all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in names)
        assert {(r["doc_id"], r["text"]) for r in rows} == {(r["doc_id"], r["text"]) for r in stage(spark, plain, SMALL).collect()}
    first, second = (" ".join(f"{w}{i}" for i in range(40)) for w in "ab")
    rows = [(3, first), (3, second), (3, second), (3, None), (5, first), (2, second + " more"), (9, second)]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SMALL)
    # the other text of 3 equals that of 5, an identifier, and comes after it
    assert Counter(map(tuple, got.collect())) == Counter([(2, second + " more"), (3, None), (5, first)])
