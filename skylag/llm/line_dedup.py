"""Repeated multi-line chunks with content-defined boundaries.

A text's lines are hashed, and a rolling hash over the last few line hashes
marks chunk ends, so an inserted line moves only the boundaries near it. A
chunk of two lines or more that also occurs earlier in the corpus, byte for
byte, is removed; its first occurrence stays.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .arrow import checkpointed, lean, sliced, with_rest

SPAN = 1  # lines that a boundary looks at
DIVISOR = 2  # one boundary in so many places
LEAST, MOST = 2, 16  # lines of a chunk

_LOW = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15


def chunks_of(text: str) -> list[str]:
    """Chunks that join with line feeds to the text. Lines end at line feeds only."""
    lines = text.split("\n")
    seen = [xxhash.xxh3_64_intdigest(line) for line in lines]
    out, start, n = [], 0, len(lines)
    value, first = 0, pow(_STEP, SPAN, 1 << 64)
    for i, h in enumerate(seen):
        value = (value * _STEP + h) & _LOW
        if i >= SPAN:
            value = (value - seen[i - SPAN] * first) & _LOW
        length = i + 1 - start
        boundary = ((value ^ value >> 31) * _STEP & _LOW) >> 40 & (DIVISOR - 1) == 0
        if i + 1 == n or length >= MOST or (length >= LEAST and boundary):
            out.append("\n".join(lines[start : i + 1]))
            start = i + 1
    return out


def _eligible(chunk: str) -> bool:
    return "\n" in chunk and not chunk.isspace()


def _mapped(df: DataFrame, kind: str | StructType, fn):
    """One pass over texts; ``fn`` turns a bounded slice into rows of ``kind``."""

    def run(batches):
        for part in sliced(batches):
            rows = fn(part)
            if rows is not None and rows.num_rows:
                yield rows

    return df.mapInArrow(run, kind)


def _hash(chunk: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(chunk)
    return (h >> 64) - (1 << 63), (h & _LOW) - (1 << 63)


def _chunk_rows(part: pa.RecordBatch) -> pa.RecordBatch:
    owner, number, first, second = [], [], [], []
    for i, text in enumerate(part.column("text").to_pylist()):
        if "\n" in text:
            for k, chunk in enumerate(chunks_of(text)):
                if _eligible(chunk):
                    a, b = _hash(chunk)
                    owner.append(i)
                    number.append(k)
                    first.append(a)
                    second.append(b)
    columns = [part.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), pa.array(first, pa.int64()), pa.array(second, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "chunk", "h1", "h2"])


def _first_texts(part: pa.RecordBatch) -> pa.RecordBatch:
    ids, number, body = [], [], []
    for i, (text, wanted) in enumerate(zip(part.column("text").to_pylist(), part.column("wanted").to_pylist(), strict=True)):
        chunks = chunks_of(text)
        for k in wanted:
            if k < len(chunks):
                ids.append(i)
                number.append(k)
                body.append(chunks[k])
    columns = [part.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(number, pa.int32()), pa.array(body, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["first_doc", "first_chunk", "body"])


def _cleaned(part: pa.RecordBatch) -> pa.RecordBatch:
    """Drop the chunks whose bytes equal those of their first occurrence."""
    texts, total, removed = [], [], []
    for text, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist(), strict=True):
        total.append(text.count("\n") + 1 if text else 0)
        gone = 0
        if found:
            bodies = {f["chunk"]: f["body"] for f in found}
            kept = []
            for k, chunk in enumerate(chunks_of(text)):
                if bodies.get(k) == chunk:
                    gone += chunk.count("\n") + 1
                else:
                    kept.append(chunk)
            text = "\n".join(kept)
        texts.append(text)
        removed.append(gone)
    rest = [c for c in part.schema.names if c == "rest"]
    columns = [part.column("doc_id"), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), *map(part.column, rest)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_lines", "n_removed", *rest])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Per row doc_id, text (what is left), n_lines and n_removed (lines); columns to ``carry`` follow in a struct ``rest``.

    Earlier means a smaller identifier, or an earlier chunk of the same text.
    Identifiers are whole numbers; rows without one are left out. A null or
    empty text has no lines. Chunks of one line or of white space alone stay.
    Repeated rows count as one document and give one result each.
    """
    whole = lean(df, id_col, text_col, carry).where("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = whole.select("doc_id", "text")
    chunks = checkpointed(_mapped(texts, "doc_id long, chunk int, h1 long, h2 long", _chunk_rows).distinct())
    place = F.struct("doc_id", "chunk")
    repeated = chunks.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = chunks.join(repeated.select("h1", "h2", "first"), ["h1", "h2"])
    later = pairs.where(place != F.col("first")).select("doc_id", "chunk", F.col("first.doc_id").alias("first_doc"), F.col("first.chunk").alias("first_chunk"))
    wanted = repeated.select("first.*").groupBy("doc_id").agg(F.collect_set("chunk").alias("wanted"))
    bodies = _mapped(texts.join(wanted.hint("shuffle_hash"), "doc_id"), "first_doc long, first_chunk int, body string", _first_texts)
    once = bodies.groupBy("first_doc", "first_chunk").agg(F.min("body").alias("body"))  # repeated rows offer the same text
    compared = later.join(once, ["first_doc", "first_chunk"])
    per_doc = compared.groupBy("doc_id").agg(F.collect_list(F.struct("chunk", "body")).alias("found"))
    joined = whole.join(per_doc.hint("shuffle_hash"), "doc_id", "left")
    return _mapped(joined, with_rest("doc_id long, text string, n_lines long, n_removed long", whole), _cleaned)
