"""Repeated word windows by prefix-partitioned suffix trees.

A word is removed when a window of ``window`` words that covers it also starts
earlier in the corpus. Suffixes are anchored: every window names the least
hashed ``ANCHOR``-word sequence in it, so equal windows hold the same anchor at
the same place, and neighbouring windows share one. Anchors that occur once
lead nowhere and are dropped after a count.

The remaining suffixes, which begin at their anchor and carry the words before
it, are partitioned by prefix. A prefix that occurs seldom is the anchor
itself, and many such prefixes share a memory-sized group. In a group the
sorted suffixes with their common lengths stand for the subtree: nodes at the
depths that complete a window, paired with the same for the words on the left,
are the repeats. A prefix that occurs often is dealt in chunks; what is first in
its chunk is lengthened to the full window, so that equal suffixes end in one
node, whose first occurrence is an aggregate combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Words, checkpointed, hashes, lean, per_group, per_text, ranges, rolling, with_rest, words_of

WINDOW = 20
ANCHOR = 5
GROUP_ROWS = 40_000  # suffixes that are held in memory together
FREQUENT = GROUP_ROWS // 4  # a prefix with more would crowd a group


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost position of the least value in every ``width`` neighbours."""
    n = len(values) - width + 1
    at, covered = np.arange(len(values)), 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        covered += step
    return at[:n]


def anchors_of(words: Words, window: int, anchor: int):
    """Anchors of each text: text, place in it, hash, and how far before it its windows start (most, least)."""
    grams = rolling(hashes(words.vocab)[words.codes], anchor)
    owner = words.owner
    reach = window - anchor + 1
    total = len(words.codes)
    if total < window:
        return (np.empty(0, np.int64),) * 5
    start = np.arange(total - window + 1)
    valid = start + window <= words.offsets[1:][owner[: len(start)]]
    at, start = _least(grams, reach)[valid], start[valid]
    if not len(at):
        return (np.empty(0, np.int64),) * 5
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(new[1:], len(at)) - 1
    place = at[new]
    text = owner[place]
    return text, place - words.offsets[text], grams[place].astype(np.int64), place - start[new], place - start[last]


def _packed(place, most, least):
    return (place.astype(np.int64) << 16) + (most << 8) + least


def _anchors(df: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        text, place, gram, most, least = anchors_of(words_of(part.column("text")), window, anchor)
        ids = part.column("doc_id").take(pa.array(text))
        return pa.RecordBatch.from_arrays(
            [pa.array(gram.astype(np.int64)), ids, pa.array(_packed(place, most, least))], names=["gram", "doc_id", "at"]
        )

    return df.mapInArrow(per_text(run), "gram long, doc_id long, at long")


def _contexts(joined: DataFrame, window: int) -> DataFrame:
    """The words around each anchor: gram, doc_id, at, chunks, words (the words of all its windows)."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(part.column("text"))
        found = part.column("found")
        bounds = found.offsets.to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(part.num_rows), np.diff(bounds))
        flat = found.flatten()
        gram, at, chunks = (flat.field(k) for k in range(3))
        packed = at.to_numpy()
        begin = (packed >> 16) - (packed >> 8 & 255)
        length = (packed >> 8 & 255) - (packed & 255) + window
        fits = (begin >= 0) & (begin + length <= words.counts[owner])
        owner, begin, length = owner[fits], begin[fits], length[fits]
        codes = words.codes[ranges(words.offsets[owner] + begin, length)]
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), words.vocab.take(pa.array(codes))
        )
        keep = pa.array(fits, pa.bool_())
        return pa.RecordBatch.from_arrays(
            [gram.filter(keep), part.column("doc_id").take(pa.array(owner)), at.filter(keep), chunks.filter(keep), pc.binary_join(lists, " ")],
            names=["gram", "doc_id", "at", "chunks", "words"],
        )

    return joined.mapInArrow(per_text(run), "gram long, doc_id long, at long, chunks long, words string")


def _nodes(matrix: np.ndarray) -> np.ndarray:
    """Node of every row at every depth: rows share node d if their first d columns are equal."""
    n, width = matrix.shape
    order = np.lexsort(matrix.T[::-1])
    rows = matrix[order]
    differs = rows[1:] != rows[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    out = np.empty((width + 1, n), np.int32)
    for depth in range(width + 1):
        out[depth, order] = np.concatenate([[0], np.cumsum(common < depth)])
    return out


def subtree_repeats(doc: np.ndarray, at: np.ndarray, texts: pa.Array, window: int, anchor: int) -> np.ndarray:
    """For each suffix a bit mask: bit l is set if its window that starts l words before it starts earlier elsewhere."""
    words = words_of(texts)
    place, most, least = at >> 16, at >> 8 & 255, at & 255
    reach = window - anchor
    n = len(doc)
    right, left = np.full((n, window), -1, np.int32), np.full((n, reach), -1, np.int32)
    row, column = words.owner, np.arange(len(words.codes)) - words.offsets[words.owner] - most[words.owner]
    after = column >= 0
    right[row[after], column[after]] = words.codes[after]
    left[row[~after], -1 - column[~after]] = words.codes[~after]
    down, up = _nodes(right), _nodes(left)
    mask = np.zeros(n, np.int64)
    for back in range(reach + 1):
        rows = np.flatnonzero((least <= back) & (back <= most))
        if len(rows) < 2:
            continue
        key = down[window - back, rows].astype(np.int64) * (n + 1) + up[back, rows]
        order = np.lexsort((place[rows], doc[rows], key))
        key, sorted_rows = key[order], rows[order]
        heads = np.append(True, key[1:] != key[:-1])
        first = sorted_rows[np.maximum.accumulate(np.where(heads, np.arange(len(heads)), 0))]
        later = (doc[sorted_rows] != doc[first]) | (place[sorted_rows] != place[first])
        mask[sorted_rows[later]] |= 1 << back
    return mask


def _subtrees(contexts: DataFrame, groups: int, window: int, anchor: int) -> DataFrame:
    """Masks of all suffixes within their group, and the words of those that are first in a chunk of a frequent prefix."""

    def run(table: pa.Table) -> pa.Table:
        doc, at, chunks = (table.column(c).to_numpy() for c in ("doc_id", "at", "chunks"))
        words = table.column("words").combine_chunks()
        mask = subtree_repeats(doc, at, words, window, anchor)
        every = (1 << (at >> 8 & 255) + 1) - (1 << (at & 255))
        first = (chunks > 1) & (mask != every)
        keep = (mask > 0) | first
        shown = pc.if_else(pa.array(first), words, pa.scalar(None, pa.string()))
        return pa.table({"doc_id": doc[keep], "at": at[keep], "mask": mask[keep], "words": shown.filter(pa.array(keep))})

    chunk = F.pmod(F.xxhash64("doc_id"), F.col("chunks"))
    dealt = contexts.select(F.pmod(F.xxhash64("gram", chunk), F.lit(groups)).alias("part"), "doc_id", "at", "chunks", "words")
    return dealt.groupBy("part").applyInArrow(per_group(run), "doc_id long, at long, mask long, words string")


def _frequent(contexts: DataFrame, window: int) -> DataFrame:
    """Suffixes of frequent prefixes, one per window, each keyed by all its words."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(part.column("words"))
        base = hashes(words.vocab)[words.codes], hashes(words.vocab, 1)[words.codes]
        first, second = (rolling(b, window) for b in base)
        at = part.column("at").to_numpy()
        each = (at >> 8 & 255) - (at & 255) + 1
        row = np.repeat(np.arange(len(at)), each)
        start = ranges(words.offsets[:-1], each)
        place = ranges((at >> 16) - (at >> 8 & 255), each)
        # windows already known to start earlier in the chunk need no second look
        new = part.column("mask").to_numpy()[row] >> (at[row] >> 16) - place & 1 == 0
        row, start, place = row[new], start[new], place[new]
        return pa.RecordBatch.from_arrays(
            [pa.array(first[start].astype(np.int64)), pa.array(second[start].astype(np.int64)), part.column("doc_id").take(pa.array(row)), pa.array(place)],
            names=["first", "second", "doc_id", "place"],
        )

    rows = contexts.where("words IS NOT NULL").select("words", "doc_id", "at", "mask")
    windows = rows.withColumnRenamed("words", "text").mapInArrow(
        per_text(lambda p: run(p.rename_columns(["words", "doc_id", "at", "mask"]))), "first long, second long, doc_id long, place long"
    )
    earliest = windows.groupBy("first", "second").agg(F.min(F.struct("doc_id", "place")).alias("e"))
    again = windows.join(earliest, ["first", "second"]).where("doc_id <> e.doc_id OR place <> e.place")
    return again.select("doc_id", "place", F.lit(1).cast("long").alias("mask"))


def repeated_windows(texts: DataFrame, window: int = WINDOW, frequent: int = FREQUENT, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, place, mask): bit l says that the window starting at word ``place - l`` also starts earlier.

    ``texts`` has doc_id and text, neither null. Places count words from 0.
    """
    anchor = min(ANCHOR, window)
    anchors = _anchors(texts, window, anchor)
    repeated = checkpointed(anchors.groupBy("gram").count().where("count > 1"))
    rows = repeated.agg(F.sum("count")).first()[0] or 0
    found = anchors.join(repeated.select("gram", F.ceil(F.col("count") / frequent).cast("long").alias("chunks")), "gram")
    per_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "at", "chunks")).alias("found"))
    contexts = _contexts(texts.join(per_doc.hint("shuffle_hash"), "doc_id"), window)
    groups = max(1, -(-rows // group_rows))
    trees = _subtrees(contexts, groups, window, anchor)
    masks = trees.where("mask > 0").select("doc_id", F.shiftright("at", 16).alias("place"), "mask")
    return masks.union(_frequent(trees, window))


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, carry: Sequence[str] = (), **sizes: int
) -> DataFrame:
    """Per row doc_id, n_words, n_removed and kept, the words left, joined by one blank.

    With columns to ``carry`` the given text follows, and they in a struct ``rest``.

    Identifiers are whole numbers; rows without one are left out. A null or
    empty text has no words. Repeated rows count as one document and give one
    result each. Texts shorter than the window keep all words.
    """
    whole = lean(df, id_col, text_col, carry).where("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = whole.select("doc_id", "text")
    more = ["text", "rest"] if carry else []
    flags = repeated_windows(texts, window, **sizes)
    per_doc = flags.groupBy("doc_id").agg(F.collect_list(F.struct("place", "mask")).alias("flags"))

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(part.column("text"))
        flags = part.column("flags")
        change = np.zeros(len(words.codes) + 1, np.int64)
        sizes = pc.list_value_length(flags).fill_null(0).to_numpy().astype(np.int64)
        flat = flags.flatten()
        owner = np.repeat(np.arange(part.num_rows), sizes)
        place, mask = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        for back in range(window):
            hit = mask >> back & 1 > 0
            if hit.any():
                start = words.offsets[owner[hit]] + place[hit] - back
                np.add.at(change, start, 1)
                np.add.at(change, start + window, -1)
        keep = np.cumsum(change[:-1]) == 0
        kept = np.concatenate([[0], np.cumsum(keep)])[words.offsets]
        lists = pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), words.vocab.take(pa.array(words.codes[keep])))
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(words.counts), pa.array(words.counts - np.diff(kept)), pc.binary_join(lists, " "), *map(part.column, more)],
            names=["doc_id", "n_words", "n_removed", "kept", *more],
        )

    joined = whole.join(per_doc.hint("shuffle_hash"), "doc_id", "left")
    kind = "doc_id long, n_words long, n_removed long, kept string" + ", text string" * bool(carry)
    return joined.mapInArrow(per_text(run), with_rest(kind, whole))
