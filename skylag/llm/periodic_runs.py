"""Periodic runs of words: maximal stretches that repeat with a period.

A repeated window of words can stand nowhere but in a text with two equal
windows, so rolling hashes first rule out all words that no run can hold. What
is left goes through the first phase of a grouping suffix sorter, once for each
of two opposite orders of the words: it ends with every position in the group
of its longest Lyndon word, which is the Lyndon array. Two neighbouring places
of one group are a Lyndon root and its repetition; longest common extensions
to both sides make it a run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import mixed, per_text, rolling, words_of

BATCH_WORDS = 1 << 18  # words grouped at once; a longer stretch without a break is grouped alone

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_groups(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The length of the longest Lyndon word at each position, and a number shared by equal ones.

    Negative codes separate stretches; the last code must be one. Groups are
    taken from the largest down. A place of the group then ends its word, which
    is appended to the word that ends right before it, if that is a smaller
    one; the words so lengthened form groups right above their former group,
    the more often lengthened ones higher.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    order = order[codes[order] >= 0]
    _, firsts, inverse = np.unique(codes[order], return_index=True, return_inverse=True)
    group_of = np.full(n, -1, np.int64)
    group_of[order] = inverse
    before = np.arange(-1, n)
    before[1:][codes < 0] = -1
    groups = len(firsts)
    members: list[list[int] | None] = [part.tolist() for part in np.split(order, firsts[1:])] if groups else []
    alive = [len(m) for m in members]
    size = [1] * groups
    below = list(range(-1, groups - 1))
    above = [*range(1, groups), -1]
    group, owner = group_of.tolist(), before.tolist()  # owner[e]: the unfinished word that ends before e
    g = groups - 1
    while g >= 0:
        length, last = size[g], -1
        touched: list[int] = []
        times: list[int] = []
        for s in members[g]:
            if group[s] == g:
                j = owner[s]
                owner[s + length] = j
                if j >= 0:
                    if j == last:
                        times[-1] += 1
                    else:
                        touched.append(j)
                        times.append(1)
                        last = j
        members[g] = None
        moved: dict[tuple[int, int], list[int]] = {}
        for j, count in zip(touched, times):
            moved.setdefault((-count, group[j]), []).append(j)
        for (count, k), places in sorted(moved.items()) if len(moved) > 1 else moved.items():
            longer = size[k] - count * length
            if alive[k] == len(places):
                size[k] = longer
                continue
            alive[k] -= len(places)
            new, up = len(size), above[k]
            size.append(longer)
            alive.append(len(places))
            members.append(places)
            below.append(k)
            above.append(up)
            below[up] = above[k] = new
            for j in places:
                group[j] = new
        g = below[g]
    group_of = np.array(group, np.int64)
    lengths = np.array([*size, 0], np.int64)[group_of]
    return lengths, group_of


def _extent(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common prefix, by blocks of growing size."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        odd = np.flatnonzero(a[at : min(at + step, n)] != b[at : min(at + step, n)])
        if len(odd):
            return at + int(odd[0])
        at, step = at + step, step * 2
    return n


def _stretch_runs(codes: np.ndarray, least: int, power: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs between negative codes, of which no two may be equal."""
    found = set()
    top = int(codes.max(initial=0))
    for ranked in (codes, np.where(codes < 0, codes, top - codes)):
        lengths, group = lyndon_groups(ranked)
        at = np.flatnonzero(lengths)
        root = lengths[at]
        again = at[group[np.minimum(at + root, len(codes) - 1)] == group[at]]
        earlier = again - lengths[again]
        heads = again[(earlier < 0) | (group[np.maximum(earlier, 0)] != group[again])]
        reached: dict[int, int] = {}
        for i in heads.tolist():
            q = int(lengths[i])
            if reached.get(q, -1) > i + q:
                continue
            after = _extent(codes[i:], codes[i + q :])
            start = i - _extent(codes[:i][::-1], codes[: i + q][::-1])
            end = reached[q] = i + q + after
            if end - start >= max(least, power * q):
                found.add((start, end - start, q))
    return found


def _screened(codes: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Words covered by windows that occur more than once in their text."""
    covered = np.zeros(len(codes) + 1, np.int64)
    windows = rolling(mixed(codes.astype(np.uint64) + np.uint64(1)), width)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(text[: len(windows)] == text[width - 1 :]) if len(windows) else np.empty(0, np.int64)
    keys = mixed(windows[at] ^ mixed(text[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    equal = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    twice = at[np.unique(np.concatenate([order[equal], order[equal + 1]]))]
    np.add.at(covered, twice, 1)
    np.subtract.at(covered, twice + width, 1)
    return np.cumsum(covered[:-1]) > 0


def _batches(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    total = np.cumsum(ends - starts)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + BATCH_WORDS, "right")))
        yield starts[a:b], ends[a:b]
        a = b


def runs_of(codes: np.ndarray, offsets: np.ndarray, least: int = 24, power: int = 3) -> list[tuple[int, int, int]]:
    """All runs of texts ``codes[offsets[i]:offsets[i + 1]]``, as (place in codes, length, period) in order.

    A run has a smallest period q and at least max(least, power * q) words; no
    neighbouring word of its text extends it.
    """
    if power < 3 or least < 2:
        raise ValueError("runs of fewer than three periods are not sought")
    # a run of length n and period q has n - q places whose word recurs q words on
    width = min(max(least, power * q) - q for q in range(1, least + 1))
    hot = _screened(codes, offsets, width)
    begins = np.zeros(len(codes), bool)
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(hot & (begins | ~np.concatenate([[False], hot[:-1]])))
    ends = np.flatnonzero(hot & np.concatenate([begins[1:] | ~hot[1:], [True]])) + 1 if len(codes) else starts
    out = []
    for first, last in _batches(starts, ends):
        sizes = last - first
        places = np.cumsum(sizes + 1) - sizes - 1
        laid = -1 - np.arange(int(sizes.sum()) + len(sizes), dtype=np.int64)
        for place, a, b in zip(places.tolist(), first.tolist(), last.tolist()):
            laid[place : place + b - a] = codes[a:b]
        for start, length, period in _stretch_runs(laid, least, power):
            k = int(np.searchsorted(places, start, "right")) - 1
            out.append((start - int(places[k]) + int(first[k]), length, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def loop_tails(codes: np.ndarray, offsets: np.ndarray, seeds: list[int | None]) -> np.ndarray:
    """The words with a loop planted at the end of the texts whose seed is a multiple of ten.

    With g = seed // 10 and n words, those from a = g % n on repeat the first
    1 + (n - a) // (3 + g % 8) of them.
    """
    codes = codes.copy()
    for i, seed in enumerate(seeds):
        n = int(offsets[i + 1] - offsets[i])
        if seed is not None and seed % 10 == 0 and n:
            g = seed // 10
            a = g % n
            tail = codes[offsets[i] + a : offsets[i + 1]]
            tail[:] = tail[np.arange(n - a) % (1 + (n - a) // (3 + g % 8))]
    return codes


def find_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, power: int = 3, seed: Column | None = None
) -> DataFrame:
    """The periodic runs of every text, and the text without their repetitions.

    Columns doc_id, n_words, runs (start, length and period of each, by start,
    then period), best (the run of greatest length / period, ties to the
    smallest start, then period; null without runs) and collapsed: the words
    outside all runs or among the first period of each, joined by one space.

    Every row has one result, repeated rows and those without identifier too. A
    null text is empty: no words, no runs, an empty collapsed text. Texts are
    taken whole, a very long one alone in its slice. Other columns are ignored.
    ``seed`` plants a loop as ``loop_tails`` does; rows with a null seed stay.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(part.column("text"))
        offsets = words.offsets
        codes = loop_tails(words.codes.astype(np.int64), offsets, part.column("seed").to_pylist())
        found = runs_of(codes, offsets, least, power)
        kept = np.ones(len(codes), bool)
        for start, length, period in found:
            kept[start + period : start + length] = False
        table = np.array(found, np.int64).reshape(-1, 3)
        text = np.searchsorted(offsets, table[:, 0], "right") - 1
        bounds = np.searchsorted(text, np.arange(len(offsets)))
        table[:, 0] -= offsets[text]
        runs = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in range(3)], fields=list(RUN))
        best = []
        for i in range(part.num_rows):
            top = None
            for r in table[bounds[i] : bounds[i + 1]].tolist():
                if top is None or r[1] * top[2] > top[1] * r[2]:
                    top = r
            best.append(top and dict(zip(("start", "length", "period"), top)))
        left = np.concatenate([[0], np.cumsum(kept)])[offsets]
        text_words = words.vocab.take(pa.array(codes[kept]))
        columns = [
            part.column("doc_id"),
            pa.array(np.diff(offsets), pa.int64()),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
            pa.array(best, RUN),
            pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), text_words), " "),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "best", "collapsed"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        (F.lit(None) if seed is None else seed).cast("long").alias("seed"),
    )
    one = "struct<start: bigint, length: bigint, period: bigint>"
    return rows.mapInArrow(per_text(run), f"doc_id {kind}, n_words bigint, runs array<{one}>, best {one}, collapsed string")
