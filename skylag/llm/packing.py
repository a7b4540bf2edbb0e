"""Best-fit packing with certified bin counts.

Texts become token ids; only texts longer than a sequence are cut. Pieces are
packed best-fit decreasing in partitions of bounded size. Dual feasible
functions give every partition a lower bound on its bins: where the bins meet
the bound the partition is certified and closed. Partitions with a gap close
their full bins and exchange the rest of their pieces with the other open
partitions, which are packed again in a new dealing. The last round takes what
comes out.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import NARROW_SLICE, checkpointed, lean, per_group, per_text, ranges, words_of

CAPACITY = 2048
PER_PARTITION = 60_000
ROUNDS = 4
_ENCODE = 20_000
_NONE, _WIDE = np.int64(1 << 20), np.int64(1 << 40)


class WordEncoder:
    """Ids of words by a word-end BPE tokenizer file, all words of a batch at a time.

    Words of Latin letters, digits and plain punctuation are merged together in
    numpy: each round merges the lowest-ranked leftmost pair of every pre-token.
    All other words, and very long ones, go to the tokenizers library itself.
    """

    LONGEST = 64
    # What the vectorised path takes; it has no case, contraction
    # or special-token rules beyond lower-casing and class changes.
    PLAIN = r'^[A-Za-zÀ-ÖØ-öø-ÿ0-9!"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~]{1,64}$'

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = [ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(b))[0][0] for b in range(128)]
        high = {}  # the printable stand-in of each byte that occurs in two-byte letters
        for code in range(0xC0, 0x100):
            shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0]
            high.update(zip(chr(code).encode(), shown, strict=True))
        self.inner, self.final = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for b in range(256):
            shown = letters[b] if b < 128 else high.get(b)
            if shown is not None:
                self.inner[b], self.final[b] = vocab[shown], vocab[shown + end]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) + vocab[b] for a, b in merges], np.uint64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.slots = np.full(1 << 20, -1, np.int64)
        self.keys, self.probes = keys, 1
        for rank, slot in enumerate(self._slot(keys).tolist()):
            tries = 1
            while self.slots[slot] >= 0:
                slot, tries = (slot + 1) % len(self.slots), tries + 1
            self.slots[slot], self.probes = rank, max(self.probes, tries)
        kind = np.full(256, 2, np.int8)
        kind[ord("a") : ord("z") + 1] = 0
        kind[0x80:] = 0
        kind[ord("0") : ord("9") + 1] = 1
        self.kind = kind

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE where it does not merge."""
        keys = (left.astype(np.uint64) << np.uint64(32)) + right.astype(np.uint64)
        slot, out = self._slot(keys), np.full(len(keys), _NONE)
        for k in range(self.probes):
            found = self.slots[(slot + k) & (len(self.slots) - 1)]
            hit = (found >= 0) & (self.keys[found] == keys)
            out[hit] = found[hit]
        return out

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.utf8_lower(words)
        sizes = pc.binary_length(words).to_numpy().astype(np.int64)
        raw = np.frombuffer(b"".join(words.cast(pa.binary()).to_pylist()), np.uint8)
        starts = np.cumsum(sizes) - sizes
        kind = self.kind[raw]
        head = np.ones(len(raw), bool)
        head[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 1)
        head[starts] = True
        last = np.append(head[1:], True)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        symbols = np.where(last, self.final[raw], self.inner[raw])
        token = np.cumsum(head) - 1
        position = np.arange(len(raw))
        rank = np.full(len(raw), _NONE)
        inside = np.flatnonzero(~last)
        rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
        done_symbols, done_place = [], []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            best = np.minimum.reduceat(rank * _WIDE + np.arange(len(rank)), starts)
            active = best < _NONE * _WIDE
            keep = np.repeat(active, np.diff(np.append(starts, len(symbols))))
            done_symbols.append(symbols[~keep])
            done_place.append(position[~keep])
            at = best[active] % _WIDE
            symbols[at] = self.merged[best[active] // _WIDE]
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, token, position, rank = symbols[keep], token[keep], position[keep], rank[keep]
            at = moved[at]
            if not len(symbols):
                break
            same = np.append(token[1:] == token[:-1], False)
            touched = np.concatenate([at, at[(at > 0) & (token[at - 1] == token[at])] - 1])
            rank[touched] = _NONE
            touched = touched[same[touched]]
            rank[touched] = self.ranks(symbols[touched], symbols[touched + 1])
        flat, place = np.concatenate([*done_symbols, np.empty(0, np.int64)]), np.concatenate([*done_place, np.empty(0, np.int64)])
        order = np.argsort(place, kind="stable")
        return flat[order].astype(np.uint32), np.bincount(owner[place], minlength=len(sizes))

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the number of ids of each."""
        plain = pc.match_substring_regex(words, self.PLAIN).to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(words), np.int64)
        first, sizes[plain] = self._plain(words.filter(pa.array(plain)))
        others, second = words.filter(pa.array(~plain)).to_pylist(), []
        counts = []
        for k in range(0, len(others), _ENCODE):
            for e in self.library.encode_batch_fast(others[k : k + _ENCODE], add_special_tokens=False):
                second.extend(e.ids)
                counts.append(len(e.ids))
        sizes[~plain] = counts
        at, flat = np.cumsum(sizes) - sizes, np.empty(int(sizes.sum()), np.uint32)
        flat[ranges(at[plain], sizes[plain])] = first
        flat[ranges(at[~plain], sizes[~plain])] = second
        return flat, sizes


@cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenise(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    The tokenizer drops white space and never merges over it, so each distinct
    word of a batch is encoded once and the ids of the texts are gathered. A
    null or empty text is its end id alone.
    """
    fields = [("doc_id", df.schema[id_col].dataType), ("piece", "int"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")]
    names = ", ".join(f"{n} {t if isinstance(t, str) else t.simpleString()}" for n, t in fields)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(part.column("text"))
        flat, sizes = word_encoder(tokenizer)(words.vocab)
        first = np.cumsum(sizes) - sizes
        per_word = sizes[words.codes]
        ids = flat[ranges(first[words.codes], per_word)]
        ends = np.concatenate([[0], np.cumsum(per_word)])[words.offsets]
        rows, pieces, starts, lengths, crcs, kept = [], [], [], [], [], []
        for i in range(part.num_rows):
            own = np.append(ids[ends[i] : ends[i + 1]], np.uint32(end_id))
            for k, at in enumerate(range(0, len(own), capacity)):
                chunk = own[at : at + capacity].astype("<u4").tobytes()
                rows.append(i)
                pieces.append(k)
                starts.append(at)
                lengths.append(len(chunk) // 4)
                crcs.append(zlib.crc32(chunk))
                if keep_ids:
                    kept.append(chunk)
        columns = [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32())]
        columns += [pa.array(c, pa.int64()) for c in (starts, lengths, crcs)]
        if keep_ids:
            columns.append(pa.array(kept, pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields] + ["ids"] * keep_ids)

    return lean(df, id_col, text_col).mapInArrow(per_text(run, NARROW_SLICE), names + ", ids binary" * keep_ids)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual feasible functions.

    The first drops items below a threshold and rounds those above its
    complement up to a whole bin; the second rounds to multiples of 1/k.
    """
    counts = np.bincount(sizes, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    x = np.arange(capacity + 1)
    mass = np.concatenate([[0], np.cumsum(counts * x)])
    number = np.concatenate([[0], np.cumsum(counts)])
    e = np.arange(capacity // 2 + 1)
    middle = mass[capacity - e + 1] - mass[e]
    large = number[capacity + 1] - number[capacity - e + 1]
    best = int(np.max(large + -(-middle // capacity)))
    for k in range(1, 33):
        scaled = (k + 1) * x
        whole = scaled % capacity == 0
        # values in units of capacity / k for the rounded part, exact in integers
        value = np.where(whole, x * k, (scaled // capacity) * capacity)
        best = max(best, int(-(-int(np.sum(counts * value)) // (k * capacity))))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item. Open bins hang on their remaining room; the tightest that fits is taken."""
    order = np.argsort(-sizes, kind="stable")
    rooms: list[int] = []  # distinct remaining rooms, ascending
    holders: dict[int, list[int]] = {}
    out, used = np.empty(len(sizes), np.int64), 0
    for i in order.tolist():
        size = int(sizes[i])
        at = bisect_left(rooms, size)
        if at == len(rooms):
            number, room, used = used, capacity - size, used + 1
        else:
            room = rooms[at]
            number = holders[room].pop()
            if not holders[room]:
                del holders[room], rooms[at]
            room -= size
        out[i] = number
        if room:
            if room not in holders:
                holders[room] = []
                insort(rooms, room)
            holders[room].append(number)
    return out


def _pack_group(capacity: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        sizes = table.column("length").to_numpy()
        bins = best_fit_decreasing(sizes, capacity)
        used, bound = int(bins.max()) + 1, lower_bound(sizes, capacity)
        fill = np.bincount(bins, weights=sizes, minlength=used).astype(np.int64)
        closed = np.ones(used, bool) if last or used <= bound else fill == capacity
        order = np.argsort(bins, kind="stable")
        sums = np.cumsum(sizes[order]) - sizes[order]
        first = np.searchsorted(bins[order], np.arange(used))
        offset = np.empty(len(sizes), np.int64)
        offset[order] = sums - sums[first][bins[order]]
        extra = {
            "bin": pa.array(bins), "offset": pa.array(offset), "closed": pa.array(closed[bins]),
            "bins": pa.array(np.full(len(sizes), used)), "bound": pa.array(np.full(len(sizes), bound)),
        }
        for name, values in extra.items():
            table = table.append_column(name, values)
        return table

    return run


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, per_partition: int = PER_PARTITION, rounds: int = ROUNDS
) -> DataFrame:
    """Place rows of (doc_id, piece, length, ...) in sequences of ``capacity``.

    Adds sequence_id and offset (gapless from 0) plus ``bins`` and ``bound``,
    the bins and the certified least number of bins of the partition that the
    row was packed in. Every row is placed once. Lengths are 1 .. capacity. No
    rows give no rows. Ties go by doc_id, then piece.
    """
    columns = pieces.columns
    out_type = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    out_type += ", bin long, offset long, closed boolean, bins long, bound long, part long"
    open_rows = checkpointed(pieces)
    placed = []
    for turn in range(rounds):
        n = open_rows.count()
        if n == 0:
            break
        parts = -(-n // per_partition)
        last = turn == rounds - 1 or (turn > 0 and parts == 1)
        dealt = open_rows.select(*columns, F.pmod(F.xxhash64("doc_id", "piece", F.lit(turn)), F.lit(parts)).alias("part"))
        grouped = dealt.groupBy("part").applyInArrow(per_group(_with_part(_pack_group(capacity, last))), out_type)
        packed = checkpointed(grouped)
        number = (F.lit(turn).cast("long") * (1 << 56)) + F.col("part") * (1 << 28) + F.col("bin")
        placed.append(packed.where("closed").select(*columns, number.alias("sequence_id"), "offset", "bins", "bound"))
        open_rows = packed.where("NOT closed").select(*columns)
    if not placed:
        empty = open_rows.select(*columns, *[F.lit(0).cast("long").alias(c) for c in ("sequence_id", "offset", "bins", "bound")])
        return empty.where(F.lit(False))
    out = placed[0]
    for more in placed[1:]:
        out = out.union(more)
    return out


def _with_part(fn):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")
        out = fn(table.drop_columns(["part"]))
        return out.append_column("part", pa.array(np.full(out.num_rows, part[0].as_py()), pa.int64()))

    return run


def pack_documents(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, keep_ids: bool = False,
) -> DataFrame:
    """Tokenise and pack whole texts; see ``tokenise`` and ``pack``.

    Null and empty texts take one place for the end id. Repeated rows are
    packed as often as they occur.
    """
    return pack(tokenise(df, tokenizer, id_col, text_col, capacity, keep_ids=keep_ids), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens and their little-endian ids. Needs ``keep_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(F.transform(parts, lambda p: p["ids"]), F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ids.alias("ids"))
