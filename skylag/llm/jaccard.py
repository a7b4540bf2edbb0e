"""Exact n-gram Jaccard links and their classes, by set-relation skipping.

Equal sets are one set. A set's n-grams have one global order, rare ones first,
and two sets that are similar enough share an n-gram among the first few of
each (the prefix). An index list holds the sets of like size with one prefix
n-gram, or with one equal part (``part_lists``); the least of them is its leader, and every set goes, once, to the home
of each of its leaders, where all candidate pairs of those lists meet.

Sketches first rule out, by a lower bound on the difference, the sets that no
other set of the home comes near; only the rest are sent with their texts.

In a home, index lists are ordered by the place of the n-gram in its set and
are left where the place is too late for any pair to reach the threshold. Sets
that are already in one class are not compared. A set that differs little from
one whose overlaps are known derives its own overlaps from those, over the
n-grams in which the two differ. Large homes are dealt in blocks, each with the
leader: what is linked to the leader there is one class. The other sets, the
strays, are dealt in blocks of their own, and each pair of a strays' block with
another block is a unit by itself, so no task holds more than two blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .arrow import Words, checkpointed, hashes, lean, mixed, per_group, per_text, ranges, rolling, words_of
from .components import components

SHINGLE = 5
PERCENT = 80
BLOCK = 2000
BLOCK_GRAMS = 1_000_000
GROUP_SETS = 3000
FREQUENT_KEPT = 200_000
SLOTS = 1 << 20


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all texts, text by text in ascending order, and their bounds.

    A text of fewer words has its whole sequence as one; a text without words has none.
    """
    coded = hashes(words.vocab)[words.codes]
    counts, n = words.counts, len(words.counts)
    grams = rolling(coded, width)
    start = np.arange(len(grams))
    owner = words.owner
    inside = start + width <= words.offsets[1:][owner[: len(start)]]
    values, owners = [grams[inside]], [owner[: len(start)][inside]]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        own = []
        for t in short.tolist():
            x = np.uint64(0)
            for c in coded[words.offsets[t] : words.offsets[t + 1]]:
                x = mixed(np.array([x ^ c], np.uint64))[0] + np.uint64(counts[t])
            own.append(x)
        values.append(np.array(own, np.uint64))
        owners.append(short)
    values, owners = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    return values, np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=n))])


def _set_keys(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    digests = [xxhash.xxh3_128_digest(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def sketch_of(values: np.ndarray) -> bytes:
    """One byte for each of about n / 4 buckets, the sum without carry of its members' hashes.

    Two sets differ in at least as many members as their sketches differ in
    buckets. A sketch folds to any smaller power of two.
    """
    buckets = 1 << max(3, int(len(values) - 1).bit_length() - 1) if len(values) else 8
    spread = mixed(values ^ np.uint64(0x5EED))
    place, mark = (spread & np.uint64(buckets - 1)).astype(np.int64), (spread >> np.uint64(56)).astype(np.uint8) | 1
    order = np.argsort(place, kind="stable")
    out = np.zeros(buckets, np.uint8)
    held = place[order]
    heads = np.flatnonzero(np.append(True, held[1:] != held[:-1])) if len(held) else np.empty(0, np.int64)
    if len(heads):
        out[held[heads]] = np.bitwise_xor.reduceat(mark[order], heads)
    return out.tobytes()


def _folded(sketch: bytes, buckets: int) -> np.ndarray:
    out = np.frombuffer(sketch, np.uint8)
    while len(out) > buckets:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """Two kinds of rows in one pass: a text's set key and size (kind 0), and n-grams frequent in a slice (kind 1)."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        values, bounds = shingle_sets(words_of(part.column("text"), lower=True), width)
        first, second = _set_keys(values, bounds)
        grams, counts = np.unique(values, return_counts=True)
        often = counts >= max(4, part.num_rows // 500)
        grams, counts = grams[often].view(np.int64), counts[often]
        ids = part.column("doc_id").to_numpy(zero_copy_only=False)
        zeros = np.zeros(len(grams), np.int64)
        kind = np.concatenate([np.zeros(len(ids), np.int32), np.ones(len(grams), np.int32)])
        columns = [(ids, grams), (first, zeros), (second, zeros), (np.diff(bounds), counts)]
        sketches = [sketch_of(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(kind), *[pa.array(np.concatenate(c).astype(np.int64)) for c in columns], pa.array(sketches + [None] * len(grams), pa.binary())],
            names=["kind", "id", "k1", "k2", "n", "sketch"],
        )

    return texts.mapInArrow(per_text(run), "kind int, id long, k1 long, k2 long, n long, sketch binary")


def _least_overlap(total, percent: int):
    """Least intersection of two sets of ``total`` members together that meets the threshold."""
    return -(-percent * total // (100 + percent))


class Order:
    """The global order of n-grams: frequent ones last, else by a hash."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = np.sort(frequent)

    def key(self, values: np.ndarray) -> np.ndarray:
        key = mixed(values) >> np.uint64(1)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, values), len(self.frequent) - 1)
            key = np.where(self.frequent[at] == values, key | np.uint64(1 << 63), key)
        return key


def _prefixes(values: np.ndarray, bounds: np.ndarray, order: Order, percent: int):
    """Rows of (n-gram, set, place) of all prefixes, set by set in order."""
    size = np.diff(bounds)
    owner = np.repeat(np.arange(len(size)), size)
    values = values[np.lexsort((order.key(values), owner))]
    place = np.arange(len(values)) - bounds[owner]
    keep = place < size[owner] - -(-percent * size[owner] // 100) + 1
    return values[keep], owner[keep], place[keep]


def size_class(size: np.ndarray) -> np.ndarray:
    """Classes of sizes, each a quarter wide."""
    return np.floor(np.log(np.maximum(size, 1)) / np.log(1.25)).astype(np.int64)


def prefix_lists(values: np.ndarray, bounds: np.ndarray, order: Order, percent: int):
    """Rows of (list, set, whether the set may be the smaller one of a pair there), a list for each prefix n-gram.

    A list is an n-gram for one class of sizes, that of the smaller set. A set
    enters the lists of all classes from its least partner's to its own. The smaller
    set of a pair has a common n-gram among fewer of its first than the larger.
    """
    gram, owner, place = _prefixes(values, bounds, order, percent)
    size = np.diff(bounds)[owner]
    mine, below = size_class(size), size_class(-(-percent * size // 100))
    small = place < size - _least_overlap(2 * size, percent) + 1
    entry = np.repeat(np.arange(len(gram)), mine - below + 1)
    classes = ranges(below, mine - below + 1)
    # the least partner in a list bounds the place of the first common n-gram
    least = np.maximum(-(-percent * size[entry] // 100), (1.25**classes * (1 - 1e-9)).astype(np.int64))
    early = place[entry] <= size[entry] - _least_overlap(size[entry] + least, percent)
    entry, classes = entry[early], classes[early]
    lists = mixed(gram[entry] + mixed(classes.astype(np.uint64)))
    return lists, owner[entry], small[entry] & (classes == mine[entry])


def part_lists(values: np.ndarray, bounds: np.ndarray, percent: int):
    """Rows as in ``prefix_lists``, but a list for each part of the n-grams as a whole.

    A hash deals the n-grams into more parts than two linked sets of a class of
    sizes can differ in, so linked sets have equal parts. Empty parts are spared for:
    a set with no more of them than spare parts needs no list for them, as one of the
    equal parts has members. A set with more of them enters their lists too.
    """
    size = np.diff(bounds)
    mine, below = size_class(size), size_class(-(-percent * size // 100))
    spans = np.where(size > 0, mine - below + 1, 0)
    owner, classes = np.repeat(np.arange(len(size)), spans), ranges(below, spans)
    most = (1.25 ** (classes + 1)).astype(np.int64) + 1
    apart = (most + 100 * most // percent) * (100 - percent) // (100 + percent)
    spare = np.where(apart > 0, 1 + apart // 20, 0)
    parts = apart + 1 + spare
    at = np.concatenate([[0], np.cumsum(parts)])
    entry = np.repeat(np.arange(len(owner)), size[owner])
    spread = mixed(values[ranges(bounds[:-1][owner], size[owner])] ^ np.uint64(0xA17))
    slot = at[entry] + (spread % parts[entry].astype(np.uint64)).astype(np.int64)
    sums = np.zeros(at[-1], np.uint64)
    np.add.at(sums, slot, mixed(spread))
    empty = np.bincount(slot, minlength=at[-1]) == 0
    of = np.repeat(np.arange(len(owner)), parts)
    keep = ~empty | (np.bincount(of[empty], minlength=len(owner)) > spare)[of]
    number = np.arange(at[-1]) - at[of]
    lists = mixed(sums + mixed((number << 8 | classes[of]).astype(np.uint64)))
    return lists[keep], owner[of[keep]], (classes == mine[owner])[of[keep]]


def _postings(texts: DataFrame, width: int, percent: int, frequent: np.ndarray, by_parts: bool) -> DataFrame:
    """Index entries: list, set key and whether the set may be the smaller one of a pair in that list."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        values, bounds = shingle_sets(words_of(part.column("text"), lower=True), width)
        key, _ = _set_keys(values, bounds)
        _, first = np.unique(key, return_index=True)
        lists, owner, small = part_lists(values, bounds, percent) if by_parts else prefix_lists(values, bounds, Order(frequent), percent)
        fresh = np.zeros(len(key), bool)
        fresh[first] = True
        fresh = fresh[owner]
        columns = [pa.array(lists[fresh].view(np.int64)), pa.array(key[owner[fresh]]), pa.array(small[fresh])]
        return pa.RecordBatch.from_arrays(columns, names=["list", "k1", "small"])

    return texts.mapInArrow(per_text(run), "list long, k1 long, small boolean")


def home_links(ids: np.ndarray, leaders: np.ndarray, texts: pa.Array, asks: np.ndarray, width: int, percent: int, frequent: np.ndarray):
    """Links within one unit that join its classes, and whether each set is linked to the leader (if there is one).

    If some sets are marked ``asks`` and some are not, only pairs of one of each count.
    """
    values, bounds = shingle_sets(words_of(texts, lower=True), width)
    size = np.diff(bounds)
    # sets by size, the leader's first
    rank = np.lexsort((ids, size, ~leaders))
    n = len(rank)
    pieces = [values[bounds[i] : bounds[i + 1]] for i in rank]
    ids, size, asks = ids[rank], size[rank], asks[rank]
    sided = bool(asks.any() and not asks.all())
    vocab, flat = np.unique(np.concatenate(pieces), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(size)])
    codes = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    owner = np.repeat(np.arange(n), size)
    # index lists: all sets that hold an n-gram, and the prefix entries by place
    by_gram = np.argsort(flat, kind="stable")
    holders, list_at = owner[by_gram], np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=len(vocab)))])
    gram, holder, place = _prefixes(np.concatenate(pieces), bounds, Order(frequent), percent)
    entry = np.searchsorted(vocab, gram)
    line = np.lexsort((place, entry))
    entry_sorted, entry_set, entry_place = entry[line], holder[line], place[line]
    entry_at = np.searchsorted(entry_sorted, np.arange(len(vocab) + 1))
    own = np.concatenate([[0], np.cumsum(np.bincount(holder, minlength=n))])

    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    mark = np.zeros(len(vocab), bool)
    known: dict[int, np.ndarray] = {}
    links = []

    def overlaps(x: int) -> np.ndarray:
        """Intersection sizes of set x with all sets."""
        base = max(known, key=lambda s: known[s][x], default=None)
        if base is not None:
            both = known[base][x]
            if 4 * (size[x] + size[base] - 2 * both) < size[x]:
                mark[codes[base]] = True
                gained = codes[x][~mark[codes[x]]]
                mark[codes[base]] = False
                mark[codes[x]] = True
                lost = codes[base][~mark[codes[base]]]
                mark[codes[x]] = False
                out = known[base].copy()
                for own_grams, sign in ((gained, 1), (lost, -1)):
                    for g in own_grams.tolist():
                        out[holders[list_at[g] : list_at[g + 1]]] += sign
                return out
        mark[codes[x]] = True
        out = np.add.reduceat(np.append(mark[flat], False).astype(np.int64), bounds[:-1])
        mark[codes[x]] = False
        return out

    # compared with the leader first, then the sets in their order
    for x in range(n):
        if sided and not asks[x]:
            continue
        if x == 0 and not sided:
            near = np.arange(1, n)
        else:
            found = []
            late = 100 * size[x] // percent
            for g, p in zip(entry[own[x] : own[x + 1]].tolist(), place[own[x] : own[x + 1]].tolist(), strict=True):
                a, b = entry_at[g], entry_at[g + 1]
                if b - a < 2:
                    continue
                # a partner has at most ``late`` members, so an entry behind this place cannot meet the threshold
                latest = late - _least_overlap(size[x] + late, percent) + 1
                b = a + int(np.searchsorted(entry_place[a:b], latest, "right"))
                others, at = entry_set[a:b], entry_place[a:b]
                enough = np.minimum(size[x] - p, size[others] - at) >= _least_overlap(size[x] + size[others], percent)
                found.append(others[enough])
            near = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
            if sided:
                near = near[~asks[near]]
            mine = root(x)
            near = np.array([y for y in near.tolist() if y != x and root(y) != mine], np.int64)
        if not len(near):
            continue
        shared = overlaps(x)
        if len(known) < 8:
            known[x] = shared
        union = size[x] + size - shared
        for y in near[100 * shared[near] >= percent * union[near]].tolist():
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((ids[x], ids[y]))
    out = np.zeros(n, bool)
    if leaders.any():
        shared = known[0] if 0 in known else overlaps(0)
        out[rank] = 100 * shared >= percent * (size[0] + size - shared)
    return links, out


def _near(marks: np.ndarray, size: np.ndarray, asks: np.ndarray, percent: int) -> np.ndarray:
    """Sets that their sketches do not keep apart from every other set of the unit, or of its other side."""
    keep = np.zeros(len(size), bool)
    sided = asks.any() and not asks.all()
    other = np.flatnonzero(~asks) if sided else np.arange(len(size))
    for i in np.flatnonzero(asks).tolist() if sided else range(len(size) - 1):
        rest = other if sided else other[i + 1 :]
        total = size[i] + size[rest]
        least = _least_overlap(total, percent)
        apart = (marks[rest] != marks[i]).sum(axis=1)
        near = (apart <= total - 2 * least) & (least <= np.minimum(size[i], size[rest]))
        if near.any():
            keep[i] = True
            keep[rest[near]] = True
    return keep


def _units(leader: np.ndarray, unit: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the units in rows sorted by home and unit."""
    new = np.flatnonzero(np.append(True, (leader[1:] != leader[:-1]) | (unit[1:] != unit[:-1]))).tolist() if len(leader) else []
    return list(zip(new, [*new[1:], len(leader)], strict=True))


def _grouped(members: DataFrame, groups: int):
    """Units of small homes by ``groups`` parts, every unit of a large one by itself."""
    part = F.when(F.col("large"), F.col("unit")).otherwise(F.pmod(F.xxhash64("leader"), F.lit(groups)).cast("long"))
    return members.withColumn("home", F.when(F.col("large"), F.col("leader"))).withColumn("part", part).groupBy("home", "part")


def _possible(members: DataFrame, groups: int, percent: int) -> DataFrame:
    """Members that their sketches do not keep apart from every other set that they are compared with in the unit."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("leader", "ascending"), ("unit", "ascending"), ("doc_id", "ascending")])
        size, asks = table.column("n").to_numpy(), table.column("asks").to_numpy()
        sketches = table.column("sketch").to_pylist()
        keep = np.zeros(len(size), bool)
        for a, b in _units(table.column("leader").to_numpy(), table.column("unit").to_numpy()):
            buckets = min(map(len, sketches[a:b]))
            marks = np.stack([_folded(x, buckets) for x in sketches[a:b]])
            keep[a:b] = _near(marks, size[a:b], asks[a:b], percent)
        return table.select(["doc_id", "n", "leader", "is_leader", "large", "unit", "asks"]).filter(pa.array(keep))

    kinds = "doc_id long, n long, leader long, is_leader boolean, large boolean, unit long, asks boolean"
    return _grouped(members, groups).applyInArrow(per_group(run), kinds)


def _homes(members: DataFrame, groups: int, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Rows (a, b) of links, and rows (leader, set) of kind 1 for the sets of large homes that are linked to the leader."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("leader", "ascending"), ("unit", "ascending"), ("doc_id", "ascending")])
        leader, large = table.column("leader").to_numpy(), table.column("large").to_numpy()
        ids, heads = table.column("doc_id").to_numpy(), table.column("is_leader").to_numpy()
        asks, texts = table.column("asks").to_numpy(), table.column("text").combine_chunks()
        kinds, first, second = [], [], []
        for a, b in _units(leader, table.column("unit").to_numpy()):
            if b - a < 2:
                continue
            _, keep = np.unique(ids[a:b], return_index=True)
            keep = keep + a
            links, linked = home_links(ids[keep], heads[keep], texts.take(pa.array(keep)), asks[keep], width, percent, frequent)
            for x, y in links:
                kinds.append(0)
                first.append(x)
                second.append(y)
            if large[a]:
                for x in ids[keep][linked].tolist():
                    kinds.append(1)
                    first.append(leader[a])
                    second.append(x)
        return pa.table({"kind": pa.array(kinds, pa.int32()), "a": pa.array(first, pa.int64()), "b": pa.array(second, pa.int64())})

    return _grouped(members, groups).applyInArrow(per_group(run), "kind int, a long, b long")


def _strays(members: DataFrame, linked: DataFrame, fill: int) -> DataFrame:
    """Members of large homes that are not linked to the leader, in the units where they meet each other and the linked ones.

    Both kinds are dealt in blocks. A unit is a pair of strays' blocks, of which the
    first asks, one block of strays alone, or a block of strays that asks one of linked sets.
    The leader itself has been compared with all of its home.
    """
    core = linked.select("leader", "doc_id", F.lit(True).alias("core"))
    held = members.where("large AND NOT is_leader").join(core, ["leader", "doc_id"], "left").withColumn("core", F.col("core").isNotNull())

    def blocks(of: Column) -> Column:
        sets, grams = F.count(F.when(of, 1)), F.sum(F.when(of, F.col("n")))
        return F.greatest(F.ceil(sets / fill), F.least(sets, F.ceil(grams / BLOCK_GRAMS))).cast("long")

    tally = held.groupBy("leader").agg(blocks(~F.col("core")).alias("apart"), F.coalesce(blocks(F.col("core")), F.lit(0)).alias("linked"))
    dealt = held.join(tally.where("apart > 0"), "leader")
    mine = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.when(F.col("core"), F.col("linked")).otherwise(F.col("apart")))
    among = "transform(sequence(0, apart - 1), j -> struct(least(mine, j) * 2147483648 + greatest(mine, j) AS unit, mine <= j AS asks))"
    to_core = "transform(sequence(1, linked), j -> struct(mine * 2147483648 + 1073741824 + j AS unit, true AS asks))"
    asked = "transform(sequence(0, apart - 1), j -> struct(j * 2147483648 + 1073741825 + mine AS unit, false AS asks))"
    places = f"CASE WHEN core THEN {asked} WHEN linked > 0 THEN concat({among}, {to_core}) ELSE {among} END"
    placed = dealt.withColumn("mine", mine).withColumn("place", F.explode(F.expr(places)))
    return placed.select("doc_id", "n", "sketch", "leader", "is_leader", "large", "place.unit", "place.asks")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT,
    block: int = BLOCK, group_sets: int = GROUP_SETS, by_parts: bool = False,
) -> DataFrame:
    """Per row doc_id, n_shingles and component_id, the least identifier reachable over links.

    Two texts link when 100 * intersection >= percent * union of their sets of
    distinct ``width``-word n-grams (A-Z lowered). Identifiers are whole
    numbers; rows without one are left out. By default five words and 0.8. A null, empty or wordless text has
    an empty set and no link. Repeated rows link with each other like any equal
    sets. A unit of a large home has at most two blocks of ``block`` sets. ``by_parts`` finds
    candidates by equal parts of sets instead of single n-grams: for short
    n-grams, which many texts share by chance, and thresholds of 90 or more.
    """
    if by_parts and percent < 90:
        raise ValueError("index lists of parts need a threshold of 90 percent or more")
    texts = lean(df, id_col, text_col).where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    scanned = checkpointed(_sets(texts, width))
    sets = scanned.where("kind = 0").select(F.col("id").alias("doc_id"), "k1", "k2", "n")
    sketches = scanned.where("kind = 0 AND n > 0").groupBy("k1", "k2").agg(F.min("id").alias("doc_id"), F.first("n").alias("n"), F.min("sketch").alias("sketch"))
    often = scanned.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").limit(FREQUENT_KEPT)
    frequent = np.array([r[0] for r in often.select("id").collect()], np.int64).view(np.uint64)

    reps = sets.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    postings = materialise(_postings(texts, width, percent, frequent, by_parts), "index-lists")
    lists = postings.groupBy("list").agg(F.min("k1").alias("leader"), F.max("k1").alias("last"), F.max("small").alias("small"))
    leaders = lists.where("leader < last AND small").select("list", "leader")
    homes = checkpointed(postings.select("list", "k1").join(leaders, "list").select("k1", "leader").distinct())
    held = homes.join(sketches.select("k1", "n"), "k1")
    # blocks are filled by a hash, so three quarters on average keep them below their bound
    fill = max(1, 3 * block // 4)
    count, grams = F.count(F.lit(1)), F.ceil(F.sum("n") / BLOCK_GRAMS)
    blocks = F.greatest(F.when(count > block, F.ceil(count / fill)).otherwise(1), F.least(count, grams)).cast("long")
    sizes = held.groupBy("leader").agg(blocks.alias("blocks"))
    members = homes.join(sizes, "leader").join(sketches, "k1").withColumn("large", F.col("blocks") > 1)
    members = members.select("doc_id", "leader", "n", "sketch", "blocks", "large", (F.col("k1") == F.col("leader")).alias("is_leader"))

    def parts(rows: DataFrame) -> int:
        rows, grams = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
        return max(1, -(-rows // group_sets), -(-(grams or 0) // BLOCK_GRAMS))

    def shipped(rows: DataFrame) -> DataFrame:
        """Members with their texts."""
        place = F.struct("leader", "unit", "large", "is_leader", "asks")
        per_doc = rows.groupBy("doc_id").agg(F.collect_list(place).alias("places")).hint("shuffle_hash")
        # at most SLOTS rows are broadcast: texts whose identifier falls on none of them need not be shuffled
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
        taken = rows.select(slot.alias("slot")).distinct()
        once = texts.withColumn("slot", slot).join(F.broadcast(taken), "slot", "left_semi").drop("slot").join(per_doc, "doc_id")
        return once.select("doc_id", "text", F.explode("places").alias("p")).select("doc_id", "text", "p.*")

    def linked(dealt: DataFrame, groups: int) -> DataFrame:
        left = checkpointed(_possible(dealt, groups, percent))
        return checkpointed(_homes(shipped(left), parts(left), width, percent, frequent))

    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    unit = F.explode(F.when(F.col("is_leader"), every).otherwise(F.array(F.pmod(F.xxhash64("doc_id"), F.col("blocks")))))
    found = linked(members.withColumn("unit", unit).withColumn("asks", F.lit(False)), parts(held))
    edges = found.where("kind = 0").select("a", "b")
    if not sizes.where("blocks > 1").isEmpty():
        at_leader = found.where("kind = 1").select(F.col("a").alias("leader"), F.col("b").alias("doc_id"))
        edges = edges.union(linked(_strays(members, at_leader, fill), 1).where("kind = 0").select("a", "b"))

    classes = components(edges)
    by_rep = reps.join(classes, F.col("rep") == F.col("node"), "left").select("k1", "k2", F.coalesce("component", "rep").alias("component_id"))
    out = sets.join(by_rep, ["k1", "k2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
