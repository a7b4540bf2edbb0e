"""The training-text operators against brute force on small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skylag.llm import ann, bpe, html_text, jaccard, line_dedup, lm_scoring, packing, quality, substring_dedup, topk
from skylag.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, extra string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def corpus(seed=5, n=120):
    """Random texts with copies, near copies, shared lines, nulls, empty and odd ones."""
    rng = random.Random(seed)
    words = ["the", "of", "Éa", "naïve", "x1", "end.", "(so)", "don't", *[f"w{i}" for i in range(60)]]
    line = lambda k: " ".join(rng.choices(words, k=k))
    shared = [line(25) for _ in range(4)]
    texts = []
    for i in range(n):
        body = [line(rng.randint(1, 15)) for _ in range(rng.randint(1, 6))]
        if i % 5 == 0:
            body.insert(rng.randint(0, len(body)), rng.choice(shared))
            body.insert(0, shared[0] + "\n" + shared[1])
        texts.append("\n".join(body))
    for i in range(0, n, 6):
        own = texts[i].split(" ")
        if rng.random() < 0.5:
            own[rng.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
    texts += [None, "", " \n\t", "a", "A b", "a  B", "word " * 400, "\n\n\n", "x" * 3000, "　odd\x85 space　s  ", "<|endoftext|> 😀 ﷽"]
    return [(i, t, "doc_id") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_line_chunks(docs, rows, empty):
    seen, wanted = set(), {}
    for i, text, _ in rows:
        kept = []
        for chunk in line_dedup.chunks_of(text or ""):
            if "\n" in chunk and not chunk.isspace():
                if chunk in seen:
                    continue
                seen.add(chunk)
            kept.append(chunk)
        wanted[i] = "\n".join(kept)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert {i: r["text"] for i, r in got.items()} == wanted
    assert sum(r["n_removed"] for r in got.values()) > 10
    assert line_dedup.dedup_lines(empty).count() == 0
    # repeated rows give one result each, rows without identifier none
    twice = docs.union(docs.where("doc_id = 0")).union(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    assert line_dedup.dedup_lines(twice).where("doc_id = 0").select("text").distinct().count() == 1
    assert line_dedup.dedup_lines(twice).count() == len(rows) + 1


def test_chunks_resist_a_shift():
    lines = [f"line {i * i % 97}" for i in range(300)]
    plain, moved = (set(line_dedup.chunks_of("\n".join(x))) for x in (lines, ["new"] + lines))
    assert len(plain & moved) > 0.9 * len(plain)
    assert all("\n".join(line_dedup.chunks_of(t)) == t for t in ("", "a", "\n", "a\n\nb\n"))


def test_chunks_catch_short_passages():
    rng, seen, caught = random.Random(8), set(), 0
    for n in range(400):  # texts of six lines, then texts that share four of them between other neighbours
        for lines in ([f"{n} {k}" for k in range(6)], [f"a {n}", f"b {n}", *[f"{n} {k}" for k in range(1, 5)], f"c {n}", f"d {rng.random()}"]):
            for chunk in line_dedup.chunks_of("\n".join(lines)):
                caught += "\n" in chunk and chunk in seen
                seen.add(chunk)
    assert caught > 120


def test_language_model(docs, rows, empty):
    counts, tokens = Counter(), {}
    for i, text, _ in rows:
        tokens[i] = [*WORD.findall(lower(text or "")), "\n"]
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    learns = "crc32(cast(cast(doc_id AS string) AS binary)) % 7 <> 2"
    for head in (1 << 20, 16):  # all words broadcast, or most of them joined
        got = lm_scoring.score_texts(docs, learns, head=head).collect()
        assert len(got) == len(rows)
        for r in got:
            own = tokens[r["doc_id"]]
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), n)
            assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
            assert r["score"] < 0
        learnt = [r for r in got if not r["held_out"]]
        assert sum(r["score"] for r in learnt) > sum(r["base_score"] for r in learnt)
    assert lm_scoring.score_texts(empty, learns).count() == 0


def test_words_of_a_class_hang_on_their_history(spark):
    pairs = [("left", "aaing", 60), ("right", "bbing", 60), ("left", "bbing", 6), ("right", "aaing", 6)]
    texts = [f"{a} {b} after" for a, b, n in pairs for _ in range(n)]
    held = [f"{a} {b} after" for a, b, _ in pairs]
    rows = [*enumerate(texts), *enumerate(held, 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(docs, "doc_id < 1000").collect()}
    # both words are as frequent and of one class
    assert got[1000] - got[1002] > 0.2 and got[1001] - got[1003] > 0.2


def test_score_is_the_softmax_over_classes_and_words(spark, monkeypatch):
    rng = random.Random(4)
    words = [a + b + c for a in ("ba", "ko", "mi", "tu") for b in ("", "r", "s", "lo") for c in ("ing", "ed", "s")]
    rows = [(i, " ".join(rng.choices(words, range(1, len(words) + 1), k=rng.randint(0, 30)))) for i in range(60)]
    rows += [(1000, "baing unknown words KOED"), (1001, None)]
    kept, train = [], lm_scoring.train
    monkeypatch.setattr(lm_scoring, "train", lambda *args: kept.append((train(*args), *args[1:3])) or kept[0][0])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(docs, "doc_id < 1000").collect()}
    weights, _, own = kept[0]
    assert np.abs(weights[0]).max() > 0 and np.abs(weights[1]).max() > 0

    counts = Counter(w for i, text in rows if i < 1000 for w in [*text.split(), None])
    known = [w for w in counts if w]
    codes, vocab, cells, _ = lm_scoring._tokens(pa.array([" ".join(known)]))
    place = dict(zip([*known, None], zip(*(x[codes].tolist() for x in lm_scoring._placed(vocab, cells, own)), strict=True), strict=True))
    assert len({place[w] for w in known if place[w][1] < lm_scoring.OWN}) == len(own[0])
    for i, text in rows:
        codes, vocab, cells, bounds = lm_scoring._tokens(pa.array([text or ""]))
        histories = lm_scoring._histories(codes, vocab, bounds)
        classes, slots = (x[codes] for x in lm_scoring._placed(vocab, cells, own))
        expected = 0.0
        for k, w in enumerate([*WORD.findall(lower(text or "")), None]):
            logits = lm_scoring._logits(weights[0], histories[:, k : k + 1])[0].astype(float)
            expected += logits[classes[k]] - math.log(sum(math.exp(x) for x in logits))
            if w is None:
                continue  # the only word of its class
            theta = lm_scoring._logits(weights[1], lm_scoring._within(histories[:, k : k + 1], classes[k : k + 1]))[0].astype(float)
            rivals = [math.log(counts[x] + 1) + theta[place[x][1]] for x in known if place[x][0] == classes[k]]
            rivals += theta[lm_scoring.OWN :].tolist()  # an unknown word in every shared slot
            expected += math.log(counts[w] + 1) + theta[slots[k]] - math.log(sum(math.exp(x) for x in rivals))
        assert got[i] == pytest.approx(expected / math.log(10), rel=1e-4)


def test_class_softmax_is_a_distribution():
    weights = np.random.default_rng(1).normal(size=(lm_scoring._FEATURES * lm_scoring.SLOTS + 1, lm_scoring.CLASSES)).astype(np.float32)
    codes, vocab, _, bounds = lm_scoring._tokens(pa.array(["a b c", "", "b"]))
    p = lm_scoring._softmax(lm_scoring._logits(weights, lm_scoring._histories(codes, vocab, bounds)))
    assert p.shape == (7, lm_scoring.CLASSES) and np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_packing(docs, rows, empty, spark):
    from tokenizers import Tokenizer

    library, capacity = Tokenizer.from_file(WORD_FILE), 64
    placed = packing.pack_documents(docs, WORD_FILE, capacity=capacity, keep_ids=True)
    got = placed.collect()
    by_doc: dict = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], {})[r["piece"]] = r
    assert set(by_doc) == {i for i, _, _ in rows}
    for i, text, _ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = [by_doc[i][k] for k in range(len(by_doc[i]))]
        assert [p["start"] for p in pieces] == list(range(0, len(ids), capacity))
        assert np.concatenate([np.frombuffer(p["ids"], "<u4") for p in pieces]).tolist() == ids
        assert all(p["ids_crc32"] == zlib.crc32(p["ids"]) and p["length"] == len(p["ids"]) // 4 for p in pieces)
    bins: dict = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= 1.02 * packing.lower_bound(np.array([r["length"] for r in got]), capacity) + 1
    assert packing.sequences(placed).agg(F.sum("n_tokens")).first()[0] == sum(r["length"] for r in got)
    assert packing.pack_documents(empty, WORD_FILE).count() == 0


def test_packing_exchanges_between_partitions(spark):
    items = spark.createDataFrame([(i, 0, 1 + (i * 37) % 90) for i in range(900)], "doc_id long, piece int, length long")
    got = packing.pack(items, 100, per_partition=300).collect()
    fill = Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert len(got) == 900 and max(fill.values()) <= 100 and len({r["sequence_id"] >> 56 for r in got}) > 1
    assert len(fill) <= packing.lower_bound(np.array([r["length"] for r in got]), 100) * 1.03


def test_lower_bound_never_exceeds_the_best():
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3
    assert packing.lower_bound(np.array([4, 4, 4, 4]), 10) == 2
    rng = np.random.default_rng(3)
    for _ in range(50):
        sizes = rng.integers(1, 21, 30)
        assert packing.lower_bound(sizes, 20) <= packing.best_fit_decreasing(sizes, 20).max() + 1


def vectors(n=400, d=8, seed=4):
    x = np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)
    x[50:120] = x[50]  # one vector many times
    out = [(i, v.tolist(), "vec_id") for i, v in enumerate(x)]
    return out + [(n, None, ""), (n + 1, [0.0] * d, ""), (n + 2, [float("nan")] * d, ""), (n + 3, [1.0] * (d - 1) + [None], ""), (n + 4, [1.0], ""), (None, [1.0] * d, "")]


def best(x, ids, k, is_query):
    scores, out = x @ x.T, {}
    for i in np.flatnonzero([is_query(v) for v in ids]):
        others = np.flatnonzero(ids != ids[i])
        order = others[np.lexsort((ids[others], -scores[i, others]))[:k]]
        out[int(ids[i])] = [int(v) for v in ids[order]]
    return out


def answers(df):
    out: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


@pytest.mark.parametrize("block", [4000, 30])
def test_vector_searches(spark, block):
    data = vectors()
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label string")
    good = [(i, v) for i, v, _ in data if i is not None and i < 402 and v is not None]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good], np.float64)
    exact = answers(topk.search(df, F.col("vec_id") % 20 == 0, k=7, block=block))
    assert exact == best(np.floor(64 * x), ids, 7, lambda v: v % 20 == 0)
    some = ids != 401
    wanted = best(x[some], ids[some], 7, lambda v: v % 20 == 0)
    found = answers(ann.search(df, F.col("vec_id") % 20 == 0, k=7, block=block, centroids=8))
    assert set(found) == set(wanted)
    assert np.mean([len(set(found[q]) & set(w)) / 7 for q, w in wanted.items()]) >= 0.9
    whole = answers(ann.search(df, F.col("vec_id") % 20 == 0, k=7, block=block, centroids=8, visit=1.0))
    assert whole == wanted
    none = df.where("false")
    assert topk.search(none, F.col("vec_id") % 20 == 0).count() == 0 == ann.search(none, F.col("vec_id") % 20 == 0).count()


def test_bounds_keep_every_needed_group():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.3, size=(40, 3)) for c in (-9, 0, 9)])
    pivots = np.array([[-9.0] * 3, [0.0] * 3, [9.0] * 3])
    group = np.repeat(np.arange(3), 40)
    far = np.array([np.linalg.norm(x[group == g] - pivots[g], axis=1).max() for g in range(3)])
    needed = topk.needed_groups(pivots, np.full(3, 40.0), far, far, 5)
    for i in range(120):
        top = [j for j in np.argsort(-(x @ x[i])) if j != i][:5]
        assert needed[group[i], group[top]].all()
    assert not needed.all()


def test_rows_go_only_to_turns_that_may_need_them():
    rng = np.random.default_rng(4)
    needed = rng.random((40, 40)) < 0.1
    asked = rng.integers(0, 60, 40).astype(float)
    asked[7] = 450  # a hot group has turns of its own
    first, number = topk.dealt_turns(asked, rng.integers(0, 9, 40), 100)
    load: dict = {}
    for g in range(40):
        for t in range(int(number[g])):
            load[first[g] + t] = load.get(first[g] + t, 0) + asked[g] / number[g]
    assert number[7] == 5 and max(load.values()) <= 100 and all(load[first[7] + t] == 90 for t in range(5))
    spans = topk.turns_needed(needed, asked, first, number)
    sent = [{t for a, b in own for t in range(a, b + 1)} for own in spans]
    assert all(len(own) == sum(b - a + 1 for a, b in spans[h]) for h, own in enumerate(sent))  # no row twice in a turn
    wanted = [{int(first[g] + t) for g in range(40) if needed[g, h] and asked[g] for t in range(int(number[g]))} for h in range(40)]
    assert sent == wanted
    assert sum(map(len, sent)) < 0.5 * 40 * len(load)


@pytest.mark.parametrize("hot", [False, True])
def test_exact_search_in_turns_of_clustered_rows(spark, hot):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(10, 6)) * 5
    x = centres[rng.integers(0, 10, 900)] + rng.normal(size=(900, 6)) * 0.2
    if hot:
        x[:300] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asks = lambda v: v % 3 == 0
    assert answers(topk.search(df, F.col("vec_id") % 3 == 0, k=9, block=50)) == best(np.floor(64 * x), np.arange(900), 9, asks)
    assert topk.search(df, F.col("vec_id") < 0, k=9, block=50).count() == 0  # nothing asked


def windows_removed(rows, width):
    seen, out = set(), {}
    for i, text, _ in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for s in range(len(words) - width + 1):
            key = tuple(words[s : s + width])
            if key in seen:
                gone[s : s + width] = [True] * width
            seen.add(key)
        out[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


@pytest.mark.parametrize("sizes", [{}, {"window": 6, "frequent": 3, "group_rows": 50}])
def test_substrings(docs, rows, empty, sizes):
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.remove_repeats(docs, **sizes).collect()}
    assert got == windows_removed(rows, sizes.get("window", 20))
    assert sum(r[1] for r in got.values()) > 100
    assert substring_dedup.remove_repeats(empty).count() == 0


def near_classes(rows, width, percent):
    sets = {}
    for i, text, _ in rows:
        w = WORD.findall(lower(text or ""))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("sizes", [{}, {"width": 3, "percent": 90}, {"width": 3, "percent": 90, "by_parts": True}, {"width": 2, "percent": 90, "by_parts": True, "block": 8}, {"width": 3, "percent": 70, "block": 8}, {"width": 2, "percent": 40}])
def test_near_duplicates(spark, rows, empty, sizes):
    rng = random.Random(9)
    base = [f"g{rng.randint(0, 200)}" for _ in range(80)]
    more = []
    for i in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(80)] = f"e{rng.randint(0, 9)}"
        more.append((1000 + i, " ".join(own), ""))
    every = rows + more
    df = spark.createDataFrame(every, SCHEMA).repartition(2)
    got = {r["doc_id"]: tuple(r)[1:] for r in jaccard.near_duplicates(df, **sizes).collect()}
    assert got == near_classes(every, sizes.get("width", 5), sizes.get("percent", 80))
    assert jaccard.near_duplicates(empty).count() == 0


def test_blocks_bound_a_home_of_own_edits(spark, monkeypatch):
    """3,000 texts, each an own edit of one text: at 0.8 most link to the original at best, some with each other."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(70)]
    rows = [(0, " ".join(base), "")]
    for i in range(1, 3001):
        own = list(base)
        if i % 10 == 0 and i > 10:  # near another edit, too far from the original
            own = rows[i - 7][1].split(" ")
            own[rng.randrange(70)] = f"y{i}"
        for place in rng.sample(range(0, 70, 6), 1 + i % 4):
            own[place] = f"x{i}-{place}"
        rows.append((i, " ".join(own), ""))
    sets = [sorted({tuple(w[k : k + 5]) for k in range(66)}) for w in (r[1].split(" ") for r in rows)]
    code: dict = {}
    held = [np.array([code.setdefault(g, len(code)) for g in x]) for x in sets]
    lists: list = [[] for _ in code]
    for i, x in enumerate(held):
        for g in x.tolist():
            lists[g].append(i)
    lists = [np.array(x) for x in lists]
    size = np.array([len(x) for x in held])
    least = np.arange(len(rows))
    links = []
    for i, x in enumerate(held):
        shared = np.bincount(np.concatenate([lists[g] for g in x.tolist()]), minlength=len(rows))
        links.append(np.flatnonzero(100 * shared >= 80 * (size[i] + size - shared)))
    while True:
        lower = np.array([least[x].min() for x in links])
        if (lower == least).all():
            break
        least = lower
    largest = []
    grouped = jaccard._grouped

    def counted(members, groups):
        n = members.where("large").groupBy("leader", "unit").count().agg({"count": "max"}).first()[0]
        largest.append(n or 0)
        return grouped(members, groups)

    monkeypatch.setattr(jaccard, "_grouped", counted)
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(df, block=200).collect()}
    assert got == dict(enumerate(least.tolist()))
    assert 100 < len(set(got.values())) < 2900
    assert len(largest) == 4 and 100 < max(largest) <= 400


def test_sketches_never_overstate_a_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 62, 300, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(1, 300)], rng.integers(0, 1 << 62, 40, dtype=np.uint64)]))
        x, y = jaccard.sketch_of(a), jaccard.sketch_of(b)
        buckets = min(len(x), len(y))
        assert (jaccard._folded(x, buckets) != jaccard._folded(y, buckets)).sum() <= len(np.setxor1d(a, b))


def test_linked_sets_share_a_list_of_parts():
    rng = np.random.default_rng(4)
    met = 0
    for turn in range(120):
        n = int(rng.integers(1, 40 if turn % 2 else 600))
        base = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        sets = [base]
        for _ in range(5):
            gone, more = rng.integers(0, n // 9 + 1, 2)
            sets.append(np.union1d(rng.permutation(base)[gone:], rng.integers(0, 1 << 62, more, dtype=np.uint64)))
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        lists, owner, small = jaccard.part_lists(np.concatenate(sets), bounds, 90)
        for i in range(len(sets)):
            for j in range(i):
                shared = len(np.intersect1d(sets[i], sets[j]))
                if 100 * shared >= 90 * (len(sets[i]) + len(sets[j]) - shared) > 0:
                    met += 1
                    less = i if len(sets[i]) <= len(sets[j]) else j
                    assert set(lists[owner == i]) & set(lists[owner == j]) & set(lists[(owner == less) & small])
    assert met > 100


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (2, 1), (5, 5), (9, 8), (8, 7), (None, 4), (30, 9)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7), (30, 7)}
    assert components(edges.where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 5, 30, 41])
def test_multi_index_gives_all_of_few_rows(spark, n):
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 6)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = answers(ann.search(df, F.col("vec_id") % 20 == 0))
    assert all(len(w) == min(20, n - 1) for w in found.values()) and (n == 1 or set(found) == set(range(0, n, 20)))
    if n <= 21:
        assert found == {} if n == 1 else found == best(x.astype(np.float64), np.arange(n), 20, lambda v: v % 20 == 0)


def test_multi_index_with_many_copies(spark):
    """A third of the rows is one vector: copies are answers by identifier, and other queries keep their recall."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((900, 16)).astype(np.float32)
    x[rng.permutation(900)[:300]] = x[7] * 2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    wanted = best(x.astype(np.float64), np.arange(900), 20, lambda v: v % 20 == 0)
    assert answers(ann.search(df, F.col("vec_id") % 20 == 0, visit=1.0)) == wanted
    found = answers(ann.search(df, F.col("vec_id") % 20 == 0))
    assert set(found) == set(wanted) and all(len(w) == 20 for w in found.values())
    assert np.mean([len(set(found[q]) & set(w)) / 20 for q, w in wanted.items()]) >= 0.9


def test_quality_of_repeated_ratings_and_without_the_top_grade(spark):
    texts = [(i, f"plain words {i} here" if i % 2 else f"%%% nasty {i} !!", 1 if i % 2 else 0) for i in range(200)]
    df = spark.createDataFrame([t[:2] for t in texts] + [texts[0][:2]] * 50 + [(1, None)], "doc_id long, text string")
    rated = spark.createDataFrame([(i, g) for i, _, g in texts], "doc_id long, grade int")
    lowest = quality.fit(df, rated, "grade", top=2)
    assert len(lowest.thresholds) == 2 and not any(r["keep"] for r in quality.grade_texts(df, lowest).collect())
    once = quality.fit(df.where("text IS NOT NULL").distinct(), rated, "grade", top=2)
    assert np.array_equal(once.weights, lowest.weights) and np.array_equal(once.thresholds, lowest.thresholds)


def test_quality(spark):
    rng = random.Random(3)
    rows, ratings = [], []
    for i in range(600):
        text, grade = " ".join(f"w{rng.randint(0, 300)}" for _ in range(rng.randint(5, 60))), 2
        if i % 6 == 0:
            text, grade = text + f" vile{rng.choice('abcd')} nastyx", 0
        elif i % 6 == 1:
            text, grade = text.replace(" ", "%%% "), 1
        rows.append((i, text, "k"))
        ratings.append((i, grade))
    rows += [(9000, None, ""), (9001, "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep string")
    rated = spark.createDataFrame([r for r in ratings if r[0] < 400] + [(5, 2), (None, 1), (8, None)], "doc_id long, grade int")
    model = quality.fit(df, rated, "grade")
    assert np.all(np.diff(model.thresholds) > 0)
    got = {r["doc_id"]: r for r in quality.grade_texts(df, model).collect()}
    assert len(got) == len(rows) and all(0 <= r["tail_probability"] <= 1 for r in got.values())
    held = [(g, got[i]["keep"]) for i, g in ratings if i >= 400]
    assert np.mean([k == (g == 2) for g, k in held]) > 0.97
    mean = {g: np.mean([got[i]["expected_grade"] for i, x in ratings if x == g]) for g in range(3)}
    assert mean[0] < mean[1] < mean[2]
    nothing = quality.fit(df, rated.where("false"), "grade")
    assert all(r["keep"] for r in quality.grade_texts(df, nothing).collect())
    assert quality.grade_texts(df.where("false"), model).count() == 0


def test_byte_bpe(docs, rows, empty):
    import tiktoken

    with open(BPE_FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.round_trip(docs, BPE_FILE, public_tokenizers.PATTERN).collect()}
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        assert got[i] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    coded = bpe.encode(docs, BPE_FILE, public_tokenizers.PATTERN)
    back = {r["doc_id"]: r["data"].decode() for r in bpe.decode(coded, BPE_FILE, public_tokenizers.PATTERN).collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    own, rng = bpe.codec(BPE_FILE, public_tokenizers.PATTERN), random.Random(1)
    parts = [" ", "  ", "\n", "\x1c", "\x85", "\xa0", "a", "the", "É", "12", "'s", "'ll", "!", "\r\n", "́", "😀", "x" * 40]
    odd = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(2000)]
    assert [x.tolist() for x in bpe.encode_texts(pa.array(odd), own)] == [library.encode_ordinary(t) for t in odd]
    assert all(own.whole.get(k) == v for k, v in list(ranks.items())[::97]) and own.whole.get(b"\x00\x00\x00no") is None
    assert bpe.round_trip(empty, BPE_FILE, public_tokenizers.PATTERN).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><div id="header"><a href="/">Home</a></div>
<nav><ul><li><a href="/a">A</a></ul></nav><div class="sidebar box"><p>Beside the point, though it is rather long for that.</div>
%s<form><p>Your mail<input></form><div class="comments"><p>A reader says many words here, as long as the article itself or so.</div>
<footer>&copy; all</footer><script>var a = "<p>no</p>";</script></body></html>"""
BODY = """<h1>Head &amp; shoulders</h1><p><b>First paragraph, with <a href="x">a link</a> and enough text to read.<br><p>Second   one
over two lines &mdash; done.<ul><li>one<li>two</ul><p>Third, short.</p>"""
TEXT = "Head & shoulders\n\nFirst paragraph, with a link and enough text to read.\n\nSecond one over two lines — done.\n\none\n\ntwo\n\nThird, short."


@pytest.mark.parametrize("shell", ["<article>%s</article>", "<div class=story>%s</div>", "<main><div>%s</div></main>", "<div><section>%s</section></div>"])
def test_main_text(shell):
    assert html_text.main_text(PAGE % (shell % BODY)) == TEXT


@pytest.mark.parametrize("name", ["class='has-sidebar'", "class='content-sidebar-wrap'", "class=no-sidebar", "class='page search'", "id=widget"])
def test_class_words_never_cut_the_text(name):
    assert html_text.main_text(PAGE % (f"<div {name}><article>{BODY * 3}</article></div>")) == "\n\n".join([TEXT] * 3)
    inner = "<section id='related-work'><h2>Related work</h2><p>Others wrote about it before, at some length.</p></section>"
    got = html_text.main_text(PAGE % f"<article>{BODY}{inner}<div class='ad big'><p>Buy this thing now, it is cheap.</p></div></article>")
    assert got == TEXT + "\n\nRelated work\n\nOthers wrote about it before, at some length."


def _paragraphs(*sizes):
    return "".join("<p>" + " ".join(f"w{size}x{i}" for i in range(size)) + "</p>" for size in sizes)


@pytest.mark.parametrize("body", [
    "<main><article>" + _paragraphs(60, 61, 62, 63) + "</article><article>" + _paragraphs(40) + "</article><article>" + _paragraphs(15) + "</article></main>",
    "<main>" + _paragraphs(30, 31) + "<article class=quote>" + _paragraphs(80, 81, 82, 83) + "</article>" + _paragraphs(33) + "</main>",
    "<article><section>" + _paragraphs(90, 91, 92) + "</section><section><h2>t</h2>" + _paragraphs(10) + "</section></article>",
    "<article>" + _paragraphs(90, 91, 92) + "</article><div>" + _paragraphs(93, 94, 95) + "</div>",
])
def test_text_in_several_elements(body):
    links = "<div><a href=1>link one</a> <a href=2>link two</a> <a href=3>more links</a></div>"
    got = html_text.main_text(PAGE % (body + links)).split()
    assert set(re.findall(r"w\d+x\d+", body)) <= set(got) and "link" not in got
    inside = body.replace("</p><article", "</p>" + links + "<article")
    assert "link" not in html_text.main_text(PAGE % inside).split()


def test_main_text_of_odd_pages(spark):
    pages = [None, "", "plain &lt;text&gt;", "<p>one<p>two", "<" * 500, "<a " + '"' * 400, "<div>" * 3000 + "deep", "<!-- open", "<script>x", PAGE % ""]
    assert [html_text.main_text(p) for p in pages[:4]] == ["", "", "plain <text>", "one\n\ntwo"]
    assert html_text.main_text(pages[6]) == "deep" and html_text.main_text(pages[8]) == ""
    df = spark.createDataFrame([(i, p, "mine") for i, p in enumerate(pages)], "page_id long, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract(df.where("false")).count() == 0
