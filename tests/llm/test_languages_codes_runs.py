"""Language filters, product codes and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skylag.llm import active_lloyd, language_id, periodic_runs
from skylag.llm.queries import CRC, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# periodic runs


def brute_lyndon(s):
    out = []
    for i in range(len(s)):
        words = (s[i:j] for j in range(i + 1, len(s) + 1))
        out.append(max(len(w) for w in words if all(w < w[k:] for k in range(1, len(w)))))
    return out


def brute_runs(words, least=24, power=3):
    out = []
    for q in range(1, len(words) // power + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            whole = j - i + q
            if whole >= max(least, power * q) and not any(a <= i and i + whole <= a + n for a, n, _ in out):
                out.append((i, whole, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def looped(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_lyndon_arrays_of_both_orders():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(1, 25))]
        for ranks in (s, [2 - c for c in s]):
            lengths, groups = periodic_runs.lyndon_groups(np.array([*ranks, -1]))
            assert lengths[:-1].tolist() == brute_lyndon(ranks)
            of_group = defaultdict(set)
            for i, g in enumerate(groups[:-1].tolist()):
                of_group[g].add(tuple(ranks[i : i + lengths[i]]))
            words = [next(iter(w)) for w in of_group.values()]
            assert all(len(w) == 1 for w in of_group.values()) and len(set(words)) == len(words)
    # two stretches in one call do not touch
    lengths, _ = periodic_runs.lyndon_groups(np.array([0, 1, -1, 1, 2, -1]))
    assert lengths.tolist() == [2, 1, 0, 2, 1, 0]


@pytest.mark.parametrize("batch", [1 << 18, 40])
def test_runs_of_random_texts(monkeypatch, batch):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", batch)
    rng, total = random.Random(3), 0
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(0, 4)):
            s = []
            while len(s) < rng.randint(0, 90):
                unit = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 9))]
                s += unit * rng.choice([1, 1, 2, 3, 4, 7]) + unit[: rng.randrange(len(unit) + 1)]
            texts.append(s)
        offsets = np.cumsum([0, *map(len, texts)])
        codes = np.array([c for t in texts for c in t], np.int64)
        for least, power in ((24, 3), (3, 3), (10, 4)):
            wanted = [(a + int(offsets[k]), n, q) for k, t in enumerate(texts) for a, n, q in brute_runs(t, least, power)]
            assert periodic_runs.runs_of(codes, offsets, least, power) == wanted
            total += len(wanted)
    assert total > 1000
    with pytest.raises(ValueError):
        periodic_runs.runs_of(codes, offsets, 24, 2)


def run_rows():
    rng = random.Random(4)
    rows = []
    for i in range(150):
        words = rng.choices(["a", "b", "Éa", "naïve", "x\x85y", "　", *[f"w{k}" for k in range(30)]], k=rng.randint(0, 90))
        if i % 4 == 0:
            unit = words[: rng.randint(1, 6)] or ["z"]
            words[10:10] = unit * rng.randint(2, 14)
        rows.append((i, rng.choice([" ", "\n", " \t\r "]).join(words)))
    rows += [(500, None), (501, ""), (502, " \n\t"), (None, "a " * 40), (None, None), (3, rows[3][1]), (3, rows[3][1])]
    # a text of several MB: random words, then a loop of 40,000 words
    rows.append((901, " ".join(str(rng.randrange(10**6)) for _ in range(400_000)) + " " + " ".join(map(str, [*range(40_000)] * 3))))
    return rows


def test_runs_of_documents(spark):
    rows = run_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, seed int").repartition(3)
    found = periodic_runs.find_runs(docs, seed=F.expr(CRC))
    got = Counter()
    for r in found.collect():
        got[r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["best"] and tuple(r["best"]), sha(r["collapsed"])] += 1
    wanted = Counter()
    for i, text in rows:
        words = looped(i, WORD.findall(text or ""))
        if i == 901:
            assert len(words) > 500_000
            runs = [(400_000, 120_000, 40_000)]
        else:
            runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        gone = {k for a, n, q in runs for k in range(a + q, a + n)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        wanted[i, len(words), tuple(runs), best, sha(kept)] += 1
    assert got == wanted
    assert sum(bool(k[2]) for k in got) > 20
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_runs_query(spark):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = queries()["op13_lyndon_runs"](spark, SMALL).collect()
    assert len(got) == len(rows) and sum(r["n_runs"] for r in got) > 0
    for r in got:
        words = looped(r["doc_id"], WORD.findall(rows[r["doc_id"]] or ""))
        if len(words) > 1500:
            continue
        runs = brute_runs(words)
        gone = {k for a, n, q in runs for k in range(a + q, a + n)}
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert r["n_runs"] == len(runs) and (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (math.floor(1000 * best[1] / best[2]) if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{a},{n},{q}\n" for a, n, q in runs))
        assert r["collapsed_sha256"] == sha(" ".join(w for k, w in enumerate(words) if k not in gone))


# product codes


def plain_lloyd(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(vec_id, label, vector) rows in Python integers; vectors as long as parts allow."""
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows]
    w = len(kept[0][2]) // parts
    cut = [[v[p * w : p * w + w] for p in range(parts)] for _, _, v in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][2]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for c in cut:
                own[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(own[e]) for x in zip(*own[e])] if e in own else b for e, b in enumerate(books[p])]
    out, sums = [], Counter()
    for (i, lab, _), c in zip(kept, cut):
        found = [nearest(x, books[p]) for p, x in enumerate(c)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
        sums[lab] += out[-1][3]
    digest = sha(",".join(str(x) for book in books for entry in book for x in entry))
    return Counter((i, code, error, sums[lab], digest) for i, lab, code, error in out)


def vectors(n, seed=2, size=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    return [(int(i), [None, 0, 1, 2][i % 4], [float(x) for x in np.round(centres[i % 6] + rng.normal(size=size) / 4, 2)]) for i in range(n)]


def compressed(spark, rows, **more):
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, label int, embedding array<double>, code string").repartition(4)
    got = active_lloyd.compress(df, **more)
    return Counter((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got.collect())


def test_lloyd_codes(spark):
    rows = vectors(300)
    rows += [rows[7]] * 40 + [(None, 5, rows[1][2])]  # repeated rows and one without identifier
    odd = [(1000, 1, None), (1001, 1, [None, *rows[0][2][1:]]), (1002, 1, [float("nan"), *rows[0][2][1:]]), (1003, 1, [float("inf")] * 16)]
    odd += [(1004, 1, []), (1005, 1, [1.0] * 8)]
    assert compressed(spark, rows + odd) == plain_lloyd(rows)
    few = vectors(5)
    assert compressed(spark, few) == plain_lloyd(few)
    tied = [(i, 1, [float(i % 3)] * 8) for i in range(60)]
    assert compressed(spark, tied) == plain_lloyd(tied)
    far = [(i, 1, [(-1.0) ** i * 1e4 * (i % 5)] * 16) for i in range(40)]
    assert compressed(spark, far) == plain_lloyd(far)
    assert compressed(spark, odd[:4]) == Counter()
    assert len(compressed(spark, [(i, 1, [float(i)] * 5) for i in range(20)])) == 20  # filled up with zeros
    assert len(compressed(spark, [(i, 1, [1e300, -1e300, float(i)] * 8) for i in range(20)])) == 20


def test_active_entries_spare_distances():
    rng = np.random.default_rng(4)
    points = rng.integers(-50, 50, (500, 2, 3))
    books = rng.integers(-50, 50, (2, 16, 3))
    code, near = np.zeros((500, 2), np.uint8), np.zeros((500, 2), np.int64)
    full = active_lloyd.reassign(points, code, near, books, np.ones((2, 16), bool))
    assert full == 500 * 2 * 16
    for turn in range(30):
        moved = rng.random((2, 16)) < 0.2
        books = np.where(moved[:, :, None], rng.integers(-50, 50, books.shape), books)
        work = active_lloyd.reassign(points, code, near, books, moved)
        distance = ((points[:, :, None, :] - books[None]) ** 2).sum(3)
        assert (code == distance.argmin(2)).all() and (near == distance.min(2)).all()
        assert work < full


# languages


def speak(rng, lang, n):
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "pf"], "cc": ["оро", "ска", "ние", "то"], "": ["日本", "語の", "文字", "です"]}[lang]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def lang_rows(n=200, seed=3):
    rng = random.Random(seed)
    return [(i, speak(rng, lang, rng.randint(2, 30)).upper() + " 12.5!", lang) for i, lang in enumerate(rng.choices(["aa", "bb", "cc", ""], [9, 3, 3, 3], k=n))]


def exact_sets(rows):
    """Members of every language by plain counting of n-grams."""
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            padded = f" {word} "
            for n in language_id.SIZES:
                counts[lang].update(g for k in range(len(padded) - n + 1) if (g := padded[k : k + n]) != " ")
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    top = Counter()
    for lang, c in counts.items():
        for g, k in c.items():
            top[g] = max(top[g], k / totals[lang])
    return {lang: {g for g, k in c.items() if k / totals[lang] >= max(language_id.LEAST_SHARE, 0.5 * top[g])} for lang, c in counts.items()}


def test_filters_hold_the_counted_members(spark):
    rows = lang_rows()
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    sets = exact_sets(rows)
    assert model.langs == sorted(sets)
    every = sorted({g for s in sets.values() for g in s})
    wrong = 0
    for g in every:
        hashed, _ = language_id.grams_of(pa.array([g.strip(" ")]))
        n = len(g)
        value = language_id.rolling(language_id.mixed(np.array([ord(c) for c in g], np.uint64) + np.uint64(n << 32)), n)
        mask = int(model.masks(value)[0][0])
        for k, lang in enumerate(model.langs):
            assert g not in sets[lang] or mask >> k & 1, "a filter forgets nothing"
            wrong += g not in sets[lang] and mask >> k & 1
    assert wrong <= 0.01 * len(every) * len(model.langs) + 2
    assert (model.false_rate < 0.01).all()


def test_languages_of_held_out_texts(spark):
    train, test = lang_rows(300, 5), lang_rows(200, 6)
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "12 ;-) 😀", "aa"), (903, "ωψφ", "aa"), (None, "kalo mitu", None), (5, "kalo", "x"), (5, "kalo", "x")]
    learn = spark.createDataFrame([*train, (901, "schein " * 50, None), (902, None, "dd")], "doc_id long, text string, lang string")
    model = language_id.fit(learn)
    df = spark.createDataFrame([(*r, "s", 9.0) for r in test + odd], "doc_id long, text string, lang string, lang_pred string, score double")
    got = language_id.predict(df, model).collect()
    assert len(got) == len(test) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert [by_id[i] for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "aa", "aa"]
    wanted = {i: lang for i, _, lang in test} | {5: "aa"}
    assert sum(by_id[i] == lang for i, lang in wanted.items()) > 0.99 * len(wanted)
    none = language_id.fit(learn.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(df, none).collect()} == {"und"}
    assert language_id.predict(df.limit(0), model).count() == 0


def test_many_languages_share_the_slots():
    rng = np.random.default_rng(1)
    lang = np.repeat(np.arange(150), 40)
    grams = rng.integers(0, 1 << 63, len(lang)).astype(np.uint64)
    model = language_id.build([f"{i:03}" for i in range(150)], lang, grams, 0)
    masks = model.masks(grams)
    assert masks.shape[0] == 3
    assert all(int(masks[k // 64, i]) >> (int(k) % 64) & 1 for i, k in enumerate(lang))


def test_language_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect()
    got = {r["doc_id"]: r for r in queries()["op11_bitmask_language"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(got[r["doc_id"]]["lang_pred"], r["lang"]) for r in rows if got[r["doc_id"]]["held_out"] and r["lang"]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
