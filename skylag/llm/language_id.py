"""Language of a text by bit-sliced Bloom filters of character n-grams.

An n-gram belongs to every language in which it is nearly as frequent as in
the language that uses it most. All languages share one array of slots: bit l
of a slot belongs to the filter of language l, so that one look at an n-gram's
slots, joined by AND, gives the mask of all languages that hold it. The bits of
a text's n-grams are counted for each language; what the filter's fill makes
false positives of is taken off the counts, and the largest decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .arrow import mixed, per_text, record_batch, rolling, words_of

SIZES = (1, 2, 3, 4)  # letters of an n-gram
LEAST_SHARE = 1e-5  # of a language's n-grams: so it holds 100,000 distinct ones at most
NEAR_TOP = 0.5  # of the share in the language that uses the n-gram most
HASHES = 4
SLOTS_PER_GRAM = 16
MOST_LANGUAGES = 1024
UNKNOWN = "und"


def letter_words(texts: pa.Array):
    """Words of letters and marks, lower-cased; anything else parts them."""
    return words_of(pc.replace_substring_regex(pc.utf8_lower(texts.fill_null("")), r"[^\p{L}\p{M}]+", " "))


def grams_of(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of every word, blanks around it included, and the word each stands in."""
    words = vocab.to_pylist()
    letters = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), np.fromiter((len(w) + 2 for w in words), np.int64, len(words)))
    hashed, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for n in SIZES:
        gram = rolling(mixed(letters + np.uint64(n << 32)), n)
        inside = owner[: len(gram)] == owner[n - 1 :] if len(gram) else np.empty(0, bool)
        if n == 1:
            inside &= letters != 32
        hashed.append(gram[inside])
        owners.append(owner[: len(gram)][inside])
    return np.concatenate(hashed), np.concatenate(owners)


def _counted(part: pa.RecordBatch) -> pa.RecordBatch:
    """How often each n-gram occurs in each language of a slice."""
    langs = part.column("lang").dictionary_encode()
    words = letter_words(part.column("text"))
    lang = langs.indices.to_numpy(zero_copy_only=False)[words.owner].astype(np.int64)
    grams, owner = grams_of(words.vocab)
    v, kinds = max(1, len(words.vocab)), len(langs.dictionary)
    seen, times = np.unique(lang * v + words.codes, return_counts=True)
    found = []
    for k in range(kinds):
        a, b = np.searchsorted(seen, [k * v, (k + 1) * v])
        weight = np.zeros(v, np.int64)
        weight[seen[a:b] - k * v] = times[a:b]
        per_gram = weight[owner]
        used = per_gram > 0
        own, inverse = np.unique(grams[used], return_inverse=True)
        found.append((own, np.bincount(inverse, per_gram[used], len(own)).astype(np.int64)))
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    sizes = [len(own) for own, _ in found]
    names = langs.dictionary.take(pa.array(np.repeat(np.arange(kinds), sizes)))
    empty = np.empty(0, np.int64)
    own = np.concatenate([*[o.view(np.int64) for o, _ in found], empty])
    return record_batch(schema, names.cast(pa.string()), own, np.concatenate([*[n for _, n in found], empty]))


@dataclass
class Model:
    """Slots of language bits: ``slots[w, i]`` holds those of languages 64 w and on (all in one row if they fit)."""

    langs: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    fallback: int

    def masks(self, grams: np.ndarray) -> np.ndarray:
        out = None
        for k in range(HASHES):
            held = self.slots[:, _slot(grams, k, self.slots.shape[1])]
            out = held if out is None else out & held
        return out


def _slot(grams: np.ndarray, k: int, size: int) -> np.ndarray:
    return (mixed(grams ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1))) & np.uint64(size - 1)).astype(np.int64)


def build(langs: list[str], lang: np.ndarray, grams: np.ndarray, fallback: int) -> Model:
    """Fill the filters; a slot array is a power of two of at least 16 slots for each n-gram of the largest language."""
    largest = int(np.bincount(lang, minlength=1).max(initial=0))
    size = 1 << max(6, (SLOTS_PER_GRAM * largest - 1).bit_length())
    bits = next(b for b in (8, 16, 32, 64) if len(langs) <= b or b == 64)
    slots = np.zeros((-(-max(1, len(langs)) // bits), size), f"uint{bits}")
    fill = np.zeros(len(langs))
    for number in range(len(langs)):
        own = grams[lang == number]
        taken = np.unique(np.concatenate([_slot(own, k, size) for k in range(HASHES)]))
        slots[number // bits, taken] |= slots.dtype.type(1 << (number % bits))
        fill[number] = len(taken) / size
    return Model(langs, slots, fill**HASHES, fallback)


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn the filters from all rows with a text and a language.

    n-grams are counted in all texts by a distributed aggregate. A language
    holds those that make up at least ``LEAST_SHARE`` of its n-grams (so at most
    100,000) and at least ``NEAR_TOP`` of the largest such share. No rows give a
    model without languages. More than ``MOST_LANGUAGES`` are refused: that is
    no column of languages.
    """
    rows = df.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).dropna()
    counted = rows.mapInArrow(per_text(_counted), "lang string, gram bigint, n bigint")
    counted = materialise(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    per_lang = counted.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(per_lang) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    per_lang.sort(key=lambda r: r["lang"])
    langs = [r["lang"] for r in per_lang]
    numbered = df.sparkSession.createDataFrame(
        [(r["lang"], i, r["total"]) for i, r in enumerate(per_lang)], "lang string, number int, total bigint"
    )
    share = F.col("n") / F.col("total")
    shares = counted.join(F.broadcast(numbered), "lang").select("gram", "number", share.alias("share")).where(F.col("share") >= LEAST_SHARE)
    # a list has at most one entry for each language
    held = shares.groupBy("gram").agg(F.collect_list(F.struct("number", "share")).alias("of"), F.max("share").alias("top"))
    members = held.select("gram", F.explode("of").alias("m"), "top").where(F.col("m.share") >= NEAR_TOP * F.col("top"))
    table = members.select("gram", "m.number").toArrow()
    grams = table.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    most = max(range(len(langs)), key=lambda i: (per_lang[i]["total"], -i), default=0)
    return build(langs, table.column("number").to_numpy().astype(np.int64), grams, most)


def classify(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of every text of a slice."""
    words = letter_words(texts)
    grams, owner = grams_of(words.vocab)
    masks = model.masks(grams)
    v, n = len(words.vocab), len(texts)
    bits = masks.dtype.itemsize * 8
    size = np.bincount(words.owner, np.bincount(owner, minlength=v)[words.codes], n)
    counts = np.zeros((n, len(model.langs)))
    for number in range(len(model.langs)):
        hit = masks[number // bits] >> masks.dtype.type(number % bits) & masks.dtype.type(1)
        in_word = np.bincount(owner, hit, v)
        counts[:, number] = np.bincount(words.owner, in_word[words.codes], n)
    rate = model.false_rate
    sure = np.maximum(0.0, (counts - size[:, None] * rate) / np.maximum(1e-12, 1 - rate))
    lettered = pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
    if not model.langs:
        return [UNKNOWN] * n, np.zeros(n)
    total = sure.sum(axis=1)
    best = np.where(total > 0, sure.argmax(axis=1), model.fallback)
    score = np.where(lettered & (total > 0), sure.max(axis=1) / np.maximum(total, 1e-300), 0.0)
    return [model.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())], score


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None) -> DataFrame:
    """Columns doc_id, held_out, lang_pred and score of every row, repeated rows and those without identifier too.

    ``lang_pred`` is a learned language, ties to the alphabetically first; a text none of whose n-grams is
    known gets the language of most n-grams. It is ``und`` for a null text, one without letters, and a
    model without languages. ``score`` is the predicted language's part of all corrected counts, 0 to 1; 0
    where nothing was counted. Only the text is looked at; other columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = classify(part.column("text"), shared.value)
        columns = [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    apart = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), apart.alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(per_text(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
