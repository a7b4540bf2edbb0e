"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). A word's
class hangs on its ending. Both softmaxes have hashed features of the history:
the word before (bigram), the one before that (skip), and both (trigram), plus
a bias. Within its class a word has the logit log(count + 1), the best weight of
its own bias, plus the weights of its slot under each feature joined with the
class. The ``OWN`` most frequent words of a class have slots of their own, all
others share the rest by their beginnings; as the words of a slot differ by
their counts alone, the softmax over all words of a class is summed by slots.

The weights are trained by distributed gradient updates: every task runs
minibatch updates from the shared weights over its own rows, and the new
weights are the means of the tasks' weights, each weighted by how often the
task met the feature. Texts are scored in sparse numpy batches.

Word counts are exact. The most frequent words, at most ``HEAD`` of them, are
broadcast; the counts of all others are joined to the words that need them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .arrow import hashes, mixed, sliced, words_of

CLASSES = 16
WORDS = CLASSES  # word slots of a class: the weights of both softmaxes are one table
OWN = 8  # of them for one frequent word each
HEAD = 1 << 20
SLOTS = 1 << 13
ROUNDS = 2
RATE = 0.3
WORD_RATE = 0.1
BATCH = 1 << 15
_END = np.uint64(0x5EED5EED5EED5EED)
_FEATURES = 3


def _tokens(texts: pa.Array):
    """Hash and spelled cell (class * WORDS + slot) of every token, the end of each text included, and the bounds of the texts."""
    words = words_of(texts, lower=True)
    vocab = hashes(words.vocab)
    endings = pc.utf8_slice_codeunits(words.vocab, -2, None).dictionary_encode()
    starts = pc.utf8_slice_codeunits(words.vocab, 0, 2).dictionary_encode()
    classes = (1 + hashes(endings.dictionary) % np.uint64(CLASSES - 1)).astype(np.int16)[endings.indices.to_numpy(zero_copy_only=False)]
    slots = (OWN + hashes(starts.dictionary, 1) % np.uint64(WORDS - OWN)).astype(np.int16)[starts.indices.to_numpy(zero_copy_only=False)]
    vocab, cells = np.append(vocab, _END), np.append(classes * np.int16(WORDS) + slots, np.int16(0))
    n, total = len(words.counts), len(words.codes) + len(words.counts)
    bounds = words.offsets + np.arange(n + 1)
    codes = np.full(total, len(vocab) - 1, np.int64)
    inside = np.ones(total, bool)
    inside[bounds[1:] - 1] = False
    codes[inside] = words.codes
    return codes, vocab, cells, bounds


def _lookup(keys: np.ndarray, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each word in the sorted ``keys``, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, vocab), max(len(keys) - 1, 0))
    return at, keys[at] == vocab if len(keys) else np.zeros(len(vocab), bool)


def _placed(vocab: np.ndarray, cells: np.ndarray, own: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Class and slot of each word; ``own`` holds the words with slots of their own, sorted, and their cells."""
    at, found = _lookup(own[0], vocab)
    cells = cells.astype(np.int64)
    cells[found] = own[1][at[found]]
    return cells // WORDS, cells % WORDS


def _histories(codes: np.ndarray, vocab: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows of the weight table for the features of every token's history."""
    one, two = (np.append(mixed(vocab ^ np.uint64(s)), np.uint64(s)) for s in (0x1111, 0x2222))
    before = np.full(len(codes), len(vocab), np.int64)
    before[1:] = codes[:-1]
    before[bounds[:-1]] = len(vocab)
    skip = np.full(len(codes), len(vocab), np.int64)
    skip[1:] = before[:-1]
    skip[bounds[:-1]] = len(vocab)
    slots = np.uint64(SLOTS)
    out = np.empty((_FEATURES, len(codes)), np.int64)
    out[0] = (one % slots).astype(np.int64)[before]
    out[1] = (two % slots).astype(np.int64)[skip] + SLOTS
    out[2] = (mixed(one[before] + two[skip] * np.uint64(3)) % slots).astype(np.int64) + 2 * SLOTS
    return out


def _within(rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Rows of the word weights: the same features, each joined with the class."""
    out = (mixed(rows.astype(np.uint64) * np.uint64(CLASSES) + classes.astype(np.uint64)) % np.uint64(SLOTS)).astype(np.int64)
    out += np.arange(_FEATURES)[:, None] * SLOTS
    return out


def _logits(weights: np.ndarray, rows: np.ndarray, base: np.ndarray | None = None) -> np.ndarray:
    out = weights[rows[0]]
    for k in range(1, _FEATURES):
        out += weights[rows[k]]
    out += weights[-1]
    if base is not None:
        out += base
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _log10(weights: np.ndarray, rows: np.ndarray, target: np.ndarray, base: np.ndarray | None = None) -> np.ndarray:
    """Log10 probability of each target under the softmax of its row."""
    logits = _logits(weights, rows, base)
    top = logits.max(axis=1)
    own = logits[np.arange(len(logits)), target]
    return (own - top - np.log(np.exp(logits - top[:, None]).sum(axis=1))) / np.log(10)


def _update(
    weights: np.ndarray, squares: np.ndarray, met: np.ndarray, rows: np.ndarray, target: np.ndarray,
    rate: float = RATE, base: np.ndarray | None = None,
) -> None:
    """One minibatch step of the log likelihood, in place."""
    gradient = _softmax(_logits(weights, rows, base))
    np.negative(gradient, out=gradient)
    gradient[np.arange(len(target)), target] += 1
    flat = rows.ravel()
    order = np.argsort(flat.astype(np.int16 if weights.shape[0] < 1 << 15 else np.int32), kind="stable")
    ordered = flat[order]
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    touched = ordered[heads]
    sums = np.add.reduceat(gradient[order % len(target)], heads, axis=0)
    met[touched] += np.diff(np.append(heads, len(ordered)))
    touched, sums = np.append(touched, len(weights) - 1), np.vstack([sums, gradient.sum(axis=0)])
    met[-1] += len(target)
    squares[touched] += sums * sums
    weights[touched] += rate * sums / np.sqrt(squares[touched] + 1e-6)


def _counts(training: DataFrame) -> DataFrame:
    def run(batches):
        for part in sliced(batches):
            codes, vocab, cells, _ = _tokens(part.column("text"))
            n = np.bincount(codes, minlength=len(vocab))
            yield pa.RecordBatch.from_arrays(
                [pa.array(vocab.view(np.int64)), pa.array(cells.astype(np.int32)), pa.array(n)], names=["h", "cell", "n"]
            )

    rows = training.select("text").mapInArrow(run, "h long, cell int, n long").where("n > 0")
    return rows.groupBy("h").agg(F.first("cell").alias("cell"), F.sum("n").alias("n"))


def _masses(counts: DataFrame) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Add-one count of every cell, and the words with slots of their own with their cells.

    A shared cell holds its known words and one unknown word, an own cell its
    word alone. The end of a text is all of class 0.
    """
    mass = np.zeros((CLASSES, WORDS))
    mass[1:, OWN:] = 1
    for r in counts.groupBy("cell").agg((F.sum("n") + F.count(F.lit(1))).alias("mass")).collect():
        mass[divmod(r["cell"], WORDS)] += r["mass"]
    mass[0, 0] = max(mass[0, 0], 1)
    top = Window.partitionBy(F.expr(f"cell div {WORDS}")).orderBy(F.desc("n"), "h")
    ranked = counts.where(f"cell >= {WORDS}").withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= OWN)
    words, cells = [], []
    for r in ranked.collect():
        kind, slot = divmod(r["cell"], WORDS)
        mass[kind, slot] -= r["n"] + 1
        mass[kind, r["rank"] - 1] = r["n"] + 1
        words.append(r["h"])
        cells.append(kind * WORDS + r["rank"] - 1)
    words, cells = np.array(words, np.int64).view(np.uint64), np.array(cells, np.int64)
    order = np.argsort(words)
    return mass, (words[order], cells[order])


def _base(mass: np.ndarray) -> np.ndarray:
    """Logits of the slots without weights; a slot without words has none."""
    return np.log(mass, out=np.full(mass.shape, -np.inf), where=mass > 0).astype(np.float32)


def train(texts: DataFrame, mass: np.ndarray, own_words: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the class softmax and of the word softmax within a class.

    ``texts`` has row (any whole number) and text; each round takes its share of the rows.
    """
    weights = np.zeros((2, _FEATURES * SLOTS + 1, CLASSES), np.float32)
    base = _base(mass)
    context = texts.sparkSession.sparkContext
    names = [f"w{c}" for c in range(CLASSES)]
    for turn in range(rounds):
        shared = context.broadcast(weights)

        def run(batches, shared=shared):
            own = shared.value.copy()
            squares, met = np.zeros_like(own), np.zeros(own.shape[:2], np.int64)
            for part in sliced(batches):
                codes, vocab, cells, bounds = _tokens(part.column("text"))
                rows, (classes, slots) = _histories(codes, vocab, bounds), _placed(vocab, cells, own_words)
                for at in range(0, len(codes), BATCH):
                    some, now = codes[at : at + BATCH], rows[:, at : at + BATCH]
                    kind = classes[some]
                    _update(own[0], squares[0], met[0], now, kind)
                    _update(own[1], squares[1], met[1], _within(now, kind), slots[some], WORD_RATE, base[kind])
            met = met.ravel()
            hit = np.flatnonzero(met)
            moved = own.reshape(-1, CLASSES)[hit] * met[hit, None].astype(np.float32)
            columns = [pa.array(hit), pa.array(met[hit]), *[pa.array(moved[:, c]) for c in range(CLASSES)]]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "met", *names])

        share = texts.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == turn).select("text")
        kinds = "row long, met long, " + ", ".join(f"{n} float" for n in names)
        means = share.mapInArrow(run, kinds).groupBy("row").agg(F.sum("met").alias("met"), *[F.sum(n).alias(n) for n in names])
        table = means.toArrow()
        row, met = table.column("row").to_numpy(), table.column("met").to_numpy()
        weights = weights.copy()
        for c, name in enumerate(names):
            weights.reshape(-1, CLASSES)[row, c] = table.column(name).to_numpy() / met
        shared.unpersist()
    return weights


def score_texts(
    df: DataFrame, training: str, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, rounds: int = ROUNDS
) -> DataFrame:
    """Log10 probability of every text under a model learnt from the rows where the SQL condition ``training`` holds.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (the
    add-one unigram model) and score. A null text is empty: its end alone is
    scored. Rows that share an identifier are one document, their texts scored
    one by one and summed. A null ``training`` counts as held out. Without
    training rows every token is unknown. The model is a proper distribution
    over the known words and one unknown word for each shared slot of a class.
    """
    texts = df.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.coalesce(~F.expr(training), F.lit(True)).alias("held_out"),
    )
    learning = texts.where("NOT held_out")
    counts = materialise(_counts(learning), "word-counts")
    n_all, v_all = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    mass, own_words = _masses(counts)
    weights = train(learning.select(F.xxhash64("doc_id").alias("row"), "text"), mass, own_words, rounds)

    # frequent words: a power of two as the least count, so that at most ``head`` of them are broadcast
    levels = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).count().orderBy(F.desc("level")).collect()
    least, kept = 1 << 62, 0
    for level, number in levels:
        if kept + number > head:
            break
        least, kept = 1 << level, kept + number
    frequent = counts.where(F.col("n") >= least).select("h", "n").toArrow()
    known, times = frequent.column("h").to_numpy().view(np.uint64), frequent.column("n").to_numpy()
    order = np.argsort(known)
    context = df.sparkSession.sparkContext
    shared = context.broadcast((known[order], times[order], weights))
    base = _base(mass)

    def run(batches):
        known, times, weights = shared.value
        logs = np.log10(times + 1.0)
        for part in sliced(batches):
            codes, vocab, cells, bounds = _tokens(part.column("text"))
            rows, (classes, slots) = _histories(codes, vocab, bounds), _placed(vocab, cells, own_words)
            share = np.log10(mass[classes, slots])
            value = np.empty(len(codes))
            for at in range(0, len(codes), BATCH):
                some, now = codes[at : at + BATCH], rows[:, at : at + BATCH]
                kind = classes[some]
                value[at : at + BATCH] = _log10(weights[0], now, kind)
                value[at : at + BATCH] += _log10(weights[1], _within(now, kind), slots[some], base[kind]) - share[some]
            at, found = _lookup(known, vocab)
            log_of = np.where(found, logs[at] if len(known) else 0.0, 0.0)
            first = bounds[:-1]
            ids, held = part.column("doc_id"), part.column("held_out")
            n = part.num_rows
            # what the head does not hold is looked up elsewhere: one row for each text and word
            missing = np.flatnonzero(~found[codes])
            owner = np.searchsorted(bounds, missing, "right") - 1
            pair, tf = np.unique(owner * len(vocab) + codes[missing], return_counts=True)
            owner, word = pair // len(vocab), vocab[pair % len(vocab)]
            salt = mixed(np.arange(n, dtype=np.uint64) + vocab[codes[first]] * np.uint64(31)) if n else np.empty(0, np.uint64)
            sums = [np.add.reduceat(x, first) for x in (value, log_of[codes], found[codes].astype(np.int64))]
            m = len(pair)
            place = pa.array(np.concatenate([np.arange(n), owner]))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(place), held.take(place),
                    pa.array(np.concatenate([salt, word]).view(np.int64)),
                    pa.array(np.concatenate([np.zeros(n, np.int32), np.ones(m, np.int32)])),
                    pa.array(np.concatenate([np.diff(bounds), tf])),
                    pa.array(np.concatenate([sums[2], np.zeros(m, np.int64)])),
                    pa.array(np.concatenate([sums[1], np.zeros(m)])),
                    pa.array(np.concatenate([sums[0], np.zeros(m)])),
                ],
                names=["doc_id", "held_out", "h", "rare", "tf", "known", "logs", "model"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = texts.mapInArrow(run, f"doc_id {kind}, held_out boolean, h long, rare int, tf long, known long, logs double, model double")
    rare = counts.where(F.col("n") < least).select("h", F.lit(1).alias("rare"), "n")
    joined = scored.join(rare, ["h", "rare"], "left")
    tokens, extra = F.when(F.col("rare") == 0, F.col("tf")).otherwise(0), F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)
    logs = F.col("logs") + F.when(F.col("n").isNotNull(), F.col("tf") * F.log10(F.col("n") + 1)).otherwise(0.0)
    sums = joined.groupBy("doc_id", "held_out").agg(
        F.sum(tokens).alias("n_tokens"), F.sum(F.col("known") + extra).alias("n_known"), F.sum(logs).alias("logs"), F.sum("model").alias("model")
    )
    return sums.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))).alias("base_score"),
        (F.col("logs") + F.col("model")).alias("score"),
    )
