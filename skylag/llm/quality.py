"""Ordinal cumulative-link regression on graded ratings.

P(grade >= k) = logistic(score - threshold_k) with ordered thresholds and one
score for all grades: hashed words of the text, present or not, plus a few
measures of its form. The expected grade and the probability of the top grade
follow from it; the latter selects.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import NARROW_SLICE, Words, hashes, ranges, sliced, words_of

BUCKETS = 1 << 40
PREFIXES = (4, 5)  # beginnings of words, as features of their own
LEAST_TEXTS = 3  # of the sample that a word must stand in to get a weight
TELLING = 4.0  # standard errors by which its grades must differ from those of all texts
MAX_TRAIN = 6_000
STEPS = 400
DECAY = 2e-4
KEEP = 0.5
FORM = 8


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word buckets of all texts, their bounds, and the measures of form."""
    words: Words = words_of(texts)
    plain = pc.replace_substring_regex(pc.utf8_lower(words.vocab), r"^[^\pL\pN]+|[^\pL\pN]+$", "")
    parts = [hashes(plain), *[hashes(pc.utf8_slice_codeunits(plain, 0, k), k) for k in PREFIXES]]
    buckets, place = np.unique((np.stack(parts) % np.uint64(BUCKETS)).astype(np.int64), return_inverse=True)
    place = place.reshape(len(parts), -1)
    n, owner = len(words.counts), words.owner
    own = np.unique(owner * (len(words.vocab) + 1) + words.codes)
    text, word = own // (len(words.vocab) + 1), own % (len(words.vocab) + 1)
    pairs = np.unique((text * (len(buckets) + 1) + place[:, word]).ravel())
    bounds = np.searchsorted(pairs, np.arange(n + 1) * (len(buckets) + 1))

    def per_text(of_word: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=of_word[words.codes], minlength=n)

    def measure(pattern: str) -> np.ndarray:
        return pc.count_substring_regex(words.vocab, pattern).to_numpy(zero_copy_only=False).astype(float)

    length = pc.utf8_length(words.vocab).to_numpy(zero_copy_only=False).astype(float)
    chars, count = np.maximum(per_text(length), 1), np.maximum(words.counts, 1)
    distinct = np.bincount(text, minlength=n)
    form = np.stack(
        [
            np.minimum(per_text(measure(r"\p{Lu}")) / chars * 5, 2),
            np.minimum(np.sqrt(per_text(measure(r"[^\pL\pN.,;:'\-]")) / chars) * 5, 3),
            np.minimum(per_text(measure(r"\pN")) / chars * 5, 2),
            (count - distinct) / (count + 20) * 3,
            np.sqrt(np.maximum((count - distinct) / count - 0.4, 0)) * 3,
            per_text((measure(r"[^\pL\pN.,;:'\-]") > 0).astype(float)) / count * 3,
            np.minimum(np.abs(per_text(length) / count - 5) / 5, 2),
            (words.counts == 0).astype(float),
        ],
        axis=1,
    )
    return buckets[pairs % (len(buckets) + 1)], bounds, form


@dataclass
class OrdinalModel:
    """Weights of the kept buckets (ascending), weights of the measures, and thresholds."""

    buckets: np.ndarray
    weights: np.ndarray
    form: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: pa.Array) -> np.ndarray:
        """P(grade >= k) for k = 1 .. top, one row per text."""
        bucket, bounds, form = features(texts)
        at = np.minimum(np.searchsorted(self.buckets, bucket), max(len(self.buckets) - 1, 0))
        known = self.buckets[at] == bucket if len(self.buckets) else np.zeros(len(bucket), bool)
        sums = np.concatenate([[0.0], np.cumsum(np.where(known, self.weights[at] if len(self.buckets) else 0.0, 0.0))])
        score = sums[bounds[1:]] - sums[bounds[:-1]] + form @ self.form
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def _fit(bucket: np.ndarray, bounds: np.ndarray, form: np.ndarray, grade: np.ndarray, top: int) -> OrdinalModel:
    """Penalised maximum likelihood by Adam over the whole sample."""
    owner = np.repeat(np.arange(len(grade)), np.diff(bounds))
    kept, bucket, times = np.unique(bucket, return_inverse=True, return_counts=True)
    share = np.bincount(grade, minlength=top + 1) / max(len(grade), 1)
    common = np.zeros(len(kept), bool)
    for k in range(top + 1):
        seen = np.bincount(bucket[grade[owner] == k], minlength=len(kept))
        common |= (times >= LEAST_TEXTS) & (np.abs(seen - times * share[k]) >= TELLING * np.sqrt(times * share[k] * (1 - share[k]) + 1e-9))
    keep = common[bucket]
    kept, bucket, owner = kept[common], (np.cumsum(common) - 1)[bucket[keep]], owner[keep]
    weights, shape = np.zeros(len(kept)), np.zeros(FORM)
    steps = np.concatenate([[-1.0], np.zeros(top - 1)])  # first threshold, then logs of the gaps
    params = [weights, shape, steps]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n = max(len(grade), 1)
    for t in range(1, STEPS + 1):
        thresholds = np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))
        score = np.bincount(owner, weights=weights[bucket], minlength=len(grade)) + form @ shape
        low = np.concatenate([[-np.inf], thresholds])[grade]
        high = np.concatenate([thresholds, [np.inf]])[grade]
        s_low, s_high = (1 / (1 + np.exp(np.clip(x - score, -60, 60))) for x in (low, high))
        s_low = np.where(np.isinf(low), 1.0, s_low)
        s_high = np.where(np.isinf(high), 0.0, s_high)
        mass = np.maximum(s_low - s_high, 1e-9)
        d_low, d_high = s_low * (1 - s_low) / mass, s_high * (1 - s_high) / mass
        slope = (d_low - d_high) / n
        d_threshold = np.array([(d_high[grade == k].sum() - d_low[grade == k + 1].sum()) / n for k in range(top)])
        tail = np.cumsum(d_threshold[::-1])[::-1]
        gradients = [
            np.bincount(bucket, weights=slope[owner], minlength=len(kept)) - DECAY * weights,
            form.T @ slope,
            np.concatenate([tail[:1], tail[1:] * np.exp(steps[1:])]),
        ]
        for p, g, a, b in zip(params, gradients, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p += 0.05 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)
    return OrdinalModel(kept, weights, shape, np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])])))


def fit(docs: DataFrame, ratings: DataFrame, grade: str, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN, top: int = 1) -> OrdinalModel:
    """Fit on at most ``max_train`` rated texts, those whose identifiers hash lowest.

    ``grade`` is a SQL expression over ``ratings`` giving whole numbers 0 ..
    ``top``, or more if larger ones are met; a top grade that no rating has is given to no text.
    Of the texts of one identifier the greatest counts, of its ratings the least. Ratings without a grade or a text are left out. Without any rated
    text nothing is learnt and every text is kept.
    """
    rated = ratings.select(F.col(f"`{id_col}`").alias("rated"), F.expr(grade).cast("int").alias("grade")).dropna()
    chosen = rated.groupBy("rated").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("rated"), "rated").limit(max_train)
    # the sample's size has a fixed bound, so it may be broadcast
    sample = docs.join(F.broadcast(chosen), F.col(f"`{id_col}`") == F.col("rated"))
    sample = sample.groupBy("rated").agg(F.max(F.col(f"`{text_col}`")).alias("text"), F.min("grade").alias("grade")).select("text", "grade").dropna()

    def run(batches):
        for part in sliced(batches, limit=NARROW_SLICE):
            bucket, bounds, form = features(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(bucket))
            shape = pa.ListArray.from_arrays(pa.array(np.arange(0, form.size + 1, FORM, dtype=np.int32)), pa.array(form.ravel()))
            yield pa.RecordBatch.from_arrays([lists, shape, part.column("grade")], names=["bucket", "form", "grade"])

    table = sample.mapInArrow(run, "bucket array<long>, form array<double>, grade int").toArrow()
    grades = table.column("grade").to_numpy().astype(np.int64)
    if not len(grades):
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), np.zeros(FORM), np.array([-1.0]))
    lists = table.column("bucket").combine_chunks()
    bucket = lists.flatten().to_numpy().astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    form = table.column("form").combine_chunks().flatten().to_numpy().reshape(-1, FORM)
    # a fixed order whatever the order of arrival
    order = np.lexsort((form[:, 3], form[:, 5], grades, np.diff(bounds)))
    starts, sizes = bounds[:-1][order], np.diff(bounds)[order]
    bucket = bucket[ranges(starts, sizes)]
    top = max(top, int(grades.max()))
    return _fit(bucket, np.concatenate([[0], np.cumsum(sizes)]), form[order], grades[order], top)


def grade_texts(df: DataFrame, model: OrdinalModel, text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """All columns, then expected_grade, tail_probability (of the top grade) and keep (it is at least ``keep``).

    A null text is graded as an empty one. Own columns of these names are replaced.
    """
    added = ("expected_grade", "tail_probability", "keep")
    kept = [c for c in df.columns if c not in added]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    shared = df.sparkSession.sparkContext.broadcast(model)
    place = kept.index(text_col)

    def run(batches):
        for part in sliced(batches, text_col, NARROW_SLICE):
            tails = shared.value.tails(part.column(place).fill_null(""))
            columns = [*part.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= keep)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    return rows.mapInArrow(run, kinds + ", expected_grade double, tail_probability double, keep boolean")
