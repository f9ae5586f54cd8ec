"""Toxicity of glosses: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

What a gloss holds of character n-grams is compared between the labels over labelled
glosses: the logarithm of the ratio of the two shares says how much an n-gram speaks for a label
by itself. These ratios scale the features of a logistic regression, whose weights then only
have to say how far each ratio is to be believed, so that few labelled glosses go a long way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lengths of the character n-grams, and the number of slots that their hashes share.
LENGTHS = (3, 4, 5)
BITS = 19
FEATURES = 1 << BITS
#: Added to every count; n-grams in fewer labelled glosses than this have no say.
SMOOTHING = 1.0
LEAST_GLOSSES = 2
#: N-grams that have a say, at most: those whose ratios stand out most from chance.
SELECTED = 1 << 15
#: Labelled glosses of each label whose n-grams are counted, and those that fit the classifier, at most.
COUNTED = 10_000
FITTED = 2000
#: In place of a slot: the numbers of the glosses themselves.
NO_SLOT = -1
#: Weight of the squared size of the classifier's weights, for each fitted gloss, and rounds of its fit.
PENALTY = 3e-4
ROUNDS = 60
#: Characters worked on together.
BATCH_CHARS = 200_000


def ngrams(texts: list[str | None], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed n-grams of each text, text by text, and where each text's begin; only the known ones, if told which.

    Texts are in lower case, with a space for each run of white space and one at both ends.
    """
    plain = [f" {' '.join((t or '').lower().split())} " for t in texts]
    codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) for t in plain])
    owner = np.repeat(np.arange(len(plain), dtype=np.int64) * FEATURES, np.diff(ends, prepend=0))
    found = []
    h = np.full(len(codes), 0x811C9DC5, np.uint32)
    for n in range(1, min(max(LENGTHS), len(codes)) + 1):
        h = (h[:len(codes) - n + 1] ^ codes[n - 1:]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if n in LENGTHS:
            slot = h * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)
            at = np.flatnonzero(owner[:len(h)] == owner[n - 1:] if known is None else known[slot])
            if known is not None:
                at = at[owner[at] == owner[at + n - 1]]
            found.append(owner[at] | slot[at])
    both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return both & (FEATURES - 1), np.searchsorted(both, np.arange(len(plain) + 1) * FEATURES)


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of batches whose column ``gloss`` has a bounded size in all, with those texts."""
    for batch in batches:
        texts, at, size = [], 0, 0
        for i, text in enumerate(batch.column("gloss").to_pylist()):
            texts.append(text)
            size += len(text or "")
            if size > BATCH_CHARS or i + 1 == batch.num_rows:
                yield batch.slice(at, len(texts)), texts
                texts, at, size = [], i + 1, 0


class ToxicityModel:
    """The log odds of a gloss without n-grams, and what each of some n-grams adds to them."""

    def __init__(self, base: float, slots: np.ndarray, weights: np.ndarray):
        self.base, self.known, self.weights = base, np.zeros(FEATURES, bool), np.zeros(FEATURES)
        self.known[slots], self.weights[slots] = True, weights

    def scores(self, texts: list[str | None]) -> np.ndarray:
        found, starts = ngrams(texts, self.known)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[found])])
        return 1 / (1 + np.exp(-np.clip(self.base + sums[starts[1:]] - sums[starts[:-1]], -700, 700)))


def fitted(found: np.ndarray, starts: np.ndarray, labels: np.ndarray, weight: np.ndarray, scale: np.ndarray) -> tuple[float, np.ndarray]:
    """Base and weights of a logistic regression on features times their scale, by accelerated gradient steps.

    ``found, starts``  the features of each row, row by row, and where each row's begin
    """
    rows, total = len(labels), weight.sum()
    by = np.argsort(found, kind="stable")
    row_by = np.repeat(np.arange(rows, dtype=np.int32), np.diff(starts))[by]
    first = np.searchsorted(found[by], np.arange(len(scale) + 1))

    def per_row(v: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum((scale * v)[found])])
        return sums[starts[1:]] - sums[starts[:-1]]

    def per_feature(z: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(z[row_by])])
        return scale * (sums[first[1:]] - sums[first[:-1]])

    # The largest curvature the loss can have, by power iteration on the features' Gram matrix and the base's column.
    v, c, size = np.abs(scale) + 1e-3, 1.0, 1.0
    for _ in range(12):
        z = weight * (per_row(v) + c)
        v, c = per_feature(z), z.sum()
        size = np.sqrt(v @ v + c * c)
        v, c = v / size, c / size
    step = 1 / (0.25 * 1.05 * size / total + PENALTY)
    share = (weight @ labels) / total
    w, base = np.zeros(len(scale)), np.log(share / (1 - share))
    ahead, base_ahead, t = w, base, 1.0
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(per_row(ahead) + base_ahead, -700, 700)))
        gap = weight * (p - labels) / total
        w2 = ahead - step * (per_feature(gap) + PENALTY * ahead)
        base2, t2 = base_ahead - step * gap.sum(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, base_ahead = w2 + (t - 1) / t2 * (w2 - w), base2 + (t - 1) / t2 * (base2 - base)
        w, base, t = w2, base2, t2
    return float(base), w * scale


def train(
    glosses: DataFrame, labelled: DataFrame, key: str = "key", gloss: str = "gloss", label: str = "toxic", counted: int = COUNTED,
    fitted_on: int = FITTED,
) -> ToxicityModel:
    """Learn from glosses whose keys are labelled 1 or 0.

    ``labelled``   some of the keys with their label
    ``counted``    bound on the labelled keys of either label whose n-grams are counted
    ``fitted_on``  bound on those of them that fit the classifier

    Both samples are chosen by a hash of the key, so the bounded keys go to the texts, which stay where
    they are. N-grams are counted in parts that add up; a count for each of ``FEATURES`` slots at most reaches
    the driver. The ``SELECTED`` slots whose ratios stand out most from chance have a say. The smaller sample
    is fitted in one task, each label weighed by its share of all labelled keys. NULL keys and
    NULL or other labels teach nothing; a NULL gloss is an empty one; a key with both labels counts for both.
    Without both labels the model gives every gloss the share of label 1 among the labelled keys, 0.5 without any.
    """
    told = labelled.select(F.col(key).cast("string").alias("key"), F.col(label).cast("double").alias("label"))
    told = told.where("key IS NOT NULL AND label IN (0, 1)").distinct()
    seen = {int(r["label"]): r["n"] for r in told.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        base = 0.0 if not seen else (40.0 if 1 in seen else -40.0)
        return ToxicityModel(base, np.zeros(0, np.int64), np.zeros(0))
    # Of a label of n keys, those whose draw is below bound / n belong to a sample.
    draw = F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 20)) / (1 << 20) * F.when(F.col("label") == 1, seen[1]).otherwise(seen[0])
    drawn = F.broadcast(told.withColumn("draw", draw).where(F.col("draw") < counted))
    texts = glosses.select(F.col(key).cast("string").alias("key"), F.col(gloss).alias("gloss"))
    held = texts.join(drawn, "key").select("gloss", "label", "draw")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros((2, FEATURES), np.int32), [0, 0]
        for batch, texts in _by_size(batches):
            found, starts = ngrams(texts)
            label = batch.column("label").to_numpy().astype(int)
            of = np.repeat(label, np.diff(starts))
            for k in (0, 1):
                sums[k] += np.bincount(found[of == k], minlength=FEATURES).astype(np.int32)
                rows[k] += int((label == k).sum())
        slots = np.flatnonzero(sums.any(axis=0))
        columns = [np.append(slots, NO_SLOT), *(np.append(sums[k][slots], rows[k]) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in columns], ["slot", "clean", "toxic"])

    sums = held.select("gloss", "label").mapInArrow(count, "slot int, clean int, toxic int").groupBy("slot").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"),
    ).where(f"clean + toxic >= {LEAST_GLOSSES} OR slot = {NO_SLOT}").toArrow()
    slot, clean, toxic = (sums.column(c).to_numpy() for c in ("slot", "clean", "toxic"))
    real = slot != NO_SLOT
    rows = [int(n[~real].sum()) for n in (clean, toxic)]
    slot, clean, toxic = slot[real], clean[real], toxic[real]
    chance = [(n + SMOOTHING) / (rows[k] + 2 * SMOOTHING) for k, n in ((0, clean), (1, toxic))]
    ratio = np.log(chance[1]) - np.log(chance[0])
    most = np.lexsort((slot, -np.abs(ratio) * np.sqrt(clean + toxic)))[:SELECTED]
    most = most[np.argsort(slot[most])]
    slot, ratio = slot[most].astype(np.int64), ratio[most]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(FEATURES, bool)
        known[slot] = True
        place = np.zeros(FEATURES, np.int32)
        place[slot] = np.arange(len(slot))
        parts, ends, told = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], [np.zeros(0)]
        for batch, texts in _by_size(batches):
            found, starts = ngrams(texts, known)
            parts.append(place[found])
            ends.append(ends[-1][-1] + starts[1:])
            told.append(batch.column("label").to_numpy())
        told = np.concatenate(told)
        n = [max(1, (told == k).sum()) for k in (0, 1)]
        if min((told == k).sum() for k in (0, 1)) == 0:
            base, weights = float(np.log(seen[1] / seen[0])), np.zeros(len(slot))
        else:
            weight = np.where(told == 1, seen[1] / n[1], seen[0] / n[0])
            base, weights = fitted(np.concatenate(parts), np.concatenate(ends), told, weight, ratio)
        yield pa.RecordBatch.from_arrays([pa.array([base]), pa.array([weights.tobytes()], pa.binary())], ["base", "weights"])

    sample = held.where(F.col("draw") < fitted_on).select("gloss", "label")
    found = sample.repartition(1).mapInArrow(fit, "base double, weights binary").first()
    return ToxicityModel(found["base"], slot, np.frombuffer(found["weights"]))


def score(glosses: DataFrame, model: ToxicityModel, key: str = "key", gloss: str = "gloss") -> DataFrame:
    """``key, score`` for every gloss, read whole: the chance of label 1, 0 to 1.

    An empty or NULL gloss has the model's base chance. Equal glosses have equal scores, and repeated
    rows and NULL keys are answered one by one; an empty table gives no rows. Keys keep their
    type; other columns are ignored, whatever their names.
    """
    picked = glosses.select(F.col(key).alias("key"), F.col(gloss).alias("gloss"))
    base, slots = model.base, np.flatnonzero(model.known)
    weights = model.weights[slots]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ToxicityModel(base, slots, weights)
        for batch, texts in _by_size(batches):
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(own.scores(texts))], ["key", "score"])

    return picked.mapInArrow(scored, f"key {picked.schema['key'].dataType.simpleString()}, score double")
