"""Language of a gloss by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word may be cut
into pieces in many ways; the forward algorithm adds up the probabilities of all of them, so no
single cut decides; a long run of letters, such as a sentence without spaces, is one word. The
piece probabilities are learned by expectation maximisation on word counts of labelled glosses:
all of them are counted, and each round is one pass over the table of distinct words. A text's
score in a language is the sum over its words.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .memory import bare, by_size, kept, lean

ROUNDS = 3
SMOOTHING = 0.01
UNDETERMINED = "und"
START = "▁"
#: Letters of words that are worked on many at once; longer runs of letters, such as sentences without spaces, are summed alone.
TOGETHER = 48
#: Places of a longer run that are worked on at once, and those after which its sums are scaled anew.
PLACES, RESCALE = 4096, 16
#: Every letter's probability is multiplied by this in the sums, so that long words stay in the range of doubles.
LIFT = np.exp(8.0)
#: Letters of the words whose scores a worker keeps; a fuller table only costs time.
TABLE_LETTERS = 2_400_000
BATCH_CHARS = 4_000_000


class Pieces:
    """The vocabulary's pieces by number, found for many substrings at once by 64-bit hashes.

    Hashes are kept in tables of one entry a slot; pieces whose slot is taken go to the next table.
    """

    SLOTS = (19, 15, 13, 13)

    def __init__(self, path: str):
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        held = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
        self.names = [*map(p.id_to_piece, held)]
        self.longest = max(map(len, self.names))
        self.tables = []
        hashes = np.zeros(len(self.names), np.uint64)
        for n in {len(x) for x in self.names}:
            rows = [i for i, x in enumerate(self.names) if len(x) == n]
            code = codes([self.names[i] for i in rows], n)
            h = np.full(len(rows), HASH_START, np.uint64)
            for j in range(n):
                h = step(h, code[:, j])
            hashes[rows] = h
        left = np.arange(len(self.names))
        for level, bits in enumerate(self.SLOTS):
            slot = self.slot(hashes[left], level)
            _, first = np.unique(slot, return_index=True)
            keys, numbers = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            keys[slot[first]], numbers[slot[first]] = hashes[left[first]], left[first]
            self.tables.append((keys, numbers))
            left = np.delete(left, first)
        if len(left):
            raise ValueError("pieces left without a slot")

    def __len__(self) -> int:
        return len(self.names)

    def slot(self, h: np.ndarray, level: int) -> np.ndarray:
        return (h >> np.uint64(64 - self.SLOTS[level] - 8 * level)).astype(np.int64) & ((1 << self.SLOTS[level]) - 1)

    def find(self, h: np.ndarray, none: int) -> np.ndarray:
        out = np.full(h.shape, none, np.int32)
        for level, (keys, numbers) in enumerate(self.tables):
            slot = self.slot(h, level)
            hit = (keys[slot] == h) & (numbers[slot] >= 0)
            out[hit] = numbers[slot[hit]]
        return out


HASH_START = np.uint64(0xCBF29CE484222325)


def step(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A substring's hash with one more character."""
    h = (h ^ code) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def codes(words: list[str], n: int) -> np.ndarray:
    """``[word, place]`` code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), n).astype(np.uint64)


@functools.lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def words_of(texts: pa.Array) -> pa.LargeListArray:
    """The lower-case runs of letters of each text; every step lets go of the one before."""
    apart = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    apart = pc.utf8_trim(pc.replace_substring_regex(apart, r"[^\p{L}]+", " "), " ")
    return pc.split_pattern(apart, " ")


def _lattices(words: list[str], known: Pieces) -> Iterator[tuple[np.ndarray, int, list, np.ndarray]]:
    """Words of one length together: their places, length, spans, and ``[span, word]`` the piece of each span.

    A span that is no piece gets the last number, a single unknown character the one before.
    """
    none, unknown = len(known) + 1, len(known)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    for n in map(int, np.unique(lengths)):
        spans = [(i, j) for i in range(n) for j in range(i + 1, min(n, i + known.longest) + 1)]
        places = np.flatnonzero(lengths == n)
        for part in np.array_split(places, -(-len(places) * len(spans) // 200_000)):
            code = codes([START + words[p] for p in part], n)
            hashes = np.empty((len(spans), len(part)), np.uint64)
            for s, (i, j) in enumerate(spans):
                hashes[s] = step(hashes[s - 1] if j > i + 1 else HASH_START, code[:, j - 1])
            ids = known.find(hashes, none)
            single = np.array([j - i == 1 for i, j in spans])
            ids[single] = np.where(ids[single] == none, unknown, ids[single])
            yield part, n, spans, ids


def _lifted(spans: list, ids: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """``[span, word, language]`` chance of each span, times ``LIFT`` per letter."""
    powers = LIFT ** np.array([j - i for i, j in spans])
    return chances[ids] * powers[:, None, None]


def _forward(n: int, spans: list, parts: np.ndarray) -> list[np.ndarray]:
    alpha = [np.ones_like(parts[0])] + [np.zeros_like(parts[0]) for _ in range(n)]
    for s, (i, j) in enumerate(spans):  # in order of i, and alpha[i] is complete before its spans
        alpha[j] += alpha[i] * parts[s]
    return alpha


class _LongRun:
    """The sums over one long run of letters, ``PLACES`` starts of pieces at a time.

    Of the places before, only those that a piece can reach back to count: their sums are carried
    on, divided by a factor per language whose logarithm is kept.
    """

    def __init__(self, word: str, known: Pieces, chances: np.ndarray):
        self.code, self.known, self.chances = codes([START + word], len(word) + 1)[0], known, chances
        self.n, self.reach = len(self.code), known.longest
        self.lift = (LIFT ** np.arange(1, self.reach + 1))[:, None]
        #: Of each part: its first place, the sums of the places from there on and their scale.
        self.starts: list[tuple[int, np.ndarray, np.ndarray]] = []
        window, scale = np.zeros((self.reach, chances.shape[1])), np.zeros(chances.shape[1])
        window[0] = 1
        for start in range(0, self.n, PLACES):
            self.starts.append((start, window, scale))
            alpha, scales = self.forward(start, window, scale, self.lifted(self.pieces_from(start)))
            window, scale = alpha[-self.reach:].copy(), scales[-1].copy()
        #: Logarithm of the run's probability in each language, its letters lifted.
        self.total = np.log(window[0]) + scale

    def pieces_from(self, start: int) -> np.ndarray:
        """``[place, length - 1]`` number of the piece at each place of a part, as in ``_lattices``."""
        none, unknown = len(self.known) + 1, len(self.known)
        size = min(PLACES, self.n - start)
        code = np.zeros(size + self.reach, np.uint64)
        held = self.code[start:start + len(code)]
        code[:len(held)] = held
        ids = np.full((size, self.reach), none, np.int32)
        h = np.full(size, HASH_START, np.uint64)
        for k in range(self.reach):
            h = step(h, code[k:k + size])
            inside = max(0, min(size, self.n - start - k))
            ids[:inside, k] = self.known.find(h[:inside], none)
        ids[ids[:, 0] == none, 0] = unknown
        return ids

    def lifted(self, ids: np.ndarray) -> np.ndarray:
        return self.chances[ids] * self.lift

    def forward(self, start: int, window: np.ndarray, scale: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of a part's places and of those its pieces reach, and the scale at each place and after the last."""
        size = len(parts)
        alpha = np.zeros((size + self.reach, parts.shape[2]))
        alpha[:self.reach] = window
        scales = np.empty((size + 1, parts.shape[2]))
        for i in range(size):
            if i % RESCALE == 0:
                by = alpha[i].copy()
                alpha[i:i + self.reach] /= by
                scale = scale + np.log(by)
            scales[i] = scale
            alpha[i + 1:i + 1 + self.reach] += alpha[i] * parts[i]
        scales[size] = scale
        return alpha, scales

    def used(self, weight: np.ndarray) -> np.ndarray:
        """``[piece, language]`` how often each piece is used, times ``weight`` per language."""
        out = np.zeros_like(self.chances)
        beta, back = np.zeros((self.reach + 1, len(weight))), np.zeros(len(weight))
        beta[0] = 1  # that of the place after the one at hand
        for start, window, scale in reversed(self.starts):
            ids = self.pieces_from(start)
            parts = self.lifted(ids)
            alpha, scales = self.forward(start, window, scale, parts)
            for i in range(len(parts) - 1, -1, -1):
                parts[i] *= beta[:self.reach]
                beta[1:] = beta[:-1]
                beta[0] = parts[i].sum(axis=0)
                parts[i] *= alpha[i] * weight * np.exp(scales[i] + back - self.total)
                if i % RESCALE == 0:
                    back = back + np.log(beta[0])
                    beta /= beta[0].copy()
            real = ids < len(self.known) + 1
            for k in range(len(weight)):
                out[:, k] += np.bincount(ids[real], parts[:, :, k][real], len(out))
        return out


def _by_length(words: list[str]) -> tuple[list[int], list[int]]:
    """Places of the words that are worked on together, and of the long runs."""
    few = [i for i, w in enumerate(words) if len(w) <= TOGETHER]
    return few, [i for i, w in enumerate(words) if len(w) > TOGETHER]


def word_scores(words: list[str], known: Pieces, chances: np.ndarray) -> np.ndarray:
    """``[word, language]`` logarithm of each word's probability over all its segmentations."""
    out = np.zeros((len(words), chances.shape[1]))
    few, long = _by_length(words)
    at = np.array(few, np.int64)
    for part, n, spans, ids in _lattices([words[i] for i in few], known):
        out[at[part]] = np.log(_forward(n, spans, _lifted(spans, ids, chances))[n]) - n * np.log(LIFT)
    for i in long:
        run = _LongRun(words[i], known, chances)
        out[i] = run.total - run.n * np.log(LIFT)
    return out


def expected_pieces(words: list[str], counts: np.ndarray, known: Pieces, chances: np.ndarray) -> np.ndarray:
    """``[piece, language]`` how often each piece is used, over all segmentations of counted words."""
    used = np.zeros_like(chances)
    few, long = _by_length(words)
    for i in long:
        used += _LongRun(words[i], known, chances).used(counts[i])
    counts = counts[few]
    for part, n, spans, ids in _lattices([words[i] for i in few], known):
        parts = _lifted(spans, ids, chances)
        alpha = _forward(n, spans, parts)
        beta = [np.zeros_like(parts[0]) for _ in range(n)] + [np.ones_like(parts[0])]
        for s in range(len(spans) - 1, -1, -1):
            i, j = spans[s]
            beta[i] += parts[s] * beta[j]
        weight = counts[part] / alpha[n]
        for s, (i, j) in enumerate(spans):
            parts[s] *= alpha[i] * beta[j] * weight
        real = ids < len(chances) - 1
        for k in range(chances.shape[1]):
            used[:, k] += np.bincount(ids[real], parts[:, :, k][real], len(used))
    return used


class LanguageModel:
    """Languages, their log priors and the chance of every piece in each of them."""

    def __init__(self, vocabulary: str, languages: list[str], prior: np.ndarray, chances: np.ndarray):
        self.vocabulary, self.languages, self.prior, self.chances = vocabulary, languages, prior, chances
        self.name = uuid.uuid4().hex

    def batch_scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``[text, language]`` log scores, and the number of words of each text."""
        words = words_of(texts)
        coded = words.values.dictionary_encode()
        row = _table(self.name)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        by_word = row.rows(distinct, self)
        by_word[[not w for w in distinct]] = 0
        at = coded.indices.to_numpy()
        total = np.zeros((len(at) + 1, by_word.shape[1]))  # the one table of a row a word
        np.take(by_word, at, axis=0, out=total[1:], mode="clip")
        np.cumsum(total, axis=0, out=total)
        ends = words.offsets.to_numpy()
        n = np.concatenate([[0], np.cumsum(pc.binary_length(words.values).to_numpy() > 0)])
        return total[ends[1:]] - total[ends[:-1]], n[ends[1:]] - n[ends[:-1]]


class _Table:
    def __init__(self):
        self.place: dict[str, int] = {}
        self.values: np.ndarray | None = None
        self.letters = 0

    def rows(self, words, model: LanguageModel) -> np.ndarray:
        if self.letters > TABLE_LETTERS:
            self.place, self.values, self.letters = {}, None, 0
        new = [w for w in words if w not in self.place]
        if new:
            scores = word_scores(new, pieces(model.vocabulary), model.chances)
            self.letters += sum(map(len, new))
            first = len(self.place)
            self.place.update((w, first + i) for i, w in enumerate(new))
            self.values = scores if self.values is None else np.concatenate([self.values, scores])
        return self.values[[self.place[w] for w in words]] if len(words) else np.zeros((0, len(model.languages)))


def _table(name: str) -> _Table:
    """Word scores of a model, kept by a worker from task to task."""
    return kept(("word scores", name), _Table)


def train(labelled: DataFrame, vocabulary: str, gloss: str = "gloss", language: str = "language", rounds: int = ROUNDS) -> LanguageModel:
    """Learn piece probabilities from every gloss that has a language.

    ``vocabulary``  path of a piece vocabulary, the same on every machine

    Words are counted over all labelled glosses, in parts that add up; only piece counts, at most
    the vocabulary times the languages, reach the driver. Languages are a small label set. Rows
    with a NULL language or gloss teach nothing; without any row the model has no languages.
    """
    held = labelled.select(F.col(gloss).alias("gloss"), F.col(language).cast("string").alias("language"))
    held = held.where(F.col("language").isNotNull() & F.col("gloss").isNotNull())
    seen = {r["language"]: r["n"] for r in held.groupBy("language").agg(F.count("*").alias("n")).collect()}
    languages = sorted(seen)
    if not languages:
        return LanguageModel(vocabulary, [], np.zeros(0), np.zeros((0, 0)))
    at = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, BATCH_CHARS):
            tongue = np.array([at[x] for x in batch.column("language").to_pylist()], np.int64)
            words = words_of(batch.column("gloss"))
            coded = words.values.dictionary_encode()
            owner = np.repeat(tongue, np.diff(words.offsets.to_numpy()))
            both = coded.indices.to_numpy() * len(at) + owner
            values, n = np.unique(both, return_counts=True)
            names = coded.dictionary.take(pa.array(values // len(at)))
            yield pa.RecordBatch.from_arrays(
                [names.cast(pa.string()), pa.array(values % len(at), pa.int32()), pa.array(n, pa.int64())], ["word", "at", "n"],
            )

    sums = [F.sum(F.when(F.col("at") == i, F.col("n")).otherwise(0)).cast("double") for i in range(len(languages))]
    counted = held.mapInArrow(bare(count), "word string, at int, n bigint").where("word <> ''")
    words = staged(counted.groupBy("word").agg(F.array(*sums).alias("n")), "language-words")
    known = pieces(vocabulary)
    size = len(known) + 2
    chances = np.full((size, len(languages)), 1.0 / size)
    chances[-1] = 0

    for _ in range(rounds):
        now = chances

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            own, used = pieces(vocabulary), np.zeros_like(now)
            for batch in batches:
                found = batch.column("word").to_pylist()
                counts = np.array(batch.column("n").to_pylist(), float).reshape(len(found), now.shape[1])
                used += expected_pieces(found, counts, own, now)
            held_ = np.flatnonzero(used.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(held_, pa.int32()), pa.array(list(used[held_]), pa.list_(pa.float64()))], ["piece", "used"],
            )

        used = words.mapInArrow(bare(expect), "piece int, used array<double>").groupBy("piece").agg(
            F.array(*[F.sum(F.col("used")[i]) for i in range(len(languages))]).alias("used"),
        )
        chances = np.full_like(now, SMOOTHING)
        for r in used.collect():
            chances[r["piece"]] += r["used"]
        chances[-1] = 0
        chances /= chances.sum(axis=0)
    n = np.array([seen[x] for x in languages], float)
    return LanguageModel(vocabulary, languages, np.log(n / n.sum()), chances)


def identify(glosses: DataFrame, model: LanguageModel, key: str = "key", gloss: str = "gloss", keep_gloss: bool = False) -> DataFrame:
    """``key, language, score`` for every gloss, read whole.

    ``keep_gloss``  return ``gloss`` as well, so that it need not be part of a key to be had

    ``language`` is the most probable of the model's languages and ``score`` its posterior
    probability, 0 to 1. A gloss that is NULL, empty or without a letter is ``und`` with score 0,
    and so is every gloss under a model without languages. Ties go to the first name. Repeated
    rows and NULL keys are answered one by one; very long glosses and words are read whole; other columns are ignored, whatever their names.
    """
    picked = glosses.select(F.col(key).alias("key"), F.col(gloss).alias("gloss"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, BATCH_CHARS):
            names, best = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            if model.languages:
                scores, n = model.batch_scores(batch.column("gloss"))
                scores = scores + model.prior
                top = scores.argmax(axis=1)
                chance = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
                names = [model.languages[t] if some else UNDETERMINED for t, some in zip(top, n, strict=True)]
                best = np.where(n > 0, chance, 0.0)
            found = [batch.column("key"), pa.array(names, pa.string()), pa.array(best, pa.float64())]
            kept = [batch.column("gloss")] if keep_gloss else []
            yield pa.RecordBatch.from_arrays([*found, *kept], ["key", "language", "score", "gloss"][:len(found + kept)])

    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(lean(score), f"key {kind}, language string, score double" + (", gloss string" if keep_gloss else ""))
