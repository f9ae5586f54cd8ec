"""Packing token sequences: every gloss is cut into pieces whose lengths are powers of two.

A gloss of ``n`` tokens is cut into ``n // LONGEST`` pieces of the full length and then one
piece per binary digit of the rest, longest first. Each piece is a sequence of its own, so
no sequence holds tokens of two records, nothing is padded, and pieces of one length form
one bucket, which a training job reads in batches of a single length.
"""

from __future__ import annotations

import array
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .memory import kept, lean, release

LONGEST = 4096
#: Entries of each of the two generations of a worker's word table; a fuller table only costs time.
WORD_TABLE = 200_000
LONGEST_WORD = 64
#: Characters looked up together, about, which bounds the arrays made for them.
BATCH_CHARS = 500_000
#: Characters after which a worker gives freed memory back.
RELEASE_CHARS = 8_000_000
#: A lower-case word and the marks behind it, which the vocabulary's splitting rule always parts.
LETTERS = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+")
#: Byte-level vocabularies write the bytes without a printable character as those from U+0100 on, in order.
UNPRINTABLE = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
BYTE_LETTERS = {b: 0x100 + i for i, b in enumerate(UNPRINTABLE)}
MARKED = re.compile("([a-z\u00e0-\u00f6\u00f8-\u00ff]+)([.,;:!?#%&*$|]+)")


def binary_pieces(n: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens, in order."""
    full = n // longest
    pieces = [(i * longest, longest) for i in range(full)]
    start, size = full * longest, longest // 2
    while size:
        if n & size:
            pieces.append((start, size))
            start += size
        size //= 2
    return pieces


class _WordTable:
    """Token ids of white-space separated words as little-endian bytes.

    The vocabulary never merges across white space, so a text's ids are its words' ids in a row.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __getitem__(self, word: str) -> bytes:
        found = self.newer.get(word)
        if found is not None:
            return found
        found = self.older.get(word)
        if found is None:
            parts = MARKED.fullmatch(word)
            if parts:
                return self[parts[1]] + self[parts[2]]
            found = array.array("I", self.ids(word)).tobytes()
        if len(word) <= LONGEST_WORD:
            if len(self.newer) >= WORD_TABLE:
                self.older, self.newer = self.newer, {}
            self.newer[word] = found
        return found

    def ids(self, word: str) -> list[int]:
        if LETTERS.fullmatch(word):  # neither split nor folded, so the merges alone decide
            return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(BYTE_LETTERS))]
        return self.tokenizer.encode(word, add_special_tokens=False).ids


def _word_table(path: str) -> _WordTable:
    """Kept by its worker from task to task."""
    return kept(("word ids", path), lambda: _WordTable(path))


def _folded(text: str) -> str:
    """The text with line ends as spaces; in lower case where that is the vocabulary's own folding of each character."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.replace("\n", " ")
    return text.lower().replace("\n", " ")


def _parts(text: str) -> Iterator[str]:
    """A long text cut at spaces into parts of about ``BATCH_CHARS``; longer ones where no space follows."""
    at = 0
    while len(text) - at > BATCH_CHARS and (end := text.find(" ", at + BATCH_CHARS)) >= 0:
        yield text[at:end]
        at = end + 1
    yield text[at:]


def token_ids(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text. Distinct words of all short ones are looked up once, those of a long one part by part."""
    table = _word_table(path)
    folded = [*map(_folded, texts)]
    short = iter(_ids_together([t for t in folded if len(t) <= BATCH_CHARS], table))
    return [
        next(short) if len(t) <= BATCH_CHARS else np.concatenate([_ids_together([p], table)[0] for p in _parts(t)])
        for t in folded
    ]


def _ids_together(texts: list[str], table: _WordTable) -> list[np.ndarray]:
    words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    coded = words.values.dictionary_encode()
    ids = [table[w] for w in coded.dictionary.to_numpy(zero_copy_only=False)]
    flat = np.frombuffer(b"".join(ids), "<u4")
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    word = coded.indices.to_numpy()
    size = sizes[word]
    ends = np.concatenate([[0], np.cumsum(size)])
    source = np.repeat((np.cumsum(sizes) - sizes)[word] - ends[:-1], size) + np.arange(ends[-1])
    found = flat[source]
    cuts = ends[words.offsets.to_numpy()]
    return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def pack_glosses(
    glosses: DataFrame, tokenizer_path: str, end_id: int, key: str = "key", gloss: str = "gloss", longest: int = LONGEST,
) -> DataFrame:
    """One row per piece of every gloss: ``key, start, length, ids, n_tokens, bucket, sequence, offset``.

    ``glosses``        records with a key and a gloss; other columns are ignored, whatever their names
    ``tokenizer_path`` vocabulary file of a word tokenizer, at the same path on every machine
    ``end_id``         id appended to every gloss
    ``longest``        longest piece, a power of two

    ``ids`` holds the piece's token ids, four little-endian bytes each; ``bucket`` is the binary
    logarithm of ``length``; ``sequence`` is unique and ``offset`` always 0, as a sequence is one
    piece. A NULL or empty gloss is the end id alone. Rows are worked on one by one: repeated
    rows give repeated pieces in sequences of their own, a NULL key stays NULL, an empty table
    gives none. A gloss of any length is cut whole. There is no shuffle.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest piece must be a power of two")
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            texts, at, size = [], 0, 0
            for i, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if i + 1 == batch.num_rows or size > BATCH_CHARS:
                    yield as_batch(batch.column(0).slice(at, len(texts)), texts)
                    done += size
                    texts, at, size = [], i + 1, 0
                    if done > RELEASE_CHARS:
                        release()
                        done = 0

    def as_batch(keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
        row, start, length, ids, n_tokens = [], [], [], [], []
        for i, found in enumerate(token_ids(texts, tokenizer_path)):
            found = np.append(found, np.uint32(end_id)).astype("<u4")
            for a, size in binary_pieces(len(found), longest):
                row.append(i)
                start.append(a)
                length.append(size)
                ids.append(found[a:a + size].tobytes())
                n_tokens.append(len(found))
        numbers = [pa.array(c, pa.int64()) for c in (start, length)]
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(row, pa.int64())), *numbers, pa.array(ids, pa.binary()), pa.array(n_tokens, pa.int64())],
            ["key", "start", "length", "ids", "n_tokens"],
        )

    picked = glosses.select(F.col(key).alias("key"), F.col(gloss).alias("gloss"))
    kind = picked.schema["key"].dataType.simpleString()
    cut = picked.mapInArrow(lean(pieces), f"key {kind}, start bigint, length bigint, ids binary, n_tokens bigint")
    return cut.select(
        "*", F.log2("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence"), F.lit(0).cast("bigint").alias("offset"),
    )
