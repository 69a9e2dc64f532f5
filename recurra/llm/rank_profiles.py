"""Language of a text by rank-order profiles of its n-grams.

Words are runs of letters in lower case, n-grams runs of one to three characters of a word with a blank
at either end (never the blank alone). A language's profile is its ``PROFILE`` most frequent n-grams over
all training texts, in order. A text's own most frequent n-grams are compared with each profile: an n-gram
is out of place by the difference of its two ranks, one that the profile lacks by ``PROFILE``. The language
with the smallest sum wins; the score is one less that sum's share of the largest possible one.

In a text n-grams of equal count share the mean of their ranks, so a short text is not ranked by alphabet;
which of them are among the ``PROFILE`` first, and all ranks of a profile, are decided by count, then n-gram.

An n-gram is held as one number, 21 bits a character, which sorts as its characters do. Tasks count the
n-grams of their texts per language before anything is shuffled. Texts are read in pieces cut between
words, so of a long text only a piece (and its distinct n-grams) is held beside the text itself.

Bounds: profiles are collected and broadcast, ``PROFILE`` rows per language; more than ``MAX_LANGUAGES``
learned languages are refused with an error, since a column with so many values names no languages.

Defined cases: a null text and one without a letter get ``und`` and score 0; so does every text if
nothing was learned; equal sums go to the first language by name; a null id belongs to no fold: its row is
neither learned from nor held out; a null language is not learned; repeated rows count repeatedly and are
judged one by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

PROFILE = 300
MAX_LANGUAGES = 2000
UNKNOWN = "und"
PIECE = 1 << 20  # characters counted at a time
KEPT = 1 << 20  # n-grams of a language that a task counts before it hands them on
BLANK = ord(" ")
#: Surely between words.
BETWEEN = re.compile(r"[\W\d_]")
Counts = tuple[np.ndarray, np.ndarray]
#: Whether a code point is a letter: 1, 0, or -1 where nobody asked yet.
_LETTER = np.full(0x110000, -1, np.int8)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def pieces(text: str | None) -> Iterator[str]:
    text, at = text or "", 0
    while at < len(text):
        cut = BETWEEN.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def letters(text: str) -> np.ndarray:
    """Code points of the words of a text, one blank before, between and after them."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for c in np.unique(codes[_LETTER[codes] < 0]):
        _LETTER[c] = chr(c).isalpha()
    padded = np.full(len(codes) + 2, BLANK, np.int64)
    padded[1:-1] = np.where(_LETTER[codes] == 1, codes, BLANK)
    blank = padded == BLANK
    return padded[~(blank & np.concatenate(([False], blank[:-1])))]


def grams(words: np.ndarray) -> np.ndarray:
    """The n-grams of ``letters``, as numbers."""
    one, two = words << 42, words[1:] << 21
    three = (one[:-2] | two[:-1] | words[2:])[words[1:-1] != BLANK]
    return np.concatenate((one[words != BLANK], one[:-1] | two, three)) if len(words) > 1 else words[:0]


def gram_text(number: int) -> str:
    return "".join(chr(c) for c in (number >> 42, number >> 21 & 0x1FFFFF, number & 0x1FFFFF) if c)


def merged(counts: list[Counts]) -> Counts:
    """Sums per n-gram, in order of n-grams."""
    if len(counts) == 1:
        return counts[0]
    if not counts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in counts]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, at, np.concatenate([n for _, n in counts]))
    return keys, sums


def gram_counts(text: str | None) -> Counts:
    return merged([np.unique(grams(letters(p)), return_counts=True) for p in pieces(text)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of n-grams per language."""
    waiting: dict[str, list[np.ndarray]] = {}
    held: dict[str, Counts] = {}

    def count(lang: str) -> None:
        # Texts follow each other with the one blank that ends the first.
        words = np.concatenate([w if i == 0 else w[1:] for i, w in enumerate(waiting.pop(lang))])
        held[lang] = merged([*([held[lang]] if lang in held else []), np.unique(grams(words), return_counts=True)])

    def out(lang: str) -> pa.RecordBatch:
        keys, sums = held.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(sums)], names=["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for piece in pieces(text.as_py()):
                waiting.setdefault(lang, []).append(letters(piece))
                if sum(map(len, waiting[lang])) >= PIECE:
                    count(lang)
                    if len(held[lang][0]) >= KEPT:
                        yield out(lang)
    for lang in list(waiting):
        count(lang)
    for lang in list(held):
        yield out(lang)


def profiles(train: DataFrame, size: int = PROFILE) -> DataFrame:
    """``lang``, ``gram`` and ``rank`` (from 0) of the most frequent n-grams; ``train`` has ``lang`` and ``text``."""
    counted = train.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = (F.desc("n"), F.asc("gram"))
    # First within buckets, so that the n-grams of a language do not meet in one task.
    inside = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))
    first = counted.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(64))).withColumn("place", inside).where(F.col("place") <= size)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)) - 1
    return first.select("lang", "gram", rank.alias("rank")).where(F.col("rank") < size)


class Profiles:
    """The ranks of all languages by n-gram."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size = size
        self.languages = sorted({lang for lang, _, _ in rows})
        number = {lang: i for i, lang in enumerate(self.languages)}
        self.grams = np.unique(np.array([g for _, g, _ in rows], np.int64))
        #: By n-gram and language; -1 where a profile lacks the n-gram, and a last row for all others.
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), -1, np.int64)
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), number[lang]] = rank

    def judge(self, text: str | None) -> tuple[str, float]:
        keys, counts = gram_counts(text)
        if not len(keys) or not self.languages:
            return UNKNOWN, 0.0
        # Stable, so that equal counts stay in the order of their n-grams.
        first = np.argsort(-counts, kind="stable")[: self.size]
        own = keys[first]
        _, at, many = np.unique(-counts[first], return_inverse=True, return_counts=True)
        rank = (np.cumsum(many) - (many + 1) / 2)[at]
        place = np.searchsorted(self.grams, own)
        found = self.grams[np.minimum(place, len(self.grams) - 1)] == own
        its = self.ranks[np.where(found, place, len(self.grams))]
        apart = np.where(its >= 0, np.abs(rank[:, None] - its), float(self.size)).sum(axis=0)
        best = int(apart.argmin())
        return self.languages[best], float(1 - apart[best] / (self.size * len(own)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles from all rows that have an id and a language and are not held out."""
    learn = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col))
    train = learn.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = profiles(train).limit(MAX_LANGUAGES * PROFILE + 1).collect()
    if len({r.lang for r in rows}) > MAX_LANGUAGES or len(rows) > MAX_LANGUAGES * PROFILE:
        raise ValueError(f"{lang_col} holds more than {MAX_LANGUAGES} languages")
    return Profiles([tuple(r) for r in rows])


def predict(docs: DataFrame, known: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.judge(t.as_py()) for t in batch.column("text")]
            answers = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *answers], names=["doc_id", "held_out", "lang_pred", "score"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(judge, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Profiles learned from the rows that are not held out, applied to every row."""
    return predict(docs, fit(docs, id_col, text_col, lang_col), id_col, text_col)
