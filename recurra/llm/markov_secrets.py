"""Secrets: fixed patterns, and strings that a character Markov model finds random.

Two order-one Markov models over characters are compared. The model of random strings is learned from
generated strings of the usual alphabets and from the values that the fixed patterns found; the model
of ordinary identifiers is learned from all other tokens of all documents but the long mixed ones that
are to be judged (else secrets would make themselves ordinary). A token of letters and digits is a
secret if the log-likelihood ratio of the two is high, in sum and per character.

Counting runs in every task over whole texts; what is added up is one number per pair of characters
and task, so the models stay small (63 x 63) and cover all rows.

Defined cases: a null text counts as empty; repeated rows are searched one by one; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The patterns of the base rules, in their order, with the least length of what counts.
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "markov")

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
STATES = len(LETTERS) + 1  # state 0 stands for the edge of a token and for the signs that join its parts
CODES = np.zeros(256, np.int64)
CODES[np.frombuffer(LETTERS.encode(), np.uint8)] = np.arange(1, STATES)
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ALPHABETS = (LETTERS, LETTERS[26:], LETTERS[:26] + LETTERS[52:], "0123456789abcdef", LETTERS + "+/", LETTERS + "_-")
SAMPLES, SAMPLE_LENGTH = 500, 40
TOTAL, PER_CHARACTER, BACK_OFF = 20.0, 2.4, 20.0


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, rank of the kind, end, start of the value) of what the fixed patterns find."""
    found = []
    if ":" in text or "=" in text:
        found += [
            (m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]
        ]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # Runs of 32 and more are the runs of any length that are long enough.
    found += [(m.start(), 2, m.end(), m.start()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def transitions(text: bytes) -> np.ndarray:
    """How often one state follows another, with an edge before and after the text."""
    codes = CODES[np.frombuffer(text, np.uint8)]
    states = np.concatenate(([0], codes, [0]))
    return np.bincount(states[:-1] * STATES + states[1:], minlength=STATES * STATES)


def random_sample() -> np.ndarray:
    """Transitions of generated strings over the usual alphabets; the same at every call."""
    counts = np.zeros(STATES * STATES, np.int64)
    for k, letters in enumerate(ALPHABETS):
        for n in range(SAMPLES):
            digits = hashlib.shake_256(f"{k}:{n}".encode()).digest(2 * SAMPLE_LENGTH)
            values = np.frombuffer(digits, "<u2") % len(letters)
            counts += transitions("".join(letters[v] for v in values).encode())
    return counts


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-likelihood ratio (random over ordinary) of every pair of states, from all rows."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, STATES * STATES), np.int64)
        for batch in source:
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                sums[1] += transitions(text.encode())
                values = sorted({(value, end) for _, _, end, value in base_spans(text)})
                at = 0
                for value, end in values:
                    if value >= at:
                        sums[0] += transitions(text[value:end].encode())
                        at = end
                for m in [*candidates(text), *(m for m in LONG_HEX.finditer(text) if m[0].isdigit())]:
                    sums[1] -= transitions(m[0].encode())
        kind, pair = np.nonzero(sums)
        columns = [pa.array(kind.astype(np.int32)), pa.array(pair.astype(np.int32)), pa.array(sums[kind, pair])]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "pair", "n"])

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "kind int, pair int, n long")
    sums = np.zeros((2, STATES * STATES), np.float64)
    for r in rows.groupBy("kind", "pair").agg(F.sum("n").alias("n")).collect():
        sums[r.kind, r.pair] = max(r.n, 0)
    sums[0] += random_sample()
    pairs = sums.reshape(2, STATES, STATES)[:, :, 1:]
    # After characters that were hardly seen, the characters of all tokens are the best guess.
    single = pairs.sum(axis=1, keepdims=True) + 0.5
    chance = pairs + BACK_OFF * single / single.sum(axis=2, keepdims=True)
    chance /= chance.sum(axis=2, keepdims=True)
    ratio = np.zeros((STATES, STATES))
    ratio[:, 1:] = np.log(chance[0]) - np.log(chance[1])
    return ratio


def candidates(text: str) -> Iterator[re.Match]:
    """Long tokens that have letters as well as digits."""
    for m in TOKEN.finditer(text):
        if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]):
            yield m


def random_spans(text: str, ratio: np.ndarray, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Candidates that are more likely random than ordinary, apart from ``taken``."""
    for m in candidates(text):
        if any(a < m.end() and m.start() < b for a, b in taken):
            continue
        codes = CODES[np.frombuffer(m[0].encode(), np.uint8)]
        score = ratio[np.concatenate(([0], codes[:-1])), codes].sum()
        if score >= max(TOTAL, PER_CHARACTER * len(codes)):
            yield m.start(), m.end()


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end in code points) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))

    def search(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = []
            for text in batch.column(1).to_pylist():
                spans = [(s, k, e) for s, k, e, _ in base_spans(text or "")]
                taken = [(s, e) for s, _, e in spans]
                spans += [(s, 3, e) for s, e in random_spans(text or "", shared.value, taken)]
                found.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(spans)])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(search, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")
