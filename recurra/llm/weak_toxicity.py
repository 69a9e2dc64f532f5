"""Toxicity by weak supervision.

Voters: lexicons (words, and word beginnings of several lengths, that labelled training texts show to
be typical of either class) and patterns (shouting, runs of exclamation marks, insults in the second
person). Each voter says toxic, clean or nothing. How often each combination of votes occurs in all
training documents is all a generative label model needs: expectation-maximisation estimates each
voter's accuracy and the share of toxic texts without labels; voters that still agree more than
these explain are correlated, and share their say. Its posterior for a text is the training label
of a linear classifier over words and word beginnings, which gives the scores.

Bounds: words are learned from at most about ``MAX_LABELLED`` labelled training rows (all, if there are
fewer), and at most ``MAX_FEATURES`` of them are kept; with nine voters there are at most 3 ** 9
combinations of votes. Scores use whole texts.

Defined cases: null and empty texts have no words and get the score of the intercept; without any
labelled rows, or with one class only, every score is the share of that class (0 without labels);
rows without id are not held out and never learned from; several labels of one id count as its
largest; repeated rows are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MAX_LABELLED = 20_000
MAX_FEATURES = 4096
STARTS = (4, 5, 6, 7)
LEAST_ODDS = 150.0
WORD = re.compile(r"[^\W\d_]+")
SHOUT = re.compile(r"\b[A-Z]{4,}\b")
MARKS = re.compile(r"!{3,}|\?!|!\?")
SECOND = re.compile(r"\b(?:you|your|tu|vous|du|ihr|eres)\b", re.I)
VOTERS = ("words", *(f"start{n}" for n in STARTS), "second", "shouting", "marks", "plain")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def features(word: str) -> list[str]:
    """A word and its beginnings; beginnings are marked and shorter than the word."""
    return [word, *(f"{word[:n]}*" for n in STARTS if len(word) > n)]


def _kind(feature: str) -> str:
    return f"start{len(feature) - 1}" if feature.endswith("*") else "words"


class Voters:
    """Lexicons of typical features and the patterns that go with them."""

    def __init__(self, lexicons: dict[str, set[str]]) -> None:
        self.lexicons = lexicons

    def votes(self, text: str) -> tuple[int, ...]:
        words = set(WORD.findall(text.lower()))
        found = [any(w in self.lexicons["words"] for w in words)]
        for n in STARTS:
            lexicon = self.lexicons[f"start{n}"]
            found.append(any(w[:n] + "*" in lexicon for w in words if len(w) > n))
        # A lexicon says nothing about a text without its words; that there are none at all is a vote.
        out = [int(x) for x in found]
        strong = any(found)
        letters = max(1, len(text))
        out.append(1 if strong and SECOND.search(text) else 0)
        out.append(1 if 40 * sum(map(len, SHOUT.findall(text))) > letters and strong else 0)
        out.append(1 if MARKS.search(text) and strong else 0)
        out.append(0 if strong else -1)
        return tuple(out)


def _mapped(rows: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function`` (a generator over lists of columns) applied to the batches of every partition."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(([c.to_pylist() for c in b.columns] for b in source)):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return rows.mapInArrow(run, schema)


def lexicons(labelled: DataFrame) -> dict[str, set[str]]:
    """Features that are typical of toxic training texts: frequent enough, and rarely in clean ones."""

    def count(batches) -> Iterator[list]:
        seen = (Counter(), Counter())
        texts = [0, 0]
        for text, toxic in batches:
            for t, label in zip(text, toxic, strict=True):
                texts[label] += 1
                seen[label].update({f for w in set(WORD.findall((t or "").lower())) for f in features(w)})
        every = list(seen[0].keys() | seen[1].keys())
        yield [["", *every], [texts[1], *(seen[1][f] for f in every)], [texts[0], *(seen[0][f] for f in every)]]

    counts = _mapped(labelled.select("text", "toxic"), count, "feature string, toxic long, clean long")
    sums = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    total = sums.where("feature = ''").first()
    out: dict[str, set[str]] = {k: set() for k in VOTERS[: 1 + len(STARTS)]}
    if not total or not total.toxic or not total.clean:
        return out
    odds = ((F.col("toxic") + 0.5) / (total.toxic + 1.0)) / ((F.col("clean") + 0.5) / (total.clean + 1.0))
    least = max(3, total.toxic // 200)
    typical = sums.where(f"feature <> '' AND toxic >= {least}").withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    for r in typical.orderBy(F.desc(F.log("odds") * F.sqrt("toxic")), "feature").limit(MAX_FEATURES).collect():
        out[_kind(r.feature)].add(r.feature)
    return out


class LabelModel:
    """Accuracies, class share and correlations of voters, from counts of vote combinations."""

    def __init__(self, combinations: list[tuple[tuple[int, ...], int]], share: float, steps: int = 50) -> None:
        votes = np.array([v for v, _ in combinations], np.int64)
        weight = np.array([n for _, n in combinations], float)
        self.tables = np.zeros((votes.shape[1], 2, 3))
        # To begin with, voters are right more often than not.
        self.tables[:, 1] = (0.2, 0.3, 0.5)
        self.tables[:, 0] = (0.5, 0.3, 0.2)
        self.share, self.say = share, np.ones(votes.shape[1])
        for step in range(steps):
            toxic = self.posterior(votes, silence=True)
            parts = np.stack([weight * (1 - toxic), weight * toxic])
            self.share = float(np.clip(parts[1].sum() / weight.sum(), 1e-4, 0.5))
            for j in range(votes.shape[1]):
                for y in (0, 1):
                    n = np.bincount(votes[:, j] + 1, parts[y], minlength=3) + 1.0
                    self.tables[j, y] = n / n.sum()
            if step % 10 == 9:
                self.say = self._shares(votes, parts)

    @staticmethod
    def _shares(votes: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """A voter's say: one, divided among the voters that agree with it beyond the classes."""
        extra = np.zeros((votes.shape[1],) * 2)
        for w in parts:
            mean = (w[:, None] * votes).sum(axis=0) / max(w.sum(), 1e-9)
            apart = votes - mean
            cover = (w[:, None] * apart).T @ apart / max(w.sum(), 1e-9)
            spread = np.sqrt(np.clip(np.diag(cover), 1e-9, None))
            extra += np.clip(cover / np.outer(spread, spread), 0, 1) * w.sum() / parts.sum()
        np.fill_diagonal(extra, 0)
        return 1 / (1 + np.where(extra > 0.1, extra, 0).sum(axis=1))

    def posterior(self, votes: np.ndarray, silence: bool = False) -> np.ndarray:
        """Chance that texts are toxic; silence of a voter tells classes apart only while these are estimated."""
        ratio = np.log(self.tables[:, 1]) - np.log(self.tables[:, 0])
        if not silence:
            ratio[:, 1] = 0
        score = np.log(self.share / (1 - self.share)) + sum(self.say[j] * ratio[j][votes[:, j] + 1] for j in range(len(ratio)))
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def classifier(texts: list[set[str]], labels: np.ndarray, vocabulary: list[str], rounds: int = 400) -> tuple[dict[str, float], float]:
    """Weights and intercept of a logistic regression on soft labels."""
    index = {f: k for k, f in enumerate(vocabulary)}
    row = np.concatenate([np.full(len(t), i) for i, t in enumerate(texts)] or [[]]).astype(np.int64)
    col = np.fromiter((index[f] for t in texts for f in sorted(t)), np.int64, len(row))
    weight, bias = np.zeros(len(vocabulary)), 0.0
    steps, bias_step = np.zeros(len(vocabulary)), 0.0
    for _ in range(rounds):
        score = bias + np.bincount(row, weight[col], minlength=len(texts))
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels) / len(texts)
        slope = np.bincount(col, error[row], minlength=len(vocabulary)) + 1e-6 * weight
        steps += slope**2
        bias_step += error.sum() ** 2
        weight -= 0.5 * slope / np.sqrt(steps + 1e-12)
        bias -= 0.2 * error.sum() / np.sqrt(bias_step + 1e-12)
    return {f: float(w) for f, w in zip(vocabulary, weight, strict=True) if w}, float(bias)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[str, float], float]:
    """Weights of features and the intercept, from training rows alone."""
    context = docs.sparkSession.sparkContext
    known = labels.groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").cast("int").alias("toxic")).where("toxic IS NOT NULL")
    known = known.where(F.col("_id").isNotNull() & ~held_out("_id"))
    share = min(1.0, MAX_LABELLED / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    learn = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    labelled = learn.join(F.broadcast(chosen), "_id").select("text", "toxic")
    balance = labelled.agg(F.count("*"), F.coalesce(F.avg("toxic"), F.lit(0.0))).first()
    if balance[1] in (0.0, 1.0):
        return {}, 30.0 if balance[1] else -30.0
    voters = Voters(lexicons(labelled))
    shared = context.broadcast(voters)

    def count(batches) -> Iterator[list]:
        seen = Counter()
        for (text,) in batches:
            seen.update(shared.value.votes(t or "") for t in text)
        yield [[list(v) for v in seen], list(seen.values())]

    votes = _mapped(learn.select("text"), count, "votes array<long>, n long").groupBy("votes").agg(F.sum("n").alias("n"))
    model = LabelModel(sorted((tuple(r.votes), r.n) for r in votes.collect()), balance[1])
    every = sorted(f for lexicon in voters.lexicons.values() for f in lexicon)

    def marked(batches) -> Iterator[list]:
        known = set(every)
        for text, _ in batches:
            sets = [sorted({f for w in set(WORD.findall((t or "").lower())) for f in features(w)} & known) for t in text]
            cast = np.array([shared.value.votes(t or "") for t in text], np.int64).reshape(-1, len(VOTERS))
            yield [sets, model.posterior(cast).tolist()]

    rows = _mapped(labelled, marked, "features array<string>, toxic double").collect()
    return classifier([set(r.features) for r in rows], np.array([r.toxic for r in rows]), every)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))

    def judge(batches) -> Iterator[list]:
        weights, bias = shared.value
        by_word: dict[str, tuple] = {}
        for ids, out, texts in batches:
            scores = []
            for text in texts:
                found = set()
                for word in set(WORD.findall((text or "").lower())):
                    if (hits := by_word.get(word)) is None:
                        if len(by_word) > 1 << 18:
                            by_word.clear()
                        hits = by_word[word] = tuple(f for f in features(word) if f in weights)
                    if hits:
                        found.update(hits)
                scores.append(1 / (1 + np.exp(-np.clip(bias + sum(weights[f] for f in sorted(found)), -30, 30))))
            yield [ids, out, np.array(scores, float)]

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    scored = _mapped(rows, judge, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
