"""Operator 3: toxicity by maximum-scoring segments.

Labelled documents give every word a log-odds of standing in a toxic document, with Dirichlet priors: a
word's prior is what its prefix shows, that prefix's prior is the shorter one's, so that a word never
seen has the score of its stem. A linear-time scan over these scores finds all maximal scoring passages
of a text. Scores of the best passages in clean texts follow an extreme-value law that depends on the
text's length; against it every passage has an expected number of equally good ones by chance, and the
significant ones together make the document's score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventflow.llm.common import BoundedCache, append_columns, arrow_batch, struct, text_or_empty, written

#: Labelled documents the model is fitted on, at most: those whose ids have the smallest hashes.
TRAINING = 20_000
#: Of ten of these, so many give word counts; the others fit the extreme-value law and the final weights.
COUNTING = 7
#: A word or a prefix says something by itself if so many of the labelled documents have it.
SUPPORT = 3
PREFIXES = (3, 4, 5, 6)
#: Weight of a prior, in documents.
PRIOR = 2.0
#: Cost of a word inside a passage, and log-odds that are taken as none.
DRIFT, NOISE = 0.25, 1.5
#: Log-odds are not trusted beyond this: the prefixes of a word are not independent evidence.
CERTAIN = 8.0
#: A passage counts if fewer than so many as good are expected by chance in a clean text of that length.
SIGNIFICANT = 0.05
WORD = re.compile(r"\w+")
CACHE_WORDS = 200_000


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, stop, score), in linear time.

    A segment is maximal if no part of it scores higher and none around it is a segment of that kind.
    """
    sums = list(accumulate(scores, initial=0.0))
    found: list[tuple[int, int, float, float, int]] = []  # start, stop, sum before, sum behind, earlier with less before
    for i, s in enumerate(scores):
        if s <= 0:
            continue
        start, stop, before, behind = i, i + 1, sums[i], sums[i + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= behind:
                found.append((start, stop, before, behind, j))
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, y - x) for a, b, x, y, _ in found]


class Model:
    """Word scores, the extreme-value law of clean texts, and the weights of the final score."""

    def __init__(self, counts: dict[str, tuple[int, int]], toxic: int, clean: int):
        base = (toxic + 1) / (toxic + clean + 2)
        self.base = math.log(base / (1 - base))
        self.scores: dict[str, float] = {}
        self.cache = BoundedCache(CACHE_WORDS)
        self.rate, self.scale, self.weights = 1.0, 1.0, np.zeros(4)
        odds = {}
        for key, (t, c) in counts.items():
            if not t:
                odds[key] = 0.0  # what only clean documents have speaks for nothing, whatever its stem does
                continue
            mean = base
            for size in PREFIXES:
                prefix = key[:size] + "*"
                if size < len(key.rstrip("*")) + key.endswith("*") and prefix != key and prefix in counts:
                    pt, pc = counts[prefix][0] - t, counts[prefix][1] - c  # without the word itself
                    mean = (max(0, pt) + PRIOR * mean) / (max(0, pt) + max(0, pc) + PRIOR)
            share = (t + PRIOR * mean) / (t + c + PRIOR)
            odds[key] = min(CERTAIN, math.log(share / (1 - share)) - self.base)
        # what scores as its stem does need not be in the table every task gets
        for key in sorted(odds, key=lambda k: (not k.endswith("*"), len(k), k)):
            own = odds[key] if abs(odds[key]) >= NOISE else 0.0
            if own != self._inherited(key.rstrip("*")):
                self.scores[key] = own

    def _inherited(self, word: str) -> float:
        for size in reversed(PREFIXES):
            if size < len(word) and (found := self.scores.get(word[:size] + "*")) is not None:
                return found
        return 0.0

    def odds(self, word: str) -> float:
        found = self.scores.get(word)
        return self._inherited(word) if found is None else found

    def word_scores(self, tokens: list[str]) -> list[float]:
        known = self.cache
        fresh = {w: (o if abs(o := self.odds(w)) >= NOISE else 0.0) - DRIFT for w in set(tokens) if w not in known}
        if fresh:
            scores = [known[w] if w in known else fresh[w] for w in tokens]
            known.add(fresh)
            return scores
        return list(map(known.__getitem__, tokens))

    def best(self, tokens: list[str]) -> float:
        return max((s for *_, s in segments(self.word_scores(tokens))), default=0.0)

    def expected(self, score: float, length: int) -> float:
        """Segments of at least that score to expect in a clean text of that many words."""
        return self.scale * max(1, length) * math.exp(-self.rate * min(score, 700 / self.rate))

    def fit_law(self, clean: list[tuple[int, float]]) -> None:
        """The extreme-value law from lengths and best scores of clean texts.

        From two quantiles, so that a few texts labelled wrongly do not bend it.
        """
        some = [(n, s) for n, s in clean if n > 0]
        if len(some) < 10:
            return
        logs, best = np.log([n for n, _ in some]), np.array([s for _, s in some])
        middle, upper = 0.5, 0.9
        gap = math.log(-math.log(middle)) - math.log(-math.log(upper))
        for _ in range(50):
            low, high = np.quantile(best - logs / self.rate, [middle, upper])
            self.rate = float(np.clip(0.5 * self.rate + 0.5 * gap / max(high - low, 1e-3), 0.2, 4.0))
        self.scale = float(np.exp(self.rate * np.quantile(best - logs / self.rate, middle)) * -math.log(middle))

    def passages(self, tokens: list[str]) -> list[tuple[int, int, float, float]]:
        """(start, stop, score, expected by chance) of every significant passage, in words."""
        n = len(tokens)
        found = ((a, b, s, self.expected(s, n)) for a, b, s in segments(self.word_scores(tokens)))
        return [p for p in found if p[3] < SIGNIFICANT]

    def features(self, passages: list[tuple[int, int, float, float]]) -> list[float]:
        surprise = [min(50.0, -math.log(max(p[3], 1e-300))) for p in passages]
        return [1.0, math.log1p(sum(surprise)), min(60.0, sum(surprise)) / 10, math.log1p(len(surprise))]

    def fit_weights(self, rows: list[list[float]], labels: list[int]) -> None:
        """Logistic regression with a small ridge, by Newton's steps."""
        if not rows:
            return
        x, y = np.array(rows), np.array(labels, float)
        w = np.zeros(x.shape[1])
        ridge = np.diag([1e-3, *[0.02] * (x.shape[1] - 1)])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def score(self, passages: list[tuple[int, int, float, float]]) -> float:
        z = float(np.dot(self.weights, self.features(passages)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          training: int = TRAINING) -> Model:
    """The model from labelled documents; give only rows that may be learned from.

    Of the rows with a label, `training` are used at most. Several labels of a document count as toxic if
    one is; null labels and null ids are no labels; equal texts count once. With no labelled documents,
    or only one class, every text has the same score.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("__id"), "__id").limit(training)
    )
    sample = written(
        docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("__text"))
        .join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
        .groupBy(text_or_empty("__text").alias("text")).agg(F.max("y").alias("y"), F.min("__id").alias("id"))
        .select("text", "y", F.pmod(F.xxhash64("id"), F.lit(10)).cast("int").alias("fold")),
        "labelled", slim=True,
    )
    counting, fitting = sample.where(F.col("fold") < COUNTING), sample.where(F.col("fold") >= COUNTING)

    schema = struct("word string, t bigint, c bigint")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[0 if y else 1].update(set(words(t)))
        every = list(seen[0].keys() | seen[1].keys())
        yield arrow_batch({"word": every, "t": [seen[0][w] for w in every], "c": [seen[1][w] for w in every]}, schema)

    by_word = written(
        counting.select("text", "y").mapInArrow(count, schema).groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")),
        "words", slim=True,
    )
    stems = F.array(*[F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in PREFIXES])
    prefixes = (
        by_word.select(F.explode(stems).alias("word"), "t", "c").where("word IS NOT NULL")
        .groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    )
    strong = by_word.unionByName(prefixes).where(F.col("t") + F.col("c") >= SUPPORT)
    size = {r.y: r.n for r in counting.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rows = strong.collect()  # bounded by the words that SUPPORT of the `training` documents share
    model = Model({r.word: (r.t, r.c) for r in rows}, size.get(1, 0), size.get(0, 0))

    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    measured = struct("y int, n bigint, best double")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [words(t) for t in batch.column(0).to_pylist()]
            yield arrow_batch({"y": batch.column(1), "n": list(map(len, tokens)),
                               "best": list(map(broadcast.value.best, tokens))}, measured)

    clean = fitting.where("y = 0").select("text", "y").mapInArrow(best, measured).collect()
    model.cache.clear()
    model.fit_law([(r.n, r.best) for r in clean])
    again = docs.sparkSession.sparkContext.broadcast(model)
    fitted = struct("y int, x array<double>")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield arrow_batch({"y": batch.column(1), "x": [again.value.features(again.value.passages(words(t)))
                                                           for t in batch.column(0).to_pylist()]}, fitted)

    rows = fitting.select("text", "y").mapInArrow(features, fitted).collect()
    model.fit_weights([r.x for r in rows], [r.y for r in rows])
    return model


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df with `score` (0 to 1, higher: toxic likelier) and `passages`, an array of (start, stop, words,
    value, expected): character range, number of words, score, and how many as good chance would give.

    Only the whole text is looked at. Null and empty texts have the score of a text without passages.
    Repeated rows stay, empty tables stay empty, and input columns of those names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value

        def one(value: str):
            found = own.passages(words(value))
            spans = [m.span() for m in WORD.finditer(value.lower())] if found else []
            return own.score(found), [
                {"start": spans[a][0], "stop": spans[b - 1][1], "words": b - a, "value": s, "expected": e}
                for a, b, s, e in found
            ]

        def work(batch):
            rows = [one(t or "") for t in batch.column(text).to_pylist()]
            return {"score": [r[0] for r in rows], "passages": [r[1] for r in rows]}

        return work

    return append_columns(
        df, start,
        "score double, passages array<struct<start: bigint, stop: bigint, words: bigint, value: double, expected: double>>",
    )
