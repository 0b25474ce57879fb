"""Toxicity by multiple-instance learning.

Only documents have labels; sentences do not. Each sentence gets a probability from its words, a document the noisy-or of its
sentences (toxic unless no sentence is), and the weights of the words are those under which the document labels are likeliest.
The sentences that carry the score are then the offending ones.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborlog.llm.common import columns, held_out

#: The sample of labelled rows that a model is fitted on holds about so many rows, drawn by a hash of the id.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
#: Words are hashed to so many features; those on fewer documents of the sample, or with a smaller |z|, get no weight.
FEATURE_BITS, MIN_DOCS, MIN_Z = 20, 4, 4.0
MAX_FEATURES = 20_000
ROUNDS, RATE, DECAY = 300, 0.1, 1e-5
REMEMBERED = 400_000
#: Longer words also count by their first letters, so that inflected forms learn from each other.
STEM_LETTERS = 5

# A sentence ends at its marks or at a line break; white space before the next one belongs to neither.
_pieces = re.compile(r"[^\W\d_]+|[.!?\n]")
_sentence = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")


def feature(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << FEATURE_BITS) - 1)


def word_features(word: str) -> tuple[int, ...]:
    """Of a word, and of its stem if it is longer than one."""
    return (feature(word), feature(word[:STEM_LETTERS] + "*")) if len(word) > STEM_LETTERS else (feature(word),)


@dataclass(frozen=True)
class Model:
    """Weights of hashed words, and as logits what they add to in a sentence and the score of a sentence without any of them.

    The latter is the bias unless given; trained models give minus infinity, so that no text is toxic by its length.
    """

    features: np.ndarray
    weights: np.ndarray
    bias: float
    plain: float | None = None

    def lookup(self) -> dict[int, float]:
        return dict(zip(self.features.tolist(), self.weights.tolist()))


class Scorer:
    """Scores whole texts; remembers the weights of the words it has met."""

    def __init__(self, model: Model):
        known = model.lookup()

        class Words(dict):
            def __missing__(self, word: str) -> float:
                found = self[word] = math.nan if word in ".!?\n" else sum(known.get(f, 0.0) for f in word_features(word))
                return found

        self.words, self.bias = Words(), model.bias
        # What a sentence adds to the log of "none is toxic" if no word of it has a weight.
        self.plain = -float(np.logaddexp(0, model.bias if model.plain is None else model.plain))

    def sentences(self, text: str) -> tuple[np.ndarray, int]:
        """Logits of the sentences whose words have weights above 0 in sum, in order, and the number of the others."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
        found = _pieces.findall(text.lower())
        if not found:
            return np.zeros(0), 0
        w = np.fromiter(map(self.words.__getitem__, found), np.float64, len(found))
        marks = np.isnan(w)
        number = np.cumsum(marks)
        spoken = np.unique(number[~marks])
        some = ~marks & (w != 0)
        if not some.any():
            return np.zeros(0), len(spoken)
        which, at = np.unique(number[some], return_inverse=True)
        total = np.bincount(at, w[some])
        speaks = total[total > 0]  # weights of nothing or less say no more than none
        return self.bias + speaks, len(spoken) - len(speaks)

    def score(self, text: str | None) -> float:
        """Noisy-or of all sentences; 0 for a null text or one without words."""
        if not text:
            return 0.0
        logits, others = self.sentences(text)
        none = others * self.plain - np.logaddexp(0, logits).sum()
        return float(-math.expm1(none))

    def offending(self, text: str | None, at_least: float) -> list[tuple[int, int, float]]:
        """(start, end, probability) in code points of the sentences with at least that probability."""
        out = []
        for m in _sentence.finditer(text or ""):
            logits, _ = self.sentences(m.group())
            if len(logits) and (p := float(np.exp(-np.logaddexp(0, -logits[0])))) >= at_least:
                out.append((m.start(), m.end(), p))
        return out


def _sentence_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document's words by sentence: feature numbers with the sentence's number above them, each once."""
    for batch in batches:
        rows = []
        for text in batch["text"]:
            found = _pieces.findall((text or "").lower())
            at, keys = 0, set()
            for piece in found:
                if piece in ".!?\n":
                    at += 1
                else:
                    keys.update(at << FEATURE_BITS | f for f in word_features(piece))
            rows.append(np.array(sorted(keys), np.int64))
        yield pd.DataFrame({"toxic": batch["toxic"], "words": rows})


def _fit(docs: pd.DataFrame) -> Model:
    """Weights by gradient on the noisy-or likelihood, from a start at the words' log odds."""
    y = docs["toxic"].to_numpy(np.float64)
    if not len(y) or y.min() == y.max():  # nothing to tell apart
        return Model(np.zeros(0, np.int64), np.zeros(0), -8.0, -math.inf)
    size, mask = 1 << FEATURE_BITS, (1 << FEATURE_BITS) - 1
    n, toxic = np.zeros(size), np.zeros(size)
    for keys, label in zip(docs["words"], y):
        has = np.unique(np.asarray(keys, np.int64) & mask)
        n[has] += 1
        toxic[has] += label
    share, rows = y.mean(), len(y)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = (toxic - n * share) / np.sqrt(n * share * (1 - share) * (1 - n / rows) + 1e-9)
    z[n < MIN_DOCS] = 0
    chosen = np.flatnonzero(np.abs(z) >= MIN_Z)
    chosen = np.sort(chosen[np.argsort(-np.abs(z[chosen]), kind="stable")[:MAX_FEATURES]])
    place = np.full(size, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    # Of each document the sentences with a chosen word, numbered through. The others have probability 0, as has a
    # sentence while its weights add to nothing or less.
    columns, rows_of, own, used = [], [], [], 0
    for d, keys in enumerate(docs["words"]):
        keys = np.asarray(keys, np.int64)
        number, at = keys >> FEATURE_BITS, place[keys & mask]
        names, where = np.unique(number[at >= 0], return_inverse=True)
        columns.append(at[at >= 0])
        rows_of.append(where + used)
        own.append(np.full(len(names), d))
        used += len(names)
    column, row, own = np.concatenate(columns), np.concatenate(rows_of), np.concatenate(own)
    odds = np.log((toxic[chosen] + 0.5) / (n[chosen] - toxic[chosen] + 0.5)) - math.log(share / (1 - share))
    theta = np.append(np.clip(odds, -2, 4), -4.0)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    best, least = theta, math.inf
    for step in range(1, ROUNDS + 1):
        total = np.bincount(row, theta[column], minlength=used)
        logit = np.where(total > 0, theta[-1] + total, -np.inf)
        none = -np.bincount(own, np.logaddexp(0, logit), minlength=rows)
        none = np.minimum(none, -1e-12)
        some = -np.expm1(none)
        loss = -(y * np.log(some) + (1 - y) * none).mean() + DECAY * np.abs(theta[:-1]).sum() / 10 + DECAY * (theta[:-1] ** 2).sum() / 2
        if loss < least:
            best, least = theta.copy(), loss
        pull = (1 - y) - y * np.exp(none) / some  # slope of the loss in -none
        p = np.exp(-np.logaddexp(0, -logit))
        at = pull[own] * p
        slope = np.append(np.bincount(column, at[row], minlength=len(chosen)), at.sum()) / rows
        slope[:-1] += DECAY * theta[:-1] + DECAY / 10 * np.sign(theta[:-1])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta = theta - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(chosen, best[:-1], float(best[-1]), -math.inf)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the documents (doc_id, text) whose ``labels`` (doc_id, toxic) are not null and which are not held out.

    Fitted in one task on a sample of about ``sample_rows`` labelled rows, drawn by a hash of the id whatever the size of the
    table; with no more rows than that all are taken. Of several labels of one id the largest counts. Without labels, or with one
    kind only, no word gets a weight.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
    share = min(1.0, sample_rows / max(1, known.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(24)), F.lit(1 << 30))
    sample = docs.select("doc_id", "text").join(known.filter(draw < int(share * (1 << 30))), "doc_id").select("text", "toxic")
    words = sample.mapInPandas(_sentence_features, "toxic double, words array<bigint>")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        model = _fit(pd.concat(parts) if parts else pd.DataFrame({"toxic": [], "words": []}))
        yield pd.DataFrame({"features": [model.features], "weights": [model.weights], "bias": [model.bias], "plain": [model.plain]})

    schema = "features array<bigint>, weights array<double>, bias double, plain double"
    row = words.repartition(1).sortWithinPartitions("toxic", "words").mapInPandas(fit, schema).first()
    # An empty sample may have no task at all.
    return Model(np.array(row.features, np.int64), np.array(row.weights), row.bias, row.plain) if row else _fit(pd.DataFrame({"toxic": [], "words": []}))


def scored(docs: DataFrame, model: Model, at_least: float = THRESHOLD) -> DataFrame:
    """``docs`` as (_doc: its columns, score, offending: start, end and probability of sentences).

    A null text, and one without words, has score 0 and no offending sentence. Sentences are located only in texts that reach
    the threshold.
    """
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("probability", T.DoubleType())])
    out = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("offending", T.ArrayType(span))])

    @F.pandas_udf(out)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for texts in batches:
            scores = [scorer.score(t) for t in texts]
            found = [scorer.offending(t, at_least) if s >= at_least else [] for t, s in zip(texts, scores)]
            yield pd.DataFrame({"score": scores, "offending": [[{"start": a, "end": b, "probability": p} for a, b, p in f] for f in found]})

    return docs.select(F.struct(*columns(docs.columns)).alias("_doc"), score(F.col("text")).alias("s")).select("_doc", "s.score", "s.offending")


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, all columns."""
    return scored(docs, train(docs, labels), threshold).filter(F.col("score") < threshold).select("_doc.*")
