"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent n-grams in order. A document's own list is compared to each profile by the
out-of-place distance: how far every n-gram stands from its place in the profile, the full length of the list where it is
missing. The nearest profile names the language.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
#: n-grams have one to three letters or blanks; profiles hold so many of them.
LONGEST, PROFILE_GRAMS = 3, 400
CHAR_BITS = 21
#: Distinct n-grams that a task gathers before it passes its counts on.
FLUSH_GRAMS = 1_000_000

_folded: np.ndarray | None = None


def _folding() -> np.ndarray:
    """Code point to its lower-case letter, anything that is no letter to a blank."""
    global _folded
    if _folded is None:
        _folded = np.full(sys.maxunicode + 1, 32, np.uint32)
        for code in range(sys.maxunicode + 1):
            c = chr(code)
            if c.isalpha():
                _folded[code] = ord(c.lower()[0])
    return _folded


def grams(text: str | None) -> np.ndarray:
    """All n-grams of a whole text, as numbers; empty if it has no letter.

    Letters in lower case; whatever stands between words is one blank, also before the first and after the last word. Blanks alone
    and n-grams with a blank inside are left out.
    """
    codes = _folding()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")]
    codes = np.concatenate([[32], codes, [32]])
    blank = codes == 32
    codes = codes[np.append(True, ~(blank[1:] & blank[:-1]))]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    c = codes.astype(np.int64)
    blank = c == 32
    two = c[:-1] << CHAR_BITS | c[1:]
    three = two[:-1] << CHAR_BITS | c[2:]
    return np.concatenate([c[~blank], two, three[~blank[1:-1]]])


def ranked(values: np.ndarray, counts: np.ndarray, size: int = PROFILE_GRAMS) -> np.ndarray:
    """The ``size`` most frequent values in order; ties by value."""
    if len(values) > size:
        least = np.partition(counts, -size)[-size]
        kept = counts >= least
        values, counts = values[kept], counts[kept]
    return values[np.lexsort((values, -counts))][:size]


@dataclass(frozen=True)
class Profiles:
    """Profiles of the learned languages: known n-grams in ascending order, and for each its place in every language."""

    langs: tuple[str, ...]
    grams: np.ndarray
    places: np.ndarray
    size: int

    @classmethod
    def of(cls, lists: dict[str, np.ndarray], size: int) -> Profiles:
        langs = tuple(sorted(lists))
        known = np.unique(np.concatenate([lists[x] for x in langs])) if langs else np.zeros(0, np.int64)
        places = np.full((len(known) + 1, len(langs)), -1, np.int64)  # the last row is for unknown ones
        for j, lang in enumerate(langs):
            places[np.searchsorted(known, lists[lang]), j] = np.arange(len(lists[lang]))
        return cls(langs, known, places, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language at the least distance (ties: the first by name), and 1 − its distance as a share of the largest."""
        found = grams(text)
        if not len(found) or not self.langs:
            return UNKNOWN, 0.0
        own = ranked(*np.unique(found, return_counts=True), self.size)
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == own, at, len(self.grams))
        there = self.places[at]
        away = np.where(there < 0, self.size, np.abs(there - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(away))
        return self.langs[best], float(1 - away[best] / (self.size * len(own)))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts of n-grams by language; each batch is sorted once, the sums pass on when they grow long."""

    def frame(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        parts = [pd.DataFrame({"lang": lang, "gram": g, "n": n}) for lang, (g, n) in held.items()]
        return pd.concat(parts) if parts else pd.DataFrame({"lang": [], "gram": [], "n": []})

    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            # Blocks of texts, so that a block's n-grams stay a few megabytes.
            block, size = [], 0
            for i, text in enumerate(texts, 1):
                block.append(text)
                size += len(text or "")
                if size < 1_000_000 and i < len(texts):
                    continue
                found, n = np.unique(np.concatenate([grams(t) for t in block]), return_counts=True)
                block, size = [], 0
                if lang in held:
                    found, where = np.unique(np.concatenate([held[lang][0], found]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([held[lang][1], n])).astype(np.int64)
                held[lang] = found, n
        if sum(len(g) for g, _ in held.values()) > FLUSH_GRAMS:
            yield frame(held)
            held = {}
    if held:
        yield frame(held)


def learn(docs: DataFrame, size: int = PROFILE_GRAMS) -> Profiles:
    """Profiles from all rows of ``docs`` (text, lang) with a language.

    n-grams are counted over all whole texts: a task passes on sums, which meet per (language, n-gram). Only the profiles, ``size``
    rows for each language, reach the driver.
    """
    known = docs.filter(F.col("lang").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    sums = known.mapInPandas(_counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = sums.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
    rows = top.toPandas().sort_values(["lang", "place"])
    return Profiles.of({lang: part["gram"].to_numpy() for lang, part in rows.groupby("lang")}, size)


def language(text: Column, profiles: Profiles) -> Column:
    """A struct (lang, score) for a text column; ``und`` and 0 for a text that is null or has no letter."""

    @F.pandas_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang", "score"])

    return predict(text)
