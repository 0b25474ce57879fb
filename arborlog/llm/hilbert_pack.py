"""Packing along a space-filling curve.

A document's hashed term vector is projected to a few dimensions, its cell there gives a Hilbert key, and documents are put in
the order of their keys. Sequences are cut from that order, so a sequence holds documents that lie near each other.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlog.llm.tokens import BYTES_PER_ID, token_stream, tokenizer_path

END_ID = 1
SEQUENCE_IDS = 2048
#: Hashed features, dimensions of the projection and bits of each coordinate.
FEATURES, DIMENSIONS, COORDINATE_BITS = 1024, 8, 7
SEED = 17
#: Texts whose vectors stand side by side.
TOGETHER = 500
#: Terms of a long text that are hashed together.
PIECES = 1 << 20
#: Bits of a hash of the id, which stand after the key and spread copies of one text over ranges.
SPREAD_BITS = 11
#: Rows of a range of the curve, and rows a range that are looked at to place the bounds; tables of over 100,000 such ranges get
#: larger ones instead.
RANGE_ROWS, BOUND_ROWS, MAX_RANGES = 5_000, 100, 100_000


def hashed_counts(text: str | None, features: int = FEATURES) -> np.ndarray:
    """How often each hashed term occurs in a whole text; a term is four bytes from any byte on, blanks after the last."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower() + b"   "
    pieces = np.ndarray(len(raw) - 3, "<u4", raw, strides=(1,))
    counts = np.zeros(features, np.int64)
    for i in range(0, len(pieces), PIECES):
        # The high bits of a product by an odd number depend on all four bytes.
        hashed = (pieces[i : i + PIECES] * np.uint32(2654435761)) >> np.uint32(32 - int(math.log2(features)))
        counts += np.bincount(hashed, minlength=features)
    return counts


def projection(features: int = FEATURES, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """Random directions; the same for every task and run."""
    return np.random.default_rng(seed).standard_normal((features, dimensions))


def hilbert_keys(cells: np.ndarray, bits: int = COORDINATE_BITS) -> np.ndarray:
    """The places of cells (one a row) on the Hilbert curve through a cube of ``2 ** bits`` cells a side.

    The coordinates are turned, from the highest bit down, into the curve's own axes; their bits in turn, freed of the Gray
    code, are the key.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(n):
            high = x[i] >> bit & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    shift = 1
    while shift < n * bits:
        key ^= key >> shift
        shift <<= 1
    return key


def curve_keys(texts, bits: int = COORDINATE_BITS) -> np.ndarray:
    """Hilbert keys of texts: their vectors, damped by a square root, taken from their mean and brought to length 1, are projected.

    Coordinates go through a sigmoid, so that cells are about evenly used.
    """
    directions = projection()
    keys = []
    for i in range(0, len(texts), TOGETHER):
        vectors = np.sqrt(np.stack([hashed_counts(t) for t in texts[i : i + TOGETHER]]))
        vectors -= vectors.mean(axis=1, keepdims=True)  # long texts have all terms, and this part in common
        along = vectors @ directions / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)  # no term: the middle
        cells = np.floor((1 << bits) / (1 + np.exp(-1.7 * along))).astype(np.int64)
        keys.append(hilbert_keys(np.minimum(cells, (1 << bits) - 1), bits))
    return np.concatenate(keys) if keys else np.zeros(0, np.int64)


def range_numbers(keys: np.ndarray, spread: np.ndarray, bound_keys: np.ndarray, bound_spread: np.ndarray) -> np.ndarray:
    """How many bounds, ascending pairs of key and hash, are at or below each pair. The pairs have more bits than a number."""
    distinct, which = np.unique(bound_keys, return_inverse=True)
    at = np.searchsorted(distinct, keys)
    # Between two bound keys an even number, at one an odd number.
    equal = np.append(distinct, -1)[at] == keys
    pairs = (2 * at + equal << SPREAD_BITS) + np.where(equal, spread, 0)
    return np.searchsorted((2 * which + 1 << SPREAD_BITS) + bound_spread, pairs, side="right")


def _placed(bound_keys: np.ndarray, bound_spread: np.ndarray):
    """The key of a text, and the number of its range."""

    @F.pandas_udf("key bigint, part int")
    def placed(texts: pd.Series, spread: pd.Series) -> pd.DataFrame:
        keys = curve_keys(texts.tolist())
        return pd.DataFrame({"key": keys, "part": range_numbers(keys, spread.to_numpy(np.int64), bound_keys, bound_spread)})

    return placed


def pack(docs: DataFrame, path: str | None = None, length: int = SEQUENCE_IDS, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents of ``docs`` (doc_id, text) in sequences of ``length`` ids.

    Columns: doc_id, start (ids of its document before the piece), length, ids (little-endian unsigned 32-bit integers),
    doc_tokens (ids of the document, its end included), sequence_id, offset (place in the sequence). Documents follow each
    other along the curve, copies by a hash of the id, then by id and a hash of the text; sequences are cut from that order without a gap: all are full but the last.
    A null or empty text is its end id alone; repeated rows are packed each; an empty table gives no piece. Copies share a key, so
    the hash of the id is part of the order and no range holds all copies.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << SPREAD_BITS)).alias("spread")
    rows = plain.count()
    ranges = max(1, -(-rows // max(RANGE_ROWS, -(-rows // MAX_RANGES))))
    # The bounds decide how even the ranges are, never the order.
    none = np.zeros(0, np.int64)
    few = plain.sample(min(1.0, BOUND_ROWS * ranges / max(1, rows)), seed=SEED) if ranges > 1 else plain.limit(0)
    seen = few.select(_placed(none, none)("text", spread)["key"].alias("key"), spread).toArrow()
    seen = np.stack([seen["key"].to_numpy(), seen["spread"].to_numpy()]).astype(np.int64)
    seen = seen[:, np.lexsort((seen[1], seen[0]))]
    steps = np.arange(1, ranges) * seen.shape[1] // ranges if seen.shape[1] else none
    bounds = np.unique(seen[:, steps], axis=1)
    keyed = plain.select("doc_id", "text", spread, F.xxhash64("text").alias("tie"), _placed(*bounds)("text", spread).alias("placed"))
    ranged = keyed.select("placed.part", "placed.key", "spread", "doc_id", "text", "tie").repartition("part")
    tokens = token_stream(ranged.sortWithinPartitions("part", "key", "spread", "doc_id", "tie"), end_id, path or tokenizer_path())
    end = F.col("start") + F.col("n_ids")
    first, last = F.floor(F.col("start") / length), F.floor((end - 1) / length)
    cut = tokens.withColumn("sequence_id", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("sequence_id") * length)
    size = F.least(end, (F.col("sequence_id") + 1) * length) - begin
    offset = begin - F.col("start")
    return cut.select(
        "doc_id",
        offset.alias("start"),
        size.alias("length"),
        F.substring("ids", (offset * BYTES_PER_ID + 1).cast("int"), (size * BYTES_PER_ID).cast("int")).alias("ids"),
        F.col("n_ids").alias("doc_tokens"),
        "sequence_id",
        (begin - F.col("sequence_id") * length).alias("offset"),
    )
