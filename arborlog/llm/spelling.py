"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

Words lie in blocks of equal length and equal counts of five letter classes. One edit changes the length by at most one and the
class counts by at most one down and one up, so near words lie in one block or in neighbouring ones. A block's words meet each
neighbour's in NumPy products of their letter counts: |a|² + |b|² − 2ab is the squared distance, 1 after an insertion and 2 after a
replacement. Pairs at most two apart are verified letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlog.llm.common import written
from arborlog.session import broadcast_if_small

#: Letters: a to z, and U+00C0 to U+00FF. All have one byte in Latin-1.
_codes = [*range(97, 123), *range(0xC0, 0x100)]
_dimension = np.zeros(256, np.intp)
_dimension[_codes] = np.arange(len(_codes))
#: Letter classes by code; more classes make smaller blocks and more neighbours.
CLASSES = 5
#: Words of a block that are held together, and words that meet them at a time; fewer if they are long.
CHUNK = 2_048
CHUNK_LETTERS = 4_000_000
#: Chunks of one block that meet the same task.
CHUNKS_TOGETHER = 64
#: Words that a task counts before it passes them on.
HELD_WORDS = 300_000
#: Pairs that are verified at a time, in letters.
VERIFIED = 8_000_000

DELETE_EVERY = 31


def delete_some(doc_id: int | None, run: str) -> str:
    """``run`` without one letter, if 31 divides the crc32 of ``<doc_id>:<run>``: misspellings that a rerun makes again."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DELETE_EVERY:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def word_counts(docs: DataFrame, min_length: int = 7, min_count: int = 2, edit: Callable[[int | None, str], str] | None = None) -> DataFrame:
    """word, n: words of at least ``min_length`` letters with at least ``min_count`` occurrences in all texts of ``docs`` (doc_id, text).

    A word is a longest run of letters, A to Z in lower case. ``edit`` changes a document's word before it counts; it never makes it
    longer. Null and empty texts have no words. Repeated rows count again.
    """
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, min_length))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py()
                if not raw:
                    continue
                # Bytes turn to lower case in ASCII alone.
                found = Counter(pattern.findall(raw.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                for run, n in found.items():
                    held[edit(doc_id, run) if edit else run] += n
                if len(held) > HELD_WORDS:
                    yield _counted(held, min_length)
                    held.clear()
        if held:
            yield _counted(held, min_length)

    counts = docs.select("doc_id", "text").mapInArrow(count, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _counted(held: Counter[str], min_length: int) -> pa.RecordBatch:
    kept = [(w, n) for w, n in held.items() if len(w) >= min_length]
    return pa.record_batch([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])


def _class_counts(word: str) -> list[Column]:
    letters = ["".join(chr(c) for c in _codes if c % CLASSES == k) for k in range(CLASSES)]
    return [F.length(word) - F.length(F.translate(F.col(word), own, "")) for own in letters]


def _key(counts: list[Column]) -> Column:
    return F.concat_ws(".", *[c.cast("string") for c in counts])


def _smaller_neighbours(counts: list[Column]) -> Column:
    """The block itself, those of one letter less, and those of a letter less in one class and one more in a later class."""
    own = [F.struct(_key(counts).alias("at"), F.lit(True).alias("same"))]
    for g in range(CLASSES):
        for h in [None, *range(g + 1, CLASSES)]:
            moved = [c - 1 if i == g else c + 1 if i == h else c for i, c in enumerate(counts)]
            own.append(F.when(counts[g] > 0, F.struct(_key(moved).alias("at"), F.lit(False).alias("same"))))
    return F.filter(F.array(*own), lambda x: x.isNotNull())


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of all pairs of ``words`` (distinct word, n, class counts) one edit apart.

    The table must be stored, as it is read several times. Words of a large block are dealt to chunks; a task holds
    one chunk and streams past it what the neighbours have, 64 chunks of each of them at most.
    """
    counts = [F.col(f"c{k}") for k in range(CLASSES)]
    keyed = words.withColumn("block", _key(counts))
    load = F.greatest(F.lit(1.0), F.max(F.length("word")) * (CHUNK / CHUNK_LETTERS))
    blocks = keyed.groupBy("block").agg(F.ceil(F.count("*") * load / CHUNK).cast("int").alias("chunks"), *[F.first(c).alias(f"c{k}") for k, c in enumerate(counts)])
    blocks = written(blocks, "blocks")
    sides = blocks.select("chunks", F.explode(_smaller_neighbours(counts)).alias("n")).groupBy(F.col("n.at").alias("block"))
    spread = sides.agg(F.max("chunks").alias("most")).join(blocks.select("block", "chunks"), "block")
    spread = spread.select("block", "chunks", F.ceil(F.col("most") / CHUNKS_TOGETHER).cast("int").alias("slices"))
    small = broadcast_if_small(spread, blocks.count())
    chunk = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    keyed = keyed.join(small, "block").select("word", "n", "block", "slices", chunk.alias("chunk"), *counts)
    left = keyed.select("block", "chunk", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("role"), "word", "n")
    met = keyed.select("word", "n", F.floor(F.col("chunk") / CHUNKS_TOGETHER).cast("int").alias("slice"), F.explode(_smaller_neighbours(counts)).alias("to"))
    met = met.select("word", "n", "slice", F.col("to.at").alias("block"), F.when(F.col("to.same"), 1).otherwise(2).alias("role"))
    right = met.join(small.select("block", "chunks"), "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "slice", "role", "word", "n"
    )
    group = ["block", "chunk", "slice"]
    order = [*group, "role", "length"]
    meeting = left.unionByName(right).withColumn("length", F.length("word")).repartition(*group).sortWithinPartitions(*order)
    return meeting.select(*order, "word", "n").mapInArrow(_meet, "word string, near string, near_n bigint")


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows sorted by group, role and length: a group's chunk comes first and is held, all others stream past it."""
    group, chunk, held = None, [], None
    found: list[tuple[np.ndarray, ...]] = []
    pairs = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = batch.column(0).dictionary_encode()
        names = blocks.dictionary.to_pylist()
        keys = np.stack([blocks.indices.to_numpy(), *[batch.column(i).to_numpy() for i in range(1, 5)]])
        words, n = batch.column(5).to_numpy(zero_copy_only=False), batch.column(6).to_numpy()
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(words)]):
            block, number, slice_, role, length = keys[:, a].tolist()
            own = names[block], number, slice_
            if own != group:
                group, chunk, held = own, [], None
            if role == 0:
                chunk.append((words[a:b], n[a:b]))
                continue
            if not chunk:  # no word was dealt to this chunk
                continue
            if held is None:
                held = _Words(*(np.concatenate(c) for c in zip(*chunk)))
            step = max(1, min(CHUNK, CHUNK_LETTERS // length))
            for i in range(a, b, step):
                end = min(b, i + step)
                one, two, n_one, n_two = held.near(_Words(words[i:end], n[i:end]), role == 1)
                if len(one):
                    found.append((np.append(one, two), np.append(two, one), np.append(n_two, n_one)))
                    pairs += len(one)
        if pairs > 100_000:
            yield _links(found)
            found, pairs = [], 0
    if pairs:
        yield _links(found)


def _links(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [np.concatenate([f[i] for f in found]) for i in range(3)]
    return pa.record_batch([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["word", "near", "near_n"])


class _Words:
    """Words of one length, as letters and as letter counts."""

    def __init__(self, words: np.ndarray, n: np.ndarray):
        self.words, self.n = words, n
        codes = np.frombuffer("".join(self.words).encode("latin-1"), np.uint8)
        self.letters = codes.reshape(len(self.words), -1)
        width = len(_codes)
        at = np.repeat(np.arange(len(self.words)) * width, self.letters.shape[1]) + _dimension[codes]
        self.counts = np.bincount(at, minlength=len(self.words) * width).reshape(-1, width).astype(np.float32)
        self.squares = (self.counts**2).sum(axis=1)

    def near(self, other: _Words, same_block: bool) -> tuple[np.ndarray, ...]:
        """Pairs one edit apart: own words, other words and their counts. Of one block's pairs, those in order only."""
        apart = self.squares[:, None] + other.squares - 2 * (self.counts @ other.counts.T)
        i, j = np.nonzero(apart <= 2)
        step = max(1, VERIFIED // max(1, self.letters.shape[1]))
        good = [_one_edit(self.letters[i[k : k + step]], other.letters[j[k : k + step]]) for k in range(0, len(i), step)]
        good = np.concatenate(good) if good else np.zeros(0, bool)
        i, j = i[good], j[good]
        one, two = self.words[i], other.words[j]
        if same_block and len(i):
            forward = (one < two).astype(bool)
            i, j, one, two = i[forward], j[forward], one[forward], two[forward]
        return one, two, self.n[i], other.n[j]


def _one_edit(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which pairs of words, the second as long as the first or one letter longer, differ by exactly one edit."""
    length = one.shape[1]
    if two.shape[1] == length:
        return (one != two).sum(axis=1) == 1
    ahead, behind = one != two[:, :length], one != two[:, 1:]
    prefix = np.where(ahead.any(axis=1), ahead.argmax(axis=1), length)
    suffix = np.where(behind.any(axis=1), behind[:, ::-1].argmax(axis=1), length)
    return prefix + suffix >= length


def spelling_forms(words: DataFrame, factor: int = 10) -> DataFrame:
    """word, n, n_near, form, form_n, root of distinct ``words`` (word, n), all of them of the letters a to z and U+00C0 to U+00FF.

    n_near counts the words that differ by exactly one inserted, deleted or replaced letter. ``form`` is the one of largest n
    (ties: the smallest), if that n is at least ``factor`` times the word's, else null; ``root`` follows forms to the last, and is the word
    itself without one. n grows with each step, so no chain is long and none is closed. Null words are left out.
    """
    counts = {f"c{k}": c.cast("int") for k, c in enumerate(_class_counts("word"))}
    words = written(words.filter("word IS NOT NULL").select("word", "n").withColumns(counts), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near")))
    near = written(near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")), "near")
    rows = words.select("word", "n").join(near, "word", "left")
    is_form = -F.col("best.minus_n") >= F.col("n") * factor
    rows = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.minus_n")).alias("form_n"),
    )
    rows = written(rows, "forms")
    roots = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        # Each round doubles the steps that a root is away.
        roots = written(roots, "roots")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = roots.join(further, "root", "left")
        if joined.filter("further IS NOT NULL").isEmpty():
            break
        roots = joined.select("word", F.coalesce("further", "root").alias("root"))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
