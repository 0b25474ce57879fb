"""Phrase collocation mining by stripes.

A stripe is a prefix of words with a counter of the words that follow it. Tasks count stripes of their texts, and the stripes of a prefix
are merged element by element: an element is a row while it is summed, so a hot prefix is spread over all tasks and combines before
the shuffle. All statistics come from the merged stripes: an element is the count of the extended phrase, elements of
shorter prefixes are the totals of prefixes and rests, the empty prefix counts all words, and the greatest elements say which
phrases a longer one stands for.

Only phrases that are frequent enough are extended. A bit filter of fixed size says which may be; a wrong yes
costs a row in the shuffle and never changes a count.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arborlog.llm.common import written

#: Bits of the filter: 8 MB, whatever the corpus. Two bits are set for each frequent phrase.
FILTER_BITS = 26
#: Bytes of text that a task counts at a time; a longer text is taken in parts that end with a piece.
PART_BYTES = 8_000_000
#: Rows of a batch of texts on its way to Python, and stripes of one on its way back.
TEXTS, STRIPES = 500, 5_000
#: Rows over which the totals of single words are dealt, where a hot word meets the phrases that begin or end with it.
SALTS = 16
NO_LANG = "und"

# Characters that end a piece become line breaks, a tab becomes a space.
_ends = b".,;:!?\n\x0b\x0c\r"
_plain = bytes.maketrans(_ends + b"\t", b"\n" * len(_ends) + b" ")
_TEXT_END = b"\r"  # no word holds it, as it ends pieces


def _parts(langs: Iterable[str], texts: Iterable[pa.Scalar]) -> Iterator[tuple[list[str], list[bytes]]]:
    """Languages and translated texts, some ``PART_BYTES`` at a time."""
    return _parts_of(zip(langs, texts))


def _parts_of(rows: Iterable[tuple[str, pa.Scalar]]) -> Iterator[tuple[list[str], list[bytes]]]:
    some_langs, some, size = [], [], 0
    for lang, value in rows:
        text = value.as_py()
        if not text:
            continue
        # Bytes turn to lower case in ASCII alone.
        raw, at = text.encode("utf-8", "surrogatepass").lower().translate(_plain), 0
        while at < len(raw):
            end = len(raw) if len(raw) - at <= PART_BYTES else raw.find(b"\n", at + PART_BYTES) + 1 or len(raw)
            some_langs.append(lang)
            some.append(raw[at:end])
            size, at = size + end - at, end
            if size >= PART_BYTES:
                yield some_langs, some
                some_langs, some, size = [], [], 0
    if some:
        yield some_langs, some


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all but its last word and that of the last; a phrase begins with its language."""
    return _mixed(h * np.uint64(0xC2B2AE3D27D4EB4F) + word)


def _word_hash(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return h & mask, (h >> np.uint64(64 - FILTER_BITS)) & mask


def _maybe(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    yes = np.ones(len(h), bool)
    for slot in _slots(h):
        yes &= (filter_[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return yes


class _Tokens:
    """Words of a part as numbers, with the places where pieces end."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        joined = (b" " + _TEXT_END + b" ").join(t.replace(b"\n", b" \n ") for t in texts)
        coded = pc.split_pattern(pa.array([joined], pa.large_binary()), b" ").flatten().dictionary_encode()
        self.names = coded.dictionary
        empty, text_end, piece_end = (pc.index(self.names, pa.scalar(w, pa.large_binary())).as_py() for w in (b"", _TEXT_END, b"\n"))
        numbers = coded.indices.to_numpy()
        numbers = numbers[numbers != empty].astype(np.int64)
        ends_text = numbers == text_end
        self.number = numbers
        self.is_word = ~ends_text & (numbers != piece_end)
        self.langs = sorted(set(langs))
        place = {lang: i for i, lang in enumerate(self.langs)}
        self.lang = np.array([place[lang] for lang in langs], np.int64)[np.cumsum(ends_text) - ends_text]

    def maybe_frequent(self, length: int, filter_: np.ndarray) -> np.ndarray:
        """Whether a phrase of ``length`` words that the filter has begins at a place."""
        found = self.begins(length)
        at = np.flatnonzero(found)
        word_hash = _word_hash(self.names.to_numpy(zero_copy_only=False).tolist())
        h = _word_hash([lang.encode() for lang in self.langs])[self.lang[at]]
        for k in range(length):
            h = _extended(h, word_hash[self.number[at + k]])
        found[at] = _maybe(filter_, h)
        return found

    def begins(self, length: int) -> np.ndarray:
        """Whether a phrase of ``length`` words begins at a place; none does at the last ones."""
        n = len(self.number) - length + 1
        found = np.zeros(len(self.number), bool)
        if n > 0:
            found[:n] = self.is_word[:n]
            for k in range(1, length):
                found[:n] &= self.is_word[k : k + n]
        return found

    def stripes(self, length: int, filter_: np.ndarray | None) -> pa.RecordBatch | None:
        """Counters of the words after each prefix of ``length`` − 1 words. Phrases of one word less must pass the filter."""
        if length > 1:
            shorter = self.maybe_frequent(length - 1, filter_)
            at = np.flatnonzero(self.begins(length)[:-1] & shorter[:-1] & shorter[1:])
        else:
            at = np.flatnonzero(self.is_word)
        if not len(at):
            return None
        # Numbers of the prefixes, one word after another, so that no product passes 64 bits.
        prefix, first = self.lang[at], None
        for k in range(length - 1):
            prefix = prefix * len(self.names) + self.number[at + k]
            if k:
                _, first, prefix = np.unique(prefix, return_index=True, return_inverse=True)
        last = self.number[at + length - 1]
        pairs, n_of = np.unique(prefix * len(self.names) + last, return_counts=True)
        prefix_of = pairs // len(self.names)
        begins = np.flatnonzero(np.append(True, prefix_of[1:] != prefix_of[:-1]))
        which = prefix_of[begins]
        if length == 1:
            langs, text = which, pa.array([b""] * len(which), pa.large_binary())
        elif length == 2:
            langs, text = which // len(self.names), self.names.take(pa.array(which % len(self.names)))
        else:
            places = at[first[which]]
            langs = self.lang[places]
            names = [self.names.take(pa.array(self.number[places + k])) for k in range(length - 1)]
            text = pc.binary_join_element_wise(*names, pa.scalar(b" ", pa.large_binary()))
        offsets = pa.array(np.append(begins, len(pairs)), pa.int32())
        following = self.names.take(pa.array(pairs % len(self.names))).cast(pa.string())
        return pa.record_batch(
            [
                pa.array(self.langs, pa.string()).take(pa.array(langs)),
                text.cast(pa.string()),
                pa.ListArray.from_arrays(offsets, following),
                pa.ListArray.from_arrays(offsets, pa.array(n_of, pa.int64())),
            ],
            ["lang", "prefix", "next", "n"],
        )


@contextlib.contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs send batches of ``TEXTS`` rows to Python at most; the setting decides about memory, never about a result."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), TEXTS) if int(before) > 0 else TEXTS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _counter(length: int, filter_: Broadcast | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Small batches come and go, so that no process holds much more than a part.
        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1)))
        for langs, some in _parts_of(rows):
            found = _Tokens(langs, some).stripes(length, filter_.value if filter_ else None)
            if found is not None:
                yield from (found.slice(i, STRIPES) for i in range(0, found.num_rows, STRIPES))
            found = None
            pa.default_memory_pool().release_unused()

    return count


def _merged_stripes(texts: DataFrame, length: int, filter_: Broadcast | None) -> DataFrame:
    """Elements of all stripes of prefixes of ``length`` − 1 words: lang, prefix, next, n."""
    stripes = texts.mapInArrow(_counter(length, filter_), "lang string, prefix string, next array<string>, n array<bigint>")
    elements = stripes.select("lang", "prefix", F.explode(F.arrays_zip("next", "n")).alias("e"))
    return elements.groupBy("lang", "prefix", F.col("e.next").alias("next")).agg(F.sum("e.n").alias("n"))


def _filter_of(spark: SparkSession, phrases: DataFrame) -> Broadcast:
    """The bit filter of ``phrases`` (lang, phrase). Its words of 64 bits are put together on the executors."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [p.encode().split(b" ") for p in batch.column(1).to_pylist()]
            langs = [lang.encode() for lang in batch.column(0).to_pylist()]
            if not words:
                continue
            h = _word_hash(langs)
            for k in range(len(words[0])):
                h = _extended(h, _word_hash([w[k] for w in words]))
            slots = np.concatenate(_slots(h))
            yield pa.record_batch([pa.array((slots >> np.uint64(6)).astype(np.int64)), pa.array((slots & np.uint64(63)).astype(np.int32))], ["slot", "bit"])

    marks = phrases.select("lang", "phrase").mapInArrow(bits, "slot bigint, bit int")
    found = marks.groupBy("slot").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    filter_ = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    filter_[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(filter_)


def collocations(docs: DataFrame, min_count: int = 30, longest: int = 4, top: int = 2000, stands_for: tuple[int, int] = (80, 100)) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to ``longest`` words of each language of ``docs`` (text, lang).

    Texts (A to Z in lower case) fall into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at spaces and tabs; a
    phrase lies within a piece. ``a`` counts a phrase's occurrences, ``n`` all words of the language. Each cut of a phrase gives
    floor(2000000 · a / (l + r)) from the counts l and r of its parts; the lowest is its ``score``, the earliest cut on ties. Phrases
    with fewer than ``min_count`` occurrences are no candidates, and a candidate that lies in a longer one goes if the longer one
    has at least ``stands_for`` (80 of 100) of its occurrences. The ``top`` by score, a (both descending) and phrase (UTF-8 bytes)
    stay. A null text is empty, a null lang ``und``; repeated rows count again; other columns are left out.
    """
    spark = docs.sparkSession
    texts = docs.filter("text <> ''").select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    with _small_batches(spark):
        words = written(_merged_stripes(texts, 1, None), "stripes")
    totals = words.groupBy("lang").agg(F.sum("n").alias("all_words"))
    levels, filter_ = [], None
    for length in range(1, longest + 1):
        elements = words if length == 1 else _merged_stripes(texts, length, filter_)
        frequent = elements.filter(F.col("n") >= min_count)
        phrase = F.concat_ws(" ", "prefix", "next") if length > 1 else F.col("next")
        level = frequent.select("lang", phrase.alias("phrase"), "prefix", F.lit(length).alias("length"), F.col("n").alias("a"))
        with _small_batches(spark):
            level = written(level, "phrases")
        levels.append(level)
        if length < longest:
            filter_ = _filter_of(spark, level)
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    candidates = phrases.filter("length > 1")

    # The most frequent longer phrase around a phrase has one word more: it is an element of the phrase's own stripe, or of the stripe
    # that has one more word in front.
    rest = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    longer = candidates.filter("length > 2")
    around = longer.select("lang", F.col("prefix").alias("phrase"), "a").unionByName(longer.select("lang", rest.alias("phrase"), "a"))
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    part, whole = stands_for
    stood_for = F.expr(f"CAST(longer AS DECIMAL(38, 0)) * {whole} >= CAST(a AS DECIMAL(38, 0)) * {part}")
    kept = candidates.join(around, ["lang", "phrase"], "left").filter(~F.coalesce(stood_for, F.lit(False))).select("lang", "phrase", "length", "a")

    # Totals of both parts of every cut. A single word may be part of very many phrases, so its total is dealt to salts.
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    first = F.expr("substring_index(phrase, ' ', k)")
    cuts = cuts.withColumn("first", first).withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    sides = F.array(F.struct(F.lit("l").alias("side"), F.col("first").alias("part")), F.struct(F.lit("r").alias("side"), F.col("rest").alias("part")))
    sides = cuts.select("lang", "phrase", "a", "k", F.explode(sides).alias("s")).select("lang", "phrase", "a", "k", "s.side", "s.part")
    sides = sides.withColumn("salt", F.when(F.instr("part", " ") == 0, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(0))
    dealt = F.when(F.col("length") == 1, F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.explode(dealt).alias("salt"), F.col("a").alias("f"))
    joined = sides.join(parts, ["lang", "part", "salt"]).groupBy("lang", "phrase", "a", "k")
    scored = joined.agg(F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"))
    score = F.expr("CAST(a AS DECIMAL(38, 0)) * 2000000 DIV (l + r)")
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = worst.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")
