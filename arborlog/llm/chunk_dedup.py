"""Substring dedup by content-defined chunks.

A gear hash rolls over each text's bytes; where it is smallest in its neighbourhood a chunk ends. A cut depends on a few bytes
around it only, so an insertion moves no cut beyond its place. Text that repeats itself is cut at its periods. Chunks are told
apart by digest. A run of neighbouring chunks that all occur in other documents too is a repeated passage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborlog.llm.common import written

#: Bytes that the hash looks back on.
WINDOW = 16
#: A cut has the smallest hash of so many bytes before and after it: chunks have some 33 bytes, and few are much longer.
REACH = 16
#: A chunk without a cut ends here.
MAX_CHUNK = 2_048
#: A run of repeated chunks is a passage from so many words on. A passage loses up to some 25 words at its ends, where chunks
#: hold other text too.
MIN_WORDS = 18
#: Or from so many bytes on, as text in a script without spaces has few words; 18 words of English have fewer.
MIN_BYTES = 160
#: A document that is repeated from end to end loses nothing at its ends: so many words do. One with fewer words (and bytes) is one
#: chunk that only its exact copies have.
MIN_WHOLE_WORDS = 12
#: Periods of text are told apart if they have up to so many chunks.
MAX_PERIOD = 8
SEED = 5

_gear = np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)


def _of_periods(tied: list[int]) -> list[int]:
    """The cuts among places whose hash is smallest in their neighbourhood, but not alone.

    Two of them within reach have one hash, so the text between them is a period of at most ``REACH`` bytes. The first and the
    last of such a stretch are cuts, and as few between them as make chunks of ``REACH`` bytes or more. These are the same
    number of periods each, from the same byte of the period on, wherever the stretch begins and however long it is.
    """
    cuts: list[int] = []
    last = None
    for at in tied:
        if last is None or at - last > REACH:
            if last is not None and cuts[-1] != last:
                cuts.append(last)
            cuts.append(at)
        elif at - cuts[-1] >= REACH:
            cuts.append(at)
        last = at
    if last is not None and cuts[-1] != last:
        cuts.append(last)
    return cuts


def chunk_ends(raw: bytes) -> np.ndarray:
    """Ends of the chunks of UTF-8 bytes, the last at their length. No chunk cuts a character."""
    data = np.frombuffer(raw, np.uint8)
    # The gear hash h ← 2h + gear(byte) over the last ``WINDOW`` bytes, by doubling the part summed up.
    rolled = _gear[data]
    width = 1
    while width < WINDOW:
        rolled[width:] += rolled[:-width] << np.uint32(width)
        width *= 2
    whole = np.append(data[1:] & 0xC0 != 0x80, True)  # a character ends here
    rolled[~whole] = 0xFFFFFFFF
    ends = np.full(REACH, 0xFFFFFFFF, np.uint32)
    least = np.concatenate([ends, rolled, ends])
    width = 1
    while width < REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    n = len(data)
    before, after = least[:n], least[REACH + 1 : REACH + 1 + n]
    low = (rolled <= before) & (rolled <= after) & whole
    tied = low & ((rolled == before) | (rolled == after))
    ends = np.concatenate([np.flatnonzero(low & ~tied), _of_periods(np.flatnonzero(tied).tolist()), [n - 1]]) + 1
    ends = np.unique(ends.astype(np.int64))
    gaps = np.flatnonzero(np.diff(np.append(0, ends)) > MAX_CHUNK)
    if len(gaps):
        more = []
        for g in gaps.tolist():
            at, last = int(ends[g - 1]) if g else 0, int(ends[g])
            while last - at > MAX_CHUNK:
                at += MAX_CHUNK
                while not whole[at - 1]:
                    at -= 1
                more.append(at)
        ends = np.unique(np.append(ends, more))
    return ends


def _numbered(digests: np.ndarray) -> np.ndarray:
    """Digests of a text's chunks in order; in text of one period of up to ``MAX_PERIOD`` chunks they tell the periods apart too.

    So a longer run of periods has chunks that a shorter one has not.
    """
    places = np.arange(len(digests))
    number = np.zeros(len(digests), np.uint64)
    for period in range(min(MAX_PERIOD, len(digests) - 1), 0, -1):
        again = np.append(np.zeros(period, bool), digests[period:] == digests[:-period])
        if again.any():
            so_far = places - np.maximum.accumulate(np.where(again, -1, places))
            number = np.where(again, so_far.astype(np.uint64), number)
    return digests + number * np.uint64(0x9E3779B97F4A7C15)


def _chunk_rows(min_words: int, min_bytes: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, held = [], 0
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                if not raw:
                    continue
                data = np.frombuffer(raw, np.uint8)
                space = (data == 32) | (data >= 9) & (data <= 13)
                # A word counts where it begins.
                begins = np.append(0, np.cumsum(~space & np.append(True, space[:-1])))
                points = np.append(0, np.cumsum(data & 0xC0 != 0x80))
                short = begins[-1] < min(MIN_WHOLE_WORDS, min_words) and len(raw) < min(min_bytes, MAX_CHUNK)
                if short and not begins[-1]:
                    continue
                ends = np.array([len(raw)]) if short else chunk_ends(raw)
                starts = np.append(0, ends[:-1])
                view, seed = memoryview(raw), int(short)
                digests = [xxhash.xxh3_64_intdigest(view[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())]
                words, chars = begins[ends] - begins[starts], points[ends] - points[starts]
                size = (ends - starts - chars) << 24 | words << 13 | chars << 1 | (ends == len(raw))
                frame = {"digest": _numbered(np.array(digests, np.uint64)).view(np.int64), "row": row, "doc_id": doc_id, "start": points[starts], "size": size}
                parts.append(pd.DataFrame(frame))
                held += len(ends)
                if held > 50_000:
                    yield pd.concat(parts)
                    parts, held = [], 0
            if parts:
                yield pd.concat(parts)

    return rows


# A chunk's size in one number, as it passes four shuffles: by how much its bytes outnumber its code points (0 in ASCII), the words
# begun in it (11 bits), its code points (12 bits), whether it ends its text.
_WORDS, _CHARS, _LAST = "(size >> 13) & 2047", "(size >> 1) & 4095", "size & 1"
_BYTES = f"(size >> 24) + ({_CHARS})"
_END = f"CAST(start + ({_CHARS}) AS INT)"


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Passages of ``docs`` (doc_id, text) that occur in several documents: doc_id, start, end, words, chunks, first_doc_id.

    A repeated passage is a longest run of neighbouring chunks each of which another document holds too, with at least
    ``min_words`` words begun in it or ``min_bytes`` bytes, or one that is its whole document. A document with fewer words than
    ``min_words`` and ``MIN_WHOLE_WORDS`` and fewer bytes than ``min_bytes`` is one only if another text equals it. A passage has
    a row for each stretch of chunks with one ``first_doc_id``, the smallest document that
    has the chunk in a passage; that document's copy is the one to keep. So the rows of a chunk name the same document, which has
    a row itself, however the copies are edited. start and end are code points of the whole text. Digests have 64 bits; a passage
    is several chunks in a row, so that chance makes none. Of a run of periods only as many count as another document has in a row. A document whose passages are its own has no row, nor has a null or
    empty text, a short text without words or a row without an id. Repeated rows of one id are one document.
    """
    rows = docs.filter("doc_id IS NOT NULL").select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "digest bigint, row bigint, doc_id bigint, start int, size bigint"
    chunks = written(rows.mapInPandas(_chunk_rows(min_words, min_bytes), schema), "chunks")
    held = chunks.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = held.filter("first <> last").select("digest")
    # Digests that one document has alone leave here; the rest keep the chunks' side, which adaptive execution may split. The id of a
    # document stays behind and comes back by its row: each has one chunk at 0.
    repeated = chunks.select("digest", "row", "start", "size").join(shared, "digest")
    owners = chunks.filter("start = 0").select("row", "doc_id")
    in_order = Window.partitionBy("row").orderBy("start")
    # A run breaks where a chunk does not begin at the end of the one before it.
    broken = (F.col("start") != F.lag(F.expr(_END)).over(in_order)).cast("int")
    runs = repeated.withColumn("broken", F.coalesce(broken, F.lit(0))).withColumn("run", F.sum("broken").over(in_order))
    own = Window.partitionBy("row", "run")
    whole = (F.min("start").over(own) == 0) & (F.max(F.expr(_LAST)).over(own) == 1)
    long = (F.sum(F.expr(_WORDS)).over(own) >= min_words) | (F.sum(F.expr(_BYTES)).over(own) >= min_bytes) | whole
    passages = runs.withColumn("long", long).filter("long").drop("broken", "run", "long")
    passages = written(passages.join(owners, "row").select("digest", "row", "doc_id", "start", "size"), "passages")
    keepers = passages.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"))
    kept = passages.select("digest", "row", "start", "size").join(keepers, "digest").select("row", "start", "size", "first_doc_id")
    in_order = Window.partitionBy("row").orderBy("start")
    same = F.coalesce((F.col("start") == F.lag(F.expr(_END)).over(in_order)) & (F.col("first_doc_id") == F.lag("first_doc_id").over(in_order)), F.lit(False))
    stretches = kept.withColumn("new", (~same).cast("int")).withColumn("stretch", F.sum("new").over(in_order)).groupBy("row", "first_doc_id", "stretch")
    out = stretches.agg(F.min("start").alias("start"), F.max(F.expr(_END)).alias("end"), F.sum(F.expr(_WORDS)).alias("words"), F.count("*").alias("chunks"))
    return out.join(owners, "row").select("doc_id", "start", "end", "words", "chunks", "first_doc_id")
