"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import array
import functools
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborlog.llm.common import written

BYTES_PER_ID = 4
#: Pieces whose ids a task remembers, twice so many at most: those met lately and those met before them; and characters of the longest.
REMEMBERED = 250_000
LONG = 64
#: New pieces that are encoded in one text.
LINES = 1000
#: Characters of the texts that are encoded together.
TOGETHER_CHARS = 9_000_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Kinds of bytes, as far as cuts depend on them: ASCII letters, digits, other ASCII that is no white space, the apostrophe, space and
#: line break, the first byte of other characters, first bytes with which white space may begin, and all the rest.
_LETTER, _DIGIT, _SIGN, _APOSTROPHE, _SPACE, _BREAK, _OTHER, _MAYBE, _REST = range(9)
_WHITE = ("\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")
_WHITE_BYTES = np.array([int.from_bytes(c.encode().ljust(3, b"\0")) for c in _WHITE])


def _kinds() -> np.ndarray:
    kinds = np.full(256, _REST, np.uint8)
    kinds[[*range(0x09), *range(0x0E, 0x1C), *range(0x21, 0x80)]] = _SIGN
    kinds[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = _LETTER
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[[ord("'"), ord(" "), ord("\n")]] = _APOSTROPHE, _SPACE, _BREAK
    kinds[0xC3:0xF5] = _OTHER
    kinds[[0xC2, 0xE1, 0xE2, 0xE3]] = _MAYBE
    return kinds


def _cuts() -> np.ndarray:
    """Of two kinds of bytes that follow each other: 1 for a cut between them, 2 for one before the first, 3 for both."""
    cuts = np.zeros((16, 16), np.uint8)
    for kind, others in ((_LETTER, [_DIGIT, _SIGN, _APOSTROPHE]), (_DIGIT, [_LETTER, _SIGN, _APOSTROPHE]), (_SIGN, [_LETTER, _DIGIT]), (_APOSTROPHE, [])):
        cuts[kind, [*others, _SPACE, _BREAK]] = 1
    black = [_LETTER, _DIGIT, _SIGN, _APOSTROPHE, _OTHER]
    cuts[_SPACE, black] = 2
    cuts[_BREAK, black] = 3
    return cuts.ravel()


_KIND_OF, _CUT_OF = _kinds().tobytes(), _cuts().tobytes()
#: A piece without white space but a space at its beginning, and with something else.
_LINE = "^ ?[^\\x09-\\x0d\\x1c-\\x20%s]+$" % "".join(_WHITE)


class Met:
    """Pieces and their ids, held by Arrow: a look-up is one call for many, and no piece becomes an object of Python's."""

    def __init__(self, pieces: pa.Array | None = None, ids: pa.Array | None = None):
        self.pieces = pa.array([], pa.large_string()) if pieces is None else pieces
        self.ids = pa.array([], pa.large_binary()) if ids is None else ids

    def __iter__(self) -> Iterator[str]:
        """The pieces, without a space before."""
        return (piece.as_py().removeprefix(" ") for piece in self.pieces)

    def __len__(self) -> int:
        return len(self.pieces)

    def find(self, pieces: pa.Array) -> np.ndarray:
        """Where each of ``pieces`` stands here, -1 for none."""
        return pc.index_in(pieces, value_set=self.pieces).fill_null(-1).to_numpy().astype(np.int64)

    def more(self, pieces: pa.Array, ids: pa.Array) -> Met:
        return Met(pa.concat_arrays([self.pieces, pieces]), pa.concat_arrays([self.ids, ids]))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(where each of the texts begins and the last one ends, their bytes); none is null."""
    _, places, raw = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return places - places[0], np.frombuffer(raw or b"", np.uint8)[places[0] : places[-1]]


def _binary(ids: np.ndarray, places: np.ndarray) -> pa.Array:
    """The bytes of the ids from each place to the next."""
    return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(BYTES_PER_ID * places), pa.py_buffer(ids)])


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit integers, the same ids as encoding each text in one go.

    The pre-tokenizer of a byte-level BPE makes tokens of letters, of digits, of other signs and of white space; a token may begin with a
    space before, and one of an apostrophe may end with letters. Of white space before another character the last one stands apart. So
    texts are cut where it cuts them whatever stands around (``_cuts``), and each different piece is encoded once. Texts that hold
    the string of an added token, which is that token, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # The ids with which a line's piece begins: a line break before it, or a space of its own.
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        ((space, _),) = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ")
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[self.line_break, *(i for token, i in vocabulary.items() if token.startswith(space))]] = True
        self.lately, self.before = Met(), Met()

    def whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _lines(self, pieces: pa.Array) -> pa.Array:
        """The ids of pieces without white space but at their beginning, many at a time: those without a space before stand on new lines."""
        places, raw = _bytes(pieces)
        broken = np.flatnonzero(raw[places[:-1]] != ord(" "))
        raw, places = np.insert(raw, places[broken], ord("\n")), places + np.searchsorted(broken, np.arange(len(places)))
        cuts = [*range(0, len(pieces), LINES), len(pieces)]
        coded = [np.zeros(0, "<u4")]
        for a, b in zip(cuts, cuts[1:]):
            (text,) = self.tokenizer.encode_batch_fast([raw[places[a] : places[b]].tobytes().decode()], add_special_tokens=False)
            coded.append(np.array(text.ids, "<u4"))
        ids = np.concatenate(coded)
        begins = np.flatnonzero(self.begins[ids])
        if len(begins) != len(pieces):
            raise ValueError("pieces are not tokens of the pre-tokenizer")
        begins -= np.searchsorted(broken, np.arange(len(begins)))
        ids = ids[ids != self.line_break]
        return _binary(ids, np.append(begins, len(ids)))

    def _new(self, pieces: pa.Array, whole: pa.Array) -> pa.Array:
        """The ids of different pieces that were not met; those of ``whole`` hold the string of an added token."""
        lines = pc.match_substring_regex(pieces, _LINE).to_numpy(zero_copy_only=False)
        if len(whole):
            lines &= ~pc.is_in(pieces, value_set=whole).to_numpy(zero_copy_only=False)
        alone = [self.whole(piece) for piece in pieces.filter(pa.array(~lines)).to_pylist()]
        coded = pa.concat_arrays([self._lines(pieces.filter(pa.array(lines))), pa.array(alone, pa.large_binary())])
        return coded.take(pa.array(np.argsort(np.argsort(~lines, kind="stable"), kind="stable")))

    def _pieces(self, pieces: pa.Array, whole: pa.Array) -> pa.Array:
        """The ids of different pieces; those of ``whole`` hold the string of an added token. Long ones are not remembered."""
        if len(self.lately) >= REMEMBERED:
            self.before, self.lately = self.lately, Met()
        place = self.lately.find(pieces)
        missing = np.flatnonzero(place < 0)
        older = self.before.find(pieces.take(pa.array(missing)))
        new = missing[older < 0]
        older = np.where(older < 0, len(self.before) + np.cumsum(older < 0) - 1, older)
        place[missing] = len(self.lately) + older
        coded = self._new(pieces.take(pa.array(new)), whole)
        found = pa.concat_arrays([self.lately.ids, self.before.ids, coded]).take(pa.array(place))
        # What was met before is met lately now.
        missed = pieces.take(pa.array(missing))
        kept = pc.less_equal(pc.utf8_length(missed), LONG).to_numpy(zero_copy_only=False)
        if len(whole):
            kept &= ~pc.is_in(missed, value_set=whole).to_numpy(zero_copy_only=False)
        self.lately = self.lately.more(missed.filter(pa.array(kept)), found.take(pa.array(missing[kept])))
        return found

    def _begins(self, raw: np.ndarray, places: np.ndarray, odd: np.ndarray) -> np.ndarray:
        """Where the pieces of texts begin in their bytes; ``places`` are those of the texts and the end, ``odd`` texts are one piece."""
        # One byte for each; to index by bytes would make eight of each.
        kinds = np.frombuffer(bytearray(raw).translate(_KIND_OF), np.uint8)
        maybe = np.flatnonzero(kinds == _MAYBE)
        if len(maybe):
            # The two bytes after the first; a character of two bytes has none of a third.
            after = [raw[np.minimum(maybe + k, len(raw) - 1)].astype(np.int64) for k in (1, 2)]
            three = (raw[maybe].astype(np.int64) << 16) + (after[0] << 8) + np.where(raw[maybe] == 0xC2, 0, after[1])
            kinds[maybe] = np.where(np.isin(three, _WHITE_BYTES), _REST, _OTHER)
        cut = np.zeros(len(raw), bool)
        pairs = np.frombuffer(bytearray((kinds[:-1] << 4) | kinds[1:]).translate(_CUT_OF), np.uint8)
        edges = places[(places > 0) & (places < len(raw))]
        pairs[edges - 1] = 0  # the last of a text and the first of the next
        cut[1:] = pairs & 1
        cut[:-1] |= pairs > 1
        for i in np.flatnonzero(odd).tolist():
            cut[places[i] : places[i + 1]] = False
        cut[places[places < len(raw)]] = True
        return np.flatnonzero(cut)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); every text ends with ``end_id``, null is an empty text."""
        texts = texts.fill_null("").cast(pa.large_string())
        odd = np.zeros(len(texts), bool)
        for token in self.added:
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        places, raw = _bytes(texts)
        begins = self._begins(raw, places, odd) if len(raw) else np.zeros(0, np.int64)
        cuts = pa.py_buffer(np.append(begins, len(raw)))
        coded = pa.Array.from_buffers(pa.large_string(), len(begins), [None, cuts, pa.py_buffer(raw)]).dictionary_encode()
        found = self._pieces(coded.dictionary, texts.filter(pa.array(odd)))
        entries = pa.concat_arrays([found, pa.array([array.array("I", [end_id]).tobytes()], pa.large_binary())])
        # The end id is a piece after the last one of each text.
        ends = np.searchsorted(begins, places[1:])
        _, upto, ids = entries.take(pa.array(np.insert(coded.indices.to_numpy(), ends, len(found)))).buffers()
        upto = np.frombuffer(upto, np.int64)[np.append(0, ends + np.arange(1, len(ends) + 1))] // BYTES_PER_ID
        return np.frombuffer(ids, "<u4")[: upto[-1]], np.diff(upto)


@functools.cache
def task_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: a worker runs many tasks, one at a time, and keeps the loaded file and the words it has met."""
    return Encoder(path)


def _slices(texts: pa.Array, parts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of one part each, about equally long and of about ``TOGETHER_CHARS`` characters at most."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    each = -(-int(upto[-1]) // -(-int(upto[-1]) // TOGETHER_CHARS)) if len(upto) and upto[-1] else 1
    new = (np.diff((upto - 1) // each) > 0) | (np.diff(parts.to_numpy(zero_copy_only=False)) != 0)
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(texts)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


def _encoded(path: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = task_encoder(path)
        part, start = None, 0
        for batch in batches:
            for a, b in _slices(batch["text"], batch["part"]):
                rows = batch.slice(a, b - a)
                if rows["part"][0].as_py() != part:
                    part, start = rows["part"][0].as_py(), 0
                ids, counts = encoder.encode(rows["text"], end_id)
                upto = np.cumsum(counts)
                places = np.append(0, upto * BYTES_PER_ID).astype(np.int32)
                coded = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(places), pa.py_buffer(ids)])
                columns = [rows["doc_id"], rows["part"], pa.array(start + upto - counts), pa.array(counts), coded]
                yield pa.record_batch(columns, names=["doc_id", "part", "local_start", "n_ids", "ids"])
                start += int(upto[-1])
                # Arrow would keep what a slice took, in each worker, beside the JVM.
                pa.default_memory_pool().release_unused()

    return encode


def token_stream(docs: DataFrame, end_id: int, path: str) -> DataFrame:
    """Texts in a global order, as ids: doc_id, start, n_ids, ids.

    ``docs`` has part, doc_id and text; parts follow each other by number, each lies whole in one partition, and there its rows
    stand in their order. ``start`` counts the ids of all documents before; ``ids`` are little-endian unsigned 32-bit integers
    with ``end_id`` at the end, so a null or empty text is ``end_id`` alone. The ids are written once; what is known of a whole
    part is one number, so only those numbers are summed up.
    """
    schema = "doc_id bigint, part int, local_start bigint, n_ids bigint, ids binary"
    table = written(docs.select("part", "doc_id", "text").mapInArrow(_encoded(path, end_id), schema), "token-ids")
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = table.join(F.broadcast(bases), "part")
    return placed.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_ids", "ids")


def ordered_tokens(docs: DataFrame, order: Sequence[str], end_id: int, path: str) -> DataFrame:
    """``token_stream`` of ``docs`` (doc_id, text) by the columns ``order``, which should identify a row and be short.

    The parts are the partitions of a range shuffle.
    """
    names = list(dict.fromkeys([*order, "doc_id", "text"]))
    ranged = docs.select(*names).repartitionByRange(*order).sortWithinPartitions(*order)
    return token_stream(ranged.withColumn("part", F.spark_partition_id()), end_id, path)
