"""Token ids as blocks of a static range asymmetric numeral system.

One table of frequencies, counted over all ids, serves every block. A block holds whole documents, in order, dealt to
interleaved lanes: id ``i`` goes to lane ``i % lanes`` at step ``i // lanes``. Each lane is a coder of its own with a 64-bit state
that gives off 32-bit words; the words of all lanes stand in one stream in the order a decoder asks for them. A block also has
the states at checkpoints, from where its rest can be decoded alone, and checksums of the stream and of the ids. Blocks decode
independently of each other.

The files are two Parquet tables in one folder: ``table`` (id, frequency) and ``blocks`` (one row per block).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LANES = 128
#: A block is closed by the document that brings it to so many ids.
BLOCK_IDS = 32_768
CHECKPOINT_STEPS = 128
#: Blocks that a task codes side by side hold about so many ids.
TOGETHER_IDS = 1_500_000
MIN_SCALE_BITS = 16
LOW, WORD_BITS = np.uint64(1 << 31), np.uint64(32)
WORD_MASK = np.uint64((1 << 32) - 1)

BLOCK_SCHEMA = (
    "start bigint, n_ids bigint, doc_ids array<bigint>, doc_sizes array<bigint>, lanes int, table_crc32 bigint, "
    "states binary, words binary, words_crc32 bigint, ids_crc32 bigint, checkpoint_steps array<int>, "
    "checkpoint_words array<bigint>, checkpoint_states binary"
)
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
BLOCK_FIELDS = pa.schema([(name, _ARROW[kind]) for name, kind in map(str.split, BLOCK_SCHEMA.split(", "))])


class Table:
    """Frequencies of ids, scaled to a power of two; every counted id keeps at least 1."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.freqs = ids[order].astype(np.uint32), freqs[order].astype(np.uint64)
        total = int(self.freqs.sum())
        self.bits = max(total - 1, 0).bit_length()
        if total != 1 << self.bits:
            raise ValueError("the frequencies of a table add up to a power of two")
        self.starts = np.cumsum(self.freqs) - self.freqs
        self.place: np.ndarray | None = None
        self.crc32 = zlib.crc32(self.ids.astype("<u4").tobytes() + self.freqs.astype("<u8").tobytes())

    @classmethod
    def scaled(cls, ids: np.ndarray, counts: np.ndarray) -> Table:
        """From counts. Ids share the scale by count; the most frequent one takes what rounding leaves."""
        bits = max(MIN_SCALE_BITS, (2 * len(ids)).bit_length())
        whole, total = 1 << bits, int(counts.sum())
        freqs = np.array([max(1, int(c) * (whole - len(ids)) // total) for c in counts], np.int64)
        freqs[int(np.argmax(counts))] += whole - int(freqs.sum())
        return cls(ids, freqs)

    def positions(self, ids: np.ndarray) -> np.ndarray:
        """Of ids in the table; an id that was not counted is an error."""
        if self.place is None:
            # As long as the largest id, so one look-up finds a position; the last entry is for ids beyond.
            self.place = np.zeros(int(self.ids[-1]) + 2, np.uint32)
            self.place[self.ids] = np.arange(len(self.ids), dtype=np.uint32)
        at = self.place[np.minimum(ids, np.uint32(len(self.place) - 1))]
        if not np.array_equal(self.ids[at], ids):
            raise ValueError("an id is not in the table")
        return at


def _steps(sizes: np.ndarray, lanes: int) -> np.ndarray:
    return -(-sizes // lanes)


def encode_blocks(blocks: list[np.ndarray], table: Table, lanes: int = LANES) -> list[dict]:
    """Id arrays to their coded parts: states, words and checkpoints.

    All blocks advance together, one step of all lanes at a time; the longest stand first, so that those still at work are a
    prefix.
    """
    sizes = np.array([len(b) for b in blocks], np.int64)
    order = np.argsort(-sizes, kind="stable")
    steps = _steps(sizes[order], lanes)
    depth, filler = int(steps[0]) if len(steps) else 0, int(np.argmax(table.freqs))
    at = np.full((depth, len(blocks), lanes), filler, np.uint32)
    for column, b in enumerate(order):
        filled = np.full(int(steps[column]) * lanes, filler, np.uint32)
        filled[: sizes[b]] = table.positions(blocks[b])
        at[: steps[column], column] = filled.reshape(-1, lanes)
    active = np.searchsorted(-steps, -np.arange(depth), side="left")  # blocks with more steps than this one
    shift, limit = np.uint64(table.bits), (LOW >> np.uint64(table.bits)) << WORD_BITS
    x = np.full((len(blocks), lanes), LOW, np.uint64)
    given = np.zeros(at.shape, bool)
    words = np.zeros(at.shape, np.uint32)
    marks: dict[int, np.ndarray] = {}
    for t in range(depth - 1, -1, -1):
        n = int(active[t])
        symbol, now = at[t, :n].astype(np.intp), x[:n]
        freq, start = table.freqs[symbol], table.starts[symbol]
        full = now >= limit * freq
        given[t, :n] = full
        words[t, :n] = (now & WORD_MASK).astype(np.uint32)
        now = np.where(full, now >> WORD_BITS, now)
        whole = now // freq
        x[:n] = (whole << shift) + (now - whole * freq) + start
        if t and t % CHECKPOINT_STEPS == 0:
            marks[t] = x[:n].copy()  # the states before step t, as a decoder has them
    out: list[dict] = [{}] * len(blocks)
    for column, b in enumerate(order):
        mine = given[: steps[column], column]
        before = np.cumsum(mine.sum(axis=1))
        places = [t for t in sorted(marks) if t < steps[column]]
        out[b] = {
            "states": x[column].astype("<u8").tobytes(),
            "words": words[: steps[column], column][mine].astype("<u4").tobytes(),
            "checkpoint_steps": places,
            "checkpoint_words": [int(before[t - 1]) for t in places],
            "checkpoint_states": b"".join(marks[t][column].astype("<u8").tobytes() for t in places),
        }
    return out


def decode_blocks(sizes: np.ndarray, states: list[bytes], words: list[bytes], table: Table, lanes: int = LANES) -> list[np.ndarray]:
    """The ids of blocks, given how many each holds; from a checkpoint with its states and the words from its place on."""
    order = np.argsort(-sizes, kind="stable")
    steps = _steps(sizes[order], lanes)
    depth = int(steps[0]) if len(steps) else 0
    active = np.searchsorted(-steps, -np.arange(depth), side="left")
    lengths = np.array([len(words[b]) // 4 for b in order], np.int64)
    stream = np.frombuffer(b"".join([*(words[b] for b in order), b"\0\0\0\0"]), "<u4").astype(np.uint64)
    place = np.cumsum(lengths) - lengths
    x = np.frombuffer(b"".join(states[b] for b in order), "<u8").reshape(-1, lanes).astype(np.uint64)
    # Of each slot of the scale its symbol, the symbol's frequency, and how far the slot is from the symbol's first.
    slots = np.repeat(np.arange(len(table.ids), dtype=np.uint32), table.freqs.astype(np.int64))
    wide, past = table.freqs[slots], np.arange(len(slots), dtype=np.uint64) - table.starts[slots]
    shift, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    at = np.zeros((depth, len(order), lanes), np.uint32)
    for t in range(depth):
        n = int(active[t])
        slot = (x[:n] & mask).astype(np.intp)
        at[t, :n] = slots[slot]
        now = wide[slot] * (x[:n] >> shift) + past[slot]
        empty = now < LOW
        # Lanes in need take the next words of their block, in the order of the lanes.
        asked = empty.sum(axis=1)
        lane_block = np.repeat(np.arange(n), asked)
        order_in = np.arange(len(lane_block)) - np.repeat(np.cumsum(asked) - asked, asked)
        now[empty] = (now[empty] << WORD_BITS) | stream[place[lane_block] + order_in]
        x[:n] = now
        place[:n] += asked
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(order)
    for column, b in enumerate(order):
        out[b] = table.ids[at[: steps[column], column].reshape(-1)[: sizes[b]]]
    return out


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(where the ids of each row begin and the last ones end, all ids) of a column of binaries."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, "<u4")
    _, places, raw = column.buffers()
    places = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    ids = np.frombuffer(raw, "<u4", (places[-1] - places[0]) // 4, places[0])
    return (places - places[0]) // 4, ids


def count_ids(tokens: DataFrame) -> DataFrame:
    """(id, n) over all ``ids`` of the table. A task adds up in an array as long as the largest id, before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            got = np.bincount(_ids(batch["ids"])[1])
            total, less = (got, total) if len(got) > len(total) else (total, got)
            total[: len(less)] += less
        seen = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})

    return tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def _runs(starts: list[int], sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Row ranges of blocks: documents that follow each other, closed at the least size."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and starts[i] != starts[i - 1] + sizes[i - 1]:
            yield first, i
            first, held = i, 0
        held += size
        if held >= BLOCK_IDS:
            yield first, i + 1
            first, held = i + 1, 0
    if held:
        yield first, len(sizes)


def _together(runs: list, sizes: list[int]) -> Iterator[list]:
    part, held = [], 0
    for run, size in zip(runs, sizes):
        if part and held + size > TOGETHER_IDS:
            yield part
            part, held = [], 0
        part.append(run)
        held += size
    if part:
        yield part


def _block_rows(table: Table):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, starts, sizes = (batch[name].to_pylist() for name in ("doc_id", "start", "n_ids"))
            places, ids = _ids(batch["ids"])
            runs = list(_runs(starts, sizes))
            for some in _together(runs, [sum(sizes[a:b]) for a, b in runs]):
                raw = [ids[places[a] : places[b]] for a, b in some]
                rows = [
                    {
                        "start": starts[a],
                        "n_ids": len(r),
                        "doc_ids": doc_ids[a:b],
                        "doc_sizes": sizes[a:b],
                        "lanes": LANES,
                        "table_crc32": table.crc32,
                        "words_crc32": zlib.crc32(c["words"]),
                        "ids_crc32": zlib.crc32(r),
                        **c,
                    }
                    for (a, b), r, c in zip(some, raw, encode_blocks(raw, table))
                ]
                yield pa.RecordBatch.from_pylist(rows, BLOCK_FIELDS)

    return encode


def write_blocks(tokens: DataFrame, path: str) -> None:
    """Write (doc_id, start, n_ids, ids), in order within each file of the input, as table and blocks under ``path``.

    Every document lies whole in one block. Only the table, as long as the vocabulary, reaches the driver. A table without rows
    gives a table and blocks without rows.
    """
    spark = tokens.sparkSession
    counted = count_ids(tokens).toPandas()
    table = Table.scaled(counted["id"].to_numpy(), counted["n"].to_numpy()) if len(counted) else None
    rows = [] if table is None else list(zip(table.ids.tolist(), table.freqs.astype(np.int64).tolist()))
    spark.createDataFrame(rows, "id bigint, frequency bigint").coalesce(1).write.parquet(f"{path}/table")
    blocks = tokens.mapInArrow(_block_rows(table), BLOCK_SCHEMA) if table else spark.createDataFrame([], BLOCK_SCHEMA)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def _document_rows(table: Table):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _together(list(range(len(batch))), batch["n_ids"].to_pylist()):
                part = batch.slice(some[0], len(some))
                rows = part.select(["start", "table_crc32", "words", "words_crc32", "ids_crc32", "states", "n_ids"]).to_pylist()
                for row in rows:
                    if row["table_crc32"] != table.crc32 or zlib.crc32(row["words"]) != row["words_crc32"]:
                        raise ValueError(f"block at {row['start']}: the table or the words are not those it was written with")
                sizes = np.array([row["n_ids"] for row in rows], np.int64)
                found = decode_blocks(sizes, [row["states"] for row in rows], [row["words"] for row in rows], table)
                for ids, row in zip(found, rows):
                    if zlib.crc32(ids.astype("<u4", copy=False)) != row["ids_crc32"]:
                        raise ValueError(f"block at {row['start']}: the ids differ from those written")
                # The documents of all these blocks; each follows the one before it, or is the first of its block.
                held = part["doc_sizes"].value_lengths().to_numpy()
                doc_sizes = part["doc_sizes"].flatten().to_numpy()
                ends = np.cumsum(doc_sizes)
                starts = ends - doc_sizes + np.repeat(part["start"].to_numpy() - (np.cumsum(sizes) - sizes), held)
                places = np.append(0, 4 * ends).astype(np.int32)
                raw = pa.py_buffer(np.concatenate(found).astype("<u4", copy=False))
                texts = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(places), raw])
                columns = [part["doc_ids"].flatten(), pa.array(starts), pa.array(doc_sizes), texts]
                yield pa.record_batch(columns, names=["doc_id", "start", "n_ids", "ids"])

    return decode


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files under ``path``: doc_id, start, n_ids, ids. A block that fails a checksum is an error."""
    rows = spark.read.schema("id bigint, frequency bigint").parquet(f"{path}/table").toPandas()
    schema = "doc_id bigint, start bigint, n_ids bigint, ids binary"
    if rows.empty:
        return spark.createDataFrame([], schema)
    table = Table(rows["id"].to_numpy(), rows["frequency"].to_numpy())
    return spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").mapInArrow(_document_rows(table), schema)
