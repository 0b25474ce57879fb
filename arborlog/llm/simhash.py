"""Document fingerprints by SimHash, in built-in expressions only.

Terms are pairs of neighbouring words, weighted by how often they occur: every occurrence's 64-bit hash votes for or against each
bit. Permuted block tables find the fingerprints within a Hamming radius.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborlog.functions.buckets import quantile_bounds, with_buckets
from arborlog.llm.common import written
from arborlog.operators.metrics import join_skewed
from arborlog.session import broadcast_if_small

BITS = 64
SPACE = r"[\x20\x09-\x0D]+"
#: Rows of a range of ids that are looked at together; tables of over 200,000 such ranges get larger ones instead.
RANGE_ROWS, MAX_RANGES = 1_000, 200_000
#: Bits that fingerprints of near documents differ in at most.
RADIUS = 3

# Two counters in one long: bit k of a hash below, bit k + 32 above. A text has fewer than 2^31 words, so none overflows.
_LOW = 0x1_0000_0001


def _votes(h: str) -> list[Column]:
    return [F.expr(f"sum(shiftrightunsigned({h}, {k}) & {_LOW}L) AS _v{k}") for k in range(BITS // 2)]


def _majority(total: str) -> Column:
    """The fingerprint from the packed counters: bit k is 1 if more than half of the votes are for it."""
    low = [f"IF(2 * (_v{k} & 4294967295L) > {total}, {1 << k}L, 0L)" for k in range(BITS // 2)]
    high = [f"IF(2 * shiftrightunsigned(_v{k}, 32) > {total}, shiftleft(1L, {k + 32}), 0L)" for k in range(BITS // 2)]
    return F.expr(" | ".join(low + high))


def _terms(text: Column) -> Column:
    """Pairs of neighbouring words as (a, b); a single word alone is (word, null)."""
    words = F.array_remove(F.split(F.lower(text), SPACE), "")
    n = F.size(words)
    return F.arrays_zip(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(1))).alias("a"), F.slice(words, F.lit(2), F.greatest(n, F.lit(1))).alias("b"))


def with_fingerprints(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per combination of ``keys`` (which tell rows apart): the keys and fp, a signed long.

    Null and word-less texts have fingerprint 0. Rows that agree in all keys are one text in parts. If the input is partitioned by
    some of the keys, nothing is shuffled; else each document is a few rows after the map side.
    """
    each = df.select(*keys, F.inline_outer(_terms(F.coalesce(text, F.lit("")))))
    hashed = each.select(*keys, F.col("a").isNotNull().cast("long").alias("_n"), F.when(F.col("a").isNull(), F.lit(0)).otherwise(F.xxhash64("a", "b")).alias("_h"))
    counted = hashed.groupBy(*keys).agg(F.sum("_n").alias("_total"), *_votes("_h"))
    return counted.select(*keys, _majority("_total").alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


def _ranged(docs: DataFrame) -> DataFrame:
    """Rows with a range of ids each (``range``), and once more, marked ``borrowed``, those that follow the end of a range.

    What follows the last range is the start of the first. Only the least id of each range is looked up.
    """
    ids = docs.select("doc_id")
    rows = ids.count()
    ranges = max(1, -(-rows // max(RANGE_ROWS, -(-rows // MAX_RANGES))))
    bounds = quantile_bounds(ids, ["doc_id"], ranges, rows)
    own = with_buckets(docs, {"doc_id": "range"}, bounds)
    firsts = with_buckets(ids, {"doc_id": "range"}, bounds).groupBy("range").agg(F.min(F.struct("doc_id")).alias("least"))
    in_order = Window.orderBy("range")
    before = F.coalesce(F.lag("range").over(in_order), F.max("range").over(Window.partitionBy(F.lit(1))))
    lent = firsts.select(F.col("least.doc_id").alias("_first"), before.alias("_to"))
    borrowed = docs.join(broadcast_if_small(lent, ranges), F.col("doc_id").eqNullSafe(F.col("_first")))
    borrowed = borrowed.select(*docs.columns, F.col("_to").alias("range"), F.lit(True).alias("borrowed"))
    return own.withColumn("borrowed", F.lit(False)).unionByName(borrowed)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp.

    The edited text has the last floor(n / 2) code points replaced by the first as many (or all) of the next document by doc_id
    (null first, then by a hash of the text); after the last comes the first. A null text is empty. One shuffle, by ranges of
    ids; fingerprints are counted in the partitions it makes.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("range").orderBy("borrowed", F.col("doc_id").asc_nulls_first(), "_h")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = (
        _ranged(plain)
        .withColumn("_h", F.xxhash64("text"))
        .withColumns({"_at": F.row_number().over(order), "_next": F.lead("text").over(order)})
        .withColumn("_edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("_next", F.lit(1), half)))
    )
    both = rows.select(
        "range",
        "_at",
        "borrowed",
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.unhex(F.sha2(F.col("_edited").cast("binary"), 256)).alias("_sha"),
        # A borrowed row only lends its own fingerprint.
        F.explode(
            F.when(F.col("borrowed"), F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")))).otherwise(
                F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("_edited").alias("text")))
            )
        ).alias("t"),
    )
    keys = ["range", "_at", "borrowed", "doc_id", "n_chars", "_sha", "kind"]
    counted = with_fingerprints(both.select(*keys[:-1], "t.kind", "t.text"), keys)
    wide = counted.groupBy(*keys[:-1]).agg(F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"))
    following = wide.withColumn("next_fp", F.lead("fp").over(Window.partitionBy("range").orderBy("_at")))
    kept = following.filter(~F.col("borrowed"))
    return kept.select("doc_id", "n_chars", F.lower(F.hex("_sha")).alias("edited_sha256"), "fp", "edited_fp", "next_fp")


def _table_keys(fp: str, radius: int) -> tuple[list[str], list[int]]:
    """Keys of the permuted tables, and the bits that each takes: of ``radius + 2`` blocks every two, moved to the front."""
    blocks = radius + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    width = max(b - a for a, b in zip(edges, edges[1:]))
    masks = [(1 << (b - a)) - 1 for a, b in zip(edges, edges[1:])]

    def block(i: int) -> str:
        return f"(shiftrightunsigned({fp}, {edges[i]}) & {masks[i]}L)"

    pairs = list(combinations(range(blocks), 2))
    keys = [f"(shiftleft({t}L, {2 * width}) | shiftleft({block(i)}, {width}) | {block(j)})" for t, (i, j) in enumerate(pairs)]
    taken = [masks[i] << edges[i] | masks[j] << edges[j] for i, j in pairs]
    return keys, [m - (1 << BITS if m >> (BITS - 1) else 0) for m in taken]


def _met(asked: DataFrame, held: DataFrame, radius: int) -> DataFrame:
    """Rows of ``asked`` (query_fp) and ``held`` (fp) at most ``radius`` bits apart, with their distance.

    At most ``radius`` of ``radius + 2`` blocks differ, so two fingerprints that are near agree in two blocks and meet in the
    table that has these in front. Of several such tables the first counts. Both tests are part of the join, so only near pairs
    leave it; a hot key is dealt to a grid of tasks.
    """
    own, taken = _table_keys("query_fp", radius)
    left = asked.filter("query_fp IS NOT NULL").select("*", F.explode(F.expr(f"array({', '.join(own)})")).alias("_key"))
    right = held.filter("fp IS NOT NULL").select("*", F.explode(F.expr(f"array({', '.join(_table_keys('fp', radius)[0])})")).alias("_key"))
    apart = F.col("query_fp").bitwiseXOR(F.col("fp"))
    first = F.expr(f"CASE {' '.join(f'WHEN ((query_fp ^ fp) & {_long(m)}) = 0 THEN {k}' for k, m in zip(own, taken))} END")
    met = join_skewed(left, right, "_key").filter((F.bit_count(apart) <= radius) & (F.col("_key") == first))
    return met.drop("_key").withColumn("distance", F.bit_count(apart))


def _long(number: int) -> str:
    return f"{number}L" if number > -(1 << 63) else "(-9223372036854775807L - 1L)"


def within_radius(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (query_fp, fp, distance) of distinct fingerprints (columns query_fp and fp) at most ``radius`` bits apart.

    Nulls are near nothing.
    """
    met = _met(queries.select("query_fp").distinct(), fingerprints.select("fp").distinct(), radius)
    return met.select("query_fp", "fp", "distance")


def with_near(fingerprints: DataFrame, is_query: Column, radius: int = RADIUS) -> DataFrame:
    """Add ``n_near`` to rows with an ``fp``: how many other rows have a fingerprint at most ``radius`` bits away.

    It is null where ``is_query`` is not true or fp is null. Equal fingerprints are looked up once and weigh as many rows as have them, so copies
    make no pairs. ``fingerprints`` is read several times: a written table.
    """
    asked = fingerprints.filter(is_query & F.col("fp").isNotNull())
    held = fingerprints.groupBy("fp").agg(F.count("*").alias("_rows"))
    met = _met(asked.select(F.col("fp").alias("query_fp")).distinct(), held, radius)
    counts = met.groupBy(F.col("query_fp").alias("fp")).agg((F.sum("_rows") - 1).alias("n_near"))
    others = fingerprints.filter(~F.coalesce(is_query & F.col("fp").isNotNull(), F.lit(False))).withColumn("n_near", F.lit(None).cast("bigint"))
    return join_skewed(asked, written(counts, "near"), "fp").select(*fingerprints.columns, "n_near").unionByName(others)
