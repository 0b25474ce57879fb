"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected ``target / source size`` times. The expected copies are summed up within the source, one
random offset is added, and the document is emitted once per integer boundary that its part of the sum crosses. The source is
walked by size, so that neighbours stand in for each other and the words taken come near the target: they miss it by less than
the largest document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborlog.llm.common import WORD_PATTERN, columns, written

SEED = 24
#: Rows of one size and source that are ranked in one group, on average.
SLOT_ROWS = 20_000
HASH_BITS = 60


def word_count(text: Column) -> Column:
    """Words of a text, null as an empty one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def _draw(value: Column) -> Column:
    """60 bits of a hash that SQL engines share."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) to those and weight, target.

    Weights repeat along the sources by code point, the empty key (null) last. The targets sum up to ``share`` of all sizes; none is above
    ``most`` times its source's size, and what is above is shared again by weight among the others. That is one level for all
    sources that are not full: target = level × weight. The table has one row per source.
    """
    by_name = Window.orderBy(F.col("source") == "", "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("full_at", F.lit(most) * F.col("source_size") / F.col("weight"))
    below = Window.orderBy("full_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(1))
    total, upto, weight_upto = F.sum("source_size"), F.sum("source_size").over(below), F.sum("weight").over(below)
    same = Window.partitionBy("full_at")
    before, weight_before = upto - F.sum("source_size").over(same), weight_upto - F.sum("weight").over(same)
    level = (F.lit(share) * total.over(every) - F.lit(most) * before) / (F.sum("weight").over(every) - weight_before)
    leveled = weighed.withColumn("own_level", level)
    # The first source that its level does not fill sets the level of all that follow.
    first = F.min(F.when(F.col("own_level") < F.col("full_at"), F.struct("full_at", "own_level"))).over(every)
    full = F.lit(most) * F.col("source_size")
    target = F.when(first.isNull() | (F.col("full_at") < first["full_at"]), full).otherwise(first["own_level"] * F.col("weight"))
    return leveled.withColumn("target", target).select("source", "source_size", "weight", "target")


def mix(
    docs: DataFrame,
    kept: Sequence[str] = ("doc_id",),
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): _doc (the columns ``kept``), size, source_size, target, copies.

    ``copies`` is how often the mix takes the document: target / source_size rounded down or up. Documents without words have
    size 0 and take part like others; a source without words has target 0 and none of its documents is taken. A null source is
    a source; a null id counts as empty text in the order; repeated rows are documents of their own. Ties in size are broken by
    a hash of the id, then by id and text, so that runs agree however the table is partitioned.
    """
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    table = written(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.struct(*columns(kept)).alias("_doc"),
            F.col("doc_id").alias("_id"),
            # Never null: null is the empty key, any other source follows a mark.
            F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source"),
            word_count(F.col("text")).alias("size"),
            _draw(text_id).alias("_draw"),
            F.xxhash64("text").alias("_text"),
        ),
        "mix-sizes",
    )
    plain = table.drop("_doc")
    bounds = targets(plain.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    offset = _draw(F.concat(F.lit(f"{seed}|"), F.col("source"))) / F.lit(float(1 << HASH_BITS))
    plan = written(bounds.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumn("offset", offset), "mix-plan")
    # Slots follow the hash, so the rank does not depend on how many there are; one size of a hot source is many slots.
    slots = max(1, -(-plain.count() // SLOT_ROWS))
    slot = F.floor(F.col("_draw") / F.lit(float(1 << HASH_BITS)) * slots).cast("int")
    cut = plain.withColumn("slot", slot)
    counts = cut.groupBy("source", "size", "slot").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    smaller = sizes.select("source", "size", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("smaller"))
    inside = Window.partitionBy("source", "size").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    starts = starts.join(smaller, ["source", "size"]).select("source", "size", "slot", (F.col("smaller") + F.col("inside")).alias("start"))
    own = Window.partitionBy("source", "size", "slot").orderBy("_draw", "_id", "_text", "_row")
    ranked = cut.withColumn("own", F.row_number().over(own)).join(starts, ["source", "size", "slot"])
    rated = ranked.join(plan, "source")
    rank = (F.col("start") + F.col("own")).cast("double")
    crossed = F.floor(F.col("rate") * rank + F.col("offset")) - F.floor(F.col("rate") * (rank - 1.0) + F.col("offset"))
    # The last digit of a long sum must not add a copy.
    copies = F.least(crossed, F.ceil("rate")).cast("bigint").alias("copies")
    return table.select("_row", "_doc").join(rated.select("_row", "size", "source_size", "target", copies), "_row").drop("_row")


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs``, all its columns, as often as the mix takes it."""
    mixed = mix(docs, kept=docs.columns, **options)
    return mixed.filter("copies > 0").select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")
