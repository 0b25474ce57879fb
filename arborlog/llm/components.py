"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlog.session import broadcast_if_small, reliable_checkpoint


#: Links of a task. A table of fewer is not cut finer, however many partitions a shuffle has.
TASK_LINKS = 100_000


def component_labels(links: DataFrame) -> DataFrame:
    """Links (a, b) to (node, label): the smallest node that a chain of links reaches, for every node with a link to another.

    Large-star and small-star steps in turn until all components are stars: each hangs neighbours of a node under the smallest node
    it knows, so the number of rounds follows the logarithm of the longest chain and the number of links never grows. The
    smallest neighbours of all nodes, which a round begins with, tell whether it is needed. A hot node is a group that combines on
    the map side, and joins keep the links on the side that adaptive execution may split.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    now = reliable_checkpoint(links.filter("a <> b").select(big.alias("u"), small.alias("v")).distinct())
    tasks = max(1, -(-now.count() // TASK_LINKS))
    now = now.coalesce(tasks)
    while True:
        both = now.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = reliable_checkpoint(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).coalesce(2 * tasks))
        # In a star a node with a smaller neighbour has no other.
        nodes, more = least.agg(F.count("*"), F.count_if(F.expr("m < u AND n > 1"))).first()
        if not more:
            return least.select(F.col("u").alias("node"), F.least("u", "m").alias("label"))
        # Large-star: with m the smallest of v and its neighbours, larger neighbours of v go under m.
        under = broadcast_if_small(least.select(F.col("u").alias("v"), F.least("u", "m").alias("m")), nodes)
        hung = now.join(under, "v").select("u", F.col("m").alias("v"))
        # Small-star: smaller neighbours of u, and u itself, go under the smallest of them.
        under = broadcast_if_small(hung.groupBy("u").agg(F.min("v").alias("m")), nodes)
        pairs = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        next_ = hung.join(under, "u").select(F.explode(pairs).alias("e")).select("e.*")
        now = reliable_checkpoint(next_.filter("u <> v").distinct().coalesce(tasks))
