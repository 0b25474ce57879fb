"""Near-duplicates by SimHash and BK-trees.

Equal fingerprints are one node. Nodes that differ in at most ``radius`` bits share at least one of ``radius + 1`` bit blocks, so
a shard holds the nodes that agree in one block; its BK-tree (children keyed by their integer Hamming distance to the parent) is
searched by the shard's nodes, following only edges within the radius. Only a link of each node to the smallest of its class leaves
the task, so no pairs of a large group are written out. Links of all shards meet in connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborlog.llm.common import columns, written
from arborlog.llm.components import component_labels

SEED = 42
BITS = 64
#: Nodes of a tree. A shard with more is cut into trees of this size; each of them is sent to each block of the shard's queries.
TREE_NODES = 4096
#: Nodes that one task of small shards holds, on average.
TASK_NODES = 50_000
#: A fingerprint is hot if it has more than this part of all rows, so there are fewer hot ones than that.
HOT_PART = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a whole text: bit k is 1 if over half of the shingles' XXH64 values have it.

    A-Z in lower case, words split at ASCII white space, shingles of ``shingle`` words joined by one space, repeats included;
    fewer words are one shingle; without words (null too) the fingerprint is 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    last = ends[min(shingle, len(words)) - 1 :] - 1
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    # Blocks of shingles keep the bit matrix of a very long text small.
    for i in range(0, n, 65_536):
        places = zip(starts[i : min(i + 65_536, n)].tolist(), last[i : i + 65_536].tolist())
        values = np.array([hashed(joined[a:b], SEED) for a, b in places], "<u8")
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """``docs`` as (_doc: its columns, fp: the fingerprint as a signed long)."""
    @F.pandas_udf(T.LongType())
    def hashed(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return docs.select(F.struct(*columns(docs.columns)).alias("_doc"), hashed(F.col(text)).alias("fp"))


class BKTree:
    """A tree of distinct integers; the edge to a child carries its Hamming distance to the parent."""

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        for i in range(1, len(values)):
            at = 0
            while True:
                d = (values[at] ^ values[i]).bit_count()
                below = self.children[at].get(d)
                if below is None:
                    self.children[at][d] = i
                    break
                at = below

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Positions of all nodes at most ``radius`` bits from ``value``."""
        values, children = self.values, self.children
        stack = [0] if values else []
        while stack:
            at = stack.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                yield at
            edges = children[at]
            if len(edges) <= 2 * radius + 1:
                stack += [child for edge, child in edges.items() if d - radius <= edge <= d + radius]
            else:
                stack += [edges[edge] for edge in range(d - radius, d + radius + 1) if edge in edges]


class _Classes:
    """Classes of linked integers; each hangs under its smallest."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, v: int) -> int:
        parent = self.parent
        while (p := parent.get(v, v)) != v:
            parent[v] = parent.get(p, p)
            v = parent[v]
        return v

    def link(self, tree: np.ndarray, queries: np.ndarray, radius: int) -> None:
        """Joins the classes of ``queries`` and the nodes of ``tree`` (both distinct) near them."""
        nodes = [int(v) for v in tree.view(np.uint64)]
        asked = nodes if tree is queries else [int(v) for v in queries.view(np.uint64)]
        found = BKTree(nodes)
        for q in asked:
            for at in found.within(q, radius):
                a, b = self.root(q), self.root(nodes[at])
                if a != b:
                    self.parent[max(a, b)] = min(a, b)

    def links(self) -> pd.DataFrame:
        """A link from every member of a class to its smallest, so that no chain leaves a task."""
        flat = np.fromiter(chain.from_iterable((v, self.root(v)) for v in list(self.parent)), np.uint64, 2 * len(self.parent))
        flat = flat.view(np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": flat[:, 0], "b": flat[:, 1]})


def _small_shards(radius: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "value", "fp"])
        fps = rows["fp"].to_numpy()
        change = (np.diff(rows["value"].to_numpy()) != 0) | (np.diff(rows["block"].to_numpy()) != 0)
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(fps)]]).tolist()
        classes = _Classes()
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                classes.link(part := fps[a:b], part, radius)
        return classes.links()

    return search


def _large_shard(radius: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("fp")
        tree = rows.loc[rows["is_tree"], "fp"].to_numpy()
        queries = rows.loc[~rows["is_tree"], "fp"].to_numpy()
        classes = _Classes()
        classes.link(tree, queries if len(queries) else tree, radius)
        return classes.links()

    return search


def links(nodes: DataFrame, radius: int = 2, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Links (a, b) of distinct fingerprints (column fp) that join every class of those at most ``radius`` bits apart.

    A link goes to the smallest fingerprint that a task's links reach, so its ends may be further apart than ``radius``.

    A shard (the nodes that agree in one bit block) with more than ``tree_nodes`` nodes is cut by hash into trees i and query
    blocks j ≤ i; the task (i, j) holds one of each, so no task grows with the shard.
    """
    schema = "a bigint, b bigint"
    if radius < 1:  # distinct fingerprints have no link
        return nodes.sparkSession.createDataFrame([], schema)
    blocks = radius + 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    values = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned("fp", edges[i]).bitwiseAND((1 << (edges[i + 1] - edges[i])) - 1).alias("value"),
        )
        for i in range(blocks)
    ]
    keyed = nodes.select("fp", F.explode(F.array(*values)).alias("k")).select("fp", "k.block", "k.value")
    large = keyed.groupBy("block", "value").agg(F.count("*").alias("n")).filter(F.col("n") > tree_nodes)
    large = written(large.withColumn("trees", F.ceil(F.col("n") / tree_nodes).cast("int")).drop("n"), "large-shards")
    rows, many = nodes.count(), large.count()
    tasks = max(1, -(-rows * blocks // TASK_NODES))
    small = keyed if not many else keyed.join(large, ["block", "value"], "left_anti")
    bucket = F.pmod(F.xxhash64("block", "value"), F.lit(tasks)).alias("bucket")
    out = small.groupBy("block", bucket).applyInPandas(_small_shards(radius), schema)
    if many:
        part = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
        cut = keyed.join(large, ["block", "value"]).withColumn("part", part)
        # As a tree a part meets the query blocks up to its own number, as a query block the trees from its number on.
        as_tree = cut.withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0), F.col("part")), lambda j: F.struct(F.col("part").alias("i"), j.alias("j")))))
        later = F.filter(F.sequence(F.lit(0), F.col("trees") - 1), lambda i: i > F.col("part"))
        as_query = cut.withColumn("pair", F.explode(F.transform(later, lambda i: F.struct(i.alias("i"), F.col("part").alias("j")))))
        both = as_tree.withColumn("is_tree", F.lit(True)).unionByName(as_query.withColumn("is_tree", F.lit(False)))
        found = both.groupBy("block", "value", "pair.i", "pair.j").applyInPandas(_large_shard(radius), schema)
        out = out.unionByName(found)
    return out


def near_classes(docs: DataFrame, shingle: int = 3, radius: int = 2, text: str = "text") -> DataFrame:
    """``docs`` as (_doc: its columns, fp, component_id, class: a fingerprint that stands for the class).

    ``component_id`` is the smallest doc_id that a chain of links reaches, the document itself included; null if no document of
    the class has an id. Equal fingerprints are linked, so are all texts without words. Repeated rows stay. An empty table gives
    an empty result.
    """
    table = written(fingerprints(docs, shingle, text), "fingerprints")
    nodes = written(table.groupBy("fp").agg(F.min("_doc.doc_id").alias("doc_id"), F.count("*").alias("n")), "fingerprint-nodes")
    labels = component_labels(links(nodes.select("fp"), radius))
    # Classes of several fingerprints; all others are their fingerprint alone.
    named = nodes.join(labels, nodes["fp"] == labels["node"]).select("fp", "doc_id", "label")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    classes = named.join(least, "label").select("fp", "component_id", F.col("label").alias("class"))
    one = classes["class"].isNull()
    whole = nodes.join(classes, "fp", "left").select(
        "fp",
        F.when(one, nodes["doc_id"]).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("class", "fp").alias("class"),
    )
    # Rows of a hot fingerprint are dealt to HOT_PART tasks, each of which gets its class; they are numbered within the parts of a
    # written table, so a task that runs again deals them as before.
    rows = nodes.agg(F.sum("n")).first()[0] or 0
    hot = [r["fp"] for r in nodes.filter(F.col("n") > max(1, rows // HOT_PART)).select("fp").collect()]
    is_hot, none = F.col("fp").isin(hot), F.lit(0).cast("bigint")
    dealt = table.withColumn("_part", F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(HOT_PART))).otherwise(none))
    every = F.sequence(none, F.lit(HOT_PART - 1).cast("bigint"))
    whole = whole.withColumn("_part", F.explode(F.when(is_hot, every).otherwise(F.array(none))))
    return dealt.join(whole, ["fp", "_part"], "left").select("_doc", "fp", "component_id", "class")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each class, the one with the smallest doc_id (null last), with all its columns.

    Of rows that repeat that id the one with the smallest text, then the smallest row in the order of its columns' text, stays.
    """
    classed = near_classes(docs, shingle, radius)
    # The id decides; a window meets only rows that repeat it.
    first = classed.filter(F.col("_doc.doc_id").eqNullSafe(F.col("component_id")))
    order = Window.partitionBy("class").orderBy("_doc.text", F.to_json("_doc"))
    return first.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").select("_doc.*")
