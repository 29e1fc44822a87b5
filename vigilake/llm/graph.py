"""Connected components over links of numbered nodes.

Up to FEW links (16 bytes each) fit one task, which takes them from their table in batches and joins them up in numpy. More
links go by alternating large-star and small-star steps: a node of many links is handled by its minimum, which is an
aggregate combined before the shuffle, and by an equi-join with one row for each node on the other side. Links live in
tables of the shared scratch folder either way; the driver only ever gets a count."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.llm.common import materialize

#: Links that one task joins up.
FEW = 1 << 20


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: a > b, distinct. Large star: every greater neighbour of a node goes to the least of the node's
    neighbourhood. Small star: the node and its lesser neighbours do."""
    sides = links if not large else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = sides.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    met = sides.join(least, "a")
    to = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return to.filter("a > b").distinct()


def _least(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links a, b, sorted, and the least node that each reaches."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        then = root.copy()
        for end in (a, b, root[a], root[b]):
            np.minimum.at(then, end, low)
        while (then[then] != then).any():
            then = then[then]
        if (then == root).all():
            return nodes, nodes[root]
        root = then


def components(links: DataFrame, a: str = "a", b: str = "b", few: int = FEW) -> DataFrame:
    """node, root (long): the least node that can be reached, for each node that has a link to another one.

    Links may repeat, in either direction; links with a null end or from a node to itself say nothing."""
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("a > b")
    now = materialize(now, "links")
    if now.count() <= few:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
            if found:
                nodes, roots = _least(*(np.concatenate(x) for x in zip(*found)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "root"])

        return now.coalesce(1).mapInArrow(run, "node long, root long")
    now = materialize(now.distinct(), "links")
    shape = None
    while True:
        then = materialize(_star(_star(now, large=True), large=False), "links")
        got = tuple(then.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").bitwiseAND(0xFFFFFFFF))).first())
        if got == shape:
            break
        now, shape = then, got
    return then.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(then.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
