"""Connected components of a link table, by contraction in a few tasks or by large-star and small-star rounds.

Up to FEW_LINKS links are dealt over FEW_TASKS tasks by both of their nodes, and each task replaces what
it holds by links of each node to the smallest one it is connected to there: one shuffle a round. More
links go through alternating large-star and small-star rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm.shared import FEW_TASKS, prepare, stored

MAX_ROUNDS = 60
#: Up to this many links are contracted in FEW_TASKS tasks.
FEW_LINKS = 200_000


def least_reachable(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """The smallest node connected to each of the nodes 0, 1, .. by the links (a, b)."""
    low = np.arange(nodes)
    while True:
        least, before = np.minimum(low[a], low[b]), low.copy()
        np.minimum.at(low, before[a], least)
        np.minimum.at(low, before[b], least)
        while (low[low] != low).any():
            low = low[low]
        if (low == before).all():
            return low


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, own, open) of a task's links (key, a, b), which are all links of each of its keys.

    b is the smallest node connected to a here; own: a is a key of this task; keys without a smaller node
    come with themselves. The first row's open counts the keys that have links to more than a center.
    """
    held = [batch for batch in batches if len(batch)]
    if not held:
        return
    links = pa.Table.from_batches(held).combine_chunks()
    names = pc.unique(pa.chunked_array([*links["a"].chunks, *links["b"].chunks]))
    names = names.take(pc.sort_indices(names))
    key, a, b = (pc.index_in(links[k], names).to_numpy().astype(np.int64) for k in ("key", "a", "b"))
    least, most = np.full(len(names), len(names)), np.full(len(names), -1)
    other = a + b - key
    np.minimum.at(least, key, other)
    np.maximum.at(most, key, other)
    own = most >= 0
    number = np.arange(len(names))
    center, member = least > number, (least == most) & (least < number)
    low = least_reachable(a, b, len(names))
    kept = np.flatnonzero(own | (low != number))
    open_ = np.zeros(len(kept), np.int64)
    open_[0] = np.count_nonzero(own & ~center & ~member)
    columns = [names.take(pa.array(kept)), names.take(pa.array(low[kept])), pa.array(own[kept]), pa.array(open_)]
    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "own", "open"])


def _contracted(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) of few links (a, b)."""
    kind = links.schema["a"].dataType.simpleString()
    for number in range(1, MAX_ROUNDS):
        ends = links.filter("a != b").select(F.explode(F.array("a", "b")).alias("key"), "a", "b")
        # All links of a node lie in one task, whatever the number of partitions they were shuffled to.
        dealt = ends.repartition(FEW_TASKS, "key").coalesce(FEW_TASKS)
        state = Observation()
        found = dealt.mapInArrow(_contract, f"a {kind}, b {kind}, own boolean, open long").observe(state, F.sum("open").alias("open"))
        links = stored(spark, found.drop("open"), f"components-{number}")
        if not state.get["open"]:
            return links.filter("own").select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError("components did not settle")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a != b")


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(least, "a").filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(least.select("a", F.col("low").alias("b"))).distinct()


def _stored_round(spark: SparkSession, links: DataFrame, number: int) -> tuple[DataFrame, dict[str, int]]:
    """The stored links, with their number and a digest of them that the write itself has gathered."""
    state = Observation()
    links = links.observe(state, F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("a", "b")).alias("digest"))
    return stored(spark, links, f"components-{number}"), state.get


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b); component is the smallest node reachable.

    Links of a node to itself count for nothing. Each round is written to the shared folder.
    """
    links = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    prepare(spark)
    links, before = _stored_round(spark, links, 0)
    if not before["rows"]:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    if before["rows"] <= FEW_LINKS:
        return _contracted(spark, links)
    links, before = _stored_round(spark, links.distinct(), 0)
    for number in range(1, MAX_ROUNDS):
        links, state = _stored_round(spark, _small_star(_large_star(links).distinct()), number)
        if state == before:
            roots = links.select(F.col("b").alias("node")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                roots.select("node", F.col("node").alias("component"))
            )
        before = state
    raise RuntimeError("components did not settle")
