"""Chosen-path set similarity join of documents on word shingles.

A document's set is its distinct shingles; rows of equal sets form a class, named by a digest of the
set. Each class gets POSITIONS minwise tokens: for every hash function of a fixed family, the shingle
that comes first under it. Two sets of similarity t agree in a position with probability t.

A tree starts with all classes at its root. A node chooses BRANCHES positions by a hash of its own
name, and sends each of its classes to one child per chosen position, named by the node, the
position and the class's token there: classes that agree on it stay together. Nodes small enough are
compared exhaustively, the others branch on. A pair of similarity t is parted for good in a tree with
probability q = (1 - t + t * q) ** BRANCHES at most, so `trees_for(recall)` independent trees miss
fewer than 1 - recall of the pairs at the threshold, and far fewer above it.

Comparing means: the classes' lengths, then the number of agreeing positions (which a pair at the
threshold misses with probability MISS), then the whole sets of the texts. Only links are needed that
join components, so:

1. in every node all classes meet the one of the smallest name, and linked classes become components;
2. as long as that still joins many, every class outside its node's largest component meets one
   of that component, another in each round;
3. nodes that still hold several components go down the tree: where the classes outside the largest
   component are few (at most SMALL) they meet all others, in blocks of BLOCK classes; a node with more
   of them branches. At the last level, nodes that never fell apart (many sets almost similar enough) are
   compared block by block. So no group is dropped, cut or sampled, and none has to fit into a task.
   Likely pairs are not written, as there may be as many as the square of a group's classes: a block gives
   what connects its likely pairs, at most a pair a class, connected classes become families, and a
   family's whole sets are compared within a task, which gives at most a link a class again. A
   family with more than SMALL classes outside its largest component is compared in the blocks its pairs are from.

Edge cases: null or blank text has no shingles, n_shingles 0 and is its own component; a text of fewer
words than a shingle has one, the whole sequence; rows that repeat a doc_id are one node, whatever
their texts, so they link these; a null doc_id takes no part and gets a null component; an
empty table gives an empty result; other columns are ignored. 64-bit hashes stand for shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm import words
from wardgrid.llm.components import components
from wardgrid.llm.jaccard import shingle_sets
from wardgrid.llm.shared import MAX_BROADCAST_ROWS, TASK_ROWS, broadcast_if_small, fitted, shuffles_released, stored

WORDS = 3
PERCENT = 85
POSITIONS = 128
BRANCHES = 2
RECALL = 0.99999
MISS = 1e-6
#: A node is small if at most so many of its classes are outside its largest component.
SMALL = 2048
BLOCK = 2048
#: Hashes of a block's sets that are looked up at a time.
LOOKUPS = 1 << 20
LEVELS = 6
ROUNDS = 8
#: Pairs that share a class on one side are verified in parts of this many.
PART = 1024
#: Keys of more rows than this are hot, as long as there are so many rows that hot keys may be broadcast.
HOT = 2_000
#: Pairs of whole texts that are dealt to a task.
TEXT_PAIRS = 5_000
#: Classes in up to this many pairs are picked by broadcast (two names of 16 bytes a pair).
MAX_BROADCAST_PAIRS = 250_000

_SEEDS = words.mix(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = words.mix(_SEEDS) | np.uint64(1)


def parted(percent: int = PERCENT, branches: int = BRANCHES) -> float:
    """The share of pairs at the threshold that one tree of any depth parts for good."""
    t, q = percent / 100, 0.0
    for _ in range(1000):
        q = (1 - t + t * q) ** branches
    return q


def trees_for(recall: float = RECALL, percent: int = PERCENT, branches: int = BRANCHES) -> int:
    """Independent trees that find at least this share of the pairs at the threshold."""
    q = parted(percent, branches)
    return max(1, ceil(log(1 - recall) / log(q))) if q > 0 else 1


def least_agreeing(percent: int = PERCENT, positions: int = POSITIONS, miss: float = MISS) -> int:
    """Agreeing positions that a pair at the threshold falls short of with probability `miss` at most."""
    t, below = percent / 100, 0.0
    for k in range(positions + 1):
        below += comb(positions, k) * t**k * (1 - t) ** (positions - k)
        if below > miss:
            return k
    return positions


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """32 bits of the minwise token of each set (none empty) at each position."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    out = np.empty((len(sets), POSITIONS), np.uint32)
    for j in range(POSITIONS):
        least = np.minimum.reduceat((flat ^ _SEEDS[j]) * _FACTORS[j], starts)
        out[:, j] = words.mix(least) >> np.uint64(32)
    return out


def root_positions(trees: int, branches: int = BRANCHES) -> list[int]:
    """Positions that the roots choose; different ones in all trees as long as there are enough."""
    order = np.argsort(words.mix(_SEEDS ^ np.uint64(0x5DEECE66D)), kind="stable")
    return [int(order[i % POSITIONS]) for i in range(trees * branches)]


# ---------------------------------------------------------------------------- tasks


def _scan(size: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.chunks(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                digests = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
                full = [s for s in sets if len(s)]
                tokens = iter(minwise(full) if full else ())
                columns = [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([next(tokens).tobytes() if len(s) else None for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "set", "tokens"])

    return scan


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    data, offsets = words.buffers(column)
    return data[offsets[0] : offsets[-1]].view(np.uint32).reshape(rows, POSITIONS)


def _alike(n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)


def _true(rows: np.ndarray) -> np.ndarray:
    """The number of true values in each row of POSITIONS (added up by eight bytes at a time)."""
    lanes = rows.view(np.uint64).sum(axis=1, dtype=np.uint64)
    return (lanes * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.int64)


def _agreeing(percent: int):
    """Keeps pairs (a, b, tokens_a, tokens_b) with enough agreeing positions."""
    least = least_agreeing(percent)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            same = _matrix(batch.column("tokens_a"), len(batch)) == _matrix(batch.column("tokens_b"), len(batch))
            chosen = batch.select(["a", "b"]).filter(pa.array(_true(same) >= least))
            yield chosen

    return keep


class _Sets:
    """The whole sets of a block's rows, none empty."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = words.buffers(column)
        self.hashes = data[offsets[0] : offsets[-1]].view(np.uint64)
        self.starts = (offsets - offsets[0]) // 8
        self.marks = (self.hashes >> np.uint64(48)).astype(np.uint16)
        self.held = np.zeros(1 << 16, bool)

    def possible(self, i: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Whether the sets may be similar to that of row i: their marks (16 bits of a hash) share at least what the sets do."""
        own = self.marks[self.starts[i] : self.starts[i + 1]]
        sizes = self.starts[others + 1] - self.starts[others]
        shared = np.zeros(len(others), np.int64)
        self.held[own] = True
        at, ends = 0, np.cumsum(sizes)
        while at < len(others):
            done = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + LOOKUPS, "right")))
            found = self.held[self.marks[words.runs(self.starts[others[at:end]], sizes[at:end])]]
            shared[at:end] = np.add.reduceat(found, ends[at:end] - sizes[at:end] - done, dtype=np.int64)
            at = end
        self.held[own] = False
        return 100 * shared >= percent * (len(own) + sizes - np.minimum(shared, sizes))

    def similar(self, i: int, j: int, percent: int) -> bool:
        a, b = (self.hashes[self.starts[x] : self.starts[x + 1]] for x in (i, j))
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return shared > 0 and 100 * shared >= percent * (len(a) + len(b) - shared)


class _Group:
    """The classes of a node or family that meet in one block, gathered over batches."""

    def __init__(self) -> None:
        self.parts: list[pa.RecordBatch] = []

    def pairs(self, percent: int, least: int, whole: bool) -> tuple[list[bytes], list[bytes]]:
        """Pairs that connect the likely pairs of different components; whole: only pairs of similar sets."""
        rows = pa.Table.from_batches(self.parts).combine_chunks().to_batches()[0]
        few = rows.column("few").to_numpy(zero_copy_only=False)
        n = rows.column("n").to_numpy()
        part = np.unique(np.array(rows.column("part").to_pylist(), dtype=object), return_inverse=True)[1]
        tokens = _matrix(rows.column("tokens"), len(rows))
        low = tokens.astype(np.uint8)  # agree wherever the tokens do
        sets = _Sets(rows.column("hashes")) if whole else None
        names = rows.column("set").to_pylist()
        left, right = [], []
        members = np.flatnonzero(~few)
        # A class may be both one of the few and one of the others. Whole sets join components, likely pairs only classes.
        place = {name: i for i, name in enumerate(names)}
        joined = part.copy() if whole else np.array([place[name] for name in names])
        for i in np.flatnonzero(few).tolist():
            other = members[(part[members] != part[i]) & (joined[members] != joined[i]) & _alike(n[members], n[i], percent)]
            if len(other):
                other = other[_true(low[other] == low[i]) >= least]
            if not len(other):
                continue
            agreeing = _true(tokens[other] == tokens[i])
            other = other[np.argsort(-agreeing, kind="stable")[: np.count_nonzero(agreeing >= least)]]
            if whole and len(other):
                other = other[sets.possible(i, other, percent)]
            for j in other.tolist():
                if joined[j] != joined[i] and (not whole or sets.similar(i, j, percent)):
                    left.append(names[i])
                    right.append(names[j])
                    joined[joined == joined[j]] = joined[i]
        return left, right


def _compare(percent: int, whole: bool):
    """Pairs of a block: rows marked `few` against the others of other components (`_Group.pairs`).

    Rows come sorted by group (node, block); a group holds at most BLOCK others and SMALL or BLOCK few.
    """
    least = least_agreeing(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key = _Group(), None

        def flush() -> Iterator[pa.RecordBatch]:
            left, right = group.pairs(percent, least, whole)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column("group").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if keys[first] != key and group.parts:
                    yield from flush()
                    group = _Group()
                key = keys[first]
                group.parts.append(batch.slice(first, last - first))
        if group.parts:
            yield from flush()

    return compare


def _verify(size: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in words.chunks(batch, "text_b"):
                keep = []
                rights = shingle_sets(part.column("text_b"), size)
                for i, (a, right) in enumerate(zip(part.column("a").to_pylist(), rights, strict=True)):
                    if a != last:
                        last, left = a, shingle_sets(part.column("text_a").slice(i, 1), size)[0]
                    shared = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(shared > 0 and 100 * shared >= percent * (len(left) + len(right) - shared))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _texts_of_sets(size: int):
    """(set, text) of rows (doc_id, set, text) whose text has that set."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.chunks(batch, "text"):
                digests = [hashlib.md5(s.tobytes()).digest() for s in shingle_sets(part.column("text"), size)]
                same = [d == name for d, name in zip(digests, part.column("set").to_pylist(), strict=True)]
                yield part.select(["set", "text"]).filter(pa.array(same, pa.bool_()))

    return keep


def _hashes_of_sets(size: int):
    """(set, hashes) of rows (set, text), each text the one of its set."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.chunks(batch, "text"):
                found = [s.tobytes() for s in shingle_sets(part.column("text"), size)]
                yield pa.RecordBatch.from_arrays([part.column("set"), pa.array(found, pa.binary())], names=["set", "hashes"])

    return hashes


# ---------------------------------------------------------------------------- Spark


def _meet(rows: DataFrame, named: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """rows with the columns of their row in `named` (key, size, ..); size: how many of the `total` rows have the key.

    Rows of the most frequent keys meet it by broadcast, so that no task holds all rows of a key.
    """
    # So many rows a key that the hot keys are few enough by count.
    limit = max(HOT, total // MAX_BROADCAST_ROWS)
    hot = named.filter(F.col("size") > limit)
    if hot.isEmpty():
        return fitted(rows.join(named, key, how), total)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(named.filter(F.col("size") <= limit), key, how)
    return fitted(cold, total).unionByName(rows.join(F.broadcast(hot), key))


def _both_sides(pairs: DataFrame, side: DataFrame, total: int, a_task: int = TASK_ROWS) -> DataFrame:
    """The `total` pairs (a, b) with the columns of `side` (set, ..) for both, named .._a and .._b.

    The more frequent class of a pair becomes a; a class in very many pairs is dealt out in parts.
    """
    several = pairs.select(F.explode(F.array("a", "b")).alias("set")).groupBy("set").count().filter(F.col("count") > PART)
    several = fitted(several.select("set", F.ceil(F.col("count") / PART).cast("int").alias("parts")), total)
    if 2 * total // PART <= MAX_BROADCAST_ROWS:  # there cannot be more
        several = F.broadcast(several)
    for x in "ab":
        pairs = pairs.join(several.select(F.col("set").alias(x), F.col("parts").alias(f"parts_{x}")), x, "left")
    pairs = pairs.na.fill(1, ["parts_a", "parts_b"])
    turn = F.col("parts_b") > F.col("parts_a")
    turned = pairs.select(
        F.when(turn, F.col("b")).otherwise(F.col("a")).alias("a"),
        F.when(turn, F.col("a")).otherwise(F.col("b")).alias("b"),
        F.greatest("parts_a", "parts_b").alias("parts"),
    )
    dealt = turned.select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt"))
    names = [c for c in side.columns if c != "set"]
    copies = side.join(several, "set", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    side_a = copies.select(F.col("set").alias("a"), "salt", *[F.col(c).alias(f"{c}_a") for c in names])
    side_b = side.select(F.col("set").alias("b"), *[F.col(c).alias(f"{c}_b") for c in names])
    return fitted(dealt.join(side_b, "b"), total, a_task).join(side_a, ["a", "salt"]).drop("salt")


class _Join:
    """The state of one join: classes, their texts, the links found and the pairs tried."""

    def __init__(self, spark: SparkSession, docs: DataFrame, size: int, percent: int, limits: dict[str, int]) -> None:
        self.spark, self.size, self.percent, self.limits = spark, size, percent, limits
        self.texts = docs.select("doc_id", "text")
        scanned = self.texts.mapInArrow(_scan(size), "doc_id long, n long, set binary, tokens binary")
        self.rows = stored(spark, scanned, "chosenpath-rows")
        known = self.rows.filter("n > 0 AND doc_id IS NOT NULL")
        total = self.rows.count()
        grouped = known.groupBy("set").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
        self.classes = stored(spark, fitted(grouped, total), "chosenpath-classes")
        # Rows of one doc_id are one node: its sets are linked.
        name = F.xxhash64("set")
        several = fitted(known.groupBy("doc_id").agg(F.min(name).alias("least"), F.max(name).alias("most")).filter("least != most"), total)
        same = known.join(broadcast_if_small(several.select("doc_id")), "doc_id").select("doc_id", "set")
        links = same.join(same.groupBy("doc_id").agg(F.min("set").alias("a")), "doc_id")
        self.links = stored(spark, links.select("a", F.col("set").alias("b")).filter("a != b").distinct(), "chosenpath-links")
        self.tried = self.links.limit(0)
        self.number, self.placed = 0, None

    def parts(self) -> DataFrame:
        """(set, part) of every linked class; found again only after new links."""
        if self.placed is None:
            self.placed = components(self.spark, self.links).select(F.col("node").alias("set"), F.col("component").alias("part"))
        return self.placed

    def check(self, pairs: DataFrame, most: int) -> int:
        """Verifies the pairs (a, b) not tried yet, of at most so many; returns how many links were new."""
        self.number += 1
        ordered = pairs.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).select("a", "b").distinct()
        if self.number > 1:
            ordered = ordered.join(self.tried, ["a", "b"], "left_anti")
        ordered = stored(self.spark, fitted(ordered, most), f"chosenpath-pairs-{self.number}")
        self.tried = ordered if self.number == 1 else self.tried.unionAll(ordered)
        total = ordered.count()
        if total:
            tokens = self._of(ordered, self.classes.select("set", "tokens"), total)
            both = fitted(_both_sides(ordered, tokens, total).select("a", "b", "tokens_a", "tokens_b"), total)
            both = both.mapInArrow(_agreeing(self.percent), "a binary, b binary")
            ordered = stored(self.spark, both, f"chosenpath-agreeing-{self.number}")
            total = ordered.count()
        if not total:
            return 0
        return self._add(stored(self.spark, self._whole(ordered, total), f"chosenpath-links-{self.number}"))

    def _add(self, found: DataFrame) -> int:
        """Takes in the links found; components stand as long as there are none. Returns their number."""
        number = found.count()
        if number:
            self.links, self.placed = self.links.unionAll(found), None
        return number

    def _of(self, pairs: DataFrame, side: DataFrame, total: int) -> DataFrame:
        """The rows of `side` whose set is in one of the pairs."""
        sets = fitted(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), total)
        return side.join(F.broadcast(sets) if total <= MAX_BROADCAST_PAIRS else sets, "set", "left_semi")

    def _whole(self, pairs: DataFrame, total: int) -> DataFrame:
        """The pairs whose whole sets reach the similarity."""
        texts = self._texts(self._of(pairs, self.classes.select("set", F.col("rep").alias("doc_id")), total), total)
        whole = _both_sides(pairs, texts, total, TEXT_PAIRS).select("a", "b", "text_a", "text_b").sortWithinPartitions("a")
        return fitted(whole, total, TEXT_PAIRS).mapInArrow(_verify(self.size, self.percent), "a binary, b binary")

    def _texts(self, wanted: DataFrame, total: int) -> DataFrame:
        """(set, text) of the wanted classes (set, doc_id), which are in `total` pairs."""
        rows = self.texts.join(F.broadcast(wanted) if total <= MAX_BROADCAST_PAIRS else wanted, "doc_id")
        texts = rows.select("set", "text").mapInArrow(_texts_of_sets(self.size), "set binary, text string")
        return fitted(stored(self.spark, texts, f"chosenpath-texts-{self.number}").dropDuplicates(["set"]), total)

    def settle(self, dealt: DataFrame) -> None:
        """Links that join the components of the likely pairs in the blocks of `dealt` (group, set, part, few)."""
        self.number += 1
        met = dealt.count()  # rows of whole nodes in all their blocks: many more than classes
        likely = stored(self.spark, self._blocks(dealt, met), f"chosenpath-likely-{self.number}")
        if likely.isEmpty():
            return
        family = components(self.spark, likely).select(F.col("component").alias("node"), F.col("node").alias("set"))
        rows, _, _ = self.open_rows(stored(self.spark, family.withColumn("n", F.lit(0)), f"chosenpath-families-{self.number}"))
        total = rows.count()
        few = F.col("size") - F.col("rows") <= self.limits["small"]
        large = rows.filter(~few).select("set")
        again = self.exhaust(rows.filter(few))
        met += again.count()
        dealt = again.unionAll(dealt.join(large, "set", "left_semi").select("group", "set", "part", "few"))
        wanted = self.classes.join(rows.select("set"), "set", "left_semi").select("set", F.col("rep").alias("doc_id"))
        texts = self._texts(fitted(wanted, total), total)
        hashes = texts.mapInArrow(_hashes_of_sets(self.size), "set binary, hashes binary")
        self._add(stored(self.spark, self._blocks(dealt, met, hashes), f"chosenpath-links-{self.number}"))

    def _near(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, n_a, b, n_b) of lengths that allow the similarity."""
        return pairs.filter(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")).select("a", "b")

    # ------------------------------------------------------------------ trees

    def roots(self, trees: int) -> DataFrame:
        """(node, set) of the roots' children: a class per tree and chosen position."""
        children = [
            F.xxhash64(F.lit(f"tree {i // BRANCHES}"), F.lit(p), _token(F.lit(p))) for i, p in enumerate(root_positions(trees))
        ]
        return self.classes.select("set", "n", F.explode(F.array(*children)).alias("node"))

    def open_rows(self, rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
        """(rows, nodes, number of rows): rows (node, set, n, part) of the nodes that hold several components."""
        total = rows.count()
        placed = fitted(rows.join(self.parts(), "set", "left"), total).select("node", "set", "n", F.coalesce("part", "set").alias("part"))
        by_part = fitted(placed.groupBy("node", "part").agg(F.count("*").alias("rows")), total)
        nodes = by_part.groupBy("node").agg(
            F.sum("rows").alias("size"), F.max(F.struct("rows", "part")).alias("largest"), F.count("*").alias("parts")
        )
        nodes = nodes.filter("parts > 1").select("node", "size", F.col("largest.part").alias("largest"), F.col("largest.rows").alias("rows"))
        nodes = stored(self.spark, fitted(nodes, total), f"chosenpath-nodes-{self.number}")
        open_ = stored(self.spark, _meet(placed, nodes, "node", total), f"chosenpath-open-{self.number}")
        return open_, nodes, open_.count()

    def stars(self, rows: DataFrame, nodes: DataFrame, total: int) -> DataFrame:
        """Pairs of each class outside the largest component with one class of it, another one each round."""
        turn = F.struct(F.xxhash64(F.lit(self.number), "set").alias("turn"), "set", "n")
        centers = fitted(rows.filter("part = largest").groupBy("node").agg(F.min(turn).alias("center")), total)
        sized = centers.join(nodes.select("node", "size"), "node").select("node", "size", F.col("center.set").alias("b"), F.col("center.n").alias("n_b"))
        outside = rows.filter("part != largest").select("node", F.col("set").alias("a"), F.col("n").alias("n_a"))
        return self._near(_meet(outside, fitted(sized, total), "node", total))

    def exhaust(self, rows: DataFrame) -> DataFrame:
        """The rows (group, set, part, few) of the blocks of nodes, or families, with few classes outside the largest component."""
        block = self.limits["block"]
        blocks = F.ceil(F.col("size") / block).cast("int")
        few = F.col("part") != F.col("largest")
        own = F.pmod(F.xxhash64("set"), blocks).cast("int")
        # Every row is one of the others of its block; the few are also rows of every block of their node.
        others = rows.select("node", "set", "part", F.lit(False).alias("few"), own.alias("block"))
        asked = rows.filter(few).select("node", "set", "part", F.lit(True).alias("few"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
        return others.unionAll(asked).select(F.xxhash64("node", "block").alias("group"), "set", "part", "few")

    def exhaust_large(self, rows: DataFrame) -> DataFrame:
        """The same for nodes of any size: every block of a node meets every block of it, each pair of blocks in a task of its own."""
        block = self.limits["block"]
        blocks = F.ceil(F.col("size") / block).cast("int")
        own = F.pmod(F.xxhash64("set"), blocks).cast("int")
        dealt = rows.select("node", "set", "part", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        asked = dealt.filter("own <= other").select("node", "set", "part", F.lit(True).alias("few"), F.col("own").alias("i"), F.col("other").alias("j"))
        others = dealt.filter("own >= other").select("node", "set", "part", F.lit(False).alias("few"), F.col("other").alias("i"), F.col("own").alias("j"))
        return others.unionAll(asked).select(F.xxhash64("node", "i", "j").alias("group"), "set", "part", "few")

    def _blocks(self, dealt: DataFrame, total: int, hashes: DataFrame | None = None) -> DataFrame:
        """Pairs that connect the likely pairs of each block; with the sets' hashes: the similar ones."""
        full = dealt.join(self.classes.select("set", "n", "tokens"), "set")
        full = fitted(full if hashes is None else full.join(hashes, "set"), total)
        full = full.select("group", "set", "part", "few", "n", "tokens", *([] if hashes is None else ["hashes"]))
        full = full.repartition("group").sortWithinPartitions("group")
        return full.mapInArrow(_compare(self.percent, hashes is not None), "a binary, b binary")

    def branch(self, rows: DataFrame, total: int) -> DataFrame:
        """(node, set, n) of the children of the nodes."""
        full = fitted(rows.select("node", "set", "n").join(self.classes.select("set", "tokens"), "set"), total)
        chosen = [F.pmod(F.xxhash64("node", F.lit(k)), F.lit(POSITIONS)).cast("int") for k in range(BRANCHES)]
        # Two different positions for each node.
        for k in range(1, BRANCHES):
            chosen[k] = F.pmod(chosen[k] + F.when(chosen[k] == chosen[k - 1], 1).otherwise(0), F.lit(POSITIONS)).cast("int")
        children = [F.xxhash64("node", p, _token(p)) for p in chosen]
        return full.select("set", "n", F.explode(F.array(*children)).alias("node"))


def _token(position: Column) -> Column:
    return F.substring("tokens", position * 4 + 1, F.lit(4))


def link_documents(
    spark: SparkSession,
    docs: DataFrame,
    size: int = WORDS,
    percent: int = PERCENT,
    recall: float = RECALL,
    small: int = SMALL,
    block: int = BLOCK,
    levels: int = LEVELS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, components): doc_id, n, set of every row; set, rep of every class; set, part of linked classes."""
    with shuffles_released(spark):
        join = _Join(spark, docs, size, percent, {"small": small, "block": block})
        trees = trees_for(recall, percent)
        members = join.roots(trees)
        center = F.min(F.struct("set", "n"))
        nodes = members.groupBy("node").agg(F.count("*").alias("size"), center.alias("center")).filter("size > 1")
        nodes = nodes.select("node", "size", F.col("center.set").alias("b"), F.col("center.n").alias("n_b"))
        total = join.classes.count() * BRANCHES * trees
        rows = stored(spark, _meet(members, stored(spark, fitted(nodes, total), "chosenpath-roots"), "node", total), "chosenpath-members")
        pairs = rows.select(F.col("set").alias("a"), F.col("n").alias("n_a"), "b", "n_b").filter("a != b")
        join.check(join._near(pairs), rows.count())
        rows = rows.select("node", "set", "n")
        for _ in range(ROUNDS):
            open_, nodes, total = join.open_rows(rows)
            outside = fitted(open_.filter("part != largest").select("set").distinct(), total).count()
            rows = open_.select("node", "set", "n")
            if not outside or join.check(join.stars(open_, nodes, total), total) < outside / 20:
                break
        for level in range(levels + 1):
            open_, nodes, total = join.open_rows(rows)
            if not total:
                break
            few = F.col("size") - F.col("rows") <= small
            join.settle(join.exhaust(open_.filter(few)))
            large = open_.filter(~few)
            if large.isEmpty():
                break
            if level == levels:
                join.settle(join.exhaust_large(large))
            else:
                rows = stored(spark, join.branch(large, total), f"chosenpath-level-{level}")
        return join.rows.select("doc_id", "n", "set"), join.classes.select("set", "rep"), join.parts()


def group_documents(spark: SparkSession, docs: DataFrame, size: int = WORDS, percent: int = PERCENT, **parameters) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    rows, classes, parts = link_documents(spark, docs, size, percent, **parameters)
    placed = classes.join(parts, "set", "left").select("set", "rep", F.coalesce("part", "set").alias("part"))
    total = rows.count()
    placed = fitted(placed, total)
    least = fitted(placed.groupBy("part").agg(F.min("rep").alias("component_id"), F.count("*").alias("sets")), total)
    # Classes of several rows or components get their name by join; all other rows name themselves.
    named = fitted(placed.join(least, "part"), total).select("set", "rep", "component_id", "sets")
    full = rows.filter("n > 0 AND doc_id IS NOT NULL")
    sizes = fitted(full.groupBy("set").agg(F.count("*").alias("size")), total)
    several = fitted(sizes.join(named, "set"), total).filter("size > 1 OR sets > 1")
    joined = _meet(full, several.select("set", "size", "component_id"), "set", total, "left")
    joined = joined.select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id"))
    other = rows.filter("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return joined.unionAll(other).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )
