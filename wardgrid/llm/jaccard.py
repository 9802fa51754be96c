"""Exact Jaccard join of documents on word shingles, filtered by several global token orders.

A document's set is its distinct shingles. Documents with equal sets form a class, which its
smallest doc_id stands for. If two sets reach similarity t, then under every global order of
shingles their prefixes (the first n - ceil(t * n) + 1 of n shingles) share a shingle. Three orders
are used; a pair is verified only if it passes all of them and the length filter:

1. rarest first, ties by a hash: an inverted index on these prefixes makes the candidate pairs. At the
   first shingle that two sets share under the order, those before it are shared by neither, so the
   places of that shingle bound the intersection. A bucket passes only pairs within that bound; a
   pair that meets in several buckets is held to it at its first one, so no link is lost;
2. rarest first in coarser steps, ties by another hash;
3. by a third hash alone.

How rare a shingle is comes from one sketch of counters over all documents (summed in Spark, a
fixed size). An order needs no exact counts, only one rank per shingle for all documents.

Links are needed to group documents, so pairs within what is already one group need no check. First
every document of an index bucket meets the document with the fewest rarer shingles; verified links are joined
into components. Then, in the buckets that still hold more than one component, documents meet a
representative of another component, and at last all pairs of different components in such buckets
are checked, so no link between components is lost. Buckets are cut by length classes, so that
documents of too different lengths never meet. A group of near copies costs one pair per
document instead of the square.

Similarity counts 64-bit hashes of shingles (chance of a wrong count below 1e-12 per pair).

Edge cases: null or blank text has no shingles, n_shingles 0 and is its own component; texts of
fewer words than a shingle have one, the whole sequence; a null doc_id takes no part and gets a
null component unless its set equals that of a document with an id; rows that repeat a doc_id are
one node; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm import words
from wardgrid.llm.components import components
from wardgrid.llm.shared import broadcast_if_small, is_small, stored

WORDS = 4
PERCENT = 85
SKETCH_BITS = 22
CHUNK_BITS = 16
#: Document ids of candidates up to this many (8 bytes each) are broadcast to pick their texts.
MAX_BROADCAST_IDS = 500_000


def shingle_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    hashes, bounds = words.hashed(texts)
    mixed = np.zeros(len(hashes), np.uint64)
    if len(hashes) >= size:
        total = hashes[: len(hashes) - size + 1].copy()
        for k in range(1, size):
            total = words.mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - size + 1 + k])
        mixed[: len(total)] = total
    out = []
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        if last - first >= size:
            out.append(np.unique(mixed[first : last - size + 1]))
        elif last > first:
            whole = np.array([size * 1000 + last - first], np.uint64)
            for h in hashes[first:last]:
                whole = words.mix(whole * np.uint64(0x9E3779B97F4A7C15) + h)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def order_keys(tokens: np.ndarray, levels: np.ndarray, number: int) -> np.ndarray:
    """Rank of shingles under one of the three global orders; smaller comes first."""
    spread = words.mix(tokens ^ np.uint64(0xA0761D6478BD642F + number * 0x1000003))
    if number == 3:
        return spread
    level = levels[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    if number == 2:
        level = level >> np.uint64(1)
    return level << np.uint64(56) | spread >> np.uint64(8)


def prefix(tokens: np.ndarray, levels: np.ndarray, number: int, percent: int = PERCENT) -> np.ndarray:
    """The first shingles under an order (ties by the shingle itself), in that order."""
    if not len(tokens):
        return tokens
    keys, keep = order_keys(tokens, levels, number), prefix_length(len(tokens), percent)
    first = keys <= np.partition(keys, keep - 1)[keep - 1]
    return tokens[first][np.lexsort((tokens[first], keys[first]))]


def _scan(size: int):
    """Rows (doc_id, n, digest) of documents, and of the task's sketch: chunk in n, counters in digest."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        names, counters = ["kind", "doc_id", "n", "digest"], np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for part in words.chunks(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                digests = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
                lengths = pa.array([len(s) for s in sets], pa.int64())
                tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                places = (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                counters += np.bincount(places, minlength=1 << SKETCH_BITS).astype(np.uint32)
                kind = pa.array(np.zeros(len(part), np.int32))
                yield pa.RecordBatch.from_arrays([kind, part.column("doc_id"), lengths, pa.array(digests, pa.binary())], names=names)
        if counters.any():
            chunks = counters.reshape(-1, 1 << CHUNK_BITS)
            n = len(chunks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(n, np.int32)),
                    pa.nulls(n, pa.int64()),
                    pa.array(np.arange(n)),
                    pa.array([c.tobytes() for c in chunks], pa.binary()),
                ],
                names=names,
            )

    return scan


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch.column("n").to_pylist(), batch.column("digest").to_pylist(), strict=True):
            counts = np.frombuffer(raw, np.uint32).astype(np.uint64)
            sums[chunk] = sums.get(chunk, 0) + counts
    # A level per counter: half steps of log2 of its count.
    levels = {k: np.minimum(255, np.floor(2 * np.log2(v.astype(np.float64) + 1))).astype(np.uint8) for k, v in sums.items()}
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(levels), pa.int64()), pa.array([v.tobytes() for v in levels.values()], pa.binary())], names=["chunk", "levels"]
    )



def _first_prefixes(levels, size: int, percent: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(levels.value, np.uint8)
        for batch in batches:
            for part in words.chunks(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                found = [prefix(s, rank, 1, percent) for s in sets]
                ends = np.concatenate([[0], np.cumsum([len(f) for f in found])])
                flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))
                lengths = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lengths, tokens], names=["doc", "n", "tokens"])

    return emit


def _candidates(levels, size: int, percent: int):
    """Length and the prefixes under orders 2 and 3 (32 bits of each shingle do for a filter)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(levels.value, np.uint8)
        for batch in batches:
            for part in words.chunks(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64())]
                for number in (2, 3):
                    found = [(prefix(s, rank, number, percent) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32) for s in sets]
                    ends = np.concatenate([[0], np.cumsum([len(f) for f in found])])
                    flat = np.concatenate(found) if found else np.zeros(0, np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
                columns.append(part.column("text"))
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "second", "third", "text"])

    return emit


def _verify(size: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in words.chunks(batch, "text_b"):
                keep = []
                rights = shingle_sets(part.column("text_b"), size)
                for i, (a, right) in enumerate(zip(part.column("a").to_pylist(), rights, strict=True)):
                    text = part.column("text_a")[i]
                    if (a, text) != last:
                        last, left = (a, text), shingle_sets(pa.array([text.as_py()]), size)[0]
                    shared = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(shared > 0 and 100 * shared >= percent * (len(left) + len(right) - shared))
                chosen = part.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], names=["a", "b"])

    return verify


def _possible(n_a: Column, before_a: Column, n_b: Column, before_b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough if they share nothing before these places."""
    most = F.least(n_a - before_a, n_b - before_b)
    return 100 * most >= percent * (n_a + n_b - most)


def _linked(spark: SparkSession, pairs: DataFrame, cand: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a < b) that reach the similarity: length and order filters, then whole sets.

    Only texts of documents in pairs that pass the filters are shuffled, if those ids are few
    enough to broadcast; else all candidate texts are.
    """
    light = cand.select("doc", "n", "second", "third")
    left = light.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("second").alias("s_a"), F.col("third").alias("t_a"))
    right = light.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("second").alias("s_b"), F.col("third").alias("t_b"))
    passed = (
        pairs.join(right, "b")
        .join(left, "a")
        .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .filter(F.arrays_overlap("s_a", "s_b") & F.arrays_overlap("t_a", "t_b"))
        .select("a", "b")
    )
    passed = stored(spark, passed, "jaccard-passed")
    ids = passed.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    texts = cand.select("doc", "text")
    texts = texts.join(F.broadcast(ids), "doc", "left_semi") if is_small(ids, MAX_BROADCAST_IDS) else texts
    whole = passed.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a"
    )
    return whole.select("a", "b", "text_a", "text_b").mapInArrow(_verify(size, percent), "a long, b long").distinct()


def join(spark: SparkSession, docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(rows, components): doc_id, n, digest of every document; node, component of linked classes.

    A node is the smallest doc_id of a class of equal sets.
    """
    texts = docs.select("doc_id", "text")
    scanned = stored(spark, texts.mapInArrow(_scan(size), "kind int, doc_id long, n long, digest binary"), "jaccard-scan")
    rows = scanned.filter("kind = 0").drop("kind")
    summed = scanned.filter("kind = 1").select("n", "digest").repartition(1 << (SKETCH_BITS - CHUNK_BITS), "n")
    ranks = np.zeros((1 << (SKETCH_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.uint8)
    for r in summed.mapInArrow(_add_up, "chunk long, levels binary").collect():
        ranks[r["chunk"]] = np.frombuffer(r["levels"], np.uint8)
    levels = spark.sparkContext.broadcast(ranks.tobytes())

    # Copies: documents whose set has a smaller doc_id.
    known = rows.filter("n > 0 AND doc_id IS NOT NULL")
    several = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")).filter("rows > 1")
    # Ids with several sets: rows of one id are one node, so its classes are linked and none of its rows leaves.
    name = F.xxhash64("digest")
    mixed = known.groupBy("doc_id").agg(F.min(name).alias("least"), F.max(name).alias("most")).filter("least != most").select("doc_id")
    mixed = broadcast_if_small(stored(spark, mixed, "jaccard-mixed"), MAX_BROADCAST_IDS)
    same = known.join(mixed, "doc_id").join(several.select("digest", "rep"), "digest", "left").filter("rep != doc_id")
    same = same.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    copies = known.join(several, "digest").filter("doc_id > rep").join(mixed, "doc_id", "left_anti").select(F.col("doc_id").alias("doc")).distinct()
    prefixes = texts.filter("doc_id IS NOT NULL").mapInArrow(_first_prefixes(levels, size, percent), "doc long, n long, tokens array<long>")
    copies = broadcast_if_small(copies, MAX_BROADCAST_IDS)
    prefixes = stored(spark, prefixes.filter(F.size("tokens") > 0).join(copies, "doc", "left_anti"), "jaccard-prefixes")
    index = prefixes.select(F.posexplode("tokens").alias("before", "token"), "doc", "n")
    shared = index.groupBy("token").agg(F.count("*").alias("rows")).filter("rows > 1")
    # Sets that reach the similarity are of the same or of neighbouring length classes; each document
    # is in the bucket of its own class and of the one below, so such sets always share a bucket.
    length_class = F.floor(F.log("n") / F.lit(float(np.log(100 / percent)) if percent < 100 else 1.0)).cast("int")
    classed = index.join(shared.select("token"), "token").select(
        "token", "doc", "n", "before", F.explode(F.array(length_class, length_class - 1)).alias("class")
    )
    classed = stored(spark, classed, "jaccard-classed")
    place = F.struct((F.col("before") / F.col("n")).alias("share"), "doc", "n", "before")
    centers = classed.groupBy("token", "class").agg(F.min(place).alias("center"), F.min("doc").alias("low"), F.max("doc").alias("high"))
    buckets = classed.join(centers.filter("low < high").drop("low", "high"), ["token", "class"])
    buckets = stored(spark, buckets, "jaccard-buckets")

    ids = buckets.select(F.col("doc").alias("doc_id")).distinct()
    ids = F.broadcast(ids) if is_small(ids, MAX_BROADCAST_IDS) else ids
    cand = texts.join(ids, "doc_id", "left_semi").mapInArrow(
        _candidates(levels, size, percent), "doc long, n long, second array<int>, third array<int>, text string"
    )
    cand = stored(spark, cand, "jaccard-candidates")

    meet = _possible(F.col("n"), F.col("before"), F.col("center.n"), F.col("center.before"), percent)
    pairs = buckets.filter((F.col("doc") != F.col("center.doc")) & meet)
    pairs = pairs.select(F.least("doc", "center.doc").alias("a"), F.greatest("doc", "center.doc").alias("b"))
    pairs = stored(spark, pairs.distinct(), "jaccard-pairs-0")
    links = stored(spark, _linked(spark, pairs, cand, size, percent).unionAll(same), "jaccard-links-0")
    tried = pairs
    for number in (1, 2):
        found = components(spark, links)
        placed = buckets.select("token", "class", "doc", "n", "before").join(found, F.col("doc") == F.col("node"), "left")
        placed = placed.select("token", "class", "doc", "n", "before", F.coalesce("component", "doc").alias("part"))
        share = F.col("before") / F.col("n")
        ends = placed.groupBy("token", "class").agg(
            F.min(F.struct("part", share.alias("share"), "doc", "n", "before")).alias("low"),
            F.max(F.struct("part", (-share).alias("share"), "doc", "n", "before")).alias("high"),
        )
        apart = ends.filter("low.part != high.part")
        open_ = placed.join(apart, ["token", "class"])
        if number == 1:  # one representative of another component for each document
            other = F.when(F.col("part") == F.col("low.part"), F.col("high")).otherwise(F.col("low"))
            more = (
                open_.withColumn("other", other)
                .filter(_possible(F.col("n"), F.col("before"), F.col("other.n"), F.col("other.before"), percent))
                .select(F.least("doc", "other.doc").alias("a"), F.greatest("doc", "other.doc").alias("b"))
            )
        else:  # every pair of different components that shares a bucket
            open_ = stored(spark, open_.select("token", "class", "doc", "n", "before", "part"), "jaccard-open")
            left = open_.toDF("token", "class", "a", "n_a", "before_a", "part_a")
            right = open_.toDF("token", "class", "b", "n_b", "before_b", "part_b")
            more = left.join(right, ["token", "class"]).filter(
                (F.col("a") < F.col("b"))
                & (F.col("part_a") != F.col("part_b"))
                & _possible(F.col("n_a"), F.col("before_a"), F.col("n_b"), F.col("before_b"), percent)
            )
            more = more.select("a", "b")
        more = stored(spark, more.distinct().join(tried, ["a", "b"], "left_anti"), f"jaccard-pairs-{number}")
        tried = tried.unionAll(more)
        links = stored(spark, links.unionAll(_linked(spark, more, cand, size, percent)), f"jaccard-links-{number}")
    return rows, components(spark, links)


def group_documents(spark: SparkSession, docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    rows, found = join(spark, docs, size, percent)
    full = rows.filter("n > 0")
    several = full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")).filter("rows > 1")
    classed = full.join(several.select("digest", "rep"), "digest", "left").select(
        "doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")
    )
    joined = classed.join(found, F.col("rep") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")
    )
    empty = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return joined.unionAll(empty)


def drop_near_copies(spark: SparkSession, docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each group of near copies, that with the smallest doc_id; empty texts all stay.

    Rows are compared by their own texts: rows that repeat a doc_id leave only as copies of a kept row.
    Rows with a null doc_id all stay.
    """
    several = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    several = stored(spark, several, "jaccard-repeated")
    if several.isEmpty():
        grouped = stored(spark, group_documents(spark, docs, size, percent), "jaccard-groups")
        dropped = grouped.filter("doc_id != component_id").select("doc_id")
        return docs.join(broadcast_if_small(dropped, MAX_BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)
    # Rows that repeat an id get keys of their own, beyond all ids; a written table keeps them the same.
    several = broadcast_if_small(several, MAX_BROADCAST_IDS)
    first = docs.agg(F.max("doc_id")).first()[0] + 1
    names = [f"_c{i}" for i in range(len(docs.columns))]
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    renamed = docs.toDF(*names)
    marked = several.withColumnRenamed("doc_id", doc_id)
    repeated = renamed.join(marked, doc_id, "left_semi").withColumn("_key", F.lit(first) + F.monotonically_increasing_id())
    rows = renamed.join(marked, doc_id, "left_anti").withColumn("_key", F.col(doc_id)).unionByName(stored(spark, repeated, "jaccard-repeated-rows"))
    grouped = group_documents(spark, rows.select(F.col("_key").alias("doc_id"), F.col(text).alias("text")), size, percent)
    grouped = stored(spark, grouped.filter("doc_id IS NOT NULL").withColumnRenamed("doc_id", "_key"), "jaccard-groups")
    owners = grouped.join(rows.select("_key", F.col(doc_id).alias("owner")), "_key")
    kept = owners.groupBy("component_id").agg(F.min(F.struct("owner", "_key")).alias("kept"))
    kept = kept.filter("component_id != kept._key").select("component_id", F.col("kept._key").alias("kept"))
    dropped = grouped.join(broadcast_if_small(kept, MAX_BROADCAST_IDS), "component_id", "left")
    dropped = dropped.filter(F.col("_key") != F.coalesce("kept", "component_id")).select("_key")
    left = rows.join(broadcast_if_small(dropped, MAX_BROADCAST_IDS), "_key", "left_anti")
    return left.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
