"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the hashed words of the whole text, and over their first HEADS bytes, which
gather the forms of a stem. A feature counts log(1 + occurrences), so long texts neither hide a few
insults nor gather weight from plain words. For every labelled text with identity terms a
counterfactual is made by swapping each term for its partner (women and men, and so on), with the heads
of both: its counts are those of the swapped words, heads that other words share included. Training
adds a penalty on the squared difference of the two scores, so that a group's mention
by itself moves the score little; that lowers false positives on neutral mentions.

Labels are learned from a bounded sample of labelled rows (TRAIN_ROWS of each label, chosen by hash);
which rows may teach is a condition that the caller gives. Features are hashed in Spark tasks, one task
trains with numpy on the sample's counts, and only the weights reach the driver. Every text is scored whole.

Edge cases: null and empty texts get the score of the intercept; without labels of both kinds every
score is 0; a document labelled more than once counts as toxic if any of its labels says so; a null
label or doc_id teaches nothing; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import words
from wardgrid.llm.langid import fold
from wardgrid.llm.shared import broadcast_if_small

BITS = 22
HEADS = (5, 6, 7, 8)
TRAIN_ROWS = 4000
TRAIN_WORDS = 4_000_000
STEPS = 300
RIDGE = 5e-4
FAIRNESS = 1.0
LEAST_TEXTS = 6
#: Pairs of the sample that training handles at a time.
BLOCK = 1 << 18
THRESHOLD = 0.3
#: Text bytes whose features a task holds at once.
CHUNK = 2 << 20
#: Toxic rows weigh this much more in training: a missed insult costs more than a false alarm.
TOXIC_WEIGHT = 2.0

# Identity terms that are swapped for each other.
IDENTITY_PAIRS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("girl", "boy"),
    ("female", "male"),
    ("gay", "straight"),
    ("lesbian", "heterosexual"),
    ("transgender", "cisgender"),
    ("black", "white"),
    ("asian", "european"),
    ("african", "american"),
    ("muslim", "christian"),
    ("muslims", "christians"),
    ("jewish", "catholic"),
    ("immigrants", "citizens"),
    ("immigrant", "citizen"),
    ("disabled", "healthy"),
    ("deaf", "hearing"),
    ("elderly", "young"),
)

#: Marks stripped from both ends of a word before hashing.
_MARKS = np.zeros(256, bool)
_MARKS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_BLANK = words.FOLD.copy()
_BLANK[_MARKS] = 0x20


def features(texts: pa.Array, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(feature of every word and word head, offsets per text); ASCII marks part words as blanks do.

    With `weights`, only features that have one: a long text is then held as these alone.
    """
    # Marks become blanks before words are found, so "idiot!" is "idiot".
    data, offsets = words.buffers(texts)
    first, last = (int(offsets[0]), int(offsets[-1])) if len(data) else (0, 0)
    starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if last > first:
        blank = _BLANK[data[first:last]]
        for _, start, _, hashes in words.spans(blank, offsets - first, words.KEEP, heads=HEADS):
            # Word by word: the word, then those of its heads that there are.
            given = hashes.T != 0
            given[:, 0] = True
            feature = (hashes.T >> np.uint64(64 - BITS)).astype(np.int64)
            if weights is not None:
                given &= weights[feature] != 0
            starts.append(np.repeat(start, given.sum(axis=1)))
            found.append(feature[given])
    return np.concatenate(found), np.searchsorted(np.concatenate(starts), offsets - first, "left")


def features_of(word: str) -> list[int]:
    """The word's feature, then those of its heads."""
    return features(pa.array([word]))[0].tolist()


def counted(feature: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, log(1 + count)) of each distinct feature of each text."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key, count = np.unique(row << BITS | feature, return_counts=True)
    return key >> BITS, key & ((1 << BITS) - 1), np.log1p(count)


# ---------------------------------------------------------------------------- model


def swap_table(pairs: Sequence[tuple[str, str]]) -> dict[int, tuple[list[int], list[int]]]:
    """For each term's own feature: all features that a swap takes away, and all that it brings."""
    table: dict[int, tuple[list[int], list[int]]] = {}
    for a, b in pairs:
        one, other = features_of(a), features_of(b)
        table |= {one[0]: (one, other), other[0]: (other, one)}
    return table


def swapped(
    row: np.ndarray, feature: np.ndarray, value: np.ndarray, swap: dict[int, tuple[list[int], list[int]]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value less its value in the swapped text) wherever a swap changes the count.

    Takes all features of the texts as `counted` gives them, in order of row and feature.
    """
    key, count = row << BITS | feature, np.rint(np.expm1(value))
    keys, changes = [np.zeros(0, np.int64)], [np.zeros(0)]
    for term, (own, other) in swap.items():
        at = np.flatnonzero(feature == term)
        for found, sign in ((own, -1.0), (other, 1.0)):
            for f in found:
                keys.append(row[at] << BITS | f)
                changes.append(sign * count[at])
    changed, place = np.unique(np.concatenate(keys), return_inverse=True)
    change = np.bincount(place, np.concatenate(changes), len(changed))
    changed, change = changed[change != 0], change[change != 0]
    before = np.zeros(len(changed))
    if len(key):
        at = np.minimum(np.searchsorted(key, changed), len(key) - 1)
        before = np.where(key[at] == changed, count[at], 0.0)
    difference = np.log1p(before) - np.log1p(np.maximum(0.0, before + change))
    return changed >> BITS, changed & ((1 << BITS) - 1), difference


def train(
    row: np.ndarray,
    feature: np.ndarray,
    value: np.ndarray,
    labels: np.ndarray,
    weights: np.ndarray | None = None,
    pairs: Sequence[tuple[str, str]] = IDENTITY_PAIRS,
    fairness: float = FAIRNESS,
    steps: int = STEPS,
    ridge: float = RIDGE,
    least_texts: int = LEAST_TEXTS,
) -> tuple[np.ndarray, float]:
    """(weight per feature, intercept) by gradient steps on

    weighted log-loss + ridge * |w|^2 + fairness * mean((score(x) - score(swapped x))^2),

    scores before the logistic function; the last mean is over texts with identity terms. Features
    of fewer than least_texts texts stay at 0, but identity terms and their heads always count.
    """
    n = len(labels)
    weights = np.ones(n) if weights is None else weights / weights.mean()
    swap = swap_table(pairs)
    terms = np.array(sorted({f for own, _ in swap.values() for f in own}), np.int64)
    # The difference that a swap makes, from the counts of all features of the texts that hold a term.
    is_swapped = np.zeros(1 << BITS, bool)
    is_swapped[list(swap)] = True
    holds = np.zeros(n, bool)
    holds[row[is_swapped[feature]]] = True
    part = np.flatnonzero(holds[row])
    d_row, d_feature, d_value = swapped(row[part].astype(np.int64), feature[part].astype(np.int64), value[part], swap)
    touched = max(1, int(holds.sum()))
    often = np.bincount(feature, minlength=1 << BITS) >= least_texts
    often[terms] = True
    keep = np.flatnonzero(often[feature])
    row, feature, value = row[keep], feature[keep], value[keep]
    del keep, part
    marked = np.zeros(1 << BITS, bool)
    marked[feature] = True
    marked[terms] = True
    used = np.flatnonzero(marked)
    place = np.zeros(1 << BITS, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    column, d_column = place[feature], place[d_feature]
    del feature, place, marked, often
    mean, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    base = np.clip((weights * labels).sum() / weights.sum(), 1e-6, 1 - 1e-6)
    w, b = np.zeros(len(used)), float(np.log(base / (1 - base)))
    cuts = range(0, len(row), BLOCK)
    for step in range(1, steps + 1):
        score = np.full(n, b)
        for at in cuts:  # a block at a time: no further array is as long as the sample
            block = slice(at, at + BLOCK)
            score += np.bincount(row[block], w[column[block]] * value[block], n)
        error = weights * (1 / (1 + np.exp(-np.clip(score, -40, 40))) - labels) / n
        gradient = 2 * ridge * w
        for at in cuts:
            block = slice(at, at + BLOCK)
            gradient += np.bincount(column[block], error[row[block]] * value[block], len(used))
        if len(d_row) and fairness:
            gap = np.bincount(d_row, w[d_column] * d_value, n)
            gradient += 2 * fairness / touched * np.bincount(d_column, gap[d_row] * d_value, len(used))
        g = np.append(gradient, error.sum())
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-10)
        w -= move[:-1]
        b -= float(move[-1])
    out = np.zeros(1 << BITS, np.float32)
    out[used] = w
    return out, b


def score_features(feature: np.ndarray, bounds: np.ndarray, weights: np.ndarray, intercept: float) -> np.ndarray:
    """Probability per text, from its features that have a weight (others add nothing)."""
    row, found, value = counted(feature, bounds)
    score = np.bincount(row, weights[found] * value, minlength=len(bounds) - 1) + intercept
    return 1 / (1 + np.exp(-np.clip(score, -40, 40)))


# ---------------------------------------------------------------------------- Spark


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.chunks(batch, "text", CHUNK):
            row, feature, value = counted(*features(part.column("text")))
            ends = np.searchsorted(row, np.arange(len(part) + 1))
            packed = [(feature[a:b].astype(np.int32).tobytes(), value[a:b].astype(np.float32).tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            lists = [pa.array([x[i] for x in packed], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), part.column("weight"), *lists],
                names=["doc_id", "label", "weight", "features", "counts"],
            )


def learn(docs: DataFrame, labels: DataFrame, may_teach: Column, rows: int = TRAIN_ROWS, **parameters) -> tuple[np.ndarray, float] | None:
    """Trains on at most about `rows` documents of each label; a label's rows weigh as in the whole."""
    known = (
        labels.filter(may_teach & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("label"))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("label") == 1, rows / counts[1]).otherwise(rows / counts[0])
    draw = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.filter(draw < share).select("doc_id", "label", (F.greatest(F.lit(1.0), 1 / share) * F.when(F.col("label") == 1, TOXIC_WEIGHT).otherwise(1.0)).alias("weight"))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    chosen = texts.join(broadcast_if_small(sample), "doc_id")
    found = chosen.select("doc_id", "label", "weight", "text").mapInArrow(
        _feature_counts, "doc_id long, label int, weight double, features binary, counts binary"
    )
    # The sample's bound in words: at most TRAIN_WORDS (feature, count) pairs reach the task that trains.
    total = found.agg(F.sum(F.length("features") / 4)).first()[0] or 0
    if total > TRAIN_WORDS:
        found = found.filter(F.pmod(F.xxhash64(F.lit("bound"), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * TRAIN_WORDS / total))
    trained = found.repartition(1).mapInArrow(_trainer(parameters), "features binary, weights binary, intercept double").collect()
    if not trained:
        return None
    weights = np.zeros(1 << BITS, np.float32)
    weights[np.frombuffer(trained[0]["features"], np.int32)] = np.frombuffer(trained[0]["weights"], np.float32)
    return weights, trained[0]["intercept"]


def _trainer(parameters: dict):
    """The model of a whole sample as one row: features with a weight, their weights, intercept; none without both labels."""

    def trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        taken = pa.Table.from_batches(parts)
        del parts
        if len(set(taken.column("label").to_pylist())) < 2:
            return
        sizes = pa.compute.binary_length(taken.column("features"))
        taken = taken.append_column("size", sizes).sort_by([("doc_id", "ascending"), ("size", "ascending")])
        lengths = taken.column("size").to_numpy() // 4
        label, weight = (taken.column(c).to_numpy().astype(np.float64) for c in ("label", "weight"))
        feature = _joined(taken.column("features"), np.int32)
        value = _joined(taken.column("counts"), np.float32)
        del taken
        row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        weights, intercept = train(row, feature, value, label, weight, **parameters)
        places = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([places.astype(np.int32).tobytes()], pa.binary()), pa.array([weights[places].tobytes()], pa.binary()), pa.array([intercept], pa.float64())],
            names=["features", "weights", "intercept"],
        )

    return trainer


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers of a binary column, one row after the other."""
    data, offsets = words.buffers(column)
    return data[offsets[0] : offsets[-1]].view(kind)


def _scorer(model: tuple[np.ndarray, float] | None, column: str, keep: bool = False):
    """Adds the score of the texts in a column, in its place or (`keep`) besides."""
    places = np.flatnonzero(model[0]) if model else np.zeros(0, np.int64)
    values, intercept = (model[0][places], model[1]) if model else (np.zeros(0, np.float32), 0.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS, np.float32)
        weights[places] = values
        for batch in batches:
            for part in words.chunks(batch, column, CHUNK):
                feature, bounds = features(part.column(column), weights)
                p = score_features(feature, bounds, weights, intercept) if model else np.zeros(len(part))
                rest = part if keep else part.remove_column(part.schema.get_field_index(column))
                yield rest.append_column("score", pa.array(p, pa.float64()))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, may_teach: Column | None = None, **parameters) -> DataFrame:
    """doc_id, held_out, score, predicted of every document (doc_id, text)."""
    held_out = fold(F.col("doc_id")) == 2
    model = learn(docs, labels, ~held_out if may_teach is None else may_teach, **parameters)
    scored = docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        _scorer(model, "text"), "doc_id long, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **parameters) -> DataFrame:
    """docs without those scored at or above the threshold; all columns are kept."""
    model = learn(docs, labels, fold(F.col("doc_id")) != 2, **parameters)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    schema = ", ".join(f"`{n}` {t}" for n, t in renamed.dtypes)
    scored = renamed.mapInArrow(_scorer(model, text, keep=True), f"{schema}, score double")
    return scored.filter(F.col("score") < threshold).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
