"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

The index holds the benchmark's items, in pieces of at most PIECE_WORDS words. Its postings are
cut by blocks of pieces, each with its greatest score. Scores are BM25 weights divided by what the piece
itself would get, so one threshold fits all. Every training document is read whole, as overlapping
passages; each passage is a query, and all pieces at or above the threshold are retrieved:

1. passages whose words' greatest scores do not add up to the threshold have no pivot at all and
   are skipped (running sums over whole batches), as are those whose greatest scores in no block of
   pieces do (sums over all passages and blocks at once);
2. the others run block-max WAND, which moves from pivot to pivot and skips blocks likewise;
3. a retrieved item is verified: enough of its word trigrams must occur near the passage. An item that
   is a question with an answer (see `split_item`) needs enough of each; any other is taken whole, and
   both overlaps are that of the whole item.

Document frequencies, mean and greatest piece length are Spark aggregates over the whole benchmark. Items
are dealt by hash to parts of about INDEX_ITEMS; a task for each part builds its index from these common
statistics and writes it to the shared folder, where the scanning tasks read one part at a time. So neither
rows nor scores depend on the number of parts, documents are scanned in one plan, and the driver holds only
the parts' paths.

Words are runs without blanks and ASCII marks, A-Z in lower case. Edge cases: null or blank texts,
items without words and null item_ids match nothing; repeated documents are reported once for each row,
repeated items count once, and of items that share an item_id the best is reported; an empty benchmark or an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import words
from wardgrid.llm.shared import broadcast_if_small, make_folder, open_file, stored, work_path, write_file

K1, B = 1.2, 0.75
PIECE_WORDS = 64
BLOCK = 4
CELLS = 1 << 20
THRESHOLD = 0.55
LEAST_QUESTION = 0.6
LEAST_ANSWER = 0.5
INDEX_ITEMS = 20_000
NGRAM = 3
#: Text held at once by a task that reads several parts for it.
READ_BYTES = 64 << 20
#: Text bytes whose words are looked up at once.
CHUNK = 2 << 20
#: Rounding allowed for in bounds, so that only scores themselves meet the threshold.
SLACK = 1e-9
LEAKS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"

_FOLD = words.FOLD.copy()
_FOLD[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 0x20


def _words(text: str) -> np.ndarray:
    return words.hashed(pa.array([text]), _FOLD)[0]


def _grams(hashes: np.ndarray, size: int = NGRAM) -> np.ndarray:
    """Hashes of the runs of `size` words; of the whole if there are fewer."""
    size = min(size, len(hashes))
    if not size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        total = words.mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(total)


_LABEL = re.compile(r"(?:^|(?<=\s))answer\s*:|^\s*a\s*:", re.I | re.M)


def split_item(text: str) -> tuple[str, str]:
    """(question, answer) of an item that has that form, else the whole item twice.

    The form is a label "Answer:" (or "A:" at a line's start) between the two, or a question mark
    that ends the last sentence but one, or the last line but one.
    """
    text = text.strip()
    labels = list(_LABEL.finditer(text))
    if labels and text[: labels[-1].start()].strip() and text[labels[-1].end() :].strip():
        return text[: labels[-1].start()], text[labels[-1].end() :]
    for ends in (r"(?<=[.!?])\s+|\n+", r"\n+"):
        parts = [p for p in re.split(ends, text) if p.strip()]
        if len(parts) > 1 and parts[-2].rstrip().endswith("?") and not parts[-1].rstrip().endswith("?"):
            return " ".join(parts[:-1]), parts[-1]
    return text, text


def _pieces(text: str) -> list[np.ndarray]:
    found = _words(text)
    return [found[at : at + PIECE_WORDS] for at in range(0, len(found), PIECE_WORDS)]


class Statistics(NamedTuple):
    """Of the whole benchmark: its pieces, their words, the longest, and the pieces that hold each term (sorted)."""

    pieces: int
    words: int
    longest: int
    terms: np.ndarray
    df: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Statistics:
        pieces = [p for text in texts for p in _pieces(text)]
        flat = np.concatenate([np.zeros(0, np.uint64), *map(np.unique, pieces)])
        return cls(len(pieces), sum(map(len, pieces)), max(map(len, pieces), default=1), *np.unique(flat, return_counts=True))


class Index:
    """Inverted index of items (item_id, text), with the statistics of the benchmark they are a part of."""

    def __init__(self, items: list[tuple[int, str]], statistics: Statistics | None = None) -> None:
        statistics = statistics or Statistics.of([text for _, text in items])
        self.item_ids, self.question, self.answer, self.sizes = [], [], [], []
        pieces, self.owner = [], []
        for item_id, text in items:
            found = _pieces(text)
            if not found:
                continue
            question, answer = split_item(text)
            self.question.append(_words(question))
            self.answer.append(_words(answer))
            self.sizes.append(sum(map(len, found)))
            pieces += found
            self.owner += [len(self.item_ids)] * len(found)
            self.item_ids.append(item_id)
        self.longest = statistics.longest
        counted = [np.unique(p, return_counts=True) for p in pieces]
        flat = np.concatenate([t for t, _ in counted]) if counted else np.zeros(0, np.uint64)
        piece = np.repeat(np.arange(len(pieces)), [len(t) for t, _ in counted])
        tf = np.concatenate([c for _, c in counted]).astype(float) if counted else np.zeros(0)
        self.terms, term, df = np.unique(flat, return_inverse=True, return_counts=True)
        everywhere = statistics.df[np.searchsorted(statistics.terms, self.terms)]
        idf = np.log1p((statistics.pieces - everywhere + 0.5) / (everywhere + 0.5))
        length = np.array([len(p) for p in pieces], float)
        norm = K1 * (1 - B + B * length / max(1.0, statistics.words / max(1, statistics.pieces)))
        score = idf[term] * tf * (K1 + 1) / (tf + norm[piece])
        score /= np.bincount(piece, score, len(pieces))[piece]
        order = np.lexsort((piece, term))
        self.pieces, self.scores = piece[order], score[order]
        self.starts = np.concatenate([[0], np.cumsum(df)]).astype(np.int64)
        self.greatest = np.maximum.reduceat(self.scores, self.starts[:-1]) if len(df) else np.zeros(0)
        # Block-max: each term's greatest score in every block of pieces that it occurs in.
        self.blocks = -(-len(pieces) // BLOCK)
        cell = term[order] * max(1, self.blocks) + self.pieces // BLOCK
        _, first = np.unique(cell, return_index=True)
        self.cell_block = self.pieces[first] // BLOCK
        self.cell_greatest = np.maximum.reduceat(self.scores, first) if len(first) else np.zeros(0)
        self.cell_starts = np.searchsorted(cell[first], np.arange(len(self.terms) + 1) * max(1, self.blocks))

    def block_greatest(self, term: int, block: int) -> float:
        low, high = int(self.cell_starts[term]), int(self.cell_starts[term + 1])
        at = low + int(np.searchsorted(self.cell_block[low:high], block))
        return float(self.cell_greatest[at]) if at < high and self.cell_block[at] == block else 0.0

    def hopeful(self, term: np.ndarray, first: np.ndarray, last: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
        """(passage, its distinct terms) where some block's greatest scores reach the threshold."""
        step = max(1, CELLS // max(1, self.blocks))
        for at in range(0, len(first), step):
            low, high = first[at : at + step], last[at : at + step]
            owner = np.repeat(np.arange(len(low)), high - low)
            found = term[words.runs(low, high - low)]
            key = np.unique(owner[found >= 0] * len(self.terms) + found[found >= 0])
            owner, found = key // len(self.terms), key % len(self.terms)
            count = self.cell_starts[found + 1] - self.cell_starts[found]
            cells = words.runs(self.cell_starts[found], count)
            sums = np.bincount(
                np.repeat(owner, count) * self.blocks + self.cell_block[cells],
                self.cell_greatest[cells],
                minlength=len(low) * self.blocks,
            ).reshape(len(low), self.blocks)
            bounds = np.searchsorted(owner, np.arange(len(low) + 1))
            for i in np.flatnonzero(sums.max(axis=1) >= threshold - SLACK):
                yield at + int(i), found[bounds[i] : bounds[i + 1]]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for words that no item has."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All (piece, score) with a score of at least the threshold: block-max WAND."""
        end = len(self.owner)
        lists = [[int(self.pieces[self.starts[t]]), int(self.starts[t]), t] for t in terms]  # piece, place, term
        found = []

        def advance(entry: list[int], piece: int) -> None:
            start, stop = entry[1], int(self.starts[entry[2] + 1])
            entry[1] = start + int(np.searchsorted(self.pieces[start:stop], piece))
            entry[0] = int(self.pieces[entry[1]]) if entry[1] < stop else end

        while True:
            lists.sort()
            bound, pivot = 0.0, None
            for i, (piece, _, t) in enumerate(lists):
                if piece == end:
                    break
                bound += self.greatest[t]
                if bound >= threshold - SLACK:
                    pivot = i
                    break
            if pivot is None:
                return found
            target = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == target:
                pivot += 1
            block = target // BLOCK
            bound = sum(self.block_greatest(t, block) for _, _, t in lists[: pivot + 1])
            skip_to = min((block + 1) * BLOCK, end)
            if bound < threshold - SLACK:
                # No piece up to the block's end can do; lists behind the pivot may come in before.
                if pivot + 1 < len(lists):
                    skip_to = min(skip_to, lists[pivot + 1][0])
                skip_to = max(skip_to, target + 1)
                for entry in lists[: pivot + 1]:
                    if entry[0] < skip_to:
                        advance(entry, skip_to)
            elif lists[0][0] == target:
                total = 0.0
                for entry in lists[: pivot + 1]:
                    total += self.scores[entry[1]]
                    advance(entry, target + 1)
                if total >= threshold:
                    found.append((target, float(total)))
            else:
                for entry in lists[: pivot + 1]:
                    if entry[0] < target:
                        advance(entry, target)

    def scan(self, hashes: np.ndarray, bounds: np.ndarray, threshold: float, least_question: float, least_answer: float):
        """(text, item_id, score, question overlap, answer overlap) of all verified items in texts given by their words."""
        term = self.lookup(hashes)
        weight = np.where(term >= 0, self.greatest[term] if len(self.greatest) else 0.0, 0.0)
        total = np.concatenate([[0.0], np.cumsum(weight)])
        lengths = np.diff(bounds)
        counts = np.where(lengths > 0, np.maximum(1, -(-(lengths - self.longest) // self.longest)), 0)
        text = np.repeat(np.arange(len(lengths)), counts)
        number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = bounds[:-1][text] + number * self.longest
        last = np.minimum(first + 2 * self.longest, bounds[1:][text])
        likely = np.flatnonzero(total[last] - total[first] >= threshold - SLACK)
        for i, part in self.hopeful(term, first[likely], last[likely], threshold):
            w = likely[i]
            for piece, score in self.search(part.tolist(), threshold):
                item = self.owner[piece]
                low, high = bounds[text[w]], bounds[text[w] + 1]
                near = hashes[max(low, first[w] - self.sizes[item]) : min(high, last[w] + self.sizes[item])]
                shares = []
                for side in (self.question[item], self.answer[item]):
                    size = min(NGRAM, len(side))
                    own = _grams(side, size)
                    shares.append(float(np.isin(own, _grams(near, size)).mean()) if size else 1.0)
                if shares[0] >= least_question and shares[1] >= least_answer:
                    yield int(text[w]), self.item_ids[item], score, *shares


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, term, df) of each part's items, and a row without a term: its pieces, their words, the longest."""
    for batch in batches:
        by_part: dict[int, list[str]] = {}
        for part, text in zip(batch.column("part").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_part.setdefault(part, []).append(text)
        for part, texts in by_part.items():
            found = Statistics.of(texts)
            size = len(found.terms)
            columns = {
                "part": pa.array([part] * (size + 1), pa.int32()),
                "term": pa.array([None, *found.terms.view(np.int64).tolist()], pa.int64()),
                "df": pa.array([None, *found.df.tolist()], pa.int64()),
                "pieces": pa.array([found.pieces] + [None] * size, pa.int64()),
                "words": pa.array([found.words] + [None] * size, pa.int64()),
                "longest": pa.array([found.longest] + [None] * size, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def write_index(benchmark: DataFrame, index_items: int = INDEX_ITEMS) -> list[str]:
    """Paths of the index parts in the shared folder, one for about `index_items` items."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna().distinct()
    items = stored(spark, items, "benchmark-items")
    parts = max(1, -(-items.count() // index_items))
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int"))
    counted = items.mapInArrow(_count, "part int, term long, df long, pieces long, words long, longest long")
    counted = stored(spark, counted, "benchmark-terms")
    pieces, length, longest = counted.agg(F.sum("pieces"), F.sum("words"), F.max("longest")).first()
    if not pieces:
        return []
    terms = counted.filter("term IS NOT NULL")
    everywhere = terms.groupBy("term").agg(F.sum("df").alias("df"))
    of_part = terms.select("part", "term").distinct().join(everywhere, "term")
    folder = work_path(spark, "benchmark-index")
    make_folder(folder)

    def build(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.assign(term=known["term"].to_numpy(np.int64).view(np.uint64)).sort_values("term")
        statistics = Statistics(pieces, length, longest, known["term"].to_numpy(), known["df"].to_numpy())
        rows = rows.sort_values(["item_id", "text"])
        index = Index(list(zip(rows["item_id"].tolist(), rows["text"], strict=True)), statistics)
        path = f"{folder}/{key[0]}-{uuid.uuid4().hex}"  # a repeated task writes another file
        write_file(path, [pickle.dumps(index)])
        return pd.DataFrame({"part": [key[0]], "path": [path]})

    built = items.groupBy("part").cogroup(of_part.groupBy("part")).applyInPandas(build, "part int, path string")
    return [r["path"] for r in built.orderBy("part").collect()]


_LOADED: dict[str, Index] = {}  # the part that this Python worker read last


def _load(path: str) -> Index:
    if path not in _LOADED:
        _LOADED.clear()
        with open_file(path) as source:
            _LOADED[path] = pickle.loads(source.read())
    return _LOADED[path]


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of the batches, as many together as hold `limit` bytes (one at least)."""
    group, size = [], 0
    for batch in batches:
        for part in words.chunks(batch, "text", CHUNK):
            group.append(part)
            size += part.nbytes
            if size >= limit:
                yield group
                group, size = [], 0
    if group:
        yield group


def _scanner(paths: list[str], threshold: float, least_question: float, least_answer: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        for group in _gathered(batches, READ_BYTES if len(paths) > 1 else 1):
            hashed = [words.hashed(part.column("text"), _FOLD) for part in group]
            best: dict[tuple[int, int, int], tuple] = {}
            for path in paths:
                search = _load(path)
                for i, (hashes, bounds) in enumerate(hashed):
                    for text, item_id, *scores in search.scan(hashes, bounds, threshold, least_question, least_answer):
                        best[i, text, item_id] = max(best.get((i, text, item_id), (0.0,)), tuple(scores))
            rows = [(group[i].column("doc_id")[text].as_py(), item_id, *scores) for (i, text, item_id), scores in best.items()]
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return scan


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    least_question: float = LEAST_QUESTION,
    least_answer: float = LEAST_ANSWER,
    index_items: int = INDEX_ITEMS,
) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: a row per document and leaked item."""
    paths = write_index(benchmark, index_items)
    if not paths:
        return docs.sparkSession.createDataFrame([], LEAKS)
    texts = docs.select("doc_id", "text").filter(F.length("text") > 0)
    return texts.mapInArrow(_scanner(paths, threshold, least_question, least_answer), LEAKS)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """docs without those that hold a benchmark item; a null doc_id always stays."""
    leaked = find_leaks(docs, benchmark, **parameters).select("doc_id").filter("doc_id IS NOT NULL").distinct()
    return docs.join(broadcast_if_small(leaked), "doc_id", "left_anti").select(*docs.columns)
