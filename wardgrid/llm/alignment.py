"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which overlap.

A text t is the byte string of " " + t. Tokenizer A (byte-level BPE, tokenizers library) encodes that
string, tokenizer B (sentencepiece) encodes t and adds the space itself; both cut the same bytes into
tokens. Per text, two dictionaries map the cumulative ends of A's and B's tokens to token indices; the
sorted intersection of their keys cuts both id lists into groups. Inside a group no interior end is
common, so its A and B ends in order make one more link than ends: every stretch between them lies in
just one A and one B token, and each overlapping pair has one stretch. Links are expanded per group.

Spark: one pass encodes and stores the ids of both sides; a second one counts in how many texts each
id pair is linked (task-side sums first, then one shuffle by pair); a third looks the counts up. The counts
table is broadcast when it holds at most MAX_BROADCAST_PAIRS rows, else the texts' distinct pairs are
joined with it, partitioned by pair.

Words recur, so tasks keep the ids of words they have met, by 64-bit hashes (a bounded table that starts anew
when full). A text is cut before a space that follows something other than a space and comes before something other
than white space: there A's pattern always starts a new part, and no piece of B goes on behind such a
space (checked when B is loaded; with other vocabularies texts are encoded whole).

Edge cases: texts that are null or empty, or whose joined A or B bytes differ from " " + text, have no
tokens: counts 0, groups_sha256 ''. Very long texts are aligned in windows of WINDOW tokens. Repeated rows are texts
of their own; a null doc_id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm import words
from wardgrid.llm.shared import broadcast_if_small, is_small, stored
from wardgrid.llm.wavelet import PartTable, _grown

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: Half of two to this power parts are kept.
TABLE_BITS = 22
#: Bytes of texts whose words are looked up at a time.
WINDOW_BYTES = 1 << 20
#: Tokens whose ends are held in dictionaries at a time.
WINDOW = 1 << 16
#: Linked id pairs that a task adds up before it hands them on.
HELD_PAIRS = 2_000_000
MAX_BROADCAST_PAIRS = 4_000_000
#: Parts that the texts of a pair in more than HELD_PAIRS texts are dealt out to.
SALTS = 64
SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
#: Ids in a row, and their number for each string.
type _Runs = tuple[np.ndarray, np.ndarray]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for (the public byte-level rule)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Tokenizers:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = _byte_of_character()
        self.bytes_a: dict[int, bytes] = {}
        for piece, i in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in of for c in piece)
            self.bytes_a[i] = bytes(of[c] for c in piece) if known else piece.encode()
        self.bytes_b: dict[int, bytes] = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
        self.spellings = tuple(map(_spellings, (self.bytes_a, self.bytes_b)))
        self.lengths_a, self.lengths_b = (lengths for _, _, lengths in self.spellings)
        #: No piece holds a space behind something else, so words may be encoded one by one.
        self.by_words = not any(" " in p.lstrip(" ") for p in (self.b.id_to_piece(i).replace("▁", " ") for i in self.bytes_b))
        self.table = _Table(TABLE_BITS)

    def encode(self, raws: list[bytes]) -> tuple[_Runs, _Runs, np.ndarray]:
        """(A's ids, B's ids, whether both give the bytes back) of strings that begin with the space."""
        texts = [r.decode() for r in raws]
        a = _flat([x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)])
        b = _flat(self.b.encode([t[1:] for t in texts], num_threads=1))
        return a, b, _gives_back(a, raws, self.spellings[0]) & _gives_back(b, raws, self.spellings[1])


def _spellings(of: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all ids in a row, start of each id's, length of each id's)."""
    ids = range(max(of) + 1)
    lengths = np.array([len(of.get(i, b"")) for i in ids], np.int64)
    data = np.frombuffer(b"".join(of.get(i, b"") for i in ids), np.uint8)
    return data, np.cumsum(lengths) - lengths, lengths


def _flat(runs: list[list[int]]) -> _Runs:
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    return np.fromiter(chain.from_iterable(runs), np.uint32, int(lengths.sum())), lengths


def _gives_back(ids: _Runs, raws: list[bytes], spellings: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether the ids' bytes in a row are the string, for each of the strings."""
    data, starts, lengths = spellings
    flat, counts = ids
    owner = np.repeat(np.arange(len(counts)), counts)
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    good = np.bincount(owner, lengths[flat], len(raws)).astype(np.int64) == sizes
    flat = flat[good[owner]]
    joined = data[words.runs(starts[flat], lengths[flat])]
    given = np.frombuffer(b"".join(r for r, g in zip(raws, good.tolist(), strict=True) if g), np.uint8)
    unlike = np.repeat(np.flatnonzero(good), sizes[good])[joined != given]
    good[unlike] = False
    return good


class _Table(PartTable):
    """From 64-bit hashes of parts to the ids of both tokenizers, and whether they give the part back."""

    def clear(self) -> None:
        super().clear()
        self.starts_b, self.ids_b = np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.good = np.zeros(0, bool)

    def add_both(self, hashes: np.ndarray, ids_a: _Runs, ids_b: _Runs, good: np.ndarray) -> None:
        before, end = len(self), int(self.starts_b[len(self)])
        self.add(hashes, *ids_a)
        flat, lengths = ids_b
        self.starts_b = _grown(self.starts_b, before + 1, end + np.cumsum(lengths))
        self.ids_b = _grown(self.ids_b, end, flat)
        self.good = _grown(self.good, before, good)


@lru_cache(maxsize=2)
def _tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


#: Bytes that may begin a character behind a cut: no white space, and no first byte of wide white space.
_BEGINS = np.ones(256, bool)
_BEGINS[[*range(0x00, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = False


def cuts(raw: np.ndarray) -> np.ndarray:
    """Places of the spaces in raw before which both tokenizers begin anew."""
    space = raw == 0x20
    return np.flatnonzero(space[1:-1] & ~space[:-2] & _BEGINS[raw[2:]]) + 1


def _windows(edges: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Runs of edges that span about `limit` bytes, one part at least."""
    at = 0
    while at < len(edges) - 1:
        end = int(np.searchsorted(edges, edges[at] + limit, "right")) - 1
        end = max(end, at + 1)
        yield edges[at : end + 1]
        at = end


def _hashes(raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """64-bit hashes of the parts of raw between the edges."""
    text = raw[edges[0] : edges[-1]]
    up, down = words._powers(max(WINDOW_BYTES, 1 << (len(text) - 1).bit_length()))
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=total[1:])
    at = edges - edges[0]
    length = np.diff(edges).astype(np.uint64)
    return words.mix((total[at[1:]] - total[at[:-1]]) * down[at[:-1]] + length * np.uint64(0xD6E8FEB86659FD93))


def token_ids(texts: pa.Array, tools: Tokenizers) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, offsets per text) for A and B; no ids for texts that have no tokens by the rule above."""
    data, offsets = words.buffers(texts)
    n = len(offsets) - 1
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    starts = offsets + np.arange(n + 1)
    raw = np.full(int(starts[-1]), 0x20, np.uint8)
    behind = np.ones(len(raw), bool)
    behind[starts[:-1]] = False
    raw[behind] = data
    begins_part = np.zeros(len(raw) + 1, bool)
    begins_part[starts] = True
    if tools.by_words:
        begins_part[cuts(raw)] = True
    edges = np.flatnonzero(begins_part)
    good = np.diff(offsets) > 0
    table = tools.table
    found: list[list[np.ndarray]] = [[], []]
    lengths = np.zeros((2, n), np.int64)
    for window in _windows(edges, WINDOW_BYTES):
        hashes = _hashes(raw, window)
        if len(table) > 1 << (table.bits - 1):
            table.clear()
        entry = table.find(hashes)
        new = np.flatnonzero(entry < 0)
        if len(new):
            fresh, first = np.unique(hashes[new], return_index=True)
            parts = [raw[window[i] : window[i + 1]].tobytes() for i in new[first]]
            table.add_both(fresh, *tools.encode(parts))
            entry[new] = table.find(hashes[new])
        text = np.searchsorted(starts, window[:-1], "right") - 1
        good[text[~table.good[entry]]] = False
        for k, (begins, ids) in enumerate(((table.starts, table.ids), (table.starts_b, table.ids_b))):
            length = begins[entry + 1] - begins[entry]
            found[k].append(ids[words.runs(begins[entry], length)])
            lengths[k] += np.bincount(text, length, n).astype(np.int64)
    out = []
    for k in range(2):
        ids = np.concatenate(found[k]) if found[k] else np.zeros(0, np.uint32)
        kept = lengths[k] * good
        out.append((ids[np.repeat(good, lengths[k])], np.concatenate([[0], np.cumsum(kept)])))
    return out


# ---------------------------------------------------------------------------- groups and links


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of A, tokens of B) up to and including each common end, in order of the ends.

    By dictionaries from ends to indices, over windows of WINDOW tokens of A.
    """
    cuts_a, cuts_b = [], []
    at_b = 0
    for at in range(0, len(ends_a), WINDOW):
        part_a = ends_a[at : at + WINDOW]
        last = int(np.searchsorted(ends_b, part_a[-1], "right"))
        index_a = dict(zip(part_a.tolist(), range(at + 1, at + 1 + len(part_a))))
        index_b = dict(zip(ends_b[at_b:last].tolist(), range(at_b + 1, last + 1)))
        common = sorted(index_a.keys() & index_b.keys())
        cuts_a.extend(map(index_a.__getitem__, common))
        cuts_b.extend(map(index_b.__getitem__, common))
        at_b = last
    return np.array(cuts_a, np.int64), np.array(cuts_b, np.int64)


def links(cuts_a: np.ndarray, cuts_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A index, B index) of every pair of overlapping tokens, group by group.

    A group of i and j tokens has i + j - 1 links: the first tokens of both, and one more for every interior
    end, with the token that begins there.
    """
    last_a, last_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    last_a[cuts_a - 1], last_b[cuts_b - 1] = True, True
    # A group's interior ends and its common end, once.
    ends = np.concatenate([ends_a[~last_a], ends_b])
    order = np.argsort(ends, kind="stable")
    from_a = (np.arange(len(ends)) < len(ends_a) - len(cuts_a))[order]
    closes = np.concatenate([np.zeros(len(ends_a) - len(cuts_a), bool), last_b])[order]
    # The link that ends here: as many tokens of a side have ended before as the side's index says.
    before_a = np.cumsum(from_a | closes) - (from_a | closes)
    before_b = np.cumsum(~from_a) - ~from_a
    return before_a, before_b


@lru_cache(maxsize=2)
def _marked(size_a: int, size_b: int) -> list[str]:
    """Decimal ids of A, then of B, with the mark behind them, for the groups' text: within a group, then at its end."""
    return [f"{i}{mark}" for size, last in ((size_a, "|"), (size_b, ";")) for mark in (",", last) for i in range(size)]


def groups_text(ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, sizes: tuple[int, int]) -> str:
    """`a1,a2|b1;a3|b2,b3`: the ids of each group in order."""
    marked = _marked(*sizes)
    codes_a, codes_b = ids_a.astype(np.int64), ids_b + np.int64(2 * sizes[0])
    codes_a[cuts_a - 1] += sizes[0]
    codes_b[cuts_b - 1] += sizes[1]
    # Group by group: A's tokens, then B's.
    in_a, in_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
    codes = np.empty(len(codes_a) + len(codes_b), np.int64)
    codes[np.arange(len(codes_a)) + np.repeat(cuts_b - in_b, in_a)] = codes_a
    codes[np.arange(len(codes_b)) + np.repeat(cuts_a, in_b)] = codes_b
    return "".join(map(marked.__getitem__, codes.tolist()))[:-1]


# ---------------------------------------------------------------------------- Spark


def _kind(lengths: tuple[np.ndarray, np.ndarray]) -> type:
    """Of stored ids."""
    return np.uint16 if max(map(len, lengths)) <= 1 << 16 else np.uint32


def _binaries(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column of the numbers between the bounds."""
    ends = pa.array(bounds * flat.itemsize, pa.int32()).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, ends, pa.py_buffer(flat.tobytes())])


def _encode(path_a: str, path_b: str):
    """Ids of both sides, and a bit per token: whether it closes a group."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _tokenizers(path_a, path_b)
        lengths = tools.lengths_a, tools.lengths_b
        kind = _kind(lengths)
        for batch in batches:
            for part in words.chunks(batch, "text"):
                sides = [(ids.astype(kind), bounds) for ids, bounds in token_ids(part.column("text"), tools)]
                closing = ([], [])
                for i in range(len(part)):
                    ends = [np.cumsum(of[ids[bounds[i] : bounds[i + 1]]]) for of, (ids, bounds) in zip(lengths, sides, strict=True)]
                    for marks, cut, end in zip(closing, common_ends(*ends), ends, strict=True):
                        last = np.zeros(len(end), bool)
                        last[cut - 1] = True
                        marks.append(np.packbits(last).tobytes())
                columns = [_binaries(*side) for side in sides] + [pa.array(marks, pa.binary()) for marks in closing]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "a", "b", "last_a", "last_b"])

    return encode


class _Aligned:
    """A stored text: ids, common ends and links."""

    def __init__(self, row: dict, lengths: tuple[np.ndarray, np.ndarray]) -> None:
        self.a, self.b = (np.frombuffer(row[x], _kind(lengths)) for x in "ab")
        self.cuts_a, self.cuts_b = (
            np.flatnonzero(np.unpackbits(np.frombuffer(row[f"last_{x}"], np.uint8), count=len(ids))) + 1
            for x, ids in (("a", self.a), ("b", self.b))
        )
        left, right = links(self.cuts_a, self.cuts_b, np.cumsum(lengths[0][self.a]), np.cumsum(lengths[1][self.b]))
        self.pairs = self.a[left].astype(np.int64) << 32 | self.b[right]


def _aligned(batch: pa.RecordBatch, lengths: tuple[np.ndarray, np.ndarray]) -> Iterator[_Aligned]:
    for row in batch.select(["a", "b", "last_a", "last_b"]).to_pylist():
        yield _Aligned(row, lengths)


def _pair_counts(lengths):
    """(pair, texts): in how many of the task's texts each id pair is linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh: list[np.ndarray] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            found, place = np.unique(np.concatenate([pairs, *fresh]), return_inverse=True)
            weight = np.concatenate([counts, np.ones(sum(map(len, fresh)), np.int64)])
            return found, np.bincount(place, weight, len(found)).astype(np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "texts"])

        held = 0
        for batch in batches:
            for part in _slices(batch):
                for text in _aligned(part, lengths.value):
                    fresh.append(np.unique(text.pairs))
                    held += len(fresh[-1])
                    if held > HELD_PAIRS:
                        pairs, counts = merged()
                        fresh, held = [], 0
                        if len(pairs) > HELD_PAIRS:
                            yield rows()
                            pairs, counts = pairs[:0], counts[:0]
        pairs, counts = merged()
        if len(pairs):
            yield rows()

    return count


def _slices(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    yield from words.chunks(batch, "a", limit)


class _Counts:
    """Counts of id pairs, and the highest one of every A id."""

    def __init__(self, packed: tuple[np.ndarray, np.ndarray], size: int) -> None:
        self.pairs, self.texts = packed
        self.highest = np.zeros(size, np.int64)
        np.maximum.at(self.highest, self.pairs >> 32, self.texts)

    def of(self, pairs: np.ndarray) -> np.ndarray:
        return self.texts[np.searchsorted(self.pairs, pairs)]


def _emit(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)


def _digest(text: _Aligned, sizes: tuple[int, int]) -> str:
    if not len(text.a):
        return ""
    return hashlib.sha256(groups_text(text.a, text.b, text.cuts_a, text.cuts_b, sizes).encode()).hexdigest()


def _with_counts(lengths, packed):
    """Result rows, the counts at hand."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = tuple(map(len, lengths.value))
        counts = _Counts(packed.value, sizes[0])
        for batch in batches:
            for part in _slices(batch):
                rows = []
                for text in _aligned(part, lengths.value):
                    found = counts.of(text.pairs)
                    best = found == counts.highest[text.pairs >> 32]
                    rows.append((len(text.a), len(text.b), len(text.cuts_a), len(found), int(best.sum()), int(found.sum()), _digest(text, sizes)))
                yield _emit(part, rows)

    return align


def _without_counts(lengths):
    """(row, result columns but the two from counts, distinct pairs and how often each is linked)."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = tuple(map(len, lengths.value))
        for batch in batches:
            for part in _slices(batch):
                rows, pairs, times = [], [], []
                for text in _aligned(part, lengths.value):
                    found, often = np.unique(text.pairs, return_counts=True)
                    rows.append((len(text.a), len(text.b), len(text.cuts_a), len(text.pairs), 0, 0, _digest(text, sizes)))
                    pairs.append(found.tolist())
                    times.append(often.tolist())
                done = _emit(part, rows).append_column("row", part.column("row"))
                done = done.append_column("pairs", pa.array(pairs, pa.list_(pa.int64())))
                yield done.append_column("times", pa.array(times, pa.list_(pa.int64())))

    return align


def align_documents(
    spark: SparkSession,
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    max_broadcast: int = MAX_BROADCAST_PAIRS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    path_a, path_b = path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B)
    tools = Tokenizers(path_a, path_b)
    lengths = spark.sparkContext.broadcast((tools.lengths_a, tools.lengths_b))
    encoded = docs.select("doc_id", "text").mapInArrow(_encode(path_a, path_b), "doc_id long, a binary, b binary, last_a binary, last_b binary")
    ids = stored(spark, encoded, "alignment-ids")
    counted = ids.filter(F.length("a") > 0).mapInArrow(_pair_counts(lengths), "pair long, texts long")
    counts = stored(spark, counted.groupBy("pair").agg(F.sum("texts").alias("texts")), "alignment-counts")
    if is_small(counts, max_broadcast):
        table = counts.toArrow().sort_by("pair")
        packed = spark.sparkContext.broadcast((table.column("pair").to_numpy(), table.column("texts").to_numpy()))
        return ids.mapInArrow(_with_counts(lengths, packed), SCHEMA)
    return _joined(spark, ids, counts, lengths)


def _joined(spark: SparkSession, ids: DataFrame, counts: DataFrame, lengths) -> DataFrame:
    """The same by a join of the texts' distinct pairs with the counts, for a counts table of any size."""
    named = stored(spark, ids.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    schema = f"{SCHEMA}, row long, pairs array<long>, times array<long>"
    aligned = stored(spark, named.mapInArrow(_without_counts(lengths), schema), "alignment-pairs")
    left = F.shiftright("pair", 32)
    highest = counts.groupBy(left.alias("left")).agg(F.max("texts").alias("highest"))
    rated = counts.join(highest, left == F.col("left")).select("pair", "texts", (F.col("texts") == F.col("highest")).alias("best"))
    pairs = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    # A pair that very many texts hold would fill one task: those are dealt out by row as well.
    common = F.col("texts") > HELD_PAIRS
    frequent = broadcast_if_small(counts.filter(common).select("pair", F.lit(SALTS).alias("salts")))
    salt = F.pmod(F.xxhash64("row"), F.coalesce("salts", F.lit(1))).cast("int")
    dealt = pairs.join(frequent, "pair", "left").select("row", "pair", "times", salt.alias("salt"))
    copies = rated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(common, SALTS - 1).otherwise(0))))
    met = dealt.join(copies, ["pair", "salt"])
    summed = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("texts")).alias("count_sum")
    )
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    out = aligned.drop("n_best", "count_sum", "pairs", "times").join(summed, "row", "left").na.fill(0, ["n_best", "count_sum"])
    return out.select(*names)
