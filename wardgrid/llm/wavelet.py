"""Token files: a wavelet matrix per shard, written by Spark tasks and read back.

Texts are encoded with a public tokenizer, an end id closes each document, and documents lie in
ascending doc_id order over the shards (range partitions). A shard's file holds one bit plane per
bit of a token id, top bit first; below each plane the sequence is reordered, zeros before ones.
That gives access, counting and occurrence lookup in a fixed number of steps per query:

    access(i)               token at i
    rank(token, i)          how often the token occurs before i
    count(token, lo, hi)    how often within [lo, hi)
    select(token, k)        where it occurs for the k-th time

Planes are cut into blocks of 64 KiB, each compressed by itself. The footer tells each block's place
and how many ones come before it, so a query reads and unpacks one block a plane.

Encoding a word at a time: the tokenizer drops white space and splits words there before it merges,
so a text's ids are those of its parts between white space. Each worker keeps the ids of the parts
it has met in a hash table (bounded; it starts anew when full) and hands only new ones to the
tokenizers library, many in one string, with a mark between them whose one id tells them apart (where
a part gives that id itself, each part is a string of its own). Texts with the opening mark of a special token go to the library whole. The
table serves tokenizers that ignore white space and letter case, as the default one does.

Edge cases: a null text is empty and has just the end id; null doc_ids come first, repeated ids side
by side; an empty table gives no file and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardgrid.llm import words
from wardgrid.llm.shared import file_system, make_folder, open_file, stored, work_path

END_ID = 1
TOKENIZER = "word_bpe_49k.json"
SHARD_BYTES = 16 << 20
TABLE_BITS = 21
#: Pieces of text whose new parts are looked up and encoded together; they hold fewer parts than the table has free.
PIECES = 4
#: Parts in one string for the tokenizer, strings handed over at a time, and what stands between parts.
JOINED = 500
STRINGS = 16
MARK = "\0"
MAGIC = b"WGWM"
BLOCK = 64 << 10  # bytes of a plane
LEVEL = 1
MANIFEST = "shard int, path string, n_docs long, n_tokens long"


# ---------------------------------------------------------------------------- tokens of texts


class PartTable:
    """Hash table from 64-bit part hashes to runs of token ids; lookups are whole-array steps."""

    def __init__(self, bits: int = TABLE_BITS) -> None:
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.number = 0
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def __len__(self) -> int:
        return self.number

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 if it is new."""
        mask = np.int64((1 << self.bits) - 1)
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        entry = self.slots[at]
        open_ = np.flatnonzero((entry >= 0) & (self.keys[at] != hashes))
        while len(open_):
            at[open_] = (at[open_] + 1) & mask
            entry[open_] = self.slots[at[open_]]
            wrong = (entry[open_] >= 0) & (self.keys[at[open_]] != hashes[open_])
            open_ = open_[wrong]
        return entry

    def add(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Adds distinct, new hashes; `ids` holds their ids in a row."""
        mask = np.int64((1 << self.bits) - 1)
        entry = np.arange(len(self), len(self) + len(hashes), dtype=np.int32)
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            vacant = left[self.slots[at[left]] < 0]
            _, first = np.unique(at[vacant], return_index=True)
            placed = vacant[first]
            self.slots[at[placed]] = entry[placed]
            self.keys[at[placed]] = hashes[placed]
            left = left[~np.isin(left, placed, assume_unique=True)]
            taken = left[self.slots[at[left]] >= 0]
            at[taken] = (at[taken] + 1) & mask
        end = int(self.starts[self.number])
        self.starts = _grown(self.starts, self.number + 1, end + np.cumsum(lengths))
        self.ids = _grown(self.ids, end, ids)
        self.number += len(hashes)


def _grown(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """The array with `more` after its first `used` values; it doubles where there is no room."""
    if used + len(more) > len(array):
        array = np.concatenate([array[:used], np.zeros(max(used, 2 * len(more)), array.dtype)])
    array[used : used + len(more)] = more
    return array


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    mark = tokenizer.encode(MARK, add_special_tokens=False).ids
    return tokenizer, PartTable(), mark[0] if len(mark) == 1 else None


def encode_parts(tokenizer, parts: list[str], mark: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all parts in a row, their number for each part); no part holds white space."""
    if mark is not None:
        text = [f" {MARK} ".join([*parts[i : i + JOINED], ""]) for i in range(0, len(parts), JOINED)]
        ids = [np.zeros(0, np.uint32)]
        for some in batched(text, STRINGS):
            ids += [np.array(x.ids, np.uint32) for x in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        flat = np.concatenate(ids)
        between = np.flatnonzero(flat == mark)
        if len(between) == len(parts):  # else a part gives this id too
            return flat[flat != mark], np.diff(between, prepend=-1) - 1
    ids = [x.ids for x in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((x for run in ids for x in run), np.uint32, int(lengths.sum())), lengths


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets): exactly what the tokenizer gives for each whole text."""
    tokenizer, table, mark = _tokenizer(path)
    data, offsets = words.buffers(texts)
    raw = data[offsets[0] : offsets[-1]].tobytes() if len(data) else b""
    n = len(offsets) - 1
    special = np.zeros(n, bool)
    at = raw.find(b"<|")
    while at >= 0:  # a text with the opening of a special token
        text = int(np.searchsorted(offsets, offsets[0] + at, "right")) - 1
        special[text] = True
        at = raw.find(b"<|", int(offsets[text + 1] - offsets[0]))
    ids, owners = [], []
    for pieces in batched(words.spans(data, offsets, split_marks=True), PIECES):
        starts, stops, hashes = (np.concatenate([piece[k] for piece in pieces]) for k in (1, 2, 3))
        if len(table) > 1 << (table.bits - 1):
            table.clear()
        entry = table.find(hashes)
        new = np.flatnonzero(entry < 0)
        if len(new):
            found, first = np.unique(hashes[new], return_index=True)
            first = new[first]
            # A line for each part, as no part holds a line break.
            size = stops[first] - starts[first] + 1
            lines = words.FOLD[data[np.minimum(words.runs(starts[first], size), len(data) - 1)]]
            lines[np.cumsum(size) - 1] = ord("\n")
            parts = lines.tobytes().decode("utf-8", "replace").split("\n")[:-1]
            table.add(found, *encode_parts(tokenizer, parts, mark))
            entry[new] = table.find(hashes[new])
        begin = table.starts[entry]
        length = table.starts[entry + 1] - begin
        text = np.searchsorted(offsets, starts, "right") - 1
        ids.append(table.ids[words.runs(begin, length)])
        owners.append(np.bincount(text, length, minlength=n).astype(np.int64) if len(text) else np.zeros(n, np.int64))
    lengths = np.sum(owners, axis=0, dtype=np.int64) if owners else np.zeros(n, np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    if special.any():
        pieces = [flat[bounds[i] : bounds[i + 1]] for i in range(n)]
        for i in np.flatnonzero(special):
            text = bytes(data[offsets[i] : offsets[i + 1]]).decode("utf-8", "replace")
            pieces[i] = np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        lengths = np.array([len(x) for x in pieces], np.int64)
        flat, bounds = np.concatenate(pieces), np.concatenate([[0], np.cumsum(lengths)])
    return flat, bounds


def close_documents(flat: np.ndarray, bounds: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with end_id after each document, and the new offsets."""
    closed = bounds + np.arange(len(bounds))
    out = np.full(int(closed[-1]), end_id, np.uint32)
    mask = np.ones(len(out), bool)
    mask[closed[1:] - 1] = False
    out[mask] = flat
    return out, closed


# ---------------------------------------------------------------------------- wavelet matrix

_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def write_matrix(uri: str, tokens: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> None:
    """Writes a shard's file: planes, documents, footer."""
    bits = max(1, int(tokens.max()).bit_length()) if len(tokens) else 1
    kind = np.uint16 if bits <= 16 else np.uint32
    sequence = tokens.astype(kind)
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    store, path = file_system(uri)
    planes, at = [], len(MAGIC)
    with store.open_output_stream(path, compression=None) as out:

        def put(raw: bytes) -> list[int]:
            nonlocal at
            packed = compress(raw)
            out.write(packed)
            at += len(packed)
            return [at - len(packed), len(packed), len(raw)]

        out.write(MAGIC)
        for bit in range(bits - 1, -1, -1):
            ones = (sequence >> kind(bit)) & kind(1) != 0
            plane = np.packbits(ones, bitorder="little")
            blocks, before = [], 0
            for i in range(0, len(plane), BLOCK):
                part = plane[i : i + BLOCK]
                blocks.append([*put(part.tobytes()), before])
                before += int(_ONES[part].sum())
            planes.append({"zeros": len(tokens) - before, "blocks": blocks})
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        ids = np.array([0 if x is None else x for x in doc_ids], np.int64)
        missing = np.array([x is None for x in doc_ids], bool)
        documents = put(ids.tobytes() + np.asarray(lengths, np.int64).tobytes() + np.packbits(missing).tobytes())
        footer = compress(json.dumps({"n": len(tokens), "docs": len(ids), "planes": planes, "documents": documents}).encode())
        out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)


class WaveletMatrix:
    """A shard's file, read block by block."""

    def __init__(self, source) -> None:
        self.source = source
        source.seek(source.size() - 12)
        length, magic = struct.unpack("<Q4s", source.read(12))
        if magic != MAGIC:
            raise ValueError("not a token file")
        source.seek(source.size() - 12 - length)
        footer = json.loads(zstandard.ZstdDecompressor().decompress(source.read(length)))
        self.n, self.docs, self.planes, self._documents = (footer[k] for k in ("n", "docs", "planes", "documents"))
        self.block = lru_cache(maxsize=2 * len(self.planes))(self._block)

    def _read(self, place: list[int]) -> bytes:
        self.source.seek(place[0])
        return zstandard.ZstdDecompressor().decompress(self.source.read(place[1]))

    def _block(self, plane: int, number: int) -> np.ndarray:
        return np.frombuffer(self._read(self.planes[plane]["blocks"][number]), np.uint8)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """(doc_ids, token counts), in file order."""
        raw = self._read(self._documents)
        ids = np.frombuffer(raw, np.int64, self.docs)
        lengths = np.frombuffer(raw, np.int64, self.docs, 8 * self.docs)
        missing = np.unpackbits(np.frombuffer(raw, np.uint8, offset=16 * self.docs), count=self.docs)
        return [None if m else int(i) for i, m in zip(ids, missing, strict=True)], lengths

    def _ones(self, plane: int, i: int) -> int:
        """Ones of a plane before i."""
        number, within = divmod(i, 8 * BLOCK)
        blocks = self.planes[plane]["blocks"]
        if number == len(blocks):
            return self.n - self.planes[plane]["zeros"]
        block = self.block(plane, number)
        whole, rest = divmod(within, 8)
        count = blocks[number][3] + int(_ONES[block[:whole]].sum())
        return count + (int(_ONES[block[whole] & ((1 << rest) - 1)]) if rest else 0)

    def _bit(self, plane: int, i: int) -> int:
        number, within = divmod(i, 8 * BLOCK)
        return int(self.block(plane, number)[within >> 3] >> (within & 7)) & 1

    def _step(self, plane: int, bit: int, i: int) -> int:
        ones = self._ones(plane, i)
        return self.planes[plane]["zeros"] + ones if bit else i - ones

    def _code(self, token: int) -> list[int] | None:
        bits = len(self.planes)
        return [(token >> (bits - 1 - k)) & 1 for k in range(bits)] if 0 <= token < 1 << bits else None

    def access(self, i: int) -> int:
        token = 0
        for plane in range(len(self.planes)):
            bit = self._bit(plane, i)
            token = token << 1 | bit
            i = self._step(plane, bit, i)
        return token

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        hi, code = self.n if hi is None else hi, self._code(token)
        if code is None or hi <= lo:
            return 0
        for plane, bit in enumerate(code):
            lo, hi = self._step(plane, bit, lo), self._step(plane, bit, hi)
        return hi - lo

    def rank(self, token: int, i: int) -> int:
        return self.count(token, 0, i)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0); IndexError if there are fewer."""
        code = self._code(token)
        if code is None or not 0 <= k < self.count(token):
            raise IndexError(k)
        start = 0
        for plane, bit in enumerate(code):
            start = self._step(plane, bit, start)
        at = start + k
        for plane in range(len(code) - 1, -1, -1):
            at = self._select_bit(plane, code[plane], at - (self.planes[plane]["zeros"] if code[plane] else 0))
        return at

    def _select_bit(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th bit of this value in a plane: search over blocks, then within one."""
        blocks = self.planes[plane]["blocks"]

        def before(number: int) -> int:
            return blocks[number][3] if bit else number * 8 * BLOCK - blocks[number][3]

        low, high = 0, len(blocks) - 1
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if before(middle) <= k else (low, middle - 1)
        within = np.unpackbits(self.block(plane, low), bitorder="little")[: self.n - low * 8 * BLOCK]
        return low * 8 * BLOCK + int(np.flatnonzero(within == bit)[k - before(low)])

    def decode(self) -> np.ndarray:
        """All tokens: each plane puts the two halves below it back into order."""
        sequence = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for depth in range(len(self.planes)):
            plane = self.planes[-1 - depth]
            packed = b"".join(self._read(block) for block in plane["blocks"])
            ones = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n, bitorder="little").view(bool)
            upper = np.empty_like(sequence)
            upper[~ones] = sequence[: plane["zeros"]]
            upper[ones] = sequence[plane["zeros"] :] | sequence.dtype.type(1 << depth)
            sequence = upper
        return sequence


# ---------------------------------------------------------------------------- Spark


def _batch(schema: list[tuple[str, pa.DataType]], columns: list) -> pa.RecordBatch:
    arrays = [pa.array(v, k) for (_, k), v in zip(schema, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in schema])


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, lengths, doc_ids = [], [], []
        for batch in batches:
            for part in words.chunks(batch, "text"):
                ids, bounds = close_documents(*encode(part.column("text"), tokenizer), end_id)
                tokens.append(ids.astype(np.uint16) if len(ids) and ids.max() < 1 << 16 else ids)
                lengths.append(np.diff(bounds))
                doc_ids += part.column("doc_id").to_pylist()
        schema = [("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
        if doc_ids:
            path = f"{folder}/{uuid.uuid4().hex}.wm"
            flat = np.concatenate(tokens)
            write_matrix(path, flat, doc_ids, np.concatenate(lengths))
            yield _batch(schema, [[TaskContext.get().partitionId()], [path], [len(doc_ids)], [len(flat)]])

    return write


def write_tokens(
    spark: SparkSession,
    docs: DataFrame,
    folder: str | None = None,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Writes docs (doc_id, text) as token files; returns the manifest, one row per file.

    The manifest's `start` counts the ids in all files before. Files have about shard_bytes of text.
    """
    folder = folder or work_path(spark, "tokens")
    make_folder(folder)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    written = (
        docs.select("doc_id", "text")
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_writer(folder, tokenizer or tokenizer_path(), end_id), MANIFEST)
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = stored(spark, written, "tokens-manifest")
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            with open_file(path) as source:
                matrix = WaveletMatrix(source)
                doc_ids, lengths = matrix.documents()
                tokens = matrix.decode().astype("<u4")
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            view = memoryview(tokens).cast("B")
            crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield _batch(schema, [doc_ids, start + bounds[:-1], lengths, crcs])


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    files = manifest.select("path", "start")
    # One file a task; a plain count keeps Spark from merging tasks whose rows look small.
    files = files.repartition(max(1, files.count()))
    return files.mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize_documents(spark: SparkSession, docs: DataFrame, **parameters) -> DataFrame:
    """Writes the token files and reads every document back from them."""
    return read_tokens(write_tokens(spark, docs, **parameters))
