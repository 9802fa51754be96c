"""Words of Arrow text columns as 64-bit hashes, computed on whole byte buffers.

A word is a longest run of bytes other than 0x20 and 0x09 to 0x0D. Work goes in pieces of
about 256 KiB, cut between words, so memory does not grow with the length of a text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
KEEP = np.arange(256, dtype=np.uint8)


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data, offsets


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: np.uint64) -> np.ndarray:
        out = np.full(length, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_BASE), run(_BASE_INVERSE)


def _pieces(data: np.ndarray, first: int, last: int):
    """Cuts [first, last) into ranges that begin and end between words."""
    at = first
    while at < last:
        cut = min(at + PIECE, last)
        while cut < last:
            gap = np.flatnonzero(SPACE[data[cut : cut + 4096]])
            if len(gap):
                cut += int(gap[0])
                break
            cut = min(cut + 4096, last)
        yield at, cut
        at = cut


def spans(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = FOLD, split_marks: bool = False, heads: Sequence[int] = ()):
    """Yields (piece start, starts, ends, hashes) of the words, in order; positions are absolute.

    With `heads`, hashes has a row for the words and one for each length in bytes: the hash of a
    word's first bytes if it has more, else 0.

    `fold` maps bytes before hashing. With split_marks a comma or full stop that ends a word
    right after a letter a-z is a word of its own.
    """
    for at, cut in _pieces(data, int(offsets[0]), int(offsets[-1])):
        text = fold[data[at:cut]]
        inside = ~SPACE[text]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, cut, "left")] - at
        begins[edges] |= inside[edges]
        ends[edges - 1] |= inside[edges - 1]
        if split_marks:
            tail = np.flatnonzero(ends)
            tail = tail[(text[tail] == 0x2C) | (text[tail] == 0x2E)]
            tail = tail[~begins[tail]]
            tail = tail[(text[tail - 1] >= 0x61) & (text[tail - 1] <= 0x7A)]
            begins[tail] = True
            ends[tail - 1] = True
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        size = max(PIECE + 4096, 1 << (len(text) - 1).bit_length())
        up, down = _powers(size)
        total = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=total[1:])
        length = (stops - starts).astype(np.uint64)
        hashes = mix((total[stops] - total[starts]) * down[starts] + length * np.uint64(0xD6E8FEB86659FD93))
        if heads:
            rows = [hashes]
            for k in heads:
                longer = length > k
                stop = np.where(longer, starts + k, starts)
                row = mix((total[stop] - total[starts]) * down[starts] + np.uint64(k * 0x1000193))
                rows.append(np.where(longer, row, np.uint64(0)))
            hashes = np.stack(rows)
        yield at, starts + at, stops + at, hashes


def hashed(texts: pa.Array | pa.ChunkedArray, fold: np.ndarray = FOLD) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets of each text's words) of a column."""
    data, offsets = buffers(texts)
    starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for _, start, _, found in spans(data, offsets, fold):
        starts.append(start)
        hashes.append(found)
    bounds = np.searchsorted(np.concatenate(starts), offsets, "left")
    return np.concatenate(hashes), bounds


def hash_word(word: str | bytes) -> int:
    """The hash that `hashed` gives this word."""
    raw = word.encode() if isinstance(word, str) else word
    return int(hashed(pa.array([raw], pa.binary()))[0][0])


def chunks(batch: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """Slices of a batch holding about `limit` text bytes each (one row at least)."""
    _, offsets = buffers(batch.column(column))
    at = 0
    while at < len(batch):
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), len(batch))
        yield batch.slice(at, end - at)
        at = end


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lengths[i] of all i, in a row."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
