"""Encoding of new parts for token files: many parts a string, the same ids as each part alone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from wardgrid.llm import wavelet

TEXTS = [
    "One, two. THREE don't 4x4 ...", None, "", "\0", "a \0 b", "\0\0 c", "é é ́x ß日本   y", "x" * 9000,
    "a <|endoftext|> b", "tab\tline\nend\r\n", " ".join(f"w{i}ord" for i in range(3000)),
]


class Counting:
    """A tokenizer that counts the strings it is given."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.strings = tokenizer, 0

    def encode_batch_fast(self, strings, **options):
        self.strings += len(strings)
        return self.tokenizer.encode_batch_fast(strings, **options)


@pytest.fixture
def path():
    wavelet._tokenizer.cache_clear()
    yield wavelet.tokenizer_path()
    wavelet._tokenizer.cache_clear()


def test_ids_are_those_of_whole_texts(path):
    tokenizer = wavelet._tokenizer(path)[0]
    for _ in range(2):  # with new parts, then with known ones
        flat, bounds = wavelet.encode(pa.array(TEXTS), path)
        for i, text in enumerate(TEXTS):
            want = tokenizer.encode(text or "", add_special_tokens=False).ids
            assert flat[bounds[i] : bounds[i + 1]].tolist() == want


def test_new_parts_share_strings(path):
    tokenizer, _, mark = wavelet._tokenizer(path)
    counting = Counting(tokenizer)
    parts = [f"w{i}" for i in range(2 * wavelet.JOINED + 1)]
    flat, lengths = wavelet.encode_parts(counting, parts, mark)
    assert counting.strings == 3
    assert lengths.tolist() == [len(tokenizer.encode(p, add_special_tokens=False).ids) for p in parts]
    assert flat.tolist() == [x for p in parts for x in tokenizer.encode(p, add_special_tokens=False).ids]


@pytest.mark.parametrize("parts", [["a", "\0", "b"], ["\0"], ["x\0", "\0\0"], [], [""], ["", "a", ""]])
def test_parts_with_the_mark_itself(path, parts):
    tokenizer, _, mark = wavelet._tokenizer(path)
    for given in (mark, None):
        flat, lengths = wavelet.encode_parts(tokenizer, parts, given)
        want = [tokenizer.encode(p, add_special_tokens=False).ids for p in parts]
        assert lengths.tolist() == [len(x) for x in want] and flat.tolist() == sum(want, [])


def test_table_grows_and_starts_anew(path):
    table = wavelet.PartTable(bits=6)
    for k in range(3):
        hashes = (np.arange(10, dtype=np.uint64) + np.uint64(10 * k + 1)) << np.uint64(50)
        table.add(hashes, np.arange(20, dtype=np.uint32) + 20 * k, np.full(10, 2))
        assert table.find(hashes).tolist() == list(range(10 * k, 10 * k + 10))
    assert len(table) == 30 and table.ids[: table.starts[30]].tolist() == list(range(60))
    table.clear()
    assert len(table) == 0 and (table.find(hashes) < 0).all()
