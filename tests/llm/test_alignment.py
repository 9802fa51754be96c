"""Alignment of two tokenizers against a plain version that looks at every pair of tokens."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardgrid.llm import alignment, shared

TEXTS = [
    "The quick brown fox, unbelievably, jumps!",
    "The quick  brown\n\nfox 12345 don't",
    "Überraschung naïveté    x 　y",
    "日本語のテキスト and English",
    " leading space",
    "  two leading, trailing  ",
    "tab\there \x1c odd\r\nline sep \u0085 next",
    "<|endoftext|> is plain <s> </s> <unk> <0x41>",
    "a ▁ b",
    "\U0001f600 emoji\U0001f469‍\U0001f680",
    "x",
    " ",
    "",
    None,
    "The quick brown fox, unbelievably, jumps!",
    "ﬁ ① ½ é é",
    "nul \x00 byte",
    "word " * 3000,
]


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    shared.prepare(spark)


@pytest.fixture(scope="module")
def tools():
    return alignment.Tokenizers(alignment.tokenizer_path(alignment.TOKENIZER_A), alignment.tokenizer_path(alignment.TOKENIZER_B))


def plain(texts, tools):
    """Result rows without the id, from whole texts and all pairs of tokens."""
    parts = []
    for text in texts:
        ids_a = tools.a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = tools.b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        same = all(b"".join(of[i] for i in ids) == raw for ids, of in ((ids_a, tools.bytes_a), (ids_b, tools.bytes_b)))
        if not text or not same:
            parts.append(([], [], [], []))
            continue

        def spans(ids, of):
            out, at = [], 0
            for i in ids:
                out.append((i, at, at + len(of[i])))
                at += len(of[i])
            return out

        a, b = spans(ids_a, tools.bytes_a), spans(ids_b, tools.bytes_b)
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for end in common:
            groups.append(tuple([i for i, s, e in side if low <= s and e <= end] for side in (a, b)))
            low = end
        linked = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        parts.append((a, b, groups, linked))
    counts = {}
    for *_, linked in parts:
        for pair in set(linked):
            counts[pair] = counts.get(pair, 0) + 1
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(n, best.get(i, 0))
    rows = []
    for a, b, groups, linked in parts:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        found = [counts[p] for p in linked]
        rows.append(
            (len(a), len(b), len(groups), len(linked), sum(counts[p] == best[p[0]] for p in linked), sum(found))
            + (hashlib.sha256(text.encode()).hexdigest() if a else "",)
        )
    return rows


def documents(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x")).withColumn("pair", F.lit(1)).repartition(3)


def test_rows_match_all_pairs(spark, tools):
    short = [t if t is None or len(t) < 9000 else t[:400] for t in TEXTS]
    want = [(i, *r) for i, r in enumerate(plain(short, tools))]
    assert sorted(map(tuple, alignment.align_documents(spark, documents(spark, short)).collect())) == want
    # A counts table that is too large to broadcast, with every pair dealt out.
    got = alignment.align_documents(spark, documents(spark, short), max_broadcast=0)
    assert sorted(map(tuple, got.collect())) == want
    assert [r[1:3] for r in want][11:14] != [] and want[13][-1] == "" and want[8][1:] == (0, 0, 0, 0, 0, 0, "")


def test_frequent_pairs_are_dealt_out(spark, tools, monkeypatch):
    texts = [f"same words here {i}" for i in range(40)]
    monkeypatch.setattr(alignment, "HELD_PAIRS", 3)
    got = alignment.align_documents(spark, documents(spark, texts), max_broadcast=0)
    assert sorted(map(tuple, got.collect())) == [(i, *r) for i, r in enumerate(plain(texts, tools))]


def test_words_give_the_ids_of_whole_texts(tools, monkeypatch):
    assert tools.by_words
    monkeypatch.setattr(alignment, "WINDOW_BYTES", 64)
    got = alignment.token_ids(pa.array(["skipped", *TEXTS])[1:], tools)
    for k, text in enumerate(TEXTS):
        a, b = (ids[bounds[k] : bounds[k + 1]].tolist() for ids, bounds in got)
        if not text:
            assert a == b == []
            continue
        whole_a, whole_b = tools.a.encode(" " + text, add_special_tokens=False).ids, tools.b.encode(text)
        if b"".join(tools.bytes_b[i] for i in whole_b) == (" " + text).encode():
            assert a == whole_a and b == whole_b, text
        else:
            assert a == b == []
    raw = np.frombuffer(b" a b  c\n d \xc2\xa0e f", np.uint8)
    assert alignment.cuts(raw).tolist() == [2, 8, 14]


def test_table_keeps_the_ids_of_both_tokenizers(tools):
    table = alignment._Table(6)
    parts = [[b" one", b" unbelievably"], [b" a", " naïveté".encode(), b" two  "], [b" x"]]
    for _ in range(2):  # new, then started anew
        for k, some in enumerate(parts):
            hashes = (np.arange(len(some), dtype=np.uint64) + np.uint64(10 * k + 1)) << np.uint64(50)
            table.add_both(hashes, *tools.encode(some))
            for i, part in zip(table.find(hashes).tolist(), some, strict=True):
                want = tools.a.encode(part.decode(), add_special_tokens=False).ids, tools.b.encode(part.decode()[1:])
                for ids, starts, wanted in ((table.ids, table.starts, want[0]), (table.ids_b, table.starts_b, want[1])):
                    assert ids[starts[i] : starts[i + 1]].tolist() == wanted
                assert table.good[i] == (b"".join(tools.bytes_b[x] for x in want[1]) == part)
        assert len(table) == 6
        table.clear()


def test_windows_change_nothing(tools, monkeypatch):
    (a, _), (b, _) = alignment.token_ids(pa.array([TEXTS[-1] + TEXTS[0] * 20]), tools)
    ends = [np.cumsum(of[ids]) for of, ids in ((tools.lengths_a, a), (tools.lengths_b, b))]
    whole = alignment.common_ends(*ends)
    monkeypatch.setattr(alignment, "WINDOW", 7)
    assert all(np.array_equal(x, y) for x, y in zip(whole, alignment.common_ends(*ends), strict=True))


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], "doc_id long, text string")
    assert alignment.align_documents(spark, docs.limit(0)).collect() == []
    rows = alignment.align_documents(spark, docs).collect()
    assert [r["count_sum"] for r in rows] == [6, 6, 6] and {r["doc_id"] for r in rows} == {1, None}
