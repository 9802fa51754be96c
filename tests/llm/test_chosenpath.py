"""The chosen-path join against all pairs by brute force, with the limits low enough that nodes branch."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardgrid.llm import chosenpath, shared
from wardgrid.llm.jaccard import shingle_sets

DOCUMENTS = "doc_id long, text string"


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    shared.prepare(spark)


def plain_sets(text, size=3):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_force(rows, size=3, percent=85):
    """(doc_id, n_shingles, component_id, kept) of every row with an id."""
    rows = [(i, plain_sets(t, size)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, left) in enumerate(rows):
        for j in range(i):
            b, right = rows[j]
            shared_ = len(left & right)
            linked = left and right and 100 * shared_ >= percent * (len(left) + len(right) - shared_)
            if linked or (a == b and left and right):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((doc, len(s), least[root(i)], doc == least[root(i)]) for i, (doc, s) in enumerate(rows))


def found(spark, rows, **parameters):
    docs = spark.createDataFrame(rows, DOCUMENTS).withColumn("n", F.lit(1)).withColumn("set", F.lit("x"))
    return sorted(map(tuple, chosenpath.group_documents(spark, docs, **parameters).collect()))


def planted(seed=5):
    """Chains of near copies, copies, a passage that many share, sets just under the threshold, short texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(400)}"
    texts = []
    for _ in range(6):
        text = [word() for _ in range(60)]
        for _ in range(8):  # each like the one before it, the ends unlike
            texts.append(" ".join(text))
            text = list(text)
            text[draw.randrange(60)] = word()
    base = [word() for _ in range(90)]
    for _ in range(40):  # pairs around the threshold
        text = list(base)
        for _ in range(draw.randrange(1, 5)):
            text[draw.randrange(90)] = word()
        texts.append(" ".join(text))
    passage = " ".join(word() for _ in range(50))
    texts += [f"{passage} {' '.join(word() for _ in range(draw.randrange(1, 20)))}" for _ in range(50)]
    texts += [texts[3]] * 20 + ["", None, "  \t", "one", "ONE", "one two", "a b c", "A b c", "b c d e", "a b c d"]
    draw.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


def test_equals_brute_force_when_all_nodes_are_small(spark):
    rows = planted()
    assert found(spark, rows) == brute_force(rows)


def test_equals_brute_force_when_nodes_branch_and_blocks_are_tiny(spark):
    rows = planted(7)
    assert found(spark, rows, small=2, block=8, levels=2) == brute_force(rows)


def test_group_that_never_falls_apart(spark):
    # Every text has its own words in one place of five: all pairs are alike, none is linked.
    rows = [(i, " ".join(f"s{k}" if k % 5 else f"o{i}x{k}" for k in range(40))) for i in range(30)]
    rows = [(i, t.replace("s4 ", "s4 ") + " " + " ".join(f"c{k}" for k in range(160))) for i, t in rows]
    assert found(spark, rows, small=1, block=4, levels=1) == brute_force(rows)


def test_a_block_gives_no_more_pairs_than_classes():
    # 200 classes of which any two are likely, none similar: 19,900 pairs, each class a component.
    rng = np.random.default_rng(1)
    common = np.arange(760, dtype=np.uint64)
    sets = [np.sort(np.concatenate([common, rng.integers(1 << 40, 1 << 60, 240).astype(np.uint64)])) for _ in range(200)]
    sets += [np.sort(np.concatenate([sets[0][:-10], rng.integers(1 << 40, 1 << 60, 10).astype(np.uint64)]))]
    tokens = chosenpath.minwise([s for s in sets])
    names = [b"%03d" % i for i in range(len(sets))]

    def run(whole):
        rows = [(1, names[i], names[i], few, len(s), tokens[i].tobytes(), s.tobytes()) for few in (True, False) for i, s in enumerate(sets)]
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["group", "set", "part", "few", "n", "tokens", "hashes"]
        )
        compare = chosenpath._compare(60 if not whole else 85, whole)
        return [tuple(p.values()) for out in compare(iter([batch])) for p in out.to_pylist()]

    likely = run(False)
    assert 0 < len(likely) < len(sets)
    assert {name for pair in likely for name in pair} == set(names)
    assert [set(pair) for pair in run(True)] == [{names[0], names[-1]}]


def test_sets_that_may_be_similar_are_compared_whole(monkeypatch):
    draw = np.random.default_rng(2)
    base = np.unique(draw.integers(0, 1 << 63, 300).astype(np.uint64))
    sets = [base[draw.random(len(base)) < draw.uniform(0.6, 1)] for _ in range(60)]
    found = chosenpath._Sets(pa.array([b"12345678", *(s.tobytes() for s in sets)], pa.binary())[1:])
    assert [found.similar(0, j, 70) for j in range(60)] == [_alike_sets(sets[0], s, 70) for s in sets]
    for lookups in (1 << 20, 500):
        monkeypatch.setattr(chosenpath, "LOOKUPS", lookups)
        for i in range(20):
            alike = np.array([_alike_sets(sets[i], s, 70) for s in sets])
            assert 0 < alike.sum() < 60 and not (alike & ~found.possible(i, np.arange(60), 70)).any()
    agree = draw.random((9, chosenpath.POSITIONS)) < 0.7
    assert chosenpath._true(agree).tolist() == agree.sum(axis=1).tolist()
    assert chosenpath._true(np.ones((1, chosenpath.POSITIONS), bool)).tolist() == [chosenpath.POSITIONS]


def _alike_sets(a, b, percent):
    shared_ = len(np.intersect1d(a, b))
    return shared_ > 0 and 100 * shared_ >= percent * (len(a) + len(b) - shared_)


def test_a_node_of_a_block_s_size_is_compared_without_branching(spark, monkeypatch):
    # 300 texts with a common passage, no two similar: more than 256 components in one node.
    passage = " ".join(f"c{k}" for k in range(40))
    rows = [(i, f"{passage} {' '.join(f'o{i}x{k}' for k in range(30))}") for i in range(300)]
    monkeypatch.setattr(chosenpath._Join, "branch", lambda *_: pytest.fail("a node branched"))
    assert [r[2] for r in found(spark, rows)] == list(range(300))


def test_repeated_ids_nulls_extra_columns(spark):
    w, v, v2 = (" ".join(f"{x}{i}" for i in range(40)) for x in "wvv")
    v2 += " more"
    rows = [(1, w), (5, w), (5, v), (9, v2), (9, v2), (7, "x y"), (7, "x y"), (8, ""), (8, "")]
    assert found(spark, rows) == brute_force(rows)
    docs = spark.createDataFrame([*rows, (None, w), (None, None)], DOCUMENTS)
    got = [tuple(r) for r in chosenpath.group_documents(spark, docs).collect()]
    assert [r for r in got if r[0] is None and r[2:] != (None, None)] == [] and len(got) == len(rows) + 2
    assert chosenpath.group_documents(spark, docs.limit(0)).collect() == []


def test_long_text_and_hot_group(spark, monkeypatch):
    monkeypatch.setattr(chosenpath, "HOT", 5)
    monkeypatch.setattr(chosenpath, "MAX_BROADCAST_PAIRS", 0)
    monkeypatch.setattr(chosenpath, "PART", 4)
    long = " ".join(f"w{i % 9973}x{i}" for i in range(120_000))
    rows = [(i, f"{long} {i}") for i in range(3)]
    words = [f"a{k}" for k in range(100)]
    rows += [(10 + i, " ".join([*words, f"z{i}"])) for i in range(25)] + [(50 + i, " ".join(words)) for i in range(12)]
    assert found(spark, rows) == brute_force(rows)


def test_minwise_tokens_agree_as_often_as_sets_do():
    draw = np.random.default_rng(3)
    t = 0.8
    shared_ = draw.integers(0, 2**63, 800).astype(np.uint64)
    a, b = (np.unique(np.concatenate([shared_, draw.integers(0, 2**63, 100).astype(np.uint64)])) for _ in range(2))
    many = [chosenpath.minwise([a, b])]
    agree = np.mean([m[0] == m[1] for m in many])
    assert abs(agree - t) < 5 * (t * (1 - t) / chosenpath.POSITIONS) ** 0.5
    assert chosenpath.trees_for() == 4 and 0.03 < chosenpath.parted() < 0.032
    assert len(set(chosenpath.root_positions(4))) == 8
    assert shingle_sets(pa.array(["a b c d"]), 3)[0].shape == (2,)
