"""Components of few links: one shuffle a round, in few tasks; the same result as by rounds of stars."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardgrid.llm import components, shared


@pytest.fixture(autouse=True)
def importable(spark):
    shared.prepare(spark)


@pytest.fixture
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def tasks(spark, run):
    """The number of tasks of all jobs of run()."""
    context = spark.sparkContext
    group = f"group-{random.random()}"
    context.setJobGroup(group, group)
    run()
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)


def plain(links):
    near = {}
    for a, b in links:
        if None not in (a, b) and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    found = {}
    for start in sorted(near):
        reach = [] if start in found else [start]
        for x in reach:
            if x not in found:
                found[x] = start
                reach += near[x]
    return sorted(found.items())


def shapes():
    rng = random.Random(4)
    order = list(range(400))
    rng.shuffle(order)
    chain = [(i, i + 1) for i in range(1000, 1200)]
    mixed = [(order[i] + 2000, order[i + 1] + 2000) for i in range(399)]
    star = [(5000 + 150, 5000 + i) for i in range(300) if i != 150]
    drawn = [(rng.randrange(9000, 9300), rng.randrange(9000, 9300)) for _ in range(160)]
    return [*chain, *mixed, *star, *drawn, *drawn[:50], *[(b, a) for a, b in drawn[:20]], (7, 7), (7, None), (None, None)]


@pytest.mark.parametrize("few", [0, 200_000])
@pytest.mark.parametrize("kind", ["long", "binary", "string"])
def test_components_of_all_shapes(spark, monkeypatch, few, kind):
    if few == 0 and kind != "long":
        pytest.skip("star rounds are slow; one kind is enough")
    monkeypatch.setattr(components, "FEW_LINKS", few)
    name = {"long": lambda x: x, "binary": lambda x: x.to_bytes(4, "big"), "string": lambda x: f"{x:05d}é"}[kind]
    links = [tuple(None if x is None else name(x) for x in pair) for pair in shapes()]
    found = components.components(spark, spark.createDataFrame(links, f"a {kind}, b {kind}"))
    got = [tuple(bytes(x) if kind == "binary" else x for x in row) for row in found.collect()]
    assert sorted(got) == plain(links)
    assert components.components(spark, spark.createDataFrame([(None, None)], f"a {kind}, b {kind}")).collect() == []


def test_least_reachable():
    rng = np.random.default_rng(2)
    for n in (1, 2, 50):
        for _ in range(20):
            a, b = rng.integers(0, n, (2, rng.integers(0, n + 1)))
            low = components.least_reachable(a, b, n)
            assert [(i, x) for i, x in enumerate(low.tolist()) if i in {*a[a != b], *b[a != b]}] == plain(zip(a.tolist(), b.tolist(), strict=True))


def test_few_links_take_few_tasks(spark, many_partitions):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert tasks(spark, lambda: components.components(spark, links).collect()) < 300


def test_fitted_keeps_rows_and_fits_tasks(spark, many_partitions):
    rows = spark.range(100).repartition(50, F.col("id"))
    assert shared.fitted(rows, 100).rdd.getNumPartitions() == shared.FEW_TASKS
    assert shared.fitted(rows, 100, 5).rdd.getNumPartitions() == 20
    assert shared.fitted(rows, 100_000, 5).rdd.getNumPartitions() == 50
    assert shared.fitted(rows, 0).count() == 100
