"""Stored tables leave no shuffle files; linked nodes."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from wardgrid.llm import components, shared


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    shared.prepare(spark)


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f"{d}/{n}" for top in folders for d, _, names in os.walk(top) for n in names if n.startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = shared.stored(spark, spark.range(500).groupBy((F.col("id") % 9).alias("k")).count(), "shuffled")
    assert sum(r["count"] for r in table.collect()) == 500
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


@pytest.mark.parametrize("value", [None, "false"])
def test_the_session_s_setting_comes_back(spark, value):
    if value:
        spark.conf.set(shared.RELEASE, value)
    try:
        default = spark.conf.get(shared.RELEASE, None)
        with pytest.raises(ValueError), shared.shuffles_released(spark):
            assert spark.conf.get(shared.RELEASE) == "true"
            raise ValueError
        assert spark.conf.get(shared.RELEASE, None) == default
    finally:
        spark.conf.unset(shared.RELEASE)


def test_chains_end_at_their_smallest_node(spark):
    links = [(i + 1, i) for i in range(60) if i % 10 != 9] + [(5, 5), (0, 1)]
    found = components.components(spark, spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(i, i - i % 10) for i in range(60)]
    assert components.components(spark, spark.createDataFrame([], "a long, b long")).collect() == []
