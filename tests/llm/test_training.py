"""The toxicity model is trained in a task, not on the driver."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardgrid.llm import shared, toxicity


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    shared.prepare(spark)


def test_the_driver_does_not_train(spark, monkeypatch):
    texts = [f"w{i} w{i + 1} {'idiot' if i % 4 == 0 else 'friend'} w{i % 7}" for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id long, toxic int")
    driver, train = os.getpid(), toxicity.train

    def elsewhere(*arrays, **parameters):
        assert os.getpid() != driver
        return train(*arrays, **parameters)

    monkeypatch.setattr(toxicity, "train", elsewhere)
    weights, intercept = toxicity.learn(docs, labels, F.lit(True), steps=60)
    assert weights.dtype == np.float32 and len(weights) == 1 << toxicity.BITS and np.isfinite(intercept)
    assert weights[toxicity.features_of("idiot")[0]] > 0 > weights[toxicity.features_of("friend")[0]]
    assert toxicity.learn(docs, labels.filter("toxic = 0"), F.lit(True)) is None
