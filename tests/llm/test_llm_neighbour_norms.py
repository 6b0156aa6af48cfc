"""Neighbours by inner product among vectors of mixed lengths, against brute force."""

import numpy as np
import pytest

from martloom.llm import neighbours
from martloom.llm.neighbours import nearest_neighbours


def recall(spark, x, every=20):
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    out = nearest_neighbours(df, every=every).toPandas()
    hits = 0
    for q in range(0, len(x), every):
        sim = x @ x[q]
        sim[q] = -np.inf
        hits += len(set(np.argsort(-sim, kind="stable")[:20]) & set(out[out.query_id == q].vec_id))
    return hits / (20 * len(range(0, len(x), every)))


@pytest.mark.parametrize("spread, outlier", [(0.2, 1), (1.0, 1), (0.2, 1e4)])
def test_recall_with_mixed_lengths(spark, spread, outlier):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((6000, 12))
    x *= np.exp(spread * rng.standard_normal((6000, 1))) / np.linalg.norm(x, axis=1, keepdims=True)
    x[[7, 4000]] *= outlier
    assert recall(spark, x, every=100) > 0.95


@pytest.mark.parametrize("spread", [0, 0.5])
def test_recall_with_few_heads(spark, monkeypatch, spread):
    """Most vectors are found by walking the graph alone, not by comparing them with the longest ones."""
    monkeypatch.setattr(neighbours, "HEADS", 64)
    monkeypatch.setattr(neighbours, "STARTS", 16)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((5000, 24))
    x *= np.exp(spread * rng.standard_normal((5000, 1))) / np.linalg.norm(x, axis=1, keepdims=True)
    assert recall(spark, x, every=100) > 0.9
