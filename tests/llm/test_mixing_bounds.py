"""Margins of the mixture at the stage's own parameters, where many cells reach probability 1."""

import numpy as np
from test_llm_operators import long_text, none, odd  # noqa: F401

from martloom.llm.mixing import mix


def reachable(tokens, power, share):
    """Shares of the kept tokens: each category's target, or all that it has."""
    goal = tokens**power
    lo, hi = 0.0, float((tokens / goal).max())
    for _ in range(200):
        c = (lo + hi) / 2
        lo, hi = (c, hi) if np.minimum(tokens, c * goal).sum() < share * tokens.sum() else (lo, c)
    kept = np.minimum(tokens, hi * goal)
    return kept / kept.sum()


def test_bounded_margins_are_met(spark, odd, none):  # noqa: F811
    rows = []
    for i in range(6000):  # a third on one source, few with the rare topics
        text = "w " * (5 + i % 11) + ("icense" if i % 40 == 0 else " | " if i % 30 == 1 else "@" if i % 9 == 4 else "")
        rows.append((i, text, f"s{0 if i % 3 == 0 else i % 7}", ("en", "en", "fr", "de")[i % 4]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = mix(docs, bounded=True).toPandas()
    expected = out.n_tokens * out.probability
    assert abs(expected.sum() / out.n_tokens.sum() - 0.8) < 1e-6 and out.probability.max() <= 1
    for key in ("source", "lang", "topic"):
        want = reachable(out.groupby(key).n_tokens.sum().astype(float), 0.7, 0.8)
        assert np.allclose(expected.groupby(out[key]).sum() / expected.sum(), want, atol=5e-3)
    assert mix(odd, bounded=True).count() == odd.count() and mix(none, bounded=True).count() == 0
