"""Periodic runs: against a scan of every lag, the query against a plain version, and odd input."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import runs
from martloom.llm.queries import QUERIES
from martloom.llm.runs import find_runs, periodic_runs


def plain_runs(words, least=24, times=3):
    """Every maximal stretch by comparing all words at all lags; the smallest period of each."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i, n = 0, len(words) - q
        while i < n:
            j = i
            while j < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda x: (x[0], x[2]))


def planted(rng, n, kinds, plants):
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(plants if n >= 24 else 0):
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        for i in range(a, min(n, a + rng.randint(2 * p, 6 * p + 1))):
            words[i] = words[a + (i - a) % p]
    return words


def test_equals_scan_of_all_lags():
    rng, total = random.Random(9), 0
    for _ in range(150):
        texts = [
            planted(rng, rng.choice([0, 5, 23, 24, 30, 100, 400, 900]), rng.choice([1, 2, 3, 20, 1000]), rng.randint(0, 3))
            for _ in range(rng.randint(1, 6))
        ]
        want = [plain_runs(t) for t in texts]
        total += sum(map(len, want))
        assert find_runs([np.array(t, dtype=np.int64) for t in texts]) == want
    assert total > 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=160), st.integers(1, 60))
def test_two_letter_texts(words, tail):
    words = (words * 4)[: len(words) * 3 + tail]
    assert find_runs([np.array(words, dtype=np.int64)]) == [plain_runs(words)]


def test_hash_collisions_do_not_matter(monkeypatch):
    """With hashes of two bits nearly every stretch seems equal; what is found is still compared word by word."""
    rng = random.Random(2)
    words = planted(rng, 300, 50, 2)
    monkeypatch.setattr(runs, "_mixed", lambda x: x & np.uint64(3))
    for got in find_runs([np.array(words, dtype=np.int64)])[0]:
        assert got[2] <= got[1] // 3 and got in plain_runs(words)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    rows = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    with_runs = 0
    for i, text in zip(docs.doc_id, docs.text):
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        want, gone = plain_runs(words), set()
        for s, m, q in want:
            gone |= set(range(s + q, s + m))
        best = max(want, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        r = rows[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in want)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        with_runs += bool(want)
    assert with_runs >= 5


def test_odd_rows(spark):
    again = " ".join(f"w{i % 20}" for i in range(70))
    long = " ".join(f"v{i % 9000}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, again), (1, again), (1, again), (4, "x " * 24), (5, "x " * 23), (6, long)]
    docs = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], "doc_id long, text string, start int, collapsed string, __n int")
    out = periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "start", "__n", "runs", "collapsed"]
    got = sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    once = " ".join(f"w{i}" for i in range(20))
    want = [
        (0, [(0, 70, 20)], once), (1, [], ""), (1, [(0, 70, 20)], once), (1, [(0, 70, 20)], once), (2, [], ""), (3, [], ""),
        (4, [(0, 24, 1)], "x"), (5, [], ("x " * 23).strip()), (6, [(0, 30_000, 9000)], " ".join(f"v{i}" for i in range(9000))),
    ]
    assert got == want
    assert periodic_runs(docs.limit(0)).collect() == []


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        find_runs([], times=2)
