"""Ranked search: against a plain scoring of all documents, over several shards, and on odd input."""

import math
import random
import re
from collections import Counter

import pytest

from martloom.llm import ranked
from martloom.llm.common import Scratch
from martloom.llm.ranked import build_index, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k):
    """{item: [(doc, score)]} by scoring every document."""
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total, n_docs = sum(sum(c.values()) for _, c in counts), len(counts)
    df = Counter(t for _, c in counts for t in c)
    out = {}
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = 0
            for t, times in Counter(TERM.findall(text.translate(LOWER))).items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0 and i is not None:
                scores.append((i, score))
        best = sorted(scores, key=lambda x: (-x[1], x[0]))[:k]
        if best:
            out[item] = best
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.item_id, r["rank"])):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


def run(spark, docs, items, shard_terms=2_000_000, **more):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    index = Scratch(spark, "index").write(build_index(docs, shard_terms=shard_terms))
    return found(search(index, spark.createDataFrame(items, "item_id long, text string"), **more).collect())


@pytest.mark.parametrize("shard_terms", [300, 20_000, 2_000_000])
def test_equals_plain_scoring(spark, monkeypatch, shard_terms):
    monkeypatch.setattr(ranked, "BLOCK", 8)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 300])))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]  # ties beyond the heap
    docs += [(9999, "x " * 70_000 + "w5")]  # counts beyond two bytes
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 8, 50])))) for i in range(40)]
    items.append((99, docs[7][1]))
    assert run(spark, docs, items, shard_terms, k=5) == plain(docs, items, 5)


def test_blocks_of_queries_make_no_difference(spark):
    docs = [(i, f"a{i % 7} b{i % 5} c{i}") for i in range(100)]
    items = [(i, f"a{i % 7} b{i} b{i} unknown") for i in range(9)]
    assert run(spark, docs, items, most_terms=2) == plain(docs, items, 20)


def test_blocks_of_survivors_alone_are_decompressed(monkeypatch, spark):
    """A term of every document must not be read whole when rarer terms have filled the heap."""
    opened = []
    real = ranked.Postings.block
    monkeypatch.setattr(ranked.Postings, "block", lambda self, b: opened.append(b) or real(self, b))
    numbers = ranked.Numbers()
    texts = []
    for i in range(20_000):
        words = ["common"] + ["rare"] * (20 if i < 30 else 0) + [f"f{i % 50}"]
        texts.append(ranked.np.array([numbers[w.encode()] for w in words]))
    rows = [r for b in ranked.shard_rows(0, list(range(len(texts))), texts, numbers) for r in b.to_pylist()]
    import pyarrow as pa

    found = ranked._search_shard(
        pa.Table.from_pylist(rows, pa.schema([(k, pa.int64()) for k in ("shard", "df")] + [("term", pa.binary()), ("posts", pa.binary())]
                             + [(k, pa.list_(pa.int64())) for k in ("blocks", "tops", "ids", "sizes")])),
        [{b"common": 1, b"rare": 1}], {b"common": 2, b"rare": 5000}, len(texts), sum(map(len, texts)), 20,
    )
    assert found.column("doc_id").to_pylist() == list(range(20))
    assert len(opened) == 2  # one block of the rare term, one of the 157 of the common one


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,!\x00"), (None, "cat cat cat"), (4, "Cat hat"), (4, "Cat hat"), (5, "ÄÖ 漢字 cat"), (6, "k" * 90_000)]
    items = [(1, "CAT äö ÄÖ"), (2, "..."), (3, "漢字"), (4, "K" * 90_000)]
    assert run(spark, docs, items) == plain(docs, items, 20)
    frame = spark.createDataFrame([(None, "cat", 1), (7, None, 1), (8, "cat", 1), (8, "cat", 1), (8, "hat", 1)], "item_id long, text string, score int")
    clash = spark.createDataFrame([(*d, 1, "t", 2) for d in docs], "doc_id long, text string, id int, term string, shard int")
    index = Scratch(spark, "index").write(build_index(clash))
    assert found(search(index, frame).collect()) == plain(docs, [(8, "cat hat")], 20)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == {}
    assert run(spark, [(1, "a")], []) == {}
    assert run(spark, [(1, None)], [(1, "a")]) == {}
