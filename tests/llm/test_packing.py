"""Packing: ids against the tokenizer, pieces against sequences, the solver on small histograms, odd input."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from martloom.llm.packing import combinations, make_plan, pack, solve_counts, whole_counts
from martloom.llm.queries import QUERIES, tokenizer_path

MODEL = Tokenizer.from_file(tokenizer_path())


def ids_of(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids + [2]


def assert_packed(rows, docs, window=4096):
    """``docs``: {id: ids}. Every id lies in one piece, sequences have no gaps and no padding."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for i, mine in pieces.items():
        at = 0
        for r in sorted(mine, key=lambda r: r.start):
            ids = np.array(docs[i][at : at + r.length], dtype="<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(docs[i]), zlib.crc32(ids.tobytes()))
            at += r.length
        assert at == len(docs[i])
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0
    return sequences


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    rows = QUERIES["op13_pack_sequences"](spark, sf_dir).collect()
    sequences = assert_packed(rows, {i: ids_of(t) for i, t in zip(docs.doc_id, docs.text)})
    full = sum(sum(n for _, n in s) == 4096 for s in sequences.values())
    assert full >= 0.7 * len(sequences)


@pytest.mark.parametrize("window", [64, 256])
def test_hot_lengths_and_long_documents(spark, window):
    rng = random.Random(window)
    texts = ["same words here"] * 300 + [" ".join("ab" * rng.randint(0, 3) for _ in range(rng.randint(0, 400))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = pack(docs, tokenizer_path(), window=window).collect()
    known = {i: ids_of(t) for i, t in enumerate(texts)}
    sequences = assert_packed(rows, known, window)
    assert all(r.ids == known[r.doc_id][r.start : r.start + r.length] for r in rows)
    assert sum(sum(n for _, n in s) < window for s in sequences.values()) <= 40


def test_odd_rows(spark):
    texts = [None, "", " \t\n", "a\x1cb c d", "Ünï café ΣΑΣ 漢字\U0001f600", "don't <|endoftext|>x", "y" * 3000, "İİ"]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, length int, rem int")
    assert_packed(pack(docs, tokenizer_path(), with_ids=False).collect(), {i: ids_of(t) for i, t in enumerate(texts)})
    again = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    rows = pack(again, tokenizer_path()).collect()
    assert sorted((r.doc_id or 0, tuple(r.ids)) for r in rows if r.doc_tokens == r.length) and sum(r.length for r in rows) == 9
    assert pack(docs.limit(0), tokenizer_path()).collect() == []
    with pytest.raises(ValueError):
        pack(docs, tokenizer_path(), window=100)


def test_combinations_fill_their_window():
    hist = np.bincount([3, 5, 7, 20, 11, 1, 16], minlength=64)
    size, lengths = combinations(hist, 64)
    assert (lengths.sum(axis=1) == size).all() and (size & (size - 1) == 0).all()
    assert (hist[lengths[lengths > 0]] > 0).all()
    listed = {(s, *sorted(x for x in row if x)) for s, row in zip(size.tolist(), lengths.tolist())}
    want = {(8, 3, 5), (32, 1, 11, 20), (16, 5, 11), (16, 16), (1, 1), (2, 1, 1), (8, 1, 7)}
    assert want <= listed and (8, 5, 5) not in listed


def test_counts_reproduce_an_exact_histogram():
    hist = np.zeros(64, dtype=np.int64)
    for lengths, times in (((30, 34), 50), ((10, 22), 40), ((7, 9), 30), ((5, 5, 6), 20)):
        for n in lengths:
            hist[n] += times
    size, lengths = combinations(hist, 64)
    x = solve_counts(lengths, hist, rounds=2000)
    made = np.bincount(lengths.ravel(), weights=np.repeat(x, 3), minlength=64)
    assert (x >= 0).all() and np.abs(made - hist)[1:].max() < 0.5
    counts, left = whole_counts(x, lengths, hist)
    assert (left >= 0).all() and left.sum() <= 0.05 * hist.sum()
    used = np.bincount(lengths.ravel(), weights=np.repeat(counts, 3), minlength=64)
    assert (used[1:] + left[1:] == hist[1:]).all()


def test_places_are_disjoint():
    rng = np.random.default_rng(4)
    hist = np.bincount(rng.integers(1, 256, 3000), minlength=256)
    hist[33] += 1500
    plan = make_plan(hist, 256)
    length = np.repeat(np.arange(256), hist)
    rank = np.arange(len(length)) - np.repeat(np.cumsum(hist) - hist, hist)
    planned, sequence, offset = plan.places(length, rank)
    assert (~planned).sum() == plan.left.sum()
    seen = set()
    for s, o, n in zip(sequence[planned].tolist(), offset[planned].tolist(), length[planned].tolist()):
        cells = {(s, o + i) for i in range(n)}
        assert not cells & seen and o + n <= 256
        seen |= cells
