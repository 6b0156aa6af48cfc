"""The registered queries against SQL, brute force or held-out truth, over whole small tables."""

import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from oracle import connect, difference

import __spark_entry__ as contract
from martloom.llm.pieces import Vocabulary
from martloom.llm.queries import ORACLES, QUERIES, vocabulary_path


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {"pipeline", *QUERIES} <= set(contract.queries())


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas().sort_values("doc_id")


def plain_fingerprint(text):
    words = text.encode().lower().split()
    n = max(1, len(words) - 2)
    shingles = [b" ".join(words[i : i + 3]) for i in range(n)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(items, near):
    """Smallest member of the connected component of each item."""
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(items)
    for k, a in enumerate(order):
        for b in order[:k]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def test_simhash_groups(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    fps = {i: plain_fingerprint(t) for i, t in zip(docs.doc_id, docs.text)}
    want = plain_groups(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    rows = QUERIES["op7_simhash_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{fps[i]:016x}", want[i]) for i in fps
    }


def plain_cut(docs, length):
    """Bytes, removed bytes, runs and digest per document, by a set of all windows."""
    seen, out = set(), {}
    for i, text in docs:
        data = text.encode()
        gone = np.zeros(len(data) + 1, dtype=int)
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s] += 1
                gone[s + length] -= 1
            seen.add(window)
        mask = np.cumsum(gone)[:-1] > 0
        kept = bytes(b for b, g in zip(data, mask) if not g)
        runs = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        out[i] = (len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    want = plain_cut(zip(docs.doc_id, docs.text), 100)
    rows = QUERIES["op8_suffix_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert sum(w[1] for w in want.values()) > 0


def test_neighbour_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x, ids = np.array(rows.embedding.tolist(), dtype=np.float64), rows.vec_id.to_numpy()
    found = QUERIES["op1_nearest_neighbours"](spark, sf_dir).toPandas()
    hits = asked = 0
    for i in ids[ids % 20 == 0]:
        scores = x @ x[ids == i][0]
        best = sorted((-s, v) for s, v in zip(scores, ids) if v != i)[:20]
        mine = found[found.query_id == i].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert np.allclose(mine.score, [scores[ids == v][0] for v in mine.vec_id], atol=1e-12)
        hits += len({v for _, v in best} & set(mine.vec_id))
        asked += 20
    assert hits / asked >= 0.9


def test_held_out_languages(spark, sf_dir):
    docs = _docs(spark, sf_dir).set_index("doc_id")
    rows = QUERIES["op2_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    right = sum(r.lang_pred == docs.lang[r.doc_id] for r in held)
    assert right / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_toxicity(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id").toxic
    rows = QUERIES["op3_toxicity"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels.index]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    flagged = [r for r in held if r.predicted == 1]
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    assert sum(labels[r.doc_id] for r in flagged) >= 0.9 * len(flagged) > 0
    assert sum(labels[r.doc_id] for r in flagged) >= 0.5 * sum(labels[r.doc_id] for r in held)


def test_every_text_has_its_best_pieces(spark, sf_dir):
    """Each text as one string through the plain Viterbi, and its digest; the text comes back."""
    docs, vocabulary = _docs(spark, sf_dir), Vocabulary(vocabulary_path())
    rows = QUERIES["op5_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    texts = dict(zip(docs.doc_id, docs.text))
    for r in rows:
        plain = ("▁" + texts[r.doc_id].replace(" ", "▁")) if texts[r.doc_id] else ""
        assert r.sp_ids == vocabulary.best(plain)[0]
        assert r.sp_bytes == sum(i in vocabulary.byte_id for i in r.sp_ids)
        assert r.sp_exact and r.sp_n == len(r.sp_ids)
        raw = np.array(r.sp_ids, dtype="<i4").tobytes()
        assert r.sp_digest == hashlib.sha256(raw).hexdigest()
