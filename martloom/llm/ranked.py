"""Ranked lexical search by Block-Max MaxScore over an inverted index in shards.

An index is a table of shards, each made from the documents of one task alone: a row per term with its postings
in compressed blocks, and one row (term null) with the shard's document ids and lengths. As the statistics of
the collection are not in it, shards can be added at any time. A block carries the pairs (length, occurrences)
that no other posting of the block beats in both; the block's highest score under any statistics is among them.

A query takes its lists by falling upper bound. Lists are essential as long as the bounds of the rest could still
bring an unseen document among the best; their postings are all scored. Documents found so far are then checked
against the other lists: first by the bound of the block that would hold them, and only blocks of survivors are
decompressed. Each shard returns a heap of k documents per query, and the heaps are merged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import Numbers, Scratch

BLOCK = 128  # postings of a block
HEAD = 4  # numbers per block in ``blocks``: first and last document, postings, code of the byte widths
INDEX = (
    "shard long, term binary, df long, blocks array<int>, tops array<int>, posts binary, ids array<long>, sizes array<long>"
)
_KEPT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters and digits; every character beyond ASCII counts as a letter, A-Z are lowered."""
    return text.translate(_KEPT).split()


def _widths(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    """Write ``values`` as little-endian numbers of ``width`` bytes at the places ``at``."""
    for byte in range(4):
        wide = width > byte
        if wide.any():
            out[at[wide] + byte] = (values[wide] >> (8 * byte)) & 255


def _lists(values: np.ndarray, ends: np.ndarray, kind) -> pa.Array:
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def shard_rows(shard: int, ids: list, texts: list[np.ndarray], numbers: Numbers) -> Iterator[pa.RecordBatch]:
    """Index rows of one shard; ``texts`` hold the term numbers of each document, none empty."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    terms = sorted(numbers)
    place = np.empty(len(terms), dtype=np.int64)
    place[np.fromiter((numbers[t] for t in terms), dtype=np.int64, count=len(terms))] = np.arange(len(terms))
    key = np.sort((place[np.concatenate(texts)] << 32) | np.repeat(np.arange(len(texts)), sizes))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    tf = np.diff(np.append(first, len(key)))
    term, doc = key[first] >> 32, key[first] & 0xFFFFFFFF
    n = len(term)
    starts = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))  # of lists
    df = np.diff(np.append(starts, n))
    opens = (np.arange(n) - np.repeat(starts, df)) % BLOCK == 0
    begin = np.flatnonzero(opens)  # of blocks
    count = np.diff(np.append(begin, n))
    block = np.cumsum(opens) - 1
    gap = np.where(opens, 0, np.diff(doc, prepend=0))
    wide, deep = _widths(np.maximum.reduceat(gap, begin)), _widths(np.maximum.reduceat(tf, begin))
    byte = np.concatenate(([0], np.cumsum(count * (wide + deep))))
    out = np.zeros(byte[-1], dtype=np.uint8)
    inside = np.arange(n) - begin[block]
    _put(out, byte[block] + inside * wide[block], gap, wide[block])
    _put(out, byte[block] + count[block] * wide[block] + inside * deep[block], tf, deep[block])

    # by rising length, the postings with more occurrences than any shorter document of their block
    order = np.lexsort((-tf, sizes[doc], block))
    b, f = block[order], tf[order]
    high = np.maximum.accumulate(f + (b << 40))
    top = np.concatenate(([True], f[1:] + (b[1:] << 40) > np.maximum(high[:-1], b[1:] << 40)))
    b, f, length = b[top], f[top], sizes[doc[order][top]]
    first_block = block[starts]
    lists = np.searchsorted(first_block, b, side="right") - 1
    tops = np.stack((b - first_block[lists], length, f), axis=1).astype(np.int32)
    blocks = np.stack((doc[begin], doc[begin + count - 1], count, wide * 8 + deep), axis=1).astype(np.int32)

    after = np.append(first_block[1:], len(begin))
    none = pa.nulls
    m = len(terms)
    offsets = pa.py_buffer(np.concatenate(([0], byte[after])).astype(np.int32).tobytes())
    names = [x.split()[0] for x in INDEX.split(", ")]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(m, shard)), pa.array(terms, pa.binary()), pa.array(df.astype(np.int64)),
            _lists(blocks.ravel(), HEAD * after, pa.int32()),
            _lists(tops.ravel(), 3 * np.searchsorted(b, after), pa.int32()),
            pa.Array.from_buffers(pa.binary(), m, [None, offsets, pa.py_buffer(out.tobytes())]),
            none(m, pa.list_(pa.int64())), none(m, pa.list_(pa.int64())),
        ],
        names,
    )
    ints = pa.list_(pa.int32())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int64()), none(1, pa.binary()), none(1, pa.int64()), none(1, ints), none(1, ints),
            none(1, pa.binary()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
        ],
        names,
    )


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shard_terms: int = 2_000_000
) -> DataFrame:
    """Index rows of all documents; a shard closes with the document that brings it to ``shard_terms`` terms.

    Documents without terms (null, empty or blank texts) are in no shard and in no statistic. A null id keeps its
    document in the statistics, but the document is never returned. Repeated rows are documents of their own.
    Write the result before it is searched: its shards are numbered by task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        ids, texts, numbers, total = [], [], Numbers(), 0
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                words = terms_of(text.as_py() or b"")
                if words:
                    ids.append(i.as_py())
                    texts.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)))
                    total += len(words)
                if total >= shard_terms:
                    yield from shard_rows(shard, ids, texts, numbers)
                    shard += 1
                    ids, texts, numbers, total = [], [], Numbers(), 0
        if texts:
            yield from shard_rows(shard, ids, texts, numbers)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, INDEX)


class Postings:
    """One term's list in a shard, decompressed block by block as needed."""

    def __init__(self, blocks: np.ndarray, tops: np.ndarray, posts: bytes, norms: np.ndarray, norm_of):
        heads = blocks.reshape(-1, HEAD)
        self.first, self.last, self.count = heads[:, 0], heads[:, 1], heads[:, 2]
        self.wide, self.deep = heads[:, 3] >> 3, heads[:, 3] & 7
        self.byte = np.concatenate(([0], np.cumsum(self.count * (self.wide + self.deep))))
        self.posts, self.norms, self.whole = posts, norms, None
        number, length, tf = tops.reshape(-1, 3).T
        best = impact(tf, norm_of(length))
        self.best = np.maximum.reduceat(best, np.flatnonzero(np.diff(number, prepend=-1)))
        self.bound = int(self.best.max())

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and their impacts in block ``b``."""
        at, n, w, d = int(self.byte[b]), int(self.count[b]), int(self.wide[b]), int(self.deep[b])
        gaps = np.frombuffer(self.posts, dtype=f"<u{w}", count=n, offset=at)
        tf = np.frombuffer(self.posts, dtype=f"<u{d}", count=n, offset=at + n * w)
        doc = np.cumsum(gaps, dtype=np.int64) + self.first[b]
        return doc, impact(tf, self.norms[doc])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            parts = [self.block(b) for b in range(len(self.first))]
            self.whole = tuple(np.concatenate(x) for x in zip(*parts))
        return self.whole


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """A posting's share of its term's weight, in billionths: rises with ``tf``, falls with ``norm``."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * norm)


def norms(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 75 + (25 * sizes.astype(np.int64) * n_docs) // n_terms


def best_documents(lists: list[tuple[int, Postings]], n_docs: int, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the k best documents of a shard; ``lists`` are (weight, postings), ties go to small ids."""
    lists = sorted(((w, p) for w, p in lists if w > 0), key=lambda x: -x[0] * x[1].bound)
    rest = np.append(np.cumsum([w * p.bound for w, p in lists][::-1])[::-1], 0)
    score, i, low = np.zeros(n_docs, dtype=np.int64), 0, 0
    while i < len(lists) and rest[i] >= low:  # essential lists
        weight, postings = lists[i]
        doc, part = postings.all()
        score[doc] += weight * part
        i += 1
        if n_docs > k:
            low = max(1, int(np.partition(score, n_docs - k)[n_docs - k]))
    found = np.flatnonzero((score > 0) & (score + rest[i] >= low))
    have = score[found]
    for j in range(i, len(lists)):
        weight, postings = lists[j]
        b = np.searchsorted(postings.last, found)
        inside = b < len(postings.last)
        b[~inside] = 0
        inside &= postings.first[b] <= found
        hope = have + np.where(inside, weight * postings.best[b], 0) + rest[j + 1]
        stays = hope >= low
        found, have, b, inside = found[stays], have[stays], b[stays], inside[stays]
        for number in np.unique(b[inside]).tolist():  # only these blocks are decompressed
            doc, part = postings.block(number)
            mine = np.flatnonzero(inside & (b == number))
            at = np.minimum(np.searchsorted(doc, found[mine]), len(doc) - 1)
            have[mine] += np.where(doc[at] == found[mine], weight * part[at], 0)
        if len(found) > k:
            low = max(low, int(np.partition(have, len(have) - k)[len(have) - k]))
    order = np.lexsort((ids[found], -have))[:k]
    return found[order], have[order]


def _search_shard(table: pa.Table, items: list[dict], weight: dict, n_docs: int, n_terms: int, k: int) -> pa.Table:
    """(item, doc_id, score) of the best documents of one shard for each item."""
    rows = table.to_pylist()
    own = next(r for r in rows if r["term"] is None)
    known = np.array([i is not None for i in own["ids"]])
    sizes = np.array(own["sizes"], dtype=np.int64)
    ids = np.array([i or 0 for i in own["ids"]], dtype=np.int64)
    length = norms(sizes, n_docs, n_terms)
    lists = {
        r["term"]: Postings(
            np.array(r["blocks"], dtype=np.int64), np.array(r["tops"], dtype=np.int64), r["posts"], length,
            lambda n: norms(n, n_docs, n_terms),
        )
        for r in rows if r["term"] is not None
    }
    unnamed = int((~known).sum())
    at, docs, scores = [], [], []
    for number, item in enumerate(items):
        here = [(times * weight[t], lists[t]) for t, times in item.items() if t in lists]
        if here:
            # documents without an id may take places, so as many more are asked for
            doc, score = best_documents(here, len(ids), ids, k + unnamed)
            named = known[doc]
            doc, score = doc[named][:k], score[named][:k]
            at.append(np.full(len(doc), number))
            docs.append(ids[doc])
            scores.append(score)
    empty = [np.zeros(0, dtype=np.int64)]
    columns = [pa.array(np.concatenate(x or empty).astype(np.int64)) for x in (at, docs, scores)]
    return pa.Table.from_arrays(columns, ["number", "doc_id", "score"])


def _shard_task(shared, n_docs: int, n_terms: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        return _search_shard(table, *shared.value, n_docs, n_terms, k)

    return run


def _blocks(queries: DataFrame, most_terms: int) -> Iterator[list[tuple[str, Counter]]]:
    """Queries in blocks of up to ``most_terms`` different terms (or one query with more)."""
    block, n = [], 0
    for row in queries.toLocalIterator():
        terms = Counter(terms_of((row["text"] or "").encode()))
        if block and n + len(terms) > most_terms:
            yield block
            block, n = [], 0
        block.append((row["item"], terms))
        n += len(terms)
    if block:
        yield block


def search(
    index: DataFrame,
    queries: DataFrame,
    item_col: str = "item_id",
    text_col: str = "text",
    *,
    k: int = 20,
    most_terms: int = 50_000,
) -> DataFrame:
    """(item, rank, doc_id, score): the ``k`` documents of a written ``index`` with the highest scores above 0.

    Exact. With N documents that have terms, L terms in all, a term in df of them weighs
    w = floor(1000 ln((2N + 2) / (2 df + 1))); a document of n terms has m = 75 + 25 n N div L, and a term that it holds tf
    times adds w * (10^9 tf div (1000 tf + 12 m)) for each time the query holds the term. Equal scores are ranked by
    rising id. Queries are taken in blocks of ``most_terms`` terms, whose weights are broadcast; a block's lists are gathered by
    shard, so a task holds the lists of one shard. A null item takes no part, a query without known terms
    has no rows, repeated rows of an item count once, and different texts of one item are searched as one text.
    """
    spark = index.sparkSession
    scratch = Scratch(spark, "search")
    kind = queries.schema[item_col].dataType
    asked = queries.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    asked = asked.where("item is not null and text is not null").distinct()
    asked = asked.groupBy("item").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n").alias("text"))
    whole = index.where("term is null").agg(
        F.sum(F.size("ids")).alias("docs"),
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms"),
    )
    n_docs, n_terms = (x or 0 for x in whole.first())
    found = spark.createDataFrame([], "item string, rank int, doc_id long, score long")
    for block in _blocks(asked, most_terms):
        terms = sorted({t for _, item in block for t in item})
        wanted = F.broadcast(spark.createDataFrame([(t,) for t in terms] + [(None,)], "wanted binary"))
        lists = index.join(wanted, F.col("term").eqNullSafe(F.col("wanted"))).drop("wanted")
        counts = lists.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")).collect()
        weight = {bytes(r.term): math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1))) for r in counts}
        items = [{t: c for t, c in item.items() if t in weight} for _, item in block]
        shared = spark.sparkContext.broadcast((items, weight))
        task = _shard_task(shared, n_docs, n_terms, k)
        heaps = lists.groupBy("shard").applyInArrow(task, "number long, doc_id long, score long")
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "number long, item string")
        best = _top(heaps, k).join(F.broadcast(names), "number").select("item", "rank", "doc_id", "score")
        found = found.union(scratch.write(best))
    return found.select(F.col("item").cast(kind).alias(item_col), "rank", "doc_id", "score")


def _top(rows: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, with their rank; every map task keeps k before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.col("score").desc(), "doc_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)
