"""Packing of tokenised documents into sequences by non-negative least squares over length combinations.

Whole windows of a long document are sequences of their own, so what is packed are remainders shorter than a window.
Shallow combinations (one, two or three lengths) that exactly fill a window of 2^k tokens are enumerated; non-negative
least squares finds how often each must occur to reproduce the histogram of lengths; the counts are rounded, and what
documents remain are packed greedily. Filled windows of one size are laid side by side up to the full length. As a
sequence whose length is a power of two needs no padding, the few windows left over make shorter sequences of such
lengths, and nothing is padded at all.

Only the histogram, one number per length, comes to the driver. Documents find their slot by their rank among those of
equal length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import Scratch, WordTable, end_to_end
from martloom.operators.dedup import row_sequence

DEEP = 1024  # three lengths are combined for windows up to this size, two for larger ones
GROUP = 20_000  # remaining documents laid end to end by one task, about
PIECES = "array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>"


def combinations(hist: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, lengths): windows of 2^k tokens and up to three lengths that fill them, 0 where there are fewer.

    Only lengths that occur (``hist`` above 0) are combined.
    """
    have, parts = hist > 0, []
    size = 1
    while size <= window:
        if size < window and have[size]:
            parts.append(np.array([[size, size, 0, 0]]))
        a = np.flatnonzero(have[: size // 2 + 1])
        b = size - a
        two = (a > 0) & (b < window) & have[np.minimum(b, window - 1)]
        a, b = a[two], b[two]
        parts.append(np.stack((np.full(len(a), size), a, b, np.zeros_like(a)), axis=1))
        if size <= DEEP:
            small = np.flatnonzero(have[: size + 1])
            small = small[small > 0]
            x, y = np.meshgrid(small, small, indexing="ij")
            z = size - x - y
            three = (x <= y) & (y <= z)
            x, y, z = x[three], y[three], z[three]
            there = have[z]
            parts.append(np.stack((np.full(len(x), size), x, y, z), axis=1)[there])
        size *= 2
    every = np.concatenate(parts) if parts else np.zeros((0, 4), dtype=np.int64)
    return every[:, 0], every[:, 1:]


def solve_counts(lengths: np.ndarray, hist: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Counts x >= 0 of the combinations that minimise the squared distance of their lengths from ``hist``.

    Multiplicative steps x * (A'b) / (A'Ax), which never leave the non-negative numbers or raise the distance. Column 0
    stands for no length.
    """
    goal = hist.astype(np.float64)
    goal[0] = 0

    def back(y: np.ndarray) -> np.ndarray:
        return y[lengths].sum(axis=1)

    x = np.ones(len(lengths))
    want = back(goal)
    for _ in range(rounds):
        made = np.bincount(lengths.ravel(), weights=np.repeat(x, 3), minlength=len(hist))
        made[0] = 0
        x *= want / np.maximum(back(made), 1e-12)
    return x


def whole_counts(x: np.ndarray, lengths: np.ndarray, hist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, left): rounded counts that the documents suffice for, raised greedily, and the histogram left over."""
    left = hist.astype(np.int64).tolist()
    left[0] = 0
    counts = np.zeros(len(x), dtype=np.int64)
    order = np.argsort(-x, kind="stable")
    rounded = np.rint(x).astype(np.int64)
    for most in (rounded, None):  # as solved first, then as many as there are documents for
        for j in order.tolist():
            need: dict[int, int] = {}
            for n in lengths[j].tolist():
                if n:
                    need[n] = need.get(n, 0) + 1
            fits = min(left[n] // times for n, times in need.items())
            if most is not None:
                fits = min(fits, int(most[j]))
            if fits > 0:
                counts[j] += fits
                for n, times in need.items():
                    left[n] -= fits * times
    return counts, np.array(left, dtype=np.int64)


@dataclass
class Plan:
    """Where the document of a given length and rank goes; all arrays are bounded by the number of combinations."""

    window: int
    key: np.ndarray  # length << 40 | first rank, ascending
    count: np.ndarray  # documents of that length and from that rank on
    size: np.ndarray  # of the window they go to
    first: np.ndarray  # number of their first window among those of its size
    inside: np.ndarray  # offset in the window
    windows: dict[int, int]  # windows of each size
    left: np.ndarray  # documents of each length that are in no combination

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(planned, sequence, offset) of documents by length and rank from 0; sequences are numbered from 0."""
        if not len(self.key):
            return np.zeros(len(length), dtype=bool), length * 0, length * 0
        i = np.maximum(np.searchsorted(self.key, (length << 40) | rank, side="right") - 1, 0)
        ahead = rank - (self.key[i] & ((1 << 40) - 1))
        planned = (self.key[i] >> 40 == length) & (ahead < self.count[i])
        number, size = self.first[i] + ahead, self.size[i]
        sequence, offset, base = np.zeros_like(number), np.zeros_like(number), 0
        for each, total in self.windows.items():
            mine = planned & (size == each)
            side = self.window // each
            full = total // side
            v = number[mine]
            row, at = v // side, v % side * each
            # the rest of this size as sequences of a power of two windows each
            rest, part, begin = total % side, 0, 0
            while rest - begin:
                width = 1 << ((rest - begin).bit_length() - 1)
                here = (v >= full * side + begin) & (v < full * side + begin + width)
                row = np.where(here, full + part, row)
                at = np.where(here, (v - full * side - begin) * each, at)
                begin, part = begin + width, part + 1
            sequence[mine], offset[mine] = base + row, at + self.inside[i][mine]
            base += full + part
        return planned, sequence, offset


def make_plan(hist: np.ndarray, window: int = 4096) -> Plan:
    """Combinations and counts for documents with ``hist[n]`` of length n below ``window``."""
    size, lengths = combinations(hist, window)
    counts, left = whole_counts(solve_counts(lengths, hist), lengths, hist) if len(size) else (size, hist.copy())
    left[0] = 0
    used = np.flatnonzero(counts)
    given = np.zeros(len(hist), dtype=np.int64)
    rows, windows = [], {}
    for j in used.tolist():
        w, n = int(size[j]), int(counts[j])
        at = 0
        for x in lengths[j].tolist():
            if x:
                rows.append(((x << 40) | int(given[x]), n, w, windows.get(w, 0), at))
                given[x] += n
                at += x
        windows[w] = windows.get(w, 0) + n
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return Plan(window, *columns, dict(sorted(windows.items())), left)


class WordEncoder:
    """Ids of single words as the tokenizer gives them, many words at a time.

    For a vocabulary whose pieces mark the end of a word, words are cut where the tokenizer cuts them itself (runs of
    letters, digits, runs of ASCII punctuation), and the parts are encoded as one text; each must end one marked piece, or
    the tokenizer is asked about each alone. Words with any other character are given to it as they are.
    """

    def __init__(self, model, mark: str = "</w>"):
        self.model = model
        self.ends = np.zeros(model.get_vocab_size(), dtype=bool)
        marked = [number for piece, number in model.get_vocab().items() if piece.endswith(mark)]
        self.ends[marked] = True
        self.parts = WordTable(self._joined) if marked else None
        # an apostrophe may begin a part with letters, "<" a special piece
        self.cut = re.compile(r"[^\W\d_]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+|\n")
        self.plain = {chr(c) for c in range(33, 127)} - {"'", "<"} | {"\n"}

    def _single(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return end_to_end([e.ids for e in self.model.encode_batch_fast(words, add_special_tokens=False)])

    def _joined(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for lo in range(0, len(parts), 1000):
            some = parts[lo : lo + 1000]
            ids = self._single([" ".join(some)])[0]
            at = np.flatnonzero(self.ends[ids]) + 1
            # every part ends a marked piece at least, so as many ends as parts means one each
            whole = len(at) == len(some) and at[-1] == len(ids)
            out.append((ids, np.diff(at, prepend=0)) if whole else self._single(some))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, digits and ASCII punctuation, and how many each has."""
        parts = np.array(self.cut.findall("\n".join(words) + "\n"), dtype=object)
        ends = np.flatnonzero(parts == "\n")
        offsets = np.concatenate(([0], ends - np.arange(len(words)))).astype(np.int32)
        return self.parts.lookup(pa.ListArray.from_arrays(offsets, pa.array(parts[parts != "\n"], pa.string())))

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.parts is None:
            return self._single(words)
        # letters that are lowered to something beside letters are not cut as letters
        odd = [c for c in set("".join(words)) - self.plain if c.isascii() or not (c.isalpha() and c.lower().isalpha())]
        if not odd:
            return self._cut(words)
        has = re.compile("[" + re.escape("".join(odd)) + "]").search
        known = np.array([not has(w) for w in words])
        sizes = np.zeros(len(words), dtype=np.int64)
        other, sizes[~known] = self._single([w for w, k in zip(words, known) if not k])
        ids = other[:0]
        if known.any():
            ids, sizes[known] = self._cut([w for w, k in zip(words, known) if k])
        mine = np.repeat(known, sizes)
        out = np.zeros(len(mine), dtype=np.int64)
        out[mine], out[~mine] = ids, other
        return out, sizes


def words_of(texts: pa.Array) -> pa.ListArray:
    """Words between ASCII white space, lowered as the tokenizer does, but for texts that may hold special pieces."""
    texts = pc.fill_null(texts, "")
    special = pc.match_substring(texts, "<|")
    return pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))


def tokenise(docs: DataFrame, model_path: str, text_col: str, end_id: int, window: int) -> DataFrame:
    """``docs`` columns, ``__row`` (unique), ``__n``, ``__first`` and ``__ids`` (little-endian numbers).

    Ids have 16 bits where the vocabulary fits, else 32.

    ``__first`` numbers the first whole window of a row, so that all whole windows have numbers of their own.

    Ids are those the tokenizer gives the whole text, then ``end_id``. The tokenizer must ignore the case of A-Z and must
    not let a piece reach across ASCII white space, so that words can be encoded once each and remembered.
    """
    keep = [c for c in docs.columns if c != text_col]
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    content = _read(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(content.value)

        table, row = WordTable(WordEncoder(model)), TaskContext.get().partitionId() << 32
        whole, most = row, max(model.get_vocab_size(), end_id + 1)
        wide = np.dtype("<u2" if most <= 1 << 16 else "<u4")
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                flat, n = table.lookup(words_of(part.column(len(keep))))
                ends = np.cumsum(n)
                flat = np.insert(flat.astype(wide), ends, end_id)
                ends = (ends + np.arange(1, len(ends) + 1)) * wide.itemsize
                offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32).tobytes())
                ids = pa.Array.from_buffers(pa.binary(), len(n), [None, offsets, pa.py_buffer(flat.tobytes())])
                upto = whole + np.cumsum((n + 1) // window)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(row + np.arange(len(n))), pa.array(n + 1), pa.array(upto - (n + 1) // window), ids],
                    [*keep, "__row", "__n", "__first", "__ids"],
                )
                row, whole = row + len(n), int(upto[-1])

    more = "`__row` long, `__n` long, `__first` long, `__ids` binary"
    content = docs.sparkSession.sparkContext.broadcast(content)
    return rows.mapInArrow(run, f"{schema}, {more}" if schema else more)


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _planned(rows: DataFrame, plan: Plan) -> DataFrame:
    """(row, n, sequence, offset) per remainder, with null places for those in no combination."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(plan))  # plain values, as executors lack this module

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(**shared.value)
        for b in batches:
            row, n, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            planned, sequence, offset = plan.places(n, rank)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(n), pa.array(sequence, mask=~planned), pa.array(offset, mask=~planned)],
                ["row", "n", "sequence", "offset"],
            )

    return rows.mapInArrow(run, "row long, n long, sequence long, offset long")


def _laid_out(rest: DataFrame, groups: int, window: int) -> DataFrame:
    """(row, pieces) of documents laid end to end, group by group, and cut where a sequence is full.

    The last sequences of a group are of falling powers of two.
    """
    group = F.pmod(F.xxhash64("row"), F.lit(groups))
    rest = rest.withColumn("group", group)
    whole = Window.partitionBy("group")
    rest = rest.select(
        "row", "n", "group", (F.sum("n").over(whole.orderBy("row")) - F.col("n")).alias("at"), F.sum("n").over(whole).alias("total")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pieces = []
            for n, group, at, total in zip(*(b.column(i).to_pylist() for i in range(1, 5))):
                mine, start = [], 0
                while start < n:
                    place, full = at + start, total // window * window
                    number, begin, size = place // window, place // window * window, window
                    if place >= full:
                        number, begin = total // window, full
                        size = 1 << (total - begin).bit_length() - 1
                        while place >= begin + size:
                            begin, number = begin + size, number + 1
                            size = 1 << (total - begin).bit_length() - 1
                    take = min(n - start, begin + size - place)
                    mine.append({"start": start, "length": take, "sequence_id": group << 32 | number, "offset": place - begin})
                    start += take
                pieces.append(mine)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pieces, _PIECE)], ["row", "pieces"])

    return rest.mapInArrow(run, f"row long, pieces {PIECES}")


_PIECE = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "sequence_id", "offset")]))


def pack(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    window: int = 4096,
    end_id: int = 2,
    with_ids: bool = True,
) -> DataFrame:
    """Every document's tokens in sequences of at most ``window``: one row per piece.

    Columns: the id, start and length (in the document), ids (array, unless ``with_ids`` is false), ids_crc32 (of the ids as
    32-bit little-endian numbers), doc_tokens, sequence_id, offset. Every sequence has ``window`` tokens or a smaller power of
    two and no gaps. A null or empty text has the end id alone. Rows with a null or repeated id are packed as documents of
    their own; other columns are ignored. ``window`` must be a power of two.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tokens = scratch.write(tokenise(named, model_path, "text", end_id, window))
    sizes = tokens.select("__row", "__n", (F.col("__n") % window).alias("rem"))
    hist = np.zeros(window, dtype=np.int64)
    for r in sizes.groupBy("rem").count().collect():  # at most ``window`` rows
        hist[r["rem"]] = r["count"]
    plan = make_plan(hist, window)

    short = sizes.where("rem > 0").select(F.col("__row").alias("row"), "rem")
    ranked = row_sequence(short, ["rem"], ["row"], "rank", chunk=F.shiftright("row", 32))
    placed = scratch.write(_planned(ranked.select("row", "rem", F.col("rank") - 1), plan))
    one = F.struct(
        F.lit(0).cast("long").alias("start"), F.col("n").alias("length"),
        (4 * F.col("sequence") + 1).alias("sequence_id"), "offset",
    )
    fitted = placed.where("sequence is not null").select("row", F.array(one).alias("pieces"))
    groups = -(-int(plan.left.sum()) // GROUP) or 1
    laid = _laid_out(placed.where("sequence is null").select("row", "n"), groups, window)
    laid = laid.select("row", F.transform("pieces", lambda x: x.withField("sequence_id", 4 * x["sequence_id"] + 2)).alias("pieces"))
    both = fitted.union(laid)

    joined = tokens.join(both.hint("shuffle_hash"), F.col("__row") == F.col("row"), "left")
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                out = []
                for i, first, n, ids, pieces in zip(*(part.column(c) for c in range(5))):
                    first, n, raw = first.as_py(), n.as_py(), ids.as_buffer()
                    known = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
                    full = n // window
                    # windows of a long document are sequences of their own, before its remainder
                    mine = [(w * window, window, 4 * (first + w), 0) for w in range(full)]
                    for p in pieces.as_py() or []:
                        mine.append((full * window + p["start"], p["length"], p["sequence_id"], p["offset"]))
                    for start, length, sequence, offset in mine:
                        cut = known[start : start + length]
                        crc = zlib.crc32(cut.tobytes())
                        out.append((i.as_py(), start, length, crc, n, sequence, offset, cut.astype("<i4") if with_ids else None))
                columns = list(zip(*out)) or [()] * 8
                arrays = [pa.array(columns[0], part.column(0).type), *[pa.array(c, pa.int64()) for c in columns[1:7]]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(columns[7], ints)], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = named.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    out = joined.select("doc_id", "__first", "__n", "__ids", "pieces").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
    return out.withColumnRenamed("doc_id", id_col)
