"""Exact removal of repeated byte strings, by refining buckets of q-grams at sampled suffixes.

Suffixes are sampled so that equal strings of ``length`` bytes sample the same places: the smallest
32-gram identifier in each window of ``length`` bytes, leftmost first, is its anchor. Neighbouring windows
with one anchor form a unit. The anchors' 32-grams are the initial buckets; each pass over the texts
refines the buckets that still have several members with the identifiers of longer strings
around the anchor, made from those of shorter ones:

1. 32-grams: a unit alone in its bucket is settled, none of its windows repeats;
2. whole units: a unit that equals an earlier one is settled, all of its windows repeat;
3. the common part of eight offset classes of each first unit: a class alone in its bucket is settled;
4. single windows of the classes that are left.

What a pass has settled goes to the next one as a bit map of bounded size. A map may let a few more
pass than it should; these are refined further for nothing and come out right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import Scratch

Q = 32  # bytes of an initial bucket
CLASSES = 8  # of offsets of the anchor in a window
BLOCK = 1 << 16  # window starts looked at together
FLUSH = 200_000  # windows and spans that a task holds at a time
NO_ID = (1 << 63) - 1  # stands for a null id: after all others


def _table() -> np.ndarray:
    """One odd 64-bit number per byte value, from a fixed hash."""
    digests = [xxhash.xxh64_intdigest(bytes([b]), 7) | 1 for b in range(256)]
    return np.array(digests, dtype=np.uint64)


def _grams(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Identifiers of all 32-grams: those of 2k-grams are made from two of k-grams."""
    with np.errstate(over="ignore"):
        ids, k, factor = table[data], 1, np.uint64(0x9E3779B97F4A7C15)
        while k < Q:
            ids = ids[:-k] * factor + ids[k:]
            factor = factor * factor
            k *= 2
        ids ^= ids >> np.uint64(31)
        ids *= np.uint64(0xD6E8FEB86659FD93)
        ids ^= ids >> np.uint64(32)
        return ids


def _window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys."""
    k = 1
    while 2 * k <= width:
        keys = np.minimum(keys[:-k], keys[k:])
        k *= 2
    return np.minimum(keys[: len(keys) - (width - k)], keys[width - k :]) if width > k else keys


class Runs:
    """Units of a buffer: consecutive windows (starts lo..hi) whose anchor is at ``p``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, length: int, table: np.ndarray):
        parts: dict[str, list] = {k: [] for k in ("p", "lo", "hi", "gram")}
        begin, end = int(bounds[0]), int(bounds[-1])
        width, place = length - Q + 1, np.uint64(20)
        for s0 in range(begin, end - length + 1, BLOCK):
            s1 = min(s0 + BLOCK, end - length + 1)
            grams = _grams(data[s0 : s1 + length - 1], table)
            keys = (grams >> place << place) | np.arange(len(grams), dtype=np.uint64)
            anchor = (_window_min(keys, width) & np.uint64((1 << 20) - 1)).astype(np.int64)
            # a window must end in the text in which it starts
            inside = np.ones(len(anchor), dtype=bool)
            first = int(np.searchsorted(bounds, s0, side="right"))
            last = int(np.searchsorted(bounds, s1 + length, side="left"))
            for e in bounds[first : last + 1].tolist():
                inside[max(0, e - length + 1 - s0) : max(0, e - s0)] = False
            new = np.ones(len(anchor), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
            at = np.nonzero(new)[0]
            stop = np.append(at[1:], len(anchor)) - 1
            keep = inside[at]
            at, stop = at[keep], stop[keep]
            p = anchor[at]
            parts["p"].append(p + s0)
            parts["lo"].append(at + s0)
            parts["hi"].append(stop + s0)
            parts["gram"].append(grams[p])
        for name, found in parts.items():
            kind = np.uint64 if name == "gram" else np.int64
            setattr(self, name, np.concatenate(found) if found else np.zeros(0, dtype=kind))
        self.text = np.searchsorted(bounds, self.lo, side="right") - 1


def _batches(batches: Iterator[pa.RecordBatch], length: int):
    """(batch, bytes, starts of the texts, units) of each batch of (id, h, text)."""
    table = _table()
    for b in batches:
        texts = b.column("text").cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset :][: len(texts) + 1]
        raw = texts.buffers()[2]
        if len(texts) and raw is not None and raw.size:
            data = np.frombuffer(raw, dtype=np.uint8)
            yield b, memoryview(raw), bounds[:-1], Runs(data, bounds, length, table)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


class Marks:
    """A set of 64-bit hashes as a bit map of their low bits: no member is missed, few others pass.

    The high bits would not do, as anchors are chosen for small hashes.
    """

    def __init__(self, bits: int, words: np.ndarray):
        self.mask, self.words = (1 << bits) - 1, words

    def __contains__(self, value: int) -> bool:
        at = value & self.mask
        return bool(int(self.words[at >> 6]) >> (at & 63) & 1)

    def test(self, values: np.ndarray) -> np.ndarray:
        at = values & np.uint64(self.mask)
        word = self.words[(at >> np.uint64(6)).astype(np.int64)]
        return (word >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def mark(hashes: DataFrame, most_bits: int) -> tuple[int, np.ndarray]:
    """Bits and words of a bit map of the ``h`` column, about 16 bits for each hash, at most 2 ** most_bits in all.

    Only the map reaches the driver: at most 2 ** most_bits / 8 bytes, whatever the data. Where that is
    too small the map lets more pass, which costs time and changes no result.
    """
    bits = min(most_bits, max(12, (16 * hashes.count()).bit_length()))
    spot = F.col("h").bitwiseAND((1 << bits) - 1)
    lit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    words = hashes.groupBy(F.shiftright(spot, 6).alias("at")).agg(F.bit_or(lit).alias("word"))
    out = np.zeros(max(1, (1 << bits) // 64), dtype=np.uint64)
    found = words.toArrow()
    out[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return bits, out


def _place_hash(id_hash: int, at: int) -> int:
    """Spark's xxhash64(id, at), given that of the id."""
    return xxhash.xxh64_intdigest(at.to_bytes(8, "little"), id_hash)


def _id_hashes(ids: pa.Array) -> list[int]:
    return [xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42) for i in ids.to_pylist()]


def _merged(spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(text, start, stop) spans in order of place, joined where they touch."""
    text = start = stop = -1
    for t, a, z in spans:
        if t == text and a <= stop:
            stop = max(stop, z)
            continue
        if text >= 0:
            yield text, start, stop
        text, start, stop = t, a, z
    if text >= 0:
        yield text, start, stop


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int, most_bits: int) -> DataFrame:
    """(id, h, start, stop) byte spans covered by windows that also start earlier.

    ``docs`` has (id long, h, text): h is a hash of the text, so that repeated ids do not mix.
    """
    sc = docs.sparkSession.sparkContext
    texts = docs.where(F.octet_length("text") >= length)
    wide = (length - 1 - Q) // CLASSES + 1  # offsets of the anchor in a class
    core = length - wide + 1  # bytes that all windows of a class share

    def gram_pass(batches):
        for _, _, _, runs in _batches(batches, length):
            grams, n = np.unique(runs.gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(grams), pa.array(n)], ["h", "n"])

    grams = texts.mapInArrow(gram_pass, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    repeated = sc.broadcast(mark(scratch.write(grams.where("n > 1").select("h")), most_bits))

    def unit_pass(batches):
        digest, low = xxhash.xxh3_128_intdigest, (1 << 64) - 1
        for b, raw, starts, runs in _batches(batches, length):
            at = np.nonzero(Marks(*repeated.value).test(runs.gram))[0]
            lo, lead = runs.lo[at], (runs.p - runs.lo)[at].tolist()
            spans = zip(lo.tolist(), (runs.hi[at] + length).tolist(), lead)
            whole = [digest(raw[s:e], k) for s, e, k in spans]
            text = runs.text[at]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(np.array([u >> 64 for u in whole], dtype=np.uint64)),
                    _signed(np.array([u & low for u in whole], dtype=np.uint64)),
                    b.column("id").take(pa.array(text)), pa.array(lo - starts[text]),
                ],
                ["u1", "u2", "id", "lo"],
            )

    units = texts.mapInArrow(unit_pass, "u1 long, u2 long, id long, lo long")
    firsts = units.groupBy("u1", "u2").agg(F.min(F.struct("id", "lo")).alias("f"))
    firsts = firsts.select(F.xxhash64("f.id", "f.lo").alias("h"))
    first_units = sc.broadcast(mark(scratch.write(firsts), most_bits))

    def left_over(runs, starts, ids):
        """(unit, is it first) of the units in crowded 32-gram buckets."""
        first, hashes = Marks(*first_units.value), _id_hashes(ids)
        for i in np.nonzero(Marks(*repeated.value).test(runs.gram))[0].tolist():
            t = int(runs.text[i])
            yield i, t, _place_hash(hashes[t], int(runs.lo[i] - starts[t])) in first

    def cores(raw, p, lo, hi):
        """(identifier, first and last window start) of a unit's offset classes."""
        for k in range((p - hi) // wide, (p - lo) // wide + 1):
            s = p - wide * k
            yield xxhash.xxh3_64_intdigest(raw[s : s + core], k), max(lo, s - wide + 1), min(hi, s)

    def class_pass(batches):
        for b, raw, starts, runs in _batches(batches, length):
            found = []
            for i, _, first in left_over(runs, starts, b.column("id")):
                if first:
                    found.extend(c for c, _, _ in cores(raw, int(runs.p[i]), int(runs.lo[i]), int(runs.hi[i])))
            keys, n = np.unique(np.array(found, dtype=np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(keys), pa.array(n)], ["h", "n"])

    classes = texts.mapInArrow(class_pass, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    crowded = sc.broadcast(mark(scratch.write(classes.where("n > 1").select("h")), most_bits))

    def window_pass(batches):
        """Spans known to repeat (sure), and the windows still to be compared.

        Of equal windows in one batch only the earliest goes on, the others repeat for sure. So
        a window that very many texts share costs one row per batch.
        """
        for b, raw, starts, runs in _batches(batches, length):
            marks, ids = Marks(*crowded.value), b.column("id").to_pylist()
            seen: dict[int, tuple] = {}
            sure: list[tuple[int, int, int]] = []
            same: list[tuple[int, tuple]] = []

            def rows(b=b, ids=ids):
                low = (1 << 64) - 1
                spans = list(_merged(sorted(sure)))
                keys = [*seen, *[w for w, _ in same]]
                places = [*seen.values(), *[x for _, x in same]]
                text = pa.array([t for t, _, _ in spans] + [t for _, _, t in places], pa.int64())
                start = [a for _, a, _ in spans] + [s for _, s, _ in places]
                stop = [z for _, _, z in spans] + [s + length for _, s, _ in places]
                w1 = [ids[t] & low for t, _, _ in spans] + [w >> 64 for w in keys]
                w2 = [a for _, a, _ in spans] + [w & low for w in keys]
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array([True] * len(spans) + [False] * len(keys), pa.bool_()),
                        _signed(np.array(w1, dtype=np.uint64)), _signed(np.array(w2, dtype=np.uint64)),
                        b.column("id").take(text), b.column("h").take(text),
                        pa.array(start, pa.int64()), pa.array(stop, pa.int64()),
                    ],
                    ["sure", "w1", "w2", "id", "h", "start", "stop"],
                )

            for i, t, first in left_over(runs, starts, b.column("id")):
                base, p, lo, hi = int(starts[t]), int(runs.p[i]), int(runs.lo[i]), int(runs.hi[i])
                if not first:
                    sure.append((t, lo - base, hi + length - base))
                    continue
                for c, a, z in cores(raw, p, lo, hi):
                    if c not in marks:
                        continue
                    for s in range(a, z + 1):
                        w = xxhash.xxh3_128_intdigest(raw[s : s + length])
                        here = (ids[t], s - base, t)
                        known = seen.setdefault(w, here)
                        if known[:2] == here[:2]:
                            if known is not here:  # a row with the same id and text
                                same.append((w, here))
                            continue
                        late = max(known, here)
                        seen[w] = min(known, here)
                        sure.append((late[2], late[1], late[1] + length))
                if len(seen) + len(sure) > FLUSH:
                    yield rows()
                    seen.clear(), sure.clear(), same.clear()
            yield rows()

    kinds = "sure boolean, w1 long, w2 long, id long, h long, start long, stop long"
    windows = texts.mapInArrow(window_pass, kinds)
    # ties are one place, named by an id twice: neither is earlier
    order = Window.partitionBy("sure", "w1", "w2").orderBy("id", "start")
    late = windows.withColumn("r", F.rank().over(order)).where("sure or r > 1")
    return late.select("id", "h", "start", "stop")


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 100, most_bits: int = 28, with_kept: bool = True
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row, ``kept`` the bytes that stay.

    ``with_kept=False`` leaves the last column null.

    Removed is each byte covered by a string of ``length`` bytes that also starts earlier: in a row
    with a smaller id, or in the same row further left. Strings are judged on the input. Whole
    texts as UTF-8; a null text is empty. Ids are whole numbers; rows with a null id come after all
    others and are one place in that order. Rows that repeat an id count as the same document:
    a string at the same place of both is not earlier in either. ``length`` is 64 or more.
    ``most_bits`` bounds the broadcast bit maps (2 ** 28 bits are 32 MB); beyond about 2 ** 24
    repeated q-grams more bits save work, with fewer the result is the same.
    """
    if length < 2 * Q:
        raise ValueError("length must be at least 64 bytes")
    scratch = Scratch(docs.sparkSession, "substrings")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("real"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("h"), text.alias("text"),
    )
    spans = repeated_spans(rows.select("id", "h", "text"), scratch, length, most_bits)
    spans = spans.groupBy(F.col("id").alias("i"), F.col("h").alias("g")).agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")
    )
    spans = spans.select("i", "g", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))
    # the spans are the small side: texts are neither sorted nor held
    joined = rows.join(spans.hint("shuffle_hash"), (F.col("id") == F.col("i")) & (F.col("h") == F.col("g")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, starts, stops in zip(b.column("text").cast(pa.binary()), b.column("starts"), b.column("stops")):
                data = text.as_py()
                if not starts.is_valid:
                    out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data))
                    continue
                step = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(step, starts.values.to_numpy(), 1)
                np.add.at(step, stops.values.to_numpy(), -1)
                gone = np.cumsum(step)[:-1] > 0
                kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                out.append((len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
            n, removed, runs, sha, kept = zip(*out) if out else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("real"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()), pa.array(sha, pa.string()),
                    pa.array(kept if with_kept else [None] * len(kept), pa.binary()),
                ],
                ["real", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    kinds = "real long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    out = joined.select("real", "text", "starts", "stops").mapInArrow(cut, kinds)
    return out.withColumnRenamed("real", id_col)
