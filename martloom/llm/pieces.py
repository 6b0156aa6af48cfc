"""SentencePiece unigram encoding and decoding over a public vocabulary file.

The pieces and their log scores come from a fixed ``.model`` file; nothing is trained. The best
segmentation is found by Viterbi over a double-array trie of the pieces' characters.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from martloom.llm.common import WordTable, end_to_end, flat_slices

MARK = "▁"  # stands for a space
LONG = 64  # characters from which a word is solved on its own
TOGETHER = 1 << 13  # words solved side by side
MOST_IDS = 1_000_000  # words and their ids that a task remembers
ROWS = 256  # texts encoded at once


class DoubleArray:
    """Trie in two arrays: from state s, character code c leads to t = base[s] + c if check[t] == s.

    Characters are numbered by frequency in the pieces, from 1. ``value[s]`` is the id of the piece
    that ends in s, else -1.
    """

    def __init__(self, pieces: dict[str, int]):
        often: dict[str, int] = {}
        for piece in pieces:
            for ch in piece:
                often[ch] = often.get(ch, 0) + 1
        self.code = {ch: i for i, ch in enumerate(sorted(often, key=lambda c: (-often[c], c)), 1)}
        tree: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for piece, number in pieces.items():
            node = 0
            for ch in piece:
                node = tree[node].setdefault(self.code[ch], len(tree))
                if node == len(tree):
                    tree.append({})
            ends[node] = number
        room = len(self.code) + 2  # beyond any start, so that no index is out of range
        base, check, value = ([x] * (len(tree) + room) for x in (0, -1, -1))
        at = {0: 0}  # tree node to state
        check[0] = 0
        seek, queue = 2, [0]
        for node in queue:
            codes = sorted(tree[node])
            if not codes:
                continue
            while check[seek] >= 0:
                seek += 1
            start = first = max(1, seek - codes[0])
            while any(check[start + c] >= 0 for c in codes):
                start += 1
                if start + room > len(check):
                    for part, x in ((base, 0), (check, -1), (value, -1)):
                        part.extend([x] * len(tree))
            if start - first > 50:  # the part before is crowded: a few places there stay empty
                seek = max(seek, start + codes[0])
            if start + 2 * room > len(check):
                for part, x in ((base, 0), (check, -1), (value, -1)):
                    part.extend([x] * (2 * room))
            state = at[node]
            base[state] = start
            for c in codes:
                child = tree[node][c]
                at[child] = start + c
                check[start + c] = state
                value[start + c] = ends.get(child, -1)
                queue.append(child)
        # four bytes a number; lists of Python numbers take ten times as much in every task
        self.base, self.check, self.value = (array("i", x) for x in (base, check, value))


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.scores = [sp.get_score(i) for i in range(n)]
        self.byte_id = [-1] * 256
        normal, self.raw = {}, []
        for i, piece in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                normal[piece] = i
                self.raw.append(piece.encode())
        if min(self.byte_id) < 0:
            raise ValueError("the vocabulary has no byte pieces to fall back on")
        self.trie = DoubleArray(normal)
        # Where no piece has a mark after another character, no path crosses the start of a run of marks.
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p in normal)

    def plain(self) -> dict:
        """What executors need, as plain values that travel without this module."""
        own = {k: getattr(self, k) for k in ("scores", "byte_id", "raw", "by_word")}
        return own | {"trie": vars(self.trie)}

    @classmethod
    def of(cls, plain: dict) -> Vocabulary:
        out, out_trie = cls.__new__(cls), DoubleArray.__new__(DoubleArray)
        vars(out_trie).update(plain["trie"])
        vars(out).update(plain | {"trie": out_trie})
        return out

    def best(self, text: str) -> tuple[list[int], float]:
        """Ids of the best segmentation and its score; in a tie the longer last piece wins.

        A character that is no piece itself may fall back to the pieces of its UTF-8 bytes.
        A path with fewer such characters is always better, whatever its score.
        """
        trie, scores = self.trie, self.scores
        base, check, value, code = trie.base, trie.check, trie.value, trie.code
        codes = [code.get(ch, 0) for ch in text]
        n = len(codes)
        # fewest fallback characters first, then the highest score
        gap = [n + 1] * (n + 1)
        score = [0.0] * (n + 1)
        back = [(-1, -1)] * (n + 1)
        gap[0] = 0
        for i in range(n):
            single, g, s, state, end = False, gap[i], score[i], 0, i
            # follow the trie from i; code 0 is in no piece
            while end < n and codes[end]:
                t = base[state] + codes[end]
                if check[t] != state:
                    break
                state = t
                end += 1
                number = value[t]
                if number >= 0:
                    single = single or end == i + 1
                    total = s + scores[number]
                    if g < gap[end] or g == gap[end] and (back[end][0] < 0 or total > score[end]):
                        gap[end], score[end], back[end] = g, total, (i, number)
            if not single and g + 1 < gap[i + 1]:
                gap[i + 1], score[i + 1], back[i + 1] = g + 1, s, (i, -1)
        out: list[int] = []
        at = n
        while at:
            start, number = back[at]
            if number >= 0:
                out.append(number)
            else:
                out.extend(self.byte_id[b] for b in reversed(text[start:at].encode()))
            at = start
        return out[::-1], score[n]


class Batch:
    """Viterbi for many words side by side, place by place; gives what ``Vocabulary.best`` gives for each."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        trie = vocabulary.trie
        self.base, self.check, self.value = (np.frombuffer(x, dtype=np.int32) for x in (trie.base, trie.check, trie.value))
        self.scores = np.array(vocabulary.scores)
        self.code = np.zeros(0x110000, dtype=np.int32)
        for ch, number in trie.code.items():
            self.code[ord(ch)] = number

    def best(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each."""
        out: list = [None] * len(words)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] <= LONG]
        for lo in range(0, len(order), TOGETHER):
            some = order[lo : lo + TOGETHER]
            self._together([words[i] for i in some], sizes[some], some, out)
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = self.v.best(words[i])[0]
        return end_to_end(out)

    def _together(self, words: list[str], sizes: np.ndarray, places: np.ndarray, out: list) -> None:
        """Fill ``out`` at ``places``, but for words with characters that are no pieces; ``sizes`` rises."""
        n, width = len(words), int(sizes[-1])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = np.zeros((n, width + 1), dtype=np.int32)
        codes[np.arange(width + 1) < sizes[:, None]] = self.code[chars]
        gap = np.full((n, width + 1), width + 1, dtype=np.int32)
        score = np.zeros((n, width + 1))
        back = np.full((n, width + 1), -1, dtype=np.int32)
        piece = np.full((n, width + 1), -1, dtype=np.int32)
        gap[:, 0] = 0
        for i in range(width):
            rows = np.arange(np.searchsorted(sizes, i, side="right"), n)  # words that have a place i
            single, state, end, mine = np.zeros(n, dtype=bool), np.zeros(len(rows), dtype=np.int32), i, rows
            while True:
                c = codes[mine, end]
                t = self.base[state] + c
                on = (c > 0) & (self.check[t] == state)
                mine, state = mine[on], t[on]
                if not len(mine):
                    break
                end += 1
                number = self.value[state]
                has = number >= 0
                r, number = mine[has], number[has]
                if end == i + 1:
                    single[r] = True
                total, g = score[r, i] + self.scores[number], gap[r, i]
                better = (g < gap[r, end]) | (g == gap[r, end]) & ((back[r, end] < 0) | (total > score[r, end]))
                r = r[better]
                gap[r, end], score[r, end], back[r, end], piece[r, end] = g[better], total[better], i, number[better]
            r = rows[~single[rows]]
            r = r[gap[r, i] + 1 < gap[r, i + 1]]
            gap[r, i + 1], score[r, i + 1], back[r, i + 1], piece[r, i + 1] = gap[r, i] + 1, score[r, i], i, -1
        rows = np.flatnonzero(gap[np.arange(n), sizes] == 0)
        at, steps = sizes[rows], []
        while at.any():
            step = np.where(at > 0, piece[rows, at], -1)
            steps.append(step)
            at = np.where(at > 0, back[rows, at], 0)
        if steps:
            found = np.stack(steps[::-1], axis=1)
            use = found >= 0
            for i, ids in zip(places[rows].tolist(), np.split(found[use], np.cumsum(use.sum(axis=1))[:-1])):
                out[i] = ids.tolist()


class Codec:
    """Encodes and decodes texts; remembers the pieces of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        # No path crosses these boundaries, so segments can be solved one by one: a run of marks begins
        # a segment, and a line break that is in no piece is one of its own.
        self.lines = vocabulary.by_word and "\n" not in vocabulary.trie.code
        if self.lines:
            self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
        else:
            self.cut = re.compile(f"(?s){MARK}+[^{MARK}]*|[^{MARK}]+" if vocabulary.by_word else "(?s).+")
        self.table = WordTable(self._encode, MOST_IDS)
        self.batch = Batch(vocabulary)
        self.blob = np.frombuffer(b"".join(vocabulary.raw), dtype=np.uint8)
        self.length = np.array([len(r) for r in vocabulary.raw], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.is_byte = np.zeros(len(vocabulary.raw), dtype=bool)
        self.is_byte[vocabulary.byte_id] = True

    def _encode(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.batch.best([k[1:] if k[:1] == "\n" else MARK + k for k in keys])

    def _keys(self, text: str) -> str:
        """The text's segments, with spaces between: without its first mark, or else with a line break before it."""
        segments = self.cut.findall(MARK + text.replace(" ", MARK))
        return " ".join(s[1:] if s[0] == MARK else "\n" + s for s in segments)

    def segments(self, texts: pa.Array) -> pa.ListArray:
        """Keys (see ``_keys``) of texts that are not null; those without runs of spaces are cut all at once."""
        if self.lines:
            odd = pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " "))
            odd = pc.or_(odd, pc.match_substring(texts, MARK))
            cut = pc.replace_substring(texts, "\n", " \n\n \n")
        else:
            odd, cut = pa.array(np.ones(len(texts), dtype=bool)), texts
        if pc.any(odd).as_py():
            slow = pa.array([self._keys(t) for t in texts.filter(odd).to_pylist()], pa.string())
            cut = pc.replace_with_mask(cut, odd, slow)
        # a line break and nothing else stands for no segment
        return pc.split_pattern(pc.if_else(pc.equal(texts, ""), "\n", cut), " ")

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each; no text may be null.

        A space is put before each text; an empty one has no ids.
        """
        return self.table.lookup(self.segments(texts))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many(pa.array([text], pa.string()))[0].astype(np.int32)

    def raw_many(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Bytes of each text: marks become spaces, the first one goes."""
        raw = flat_slices(self.blob, self.start[ids], self.length[ids]).tobytes()
        ends = np.concatenate(([0], np.cumsum(self.length[ids])))[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        texts = (raw[a:b].replace(MARK.encode(), b" ") for a, b in zip(ends, ends[1:]))
        return [t[1:] if t[:1] == b" " else t for t in texts]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids: marks become spaces, the first one goes; broken UTF-8 is replaced."""
        return self.raw_many(ids, np.array([len(ids)]))[0].decode("utf-8", "replace")


def _codec(broadcast) -> Codec:
    """One codec per task, from the broadcast vocabulary."""
    return Codec(Vocabulary.of(broadcast.value))


def encode_texts(
    docs: DataFrame, model_path: str, text_col: str = "text", *, prefix: str = "sp_"
) -> DataFrame:
    """``docs`` with ``sp_ids`` (array<int>), ``sp_n``, ``sp_bytes``, ``sp_digest`` and ``sp_exact``.

    sp_n counts the ids, sp_bytes those that fall back to single bytes, sp_digest is the
    SHA-256 of the ids as 32-bit little-endian numbers, and sp_exact tells whether the decoded ids
    give the text back (they do unless it holds the whitespace marker itself, which comes
    back as a space). A null text has null in all five, an empty one no ids. Whole texts of any length: they are cut where no piece can cross, and
    each part is solved exactly. Rows are independent of each other; existing columns with the
    names of the new ones are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path).plain())
    new = {"ids": "array<int>", "n": "long", "bytes": "long", "digest": "string", "exact": "boolean"}
    keep = [c for c in docs.columns if c not in {prefix + k for k in new}]
    at = keep.index(text_col)
    rows = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    schema += "".join(f", `{prefix}{k}` {kind}" for k, kind in new.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            # few rows at a time: the ids of long texts take more room than the texts
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                texts = part.column(at).cast(pa.string())
                known = texts.is_valid().to_numpy(zero_copy_only=False)
                plain = texts.drop_null()
                ids, sizes = codec.encode_many(plain)
                back = codec.raw_many(ids, sizes)
                exact = [t == b for t, b in zip(plain.cast(pa.binary()).to_pylist(), back)]
                ends = np.cumsum(sizes)
                raw = memoryview(ids.astype("<i4").tobytes())
                digest = [hashlib.sha256(raw[4 * (e - n) : 4 * e]).hexdigest() for e, n in zip(ends.tolist(), sizes.tolist())]
                fell = np.diff(np.concatenate(([0], np.cumsum(codec.is_byte[ids])))[np.concatenate(([0], ends))])
                # back to all rows, null where the text is
                place = pa.array(np.cumsum(known) - 1, mask=~known)
                offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                made = [lists, pa.array(sizes), pa.array(fell), pa.array(digest, pa.string()), pa.array(exact, pa.bool_())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(x.take(place) for x in made)], [*keep, *[prefix + k for k in new]]
                )

    return rows.mapInArrow(run, schema)


def decode_ids(
    encoded: DataFrame, model_path: str, ids_col: str = "sp_ids", out_col: str = "sp_text"
) -> DataFrame:
    """``encoded`` with the text of its ids; null for null ids, empty for none.

    Equals the encoded text unless that held the whitespace marker itself, which comes back
    as a space. Ids outside of the vocabulary, and null ids within a list, raise.
    """
    model = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model_path).plain())
    rows = encoded.select(*[c for c in encoded.columns if c != out_col])
    names = rows.columns
    at = names.index(ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            lists = batch.column(at)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            known = lists.is_valid().to_pylist()
            texts = [
                codec.decode(flat[ends[i] : ends[i + 1]]) if known[i] else None
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*names, out_col]
            )

    return rows.mapInArrow(run, f"{schema}, `{out_col}` string")
