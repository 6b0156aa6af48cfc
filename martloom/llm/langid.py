"""Language identification by unigrams of pieces, summed over all segmentations of each word.

The pieces are a fixed public vocabulary. Each language has a probability per piece, fitted by
expectation maximisation; the probability of a word is the sum over every way to cut it into
pieces, computed by the forward algorithm.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import Scratch, crc_mod

MARK = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
SHORT = 64  # longer words are summed one by one, in logarithms
LIFT = 12.0  # per character, keeps products of short words inside the range of doubles
STRANGE = 1e-5  # probability of a character that is in no piece, the same in all languages
BLOCK = 100_000  # words of a text looked at together
CACHE = 300_000  # words whose scores a task remembers at a time


def read_pieces(path: str) -> list[str]:
    """Ordinary pieces of a SentencePiece model file, in its order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (sp.is_control, sp.is_unknown, sp.is_unused, sp.is_byte)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not any(f(i) for f in special)]


def text_words(text: str | None) -> Iterator[list[str]]:
    """Lower-case letter runs of the whole text, a block at a time."""
    text = (text or "").lower()
    if len(text) < 1 << 20:
        found = LETTERS.findall(text)
        if found:
            yield found
        return
    runs = (m.group() for m in LETTERS.finditer(text))
    while block := list(islice(runs, BLOCK)):
        yield block


class Lattice:
    """Forward sums, and expected piece counts, of words over the pieces.

    ``prob`` has a row per piece and a column per language; two rows follow, one of zeros for
    "no such piece" and one for characters that are in no piece.
    """

    def __init__(self, pieces: list[str], prob: np.ndarray):
        self.number = {p: i for i, p in enumerate(pieces)}
        self.none, self.strange = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)
        self.prob = prob

    @staticmethod
    def table(prob: np.ndarray) -> np.ndarray:
        width = prob.shape[1]
        return np.vstack([prob, np.zeros((1, width)), np.full((1, width), STRANGE)])

    def edges(self, words: list[str]) -> np.ndarray:
        """[word, end - 1, length - 1]: number of the piece; words of equal length, with the mark."""
        n = len(words[0])
        most = min(n, self.longest)
        get, none = self.number.get, self.none
        spans = [(i - k, i) if k <= i else None for i in range(1, n + 1) for k in range(1, most + 1)]
        flat = [none if s is None else get(w[s[0] : s[1]], none) for w in words for s in spans]
        ids = np.array(flat, dtype=np.int32).reshape(len(words), n, most)
        ids[:, :, 0][ids[:, :, 0] == none] = self.strange
        return ids

    def forward(self, ids: np.ndarray) -> np.ndarray:
        """[word, end, language]: sums over all segmentations up to ``end``, lifted."""
        count, n, most = ids.shape
        lift = LIFT ** np.arange(1, most + 1)
        alpha = np.zeros((n + 1, count, self.prob.shape[1]))
        alpha[0] = 1
        for i in range(1, n + 1):
            for k in range(1, min(i, most) + 1):
                alpha[i] += alpha[i - k] * (self.prob[ids[:, i - 1, k - 1]] * lift[k - 1])
        return alpha

    def scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(words), self.prob.shape[1]))
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            by_length[len(w) + 1].append(i)
        for n, at in by_length.items():
            if n > SHORT:
                for i in at:
                    out[i] = self._long(MARK + words[i])
                continue
            for lo in range(0, len(at), 4096):
                part = at[lo : lo + 4096]
                alpha = self.forward(self.edges([MARK + words[i] for i in part]))
                out[part] = np.log(alpha[n]) - n * math.log(LIFT)
        return out

    def _long(self, word: str) -> np.ndarray:
        """The same sum for a word of any length, rescaled at each step."""
        recent = [np.ones(self.prob.shape[1])]  # scaled sums of the last positions
        log_scale = np.zeros(self.prob.shape[1])
        for i in range(1, len(word) + 1):
            total = np.zeros_like(log_scale)
            for k in range(1, min(i, self.longest) + 1):
                p = self.number.get(word[i - k : i], self.none)
                if p == self.none and k == 1:
                    p = self.strange
                total += recent[-k] * self.prob[p]
            recent = [r / total for r in recent[-self.longest :]] + [np.ones_like(total)]
            log_scale += np.log(total)
        return log_scale

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in the words, for one language (one column of ``prob``)."""
        uses = np.zeros(len(self.prob))
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            if len(w) < SHORT:
                by_length[len(w) + 1].append(i)
            else:
                self._expected_long(MARK + w, counts[i], uses)
        for n, at in by_length.items():
            for lo in range(0, len(at), 4096):
                part = at[lo : lo + 4096]
                ids = self.edges([MARK + words[i] for i in part])
                most = ids.shape[2]
                lift = LIFT ** np.arange(1, most + 1)
                alpha = self.forward(ids)[:, :, 0]
                beta = np.zeros_like(alpha)
                beta[n] = counts[part] / alpha[n]
                for i in range(n, 0, -1):
                    for k in range(1, min(i, most) + 1):
                        edge = ids[:, i - 1, k - 1]
                        back = self.prob[edge, 0] * lift[k - 1] * beta[i]
                        uses += np.bincount(edge, alpha[i - k] * back, minlength=len(uses))
                        beta[i - k] += back
        return uses


    def _edges_to(self, word: str, i: int) -> Iterator[tuple[int, int, float]]:
        """(start, piece, log probability) of the pieces that end at place ``i`` of a word, for one language."""
        for k in range(1, min(i, self.longest) + 1):
            p = self.number.get(word[i - k : i], self.none)
            if p == self.none and k == 1:
                p = self.strange
            if self.prob[p, 0] > 0:
                yield i - k, p, math.log(self.prob[p, 0])

    def _expected_long(self, word: str, count: float, uses: np.ndarray) -> None:
        """Add the expected uses in a word of any length, by sums of logarithms."""
        n = len(word)
        ahead, back = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        ahead[0] = back[n] = 0.0
        for i in range(1, n + 1):
            for start, _, cost in self._edges_to(word, i):
                ahead[i] = np.logaddexp(ahead[i], ahead[start] + cost)
        for i in range(n, 0, -1):
            for start, p, cost in self._edges_to(word, i):
                uses[p] += count * math.exp(ahead[start] + cost + back[i] - ahead[n])
                back[start] = np.logaddexp(back[start], back[i] + cost)


def _word_counts(sample: DataFrame) -> DataFrame:
    """(lang, word, n) over the sampled texts; each task counts before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                for block in text_words(text):
                    seen[lang].update(block)
            for lang, c in seen.items():
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang] * len(c), "word": list(c), "n": list(c.values())}
                )

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    rows_per_lang: int = 4000,
    rounds: int = 4,
    smoothing: float = 0.01,
) -> tuple[list[str], np.ndarray]:
    """(languages in order, probability per piece and language), learnt from training rows.

    Training rows have a language and crc32 of the id's text mod 4 other than 2. Of each language about
    ``rows_per_lang`` of them are used, chosen by a hash of the id; all words of those
    count. What reaches the driver is one sum per piece and language.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "langid")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    rows = rows.where("id is not null and lang is not null").where(crc_mod(F.col("id"), 4) != 2)
    share = rows.groupBy("lang").agg((F.lit(rows_per_lang) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    sample = rows.join(share, "lang").where(draw < F.col("share"))
    counts = scratch.write(_word_counts(sample))
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    pieces = read_pieces(model_path)
    prob = np.full((len(pieces), len(langs)), 1 / max(1, len(pieces)))
    shared_pieces = spark.sparkContext.broadcast(pieces)
    column = {lang: i for i, lang in enumerate(langs)}
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast(Lattice.table(prob))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, total = shared.value, {}
            lattices = {}
            for b in batches:
                words = np.array(b.column("word").to_pylist(), dtype=object)
                n = b.column("n").to_numpy()
                which = np.array([column[x] for x in b.column("lang").to_pylist()])
                for g in np.unique(which).tolist():
                    if g not in lattices:
                        lattices[g] = Lattice(shared_pieces.value, table[:, g : g + 1])
                    mine = which == g
                    uses = lattices[g].expected(words[mine].tolist(), n[mine].astype(float))
                    total[g] = total.get(g, 0) + uses
            for g, uses in total.items():
                used = np.nonzero(uses)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), g)), pa.array(used), pa.array(uses[used])], ["g", "piece", "uses"]
                )

        uses = counts.mapInArrow(run, "g long, piece long, uses double")
        table = np.zeros((len(pieces) + 2, len(langs)))
        for r in uses.groupBy("g", "piece").agg(F.sum("uses").alias("uses")).collect():
            table[r["piece"], r["g"]] = r["uses"]
        prob = table[: len(pieces)] + smoothing
        prob /= prob.sum(axis=0)
    return langs, prob


def predict_language(
    docs: DataFrame,
    model: tuple[list[str], np.ndarray],
    model_path: str,
    text_col: str = "text",
    *,
    lang_col: str = "lang_pred",
    score_col: str = "score",
) -> DataFrame:
    """``docs`` with the likeliest language of each whole text and its posterior probability.

    Languages are equally likely beforehand; a tie goes to the first by name. A text that is null or
    has no letter is "und" with score 0, as is every text if no language was learnt. Nothing
    but the text is looked at; existing columns of the two names are replaced.
    """
    langs, prob = model
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((read_pieces(model_path), Lattice.table(prob)))
    keep = [c for c in docs.columns if c not in (lang_col, score_col)]
    rows = docs.select(*keep)
    at = keep.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        place: defaultdict = defaultdict()
        place.default_factory = place.__len__
        known = np.zeros((0, len(langs)))
        for b in batches:
            best, score = [], []
            # a group of texts at a time, so that their new words are summed together
            for lo in range(0, b.num_rows, 256):
                if len(place) > CACHE:
                    place.clear()
                    known = known[:0]
                found = []
                for text in b.column(at).slice(lo, 256).to_pylist():
                    blocks = text_words(text)
                    found.append(
                        [np.fromiter(map(place.__getitem__, w), np.int64, len(w)) for w in blocks]
                    )
                if langs and len(place) > len(known):
                    new = list(islice(place, len(known), None))
                    known = np.vstack([known, lattice.scores(new)])
                for blocks in found:
                    if not blocks or not langs:
                        best.append(UNDETERMINED)
                        score.append(0.0)
                        continue
                    total = sum(known[x].sum(axis=0) for x in blocks)
                    win = int(total.argmax())
                    best.append(langs[win])
                    score.append(float(1 / np.exp(total - total[win]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())],
                [*keep, lang_col, score_col],
            )

    return rows.mapInArrow(run, f"{schema}, `{lang_col}` string, `{score_col}` double")
