"""Periodic runs of words: stretches that repeat a short pattern, found by multi-scale minimizers.

A run of period q is a stretch in which words q apart are equal, of at least ``times`` periods and ``least`` words, that
neither neighbour extends. Long periods are found scale by scale: in the scale of periods Q to K - 1 (K = 1.5 Q) every
window of Q / 2 + 1 starts proposes its smallest hash of K - 1 words. Inside a run the window a period later proposes
the same, so neighbouring equal minima at a distance from Q to K - 1 are seeds. Periods too short for that are sought
by comparing words at each lag directly, at places so close that no run lies between them. Seeds are extended both
ways by comparing hashes of ever shorter stretches; each run is checked word by word in the end, and where hashes misled
its period is sought anew by direct comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import Numbers

SHORT = 16  # periods below are sought by lag
BATCH = 1 << 22  # bytes of text examined at a time, or one longer text
_ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_ODD[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_ODD[2])
    return x ^ (x >> np.uint64(31))


class Stretches:
    """Equality of stretches of ``words`` by polynomial hashes modulo 2^64."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = words
        self.power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, _ODD[0], np.uint64))), dtype=np.uint64)
        value = _mixed(words.astype(np.uint64) * np.uint64(_ODD[0]))
        self.upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * self.power[:n], dtype=np.uint64)))

    def hashes(self, width: int, n: int) -> np.ndarray:
        """Hash of the ``width`` words from each start, among the first ``n`` words; independent of the start."""
        raw = self.upto[width : n + 1] - self.upto[: n + 1 - width]
        return _mixed(raw * self.power[n - np.arange(n + 1 - width)])

    def reach(self, a: np.ndarray, b: np.ndarray, most: int, back: bool) -> np.ndarray:
        """How many words from ``a`` and ``b`` > a on (or before them) are equal one by one."""
        far = np.zeros(len(a), dtype=np.int64)
        lift, n = self.power[b - a], len(self.words)
        step = 1 << max(0, most.bit_length() - 1)
        while step:
            t = far + step
            fits = a - t >= 0 if back else b + t <= n
            t = np.where(fits, t, 0)
            x, y = (a - t, b - t) if back else (a, b)
            left, right = self.upto[x + t] - self.upto[x], self.upto[y + t] - self.upto[y]
            far = np.where(fits & (left * lift == right), t, far)
            step >>= 1
        return far


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least value of some window of ``width`` places."""
    low, built = x, 1
    while built < width:
        step = min(built, width - built)
        low = np.minimum(low[:-step], low[step:])
        built += step
    edge = np.zeros(width - 1, dtype=x.dtype)
    high, built = np.concatenate((edge, low, edge)), 1
    while built < width:
        step = min(built, width - built)
        high = np.maximum(high[:-step], high[step:])
        built += step
    return np.flatnonzero(high == x)


def _seeds(s: Stretches, sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, lag) pairs of equal words that meet every run; texts stand by falling size, each with one end mark."""
    ends = np.cumsum(sizes + 1)
    words = s.words
    for lag in range(1, SHORT):
        n = int(ends[np.searchsorted(-sizes, -max(least, times * lag), side="right") - 1]) if len(sizes) else 0
        # the equal words of a run are at least so many, so one of them is at a multiple of it
        step = max(least - lag, (times - 1) * lag)
        at = np.arange(0, n - lag, step)
        at = at[words[at] == words[at + lag]]
        yield at, np.full(len(at), lag)
    low = SHORT
    while len(sizes) and times * low <= sizes[0]:
        high = low + low // 2
        n = int(ends[np.searchsorted(-sizes, -max(least, times * low), side="right") - 1])
        grams = s.hashes(high - 1, n)
        if len(grams) > low // 2:
            at = _window_minima(grams, low // 2 + 1)
            at = at[np.argsort(grams[at], kind="stable")]
            apart = np.diff(at)
            use = (grams[at[1:]] == grams[at[:-1]]) & (apart >= low) & (apart < high)
            yield at[:-1][use], apart[use]
        low = high


def find_runs(texts: list[np.ndarray], least: int = 24, times: int = 3) -> list[list[tuple[int, int, int]]]:
    """(start, length, smallest period) of every run of each text, by start and period; texts are word numbers.

    ``times`` is 3 or more: stretches of one place and length with several periods then have the same words, and the
    smallest of their periods counts.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods are not sought")
    order = sorted((i for i, t in enumerate(texts) if len(t) >= least), key=lambda i: -len(texts[i]))
    if not order:
        return [[] for _ in texts]
    sizes = np.array([len(texts[i]) for i in order], dtype=np.int64)
    marks = -1 - np.arange(len(order))  # different, so that nothing reaches across texts
    words = np.concatenate([x for i, m in zip(order, marks) for x in (texts[i], [m])]).astype(np.int64)
    s, found = Stretches(words), []
    for at, lag in _seeds(s, sizes, least, times):
        if len(at):
            before = s.reach(at, at + lag, int(sizes[0]), back=True)
            equal = before + s.reach(at, at + lag, int(sizes[0]), back=False)
            long = equal >= np.maximum(least - lag, (times - 1) * lag)
            found.append(np.stack(((at - before)[long], (equal + lag)[long], lag[long])))
    runs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), dtype=np.int64)
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    if runs.shape[1]:
        new = np.concatenate(([True], (np.diff(runs[0]) != 0) | (np.diff(runs[1]) != 0)))
        runs = runs[:, new]  # the smallest period of each stretch
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.searchsorted(begin, runs[0], side="right") - 1
    exact: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    for k, start, length, period in zip(text.tolist(), *runs.tolist()):
        here = [(start - int(begin[k]), length)]
        if not (words[start : start + length - period] == words[start + period : start + length]).all():
            # different words with one hash: the text's runs of this period are sought word by word
            here = _runs_at(texts[order[k]], period, least, times)
        for place in here:
            exact[order[k]][place] = min(period, exact[order[k]].get(place, period))
    return [sorted(((*at, p) for at, p in e.items()), key=lambda x: (x[0], x[2])) for e in exact]


def _runs_at(words: np.ndarray, period: int, least: int, times: int) -> list[tuple[int, int]]:
    """(start, length) of all runs of one period, by comparing every word."""
    other = np.flatnonzero(words[:-period] != words[period:])
    edges = np.concatenate(([-1], other, [len(words) - period]))
    length = np.diff(edges) - 1 + period
    use = length >= max(least, times * period)
    return list(zip((edges[:-1][use] + 1).tolist(), length[use].tolist()))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay if every run keeps only its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:-1] == 0


def periodic_runs(
    docs: DataFrame,
    text_col: str = "text",
    *,
    least: int = 24,
    times: int = 3,
    runs_col: str = "runs",
    collapsed_col: str = "collapsed",
) -> DataFrame:
    """``docs`` with all runs of each text (by start, then period) and the text with each run's repeats taken out.

    Words are what ASCII white space separates, numbered from 0. A collapsed text has its words joined by one space; a
    word goes if any run holds it after the run's first period. Null, empty and blank texts have no runs and an empty
    collapsed text. Whole texts of any length; rows are independent of each other, repeated rows are treated alike;
    existing columns of the two new names are replaced.
    """
    keep = [c for c in docs.columns if c not in (runs_col, collapsed_col)]
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(t) if t else 0 for t in batch.column(len(keep)).to_pylist()])
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), BATCH, side="right")) + lo)
                part = batch.slice(lo, hi - lo)
                lo = hi
                numbers = Numbers()
                texts = [(t.as_py() or b"").split() for t in part.column(len(keep)).cast(pa.binary())]
                coded = [np.fromiter(map(numbers.__getitem__, t), dtype=np.int64, count=len(t)) for t in texts]
                runs = find_runs(coded, least, times)
                left = [
                    b" ".join(t if not r else [t[i] for i in np.flatnonzero(kept_words(len(t), r))])
                    for t, r in zip(texts, runs)
                ]
                named = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(named, kind), pa.array(left, pa.binary()).cast(pa.string())],
                    [*keep, runs_col, collapsed_col],
                )

    more = f"`{runs_col}` {RUNS}, `{collapsed_col}` string"
    return rows.mapInArrow(run, f"{schema}, {more}" if schema else more)


def strongest_run(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties go to the first; null without runs."""
    return F.aggregate(
        runs, F.try_element_at(runs, F.lit(1)),
        lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best),
    )


def plant_runs(docs: DataFrame, text_col: str, words: Column, mark: Column) -> DataFrame:
    """``docs`` whose rows with ``mark`` (unsigned) divisible by ten repeat a stretch of their words up to the end.

    With g = mark div 10, from word a = g % n on, word i becomes word a + (i - a) % p for
    p = 1 + (n - a) div (3 + g % 8). Other rows, and those without words or with a null mark, are unchanged.
    """
    rows = docs.withColumns({"__w": F.when(mark % 10 == 0, words), "__g": F.floor(mark / 10).cast("long")})
    rows = rows.withColumn("__n", F.size("__w").cast("long"))
    rows = rows.withColumn("__a", F.when(F.col("__n") > 0, F.col("__g") % F.col("__n")))
    rows = rows.withColumn("__p", F.expr("1 + (__n - __a) div (3 + __g % 8)"))
    repeated = F.expr(
        "concat(slice(__w, 1, cast(__a as int)),"
        " transform(sequence(__a, __n - 1), i -> element_at(__w, cast(__a + (i - __a) % __p as int) + 1)))"
    )
    text = F.when(F.col("__a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col(text_col))
    return rows.withColumn(text_col, text).drop("__w", "__g", "__n", "__a", "__p")
