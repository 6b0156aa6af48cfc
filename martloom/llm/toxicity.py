"""Toxicity by weak supervision: many noisy voters, a generative label model, a linear classifier.

1. A bounded sample of labelled training rows is drawn. Words and word beginnings that are much
   commoner in its toxic texts become disjoint families by their first letters; with fixed lexicons and patterns
   they are the voters. The annotators' label is one more voter, trusted no more than the others.
2. A generative model of the votes estimates by expectation maximisation how often each
   voter is right for either class and how voters correlate given the class; the correlations set each
   voter's share. It gives each sampled row a posterior.
3. A logistic regression over the lexicon hits is fitted (Spark ML) to the posteriors and
   scores every whole text. A feature counts at most ``MOST`` times in a text.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import Scratch, crc_mod

LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7)
CACHE = 300_000  # tokens whose features a task remembers at a time
MOST = 3  # hits of one feature that count
STRONG = 8  # a feature votes if it is this many times as common in toxic texts
THRESHOLD = 0.7  # score from which a text is called toxic

# Common insults of four languages, and patterns of heated writing.
INSULTS = {
    "en": "idiot moron stupid dumb loser scum trash worthless pathetic disgusting clown fool jerk",
    "de": "idiot dummkopf trottel abschaum versager widerlich arschloch drecksack blödmann",
    "fr": "idiot imbécile crétin connard salaud ordure débile abruti pourriture",
    "es": "idiota imbécil estúpido basura escoria payaso tonto asqueroso cabrón",
}
PATTERNS = ("!!", "***", "shut up")


def features(token: str) -> list[str]:
    """The words in a lower-case token and their beginnings."""
    out = []
    for run in LETTERS.findall(token):
        out.append("w" + run)
        out.extend("p" + run[:k] for k in PREFIXES if len(run) >= k)
    return out


def kind(feature: str) -> str:
    return "w" if feature[0] == "w" else f"p{len(feature) - 1}"


class Hits:
    """Counts the known features of a text; the texts' tokens are looked up in a cache."""

    def __init__(self, known: list[str]):
        self.index = {f: i for i, f in enumerate(known)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> dict[int, int]:
        found: dict[int, int] = {}
        cache = self.cache
        for token, n in Counter(text.lower().split()).items():
            ids = cache.get(token)
            if ids is None:
                ids = tuple(self.index[f] for f in features(token) if f in self.index)
                if len(token) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[token] = ids
            for i in ids:
                found[i] = found.get(i, 0) + n
        return found


@dataclass
class Linear:
    """The classifier: known features, their weights, and the intercept."""

    known: list[str]
    weights: np.ndarray
    intercept: float

    def scorer(self):
        hits, weights, base = Hits(self.known), self.weights, self.intercept

        def score(text: str | None) -> float:
            z = base + sum(weights[i] * min(n, MOST) for i, n in hits(text or "").items())
            return 1 / (1 + math.exp(-min(max(z, -700), 700)))

        return score


def fixed_features() -> list[str]:
    return sorted({"w" + word for words in INSULTS.values() for word in words.split()})


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(id, text, toxic, weight): up to ``most`` labelled training rows of either class.

    Chosen in the order of a hash of the id; weights restore the classes' shares. Both sides of
    the join are narrow, the chosen labels are at most 2 * most rows, so they may be broadcast.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull())
    known = known.where(crc_mod(F.col(id_col), 3) != 1)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sides = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = []
    for side in (0, 1):
        weight = max(1.0, sides.get(side, 0) / most)
        few = known.where(F.col("toxic") == side).orderBy(F.xxhash64("id"), "id").limit(most)
        parts.append(few.withColumn("weight", F.lit(weight)))
    chosen = parts[0].union(parts[1])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), "id")


def _count_features(sample: DataFrame) -> DataFrame:
    """(feature, n): toxic sampled texts that hold each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update({f for t in set((text or "").lower().split()) for f in features(t)})
        if seen:
            yield pa.RecordBatch.from_pydict({"feature": list(seen), "n": list(seen.values())})

    found = sample.where("toxic = 1").select("text").mapInArrow(run, "feature string, n long")
    return found.groupBy("feature").agg(F.sum("n").alias("n"))


def _hit_rows(sample: DataFrame, known: list[str]) -> DataFrame:
    """(id, toxic, weight, at, n, marks): features found in each sampled text, and pattern counts."""
    spark = sample.sparkSession
    shared = spark.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(shared.value)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            found = [hits(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("toxic"),
                    b.column("weight"),
                    pa.array([list(f) for f in found], pa.list_(pa.int32())),
                    pa.array([[min(n, MOST) for n in f.values()] for f in found], pa.list_(pa.int32())),
                    pa.array([[t.lower().count(p) for p in PATTERNS] for t in texts], pa.list_(pa.int32())),
                ],
                ["toxic", "weight", "at", "n", "marks"],
            )

    return sample.select("text", "toxic", "weight").mapInArrow(
        run, "toxic int, weight double, at array<int>, n array<int>, marks array<int>"
    )


def _covariance(values: np.ndarray, weight: np.ndarray) -> np.ndarray:
    total = weight.sum() + 1e-9
    centred = values - (weight[:, None] * values).sum(axis=0) / total
    return (centred * weight[:, None]).T @ centred / total


def _correlation(covariance: np.ndarray) -> np.ndarray:
    sd = np.sqrt(np.maximum(np.diag(covariance), 1e-6))
    out = covariance / np.outer(sd, sd)
    np.fill_diagonal(out, 1)
    return out


def label_model(votes: np.ndarray, weight: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, dict]:
    """Posterior of class 1 per row of ``votes`` (values 0 no, 1 abstain, 2 yes), and the estimates.

    P(vote | class) of each voter is estimated by EM, started from the share of yes among a row's votes. An
    abstention says nothing about the class. The correlations R of the votes given the class decide what share of its
    log ratio a voter counts with: with d the distances of the class means in standard deviations, R^-1 d are
    the weights of the best linear rule, so the share is (R^-1 d) / d, from 0 to 1; uncorrelated voters count in full,
    and voters that nearly always agree have one share together.
    No voter is trusted beforehand. ``weight`` counts equal rows.
    """
    rows, voters = votes.shape
    onehot = np.stack([votes == v for v in range(3)], axis=2).astype(float)
    signed = votes - 1.0
    # voters that say nearly the same count once, else their agreement would become the class
    alike = 1 / (_correlation(_covariance(signed, weight)) ** 8).sum(axis=1)
    support = ((votes == 2) * alike).sum(axis=1) / np.maximum(((votes != 1) * alike).sum(axis=1), 1e-9)
    # rows with more yes than the average row are likelier of class 1 at first
    usual = (weight * support).sum() / weight.sum()
    post = np.clip(support / max(2 * usual, 1e-9), 0.02, 0.98)
    for _ in range(rounds):
        tables, means = [], []
        within = np.zeros((voters, voters))
        for p in (1 - post, post):
            w = weight * p
            total = w.sum() + 1e-9
            tables.append((np.einsum("r,rvk->vk", w, onehot) + 0.5) / (total + 1.5))
            means.append((w[:, None] * signed).sum(axis=0) / total)
            within += _covariance(signed, w) * total / weight.sum()
        correlation = _correlation(within)
        apart = (means[1] - means[0]) / np.sqrt(np.maximum(np.diag(within), 1e-6))
        ridge = 0.7 * correlation + 0.3 * np.eye(voters)  # equal voters would be singular
        sure = np.where(np.abs(apart) > 1e-6, apart, 1e-6)
        share = np.clip(np.linalg.solve(ridge, apart) / sure, 0, alike)
        prior = min(max((weight * post).sum() / weight.sum(), 1e-3), 1 - 1e-3)
        ratio = np.log(tables[1]) - np.log(tables[0])
        ratio[:, 1] = 0  # abstentions
        z = math.log(prior / (1 - prior)) + np.einsum("rvk,vk,v->r", onehot, ratio, share)
        post = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    return post, {"tables": tables, "correlation": correlation, "share": share, "prior": prior}


def _families(best: list[tuple[str, float]], families: int) -> list[list[int]]:
    """Disjoint lexicons of the strong features: all features of one word beginning are in one of them."""
    groups: dict[int, list[int]] = {}
    for i, (f, lift) in enumerate(best):
        if lift >= STRONG:
            stem = f[1 : 1 + PREFIXES[0]]
            groups.setdefault(zlib.crc32(stem.encode()) % families, []).append(i)
    return [groups[g] for g in sorted(groups)]


def _voted(hits: DataFrame, known: list[int], lexicons: list[list[int]]) -> DataFrame:
    """(x, weight, votes): the known features' hits, and what each lexicon, each pattern and the annotators say."""
    spark = hits.sparkSession
    shared = spark.sparkContext.broadcast((known, lexicons))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lexicons = shared.value
        place = np.full(max(known) + 1, -1, dtype=np.int64)
        place[known] = np.arange(len(known))
        for b in batches:
            at, counts = b.column("at"), b.column("n").flatten().to_numpy()
            row = np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy()))
            feature = at.flatten().to_numpy()
            inside = feature < len(place)
            column = np.where(inside, place[np.where(inside, feature, 0)], -1)
            x = np.zeros((len(at), len(known)))
            x[row[column >= 0], column[column >= 0]] = counts[column >= 0]
            marks = np.array(b.column("marks").to_pylist()).reshape(len(at), -1)
            votes = np.column_stack(
                [
                    *[2 * (x[:, members] > 0).any(axis=1) for members in lexicons],
                    np.where(marks >= 2, 2, 1),
                    2 * b.column("toxic").to_numpy(),
                ]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(x), pa.list_(pa.float64())),
                    b.column("weight"),
                    pa.array(votes.tolist(), pa.list_(pa.int32())),
                ],
                ["x", "weight", "votes"],
            )

    return hits.mapInArrow(run, "x array<double>, weight double, votes array<int>")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    most_rows: int = 6000,
    most_features: int = 400,
    families: int = 12,
) -> Linear:
    """Fit the classifier on up to ``most_rows`` labelled training rows of either class.

    Labels count only where crc32 of the id's text mod 3 is not 1. Without rows of both classes the
    fixed lexicons are used with a fixed weight.
    """
    fixed = fixed_features()
    plain = Linear(fixed, np.full(len(fixed), 2.5), -3.0)
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.write(_sample(docs, labels, id_col, text_col, most_rows))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if min(sizes.get(0, 0), sizes.get(1, 0)) < 5:
        return plain

    # features in at least half a per cent of the toxic rows; the most frequent 20,000 of them
    least = max(3, sizes[1] // 200)
    often = _count_features(sample).where(F.col("n") >= least)
    often = [r["feature"] for r in often.orderBy(F.desc("n"), "feature").limit(20_000).collect()]
    often = sorted(set(often) | set(fixed))
    hits = scratch.write(_hit_rows(sample, often))
    counts = hits.select("toxic", F.explode("at").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )
    scored = []
    for r in counts.collect():  # at most 20,000 features
        pa_, pb = (r["a"] + 0.5) / (sizes[1] + 1), (r["b"] + 0.5) / (sizes[0] + 1)
        gap = math.log(pa_ / (1 - pa_)) - math.log(pb / (1 - pb))
        error = math.sqrt(1 / (r["a"] + 0.5) + 1 / (r["b"] + 0.5))
        if gap > 1.5 and gap / error > 4:
            scored.append((-gap / error, often[r["f"]], pa_ / pb))
    best = [(f, lift) for _, f, lift in sorted(scored)[:most_features]]
    known = [f for f, _ in best] + [f for f in fixed if f not in {x for x, _ in best}]
    if not best:
        return plain
    spots = {f: i for i, f in enumerate(often)}

    # voters: disjoint families of strong features, fixed lexicons, patterns, annotators
    at = {f: i for i, f in enumerate(known)}
    lexicons = _families(best, families)
    lexicons += [sorted({at["w" + w] for w in words.split()}) for words in INSULTS.values()]
    rows = scratch.write(_voted(hits, [spots[f] for f in known], lexicons))
    patterns = rows.groupBy("votes").agg(F.sum("weight").alias("w")).collect()  # at most the sample
    post, _ = label_model(
        np.array([p["votes"] for p in patterns]), np.array([p["w"] for p in patterns])
    )
    spark = docs.sparkSession
    named = spark.createDataFrame(
        [(p["votes"], float(q)) for p, q in zip(patterns, post)], "votes array<int>, p double"
    )
    both = F.inline(
        F.array(
            F.struct(F.lit(1.0).alias("label"), F.col("p").alias("share")),
            F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("share")),
        )
    )
    soft = rows.join(F.broadcast(named), "votes").select("x", "weight", both)
    soft = soft.where("share > 0.001").select(
        array_to_vector("x").alias("features"), "label", (F.col("share") * F.col("weight")).alias("w")
    )
    model = LogisticRegression(
        weightCol="w", regParam=0.00003, maxIter=60, standardization=False, maxBlockSizeInMB=8
    ).fit(soft)
    return Linear(known, np.array(model.coefficients.toArray()), float(model.intercept))


def score_toxicity(
    docs: DataFrame, model: Linear, text_col: str = "text", score_col: str = "score"
) -> DataFrame:
    """``docs`` with a score from 0 to 1 per whole text, higher for likelier toxic.

    A null or empty text has the score of a text without any hit. Only the text is looked at.
    An existing ``score_col`` is replaced; rows are independent of each other.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.known, model.weights, model.intercept))
    rows = docs.select(*[c for c in docs.columns if c != score_col])
    names = rows.columns
    at = names.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Linear(*shared.value).scorer()
        for b in batches:
            values = [score(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(values, pa.float64())], [*names, score_col]
            )

    return rows.mapInArrow(run, f"{schema}, `{score_col}` double")
