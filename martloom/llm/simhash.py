"""SimHash near-duplicate groups with pigeonring candidate filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import Scratch
from martloom.llm.components import connected_components

BITS = 64
BLOCK = 1 << 16  # shingles hashed at a time, so that a very long text needs little memory


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Bit b is 1 if it is set in over half of the shingles' XXH64; 0 without words."""
    words = (text or b"").lower().split()  # both ASCII only, on bytes
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    ends = (ends[width - 1 :] - 1).tolist()
    ones, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        pieces = zip(starts[at : at + BLOCK], ends[at : at + BLOCK])
        hashes = np.array([digest(joined[s:e], 42) for s, e in pieces], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    over = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """(id, fp) for each row, the fingerprint as a signed long."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            values = np.array([fingerprint(t.as_py(), width) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(values.view(np.int64))], ["id", "fp"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, fp long")


def segment_masks(segments: int) -> list[int]:
    """Masks of consecutive bit segments of nearly equal width, as signed longs."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    return [m - (1 << BITS) if m >> 63 else m for m in masks]


def _chain(x: Column, start: int, masks: list[int], tau: int) -> Column:
    """Pigeonring condition: every chain from ``start`` of length l differs in <= l*tau/m bits."""
    m, ok, total = len(masks), F.lit(True), F.lit(0)
    for step in range(m):
        total = total + F.bit_count(x.bitwiseAND(F.lit(masks[(start + step) % m])))
        ok = ok & (total <= (step + 1) * tau // m)
    return ok


def near_links(fps: DataFrame, scratch: Scratch, tau: int = 2, bucket: int = 32) -> DataFrame:
    """(u, v) links whose transitive closure joins all distinct ``fp`` within ``tau`` bits.

    If two fingerprints differ in at most tau bits, then around the ring of m = tau + 1 segments
    some segment starts a chain whose first l segments differ in at most l * tau / m bits for
    every l; so the start segment is equal. Fingerprints that share a segment are candidates,
    and the chain condition is tested before the full distance.

    A segment value shared by more than ``bucket`` fingerprints (a large family of near copies)
    would make a quadratic number of pairs. There each fingerprint is instead sent to every value
    that it reaches by changing up to tau // 2 of the bits outside the segment: two fingerprints
    within tau bits meet at such a value for even tau, whoever meets there is within
    tau bits, and for tau = 2 a value is reached by at most 44 fingerprints. So no link is lost
    and nothing is quadratic. Only tau = 2 is offered for that reason.
    """
    if tau != 2:
        raise ValueError("the exact path for crowded segments is made for tau = 2")
    masks = segment_masks(tau + 1)
    sides = [
        F.struct(F.lit(i).alias("box"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"))
        for i, m in enumerate(masks)
    ]
    boxes = fps.select("fp", F.inline(F.array(*sides)))
    sizes = boxes.groupBy("box", "part").agg(F.count("*").alias("n")).where("n > 1")
    held = scratch.write(boxes.join(sizes, ["box", "part"]))

    few = held.where(F.col("n") <= bucket)
    a, b = few.select("box", "part", F.col("fp").alias("u")), few.select(
        "box", "part", F.col("fp").alias("v")
    )
    x = F.col("u").bitwiseXOR(F.col("v"))
    chain = F.lit(False)
    for i in range(len(masks)):
        chain = chain | ((F.col("box") == i) & _chain(x, i, masks, tau))
    pairs = a.join(b, ["box", "part"]).where((F.col("u") > F.col("v")) & chain)
    pairs = pairs.where(F.bit_count(x) <= tau).select("u", "v")

    flips = []
    for i, m in enumerate(masks):
        outside = [0] + [1 << k for k in range(BITS) if not (m >> k) & 1]
        outside = [f - (1 << BITS) if f >> 63 else f for f in outside]
        flips.append(F.when(F.col("box") == i, F.array(*[F.lit(f) for f in outside])))
    crowd = held.where(F.col("n") > bucket).select("box", "fp", F.explode(F.coalesce(*flips)).alias("flip"))
    meet = crowd.groupBy("box", F.col("fp").bitwiseXOR(F.col("flip")).alias("at")).agg(
        F.collect_set("fp").alias("near")  # at most 44: one per flip
    )
    stars = meet.where(F.size("near") > 1).select(
        F.explode("near").alias("u"), F.array_min("near").alias("v")
    )
    return pairs.union(stars.where("u <> v").distinct())


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 3, tau: int = 2
) -> DataFrame:
    """(id, fp, component) per row: its fingerprint and the smallest id of its group.

    Groups are the connected components of "fingerprints differ in at most tau bits". Rows with
    equal fingerprints are collapsed before links are sought, so a group of copies costs one
    fingerprint. Null or blank texts have fingerprint 0 and are linked like any other. A null id
    keeps its row and never names a group (null if no member has an id). Repeated ids give
    repeated rows. Other columns are ignored, whatever their names; an empty table gives none.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    rows = scratch.write(fingerprints(docs, id_col, text_col, width))
    fps = scratch.write(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    links = near_links(fps.select("fp"), scratch, tau)
    linked = connected_components(links, scratch).withColumnRenamed("u", "fp")
    # only fingerprints with a link need a root other than themselves
    members = fps.join(linked, "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root")
    )
    firsts = members.groupBy("root").agg(F.min("first_id").alias("component"))
    named = scratch.write(members.join(firsts, "root").select("fp", "component"))
    return rows.join(named, "fp").select("id", "fp", "component")


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 3, tau: int = 2
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their near-duplicate group.

    Rows with a null id cannot be told apart and stay. Of repeated rows with the naming id all
    stay, as the id is what the decision is about.
    """
    groups = simhash_groups(docs, id_col, text_col, width=width, tau=tau)
    gone = groups.where("id is not null and id <> component").select(F.col("id").alias("__gone"))
    # the short side is hashed, so that texts need not be sorted
    return docs.join(gone.distinct().hint("shuffle_hash"), docs[id_col] == F.col("__gone"), "left_anti")
