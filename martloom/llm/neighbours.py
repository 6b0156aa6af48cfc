"""Approximate nearest neighbours by inner product: NN-descent graph, greedy graph search.

Vectors of equal value are one node. Nodes are lifted by one component to equal length; a query's last
component is 0, so that the nodes nearest to it in angle are those of the largest inner product. A first
graph comes from random projections; NN-descent then joins the neighbours of each node with each other, round
by round, until few edges change. The longest vectors (``HEADS``) are compared with every query. Queries walk
the graph from the best of these and from their own neighbours: the best nodes found so far are expanded
by a join with their neighbours, and the survivors are ranked with the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import Scratch, partitions

LEAF = 512  # nodes compared with each other when the first graph is made
PART = 8192  # nodes of one range of a random projection
HEADS = 2048  # longest vectors, compared with every query
STARTS = 64  # of these, the best from which a query walks


def _matrix(column, kind: str) -> np.ndarray:
    """Rows of a non-null binary column of equal lengths as a matrix."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset :][: len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], dtype=kind)
    size = np.dtype(kind).itemsize
    return raw[ends[0] // size : ends[-1] // size].reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, full, norm2) of the vectors that take part, ``full`` the components as bytes.

    Left out are null ids, null, empty and zero vectors, null or non-finite components, and vectors of another
    length than the commonest one (the longer of two).
    """
    double = vectors.schema[vec_col].dataType.elementType.typeName() == "double"
    kind = "<f8" if double else "<f4"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    rows = rows.where("id is not null and size(vec) > 0")
    common = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"))
    common = common.orderBy(F.desc("n"), F.desc("d")).first()
    dim = common["d"] if common else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, full, norm = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                x = v.values.to_numpy(zero_copy_only=False)
                if len(x) != dim or v.values.null_count or not np.isfinite(x).all() or not x.any():
                    continue
                x = x.astype(kind) + 0.0  # one zero only
                ids.append(i)
                full.append(x.tobytes())
                norm.append(float(np.dot(x.astype("<f8"), x.astype("<f8"))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(full, pa.binary()), pa.array(norm, pa.float64())],
                ["id", "full", "norm2"],
            )

    return rows.mapInArrow(run, "id long, full binary, norm2 double"), kind


def make_nodes(rows: DataFrame, kind: str, scratch: Scratch, members: int) -> tuple[DataFrame, DataFrame, str]:
    """(node, full, code, members), one row per different vector; the longest of them; the code's type.

    node is its smallest id, members its ``members`` smallest ids: no list of nearest ids, with ties to
    the smaller, can need more of them. code is the lifted vector, in units of the shortest of the
    ``HEADS`` longest; these are cut to that length in code, so that a few outlying lengths do not
    crush all others. Half precision does where lengths differ little, else single.
    """
    rank = F.row_number().over(Window.partitionBy("full").orderBy("id"))
    few = rows.withColumn("r", rank).where(F.col("r") <= members)
    grouped = few.groupBy("full").agg(
        F.array_sort(F.collect_list("id")).alias("members"), F.max("norm2").alias("norm2")
    )
    grouped = scratch.write(grouped)
    heads = grouped.orderBy(F.desc("norm2"), "full").limit(HEADS)
    heads = scratch.write(heads.select(F.element_at("members", 1).alias("node"), "full", "norm2"))
    longest = heads.agg(F.min("norm2")).first()[0] or 1.0
    shortest = grouped.agg(F.min("norm2")).first()[0] or 0.0
    code_kind = "<f2" if shortest > 0.5 * longest else "<f4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("full"), kind).astype(np.float64)
            x /= math.sqrt(longest)
            x /= np.maximum(1, np.sqrt((x * x).sum(axis=1)))[:, None]
            last = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
            code = np.hstack([x, last[:, None]]).astype(code_kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([m[0].as_py() for m in b.column("members")], pa.int64()),
                    b.column("full"), pa.array([c.tobytes() for c in code], pa.binary()), b.column("members"),
                ],
                ["node", "full", "code", "members"],
            )

    columns = grouped.select("full", "members")
    nodes = scratch.write(
        columns.mapInArrow(run, "node long, full binary, code binary, members array<long>")
    )
    return nodes, heads, code_kind


def head_starts(asked: DataFrame, heads: DataFrame, kind: str, code_kind: str, most: int) -> DataFrame:
    """(q, code, nodes, sims): each query's code and the ``most`` best of the longest vectors for it.

    ``asked`` is (q, full). A query's code is its direction with 0 as the last component; sims are its inner
    products with the nodes, in the nodes' units. The longest vectors go to the tasks with the function; there are at most ``HEADS``.
    """
    few = heads.toPandas()
    ids = few["node"].to_numpy(dtype=np.int64)
    longs = np.array([np.frombuffer(v, dtype=kind) for v in few["full"]], dtype=np.float64)
    longs /= math.sqrt(few["norm2"].min() or 1.0) if len(few) else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("full"), kind).astype(np.float64)
            x /= np.abs(x).max(axis=1)[:, None]
            x /= np.sqrt((x * x).sum(axis=1))[:, None]
            code = np.hstack([x, np.zeros((len(x), 1))]).astype(code_kind)
            sim = x @ longs.T
            n = min(most, len(ids))
            best = np.argpartition(-sim, n - 1, axis=1)[:, :n]
            starts = pa.ListArray.from_arrays(pa.array(range(0, n * len(x) + 1, n), pa.int32()), pa.array(ids[best].ravel()))
            sims = pa.ListArray.from_arrays(starts.offsets, pa.array(np.take_along_axis(sim, best, axis=1).ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("q"), pa.array([c.tobytes() for c in code], pa.binary()), starts, sims],
                ["q", "code", "nodes", "sims"],
            )

    return asked.select("q", "full").mapInArrow(run, "q long, code binary, nodes array<long>, sims array<double>")


def _top(edges: DataFrame, by: str, k: int) -> DataFrame:
    """The k edges of each ``by`` with the highest sim; ties go to the smaller end."""
    other = "v" if by == "u" else "node"
    order = Window.partitionBy(by).orderBy(F.desc("sim"), F.col(other))
    return edges.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def first_graph(nodes: DataFrame, n: int, k: int, trees: int, seed: int, kind: str = "<f2") -> DataFrame:
    """(u, v, sim): per tree, ranges of a random projection, split by hyperplanes into leaves."""
    parts = max(1, math.ceil(n / PART))
    out = None
    for tree in range(trees):

        def project(batches: Iterator[pa.RecordBatch], tree=tree) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = _matrix(b.column("code"), kind).astype(np.float32)
                    line = np.random.default_rng(seed + tree).standard_normal(x.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [*b.columns, pa.array(x @ line, pa.float64())], ["node", "code", "at"]
                    )

        def compare(batches: Iterator[pa.RecordBatch], tree=tree) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if not held:
                return
            ids = np.concatenate([b.column("node").to_numpy() for b in held])
            x = np.vstack([_matrix(b.column("code"), kind) for b in held]).astype(np.float32)
            rng = np.random.default_rng(seed + 1000 + tree)
            stack = [np.arange(len(ids))]
            while stack:
                own = stack.pop()
                if len(own) > LEAF:
                    a, b = x[rng.choice(own, 2, replace=False)]
                    order = np.argsort(x[own] @ (a - b), kind="stable")
                    stack += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
                    continue
                sim = x[own] @ x[own].T
                np.fill_diagonal(sim, -np.inf)
                most = min(k, len(own) - 1)
                if most < 1:
                    continue
                best = np.argpartition(-sim, most - 1, axis=1)[:, :most]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids[own], most)), pa.array(ids[own][best].ravel()),
                        pa.array(np.take_along_axis(sim, best, axis=1).ravel().astype(np.float64)),
                    ],
                    ["u", "v", "sim"],
                )

        lined = nodes.select("node", "code").mapInArrow(project, "node long, code binary, at double")
        ranges = lined.repartitionByRange(parts, "at").select("node", "code")
        found = ranges.mapInArrow(compare, "u long, v long, sim double")
        out = found if out is None else out.union(found)
    return out


def _by_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches cut where the sorted key changes, so that no group spans two of them."""
    rest = None
    for b in batches:
        if rest is not None:
            b = pa.concat_batches([rest, b])
        if not b.num_rows:
            continue
        keys = b.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        rest = b.slice(cut)
        if cut:
            yield b.slice(0, cut)
    if rest is not None and rest.num_rows:
        yield rest


def _local_join(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Better edges among the neighbours of one node: pairs that beat an end's worst edge."""
    for b in _by_group(batches, "c"):
        c, m = b.column("c").to_numpy(), b.column("m").to_numpy()
        fresh, worst = b.column("fresh").to_numpy(zero_copy_only=False), b.column("worst").to_numpy()
        x = _matrix(b.column("code"), kind).astype(np.float32)
        starts = np.nonzero(np.diff(c, prepend=c[0] - 1))[0].tolist() + [len(c)]
        u, v, s = [], [], []
        for lo, hi in zip(starts, starts[1:]):
            own = x[lo:hi]
            sim = own @ own.T
            f = fresh[lo:hi]
            ok = (sim > worst[lo:hi, None]) & (f[:, None] | f[None, :])
            np.fill_diagonal(ok, False)
            i, j = np.nonzero(ok)
            ids = m[lo:hi]
            different = ids[i] != ids[j]
            i, j = i[different], j[different]
            u.append(ids[i])
            v.append(ids[j])
            s.append(sim[i, j])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(u)), pa.array(np.concatenate(v)), pa.array(np.concatenate(s).astype(np.float64))],
            ["u", "v", "sim"],
        )


def build_graph(
    nodes: DataFrame,
    scratch: Scratch,
    *,
    kind: str = "<f2",
    k: int = 48,
    reverse: int = 32,
    trees: int = 4,
    rounds: int = 5,
    settled: float = 0.02,
    seed: int = 5,
) -> DataFrame:
    """(u, v, sim): about the ``k`` nearest nodes of every node.

    Each round takes, per node, its edges and up to ``reverse`` edges that point to it (drawn
    by a hash, as NN-descent samples them), and joins them with each other; pairs of two edges that were
    both there in the round before are not tried again. Ends when fewer than ``settled`` of the
    edges are new, or after ``rounds``.
    """
    n = nodes.count()
    first = first_graph(nodes, n, k, trees, seed, kind).groupBy("u", "v").agg(F.max("sim").alias("sim"))
    edges = scratch.write(_top(first, "u", k).withColumn("fresh", F.lit(True)))
    for turn in range(rounds):
        worst = edges.groupBy("u").agg(F.min("sim").alias("low"), F.count("*").alias("n"))
        worst = worst.select(
            F.col("u").alias("m"), F.when(F.col("n") >= k, F.col("low")).otherwise(-2.0).alias("worst")
        )
        forward = edges.select(F.col("u").alias("c"), F.col("v").alias("m"), "fresh")
        back = edges.select(F.col("v").alias("c"), F.col("u").alias("m"), "fresh")
        drawn = Window.partitionBy("c").orderBy(F.desc("fresh"), F.xxhash64("m", F.lit(turn)), "m")
        back = back.withColumn("r", F.row_number().over(drawn)).where(F.col("r") <= reverse).drop("r")
        around = forward.union(back).groupBy("c", "m").agg(F.max("fresh").alias("fresh"))
        known = nodes.select(F.col("node").alias("m"), "code").join(worst, "m", "left")
        known = known.withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
        full = around.join(known, "m").select("c", "m", "fresh", "worst", "code")
        spread = full.repartition(partitions(nodes.sparkSession), "c").sortWithinPartitions("c")
        found = spread.mapInArrow(partial(_local_join, kind=kind), "u long, v long, sim double")
        found = found.groupBy("u", "v").agg(F.max("sim").alias("sim")).withColumn("fresh", F.lit(True))
        both = edges.withColumn("fresh", F.lit(False)).union(found)
        both = both.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
        after = scratch.write(_top(both, "u", k))
        scratch.drop(edges)
        edges = after
        fresh = edges.where("fresh").count()
        if fresh <= settled * n * k:
            break
    return edges.select("u", "v", "sim")


def _score(rows: DataFrame, left: str, right: str, kind: str, wide: str = "<f8") -> DataFrame:
    """``rows`` with ``sim``: inner products of two binary columns, which are dropped."""
    keep = [c for c in rows.columns if c not in (left, right)]
    rows = rows.select(*keep, left, right)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = _matrix(b.column(left), kind).astype(wide), _matrix(b.column(right), kind).astype(wide)
                sim = np.einsum("ij,ij->i", x, y).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in keep], pa.array(sim)], [*keep, "sim"]
                )

    return rows.mapInArrow(run, f"{schema}, sim double")


def greedy_search(
    queries: DataFrame,
    entry: DataFrame,
    graph: DataFrame,
    nodes: DataFrame,
    scratch: Scratch,
    *,
    kind: str = "<f2",
    keep: int = 128,
    expand: int = 32,
    rounds: int = 4,
) -> DataFrame:
    """(q, node, sim): up to ``keep`` nodes of each query with a large inner product.

    ``queries`` is (q, code), the query's direction with 0 as its last component; ``entry`` (q, node, sim) are the starting nodes. Each round
    expands the best ``expand`` nodes of a query not expanded before; the search ends when no
    query has one left among its ``keep`` best, or after ``rounds``.
    """
    state = scratch.write(_top(entry.withColumn("done", F.lit(False)), "q", keep))
    codes = nodes.select("node", F.col("code").alias("theirs"))
    for _ in range(rounds):
        order = Window.partitionBy("q").orderBy("done", F.desc("sim"), "node")
        turn = state.withColumn("r", F.row_number().over(order))
        turn = turn.withColumn("now", ~F.col("done") & (F.col("r") <= expand)).drop("r")
        ahead = turn.where("now").select("q", F.col("node").alias("u"))
        found = ahead.join(graph, "u").select("q", F.col("v").alias("node")).distinct()
        found = found.join(state.select("q", "node"), ["q", "node"], "left_anti")
        pairs = found.join(codes, "node").join(queries, "q").select("q", "node", "theirs", "code")
        scored = _score(pairs, "theirs", "code", kind, "<f4").withColumn("done", F.lit(False))
        seen = turn.select("q", "node", "sim", (F.col("done") | F.col("now")).alias("done"))
        after = scratch.write(_top(seen.select("q", "node", "sim", "done").union(scored), "q", keep))
        scratch.drop(state)
        state = after
        if state.where("not done").isEmpty():
            break
    return state.select("q", "node", "sim")


def nearest_neighbours(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, every: int = 20, k: int = 20
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of each row whose id is divisible by ``every``.

    Near is a large inner product, in double precision on the original vectors; ties go to the
    smaller id. All rows but the query's own are candidates (all of them are given, if fewer than
    ``k``). Of rows that repeat an id the one with the smallest bytes counts; vectors that are null, empty, zero,
    of an uncommon length or with a null or non-finite component take no part.
    """
    scratch = Scratch(vectors.sparkSession, "neighbours")
    rows, kind = usable(vectors, id_col, vec_col)
    rows = rows.groupBy("id").agg(F.min("full").alias("full"), F.max("norm2").alias("norm2"))
    rows = scratch.write(rows)
    nodes, heads, code_kind = make_nodes(rows, kind, scratch, k + 1)
    graph = build_graph(nodes, scratch, kind=code_kind)
    asked = rows.where(F.col("id") % every == 0).select(F.col("id").alias("q"), "full")
    at = scratch.write(asked.join(nodes.select("full", "node"), "full").select("q", "node", "full"))
    starts = scratch.write(head_starts(at, heads, kind, code_kind, max(STARTS, k + 1)))
    codes = starts.select("q", "code")
    # a query's own neighbours are scored as a query scores them, without its lift
    near = at.select("q", F.col("node").alias("u")).join(graph, "u").select("q", F.col("v").alias("node"))
    near = at.select("q", "node").union(near)
    near = near.join(nodes.select("node", F.col("code").alias("theirs")), "node").join(codes, "q")
    near = _score(near.select("q", "node", "theirs", "code"), "theirs", "code", code_kind, "<f4")
    best = starts.select("q", F.inline(F.arrays_zip("nodes", "sims"))).toDF("q", "node", "sim")
    # a head is cut in its code, not in its own score, which is the larger
    entry = near.union(best).groupBy("q", "node").agg(F.max("sim").alias("sim"))
    found = greedy_search(codes, entry, graph, nodes, scratch, kind=code_kind)
    # rank with the original vectors, and every id that shares one
    pairs = found.select("q", "node").join(nodes.select("node", F.col("full").alias("theirs"), "members"), "node")
    pairs = pairs.join(at.select("q", "full"), "q").select("q", "members", "theirs", "full")
    scored = _score(pairs, "theirs", "full", kind)
    each = scored.select("q", "sim", F.explode("members").alias("node")).where("node <> q")
    order = Window.partitionBy("q").orderBy(F.desc("sim"), "node")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(
        F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"),
        F.col("node").alias(id_col), F.col("sim").alias("score"),
    )
