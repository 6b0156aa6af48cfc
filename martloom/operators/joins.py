"""Lookups, existence tests and the star join.

No side is broadcast by hint: adaptive execution broadcasts a lookup when its measured size
is small and otherwise shuffles both sides, splitting skewed partitions. A lookup that comes straight
from files is the exception: Spark plans its broadcast by their compressed size beforehand and keeps to
it, so lookups that grow with the facts ask for a merge.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import has_value
from .skew import key_hash


@dataclass(frozen=True)
class DimJoin:
    """One lookup of a snowflake.

    ``on`` maps fact columns to lookup columns, ``take`` maps output names to lookup columns
    (or expressions over them). ``where`` restricts the lookup *before* the join, so facts
    without a match survive a left join. ``valid`` is ``(fact date, from, to)``: the lookup
    row must be valid on that date. An empty ``take`` still multiplies rows when the lookup
    is not unique, as a SQL join does. ``split`` is for a lookup that was itself aggregated by
    its keys: it lets very frequent fact keys be split (see :mod:`martloom.operators.skew`).
    ``merge`` is for a lookup that grows with the facts: both sides are shuffled and merged, and no task
    holds the whole lookup, however small its files are.
    """

    dim: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str | Column] = field(default_factory=dict)
    how: str = "left"
    where: Column | None = None
    valid: tuple[str, str, str] | None = None
    unique: bool = False
    split: bool = False
    merge: bool = False


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` after checking, in one aggregate, that no key combination repeats."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"duplicate keys in {list(keys)}")
    return df


def enrich(facts: DataFrame, dims: Iterable[DimJoin]) -> DataFrame:
    """Fold a list of lookups over the facts, in the given order."""
    for dim in dims:
        side = dim.dim if dim.where is None else dim.dim.filter(dim.where)
        if dim.unique:
            assert_unique(side, list(dim.on.values()))
        fetched = {out: F.col(c) if isinstance(c, str) else c for out, c in dim.take.items()}
        cols = {f"__on{i}": F.col(c) for i, c in enumerate(dim.on.values())} | fetched
        if dim.valid:
            cols |= {"__from": F.col(dim.valid[1]), "__to": F.col(dim.valid[2])}
        side = side.select(*[c.alias(n) for n, c in cols.items()])
        match = reduce(
            lambda a, b: a & b, [facts[c] == side[f"__on{i}"] for i, c in enumerate(dim.on)]
        )
        if dim.split:
            fact_hash = key_hash(*[facts[c] for c in dim.on])
            side = side.withColumn("__h", key_hash(*[side[f"__on{i}"] for i in range(len(dim.on))]))
            match = match & (fact_hash == side["__h"])
        if dim.valid:
            match = match & facts[dim.valid[0]].between(side["__from"], side["__to"])
        if dim.merge:
            side = side.hint("merge")
        facts = facts.join(side, match, dim.how).select(
            *[facts[c] for c in facts.columns if c not in fetched], *[side[o] for o in fetched]
        )
    return facts


def lookup_or_self(
    df: DataFrame, id_col: str, mapping: DataFrame, key: str, parent: str, name: str
) -> DataFrame:
    """The mapped parent of an id, or the id itself where the mapping has none."""
    out = enrich(df, [DimJoin(mapping, {id_col: key}, {"__parent": parent})])
    return out.withColumn(name, F.coalesce(F.col("__parent"), F.col(id_col))).drop("__parent")


def lookup_chain(
    df: DataFrame, start: str, steps: Sequence[tuple[DataFrame, str, str]], name: str
) -> DataFrame:
    """Follow ``(mapping, from, to)`` steps from ``start``; NULL once a step finds nothing."""
    at, hops = start, []
    for i, (mapping, source, target) in enumerate(steps):
        hop = f"__hop{i}"
        hops.append(DimJoin(mapping, {at: source}, {hop: target}))
        at = hop
    out = df
    for hop in hops:
        out = enrich(out, [hop])
    return out.withColumn(name, F.col(at)).select(*df.columns, name)


def exists_in(
    df: DataFrame, other: DataFrame, on: Mapping[str, str], sentinel: str | None = None
) -> DataFrame:
    """Rows whose key occurs in ``other``. A key equal to ``sentinel`` counts as missing.

    Rows of a very frequent key are split over tasks, see :mod:`martloom.operators.skew`.
    """
    if sentinel is not None:
        for col in on.values():
            other = other.filter(has_value(F.col(col), sentinel))
    names = [f"__k{i}" for i in range(len(on))]
    keys = other.select(*[F.col(c).alias(n) for n, c in zip(names, on.values())]).distinct()
    return semi_by_hash(df, keys, dict(zip(on, names)), "left_semi")


def semi_by_hash(
    df: DataFrame, keys: DataFrame, on: Mapping[str, str], how: str
) -> DataFrame:
    """Semi or anti join with distinct keys, such that skewed rows can still be split."""
    left = df.withColumn("__h", key_hash(*[df[c] for c in on]))
    right = keys.withColumn("__h", key_hash(*[keys[k] for k in on.values()]))
    match = reduce(
        lambda a, b: a & b,
        [left["__h"] == right["__h"], *[left[c] == right[k] for c, k in on.items()]],
    )
    return left.join(right, match, how).drop("__h")


def spine_join(
    spine: DataFrame, components: Mapping[str, DataFrame], on: Sequence[str], fill=0
) -> DataFrame:
    """Attach the measures of many components to a spine, ``fill`` where there are none.

    Components arrive aggregated to ``on``, hence partitioned by it: the spine is shuffled and
    sorted once, and all joins follow in one stage as merges along the same order. Each
    component travels as one struct, which later joins copy as a block instead of decoding
    every measure again. A component must not repeat a key, or it multiplies spine rows (see
    ``assert_unique``). ``fill=None`` leaves the gaps NULL.
    """
    out, measures = spine, {c: F.col(c) for c in spine.columns}
    for name, df in components.items():
        fields = [c for c in df.columns if c not in on]
        shared = [c for c in fields if c in measures]
        if shared:
            raise ValueError(f"{name} repeats columns {shared}")
        packed = f"__{name}"
        out = out.join(df.select(*on, F.struct(*fields).alias(packed)), list(on), "left")
        found = {c: F.col(f"{packed}.{c}") for c in fields}
        if fill is not None:
            found = {c: F.coalesce(col, F.lit(fill)) for c, col in found.items()}
        measures |= found
    return out.select(*[col.alias(name) for name, col in measures.items()])


def reversal_join(
    df: DataFrame,
    id_col: str,
    original_id: str,
    keys: Sequence[str],
    is_reversal: Column,
    amount: str,
) -> DataFrame:
    """Originals with what was later taken back from them: ``n_reversals``, ``reversed_amount``.

    Reversals are summed per original id and ``keys`` first, so an original with many
    reversals stays one row; NULL keys never match.
    """
    taken = (
        df.filter(is_reversal)
        .groupBy(
            F.col(original_id).alias("__id"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
        )
        .agg(F.count(F.lit(1)).alias("n_reversals"), F.sum(amount).alias("reversed_amount"))
    )
    match = reduce(
        lambda a, b: a & b,
        [df[id_col] == taken["__id"], *[df[k] == taken[f"__k{i}"] for i, k in enumerate(keys)]],
    )
    return df.join(taken, match, "left").select(
        *[df[c] for c in df.columns],
        F.coalesce("n_reversals", F.lit(0)).alias("n_reversals"),
        "reversed_amount",
    )
