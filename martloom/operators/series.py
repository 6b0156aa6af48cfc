"""Changes along a series and the filling of its gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import or_zero, safe_div
from .ordered import number_and_lag


def period_delta(
    df: DataFrame,
    keys: Sequence[str],
    period: Sequence[str],
    value: str,
    scale: int = 2,
    changed_only: bool = True,
    negate: bool = False,
    chunk: Column | None = None,
) -> DataFrame:
    """Compare each period of a key with the one before it.

    Adds ``row_num``, ``previous_<value>``, ``difference`` and ``difference_percent``, the
    last relative to the *current* value and as a fraction. Expects one row per key and
    period; ``period`` ends in a tie-break where periods can coincide.
    """
    previous = f"previous_{value}"
    timeline = number_and_lag(
        df, keys, period, seq="row_num", lags={previous: F.col(value)}, chunk=chunk
    )
    now, before = F.col(value), F.col(previous)
    if negate:
        now, before = -now, -before
    now, before = F.round(now, scale), F.round(before, scale)
    out = timeline.withColumn("difference", now - before).withColumn(
        "difference_percent", F.abs(F.round(safe_div(F.col("difference"), now), scale))
    )
    if changed_only:
        out = out.filter((F.col("difference") != 0) & F.col(previous).isNotNull())
    return out


def _anchors(keys, order, fields, known):
    """The nearest known row before and after each row, as structs of ``fields``."""
    anchor = F.when(known, F.struct(*fields))
    forward = W.partitionBy(*keys).orderBy(F.col(order).asc()).rowsBetween(W.unboundedPreceding, -1)
    # Looking back along the reversed order keeps a running state; a frame reaching to the
    # end of the group would be scanned anew for every row.
    backward = (
        W.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        F.last(anchor, ignorenulls=True).over(forward),
        F.last(anchor, ignorenulls=True).over(backward),
    )


def _neighbour_columns(order: str, value: str) -> list[Column]:
    return [
        F.col("__before.v").alias(f"prev_{value}"),
        F.col("__before.at").alias(f"prev_{order}"),
        F.col("__after.v").alias(f"next_{value}"),
        F.col("__after.at").alias(f"next_{order}"),
    ]


def neighbour_values(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Nearest non-zero value and its position on either side of each row of the key.

    Expects one row per key and position, so that a key is bounded by the calendar.
    """
    known = or_zero(F.col(value)) != 0
    before, after = _anchors(keys, order, [F.col(order).alias("at"), F.col(value).alias("v")], known)
    return df.withColumns({"__before": before, "__after": after}).select(
        *df.columns, *_neighbour_columns(order, value)
    )


def nearest_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    bound: Sequence[str] = (),
    ties: str = "all",
    seq: str = "pk",
    neighbours: bool = False,
) -> DataFrame:
    """For each empty (NULL or 0) row, the closest non-empty value of the same key.

    ``bound`` names the leading order columns a fill must not cross (the year); ``order`` is
    the position within. ``ties="all"`` returns both of two equidistant anchors, "earlier"
    only the first. A gap without any anchor stays, with NULLs. Adds ``seq`` (row number
    within the key), ``fill_<seq>`` (number of the anchor among the key's anchors) and
    ``fill_<value>``; with ``neighbours`` also the columns of :func:`neighbour_values`. Expects one row per key, bound and order: groups are bounded by the
    calendar, and all windows share one shuffle by ``keys``.
    """
    if ties not in ("all", "earlier"):
        raise ValueError(f"unknown ties: {ties}")
    known = or_zero(F.col(value)) != 0
    along = W.partitionBy(*keys).orderBy(*[F.col(c) for c in (*bound, order)])
    numbered = df.withColumns(
        {
            seq: F.row_number().over(along),
            "__anchor_no": F.count(F.when(known, 1)).over(
                along.rowsBetween(W.unboundedPreceding, W.currentRow)
            ),
        }
    )
    fields = [F.col(order).alias("at"), F.col("__anchor_no").alias("n"), F.col(value).alias("v")]
    before, after = _anchors([*keys, *bound], order, fields, known)
    gaps = numbered.withColumns({"__before": before, "__after": after}).filter(~known)
    left = F.col(order) - F.col("__before.at")
    right = F.col("__after.at") - F.col(order)
    near = F.least(left, right)
    if ties == "earlier":
        chosen = F.array(F.when(left == near, F.col("__before")).otherwise(F.col("__after")))
    else:
        chosen = F.array_compact(
            F.array(
                F.when(left == near, F.col("__before")), F.when(right == near, F.col("__after"))
            )
        )
    around = _neighbour_columns(order, value) if neighbours else []
    return gaps.withColumn("__fill", F.explode_outer(chosen)).select(
        *df.columns,
        *around,
        seq,
        F.col("__fill.n").alias(f"fill_{seq}"),
        F.col("__fill.v").alias(f"fill_{value}"),
    )
