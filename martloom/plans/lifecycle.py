"""Products that have just become profitable."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import has_value, month_index
from ..operators.unions import union_all
from ..sources import month_range

# Fixed value: the text that stands for "no article" in the existence test.
NO_ARTICLE = "None"


@dataclass(frozen=True)
class Market:
    """Monthly results of one market with its target and prior months (first, last)."""

    results: DataFrame
    target: tuple[tuple[int, int], tuple[int, int]]
    prior: tuple[tuple[int, int], tuple[int, int]]


def _one_market(market: Market) -> DataFrame:
    """One scan and one large aggregate serve all three readings of the table.

    The rows of target and prior months are summed per (team, article) with the two periods
    apart; the tests per article then look at one row per team.
    """
    bounds = sorted([*market.target, *market.prior])
    rows = month_range(market.results, "year_pdt", "month", bounds[0], bounds[-1])
    index = month_index(F.col("year_pdt"), F.col("month"))

    def during(period):
        (y0, m0), (y1, m1) = period
        return index.between(y0 * 12 + m0, y1 * 12 + m1)

    now, before = during(market.target), during(market.prior)
    margin = F.col("month_gross_margin")
    per_team = (
        rows.filter(now | before)
        .groupBy("team", "asin")
        .agg(
            F.sum(F.when(now, F.col("principal"))).alias("sum_principal"),
            F.sum(F.when(now, F.col("amount_reim"))).alias("sum_reimbursements"),
            F.sum(F.when(now, margin)).alias("sum_gross_margin"),
            F.count(F.when(now, 1)).alias("__rows"),
            F.count(F.when(now & (margin > 0), 1)).alias("__gains"),
            F.sum(F.when(before, margin)).alias("__before"),
        )
    )
    article = W.partitionBy("asin")
    return (
        per_team.withColumns(
            {
                "__gains": F.sum("__gains").over(article),
                "__before": F.sum("__before").over(article),
            }
        )
        .filter(
            (F.col("__rows") > 0)
            & (F.col("__gains") > 0)
            & (F.col("__before") == 0)
            & has_value(F.col("asin"), NO_ARTICLE)
        )
        .select(
            "team",
            "asin",
            "sum_principal",
            "sum_reimbursements",
            "sum_gross_margin",
            (F.col("sum_gross_margin") - F.col("sum_reimbursements")).alias("net_margin_after_reim"),
        )
    )


def newly_profitable(markets: Sequence[Market], ordered: bool = True) -> DataFrame:
    """Per market, articles with a gain in the target months and a zero total before them.

    An article without any prior row has no total and does not qualify.
    """
    report = union_all([_one_market(m) for m in markets])
    gain = F.col("sum_gross_margin").desc_nulls_last()
    return report.orderBy(gain, "team", "asin") if ordered else report
