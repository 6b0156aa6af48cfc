"""Advertising efficiency against the month's profit and loss."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import brand_prefix, safe_div
from ..operators.aggregates import ad_profit
from ..operators.dedup import latest_per_key
from ..operators.joins import DimJoin, enrich
from ..operators.unions import union_labelled

# P&L columns shown next to each advertisement.
PNL_COLUMNS = (
    "month_gross_margin", "principal", "quantity_purchased", "avg_price", "avg_cost_per_unit",
    "avg_fee",
)

_GRAIN = {
    "ad_id": "adid",
    "advertised_asin": "advertisedasin",
    "advertised_sku": "advertisedsku",
    "start_date": "startdate",
    "end_date": "enddate",
}
_SUMS = {
    "sum_spend": "spend",
    "sum_total_sales_ads": "sales7d",
    "sum_total_orders_ads": "purchases7d",
    "sum_total_units_ads": "unitssoldclicks7d",
}


def _with_pnl(ads: DataFrame, results: DataFrame, as_of: dt.date) -> DataFrame:
    """Advertisement totals next to each distinct P&L row of the article's current month.

    Advertisements are summed before the join. A P&L row that occurs several times counts
    the advertisement as often, as joining first would.
    """
    totals = ads.groupBy(*[F.col(c).alias(out) for out, c in _GRAIN.items()]).agg(
        *[F.sum(c).alias(out) for out, c in _SUMS.items()]
    )
    month = (F.col("year_pdt") == as_of.year) & (F.col("month") == as_of.month)
    pnl = (
        results.filter(month)
        .groupBy("asin", *PNL_COLUMNS)
        .agg(F.count(F.lit(1)).alias("__times"))
    )
    joined = enrich(
        totals,
        [
            DimJoin(
                pnl,
                {"advertised_asin": "asin"},
                {**{c: c for c in PNL_COLUMNS}, "__times": "__times"},
            )
        ],
    )
    times = F.coalesce(F.col("__times"), F.lit(1))
    joined = joined.withColumns({c: F.col(c) * times for c in _SUMS})
    sales, spend = F.col("sum_total_sales_ads"), F.col("sum_spend")
    units = F.col("sum_total_units_ads")
    profit = ad_profit(sales, spend, F.col("avg_fee"), F.col("avg_cost_per_unit"), units)

    def share(part: Column, whole: Column) -> Column:
        return safe_div(part.cast("double"), whole.cast("double"))

    return joined.withColumn("profit_ads", profit).withColumns(
        {
            "perc_cnt_ads_sales": share(units, F.col("quantity_purchased")),
            "perc_sum_ads_sales": share(sales, F.col("principal")),
            "perc_sum_profit": share(F.col("profit_ads"), F.col("month_gross_margin")),
            "roas": share(sales, spend),
            "acos": share(spend, sales),
        }
    )


def ad_efficiency(
    ads_us: DataFrame,
    results_us: DataFrame,
    planning_us: DataFrame,
    ads_ca: DataFrame,
    results_ca: DataFrame,
    brands: DataFrame,
    as_of: dt.date,
    ordered: bool = True,
) -> DataFrame:
    """Spend, attributed sales, profit and shares per advertisement, US and CA together.

    The product group (US only) is the one of the article's newest planning snapshot; team
    and brand follow from the leading part of the sku.
    """
    group = latest_per_key(planning_us, ["asin"], ["snapshot_date"], ["product_group"])
    us = enrich(
        _with_pnl(ads_us, results_us, as_of),
        [
            DimJoin(
                group, {"advertised_asin": "asin"}, {"product_group": "product_group"}, split=True
            )
        ],
    )
    ca = _with_pnl(ads_ca, results_ca, as_of).withColumn(
        "product_group", F.lit(None).cast(us.schema["product_group"].dataType)
    )
    both = union_labelled({"US": us, "CA": ca}, "marketplace")
    report = enrich(
        both.withColumn("__brand", brand_prefix(F.col("advertised_sku"))),
        [DimJoin(brands, {"__brand": "brand_id"}, {"brand_id": "brand_id", "team": "team"})],
    ).select(
        "ad_id",
        "advertised_sku",
        "start_date",
        "end_date",
        *_SUMS,
        "profit_ads",
        "perc_cnt_ads_sales",
        "perc_sum_ads_sales",
        "perc_sum_profit",
        *PNL_COLUMNS,
        "product_group",
        "marketplace",
        "brand_id",
        "team",
        "roas",
        "acos",
    )
    if not ordered:
        return report
    # sku and ad let the sort split the many advertisements without spend
    spend = F.col("sum_spend").desc_nulls_last()
    return report.orderBy("marketplace", spend, "advertised_sku", "ad_id")
