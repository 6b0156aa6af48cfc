"""Stock value by age, fee changes, unit-cost gaps and restock signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import brand_prefix, safe_div
from ..operators.aggregates import aging_value
from ..operators.dedup import latest_per_key
from ..operators.joins import DimJoin, enrich
from ..operators.series import nearest_fill, period_delta
from ..operators.skew import spread
from ..operators.unions import union_all
from ..sources import latest_snapshot, window_to_max

# Age buckets of the planning table and the teams of the report.
AGE_BUCKETS = (
    "inv_age_0_to_90_days", "inv_age_91_to_180_days", "inv_age_181_to_270_days",
    "inv_age_271_to_365_days", "inv_age_365_plus_days",
)
TEAMS = ("ADAE", "SF", "AE", "YK", "VH", "OR", "RB")
SELLABLE = "New"

# Which payment rows are fulfilment fees.
FEE_ROWS = {"transaction_type": "Order", "currency": "USD", "amount_type": "ItemFees"}
FEE_PREFIX = "FBA"

# Order status and stock columns of the restock report.
SHIPPED = "Shipped"
ON_HAND = ("afn-fulfillable-quantity", "afn-reserved-quantity")
INBOUND = (
    "afn-inbound-working-quantity", "afn-inbound-shipped-quantity",
    "afn-inbound-receiving-quantity",
)


def inventory_aging_value(
    planning: DataFrame,
    supplier_orders: DataFrame,
    teams: Sequence[str] = TEAMS,
    tie_break: Sequence[str] = ("team",),
    ordered: bool = True,
) -> DataFrame:
    """Value per age bucket of the newest snapshot, by the article's latest buying team.

    Unit cost is the plain mean over all purchase orders, whichever team placed them.
    """
    stock = latest_snapshot(planning, "snapshot_date").filter(F.col("condition") == SELLABLE)
    team = latest_per_key(
        supplier_orders.filter(F.col("team").isin(*teams)), ["asin"], ["date"], tie_break
    ).select("asin", "team")
    cost = supplier_orders.groupBy("asin").agg(F.avg("cost_per_item").alias("unit_cost"))
    by_article = enrich(
        team, [DimJoin(cost, {"asin": "asin"}, {"unit_cost": "unit_cost"}, split=True)]
    )
    valued = aging_value(
        enrich(
            stock,
            [
                DimJoin(
                    by_article,
                    {"asin": "asin"},
                    {"team": "team", "unit_cost": "unit_cost"},
                    split=True,
                )
            ],
        ),
        {f"{b}_usd": b for b in AGE_BUCKETS},
        "unit_cost",
    )
    report = (
        valued.groupBy("snapshot_date", "team", "asin")
        .agg(*[F.sum(f"{b}_usd").alias(f"{b}_usd") for b in AGE_BUCKETS])
        .withColumn("snapshot_date", F.to_date("snapshot_date"))
    )
    return report.orderBy(F.col("team").asc_nulls_last(), "asin") if ordered else report


def fee_changes(
    payments: DataFrame, settlements: DataFrame, sku_asin: DataFrame, ordered: bool = True
) -> DataFrame:
    """Each change of a unit fee from one settlement to the next, per article, sku and fee.

    Fees are averaged per settlement before the lookups join, so these meet one row per
    settlement, sku and fee. Lookups are made distinct: a repeated row must not repeat a
    period.
    """
    rows = payments
    for col, value in FEE_ROWS.items():
        rows = rows.filter(F.col(col) == value)
    rows = rows.filter(F.col("amount_description").startswith(FEE_PREFIX))
    unit_fee = safe_div(F.col("amount"), F.col("quantity_purchased"))
    periods = rows.groupBy("settlement_id", "sku", "amount_description").agg(
        F.avg(unit_fee).alias("avg_fee_per_item")
    )
    dates = ["settlement_start_date", "settlement_end_date"]
    named = enrich(
        periods,
        [
            DimJoin(
                settlements.select("settlement_id", *dates).distinct(),
                {"settlement_id": "settlement_id"},
                {d: d for d in dates},
            ),
            DimJoin(sku_asin.select("sku", "asin").distinct(), {"sku": "sku"}, {"asin": "asin"}),
        ],
    )
    keys = ["asin", "sku", "amount_description"]
    changes = period_delta(
        named, keys, [dates[0], "settlement_id"], "avg_fee_per_item", negate=True
    ).select(
        "row_num",
        "settlement_id",
        *dates,
        *keys,
        "avg_fee_per_item",
        "previous_avg_fee_per_item",
        "difference",
        "difference_percent",
    )
    if not ordered:
        return changes
    return changes.orderBy(F.col("asin").asc_nulls_last(), "sku", "row_num", "amount_description")


def cost_gap_fill(
    series: DataFrame,
    value: str = "avg_cost_per_item_month",
    ordered: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Every month without a unit cost, with the nearest known cost of the same year.

    All windows partition by the sku or finer, so the series is shuffled once. For ordered
    output that one shuffle is by ranges of the sku, which the final sort then reuses. ``partitions``
    is for a long series: how many parts it is cut into, the session's number by default.
    """
    if ordered:
        series = series.repartitionByRange(*([partitions] if partitions else []), "sku")
    else:
        series = spread(series, partitions, "sku")
    filled = nearest_fill(
        series, ["sku"], "month_", value, bound=["year_"], neighbours=True
    ).select(
        "sku",
        "year_",
        "month_",
        value,
        F.col(f"next_{value}").alias("next_not_zero_value"),
        F.col("next_month_").alias("next_not_zero_month"),
        F.col(f"prev_{value}").alias("prev_not_zero_value"),
        F.col("prev_month_").alias("previous_not_zero_month"),
        "pk",
        F.col("fill_pk").alias("pk_cross_join"),
        F.col(f"fill_{value}").alias(f"{value}_cross_join"),
    )
    return filled.orderBy("sku", "year_", "month_") if ordered else filled


def _stock(inventory: DataFrame, brands: DataFrame, date_col: str) -> DataFrame:
    """Newest stock per sku and the team of its brand; a NULL quantity voids its row's sum."""
    on_hand = sum((F.col(f"`{c}`") for c in ON_HAND[1:]), F.col(f"`{ON_HAND[0]}`"))
    inbound = sum((F.col(f"`{c}`") for c in INBOUND[1:]), F.col(f"`{INBOUND[0]}`"))
    current = window_to_max(inventory, date_col, 1)
    per_sku = (
        current.groupBy("sku")
        .agg(F.sum(on_hand).alias("active_inventory"), F.sum(inbound).alias("inbound_quantity"))
        .withColumn("__brand", brand_prefix(F.col("sku")))
    )
    named = enrich(per_sku, [DimJoin(brands, {"__brand": "brand_id"}, {"team": "team"})])
    # a brand listed twice under one team repeats the stock of its skus in the sums
    return named.groupBy("sku", "team").agg(
        F.sum("active_inventory").alias("active_inventory"),
        F.sum("inbound_quantity").alias("inbound_quantity"),
    )


def restock_signal(
    orders: Mapping[str, DataFrame],
    inventory: Mapping[str, DataFrame],
    brands: DataFrame,
    windowed: Sequence[str] = ("US",),
    days: int = 7,
    inclusive_start: bool = True,
    factor: int = 4,
    snapshot_label: Mapping[str, str] | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Stock on hand and inbound against projected sales, lowest cover first.

    Markets in ``windowed`` project from the last ``days`` days (with ``inclusive_start``
    the day before them too), the others from all their orders. ``snapshot_label`` names a
    market's date column behind ``inventory_snapshot_date`` where it is not ``report_date``.
    """
    parts = []
    for market, sales in orders.items():
        newest = sales.select(F.to_date(F.max("purchase_date"))).scalar()
        label = (snapshot_label or {}).get(market, "report_date")
        snapshot = inventory[market].select(F.to_date(F.max(label))).scalar()
        start = F.lit(None).cast("date")
        recent = sales
        if market in windowed:
            # one bound: the stamp shows the first day that the filter lets through
            start = F.date_sub(newest, days if inclusive_start else days - 1)
            kind = sales.schema["purchase_date"].dataType
            recent = sales.filter(F.col("purchase_date") >= start.cast(kind))
        shipped = (
            recent.filter(F.col("order_status") == SHIPPED)
            .groupBy("sku")
            .agg(F.sum("quantity").alias("shipped_quantity_sum"))
            .withColumn("projected_sales", F.col("shipped_quantity_sum") * F.lit(factor))
        )
        stock = ["team", "active_inventory", "inbound_quantity"]
        joined = enrich(
            shipped,
            [
                DimJoin(
                    _stock(inventory[market], brands, "report_date"),
                    {"sku": "sku"},
                    {c: c for c in stock},
                )
            ],
        )
        available = F.col("active_inventory") + F.col("inbound_quantity")
        parts.append(
            joined.select(
                newest.alias("max_purchased_date"),
                start.alias("window_start_date"),
                snapshot.alias("inventory_snapshot_date"),
                "team",
                "sku",
                "shipped_quantity_sum",
                "projected_sales",
                "active_inventory",
                "inbound_quantity",
                available.alias("total_available"),
                (available - F.col("projected_sales")).alias("days_of_supply_signal"),
            )
        )
    report = union_all(parts)
    if not ordered:
        return report
    # the sku lets the sort split the many rows without a signal
    return report.orderBy(F.col("days_of_supply_signal").asc_nulls_last(), "sku")
