"""Claims for destroyed stock and what reimbursements finally brought in."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import has_value, lacks_value, safe_div
from ..operators.intervals import anti_within_days
from ..operators.joins import reversal_join
from ..operators.unions import union_all
from ..sources import trailing_days

# Codes of the ledger and of the reimbursement table.
DESTROYED = "D"
WAREHOUSE_DAMAGE = "Damaged_Warehouse"
SELLER_FAULT = ("DEFECTIVE", "DISTRIBUTOR_DAMAGED", "CUSTOMER_DAMAGED")
TAKEN_BACK = ("Reimbursement_Reversal", "Payment_Retraction")
NO_ID = 1

# Output columns of the ledger report.
LEDGER_COLUMNS = (
    "date_correct", "fnsku", "asin", "msku", "reference_id", "quantity", "disposition",
    "reason", "reconciled_quantity", "unreconciled_quantity",
)


def destroyed_unreimbursed(
    ledgers: Mapping[str, DataFrame],
    reimbursements: Mapping[str, DataFrame],
    as_of: dt.date | None = None,
    window: tuple[int, int] = (6, 5),
    claim_days: int = 30,
    null_aware: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """Destroyed units of the reported days that no reimbursement followed within 30 days.

    Both mappings hold one table per market. The reported days are
    ``(as_of - window[0], as_of - window[1]]``; without ``as_of`` the whole ledger is
    reported.
    """
    parts = []
    for market, ledger in ledgers.items():
        events = ledger.filter(F.col("reason") == DESTROYED)
        records = reimbursements[market].filter(F.col("reason") == WAREHOUSE_DAMAGE)
        reported = events if as_of is None else trailing_days(events, "date_correct", as_of, *window)
        reported = reported.filter(~F.col("disposition").isin(*SELLER_FAULT))
        open_claims = anti_within_days(
            reported.select(*LEDGER_COLUMNS),
            events.select("asin", "fnsku", "date_correct", "reference_id"),
            records.select("asin", "fnsku", "approval_date"),
            on=["asin", "fnsku"],
            event_date="date_correct",
            record_date="approval_date",
            days=claim_days,
            id_col="reference_id",
            null_aware=null_aware,
        )
        parts.append(open_claims.withColumn("date_correct", F.to_date("date_correct")))
    report = union_all(parts)
    if not ordered:
        return report
    # the reference id lets the sort split an article with very many events of one day
    return report.orderBy(
        F.col("date_correct").desc_nulls_last(), F.col("asin").asc_nulls_last(), "reference_id"
    )


def reimbursement_net(
    reimbursements: DataFrame, repeat_originals: bool = True, ordered: bool = True
) -> DataFrame:
    """Approved, reversed and net reimbursements per month.

    With ``repeat_originals`` an original counts once per reversal in the approved amount,
    as a plain join of originals to reversals has it; without, it counts once.
    """
    originals = has_value(F.col("case_id"), NO_ID) & lacks_value(
        F.col("original_reimbursement_id"), NO_ID
    )
    keys = ["asin", "fnsku"]
    claims = reversal_join(
        reimbursements,
        "reimbursement_id",
        "original_reimbursement_id",
        keys,
        F.col("reason").isin(*TAKEN_BACK),
        "amount_total",
    ).filter(originals)
    repeats = F.greatest(F.col("n_reversals"), F.lit(1)) if repeat_originals else F.lit(1)
    # one row per id first: counting ids is then plain, and no row is copied per distinct count
    per_id = claims.groupBy("year", "month", *keys, "reimbursement_id").agg(
        F.max(F.when(F.col("n_reversals") > 0, 1)).alias("reversed"),
        F.sum(F.col("amount_total") * repeats).alias("gross"),
        F.sum("reversed_amount").alias("taken_back"),
    )
    known = F.col("reimbursement_id").isNotNull()
    per_article = (
        per_id.groupBy("year", "month", *keys)
        .agg(
            F.count(F.when(known, 1)).alias("claims"),
            F.count(F.when(known, F.col("reversed"))).alias("reversed"),
            F.sum("gross").alias("gross"),
            F.coalesce(F.sum("taken_back"), F.lit(0)).alias("taken_back"),
        )
        .withColumn("net", F.col("gross") + F.col("taken_back"))
    )
    report = per_article.groupBy("year", "month").agg(
        F.sum("claims").alias("sum_cnt_reimbursement_id"),
        F.sum("reversed").alias("sum_cnt_negative_reimbursement_id"),
        (F.sum("claims") - F.sum("reversed")).alias("net_cnt_reimbursements"),
        F.sum("gross").alias("sum_reim_with_case_id"),
        F.sum("taken_back").alias("sum_error_reimb"),
        F.sum("net").alias("sum_net_profit"),
        safe_div(F.sum("net").cast("double"), F.sum("claims")).alias("profit_per_net_profit"),
    )
    return report.orderBy("year", "month") if ordered else report
