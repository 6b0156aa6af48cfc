"""Reports on hand-made input tables holding the awkward cases."""

import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from martloom.plans import (
    Market,
    account_open_events,
    ad_efficiency,
    contact_rate_by_category,
    cost_gap_fill,
    destroyed_unreimbursed,
    early_repayment_events,
    fee_changes,
    inventory_aging_value,
    load_account_day,
    read_account_feed,
    merged_tickets,
    monthly_pnl,
    newly_profitable,
    reimbursement_net,
    restock_signal,
    tickets_monthly_pivot,
)
from martloom.plans.inventory import AGE_BUCKETS
from martloom.plans.pnl import ORDER_FEES, REFUND_FEES, REFUND_TAXES, REPORT_MEASURES

D, T = dt.date, dt.datetime


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ── monthly profit and loss ──────────────────────────────────────────────────────────────


@pytest.fixture(scope="module")
def pnl(frame):
    ym = "year_pdt int, month int"
    fees = ", ".join(f"{c} decimal(18,2)" for c in ORDER_FEES)
    refunds = ", ".join(f"{c} decimal(18,2)" for c in REFUND_FEES)

    def fee_row(names, order, sku, **values):
        return (order, sku, *[Dec(values[c]) if c in values else None for c in names])

    return {
        "sku_asin": frame(
            "sku string, asin string", ("s1", "A"), ("s2", "A"), ("s3", "B"), ("s4", None)
        ),
        "returns_repackaged": frame(
            f"sku string, {ym}, q_repackaged long", ("s1", 2023, 5, 2), ("s2", 2023, 5, 3), ("zz", 2023, 5, 9)
        ),
        "returns_sellable": frame(f"sku string, {ym}, q_sellable_returns long", ("s4", 2023, 5, 1)),
        "removals": frame(
            f"sku string, asin string, {ym}, q_removed long, removal_fee decimal(18,2)",
            ("s1", "B", 2023, 5, 1, Dec("1.50")),  # mapping wins over the row's own article
            ("zz", "B", 2023, 5, 4, Dec("0.25")),  # own article
            ("zz", None, 2023, 5, 8, Dec("9.99")),  # neither
        ),
        "reim_inventory": frame(
            f"asin string, {ym}, amount_reim decimal(18,2), q_reim_cash long, q_reim_inv long",
            ("B", 2023, 5, Dec("7.00"), 1, 2),
        ),
        "reim_returns": frame(f"asin string, {ym}, amount_reim_2 decimal(18,2), q_reim_cash_0 long"),
        "order_dates": frame(
            f"order_id string, sku string, {ym}",
            ("o1", "s1", 2023, 5), ("o1", "s3", 2023, 5), ("o2", "s2", 2023, 5), ("o3", "s1", 2023, 5),
        ),
        "order_quantities": frame(
            "order_id string, sku string, quantity_purchased long",
            ("o1", "s1", 2), ("o1", "s3", 1), ("o2", "s2", None), ("o4", "s1", 50),
        ),
        "order_fees": frame(
            f"order_id string, sku string, {fees}",
            fee_row(ORDER_FEES, "o1", "s1", Principal="10.00", Tax="1.00", Commission="-2.00",
                    LowValueGoods_Principal="0.50", MarketplaceFacilitatorTax_Other="-1.00"),
            fee_row(ORDER_FEES, "o1", "s3", Principal="5.00"),
            fee_row(ORDER_FEES, "o2", "s2", Principal="4.00", ShippingTax="0.10"),
            fee_row(ORDER_FEES, "o3", "s1", Principal="99.00"),  # no quantity row
        ),
        "refund_dates": frame(
            f"order_id string, sku string, {ym}", ("o1", "s1", 2023, 6), ("o9", "s3", 2023, 6)
        ),
        "refund_fees": frame(
            f"order_id string, sku string, {refunds}",
            fee_row(REFUND_FEES, "o1", "s1", RefundPrincipal="-10.00", RefundTax="-1.00"),
        ),
        "discrepancies": frame(
            f"asin string, {ym}, qty_adjustment long, supplier_reimbursement decimal(18,2), "
            "amount_adjustment decimal(18,2)",
            ("A", 2023, 5, 1, Dec("1.00"), Dec("2.00")), ("A", 2023, 5, 2, None, Dec("3.00")),
        ),
        "supplier_orders": frame(
            "date string, asin string, q long, cogs decimal(18,4)",
            ("2023-05-31", "A", 10, Dec("1.2345")), ("2023-05-01", "A", 5, Dec("1.0000")),
        ),
        "orders_ca": frame(
            f"asin string, {ym}, amount_ca_gs_usd decimal(18,2), quantity_purchased_ca_gs long"
        ),
        "refunds_ca": frame(f"asin string, {ym}, refund_amount_ca_gs_usd decimal(18,2)"),
        "orders_mx": frame(
            f"asin string, {ym}, amount_mx_gs_usd decimal(18,2), quantity_purchased_mx_gs long"
        ),
        "refunds_mx": frame(f"asin string, {ym}, refund_amount_mx_gs_usd decimal(18,2)"),
    }


def test_monthly_pnl(pnl):
    report = monthly_pnl(**pnl, years=[2023], ordered=True)
    assert report.columns == ["asin", "year_", "month_", *REPORT_MEASURES]
    got = {(r.asin, r.month_): r.asDict() for r in report.collect()}
    assert len(got) == 3 * 12  # A, B and the NULL article
    a = got["A", 5]
    want = {
        "q_repackaged": 5, "q_sellable_returns": 0, "q_removed": 1, "removal_fee": Dec("1.50"),
        "quantity_purchased": 2, "principal": Dec("14.00"), "tax_total": Dec("1.10"),
        "amount": Dec("12.60"), "tax_collected_amz": Dec("-0.50"), "tax_remitted": Dec("0.60"),
        "amount_2": Dec("12.00"), "revenue_unadjusted": Dec("15.10"),
        "Referral_fee_total": Dec("-2.00"), "qty_adjustment": 3,
        "supplier_reimbursement": Dec("1.00"), "amount_adjustment": Dec("5.00"), "q": 15,
        "cogs": Dec("2.23"), "amount_ca_gs_usd": 0,
    }
    assert {k: a[k] for k in want} == want
    june = got["A", 6]
    assert (june["Refunded_amount"], june["refund_tax_total"]) == (Dec("-11.00"), Dec("-1.00"))
    assert june["Refundamount_Adj"] == Dec("-10.00")
    b = got["B", 5]
    assert (b["q_removed"], b["principal"], b["q_reim_inv"]) == (4, Dec("5.00"), 2)
    silent = got["B", 1]
    assert all(silent[m] == 0 for m in REPORT_MEASURES)
    assert all(got[None, m][c] == 0 for m in range(1, 13) for c in REPORT_MEASURES)


# The fee columns of the settlement tables.
ORDER_FEES_WANTED = """
Commission FBAPerOrderFulfillmentFee FBAPerUnitFulfillmentFee FBAWeightBasedFee GiftWrap
GiftWrapTax GiftwrapChargeback LowValueGoods_Principal LowValueGoods_Shipping
LowValueGoodsTax_Other LowValueGoodsTax_Principal LowValueGoodsTax_Shipping
MarketplaceFacilitatorTax_Other MarketplaceFacilitatorTax_Principal
MarketplaceFacilitatorTax_Shipping MarketplaceFacilitatorVAT_Principal
MarketplaceFacilitatorVAT_Shipping Principal Promotion_Principal Promotion_Shipping
SalesTaxServiceFee Shipping ShippingChargeback ShippingHB ShippingTax Tax VariableClosingFee
""".split()
REFUND_FEES_WANTED = """
RefundTax RefundPrincipal RefundMarketplaceFacilitatorTax_Principal RefundCommission
RefundRefundCommission RefundShippingTax RefundShipping
RefundMarketplaceFacilitatorTax_Shipping RefundShippingChargeback RefundGoodwill
RefundVariableClosingFee RefundPromotion_Shipping RefundPromotion_Principal RefundRestockingFee
RefundMarketplaceFacilitatorTax_RestockingFee RefundMarketplaceFacilitatorTax_Other
RefundMarketplaceFacilitatorVAT_Shipping RefundMarketplaceFacilitatorVAT_Principal
RefundGiftWrap RefundGiftwrapChargeback RefundGiftWrapTax RefundShippingHB
RefundLowValueGoodsTax_Shipping RefundLowValueGoodsTax_Principal
""".split()
REFUND_TAXES_WANTED = """
RefundShippingTax RefundGiftWrapTax RefundLowValueGoodsTax_Principal
RefundMarketplaceFacilitatorTax_Other RefundTax RefundMarketplaceFacilitatorTax_Principal
RefundMarketplaceFacilitatorTax_RestockingFee RefundLowValueGoodsTax_Shipping
RefundMarketplaceFacilitatorTax_Shipping
""".split()


def test_fee_lists_are_these():
    assert list(ORDER_FEES) == list(ORDER_FEES_WANTED)
    assert list(REFUND_FEES) == list(REFUND_FEES_WANTED)
    assert list(REFUND_TAXES) == list(REFUND_TAXES_WANTED)


def test_calendar_covers_every_year_of_the_inputs(frame, pnl):
    late = frame("sku string, year_pdt int, month int, q_repackaged long", ("s1", 2031, 2, 4))
    report = monthly_pnl(**{**pnl, "returns_repackaged": pnl["returns_repackaged"].union(late)})
    found = {(r.asin, r.year_, r.month_): r.q_repackaged for r in report.filter("q_repackaged > 0").collect()}
    assert found == {("A", 2023, 5): 5, ("A", 2031, 2): 4}
    assert {r.year_ for r in report.select("year_").distinct().collect()} == set(range(2023, 2032))


def test_second_row_of_an_aggregated_input_is_reported(pnl):
    twice = {**pnl, "reim_inventory": pnl["reim_inventory"].union(pnl["reim_inventory"])}
    with pytest.raises(Exception, match="duplicate article and month in reim_inventory"):
        monthly_pnl(**twice, years=[2023]).collect()


def test_fee_lists_are_complete():
    assert (len(ORDER_FEES), len(REFUND_FEES), len(REFUND_TAXES)) == (27, 24, 9)
    assert len(set(ORDER_FEES)) == 27 and set(REFUND_TAXES) < set(REFUND_FEES)
    assert len(REPORT_MEASURES) == 36


# ── newly profitable ─────────────────────────────────────────────────────────────────────


def test_newly_profitable(frame):
    def results(*data):
        return frame(
            "team string, asin string, year_pdt int, month int, principal decimal(18,2), "
            "amount_reim decimal(18,2), month_gross_margin decimal(18,2)",
            *[(t, a, y, m, Dec(10), Dec(1), None if g is None else Dec(g)) for t, a, y, m, g in data],
        )

    df = results(
        ("t1", "zero", 2023, 7, "0.10"), ("t1", "zero", 2023, 8, "0.20"), ("t2", "zero", 2023, 9, "-0.30"),
        ("t1", "zero", 2024, 1, "5"), ("t1", "zero", 2024, 1, "-1"), ("t2", "zero", 2024, 2, "-3"),
        ("t1", "none", 2024, 1, "5"),  # no prior rows
        ("t1", "loss", 2023, 12, "0"), ("t1", "loss", 2024, 3, "-5"),  # no gain
        ("t1", "rich", 2023, 12, "4"), ("t1", "rich", 2024, 3, "5"),
        ("t1", "None", 2023, 12, "0"), ("t1", "None", 2024, 3, "5"),
        ("t1", "null", 2023, 12, None), ("t1", "null", 2024, 3, "5"),  # total unknown
        ("t1", "zero", 2024, 4, "100"),  # outside both periods
    )
    us = Market(df, ((2024, 1), (2024, 3)), ((2023, 7), (2023, 12)))
    got = [tuple(r) for r in newly_profitable([us]).collect()]
    assert got == [
        ("t1", "zero", Dec(20), Dec(2), Dec(4), Dec(2)),
        ("t2", "zero", Dec(10), Dec(1), Dec(-3), Dec(-4)),
    ]
    ca = results(("t", "x", 2023, 10, "0"), ("t", "x", 2024, 2, "0"), ("t", "x", 2024, 3, "1"))
    ca = Market(ca, ((2024, 3), (2024, 3)), ((2023, 9), (2024, 2)))
    assert [r.asin for r in newly_profitable([us, ca]).collect()] == ["zero", "x", "zero"]


# ── reimbursements ───────────────────────────────────────────────────────────────────────


@pytest.fixture(scope="module")
def ledger(frame):
    def build(*data):
        return frame(
            "date_correct timestamp, fnsku string, asin string, msku string, reference_id string, "
            "quantity long, disposition string, reason string, reconciled_quantity long, "
            "unreconciled_quantity long",
            *[(d, f, a, "m", ref, 1, disp, why, 1, 0) for d, f, a, ref, disp, why in data],
        )

    return build


def test_destroyed_unreimbursed(frame, ledger):
    at = T(2024, 6, 10, 15)  # as_of - 5
    us = ledger(
        (at, "f", "a", "open", "SELLABLE", "D"),
        (at, "f", "paid", "paid", "SELLABLE", "D"),
        (at, "f", "late", "late", "SELLABLE", "D"),
        (at, "f", "a", "bad", "DEFECTIVE", "D"),
        (at, "f", "a", "unknown", None, "D"),
        (at, "f", "a", "other", "SELLABLE", "E"),
        (T(2024, 6, 9, 23, 59), "f", "a", "before", "SELLABLE", "D"),  # as_of - 6
        (T(2024, 6, 11), "f", "a", "after", "SELLABLE", "D"),  # as_of - 4
        (at, "f", "a", "twice", "SELLABLE", "D"),
        (T(2024, 1, 1), "f", "old", "twice", "SELLABLE", "D"),  # matched long ago
        (at, None, "paid", "nokey", "SELLABLE", "D"),
    )
    reim = frame(
        "approval_date timestamp, fnsku string, asin string, reason string",
        (T(2024, 7, 10, 1), "f", "paid", "Damaged_Warehouse"),  # day 30
        (T(2024, 7, 11), "f", "late", "Damaged_Warehouse"),  # day 31
        (T(2024, 6, 10), "f", "a", "Lost_Warehouse"),
        (T(2024, 1, 1), "f", "old", "Damaged_Warehouse"),  # day 0
        (T(2024, 6, 10), None, "paid", "Damaged_Warehouse"),
    )
    got = destroyed_unreimbursed({"US": us}, {"US": reim}, as_of=D(2024, 6, 15))
    assert sorted(r.reference_id for r in got.collect()) == ["late", "nokey", "open"]
    assert {r.date_correct for r in got.collect()} == {D(2024, 6, 10)}
    both = destroyed_unreimbursed({"CA": us, "US": us}, {"CA": reim, "US": reim}, as_of=D(2024, 6, 15))
    assert both.count() == 6


def test_matched_null_reference_empties_the_report(frame, ledger):
    us = ledger(
        (T(2024, 6, 10), "f", "a", "open", "SELLABLE", "D"),
        (T(2024, 6, 10), "f", "b", None, "SELLABLE", "D"),
    )
    reim = frame(
        "approval_date timestamp, fnsku string, asin string, reason string",
        (T(2024, 6, 10), "f", "b", "Damaged_Warehouse"),
    )
    args = ({"US": us}, {"US": reim}, D(2024, 6, 15))
    assert destroyed_unreimbursed(*args).count() == 0
    assert destroyed_unreimbursed(*args, null_aware=False).count() == 2


def test_reimbursement_net(frame):
    df = frame(
        "year int, month int, reimbursement_id long, original_reimbursement_id long, case_id long, "
        "asin string, fnsku string, reason string, amount_total decimal(18,2)",
        (2024, 1, 10, None, 5, "a", "f", "Damaged_Warehouse", Dec(100)),
        (2024, 1, 11, None, 5, "b", "f", "Damaged_Warehouse", Dec(50)),
        (2024, 1, 12, None, None, "a", "f", "Damaged_Warehouse", Dec(7)),  # no case
        (2024, 1, 13, None, 1, "a", "f", "Damaged_Warehouse", Dec(7)),  # sentinel case
        (2024, 1, 14, 1, 5, "c", "f", "Damaged_Warehouse", Dec(5)),  # sentinel original
        (2024, 3, 20, 10, None, "a", "f", "Reimbursement_Reversal", Dec(-30)),
        (2024, 4, 21, 10, None, "a", "f", "Payment_Retraction", Dec(-20)),
        (2024, 4, 22, 11, None, None, "f", "Reimbursement_Reversal", Dec(-9)),  # no article
        (2024, 4, 23, 11, None, "b", "f", "Other", Dec(-9)),
        (2024, 5, 24, None, 6, "a", "f", "Payment_Retraction", Dec(-40)),  # counts as original
    )
    got = [tuple(r) for r in reimbursement_net(df).collect()]
    assert got == [
        (2024, 1, 3, 1, 2, Dec(255), Dec(-50), Dec(205), 205 / 3),
        (2024, 5, 1, 0, 1, Dec(-40), Dec(0), Dec(-40), -40.0),
    ]
    once = reimbursement_net(df, repeat_originals=False).collect()[0]
    assert once.sum_reim_with_case_id == Dec(155)


# ── inventory ────────────────────────────────────────────────────────────────────────────


def test_inventory_aging_value(frame):
    cols = ", ".join(f"{b} long" for b in AGE_BUCKETS)
    planning = frame(
        f"snapshot_date date, asin string, condition string, {cols}",
        (D(2024, 1, 1), "old", "New", 9, 9, 9, 9, 9),
        (D(2024, 2, 1), "a", "New", 1, None, 0, 0, 2),
        (D(2024, 2, 1), "a", "Used", 5, 5, 5, 5, 5),
        (D(2024, 2, 1), "noteam", "New", 1, 1, 1, 1, 1),
    )
    bought = frame(
        "date date, asin string, team string, cost_per_item decimal(18,2)",
        (D(2023, 1, 1), "a", "SF", Dec(2)),
        (D(2023, 5, 1), "a", "YK", Dec(4)),
        (D(2023, 5, 1), "a", "AE", Dec(6)),  # same day: least name
        (D(2023, 9, 1), "a", "XX", Dec(8)),  # not a report team, but counts for cost
    )
    got = rows(inventory_aging_value(planning, bought))
    assert [(r[0], r[1], r[2], [float(x) for x in r[3:]]) for r in got] == [
        (D(2024, 2, 1), "AE", "a", [5, 0, 0, 0, 10]),
        (D(2024, 2, 1), None, "noteam", [0, 0, 0, 0, 0]),
    ]
    used = planning.withColumn("condition", F.lit("Used"))
    assert inventory_aging_value(used, bought).count() == 0


def test_fee_changes(frame):
    def pay(sid, fee, qty, sku="s", kind="FBAFee", **other):
        base = {"currency": "USD", "transaction_type": "Order", "amount_type": "ItemFees"} | other
        return (sid, *base.values(), kind, sku, None if fee is None else Dec(fee), qty)

    payments = frame(
        "settlement_id long, currency string, transaction_type string, amount_type string, "
        "amount_description string, sku string, amount decimal(18,2), quantity_purchased long",
        pay(1, "-3.00", 1), pay(1, "-10.00", 2),  # mean of ratios: -4.00
        pay(1, "-99.00", 0),  # no quantity
        pay(2, "-8.00", 2),  # unchanged
        pay(3, "-5.00", 1), pay(3, "-5.00", 1, currency="CAD"), pay(3, "-9.00", 1, kind="fbaFee"),
        pay(3, "-7.00", 1, transaction_type="Refund"),
        pay(4, "-4.50", 1),  # same start as 3: ordered by settlement
    )
    meta = frame(
        "settlement_id long, settlement_start_date date, settlement_end_date date",
        *[(i, D(2024, min(i, 3), 1), D(2024, min(i, 3), 15)) for i in (1, 2, 3, 4)],
        (1, D(2024, 1, 1), D(2024, 1, 15)),
    )
    asin = frame("sku string, asin string", ("s", "A"), ("s", "A"))
    got = [
        (r.row_num, r.settlement_id, r.asin, float(r.avg_fee_per_item), float(r.difference), float(r.difference_percent))
        for r in fee_changes(payments, meta, asin).collect()
    ]
    assert got == [(3, 3, "A", -5.0, 1.0, 0.2), (4, 4, "A", -4.5, -0.5, 0.11)]


def test_cost_gap_fill(frame):
    df = frame(
        "sku string, year_ int, month_ int, avg_cost_per_item_month decimal(18,2)",
        ("a", 2023, 12, Dec(9)), ("a", 2024, 1, None), ("a", 2024, 2, Dec(3)),
        ("a", 2024, 3, Dec(0)), ("a", 2024, 4, Dec(5)),
    )
    got = [tuple(r)[:3] + tuple(r)[4:] for r in cost_gap_fill(df).collect()]
    assert got == [
        ("a", 2024, 1, Dec(3), 2, None, None, 2, 2, Dec(3)),
        ("a", 2024, 3, Dec(5), 4, Dec(3), 2, 4, 2, Dec(3)),
        ("a", 2024, 3, Dec(5), 4, Dec(3), 2, 4, 3, Dec(5)),
    ]


def test_restock_signal(frame):
    orders = frame(
        "purchase_date timestamp, sku string, order_status string, quantity long",
        (T(2024, 5, 20, 8), "7-x", "Pending", 1),  # newest order, not shipped
        (T(2024, 5, 13, 0), "7-x", "Shipped", 3),  # max - 7
        (T(2024, 5, 12, 23), "7-x", "Shipped", 50),  # max - 8
        (T(2024, 5, 19), "plain", "Shipped", 2),
        (T(2024, 5, 19), "7-null", "Shipped", 1),
    )
    names = "fulfillable reserved inbound-working inbound-shipped inbound-receiving".split()
    cols = ", ".join(f"`afn-{n}-quantity` long" for n in names)
    stock = frame(
        f"sku string, report_date timestamp, {cols}",
        ("7-x", T(2024, 5, 18, 3), 5, 2, 1, 1, 1),
        ("7-x", T(2024, 5, 17, 3), 500, 2, 1, 1, 1),
        ("7-null", T(2024, 5, 18, 9), 5, None, 1, 1, 1),
    )
    brands = frame("brand_id string, team string", ("7", "T"), ("7", "T"), ("8", "U"))
    us = {r.sku: r for r in restock_signal({"US": orders}, {"US": stock}, brands).collect()}
    x = us["7-x"]
    assert (x.max_purchased_date, x.window_start_date, x.inventory_snapshot_date) == (
        D(2024, 5, 20), D(2024, 5, 13), D(2024, 5, 18),
    )
    # the repeated brand counts the stock twice, as the join does
    assert (x.team, x.shipped_quantity_sum, x.projected_sales, x.active_inventory) == ("T", 3, 12, 14)
    assert (x.total_available, x.days_of_supply_signal) == (20, 8)
    assert us["plain"].days_of_supply_signal is None and us["7-null"].active_inventory is None
    seven = restock_signal({"US": orders}, {"US": stock}, brands, inclusive_start=False)
    assert "7-x" not in {r.sku for r in seven.collect()}
    assert {r.window_start_date for r in seven.collect()} == {D(2024, 5, 14)}
    ca = restock_signal({"CA": orders}, {"CA": stock}, brands).collect()
    assert {r.sku: r.shipped_quantity_sum for r in ca}["7-x"] == 53
    assert all(r.window_start_date is None for r in ca)
    assert ca[-1].days_of_supply_signal is None  # unmatched last


# ── advertising ──────────────────────────────────────────────────────────────────────────


def test_ad_efficiency(frame):
    ads = frame(
        "adid string, advertisedasin string, advertisedsku string, startdate date, enddate date, "
        "spend decimal(18,2), sales7d decimal(18,2), purchases7d long, unitssoldclicks7d long",
        ("1", "a", "7-a", D(2024, 1, 1), D(2024, 1, 31), Dec(10), Dec(60), 2, 3),
        ("1", "a", "7-a", D(2024, 1, 1), D(2024, 1, 31), Dec(10), Dec(40), 1, 2),
        ("2", "nopl", "9", D(2024, 1, 1), D(2024, 1, 31), Dec(5), Dec(0), 0, 0),
    )
    pl = frame(
        "asin string, sku_1 string, year_pdt int, month int, month_gross_margin decimal(18,2), "
        "principal decimal(18,2), quantity_purchased long, avg_price decimal(18,2), "
        "avg_cost_per_unit decimal(18,2), avg_fee decimal(18,2)",
        ("a", "7-a", 2024, 1, Dec(100), Dec(0), 10, Dec(20), Dec(4), Dec(-2)),
        ("a", "7-b", 2024, 1, Dec(100), Dec(0), 10, Dec(20), Dec(4), Dec(-2)),  # same measures
        ("a", "7-c", 2024, 1, Dec(50), Dec(200), 10, Dec(20), Dec(4), Dec(-2)),
        ("a", "7-a", 2023, 1, Dec(1), Dec(1), 1, Dec(1), Dec(1), Dec(1)),
    )
    planning = frame(
        "asin string, snapshot_date date, product_group string",
        ("a", D(2024, 1, 1), "old"), ("a", D(2024, 1, 2), "new"),
    )
    brands = frame("brand_id string, team string", ("7", "T"))
    none_pl = pl.filter("year_pdt = 1")
    report = ad_efficiency(ads, pl, planning, ads, none_pl, brands, D(2024, 1, 20))
    us = {(r.ad_id, r.month_gross_margin): r for r in report.collect() if r.marketplace == "US"}
    assert len(us) == 3
    twice, once = us["1", Dec(100)], us["1", Dec(50)]
    assert (once.sum_spend, once.sum_total_sales_ads, once.profit_ads) == (Dec(20), Dec(100), Dec(50))
    assert twice.sum_spend == Dec(40)  # two equal P&L rows
    assert (once.perc_cnt_ads_sales, once.perc_sum_ads_sales, once.perc_sum_profit) == (0.5, 0.5, 1.0)
    assert twice.perc_sum_ads_sales is None  # principal 0
    assert (once.roas, once.acos) == (5.0, 0.2)
    assert (once.product_group, once.brand_id, once.team) == ("new", "7", "T")
    bare = us["2", None]
    assert (bare.profit_ads, bare.acos, bare.team) == (None, None, None)
    ca = [r for r in report.collect() if r.marketplace == "CA"]
    assert [r.product_group for r in ca] == [None, None]


# ── support ──────────────────────────────────────────────────────────────────────────────


@pytest.fixture(scope="module")
def tickets(frame):
    service = frame(
        "service_number long, interaction_date timestamp, service_type string, "
        "service_folder_2 string, service_channel string",
        (1, T(2020, 1, 2, 2, 59), "Technical issue", "x", "Mail"),  # counts for Jan 1
        (1, T(2020, 1, 2, 3, 0), "Technical issue", "x", "Mail"),
        (2, T(2020, 1, 2, 12), None, "x", "Mail"),
        (3, T(2020, 1, 2, 12), "Test", "x", "Mail"),
        (4, T(2020, 1, 2, 12), "Content", "x", "Bot"),
    )
    workflow = frame(
        "id long, create_date timestamp, last_modified_date timestamp, category_1 string, "
        "category_2 string, application_source string",
        (50, T(2020, 1, 2, 21), T(2020, 1, 3), "Product", "a", "Chat"),  # counts for Jan 3
        (50, T(2020, 1, 2, 22), T(2020, 1, 5), "Content", None, None),  # re-categorised
        (50, T(2020, 1, 2, 23), T(2020, 1, 6), None, "b", None),
    )
    return service, workflow


def test_merged_tickets(tickets):
    got = rows(merged_tickets(*tickets, tie_break=["category_1"]).filter("service_number in (1, 50)"))
    assert got == [
        (1, D(2020, 1, 1), "Technical issue", "x", "Mail"),
        (1, D(2020, 1, 2), "Technical issue", "x", "Mail"),
        (50, D(2020, 1, 3), "Content", "b", "Chat"),
    ]


def test_contact_rate(frame, tickets):
    events = frame(
        "name string, country string, event_date date, user_id long",
        ("view", "Russia", D(2020, 1, 1), 1), ("view", "Russia", D(2020, 1, 1), 1),
        ("view", "Russia", D(2020, 1, 1), 2),  # child of 1
        ("view", "Russia", D(2020, 1, 3), 3), ("view", "Other", D(2020, 1, 3), 9),
        ("click", "Russia", D(2020, 1, 3), 9),
    )
    family = frame("id long, parent_id long", (2, 1))
    got = contact_rate_by_category(
        events, family, *tickets, start=D(2020, 1, 2), as_of=D(2020, 1, 9),
        event_name="view", country="Russia",
    ).collect()
    assert [r.date_events for r in got] == [D(2020, 1, d) for d in range(2, 9)]
    first, third, last = got[0], got[1], got[-1]
    assert first.dau_7day_avg == 1 / 7 and third.dau_7day_avg == 2 / 7
    assert first.cr_technical == (2 / 7) / (1 / 7) * 100000
    assert (first.cr_content, third.cr_content) == (0.0, (1 / 7) / (2 / 7) * 100000)
    assert third.cr_product == 0.0
    # Jan 8: only the events of Jan 3 and tickets of Jan 2 and 3 remain
    assert (last.dau_7day_avg, last.cr_technical) == (1 / 7, 100000.0)


def test_tickets_pivot(tickets):
    wide = tickets_monthly_pivot(*tickets, first_month=D(2020, 1, 1), months=15).collect()
    assert [c for c in wide[0].asDict()][2:5] == ["jan_2020", "feb_2020", "mar_2020"]
    assert len(wide[0]) == 17
    got = {(r.service_type, r.service_folder_2): (r.jan_2020, r.feb_2020) for r in wide}
    assert got == {
        ("Technical issue", "x"): (1, 0), (None, "x"): (1, 0), ("Test", "x"): (1, 0),
        ("Content", "x"): (1, 0), ("Content", "b"): (1, 0),
    }


def test_pivot_months_come_from_the_tickets(frame, tickets):
    service, workflow = tickets
    late = service.limit(1).withColumn("interaction_date", F.lit(T(2031, 3, 5, 12)))
    wide = tickets_monthly_pivot(service.union(late.select(*service.columns)), workflow)
    months = wide.columns[2:]
    assert months[0] == "jan_2020" and months[-1] == "mar_2031" and len(months) == 135


# ── banking ──────────────────────────────────────────────────────────────────────────────

DAY = D(2018, 10, 5)


@pytest.fixture(scope="module")
def bank(frame):
    return {
        "deals": frame(
            "id long, source_id string, deal_fd date, deal_closed_date date, cust_id long, "
            "deal_type_id int, product_id int",
            *[(i, "3C", DAY, None, 100 + i, 1, 11) for i in range(1, 7)],
            (7, "ZZ", DAY, None, 101, 1, 11),  # other source
            (8, "3C", DAY, None, 101, 1, 12),  # other product group
            (9, "3C", D(2018, 10, 4), None, 101, 1, 11),  # other day
        ),
        "deal_types": frame("id int", (1,), (1,)),  # repeated, though nothing is taken from it
        "products": frame("id int, product_group int", (11, 106), (12, 5)),
        "product_groups": frame("id int", (106,), (5,)),
        "customers": frame(
            "id long, hid_party long, fl_del string, party_type string",
            (101, 1, "0", "P"), (102, 2, "1", "P"), (103, 3, "0", "?"),
        ),
        "persons": frame(
            "hid_party long, surname string, name string, patronymic string, is_deleted int",
            (1, "Doe", "Jo", None, 0), (3, None, None, None, 0),
        ),
        "phones": frame(
            "hid_party long, startdate date, countrycode string, telephone string, is_deleted int, "
            "primary_flag int, phone_type int",
            (1, D(2020, 1, 1), "7", "9161234567", 0, 1, 3), (3, D(2020, 1, 1), "7", None, 0, 1, 3),
            (1, D(2010, 1, 1), "7", "0000000000", 0, 0, 3),
        ),
        "party_types": frame("source_name string, type_code string", ("P", "FL")),
        "account_deals": frame("deal_id long, account_id long", *[(i, 10 * i) for i in range(1, 10)]),
        "accounts": frame(
            "id long, open_dt date, source_id string, crnc int",
            *[(10 * i, DAY, "NOM", 810 if i == 1 else 840) for i in range(1, 9) if i != 6],
            (60, D(2018, 10, 6), "NOM", 810),  # opened on another day
        ),
        "deal_operators": frame(
            "deal_id long, operator_id long, d_open date, d_close date, source_id string",
            (1, 1, D(2018, 1, 1), D(2018, 10, 4), "3C"),  # reassigned the day before
            (1, 2, DAY, D(2030, 1, 1), "3C"),
            (3, 4, DAY, DAY, "3C"),
            (4, 3, DAY, DAY, "3C"),  # online operator
            (5, 2, DAY, DAY, "ZZ"), (2, 4, DAY, DAY, "NOM"), (6, 2, DAY, DAY, "3C"),
        ),
        "operators": frame(
            "id long, descr string, source_id string",
            (1, "gone", "3C"), (2, "teller", "3C"), (3, "IBANK", "3C"), (4, "web", "3C"),
        ),
        "deal_contracts": frame("deal_id long, passivedeal_id long", (1, 1001), (3, 1003)),
        "passive_deal_offices": frame(
            "passivedeal_id long, ag_id long, dt_bgn date, dt_end date, source_id string",
            (1001, 5, D(2018, 1, 1), DAY, "3C"), (1003, 5, D(2018, 10, 6), D(2030, 1, 1), "3C"),
        ),
        "offices": frame(
            "id long, mngm_office_id long, ag_addr string, source_id string", (5, 50, "main st", "3C")
        ),
        "office_star": frame("id long, office string, address string", (50, "north", "n st")),
        "operation_map": frame("source_id int, target string", (106, "OP1")),
        "operations": frame(
            "operation_code string, operation_name string, operation_type_name string, "
            "operation_grp_name string", ("OP1", "Open", "Type", "Grp"),
        ),
        "operation_channels": frame("operation_code string", ("OP1",)),
        "channel_map": frame("source string, target string", ("web", "W")),
        "channels": frame("operation_channel_code string, operation_channel_name string", ("W", "Web")),
        "product_validity": frame(
            "contract_id long, account_id long, date_from date, date_to date, contract_type string, "
            "product_group_id long",
            (1001, 10, D(2018, 1, 1), DAY, "P", 7), (1001, 10, D(2018, 1, 1), DAY, "A", 8),
            (900, 77, D(2018, 1, 1), D(2030, 1, 1), "A", 7),
        ),
        "product_star": frame(
            "group3_id long, product_name string, group_name string, group_name2 string, "
            "date_from date, date_to date",
            (7, "current", "loans", "accounts", D(2018, 1, 1), D(2019, 12, 31)),
        ),
    }


def test_account_open_events(bank):
    report = account_open_events(bank, day=DAY)
    assert len(report.columns) == 40
    got = {}
    for r in report.collect():
        got.setdefault(r.OPERATION_ID, []).append(r)
    # 4: online operator, 5: no operator of a known source, 6: account of another day
    assert set(got) == {"10-NOM-OPN", "20-NOM-OPN", "30-NOM-OPN"}
    assert all(len(v) == 2 for v in got.values())  # the repeated deal type
    one, two, three = (got[f"{k}-NOM-OPN"][0] for k in (10, 20, 30))
    assert (one.EMPLOYEE_ID, one.OPERATION_CHANNEL_CODE, one.TARGET_CHANNEL_FLAG) == (2, "Unknown", "Y")
    assert (one.PARTY_FULL_NAME, one.PARTY_PHONE_NO, one.CURRENCY_CODE) == ("DOE JO ", "+7(***)1234567", "RUR")
    assert (one.PRODUCT_NAME, one.PRODUCTGRP_NAME, one.PARTYTYPE_CODE) == ("CURRENT", "ACCOUNTS", "FL")
    assert (one.ORGSTRUCT_BRANCH_ID, one.ORGSTRUCT_BRANCH_NAME, one.ADDINFO_DESC) == ("5", "NORTH", "MAIN ST")
    assert (three.OPERATION_CHANNEL_CODE, three.FRONT_OFFICE_FLAG) == ("Web", "N")
    assert (three.PARTY_FULL_NAME, three.PARTY_PHONE_NO, three.CURRENCY_CODE) == ("N/A", None, None)
    assert (three.ORGSTRUCT_BRANCH_ID, three.PARTYTYPE_CODE, three.PRODUCT_NAME) == (None, None, None)
    assert two.PARTY_ID is None  # deleted customer
    days = account_open_events(bank)
    assert rows(days) == rows(report)  # the only day with both a deal and its account


def test_first_day_holds_for_single_days_too(bank):
    before = dt.timedelta(days=1)
    assert account_open_events(bank, day=DAY, first_day=DAY + before).count() > 0  # still open
    closed = bank["deals"].withColumn("deal_closed_date", F.lit(DAY))
    shut = {**bank, "deals": closed}
    assert account_open_events(shut, day=DAY, first_day=DAY + before).count() == 0
    assert account_open_events(shut, day=DAY, first_day=DAY).count() > 0


def test_a_day_is_loaded_alone(spark, bank, tmp_path):
    path = str(tmp_path / "feed")
    assert read_account_feed(bank, path).count() == 0
    for _ in range(2):
        load_account_day(bank, DAY, path)
    report = account_open_events(bank, day=DAY)
    loaded = read_account_feed(bank, path)
    assert loaded.columns == report.columns and rows(loaded) == rows(report) != []
    load_account_day(bank, DAY + dt.timedelta(days=1), path)
    assert rows(read_account_feed(bank, path, [DAY])) == rows(report)
    # a day whose deals are gone is emptied by its rerun, not left as it was
    load_account_day(bank | {"deals": bank["deals"].limit(0)}, DAY, path)
    assert read_account_feed(bank, path, [DAY]).count() == 0


def test_early_repayment_events(frame, bank):
    t = bank | {
        "repayments": frame(
            "source_id string, id long, dt date, sem_id long, ag_id long, db_cust_id long, "
            "contract_id long, operator_cre_id long, db_accnt_id long, prov_dt date",
            ("3C", 1, D(2018, 5, 1), 1, 5, 101, 900, 2, 1, D(2018, 5, 2)),
            ("3C", 2, D(2018, 5, 1), 1, 5, 101, 900, 2, 1, D(2018, 5, 3)),  # newer entry
            ("3C", 3, D(2018, 6, 1), 1, 5, 101, 900, 2, 1, D(2018, 6, 1)),  # migration day
            ("3C", 4, D(2018, 6, 2), 1, 5, 101, 900, 2, 1, D(2018, 6, 2)),  # day after
            ("3C", 5, D(2020, 7, 1), 1, 9, 101, 900, 2, 1, D(2018, 7, 1)),  # no balance row
            ("3C", 6, D(2018, 8, 1), 1, 5, 101, 900, 27877, 1, D(2018, 8, 1)),
            ("3C", 7, D(2018, 8, 1), 1, 5, 101, 900, None, 1, D(2018, 8, 1)),
            ("XX", 8, D(2018, 8, 1), 1, 5, 103, 901, 2, 2, D(2018, 8, 1)),  # unknown contract
        ),
        "account_contracts": frame(
            "contract_id long, account_id long, link_type int, dt_bgn date, dt_end date, fl_del int, type string",
            (900, 71, 457, D(2010, 1, 1), D(2030, 1, 1), 0, "ActiveDeal"),
            (900, 72, 457, D(2010, 1, 1), D(2030, 1, 1), 0, "ActiveDeal"),
            (900, 73, 457, D(2010, 1, 1), D(2030, 1, 1), 1, "ActiveDeal"),
            (900, 77, 1, D(2010, 1, 1), D(2030, 1, 1), 0, "ActiveDeal"),
        ),
        "migrations": frame("old_acc_id long, migration_date date", (71, D(2018, 6, 1))),
        "repayment_balances": frame(
            "accnt_id long, dt date, acct_blnc_eod decimal(18,2)",
            (71, D(2018, 5, 1), Dec(10)), (72, D(2018, 5, 1), Dec(99)),
            (71, D(2018, 6, 1), Dec(11)), (71, D(2018, 6, 2), Dec(98)), (72, D(2018, 6, 2), Dec(12)),
        ),
        "account_balances": frame(
            "accnt_id long, dt date, source_id string, acct_blnc_eod decimal(18,2)",
            (77, D(2018, 5, 1), "3C", Dec(1)), (77, D(2018, 6, 1), "3C", None),
            (77, D(2018, 6, 2), "XX", Dec(1)), (77, D(2020, 7, 1), "3C", Dec(1)),
        ),
        "accounts": frame("id long, crnc int", (1, 810)),
        "currencies": frame("source_code int, source_id string, target_code string", (810, "3C", "RUR")),
    }
    report = early_repayment_events(t)
    assert len(report.columns) == 42
    got = {r.OPERATION_ID: r for r in report.collect()}
    assert set(got) == {"2-3C", "3-3C", "4-3C", "5-3C", "8-XX"}
    assert {k: r.OPERATION_NM_AMT for k, r in got.items()} == {
        "2-3C": Dec(10), "3-3C": Dec(11), "4-3C": Dec(12), "5-3C": 0, "8-XX": 0,
    }
    # the product needs the principal account's balance of the day, and a valid star row
    assert {k: r.PRODUCT_NAME for k, r in got.items()} == {
        "2-3C": "CURRENT", "3-3C": None, "4-3C": None, "5-3C": None, "8-XX": None,
    }
    two = got["2-3C"]
    assert (two.PARTY_ID, two.PARTY_PHONE_NO, two.CURRENCY_CODE) == (1, "+7(***)1234567", "RUR")
    assert (two.ORGSTRUCT_BRANCH_ID, two.ORGSTRUCT_BRANCH_CODE, two.ADDINFO_DESC) == (5, 50, "N ST")
    assert (got["5-3C"].ORGSTRUCT_BRANCH_ID, got["8-XX"].CURRENCY_CODE) == (None, None)
    assert rows(early_repayment_events(t, bucket_days=30)) == rows(report)
    loose = {r.OPERATION_ID: r for r in early_repayment_events(t, product_bounded=False).collect()}
    assert loose["5-3C"].PRODUCT_NAME == "CURRENT"
