"""Plans of the profit and loss at size."""

import re

import pytest

from martloom.operators.pivots import transpose_sum
from martloom.plans.pnl import ORDER_FEES, REFUND_FEES, payment_lines, refund_lines
from martloom.queries import QUERIES

HUGE = 8000  # bytes; the JVM does not compile longer methods


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_profit_and_loss_has_no_method_too_long_to_compile(whole_plans, sf_dir, capsys):
    QUERIES["monthly_pnl"](whole_plans, sf_dir).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= HUGE


def test_long_fees_equal_transposed_ones(frame):
    dates = frame("order_id long, sku string, year_pdt int, month int", (1, "a", 1997, 3), (2, "b", 1997, 4), (3, "c", 1997, 4))
    bought = frame("order_id long, sku string, quantity_purchased long", (1, "a", 2), (2, "b", None), (3, "c", 1))
    schema = "order_id long, sku string, kind string, text string"
    rows = [(1, "a", "Principal", "9.99"), (1, "a", "Principal", "0.01"), (1, "a", "Commission", "-1.50")]
    rows += [(2, "b", "Tax", None), (2, "b", "Shipping", "3.00"), (3, "c", "other", "7.00"), (3, "c", None, "1.00")]
    rows += [(1, "a", "RefundPrincipal", "-4.25"), (2, "b", "RefundTax", "-0.75")]
    fees = frame(schema, *rows).selectExpr("order_id", "sku", "kind", "CAST(text AS DECIMAL(18,2)) AS amount")
    kinds = ("Principal", "Commission", "Tax", "Shipping", "RefundPrincipal", "RefundTax")

    def wide(names):
        out = transpose_sum(fees, ["order_id", "sku"], "kind", "amount", names)
        return out.selectExpr("order_id", "sku", *[f"CAST({n} AS DECIMAL(18,2)) AS {n}" for n in names])

    assert set(kinds) <= {*ORDER_FEES, *REFUND_FEES}
    for long, transposed in (
        (payment_lines(dates, bought, fees), payment_lines(dates, bought, wide(ORDER_FEES))),
        (refund_lines(dates, fees), refund_lines(dates, wide(REFUND_FEES))),
    ):
        assert [(f.name, f.dataType) for f in long.schema] == [(f.name, f.dataType) for f in transposed.schema]
        assert sorted(map(tuple, long.collect())) == sorted(map(tuple, transposed.collect()))
        assert long.count() == 3
