"""Lookups that grow with the facts are merged, however small their files are."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from martloom.operators.intervals import valid_at_join
from martloom.operators.joins import DimJoin, enrich
from martloom.plans import account_open_events, early_repayment_events
from martloom.queries.banking_reports import GROUPS, account_tables, repayment_tables

# first letters of the columns of customer and orders
GROWING = {"c", "o"}


@pytest.fixture(scope="module")
def bank_files(spark, tmp_path_factory):
    """Files so small that Spark broadcasts every one of them by itself."""
    base = tmp_path_factory.mktemp("bank")
    n, k = spark.range(60), F.col("id")
    text = F.col("id").cast("string")
    day = F.date_add(F.lit(dt.date(1997, 1, 1)), (k * 37 % 900).cast("int")).cast("timestamp")
    status = F.element_at(F.array(*map(F.lit, "FOP")), (k % 3 + 1).cast("int"))
    priority = F.element_at(F.array(F.lit("1-URGENT"), F.lit("2-HIGH"), F.lit("3-MEDIUM")), (k % 3 + 1).cast("int"))
    tables = {
        "customer": n.select(
            k.alias("c_custkey"), F.concat(F.lit("C"), text).alias("c_name"), (k % 25).cast("int").alias("c_nationkey"),
            (k * 1.5 - 9).alias("c_acctbal"), F.lit("MACHINERY").alias("c_mktsegment"),
        ),
        "supplier": n.select(
            k.alias("s_suppkey"), F.concat(F.lit("S"), text).alias("s_name"), (k % 25).cast("int").alias("s_nationkey")
        ),
        "orders": spark.range(400).select(
            k.alias("o_orderkey"), (k % 60).alias("o_custkey"), status.alias("o_orderstatus"),
            (k * 1.25).alias("o_totalprice"), day.alias("o_orderdate"), priority.alias("o_orderpriority"),
        ),
        "nation": spark.range(25).select(
            k.cast("int").alias("n_nationkey"), F.concat(F.lit("N"), text).alias("n_name"), (k % 5).cast("int").alias("n_regionkey")
        ),
        "part": n.select(
            k.alias("p_partkey"), (k % 30 + 1).cast("int").alias("p_size"), F.lit("T").alias("p_type"), F.lit("B").alias("p_brand")
        ),
        "lineitem": spark.range(800).select(
            (k / 2).cast("long").alias("l_orderkey"), k.alias("l_partkey"), (k % 60).alias("l_suppkey"), (k % 2).alias("l_linenumber"),
            *[F.lit(1.0).alias(f"l_{c}") for c in ("quantity", "extendedprice", "discount", "tax")],
            F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
        ),
        "region": spark.range(5).select(k.cast("int").alias("r_regionkey"), F.concat(F.lit("R"), text).alias("r_name")),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return str(base)


def broadcast_columns(df):
    """The columns read from files below the broadcasts of the plan, scalar subqueries apart."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    found, broadcast, scalar = set(), None, None
    for line in plan:
        level = len(re.match(r"[ :+\-]*", line).group())
        broadcast = None if broadcast is not None and level <= broadcast else broadcast
        scalar = None if scalar is not None and level <= scalar else scalar
        if "BroadcastExchange" in line and broadcast is None:
            broadcast = level
        if re.search(r"[-+] Subquery ", line) and scalar is None:
            scalar = level
        if broadcast is not None and scalar is None:
            found |= {c for scan in re.findall(r"FileScan parquet \[(.*?)\]", line) for c in re.findall(r"(\w+)#", scan)}
    return found


def broadcast_tables(df):
    """First letters of those columns."""
    return {c[0] for c in broadcast_columns(df)}


def rows(df):
    return sorted(map(repr, df.collect()))


def test_a_merged_lookup_is_not_broadcast(spark, bank_files):
    orders, customer = (spark.read.parquet(f"{bank_files}/{t}.parquet") for t in ("orders", "customer"))
    for more in ({}, {"split": True}):
        plain, merged = (
            enrich(orders, [DimJoin(customer, {"o_custkey": "c_custkey"}, {"name": "c_name"}, merge=m, **more)])
            for m in (False, True)
        )
        assert broadcast_tables(plain) == {"c"} and broadcast_tables(merged) == set()
        assert rows(plain) == rows(merged)


@pytest.mark.parametrize("more", [{}, {"bucket_days": 100}, {"chunk_rows": 3}])
def test_merged_validities_are_not_broadcast(spark, bank_files, more):
    orders = spark.read.parquet(f"{bank_files}/orders.parquet").withColumn("day", F.to_date("o_orderdate"))
    periods = spark.read.parquet(f"{bank_files}/customer.parquet").select(
        "c_custkey", "c_name", F.lit(dt.date(1997, 3, 1)).alias("a"), F.lit(dt.date(1998, 3, 1)).alias("b")
    )
    plain, merged = (
        valid_at_join(orders, periods, {"o_custkey": "c_custkey"}, "day", "a", "b", {"name": "c_name"}, merge=m, **more)
        for m in (False, True)
    )
    assert "c" in broadcast_tables(plain) and "c" not in broadcast_tables(merged)
    assert rows(plain) == rows(merged)


def test_repayments_broadcast_no_table_that_grows(spark, bank_files):
    report = early_repayment_events(repayment_tables(spark, bank_files))
    assert broadcast_tables(report) & GROWING == set()
    named = report.filter("PARTY_PHONE_NO IS NOT NULL AND PARTY_FULL_NAME LIKE 'C% MACHINERY %'")
    assert named.count() > 0


@pytest.mark.parametrize("day", [None, dt.date(1997, 8, 11)])
def test_account_events_broadcast_no_clients(spark, bank_files, day):
    report = account_open_events(account_tables(spark, bank_files), day, GROUPS, dt.date(1990, 1, 1))
    assert "c_custkey" not in broadcast_columns(report)
    assert report.filter("PARTY_ID IS NOT NULL").count() > 0


def test_repeated_clients_repeat_their_events(spark, bank_files):
    """A client known twice, with two persons, and one without a party, as the joins one by one have it."""
    t = repayment_tables(spark, bank_files)
    customers = t["customers"].filter("id <> 30").select("id", "hid_party", "party_type", F.lit("0").alias("fl_del"))
    twice, nobody = customers.filter("id = 31"), customers.filter("id = 32")
    t["customers"] = customers.filter("id <> 32").union(twice).union(nobody.withColumn("hid_party", F.lit(None).cast("long")))
    t["persons"] = t["persons"].union(t["persons"].filter("hid_party IN (500031, 500033)"))
    t["operators"] = t["operators"].limit(0)
    seen = {r.ADDINFO: r for r in early_repayment_events(t).groupBy(
        F.expr("OPERATION_SOURCE_ID DIV 2 % 60").alias("ADDINFO")).agg(
        F.count("*").alias("n"), F.count("PARTY_ID").alias("known"), F.countDistinct("OPERATION_ID").alias("ids")).collect()}
    assert {c: (seen[c].n // seen[c].ids, seen[c].known // seen[c].ids) for c in (30, 31, 32, 33, 34)} == {
        30: (1, 0), 31: (4, 4), 32: (1, 0), 33: (2, 2), 34: (1, 1),
    }
