"""Joins: lookups, existence, date ranges, spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import brand_prefix
from ..operators.calendar import calendar_spine
from ..operators.intervals import (
    anti_within_days,
    change_intervals,
    open_interval_join,
    valid_at_join,
    within_days_join,
)
from ..operators.joins import (
    DimJoin,
    enrich,
    exists_in,
    lookup_chain,
    lookup_or_self,
    reversal_join,
    spine_join,
)
from ..session import fresh_path
from ..sources import bucket_together, buckets_for, load
from .base import EV, LI, ORD, events, lines, orders, query

YEARS = range(1995, 2002)


@query(
    "left_enrich",
    """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       AND n_nationkey <> 3 LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    return enrich(
        load(spark, sf, "customer"),
        [
            DimJoin(
                load(spark, sf, "nation"),
                {"c_nationkey": "n_nationkey"},
                {"n_name": "n_name", "n_regionkey": "n_regionkey"},
                where=F.col("n_nationkey") != 3,
            ),
            DimJoin(load(spark, sf, "region"), {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}),
        ],
    ).select("c_custkey", "n_name", "r_name")


@query(
    "inner_join",
    f"""WITH {LI}, {ORD} SELECT o_orderpriority, count(*) AS n, CAST(sum(price) AS DOUBLE) AS revenue
        FROM li, ord WHERE l_orderkey = o_orderkey GROUP BY o_orderpriority""",
)
def _(spark, sf):
    joined = lines(spark, sf).join(orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("revenue")
    )


_THREE_SQL = f"""WITH {LI}, {ORD},
      d AS (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS sku, odate FROM li JOIN ord ON l_orderkey = o_orderkey),
      q AS (SELECT l_orderkey AS order_id, l_partkey AS sku, sum(qty)::BIGINT AS units FROM li
            WHERE l_returnflag <> 'A' GROUP BY ALL),
      f AS (SELECT l_orderkey AS order_id, l_partkey AS sku, CAST(sum(round(price * disc, 2)) AS DOUBLE) AS fee FROM li
            WHERE l_linestatus = 'F' GROUP BY ALL)
      SELECT d.order_id, d.sku, d.odate, q.units, f.fee FROM d
      JOIN q ON d.order_id = q.order_id AND d.sku = q.sku JOIN f ON d.order_id = f.order_id AND d.sku = f.sku"""


def _order_facts(spark, sf):
    key = [F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku")]
    rows = lines(spark, sf)
    dates = (
        rows.join(orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(*key, "odate")
        .distinct()
    )
    units = (
        rows.filter(F.col("l_returnflag") != "A").groupBy(*key).agg(F.sum("qty").alias("units"))
    )
    fee = F.round(F.col("price") * F.col("disc"), 2)
    fees = rows.filter(F.col("l_linestatus") == "F").groupBy(*key).agg(F.sum(fee).alias("fee"))
    return {"dates": dates, "units": units, "fees": fees}


def _three_way(facts):
    return facts["dates"].join(facts["units"], ["order_id", "sku"]).join(facts["fees"], ["order_id", "sku"])


@query("three_way_inner", _THREE_SQL)
def _(spark, sf):
    return _three_way(_order_facts(spark, sf))


@query("three_way_bucketed", _THREE_SQL)
def _(spark, sf):
    """The same over tables that were laid out by the key, without a shuffle."""
    path = fresh_path(spark, "order_facts")
    prefix = path.rsplit("/", 1)[1].replace("-", "_")
    # counted from the file footers; a bucket is joined by one task, so their number follows the rows
    buckets = buckets_for(load(spark, sf, "lineitem").count())
    return _three_way(bucket_together(_order_facts(spark, sf), prefix, ["order_id", "sku"], buckets, path))


def _months(df: DataFrame, date: str, measures) -> DataFrame:
    return df.groupBy(
        "l_partkey", F.year(date).alias("year_"), F.month(date).alias("month_")
    ).agg(*measures)


@query(
    "calendar_spine",
    """SELECT p_partkey, CAST(y AS INTEGER) AS year_, CAST(m AS INTEGER) AS month_
       FROM part, range(1995, 2002) a(y), range(1, 13) b(m)""",
)
def _(spark, sf):
    return calendar_spine(load(spark, sf, "part"), "p_partkey", YEARS)


@query(
    "spine_star_join",
    f"""WITH {LI}, {ORD},
      spine AS (SELECT p_partkey AS l_partkey, CAST(y AS INTEGER) AS year_, CAST(m AS INTEGER) AS month_
                FROM part, range(1995, 2002) a(y), range(1, 13) b(m)),
      sales AS (SELECT l_partkey, year(odate) AS y, month(odate) AS m, sum(qty) AS q, sum(price) AS p
                FROM li JOIN ord ON l_orderkey = o_orderkey GROUP BY ALL),
      back AS (SELECT l_partkey, year(ship) AS y, month(ship) AS m, sum(qty) AS q FROM li
               WHERE l_returnflag = 'R' GROUP BY ALL),
      gone AS (SELECT l_partkey, year(ship) AS y, month(ship) AS m, count(*) AS q, sum(round(price * tax, 2)) AS fee
               FROM li WHERE l_returnflag = 'A' GROUP BY ALL)
      SELECT s.l_partkey, year_, month_, coalesce(sales.q, 0)::BIGINT AS units, coalesce(sales.p, 0)::DOUBLE AS revenue,
        coalesce(back.q, 0)::BIGINT AS returned, coalesce(gone.q, 0)::BIGINT AS removed,
        coalesce(gone.fee, 0)::DOUBLE AS removal_fee
      FROM spine s LEFT JOIN sales ON s.l_partkey = sales.l_partkey AND year_ = sales.y AND month_ = sales.m
      LEFT JOIN back ON s.l_partkey = back.l_partkey AND year_ = back.y AND month_ = back.m
      LEFT JOIN gone ON s.l_partkey = gone.l_partkey AND year_ = gone.y AND month_ = gone.m""",
)
def _(spark, sf):
    rows = lines(spark, sf)
    sold = rows.join(orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    fee = F.round(F.col("price") * F.col("tax"), 2)
    components = {
        "sales": _months(
            sold, "odate", [F.sum("qty").alias("units"), F.sum("price").alias("revenue")]
        ),
        "returns": _months(
            rows.filter(F.col("l_returnflag") == "R"), "ship", [F.sum("qty").alias("returned")]
        ),
        "removals": _months(
            rows.filter(F.col("l_returnflag") == "A"),
            "ship",
            [F.count(F.lit(1)).alias("removed"), F.sum(fee).alias("removal_fee")],
        ),
    }
    parts = load(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    spine = calendar_spine(parts, "l_partkey", YEARS)
    return spine_join(spine, components, ["l_partkey", "year_", "month_"])


_WITHIN_SQL = f"""WITH {LI}, rec AS (SELECT l_partkey, ship AS approved, count(*) AS records, sum(qty)::BIGINT AS units
          FROM li WHERE l_returnflag = 'A' GROUP BY ALL)
        SELECT li.l_orderkey, li.l_partkey, li.l_linenumber, li.ship, approved, records, units
        FROM li JOIN rec ON li.l_partkey = rec.l_partkey AND date_diff('day', ship, approved) BETWEEN 0 AND 30
        WHERE l_returnflag = 'R'"""


def _returns_and_records(spark, sf):
    """Records are counted per part and day first, so an event meets at most 31 rows."""
    rows = lines(spark, sf)
    records = (
        rows.filter(F.col("l_returnflag") == "A")
        .groupBy("l_partkey", F.col("ship").alias("approved"))
        .agg(F.count(F.lit(1)).alias("records"), F.sum("qty").alias("units"))
    )
    events_ = rows.filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_partkey", "l_linenumber", "ship"
    )
    return events_, records


@query("within_days_join", _WITHIN_SQL)
def _(spark, sf):
    return within_days_join(*_returns_and_records(spark, sf), ["l_partkey"], "ship", "approved", 30)


@query("within_days_join_split", _WITHIN_SQL)
def _(spark, sf):
    """Parts with more than three record days in a bucket are cut."""
    return within_days_join(
        *_returns_and_records(spark, sf), ["l_partkey"], "ship", "approved", 30, most_rows=3
    )


@query(
    "within_days_semi",
    f"""WITH {LI} SELECT l_orderkey, l_partkey, l_linenumber, ship FROM li e WHERE l_returnflag = 'R' AND EXISTS (
          SELECT 1 FROM li r WHERE r.l_returnflag = 'A' AND r.l_partkey = e.l_partkey
          AND r.ship >= e.ship AND r.ship <= e.ship + 30)""",
)
def _(spark, sf):
    rows = lines(spark, sf)
    events_ = rows.filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_partkey", "l_linenumber", "ship"
    )
    records = rows.filter(F.col("l_returnflag") == "A")
    return within_days_join(events_, records, ["l_partkey"], "ship", "ship", 30, how="semi")


def _ledger(spark, sf):
    rows = lines(spark, sf)
    destroyed = rows.filter(F.col("l_returnflag") == "R").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("reference_id"),
        "l_partkey",
        "l_linenumber",
        "ship",
    )
    return destroyed, rows.filter(F.col("l_returnflag") == "A").select("l_partkey", "ship")


_LEDGER = f"""{LI}, d AS (SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS reference_id, l_partkey,
    l_linenumber, ship FROM li WHERE l_returnflag = 'R'),
  m AS (SELECT DISTINCT reference_id FROM d JOIN (SELECT l_partkey AS pk, ship AS approved FROM li
    WHERE l_returnflag = 'A') ON l_partkey = pk AND approved BETWEEN ship AND ship + 30)"""


@query(
    "anti_within_days",
    f"""WITH {_LEDGER} SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.reference_id = d.reference_id)""",
)
def _(spark, sf):
    destroyed, records = _ledger(spark, sf)
    return anti_within_days(
        destroyed, destroyed, records, ["l_partkey"], "ship", "ship", 30, "reference_id"
    )


@query(
    "anti_within_days_null_aware",
    f"""WITH {_LEDGER}, known AS (SELECT reference_id FROM m WHERE reference_id IS NOT NULL)
        SELECT * FROM d WHERE reference_id NOT IN (SELECT reference_id FROM known)""",
)
def _(spark, sf):
    """``NOT IN``: a NULL id is reported only if nothing matched; here the history has none."""
    destroyed, records = _ledger(spark, sf)
    history = destroyed.filter(F.col("reference_id").isNotNull())
    return anti_within_days(
        destroyed, history, records, ["l_partkey"], "ship", "ship", 30, "reference_id", null_aware=True
    )


@query(
    "semi_in_subquery",
    f"""WITH {LI} SELECT l_orderkey, l_partkey, l_linenumber, qty FROM li
        WHERE l_partkey IN (SELECT l_partkey FROM li WHERE l_returnflag = 'R' AND qty = 50)""",
)
def _(spark, sf):
    rows = lines(spark, sf)
    large = rows.filter((F.col("l_returnflag") == "R") & (F.col("qty") == 50))
    found = exists_in(rows, large, {"l_partkey": "l_partkey"})
    return found.select("l_orderkey", "l_partkey", "l_linenumber", "qty")


@query(
    "exists_via_left_join",
    f"""WITH {LI}, big AS (SELECT DISTINCT CASE WHEN p_size = 50 THEN 'None' ELSE p_brand END AS brand FROM part
          WHERE p_size >= 49)
        SELECT p_partkey, p_brand FROM part LEFT JOIN big ON p_brand = brand
        WHERE coalesce(brand, 'None') <> 'None'""",
)
def _(spark, sf):
    part = load(spark, sf, "part")
    brand = F.when(F.col("p_size") == 50, F.lit("None")).otherwise(F.col("p_brand"))
    big = part.filter(F.col("p_size") >= 49).select(brand.alias("brand"))
    found = exists_in(part, big, {"p_brand": "brand"}, sentinel="None")
    return found.select("p_partkey", "p_brand")


_VALID_SQL = f"""WITH {LI}, dim AS (SELECT l_partkey AS pk, date_trunc('month', ship)::DATE AS f, last_day(ship) AS t,
          min(l_suppkey) AS supplier FROM li WHERE l_returnflag = 'N' GROUP BY ALL)
        SELECT l_orderkey, l_partkey, l_linenumber, ship, supplier FROM li
        LEFT JOIN dim ON l_partkey = pk AND ship BETWEEN f AND t"""


def _supplier_at(spark, sf, **how):
    rows = lines(spark, sf)
    dim = (
        rows.filter(F.col("l_returnflag") == "N")
        .groupBy(
            "l_partkey",
            F.to_date(F.trunc("ship", "MM")).alias("valid_from"),
            F.last_day("ship").alias("valid_to"),
        )
        .agg(F.min("l_suppkey").alias("supplier"))
    )
    facts = rows.select("l_orderkey", "l_partkey", "l_linenumber", "ship")
    return valid_at_join(
        facts,
        dim,
        {"l_partkey": "l_partkey"},
        "ship",
        "valid_from",
        "valid_to",
        {"supplier": "supplier"},
        **how,
    )


@query("valid_at_join", _VALID_SQL)
def _(spark, sf):
    """Buckets keep a part with very many validity rows from meeting all of them per line."""
    return _supplier_at(spark, sf, bucket_days=31)


@query("valid_at_join_chunked", _VALID_SQL)
def _(spark, sf):
    """Parts with more than eight lines are cut at dates that give each chunk about as many."""
    return _supplier_at(spark, sf, chunk_rows=8)


_OPEN_SQL = f"""WITH {ORD}, ch AS (SELECT DISTINCT o_custkey AS ck, odate AS until FROM ord WHERE o_orderpriority = '1-URGENT'
          UNION ALL SELECT c_custkey, NULL FROM customer),
        iv AS (SELECT ck, until, lag(until) OVER (PARTITION BY ck ORDER BY until NULLS LAST) + 1 AS start FROM ch)
        SELECT o_orderkey, o_custkey, odate, until AS period_end FROM ord LEFT JOIN iv ON o_custkey = ck
          AND odate >= coalesce(start, DATE '1990-01-01') AND odate <= coalesce(until, DATE '2099-12-31')"""


def _periods_at(spark, sf, **how):
    ord_ = orders(spark, sf)
    moved = (
        ord_.filter(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_custkey").alias("customer"), F.col("odate").alias("migration_date"))
        .distinct()
    )
    last = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer"), F.lit(None).cast("date").alias("migration_date")
    )
    periods = change_intervals(moved.unionByName(last), "customer", "migration_date").withColumns(
        {
            "dt_bgn": F.lit(dt.date(1990, 1, 1)),
            "dt_end": F.lit(dt.date(2099, 12, 31)),
        }
    )
    return open_interval_join(
        ord_.select("o_orderkey", "o_custkey", "odate"),
        periods,
        {"o_custkey": "customer"},
        "odate",
        "start_dt",
        "dt_bgn",
        "migration_date",
        "dt_end",
        {"period_end": "migration_date"},
        **how,
    )


@query("open_interval_join", _OPEN_SQL)
def _(spark, sf):
    return _periods_at(spark, sf, bucket_days=366)


@query("open_interval_join_chunked", _OPEN_SQL)
def _(spark, sf):
    return _periods_at(spark, sf, chunk_rows=5)


def claims(spark, sf) -> DataFrame:
    """Finished orders as claims; their returned lines as reversals, some without article."""
    ord_, rows = orders(spark, sf), lines(spark, sf)
    nothing = F.lit(None).cast("bigint")
    original = ord_.filter(F.col("o_orderstatus") == "F").select(
        F.year("odate").alias("year"),
        F.month("odate").alias("month"),
        F.col("o_orderkey").alias("reimbursement_id"),
        nothing.alias("original_reimbursement_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("case_id"),
        F.col("o_custkey").alias("asin"),
        F.col("o_orderpriority").alias("fnsku"),
        F.lit("Damaged_Warehouse").alias("reason"),
        F.col("total").alias("amount_total"),
    )
    taken = (
        rows.filter(F.col("l_returnflag") == "R")
        .join(ord_, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.year("ship").alias("year"),
            F.month("ship").alias("month"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber") + 1000000000).alias("reimbursement_id"),
            F.col("l_orderkey").alias("original_reimbursement_id"),
            nothing.alias("case_id"),
            F.when(F.col("l_linenumber") != 7, F.col("o_custkey")).alias("asin"),
            F.col("o_orderpriority").alias("fnsku"),
            F.when(F.col("l_linestatus") == "F", "Reimbursement_Reversal")
            .otherwise("Payment_Retraction")
            .alias("reason"),
            (-F.col("price")).alias("amount_total"),
        )
    )
    return original.unionByName(taken)


CLAIMS = f"""{LI}, {ORD}, claims AS (
  SELECT CAST(year(odate) AS INTEGER) AS year, CAST(month(odate) AS INTEGER) AS month, o_orderkey AS reimbursement_id,
    CAST(NULL AS BIGINT) AS original_reimbursement_id,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS case_id, o_custkey AS asin, o_orderpriority AS fnsku,
    'Damaged_Warehouse' AS reason, total AS amount_total FROM ord WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT CAST(year(ship) AS INTEGER), CAST(month(ship) AS INTEGER), l_orderkey * 10 + l_linenumber + 1000000000,
    l_orderkey, NULL, CASE WHEN l_linenumber <> 7 THEN o_custkey END, o_orderpriority,
    CASE WHEN l_linestatus = 'F' THEN 'Reimbursement_Reversal' ELSE 'Payment_Retraction' END, -price
  FROM li JOIN ord ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')"""


@query(
    "reversal_self_join",
    f"""WITH {CLAIMS} SELECT o.reimbursement_id, o.asin, count(r.reimbursement_id) AS n_reversals,
          CAST(sum(r.amount_total) AS DOUBLE) AS reversed_amount, CAST(any_value(o.amount_total) AS DOUBLE) AS amount_total
        FROM claims o LEFT JOIN claims r ON o.reimbursement_id = r.original_reimbursement_id AND o.asin = r.asin
          AND o.fnsku = r.fnsku AND r.reason IN ('Reimbursement_Reversal', 'Payment_Retraction')
        WHERE o.original_reimbursement_id IS NULL GROUP BY o.reimbursement_id, o.asin""",
)
def _(spark, sf):
    joined = reversal_join(
        claims(spark, sf),
        "reimbursement_id",
        "original_reimbursement_id",
        ["asin", "fnsku"],
        F.col("reason").isin("Reimbursement_Reversal", "Payment_Retraction"),
        "amount_total",
    )
    return joined.filter(F.col("original_reimbursement_id").isNull()).select(
        "reimbursement_id", "asin", "n_reversals", "reversed_amount", "amount_total"
    )


@query(
    "expr_key_join",
    """SELECT p_partkey, b.brand_id, b.team FROM part LEFT JOIN (SELECT CAST(n_nationkey AS VARCHAR) AS brand_id,
         n_name AS team FROM nation) b ON split_part(p_brand, '#', 2) = b.brand_id""",
)
def _(spark, sf):
    brands = load(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("brand_id"), F.col("n_name").alias("team")
    )
    keyed = load(spark, sf, "part").select(
        "p_partkey", brand_prefix(F.col("p_brand"), "#", 2).alias("__brand")
    )
    found = DimJoin(brands, {"__brand": "brand_id"}, {"brand_id": "brand_id", "team": "team"})
    return enrich(keyed, [found]).drop("__brand")


@query(
    "lookup_or_self",
    f"""WITH {EV} SELECT event_id, user_id, CASE WHEN c_custkey IS NULL THEN user_id ELSE c_nationkey END AS household
        FROM ev LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey""",
)
def _(spark, sf):
    # customers in debt are left out of the lookup, on purpose: their users must keep their own id
    family = load(spark, sf, "customer").filter(F.col("c_acctbal") > 0)
    family = family.select("c_custkey", F.col("c_nationkey").cast("bigint").alias("parent"))
    out = lookup_or_self(events(spark, sf), "user_id", family, "c_custkey", "parent", "household")
    return out.select("event_id", "user_id", "household")


@query(
    "lookup_chain",
    """SELECT s_suppkey, r_name AS area FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey > 4
       LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    # five nations are left out of the lookup, on purpose: the chain must break at them
    steps = [
        (load(spark, sf, "nation").filter(F.col("n_nationkey") > 4), "n_nationkey", "n_regionkey"),
        (load(spark, sf, "region"), "r_regionkey", "r_name"),
    ]
    suppliers = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return lookup_chain(suppliers, "s_nationkey", steps, "area").select("s_suppkey", "area")


@query(
    "snowflake_enrich",
    f"""WITH {LI}, {ORD} SELECT l_orderkey, l_partkey, l_linenumber, odate, c_name, cn.n_name AS customer_nation,
          r_name AS customer_region, p_brand, s_name, sn.n_name AS supplier_nation
        FROM li LEFT JOIN ord ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
        LEFT JOIN region ON cn.n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""",
)
def _(spark, sf):
    nation = load(spark, sf, "nation")
    dims = [
        DimJoin(
            orders(spark, sf),
            {"l_orderkey": "o_orderkey"},
            {"odate": "odate", "o_custkey": "o_custkey"},
            where=F.col("o_orderstatus") != "P",
        ),
        DimJoin(
            load(spark, sf, "customer"),
            {"o_custkey": "c_custkey"},
            {"c_name": "c_name", "c_nationkey": "c_nationkey"},
        ),
        DimJoin(
            nation, {"c_nationkey": "n_nationkey"}, {"customer_nation": "n_name", "area": "n_regionkey"}
        ),
        DimJoin(load(spark, sf, "region"), {"area": "r_regionkey"}, {"customer_region": "r_name"}),
        DimJoin(load(spark, sf, "part"), {"l_partkey": "p_partkey"}, {"p_brand": "p_brand"}),
        DimJoin(
            load(spark, sf, "supplier"),
            {"l_suppkey": "s_suppkey"},
            {"s_name": "s_name", "s_nationkey": "s_nationkey"},
        ),
        DimJoin(nation, {"s_nationkey": "n_nationkey"}, {"supplier_nation": "n_name"}),
    ]
    facts = lines(spark, sf).select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    return enrich(facts, dims).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "odate",
        "c_name",
        "customer_nation",
        "customer_region",
        "p_brand",
        "s_name",
        "supplier_nation",
    )
