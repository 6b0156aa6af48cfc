"""Scans, slices, filters, projections, set operations and scalar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import (
    brand_prefix,
    concat0,
    flag_from_presence,
    has_value,
    hour_shift_day,
    lacks_value,
    mask_phone,
    safe_div,
)
from ..operators.aggregates import partition_total
from ..operators.events import event_row
from ..operators.joins import DimJoin, enrich
from ..operators.pivots import transpose_sum
from ..operators.unions import union_labelled, union_sources
from ..session import fresh_path
from ..sources import (
    event_day,
    latest_snapshot,
    load,
    month_range,
    months_slice,
    read_newest,
    trailing_days,
    window_to_max,
    write_table,
)
from .base import EV, LI, ORD, events, lines, orders, query

AS_OF = dt.date(1998, 6, 10)


_NEWEST_SQL = """SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate FROM lineitem
       WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)"""


@query("latest_snapshot", _NEWEST_SQL)
def _(spark, sf):
    rows = latest_snapshot(load(spark, sf, "lineitem"), "l_shipdate")
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")


@query("latest_snapshot_by_footers", _NEWEST_SQL)
def _(spark, sf):
    """Over a copy that stores real dates, as the statistics of timestamps cannot be relied on."""
    path = fresh_path(spark, "snapshots")
    rows = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    rows.withColumn("ship", F.to_date("l_shipdate")).write.parquet(path)
    return read_newest(spark, path, "ship").drop("ship")


_FEED_SQL = f"""WITH {ORD}
  SELECT CAST(o_orderkey AS VARCHAR) || '-' || o_orderstatus || '-OPN' AS operation_id,
    odate AS operation_start, 'Orders' AS process_name, upper(c_name) AS party_full_name,
    CASE WHEN n_name IS NULL THEN 'Unknown' ELSE n_name END AS branch, 'N' AS cancel_flag,
    CAST(0 AS INTEGER) AS standard_duration, CAST(total AS DOUBLE) AS amount,
    CAST(year(odate) * 100 + month(odate) AS INTEGER) AS event_month
  FROM ord LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""


def _event_feed(spark, sf):
    named = enrich(
        orders(spark, sf),
        [
            DimJoin(
                load(spark, sf, "customer"),
                {"o_custkey": "c_custkey"},
                {"c_name": "c_name", "c_nationkey": "c_nationkey"},
            ),
            DimJoin(load(spark, sf, "nation"), {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"}),
        ],
    )
    return event_row(
        named,
        {
            "operation_id": concat0(
                F.col("o_orderkey"), F.lit("-"), F.col("o_orderstatus"), F.lit("-OPN")
            ),
            "operation_start": F.col("odate"),
            "process_name": "Orders",
            "party_full_name": F.upper("c_name"),
            "branch": F.coalesce("n_name", F.lit("Unknown")),
            "cancel_flag": "N",
            "standard_duration": 0,
            "amount": F.col("total"),
            "event_month": F.year("odate") * 100 + F.month("odate"),
        },
    )


query("event_model_projection", _FEED_SQL)(_event_feed)


@query("event_feed_write", _FEED_SQL)
def _(spark, sf):
    """Rebuild the whole feed, rerun its newest month alone, and read the result back."""
    feed = _event_feed(spark, sf)
    path = fresh_path(spark, "event_feed")
    write_table(feed, path, ["event_month"], as_path=True)
    rerun = latest_snapshot(feed, "event_month")
    write_table(rerun, path, ["event_month"], touched_only=True, as_path=True)
    return spark.read.parquet(path)


@query(
    "fee_transpose",
    f"""WITH {LI} SELECT l_orderkey, l_partkey,
      CAST(sum(price) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') AS DOUBLE) AS a_f,
      CAST(sum(price) FILTER (l_returnflag = 'A' AND l_linestatus = 'O') AS DOUBLE) AS a_o,
      CAST(sum(price) FILTER (l_returnflag = 'N' AND l_linestatus = 'F') AS DOUBLE) AS n_f,
      CAST(sum(price) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS DOUBLE) AS n_o,
      CAST(sum(price) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS DOUBLE) AS r_f,
      CAST(sum(price) FILTER (l_returnflag = 'R' AND l_linestatus = 'O') AS DOUBLE) AS r_o
    FROM li GROUP BY l_orderkey, l_partkey""",
)
def _(spark, sf):
    long = lines(spark, sf).withColumn("kind", F.lower(F.concat_ws("_", "l_returnflag", "l_linestatus")))
    kinds = ["a_f", "a_o", "n_f", "n_o", "r_f", "r_o"]
    return transpose_sum(long, ["l_orderkey", "l_partkey"], "kind", "price", kinds)


@query(
    "in_list_filter",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH'""",
)
def _(spark, sf):
    rows = orders(spark, sf).filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return rows.select("o_orderkey", "o_orderpriority")


@query(
    "not_in_list_filter",
    """SELECT o_orderkey, kind FROM (SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS kind FROM orders)
       WHERE kind IS NOT NULL AND kind <> '1-URGENT' AND kind <> '2-HIGH'""",
)
def _(spark, sf):
    kind = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    rows = orders(spark, sf).select("o_orderkey", kind.alias("kind"))
    return rows.filter(~F.col("kind").isin("1-URGENT", "2-HIGH"))


@query("prefix_filter", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def _(spark, sf):
    return load(spark, sf, "part").filter(F.col("p_name").startswith("red")).select("p_partkey", "p_name")


@query(
    "between_filter",
    "SELECT p_partkey, p_size FROM part WHERE p_size >= 10 AND p_size <= 20",
)
def _(spark, sf):
    return load(spark, sf, "part").filter(F.col("p_size").between(10, 20)).select("p_partkey", "p_size")


@query(
    "comparison_filter",
    f"""WITH {LI} SELECT l_orderkey, l_partkey, l_linenumber, qty FROM li
        WHERE (l_returnflag = 'R' AND qty >= 25) OR (l_linestatus = 'O' AND disc > 0.05)""",
)
def _(spark, sf):
    # on the stored columns, so that the scan gets the condition; casts come after it
    big_return = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= F.lit(25.0))
    cheap_open = (F.col("l_linestatus") == "O") & (F.col("l_discount") > F.lit(0.05))
    rows = load(spark, sf, "lineitem").filter(big_return | cheap_open)
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("qty")
    )


@query(
    "null_filter",
    """SELECT c_custkey, p_partkey FROM customer LEFT JOIN part ON p_partkey = c_custkey AND p_size > 25
       WHERE p_partkey IS NULL""",
)
def _(spark, sf):
    joined = enrich(
        load(spark, sf, "customer").select("c_custkey"),
        [
            DimJoin(
                load(spark, sf, "part"),
                {"c_custkey": "p_partkey"},
                {"p_partkey": "p_partkey"},
                where=F.col("p_size") > 25,
            )
        ],
    )
    return joined.filter(F.col("p_partkey").isNull())


@query(
    "not_equal_filter",
    """SELECT event_id, event_type FROM events WHERE event_type IS NOT NULL AND NOT (event_type = 'click')""",
)
def _(spark, sf):
    return events(spark, sf).filter(F.col("event_type") != "click").select("event_id", "event_type")


@query(
    "trailing_days_filter",
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship FROM lineitem
       WHERE CAST(l_shipdate AS DATE) > DATE '1998-06-10' - 6
         AND CAST(l_shipdate AS DATE) <= DATE '1998-06-10' - 5""",
)
def _(spark, sf):
    rows = trailing_days(load(spark, sf, "lineitem"), "l_shipdate", AS_OF, 6, 5)
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.to_date("l_shipdate").alias("ship"))


@query(
    "event_day_slice",
    """SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
)
def _(spark, sf):
    return event_day(load(spark, sf, "events"), "ts", dt.date(2024, 1, 15)).select("event_id", "user_id")


@query(
    "window_to_max_date",
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship FROM lineitem
       WHERE date_diff('day', CAST(l_shipdate AS DATE),
                       (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)) < 7""",
)
def _(spark, sf):
    rows = window_to_max(load(spark, sf, "lineitem"), "l_shipdate", 7)
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.to_date("l_shipdate").alias("ship"))


@query(
    "window_to_max_inclusive",
    """SELECT CAST(l_shipdate AS DATE) AS ship, count(*) AS n FROM lineitem
       WHERE CAST(l_shipdate AS DATE) BETWEEN (SELECT max(CAST(l_shipdate AS DATE)) - 7 FROM lineitem)
         AND (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) GROUP BY 1""",
)
def _(spark, sf):
    rows = window_to_max(load(spark, sf, "lineitem"), "l_shipdate", 7, inclusive_start=True)
    return rows.groupBy(F.to_date("l_shipdate").alias("ship")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "current_month_filter",
    """SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 6""",
)
def _(spark, sf):
    month = (AS_OF.year, AS_OF.month)
    return months_slice(load(spark, sf, "orders"), "o_orderdate", month, month).select("o_orderkey")


@query(
    "calendar_member_filter",
    """SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1998-01', '1998-02', '1998-03')""",
)
def _(spark, sf):
    quarter = months_slice(load(spark, sf, "orders"), "o_orderdate", (1998, 1), (1998, 3))
    return quarter.select("o_orderkey")


@query(
    "scalar_subquery_stamp",
    """SELECT s_suppkey, (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) AS newest,
       (SELECT max(CAST(l_shipdate AS DATE)) - 7 FROM lineitem) AS window_start FROM supplier""",
)
def _(spark, sf):
    newest = load(spark, sf, "lineitem").select(F.to_date(F.max("l_shipdate"))).scalar()
    return load(spark, sf, "supplier").select(
        "s_suppkey", newest.alias("newest"), F.date_sub(newest, 7).alias("window_start")
    )


@query(
    "window_filter",
    f"""WITH {ORD} SELECT o_orderkey, o_custkey, CAST(spent AS DOUBLE) AS spent FROM (
         SELECT *, sum(total) OVER (PARTITION BY o_custkey) AS spent FROM ord) WHERE spent > 2000000""",
)
def _(spark, sf):
    stamped = partition_total(orders(spark, sf), ["o_custkey"], "total", "spent")
    return stamped.filter(F.col("spent") > 2000000).select("o_orderkey", "o_custkey", "spent")


_SENTINEL = """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS case_id,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS original_id FROM orders"""


@query(
    "sentinel_null_filter",
    f"""SELECT * FROM ({_SENTINEL}) WHERE case_id IS NOT NULL AND case_id <> 1
        AND (original_id IS NULL OR original_id = 1)""",
)
def _(spark, sf):
    claims = orders(spark, sf).select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("case_id"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("original_id"),
    )
    return claims.filter(has_value(F.col("case_id"), 1) & lacks_value(F.col("original_id"), 1))


@query(
    "distinct_rows",
    "SELECT l_partkey, l_suppkey FROM lineitem GROUP BY l_partkey, l_suppkey",
)
def _(spark, sf):
    return load(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(
    "alias_reuse",
    f"""WITH {EV} SELECT day, count(DISTINCT user_id) AS users, count(DISTINCT user_id) / 7.0::DOUBLE AS weekly
        FROM ev GROUP BY day""",
)
def _(spark, sf):
    users = events(spark, sf).groupBy("day").agg(F.count_distinct("user_id").alias("users"))
    return users.withColumn("weekly", F.col("users") / F.lit(7))


@query(
    "case_without_else",
    """SELECT c_custkey, CASE WHEN c_nationkey = 10 THEN 'RUR' END AS currency FROM customer""",
)
def _(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") == 10, "RUR").alias("currency")
    )


@query(
    "inline_values",
    """SELECT o_orderkey, label FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial'))
       AS t(code, label) ON o_orderstatus = code""",
)
def _(spark, sf):
    names = F.create_map(*[F.lit(x) for x in ("F", "finished", "O", "open", "P", "partial")])
    labelled = orders(spark, sf).select("o_orderkey", names[F.col("o_orderstatus")].alias("label"))
    return labelled.filter(F.col("label").isNotNull())


@query(
    "hyphenated_columns",
    """SELECT p_partkey, sum(p_size * 10 + p_size * 2)::BIGINT AS active FROM part GROUP BY p_partkey""",
)
def _(spark, sf):
    stock = load(spark, sf, "part").select(
        "p_partkey",
        (F.col("p_size") * 10).alias("on-hand-quantity"),
        (F.col("p_size") * 2).alias("reserved-quantity"),
    )
    return stock.groupBy("p_partkey").agg(
        F.sum(F.col("`on-hand-quantity`") + F.col("`reserved-quantity`")).alias("active")
    )


@query(
    "final_sort",
    """SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DOUBLE) AS total FROM orders
       ORDER BY o_orderpriority ASC NULLS LAST, total DESC NULLS LAST, o_orderkey""",
)
def _(spark, sf):
    return (
        orders(spark, sf)
        .select("o_orderkey", "o_orderpriority", "total")
        .orderBy(
            F.col("o_orderpriority").asc_nulls_last(), F.col("total").desc_nulls_last(), "o_orderkey"
        )
    )


@query(
    "union_labelled",
    f"""WITH {LI} SELECT CASE l_linestatus WHEN 'F' THEN 'US' ELSE 'CA' END AS marketplace, l_partkey,
        sum(qty)::BIGINT AS units FROM li GROUP BY ALL""",
)
def _(spark, sf):
    rows = lines(spark, sf)
    sold = {
        label: rows.filter(F.col("l_linestatus") == status)
        .groupBy("l_partkey")
        .agg(F.sum("qty").alias("units"))
        for label, status in (("US", "F"), ("CA", "O"))
    }
    return union_labelled(sold, "marketplace")


@query(
    "typed_null_union",
    f"""WITH {LI} SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_linestatus = 'F' THEN ship END AS shipped FROM li""",
)
def _(spark, sf):
    rows, cols = lines(spark, sf), ["l_orderkey", "l_linenumber", "l_partkey"]
    done = rows.filter(F.col("l_linestatus") == "F").select(*cols, F.col("ship").alias("shipped"))
    pending = rows.filter(F.col("l_linestatus") != "F").select(
        *cols, F.lit(None).cast("date").alias("shipped")
    )
    return done.unionByName(pending)


@query(
    "union_sources",
    """SELECT ticket, day, kind FROM (
         SELECT event_id AS ticket, CAST(ts - INTERVAL 3 HOUR AS DATE) AS day, event_type AS kind FROM events
         UNION ALL
         SELECT o_orderkey, CAST(o_orderdate + INTERVAL 3 HOUR AS DATE), o_orderpriority FROM orders)""",
)
def _(spark, sf):
    return union_sources(
        [
            (load(spark, sf, "events"), {"ticket": "event_id", "day": "ts", "kind": "event_type"}, -3),
            (
                load(spark, sf, "orders"),
                {"ticket": "o_orderkey", "day": "o_orderdate", "kind": "o_orderpriority"},
                3,
            ),
        ],
        "day",
    )


@query(
    "union_periods",
    f"""WITH {ORD}, m AS (SELECT o_custkey, CAST(year(odate) AS INTEGER) AS y, CAST(month(odate) AS INTEGER) AS m,
          CAST(sum(total) AS DOUBLE) AS spent FROM ord GROUP BY ALL)
        SELECT * FROM m WHERE y = 1998 AND m IN (1, 2)
        UNION ALL SELECT * FROM m WHERE y = 1997 AND m IN (9, 10, 11, 12)""",
)
def _(spark, sf):
    # the scan gets the dates; month_range then works on the months, as where only those are stored
    first, last = (1997, 9), (1998, 2)
    recent = months_slice(load(spark, sf, "orders"), "o_orderdate", first, last)
    monthly = (
        recent.groupBy(
            "o_custkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")
        )
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent"))
    )
    return month_range(monthly, "y", "m", first, last)


@query(
    "flag_from_presence",
    """SELECT c_custkey, CASE WHEN n_name IS NULL THEN 'Y' ELSE 'N' END AS flag FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) ON c_nationkey = n_nationkey""",
)
def _(spark, sf):
    named = enrich(
        load(spark, sf, "customer").select("c_custkey", "c_nationkey"),
        [
            DimJoin(
                load(spark, sf, "nation"),
                {"c_nationkey": "n_nationkey"},
                {"n_name": "n_name"},
                where=F.col("n_regionkey") == 1,
            )
        ],
    )
    return named.select("c_custkey", flag_from_presence(F.col("n_name"), "N", "Y").alias("flag"))


@query(
    "hour_shift_day",
    """SELECT event_id, CAST(date_add(ts, INTERVAL (-3) HOUR) AS DATE) AS earlier,
       CAST(date_add(ts, INTERVAL 3 HOUR) AS DATE) AS later FROM events""",
)
def _(spark, sf):
    ts = F.col("ts")
    return load(spark, sf, "events").select(
        "event_id", hour_shift_day(ts, -3).alias("earlier"), hour_shift_day(ts, 3).alias("later")
    )


@query(
    "brand_prefix",
    """SELECT p_partkey, string_split(p_brand, '#')[1] AS maker, string_split(p_brand, '#')[2] AS number FROM part""",
)
def _(spark, sf):
    brand = F.col("p_brand")
    return load(spark, sf, "part").select(
        "p_partkey", brand_prefix(brand, "#").alias("maker"), brand_prefix(brand, "#", 2).alias("number")
    )


@query(
    "mask_phone",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN '+' || CAST(c_nationkey AS VARCHAR) || '(***)' ||
         substr(CAST(9000000000 + c_custkey * 7919 AS VARCHAR), 4) END AS phone FROM customer""",
)
def _(spark, sf):
    number = F.when(F.col("c_acctbal") >= 0, F.lit(9000000000) + F.col("c_custkey") * 7919)
    return load(spark, sf, "customer").select(
        "c_custkey", mask_phone(F.col("c_nationkey"), number).alias("phone")
    )


@query(
    "concat_null_as_empty",
    """SELECT o_orderkey, o_orderkey || '-' || coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '')
         || '-OPN' AS operation_id FROM orders""",
)
def _(spark, sf):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return orders(spark, sf).select(
        "o_orderkey",
        concat0(F.col("o_orderkey"), F.lit("-"), status, F.lit("-OPN")).alias("operation_id"),
    )


@query(
    "ratio_guard",
    f"""WITH {LI}, s AS (SELECT l_partkey,
          coalesce(sum(CASE WHEN l_returnflag = 'R' THEN qty END), 0)::DOUBLE AS returned,
          coalesce(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN qty END), 0)::DOUBLE AS accepted
        FROM li GROUP BY l_partkey)
        SELECT l_partkey, CASE WHEN accepted = 0 THEN NULL ELSE returned / accepted END AS share FROM s""",
)
def _(spark, sf):
    def units(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("qty"))), F.lit(0))

    accepted = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
    totals = lines(spark, sf).groupBy("l_partkey").agg(
        units(F.col("l_returnflag") == "R").alias("returned"), units(accepted).alias("accepted")
    )
    return totals.select("l_partkey", safe_div(F.col("returned"), F.col("accepted")).alias("share"))
