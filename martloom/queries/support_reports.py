"""Support reports: events are page impressions and tickets, orders are tickets by month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import contact_rate_by_category, tickets_monthly_pivot
from ..plans.support import CHANNELS, month_columns
from ..sources import load
from .base import EV, LI, ORD, events, lines, orders, query

_KINDS = {
    "click": "Technical issue",
    "view": "Financial issue",
    "purchase": "Content",
    "error": "Product",
    "signup": "Partners",
}
_ROUTES = (*CHANNELS, "Internal bot")
_KIND_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _KINDS.items()) + " END"
_ROUTE_SQL = "[" + ", ".join(f"'{r}'" for r in _ROUTES) + "][CAST(event_id % 9 + 1 AS INTEGER)]"


@query(
    "contact_rate_by_category",
    f"""WITH {EV},
      fam AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal > 0),
      act AS (SELECT DISTINCT coalesce(c_nationkey, user_id) AS hh, day FROM ev LEFT JOIN fam ON user_id = c_custkey
        WHERE event_type <> 'error' AND day >= DATE '2024-01-08' - 14 AND day < DATE '2024-01-31'),
      dau AS (SELECT day + CAST(k AS INTEGER) AS d, count(*) / 7.0::DOUBLE AS avg7 FROM act, range(7) t(k) GROUP BY 1),
      desk AS (SELECT user_id AS num, CAST(ts - INTERVAL 3 HOUR AS DATE) AS day, {_KIND_SQL} AS kind, {_ROUTE_SQL} AS route
        FROM ev WHERE event_id % 2 = 1),
      chg AS (SELECT user_id + 1000000 AS num, CAST(ts + INTERVAL 3 HOUR AS DATE) AS day, ts, {_KIND_SQL} AS kind,
        CASE WHEN event_id % 9 < 8 THEN {_ROUTE_SQL} END AS route FROM ev WHERE event_id % 2 = 0),
      k AS (SELECT num, day, kind FROM (SELECT *, row_number() OVER (PARTITION BY num, day ORDER BY ts DESC) AS n FROM chg) WHERE n = 1),
      r AS (SELECT num, day, route FROM (SELECT *, row_number() OVER (PARTITION BY num, day ORDER BY ts DESC) AS n FROM chg
        WHERE route IS NOT NULL) WHERE n = 1),
      tick AS (SELECT * FROM desk UNION ALL SELECT k.num, k.day, k.kind, r.route FROM k LEFT JOIN r ON k.num = r.num AND k.day = r.day),
      rep AS (SELECT *, day + CAST(k AS INTEGER) AS d FROM tick, range(7) t(k) WHERE day >= DATE '2024-01-08' - 14
        AND day < DATE '2024-01-31' AND route <> 'Internal bot'),
      con AS (SELECT d, """
    + ", ".join(
        f"count(DISTINCT CASE WHEN kind = '{v}' THEN (num, day) END) / 7.0::DOUBLE AS {k}"
        for k, v in _KINDS.items()
    )
    + """ FROM rep GROUP BY d)
    SELECT dau.d AS date_events, avg7 AS dau_7day_avg, click / avg7 * 100000 AS cr_technical, view / avg7 * 100000 AS cr_financial,
      purchase / avg7 * 100000 AS cr_content, error / avg7 * 100000 AS cr_product, signup / avg7 * 100000 AS cr_partners
    FROM dau JOIN con ON dau.d = con.d WHERE dau.d >= DATE '2024-01-08' AND dau.d < DATE '2024-01-31'""",
)
def _(spark, sf):
    """Odd events play the service desk, even ones changes of the workflow tool."""
    ev = events(spark, sf)
    impressions = ev.select(
        F.when(F.col("event_type") == "error", "error").otherwise("impression").alias("name"),
        F.lit("Russia").alias("country"),
        F.col("day").alias("event_date"),
        "user_id",
    )
    # customers in debt have no family, on purpose: their users must count by themselves
    family = load(spark, sf, "customer").filter(F.col("c_acctbal") > 0)
    family = family.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("parent_id")
    )
    kinds = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    route = F.element_at(F.array(*[F.lit(r) for r in _ROUTES]), (F.col("event_id") % 9 + 1).cast("int"))
    tickets = ev.withColumns({"kind": kinds[F.col("event_type")], "route": route})
    odd = F.col("event_id") % 2 == 1
    desk = tickets.filter(odd).select(
        F.col("user_id").alias("service_number"),
        F.col("ts").alias("interaction_date"),
        F.col("kind").alias("service_type"),
        F.col("event_type").alias("service_folder_2"),
        F.col("route").alias("service_channel"),
    )
    workflow = tickets.filter(~odd).select(
        (F.col("user_id") + 1000000).alias("id"),
        F.col("ts").alias("create_date"),
        F.col("ts").alias("last_modified_date"),
        F.col("kind").alias("category_1"),
        F.col("event_type").alias("category_2"),
        F.when(F.col("route") != "Internal bot", F.col("route")).alias("application_source"),
    )
    return contact_rate_by_category(
        impressions,
        family,
        desk,
        workflow,
        start=dt.date(2024, 1, 8),
        as_of=dt.date(2024, 1, 31),
        event_name="impression",
        country="Russia",
    )


_LAST = "row_number() OVER (PARTITION BY l_orderkey, odate ORDER BY ship DESC, {c} DESC) AS n"


@query(
    "tickets_monthly_pivot",
    f"""WITH {LI}, {ORD}, chg AS (SELECT l_orderkey, odate, ship, 'T' || l_linenumber AS c1,
        CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS c2 FROM li JOIN ord ON l_orderkey = o_orderkey
        WHERE o_orderstatus = 'P'),
      a AS (SELECT * FROM (SELECT *, {_LAST.format(c="c1")} FROM chg) WHERE n = 1),
      b AS (SELECT * FROM (SELECT *, {_LAST.format(c="c1 DESC, c2")} FROM chg WHERE c2 IS NOT NULL) WHERE n = 1),
      t AS (SELECT o_orderkey AS num, CAST(CAST(odate AS TIMESTAMP) - INTERVAL 3 HOUR AS DATE) AS day, o_orderpriority AS service_type,
          o_orderstatus AS service_folder_2 FROM ord WHERE o_orderstatus <> 'P'
        UNION ALL SELECT a.l_orderkey, a.odate, a.c1, b.c2 FROM a LEFT JOIN b USING (l_orderkey, odate))
    SELECT service_type, service_folder_2, """
    + ", ".join(
        f"count(DISTINCT CASE WHEN date_trunc('month', day) = DATE '{d}' THEN num END) AS {n}"
        for n, d in month_columns(dt.date(2000, 1, 1), 15).items()
    )
    + " FROM t GROUP BY service_type, service_folder_2",
)
def _(spark, sf):
    """Lines of partial orders are the changes of a workflow ticket."""
    ord_ = orders(spark, sf).withColumn("at", F.col("odate").cast("timestamp_ntz"))
    desk = ord_.filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("service_number"),
        F.col("at").alias("interaction_date"),
        F.col("o_orderpriority").alias("service_type"),
        F.col("o_orderstatus").alias("service_folder_2"),
    )
    changed = lines(spark, sf).join(
        ord_.filter(F.col("o_orderstatus") == "P"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    workflow = changed.select(
        F.col("o_orderkey").alias("id"),
        F.col("at").alias("create_date"),
        F.col("ship").alias("last_modified_date"),
        F.concat(F.lit("T"), F.col("l_linenumber")).alias("category_1"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("category_2"),
    )
    return tickets_monthly_pivot(desk, workflow, dt.date(2000, 1, 1), 15)
