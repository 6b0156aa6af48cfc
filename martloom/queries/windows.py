"""Window operators: newest rows, changes, gaps, rolling counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.aggregates import partition_total
from ..operators.calendar import calendar_spine, date_spine
from ..operators.daily_store import DailyStore
from ..operators.dedup import latest_per_key, row_sequence
from ..operators.intervals import change_intervals
from ..operators.rolling import rolling_distinct
from ..operators.series import nearest_fill, neighbour_values, period_delta
from ..operators.skew import spread, tasks_for
from ..session import fresh_path
from ..sources import load
from .base import EV, LI, ORD, events, lines, orders, query


@query(
    "latest_per_key",
    f"""WITH {ORD} SELECT o_custkey, o_orderkey, odate, CAST(total AS DOUBLE) AS total FROM ord o
        WHERE NOT EXISTS (SELECT 1 FROM ord x WHERE x.o_custkey = o.o_custkey
          AND (x.odate > o.odate OR (x.odate = o.odate AND x.o_orderkey < o.o_orderkey)))""",
)
def _(spark, sf):
    newest = latest_per_key(orders(spark, sf), ["o_custkey"], ["odate"], ["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "odate", "total")


@query(
    "top1_per_group",
    f"""WITH {LI} SELECT l_orderkey, max(price)::DOUBLE AS price FROM li GROUP BY l_orderkey""",
)
def _(spark, sf):
    tie = ["l_partkey", "l_suppkey", "l_linenumber"]
    return latest_per_key(lines(spark, sf), ["l_orderkey"], ["price"], tie).select("l_orderkey", "price")


@query(
    "row_sequence",
    f"""WITH {ORD} SELECT o_custkey, o_orderkey, odate,
          row_number() OVER (PARTITION BY o_custkey ORDER BY odate, o_orderkey) AS row_num FROM ord""",
)
def _(spark, sf):
    """Numbered per customer and day, then carried over the days."""
    rows = orders(spark, sf).select("o_custkey", "o_orderkey", "odate")
    return row_sequence(rows, ["o_custkey"], ["odate", "o_orderkey"], chunk=F.col("odate"))


_MONTHLY = f"""{LI}, {ORD}, mon AS (SELECT l_partkey, l_returnflag, CAST(date_trunc('month', odate) AS DATE) AS period,
    CAST(max(round(price * disc, 2)) AS DECIMAL(18,2)) AS fee FROM li JOIN ord ON l_orderkey = o_orderkey GROUP BY ALL)"""


def _monthly_fee(spark, sf):
    joined = lines(spark, sf).join(orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    fee = F.round(F.col("price") * F.col("disc"), 2).cast("decimal(18,2)")
    return joined.groupBy(
        "l_partkey", "l_returnflag", F.to_date(F.trunc("odate", "MM")).alias("period")
    ).agg(F.max(fee).alias("fee"))


@query(
    "period_delta",
    f"""WITH {_MONTHLY}, l AS (SELECT *, row_number() OVER w AS row_num, lag(fee) OVER w AS previous_fee FROM mon
          WINDOW w AS (PARTITION BY l_partkey, l_returnflag ORDER BY period))
        SELECT l_partkey, l_returnflag, period, CAST(fee AS DOUBLE) AS fee, CAST(row_num AS INTEGER) AS row_num,
          CAST(previous_fee AS DOUBLE) AS previous_fee, CAST(fee - previous_fee AS DOUBLE) AS difference,
          CASE WHEN fee <> 0 THEN ((200 * CAST(abs(fee - previous_fee) * 100 AS HUGEINT) + CAST(fee * 100 AS HUGEINT))
            // (2 * CAST(fee * 100 AS HUGEINT))) / 100.0::DOUBLE END AS difference_percent
        FROM l WHERE fee <> previous_fee""",
)
def _(spark, sf):
    return period_delta(_monthly_fee(spark, sf), ["l_partkey", "l_returnflag"], ["period"], "fee")


@query(
    "change_intervals",
    f"""WITH {ORD}, ch AS (SELECT DISTINCT o_custkey, odate FROM ord UNION ALL SELECT c_custkey, NULL FROM customer)
        SELECT o_custkey, odate, CAST((SELECT max(x.odate) FROM ch x WHERE x.o_custkey = ch.o_custkey
          AND (x.odate < ch.odate OR (ch.odate IS NULL AND x.odate IS NOT NULL))) + 1 AS DATE) AS start_dt FROM ch""",
)
def _(spark, sf):
    """One open interval per customer, last; changes are carried over from year to year."""
    changes = orders(spark, sf).select("o_custkey", "odate").distinct()
    last = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.lit(None).cast("date").alias("odate")
    )
    return change_intervals(changes.unionByName(last), "o_custkey", "odate", chunk=F.year("odate"))


_COST = f"""{LI}, cost AS (SELECT l_partkey, year(ship) AS y, month(ship) AS m, max(price) AS c FROM li GROUP BY ALL),
  ser AS (SELECT p_partkey AS sku, CAST(y0 AS INTEGER) AS year_, CAST(m0 AS INTEGER) AS month_, cost.c AS cost
    FROM part CROSS JOIN range(1995, 2002) a(y0) CROSS JOIN range(1, 13) b(m0)
    LEFT JOIN cost ON cost.l_partkey = p_partkey AND cost.y = y0 AND cost.m = m0)"""


_COST_YEARS = range(1995, 2002)
_COST_MONTHS = 12 * len(_COST_YEARS)


def cost_tasks(spark, sf) -> int | None:
    """Into how many parts a long series is cut; the parts of the table are counted from the file footer."""
    return tasks_for(spark, load(spark, sf, "part").count() * _COST_MONTHS)


def cost_series(spark, sf):
    """A price per part and month, NULL where nothing shipped."""
    keys = ["sku", "year_", "month_"]
    prices = lines(spark, sf).select(
        F.col("l_partkey").alias("sku"),
        F.year("ship").alias("year_"),
        F.month("ship").alias("month_"),
        "price",
    )
    # dealt before they are summed up, so that the join takes over the number of partitions
    known = spread(prices, cost_tasks(spark, sf), *keys).groupBy(*keys).agg(F.max("price").alias("cost"))
    parts = load(spark, sf, "part").withColumnRenamed("p_partkey", "sku")
    spine = calendar_spine(parts, "sku", _COST_YEARS)
    return spine.join(known, keys, "left")


def _by_sku(spark, sf):
    return spread(cost_series(spark, sf), cost_tasks(spark, sf), "sku")


@query(
    "neighbour_values",
    f"""WITH {_COST}, k AS (SELECT * FROM ser WHERE cost IS NOT NULL),
        b AS (SELECT s.sku, s.year_, s.month_, max(k.month_) AS pm FROM ser s LEFT JOIN k
              ON k.sku = s.sku AND k.year_ = s.year_ AND k.month_ < s.month_ GROUP BY ALL),
        n AS (SELECT s.sku, s.year_, s.month_, min(k.month_) AS nm FROM ser s LEFT JOIN k
              ON k.sku = s.sku AND k.year_ = s.year_ AND k.month_ > s.month_ GROUP BY ALL)
        SELECT s.sku, s.year_, s.month_, CAST(s.cost AS DOUBLE) AS cost, CAST(p.cost AS DOUBLE) AS prev_cost,
          pm AS prev_month_, CAST(q.cost AS DOUBLE) AS next_cost, nm AS next_month_
        FROM ser s JOIN b ON b.sku = s.sku AND b.year_ = s.year_ AND b.month_ = s.month_
        JOIN n ON n.sku = s.sku AND n.year_ = s.year_ AND n.month_ = s.month_
        LEFT JOIN ser p ON p.sku = s.sku AND p.year_ = s.year_ AND p.month_ = pm
        LEFT JOIN ser q ON q.sku = s.sku AND q.year_ = s.year_ AND q.month_ = nm""",
)
def _(spark, sf):
    return neighbour_values(_by_sku(spark, sf), ["sku", "year_"], "month_", "cost")


@query(
    "nearest_fill",
    f"""WITH {_COST}, num AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY year_, month_) AS pk FROM ser),
        anc AS (SELECT sku, year_, month_, cost, row_number() OVER (PARTITION BY sku ORDER BY year_, month_) AS apk
                FROM ser WHERE cost IS NOT NULL AND cost <> 0),
        c AS (SELECT n.sku, n.year_, n.month_, n.cost, n.pk, a.apk, a.cost AS acost,
                rank() OVER (PARTITION BY n.sku, n.year_, n.month_ ORDER BY abs(n.month_ - a.month_)) AS r
              FROM num n LEFT JOIN anc a ON a.sku = n.sku AND a.year_ = n.year_
              WHERE n.cost IS NULL OR n.cost = 0)
        SELECT sku, year_, month_, CAST(cost AS DOUBLE) AS cost, CAST(pk AS INTEGER) AS pk, apk AS fill_pk,
          CAST(acost AS DOUBLE) AS fill_cost FROM c WHERE r = 1""",
)
def _(spark, sf):
    return nearest_fill(_by_sku(spark, sf), ["sku"], "month_", "cost", bound=["year_"])


@query(
    "partition_total",
    f"""WITH {LI} SELECT l_orderkey, l_partkey, l_linenumber, CAST(sum(price) OVER (PARTITION BY l_partkey) AS DOUBLE)
          AS part_total FROM li""",
)
def _(spark, sf):
    rows = lines(spark, sf).select("l_orderkey", "l_partkey", "l_linenumber", "price")
    return partition_total(rows, ["l_partkey"], "price", "part_total").drop("price")


_ROLLING = f"""WITH {EV}, r AS (SELECT user_id, day, event_type, day + CAST(k AS INTEGER) AS w FROM ev, range(7) t(k))
  SELECT w AS day, count(DISTINCT (user_id, day)) AS pairs,
    count(DISTINCT CASE WHEN event_type = 'click' THEN (user_id, day) END) AS clicks,
    count(DISTINCT CASE WHEN event_type = 'error' THEN (user_id, day) END) AS errors FROM r GROUP BY w"""


def _rolling(method):
    def run(spark, sf):
        return rolling_distinct(
            events(spark, sf),
            "day",
            ["user_id"],
            7,
            method=method,
            categories={"clicks": "click", "errors": "error"},
            category_col="event_type",
        )

    return run


for _name, _method in (
    ("rolling_explode", "explode"),
    ("rolling_spine", "spine"),
    ("rolling_daily", "daily"),
):
    query(_name, _ROLLING)(_rolling(_method))


@query("rolling_daily_store", _ROLLING)
def _(spark, sf):
    """The first two weeks are loaded with half of a day missing, then the rest, then that day's late half."""
    ev = events(spark, sf)
    span = ev.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    every = [span["first"] + dt.timedelta(days=i) for i in range((span["last"] - span["first"]).days + 1)]
    late = every[8]
    store = DailyStore(
        fresh_path(spark, "daily_store"), "day", ["user_id"], 7, categories={"clicks": "click", "errors": "error"},
        category_col="event_type",
    )
    store.refresh(ev.filter((F.col("day") != F.lit(late)) | (F.col("user_id") % 2 == 0)), every[:14])
    store.refresh(ev, every[14:])
    store.refresh(ev, [late])
    return store.windows(spark)


@query(
    "date_spine",
    f"""WITH {LI} SELECT CAST(unnest(generate_series(min(ship), max(ship) + 6, INTERVAL 1 DAY)) AS DATE) AS ship FROM li""",
)
def _(spark, sf):
    return date_spine(lines(spark, sf), "ship", extend_days=6)
