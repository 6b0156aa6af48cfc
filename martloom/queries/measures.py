"""Aggregates and the measures built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import rate_per, safe_div
from ..operators.aggregates import ad_profit, aging_value, avg_of_ratio, sum_groups
from ..operators.dedup import argmax_latest
from ..operators.pivots import pivot_count_distinct, transpose_sum
from ..operators.rolling import (
    category_sketches,
    daily_distinct,
    roll_categories,
    rolling_distinct,
    rolling_users,
    spread_days,
)
from ..operators.aggregates import approx_distinct
from ..plans.support import month_columns
from ..sources import load, window_to_max
from .base import EV, LI, ORD, cents, events, half_up, lines, orders, query

import datetime as dt


@query(
    "sum_expression",
    f"""WITH {LI} SELECT l_returnflag, l_linestatus, sum(qty)::BIGINT AS units,
          CAST(sum(price * (1 - disc)) AS DOUBLE) AS revenue, CAST(sum(price) - sum(price * disc) AS DOUBLE) AS net
        FROM li GROUP BY ALL""",
)
def _(spark, sf):
    net = F.col("price") * (F.lit(1) - F.col("disc"))
    return lines(spark, sf).groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("qty").alias("units"),
        F.sum(net).alias("revenue"),
        (F.sum("price") - F.sum(F.col("price") * F.col("disc"))).alias("net"),
    )


@query(
    "two_count_distinct",
    """SELECT l_returnflag, l_linestatus, (SELECT count(*) FROM (SELECT DISTINCT l_partkey FROM lineitem b
           WHERE b.l_returnflag = a.l_returnflag AND b.l_linestatus = a.l_linestatus)) AS parts,
         (SELECT count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem b
           WHERE b.l_returnflag = a.l_returnflag AND b.l_linestatus = a.l_linestatus)) AS suppliers
       FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem) a""",
)
def _(spark, sf):
    return lines(spark, sf).groupBy("l_returnflag", "l_linestatus").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@query(
    "avg_unweighted",
    f"""WITH {LI}, s AS (SELECT l_partkey, sum({cents("price")}) AS c, count(*) AS n FROM li GROUP BY l_partkey)
        SELECT l_partkey, {half_up("c * 10000", "n")} / 1000000.0::DOUBLE AS mean_price FROM s""",
)
def _(spark, sf):
    return lines(spark, sf).groupBy("l_partkey").agg(F.avg("price").alias("mean_price"))


@query(
    "max_min",
    f"""WITH {LI} SELECT l_suppkey, max(ship) AS newest, min(ship) AS oldest, CAST(max(price) AS DOUBLE) AS top
        FROM li GROUP BY l_suppkey""",
)
def _(spark, sf):
    return lines(spark, sf).groupBy("l_suppkey").agg(
        F.max("ship").alias("newest"), F.min("ship").alias("oldest"), F.max("price").alias("top")
    )


def _sketches(ev):
    daily = approx_distinct(ev, ["day"], "user_id", "guess", rsd=0.005)
    return daily, rolling_users(ev, "day", "user_id", 7, method="hll", name="weekly_guess", lg_k=16)


def sketched_users(spark, sf):
    """The approximate counts of the next query without the exact ones that check them; for timing."""
    daily, weekly = _sketches(events(spark, sf))
    return weekly.join(daily, "day", "left")


@query(
    "approx_distinct_daily",
    f"""WITH {EV}, w AS (SELECT w.day, count(DISTINCT user_id) AS weekly_users FROM (SELECT DISTINCT CAST(d AS DATE) AS day FROM (
          SELECT unnest(generate_series(min(day), max(day) + 6, INTERVAL 1 DAY)) AS d FROM ev)) w
        JOIN ev ON ev.day BETWEEN w.day - 6 AND w.day GROUP BY w.day),
        d AS (SELECT day, count(DISTINCT user_id) AS users FROM ev GROUP BY day)
        SELECT w.day, weekly_users, coalesce(users, 0) AS users, TRUE AS weekly_close, TRUE AS daily_close
        FROM w LEFT JOIN d ON d.day = w.day""",
)
def _(spark, sf):
    """Users per day and per trailing 7 days, and whether the sketches come within 2 per cent."""
    ev = events(spark, sf)
    daily, weekly = _sketches(ev)
    users = daily_distinct(ev, "day", ["user_id"], "users")
    exact = rolling_users(ev, "day", "user_id", 7, name="weekly_users")
    both = exact.join(weekly, "day", "left").join(users, "day", "left").join(daily, "day", "left")

    def close(guess, count):
        return F.abs(F.col(guess) - F.col(count)) <= 0.02 * F.col(count)

    return both.select(
        "day", "weekly_users", F.coalesce("users", F.lit(0)).alias("users"),
        F.coalesce(close("weekly_guess", "weekly_users"), F.lit(False)).alias("weekly_close"),
        (F.col("users").isNull() | close("guess", "users")).alias("daily_close"),
    )


# The kinds of events.
_KINDS = ("click", "error", "purchase", "signup", "view")


@query(
    "approx_category_users",
    f"""WITH {EV}, w AS (SELECT CAST(d AS DATE) AS day FROM (
          SELECT unnest(generate_series(min(day), max(day) + 6, INTERVAL 1 DAY)) AS d FROM ev))
        SELECT w.day, {", ".join(f"count(DISTINCT CASE WHEN event_type = '{k}' THEN user_id END) AS {k}s" for k in _KINDS)},
          count(DISTINCT CASE WHEN event_type = 'click' AND EXISTS (SELECT 1 FROM ev p WHERE p.event_type = 'purchase'
            AND p.user_id = ev.user_id AND p.day BETWEEN w.day - 6 AND w.day) THEN user_id END) AS click_and_purchase,
          TRUE AS close FROM w JOIN ev ON ev.day BETWEEN w.day - 6 AND w.day GROUP BY w.day""",
)
def _(spark, sf):
    """Users of each kind in the trailing week, exactly, and whether daily theta sketches come within 2 per cent."""
    ev, size = events(spark, sf), 16
    names = {f"{k}s": k for k in _KINDS}
    daily = category_sketches(ev, "day", "user_id", names, "event_type", size)
    weekly = roll_categories(daily, "day", list(names), 7, size)
    both = F.theta_sketch_estimate(F.theta_intersection("clicks", "purchases"))
    guess = weekly.select(
        "day", *[F.theta_sketch_estimate(n).alias(f"{n}_guess") for n in names], both.alias("click_and_purchase_guess")
    )
    seen = spread_days(ev.select("day", "user_id", "event_type").distinct(), "day", 7)
    kinds = seen.groupBy("day", "user_id").agg(
        *[F.max(F.when(F.col("event_type") == k, 1).otherwise(0)).alias(n) for n, k in names.items()]
    )
    exact = kinds.groupBy("day").agg(
        *[F.sum(n).alias(n) for n in names], F.sum(F.col("clicks") * F.col("purchases")).alias("click_and_purchase")
    )
    counts = [*names, "click_and_purchase"]
    near = [F.abs(F.col(f"{n}_guess") - F.col(n)) <= 0.02 * F.col(n) for n in counts]
    close = reduce(lambda a, b: a & b, near)
    return exact.join(guess, "day").select("day", *[F.col(n).cast("bigint").alias(n) for n in counts], close.alias("close"))


@query(
    "rolling_users_exact",
    f"""WITH {EV} SELECT w.day, count(DISTINCT user_id) AS users FROM (SELECT DISTINCT CAST(d AS DATE) AS day FROM (
          SELECT unnest(generate_series(min(day), max(day) + 6, INTERVAL 1 DAY)) AS d FROM ev)) w
        JOIN ev ON ev.day BETWEEN w.day - 6 AND w.day GROUP BY w.day""",
)
def _(spark, sf):
    return rolling_users(events(spark, sf), "day", "user_id", 7)


@query(
    "composite_distinct",
    f"""WITH {EV} SELECT event_type, count(DISTINCT CAST(user_id AS VARCHAR) || ',' || CAST(day AS VARCHAR)) AS userdays
        FROM ev GROUP BY event_type""",
)
def _(spark, sf):
    return events(spark, sf).groupBy("event_type").agg(
        F.count_distinct("user_id", "day").alias("userdays")
    )


@query(
    "conditional_distinct",
    f"""WITH {EV} SELECT day, count(DISTINCT user_id) FILTER (event_type = 'click') AS clickers,
          count(DISTINCT user_id) FILTER (event_type = 'purchase') AS buyers FROM ev GROUP BY day""",
)
def _(spark, sf):
    # one row per (day, user) with a mark per type: no copy of the rows per type
    kinds = {"clickers": "click", "buyers": "purchase"}
    daily = daily_distinct(events(spark, sf), "day", ["user_id"], "users", kinds, "event_type")
    return daily.select("day", *kinds)


@query(
    "argmax_latest",
    f"""WITH {EV}, a AS (SELECT user_id, day, event_type, row_number() OVER (PARTITION BY user_id, day
            ORDER BY ts DESC, event_id DESC) AS n FROM ev),
          b AS (SELECT user_id, day, val, row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) AS n
            FROM ev WHERE event_type <> 'error')
        SELECT a.user_id, a.day, a.event_type AS last_type, CAST(b.val AS DOUBLE) AS last_value FROM a
        LEFT JOIN b ON a.user_id = b.user_id AND a.day = b.day AND b.n = 1 WHERE a.n = 1""",
)
def _(spark, sf):
    ev = events(spark, sf)
    ev = ev.withColumn("val", F.when(F.col("event_type") != "error", F.col("val")))
    values = {"last_type": "event_type", "last_value": "val"}
    return argmax_latest(ev, ["user_id", "day"], values, "ts", ["event_id"])


@query(
    "two_level_agg",
    f"""WITH {LI}, a AS (SELECT CAST(year(ship) AS INTEGER) AS year, l_partkey, count(DISTINCT l_orderkey) AS n,
          count(DISTINCT l_suppkey) AS s, sum(price) AS p FROM li GROUP BY ALL)
        SELECT year, sum(n)::BIGINT AS orders, sum(s)::BIGINT AS suppliers, CAST(sum(p) AS DOUBLE) AS revenue
        FROM a GROUP BY year""",
)
def _(spark, sf):
    per_part = lines(spark, sf).groupBy(F.year("ship").alias("year"), "l_partkey").agg(
        F.count_distinct("l_orderkey").alias("n"),
        F.count_distinct("l_suppkey").alias("s"),
        F.sum("price").alias("p"),
    )
    return per_part.groupBy("year").agg(
        F.sum("n").alias("orders"), F.sum("s").alias("suppliers"), F.sum("p").alias("revenue")
    )


@query(
    "sum0_many",
    f"""WITH {LI} SELECT l_suppkey,
          CAST(coalesce(sum(price) FILTER (l_returnflag IN ('A', 'R')), 0) AS DOUBLE) AS sent_back,
          CAST(coalesce(sum(price) FILTER (l_returnflag = 'N'), 0) AS DOUBLE) AS kept,
          CAST(sum(price) AS DOUBLE) AS amount FROM li GROUP BY l_suppkey""",
)
def _(spark, sf):
    wide = transpose_sum(
        lines(spark, sf), ["l_orderkey", "l_suppkey"], "l_returnflag", "price", ["A", "N", "R"]
    )
    groups = {"sent_back": ["A", "R"], "kept": ["N"], "amount": ["A", "N", "R"]}
    return sum_groups(wide, ["l_suppkey"], groups)


_RATIO = half_up(f"{cents('price')} * CAST('100000000000000000000' AS HUGEINT)", "qty")


@query(
    "avg_of_ratio",
    f"""WITH {LI}, r AS (SELECT l_partkey, l_returnflag, sum({_RATIO}) AS s, count(*) AS n FROM li GROUP BY ALL),
          m AS (SELECT l_partkey, l_returnflag, {half_up("s * 10000", "n")} AS a FROM r)
        SELECT l_partkey, l_returnflag,
          {half_up("a", "CAST('10000000000000000000000' AS HUGEINT)")} / 10000.0::DOUBLE AS unit_price FROM m""",
)
def _(spark, sf):
    mean = avg_of_ratio(lines(spark, sf), ["l_partkey", "l_returnflag"], "price", "qty", "unit_price")
    return mean.withColumn("unit_price", F.round("unit_price", 4))


@query(
    "group_by_expression",
    f"""WITH {LI} SELECT CAST(year(ship) AS INTEGER) AS y, CAST(month(ship) AS INTEGER) AS m, sum(qty)::BIGINT AS units
        FROM li GROUP BY ALL""",
)
def _(spark, sf):
    return lines(spark, sf).groupBy(F.year("ship").alias("y"), F.month("ship").alias("m")).agg(
        F.sum("qty").alias("units")
    )


_MONTHS = month_columns(dt.date(2000, 1, 1), 15)


@query(
    "pivot_count_distinct",
    f"""WITH {ORD} SELECT o_orderpriority, o_orderstatus, """
    + ", ".join(
        f"count(DISTINCT CASE WHEN date_trunc('month', odate) = DATE '{d}' THEN o_custkey END) AS {n}"
        for n, d in _MONTHS.items()
    )
    + " FROM ord GROUP BY o_orderpriority, o_orderstatus",
)
def _(spark, sf):
    placed = orders(spark, sf).withColumn("month", F.trunc("odate", "MM"))
    keys = ["o_orderpriority", "o_orderstatus"]
    return pivot_count_distinct(placed, keys, "month", _MONTHS, "o_custkey")


@query(
    "rolling_distinct_avg",
    f"""WITH {EV}, r AS (SELECT DISTINCT user_id, day, day + CAST(k AS INTEGER) AS date_events FROM ev, range(7) t(k))
        SELECT date_events, count(*) / 7.0::DOUBLE AS dau_7day_avg FROM r GROUP BY date_events""",
)
def _(spark, sf):
    ev = events(spark, sf).withColumnRenamed("day", "date_events")
    pairs = rolling_distinct(ev, "date_events", ["user_id"], 7)
    return pairs.select("date_events", (F.col("pairs") / F.lit(7)).alias("dau_7day_avg"))


@query(
    "contact_rate",
    f"""WITH {EV} SELECT day, count(DISTINCT CASE WHEN event_type = 'error' THEN event_id END)::DOUBLE
          / nullif(count(DISTINCT user_id), 0)::DOUBLE * 100000 AS rate FROM ev GROUP BY day""",
)
def _(spark, sf):
    errors = F.count_distinct(F.when(F.col("event_type") == "error", F.col("event_id")))
    counts = events(spark, sf).groupBy("day").agg(
        errors.alias("errors"), F.count_distinct("user_id").alias("users")
    )
    return counts.select("day", rate_per(F.col("errors"), F.col("users"), 100000).alias("rate"))


@query(
    "sell_through_projection",
    f"""WITH {LI}, s AS (SELECT l_partkey, sum(qty)::BIGINT AS shipped FROM li
          WHERE ship > (SELECT max(ship) FROM li) - 7 GROUP BY l_partkey)
        SELECT l_partkey, shipped, shipped * 4 AS projected, p_size * 10 AS stock,
          p_size * 10 - shipped * 4 AS signal FROM s LEFT JOIN part ON l_partkey = p_partkey""",
)
def _(spark, sf):
    shipped = (
        window_to_max(lines(spark, sf), "ship", 7)
        .groupBy("l_partkey")
        .agg(F.sum("qty").alias("shipped"))
        .withColumn("projected", F.col("shipped") * 4)
    )
    stock = load(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), (F.col("p_size") * 10).alias("stock")
    )
    joined = shipped.join(stock, "l_partkey", "left")
    return joined.withColumn("signal", F.col("stock") - F.col("projected"))


@query(
    "ad_profit",
    f"""WITH {EV} SELECT user_id, CAST(coalesce(sum(val) FILTER (event_type = 'purchase'), 0)
          - coalesce(sum(val) FILTER (event_type = 'click'), 0) - 0.15 * count(*) FILTER (event_type = 'purchase')
          - 1.25 * count(*) FILTER (event_type = 'purchase') AS DOUBLE) AS profit,
          CAST(sum(val) FILTER (event_type = 'purchase') AS DOUBLE)
            / CAST(nullif(sum(val) FILTER (event_type = 'click'), 0) AS DOUBLE) AS roas
        FROM ev GROUP BY user_id""",
)
def _(spark, sf):
    def total(kind):
        return F.sum(F.when(F.col("event_type") == kind, F.col("val")))

    totals = events(spark, sf).groupBy("user_id").agg(
        total("purchase").alias("sales"),
        total("click").alias("spend"),
        F.count(F.when(F.col("event_type") == "purchase", 1)).alias("units"),
    )
    sales, spend = F.coalesce("sales", F.lit(0)), F.coalesce("spend", F.lit(0))
    fee, cost = F.lit("-0.15").cast("decimal(4,2)"), F.lit("1.25").cast("decimal(4,2)")
    return totals.select(
        "user_id",
        ad_profit(sales, spend, fee, cost, F.col("units")).alias("profit"),
        safe_div(F.col("sales").cast("double"), F.col("spend").cast("double")).alias("roas"),
    )


@query(
    "aging_value",
    f"""WITH {LI}, n AS (SELECT max(ship) AS newest FROM li),
        u AS (SELECT l_partkey, sum(qty) FILTER (newest - ship <= 365) AS young,
            sum(qty) FILTER (newest - ship > 365) AS old FROM li, n GROUP BY l_partkey)
        SELECT l_partkey, CAST(coalesce(young * CAST(p_retailprice AS DECIMAL(18,2)), 0) AS DOUBLE) AS young_usd,
          CAST(coalesce(old * CAST(p_retailprice AS DECIMAL(18,2)), 0) AS DOUBLE) AS old_usd
        FROM u LEFT JOIN (SELECT * FROM part WHERE p_size < 45) ON l_partkey = p_partkey""",
)
def _(spark, sf):
    rows = lines(spark, sf)
    age = F.datediff(rows.select(F.max("ship")).scalar(), F.col("ship"))
    units = rows.groupBy("l_partkey").agg(
        F.sum(F.when(age <= 365, F.col("qty"))).alias("young"),
        F.sum(F.when(age > 365, F.col("qty"))).alias("old"),
    )
    # large parts have no cost, on purpose: their units must be worth nothing
    cost = (
        load(spark, sf, "part", ["p_retailprice"])
        .filter(F.col("p_size") < 45)
        .select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    )
    buckets = {"young_usd": "young", "old_usd": "old"}
    valued = aging_value(units.join(cost, "l_partkey", "left"), buckets, "p_retailprice")
    return valued.select("l_partkey", *buckets)
