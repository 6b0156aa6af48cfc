"""Registry and the shared shapes of the driver tables.

A query is a function ``(spark, sf_dir) -> DataFrame``; its SQL check is written on its own,
in another form than the DataFrame code where there is one. Money is decimal while computing
and double in the result, because the two engines name decimal types differently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, everything else as it is."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in decimals}) if decimals else df


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with whole quantities, decimal money and dates."""
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_discount").cast("decimal(4,2)").alias("disc"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        "l_returnflag",
        "l_linestatus",
        F.to_date("l_shipdate").alias("ship"),
    )


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """orders with decimal money and dates."""
    return load(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.to_date("o_orderdate").alias("odate"),
        "o_orderpriority",
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        "event_id",
        "ts",
        F.to_date("ts").alias("day"),
        "user_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("val"),
    )


# The same shapes for the SQL checks.
LI = """li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CAST(l_quantity AS BIGINT) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax,
  l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship FROM lineitem)"""
ORD = """ord AS (SELECT o_orderkey, o_custkey, o_orderstatus,
  CAST(o_totalprice AS DECIMAL(18,2)) AS total, CAST(o_orderdate AS DATE) AS odate,
  o_orderpriority FROM orders)"""
EV = """ev AS (SELECT event_id, ts, CAST(ts AS DATE) AS day, user_id, event_type,
  CAST(value AS DECIMAL(18,2)) AS val FROM events)"""


def cents(expr: str) -> str:
    """A two-digit decimal as a whole number, for exact arithmetic in the SQL check."""
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def half_up(num: str, den: str) -> str:
    """Whole-number quotient rounded half up, as decimal division rounds."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"
