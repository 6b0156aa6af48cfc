"""Bank feeds: orders are deals and repayments, customers are clients, suppliers are
operators, nations are offices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import (
    account_open_events,
    early_repayment_events,
    load_account_day,
    read_account_feed,
)
from ..session import fresh_path
from ..sources import load
from .base import LI, ORD, lines, orders, query

GROUPS = tuple(range(1, 26))


def _source(status: str = "o_orderstatus"):
    return F.when(F.col(status) == "F", "3C").when(F.col(status) == "O", "NOM").otherwise("XX")


def _clients(spark, sf) -> dict[str, DataFrame]:
    customer = load(spark, sf, "customer")
    party = (F.col("c_custkey") + 500000).alias("hid_party")
    number = (F.lit(9000000000) + F.col("c_custkey") * 7919).cast("string")
    phones = customer.filter(F.col("c_nationkey") != 5).select(
        party,
        F.lit("7").alias("countrycode"),
        number.alias("telephone"),
        F.lit(0).alias("is_deleted"),
        F.when(F.col("c_mktsegment") == "BUILDING", 0).otherwise(1).alias("primary_flag"),
        F.lit(3).alias("phone_type"),
        F.lit(dt.date(2010, 1, 1)).alias("startdate"),
    )
    older = phones.withColumns(
        {"startdate": F.lit(dt.date(2005, 1, 1)), "telephone": F.lit("1111111111")}
    )
    return {
        "customers": customer.select(
            F.col("c_custkey").alias("id"),
            party,
            F.col("c_mktsegment").alias("party_type"),
            F.when(F.col("c_acctbal") < 0, "1").otherwise("0").alias("fl_del"),
        ),
        "persons": customer.select(
            party,
            F.col("c_name").alias("surname"),
            F.col("c_mktsegment").alias("name"),
            F.lit(None).cast("string").alias("patronymic"),
            F.when(F.col("c_nationkey") == 24, 1).otherwise(0).alias("is_deleted"),
        ),
        "phones": phones,
        "phone_history": phones.unionByName(older),
        "offices": load(spark, sf, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.when(F.col("n_regionkey") == 4, "XX").otherwise("3C").alias("source_id"),
            F.col("n_regionkey").alias("mngm_office_id"),
            F.lower("n_name").alias("ag_addr"),
        ),
        "office_star": load(spark, sf, "region").select(
            F.col("r_regionkey").alias("id"),
            F.lower("r_name").alias("office"),
            F.concat(F.lower("r_name"), F.lit(" street")).alias("address"),
        ),
        "operators": load(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("id"),
            F.when(F.col("s_nationkey") == 3, "IBANK")
            .when(F.col("s_nationkey") == 4, None)
            .otherwise(F.lower("s_name"))
            .alias("descr"),
            F.when(F.col("s_nationkey") > 20, "XX").otherwise("3C").alias("source_id"),
        ),
    }


_CLIENTS = """
cust AS (SELECT c_custkey AS id, c_custkey + 500000 AS hid, c_mktsegment AS seg, c_nationkey AS nk, c_name
  FROM customer WHERE c_acctbal >= 0),
pers AS (SELECT c_custkey + 500000 AS hid, c_name, c_mktsegment FROM customer WHERE c_nationkey <> 24),
tel AS (SELECT c_custkey + 500000 AS hid, '+7(***)' || right(CAST(9000000000 + c_custkey * 7919 AS VARCHAR), 7) AS phone
  FROM customer WHERE c_nationkey <> 5 AND c_mktsegment <> 'BUILDING'),
off AS (SELECT * FROM nation WHERE n_regionkey <> 4),
oper AS (SELECT s_suppkey, s_nationkey, CASE WHEN s_nationkey = 3 THEN 'IBANK' WHEN s_nationkey <> 4 THEN upper(s_name) END AS descr
  FROM supplier WHERE s_nationkey <= 20)"""


def account_tables(spark, sf) -> dict[str, DataFrame]:
    ord_, rows, part = orders(spark, sf), lines(spark, sf), load(spark, sf, "part")
    key, day = F.col("o_orderkey"), F.col("odate")
    sizes = part.groupBy("p_size").agg(
        F.min("p_type").alias("kind"), F.min("p_brand").alias("brand")
    )
    nation = load(spark, sf, "nation")
    op = F.concat(F.lit("OP"), F.col("p_size"))
    return _clients(spark, sf) | {
        "deals": ord_.select(
            key.alias("id"),
            _source().alias("source_id"),
            day.alias("deal_fd"),
            F.lit(None).cast("date").alias("deal_closed_date"),
            F.col("o_custkey").alias("cust_id"),
            F.col("o_orderpriority").alias("deal_type_id"),
            F.col("o_custkey").alias("product_id"),
        ),
        "deal_types": ord_.select(F.col("o_orderpriority").alias("id")).distinct(),
        "products": part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("product_group")),
        "product_groups": sizes.select(F.col("p_size").alias("id")),
        "account_deals": ord_.select(key.alias("deal_id"), key.alias("account_id")),
        "accounts": ord_.select(
            key.alias("id"),
            F.when(F.col("o_orderpriority") == "5-LOW", F.date_add(day, 1)).otherwise(day).alias("open_dt"),
            F.lit("3C").alias("source_id"),
            F.when(F.col("o_custkey") % 2 == 0, 810).otherwise(840).alias("crnc"),
        ),
        "party_types": load(spark, sf, "customer")
        .filter(F.col("c_mktsegment") != "MACHINERY")
        .select(F.col("c_mktsegment").alias("source_name"))
        .distinct()
        .withColumn("type_code", F.substring("source_name", 1, 2)),
        "deal_operators": rows.select(
            F.col("l_orderkey").alias("deal_id"),
            F.col("l_suppkey").alias("operator_id"),
            F.date_sub("ship", 400).alias("d_open"),
            F.date_add("ship", 400).alias("d_close"),
            F.when(F.col("l_returnflag") == "R", "XX").otherwise("NOM").alias("source_id"),
        ),
        "deal_contracts": ord_.select(
            key.alias("deal_id"), (key + 3000000000).alias("passivedeal_id")
        ),
        "passive_deal_offices": ord_.select(
            (key + 3000000000).alias("passivedeal_id"),
            (F.col("o_custkey") % 25).alias("ag_id"),
            F.date_sub(day, 30).alias("dt_bgn"),
            F.when(F.col("o_orderpriority") == "2-HIGH", F.date_sub(day, 1))
            .otherwise(F.date_add(day, 30))
            .alias("dt_end"),
            F.lit("3C").alias("source_id"),
        ),
        "operation_map": sizes.select(F.col("p_size").alias("source_id"), op.alias("target")),
        "operations": sizes.filter(F.col("p_size") != 9).select(
            op.alias("operation_code"),
            F.col("kind").alias("operation_name"),
            F.col("brand").alias("operation_type_name"),
            F.lit("Accounts").alias("operation_grp_name"),
        ),
        "operation_channels": sizes.select(op.alias("operation_code")),
        "channel_map": load(spark, sf, "supplier").select(
            F.lower("s_name").alias("source"), F.col("s_nationkey").alias("target")
        ),
        "channels": nation.filter(F.col("n_regionkey") == 1).select(
            F.col("n_nationkey").alias("operation_channel_code"),
            F.col("n_name").alias("operation_channel_name"),
        ),
        "product_validity": ord_.select(
            (key + 3000000000).alias("contract_id"),
            key.alias("account_id"),
            day.alias("date_from"),
            F.date_add(day, 365).alias("date_to"),
            F.when(F.col("o_orderpriority") == "3-MEDIUM", "A").otherwise("P").alias("contract_type"),
            (F.col("o_custkey") % 50 + 1).cast("int").alias("product_group_id"),
        ),
        "product_star": sizes.select(
            F.col("p_size").alias("group3_id"),
            F.lower("kind").alias("product_name"),
            F.lower("brand").alias("group_name2"),
        ),
    }


ACCOUNT_SQL = f"""WITH {LI}, {ORD}, {_CLIENTS},
sz AS (SELECT p_size, min(p_type) AS kind, min(p_brand) AS brand FROM part GROUP BY p_size),
seed AS (SELECT o.*, p_size AS grp, l_suppkey, s_nationkey, descr FROM ord o JOIN part ON p_partkey = o_custkey AND p_size <= 25
  JOIN li ON l_orderkey = o_orderkey AND l_returnflag <> 'R' AND abs(date_diff('day', ship, odate)) <= 400
  JOIN oper ON s_suppkey = l_suppkey AND descr <> 'IBANK'
  WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW')
SELECT CAST(o_orderkey AS VARCHAR) || '-3C-OPN' AS "OPERATION_ID", CASE o_orderstatus WHEN 'F' THEN '3C' ELSE 'NOM' END AS "SOURCE_CODE",
 '0' AS "OPERATION_CODE", coalesce(ch.n_name, 'Unknown') AS "OPERATION_CHANNEL_CODE", odate AS "OPERATION_START_DTTM",
 '0' AS "OPERATION_END_DTTM", 'TBD' AS "PROCESS_NAME", 'TBD' AS "PROCESS_STAGE_NAME", op.kind AS "OPERATION_NAME",
 'SELF-SERVICE' AS "OPERATION_METHOD_NAME", op.brand AS "OPERATION_TYPE_NAME",
 CASE WHEN op.p_size IS NOT NULL THEN 'Accounts' END AS "OPERATION_GRP_NAME",
 CASE WHEN seg <> 'MACHINERY' THEN substr(seg, 1, 2) END AS "PARTYTYPE_CODE", '0' AS "STANDART_DURATION", '0' AS "STANDART_PASSED_FLAG",
 upper(st.kind) AS "PRODUCT_NAME", upper(st.brand) AS "PRODUCTGRP_NAME",
 CASE WHEN ch.n_name IS NULL THEN 'Y' ELSE 'N' END AS "TARGET_CHANNEL_FLAG", CASE WHEN ch.n_name IS NULL THEN 'Y' ELSE 'N' END AS "FRONT_OFFICE_FLAG",
 'COMPLETED' AS "OPERATION_STATUS_NAME", 'N' AS "CANCEL_FLAG", cust.id AS "PARTY_ID", ' ' AS "PARTY_SEGMENT_CODE",
 CASE WHEN pers.hid IS NULL THEN 'N/A' ELSE upper(pers.c_name) || ' ' || upper(pers.c_mktsegment) || ' ' END AS "PARTY_FULL_NAME",
 phone AS "PARTY_PHONE_NO", '0' AS "IB_REGESTRATION_FLAG", '0' AS "MB_REGISTRATION_FLAG",
 CASE WHEN o_custkey % 2 = 0 THEN 'RUR' END AS "CURRENCY_CODE", '0' AS "OPERATION_NM_AMT", '0' AS "OPERATION_EQ_RUB",
 'TBD' AS "COMMISION_NM_AMT", 'TBD' AS "COMISSION_EQ_RUB", l_suppkey AS "EMPLOYEE_ID", '0' AS "EMPLOYEE_CODE",
 descr AS "EMPLOYEE_FULL_NAME", CAST(off.n_nationkey AS VARCHAR) AS "ORGSTRUCT_BRANCH_ID", CAST(r_regionkey AS VARCHAR) AS "ORGSTRUCT_BRANCH_CODE",
 r_name AS "ORGSTRUCT_BRANCH_NAME", '0' AS "ATM_ID", off.n_name AS "ADDINFO_DESC"
FROM seed LEFT JOIN cust ON cust.id = o_custkey LEFT JOIN pers ON pers.hid = cust.hid LEFT JOIN tel ON tel.hid = cust.hid
LEFT JOIN off ON off.n_nationkey = o_custkey % 25 AND o_orderpriority <> '2-HIGH' LEFT JOIN region ON r_regionkey = off.n_regionkey
LEFT JOIN sz op ON op.p_size = grp AND grp <> 9
LEFT JOIN nation ch ON ch.n_nationkey = s_nationkey AND ch.n_regionkey = 1
LEFT JOIN sz st ON st.p_size = o_custkey % 50 + 1 AND o_orderpriority <> '3-MEDIUM'"""


@query("account_open_events", ACCOUNT_SQL)
def _(spark, sf):
    """The feed of all days."""
    return account_open_events(
        account_tables(spark, sf), groups=GROUPS, first_day=dt.date(1990, 1, 1)
    )


@query(
    "account_open_events_day",
    f"""SELECT * FROM ({ACCOUNT_SQL}) WHERE "OPERATION_START_DTTM" = DATE '1998-12-09'""",
)
def _(spark, sf):
    """An incremental run for one day."""
    return account_open_events(account_tables(spark, sf), day=dt.date(1998, 12, 9), groups=GROUPS)


@query(
    "account_feed_load",
    f"""SELECT * FROM ({ACCOUNT_SQL}) WHERE "OPERATION_START_DTTM" IN (DATE '1998-12-08', DATE '1998-12-09')""",
)
def _(spark, sf):
    """Two daily loads, one of them run twice, and the table read back."""
    path, tables = fresh_path(spark, "account_feed"), account_tables(spark, sf)
    for day in (dt.date(1998, 12, 8), dt.date(1998, 12, 9), dt.date(1998, 12, 8)):
        load_account_day(tables, day, path, groups=GROUPS)
    return read_account_feed(tables, path)


def repayment_tables(spark, sf) -> dict[str, DataFrame]:
    ord_, customer = orders(spark, sf), load(spark, sf, "customer")
    key, day, cust = F.col("o_orderkey"), F.col("odate"), F.col("o_custkey")
    urgent = ord_.filter(F.col("o_orderpriority") == "1-URGENT")
    first, last = F.lit(dt.date(1990, 1, 1)), F.lit(dt.date(2099, 12, 31))

    def links(contract, account, kind, df):
        return df.select(
            contract.alias("contract_id"),
            account.alias("account_id"),
            F.lit(kind).alias("link_type"),
            first.alias("dt_bgn"),
            last.alias("dt_end"),
            F.lit(0).alias("fl_del"),
            F.lit("ActiveDeal").alias("type"),
        )

    client = F.col("c_custkey")
    daily = ord_.groupBy("o_custkey", "odate")
    principal = (cust + 2000000000).alias("accnt_id")
    nation = load(spark, sf, "nation")
    halves = F.explode(
        F.array(
            F.struct(F.lit(dt.date(1995, 1, 1)).alias("a"), F.lit(dt.date(1998, 6, 30)).alias("b"), F.lit(0).alias("g")),
            F.struct(F.lit(dt.date(1998, 7, 1)).alias("a"), F.lit(dt.date(2099, 12, 31)).alias("b"), F.lit(1).alias("g")),
        )
    )
    tables = _clients(spark, sf)
    return tables | {
        "phones": tables["phone_history"],
        "repayments": ord_.select(
            F.when(F.col("o_orderstatus") == "P", "NOM").otherwise("3C").alias("source_id"),
            key.alias("id"),
            day.alias("dt"),
            (key * 2).alias("sem_id"),
            (cust % 25).alias("ag_id"),
            cust.alias("db_cust_id"),
            cust.alias("contract_id"),
            F.when(F.col("o_orderpriority") == "5-LOW", 27877)
            .when(F.col("o_orderpriority") != "4-NOT SPECIFIED", key % 50)
            .alias("operator_cre_id"),
            cust.alias("db_accnt_id"),
            F.date_add(day, (key % 5).cast("int")).alias("prov_dt"),
        ),
        "account_contracts": links(cust, key, 457, urgent)
        .unionByName(links(client, client + 1000000000, 457, customer))
        .unionByName(links(client, client + 2000000000, 1, customer)),
        "migrations": urgent.select(key.alias("old_acc_id"), day.alias("migration_date")),
        "repayment_balances": daily.agg(F.sum("total").alias("acct_blnc_eod"))
        .select((cust + 1000000000).alias("accnt_id"), day.alias("dt"), "acct_blnc_eod")
        .unionByName(
            urgent.select(key.alias("accnt_id"), day.alias("dt"), F.col("total").alias("acct_blnc_eod"))
        ),
        "account_balances": daily.agg(
            F.max(F.when(F.col("o_orderstatus") != "P", F.col("total"))).alias("acct_blnc_eod")
        ).select(principal, day.alias("dt"), F.lit("3C").alias("source_id"), "acct_blnc_eod"),
        "product_validity": customer.select(client, "c_nationkey", halves.alias("h")).select(
            client.alias("contract_id"),
            (client + 2000000000).alias("account_id"),
            F.col("h.a").alias("date_from"),
            F.col("h.b").alias("date_to"),
            F.lit("A").alias("contract_type"),
            (F.col("c_nationkey") + F.col("h.g")).alias("product_group_id"),
        ),
        "product_star": nation.select(
            F.col("n_nationkey").alias("group3_id"),
            F.lower("n_name").alias("product_name"),
            F.concat(F.lit("group "), F.col("n_regionkey")).alias("group_name"),
            first.alias("date_from"),
            F.when(F.col("n_nationkey") < 5, F.lit(dt.date(1999, 12, 31))).otherwise(last).alias("date_to"),
        ),
        "accounts": customer.select(
            client.alias("id"), F.when(F.col("c_nationkey") < 12, 810).otherwise(840).alias("crnc")
        ),
        "currencies": nation.filter(F.col("n_nationkey") < 3).select(
            F.when(F.col("n_nationkey") < 2, 810).otherwise(840).alias("source_code"),
            F.when(F.col("n_nationkey") == 1, "NOM").otherwise("3C").alias("source_id"),
            F.element_at(
                F.array(F.lit("RUR"), F.lit("RUB"), F.lit("USD")), F.col("n_nationkey") + 1
            ).alias("target_code"),
        ),
    }


@query(
    "early_repayment_events",
    f"""WITH {ORD}, {_CLIENTS},
ro AS (SELECT o_orderkey AS id, o_custkey AS c, odate AS dt, CASE WHEN o_orderstatus = 'P' THEN 'NOM' ELSE '3C' END AS src,
    o_orderkey % 50 AS op, row_number() OVER (PARTITION BY o_custkey, odate ORDER BY odate + CAST(o_orderkey % 5 AS INTEGER) DESC, o_orderkey) AS n
  FROM ord WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')),
mig AS (SELECT c, acc, md, coalesce(lag(md + 1) OVER (PARTITION BY c ORDER BY md NULLS LAST, acc), DATE '1990-01-01') AS f,
    coalesce(md, DATE '2099-12-31') AS t FROM (
      SELECT o_custkey AS c, o_orderkey AS acc, odate AS md FROM ord WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT c_custkey, c_custkey + 1000000000, NULL FROM customer)),
bal AS (SELECT o_custkey + 1000000000 AS acc, odate AS dt, sum(total) AS b FROM ord GROUP BY ALL
  UNION ALL SELECT o_orderkey, odate, total FROM ord WHERE o_orderpriority = '1-URGENT'),
prin AS (SELECT o_custkey AS c, odate AS dt FROM ord WHERE o_orderstatus <> 'P' GROUP BY ALL)
SELECT CAST(ro.id AS VARCHAR) || '-' || src AS "OPERATION_ID", src AS "SOURCE_CODE", ro.id * 2 AS "OPERATION_SOURCE_ID",
 'Branch' AS "OPERATION_CHANNEL_CODE", ro.dt AS "OPERATION_START_DTTM", ro.dt AS "OPERATION_END_DTTM", 'Loan Operations' AS "PROCESS_NAME",
 'Loan Operations' AS "PROCESS_STAGE_NAME", 'Early Loan Repayment (Partial/Full)' AS "OPERATION_NAME", 'Not Defined' AS "OPERATION_DIRECTION",
 'Not Defined' AS "OPERATION_METHOD_NAME", 'Not Defined' AS "OPERATION_KIND_NAME", 'Retail Banking' AS "OPERATION_TYPE_NAME",
 'Loan Operations' AS "OPERATION_GRP_NAME", 'FL' AS "PARTYTYPE_CODE", 0 AS "STANDARD_DURATION", 'U' AS "STANDARD_PASSED_FLAG",
 pn.n_name AS "PRODUCT_NAME", upper('group ' || pn.n_regionkey) AS "PRODUCTGRP_NAME", 'N' AS "TARGET_CHANNEL_FLAG", 'Y' AS "FRONT_OFFICE_FLAG",
 'Completed' AS "OPERATION_STATUS_NAME", 'N' AS "CANCEL_FLAG", cust.hid AS "PARTY_ID", 'Not Defined' AS "PARTY_SEGMENT_CODE",
 coalesce(upper(pers.c_name), '') || ' ' || coalesce(upper(pers.c_mktsegment), '') || ' ' AS "PARTY_FULL_NAME", phone AS "PARTY_PHONE_NO",
 'U' AS "IB_REGISTRATION_FLAG", 'U' AS "MB_REGISTRATION_FLAG",
 CASE WHEN cn.c_nationkey < 12 THEN CASE src WHEN '3C' THEN 'RUR' ELSE 'RUB' END WHEN src = '3C' THEN 'USD' END AS "CURRENCY_CODE",
 CAST(coalesce(b, 0) AS DOUBLE) AS "OPERATION_NM_AMT", 0 AS "OPERATION_EQ_RUB", 0 AS "COMMISSION_NM_AMT", 0 AS "COMMISSION_EQ_RUB",
 s_suppkey AS "EMPLOYEE_ID", 0 AS "EMPLOYEE_CODE", descr AS "EMPLOYEE_FULL_NAME", CAST(off.n_nationkey AS BIGINT) AS "ORGSTRUCT_BRANCH_ID",
 r_regionkey AS "ORGSTRUCT_BRANCH_CODE", r_name AS "ORGSTRUCT_BRANCH_NAME", 0 AS "ATM_ID", upper(r_name || ' street') AS "ADDINFO_DESC"
FROM ro LEFT JOIN mig ON mig.c = ro.c AND ro.dt BETWEEN mig.f AND mig.t
LEFT JOIN bal ON bal.acc = mig.acc AND bal.dt = ro.dt
LEFT JOIN prin ON prin.c = ro.c AND prin.dt = ro.dt
LEFT JOIN customer pc ON pc.c_custkey = prin.c
LEFT JOIN nation pn ON pn.n_nationkey = pc.c_nationkey + CASE WHEN ro.dt > DATE '1998-06-30' THEN 1 ELSE 0 END
  AND (pn.n_nationkey >= 5 OR ro.dt <= DATE '1999-12-31')
LEFT JOIN customer cn ON cn.c_custkey = ro.c
LEFT JOIN cust ON cust.id = ro.c LEFT JOIN pers ON pers.hid = cust.hid LEFT JOIN tel ON tel.hid = cust.hid
LEFT JOIN off ON off.n_nationkey = ro.c % 25 LEFT JOIN region ON r_regionkey = off.n_regionkey
LEFT JOIN oper ON s_suppkey = op WHERE ro.n = 1""",
)
def _(spark, sf):
    """Buckets of a year guard customers with very many migrations."""
    return early_repayment_events(repayment_tables(spark, sf))
