"""Bank operations as rows of one event model.

Both reports take their tables as a mapping from table name to DataFrame; the names are the
keys used below.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import concat0, flag_from_presence, mask_phone
from ..operators.dedup import latest_per_key
from ..operators.events import event_row
from ..operators.intervals import change_intervals, date_span, open_interval_join, valid_at_join
from ..operators.joins import DimJoin, enrich
from ..sources import event_day, publish, read_published

# Fixed values of the account-opening feed.
SOURCES = ("3C", "NOM")
ACCOUNT_GROUPS = (106, 19, 961, 3286, 381)
ONLINE_OPERATORS = ("TIBCO", "RBR", "IBANK")
FIRST_DAY = dt.date(2017, 1, 1)
NOT_CLOSED = dt.date(5555, 1, 1)
ROUBLE_CODE, ROUBLE = 810, "RUR"
PASSIVE = "P"

# Fixed values of the repayment feed.
SYSTEM_OPERATOR = 27877
REPAYMENT_LINK, PRINCIPAL_LINK = 457, 1
ACTIVE_DEAL = "ActiveDeal"
LOAN_SOURCE = "3C"
MOBILE = 3
ASSET = "A"

MISSING_NAME = "N/A"


# Days of a validity bucket: keys with very many validity rows are split by it.
BUCKET_DAYS = 366


def _full_name(prefix: str, missing: str | None = None) -> Column:
    """Upper-case name parts joined by blanks; ``missing`` where no part is known."""
    parts = [F.col(f"{prefix}{p}") for p in ("surname", "name", "patronymic")]
    name = F.upper(concat0(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2]))
    if missing is None:
        return name
    return F.when(F.coalesce(*parts).isNull(), F.lit(missing)).otherwise(name)


def _person(prefix: str) -> dict[str, str]:
    return {f"{prefix}{c}": c for c in ("surname", "name", "patronymic")}


def _client_lookup(
    t: Mapping[str, DataFrame], phone: DataFrame, take: Mapping[str, str], split_phone: bool = False
) -> DataFrame:
    """``cust_id`` with the columns of its customer in ``take``, its person's name and its phone.

    All three grow with the clients, so they are merged, and facts meet the result once instead of each of them.
    """
    customers = t["customers"].filter(F.col("fl_del") == "0")
    return enrich(
        customers.select(F.col("id").alias("cust_id"), *[F.col(c).alias(out) for out, c in take.items()]),
        [
            DimJoin(
                t["persons"],
                {"hid_party": "hid_party"},
                _person("person_"),
                where=F.col("is_deleted") == 0,
                merge=True,
            ),
            DimJoin(
                phone,
                {"hid_party": "hid_party"},
                {"telephone": "telephone", "countrycode": "countrycode"},
                split=split_phone,
                merge=True,
            ),
        ],
    )


def _same(df: DataFrame, *apart: str) -> dict[str, str]:
    return {c: c for c in df.columns if c not in apart}


def account_open_events(
    t: Mapping[str, DataFrame],
    day: dt.date | None = None,
    groups: Sequence[int] = ACCOUNT_GROUPS,
    first_day: dt.date = FIRST_DAY,
) -> DataFrame:
    """One event per current account opened on the day of its deal.

    With ``day`` only that day is read; without, the feed is rebuilt for all days. The joins
    that restrict the result come first and are inner joins, so the lookups after them meet
    only the rows of the report. Of those, the ones with rows per deal, contract or client are merged.
    """
    deals = t["deals"].filter(F.col("source_id").isin(*SOURCES))
    accounts = t["accounts"].filter(F.col("source_id").isin(*SOURCES))
    closed = F.coalesce(F.col("deal_closed_date"), F.lit(NOT_CLOSED))
    deals = deals.filter((F.col("deal_fd") >= F.lit(first_day)) | (closed >= F.lit(first_day)))
    if day is not None:
        deals = event_day(deals, "deal_fd", day)
        accounts = event_day(accounts, "open_dt", day)
    from_sources = F.col("source_id").isin(*SOURCES)
    # a superset of the report's dates is enough to place the validity buckets
    span = date_span(accounts, "open_dt") if day is None else (day, day)

    opened = enrich(
        deals.select(
            F.col("id").alias("deal_id"),
            "source_id",
            "deal_fd",
            "deal_type_id",
            "product_id",
            "cust_id",
        ),
        [
            DimJoin(t["products"], {"product_id": "id"}, {"group_id": "product_group"}, "inner"),
            DimJoin(
                t["product_groups"],
                {"group_id": "id"},
                how="inner",
                where=F.col("id").isin(*groups),
            ),
            DimJoin(t["account_deals"], {"deal_id": "deal_id"}, {"account_id": "account_id"}, "inner"),
            DimJoin(
                accounts,
                {"account_id": "id", "deal_fd": "open_dt"},
                {"account_source": "source_id", "open_dt": "open_dt", "crnc": "crnc"},
                "inner",
            ),
        ],
    )
    opened = valid_at_join(
        opened,
        t["deal_operators"].filter(from_sources),
        {"deal_id": "deal_id"},
        "open_dt",
        "d_open",
        "d_close",
        {"operator_id": "operator_id"},
        how="inner",
        bucket_days=BUCKET_DAYS,
        date_range=span,
    )
    opened = enrich(
        opened,
        [
            DimJoin(
                t["operators"],
                {"operator_id": "id"},
                {"employee_id": "id", "operator_name": "descr"},
                "inner",
                where=from_sources & ~F.col("descr").isin(*ONLINE_OPERATORS),
            ),
            DimJoin(t["deal_types"], {"deal_type_id": "id"}),
            DimJoin(
                t["deal_contracts"],
                {"deal_id": "deal_id"},
                {"passivedeal_id": "passivedeal_id"},
                merge=True,
            ),
        ],
    )
    placed = valid_at_join(
        opened,
        t["passive_deal_offices"].filter(from_sources),
        {"passivedeal_id": "passivedeal_id"},
        "open_dt",
        "dt_bgn",
        "dt_end",
        {"ag_id": "ag_id"},
        bucket_days=BUCKET_DAYS,
        date_range=span,
        merge=True,
    )
    named = valid_at_join(
        placed,
        t["product_validity"].filter(F.col("contract_type") == PASSIVE),
        {"passivedeal_id": "contract_id", "account_id": "account_id"},
        "deal_fd",
        "date_from",
        "date_to",
        {"product_group_id": "product_group_id"},
        bucket_days=BUCKET_DAYS,
        date_range=span,
        merge=True,
    )
    # the phones and the operators' channels may repeat events, so they come after all joins that sort the events
    phone = t["phones"].filter((F.col("is_deleted") == 0) & (F.col("primary_flag") == 1))
    client = _client_lookup(
        t, phone, {"party_id": "id", "hid_party": "hid_party", "party_type": "party_type"}
    )
    named = enrich(
        named, [DimJoin(client, {"cust_id": "cust_id"}, _same(client, "cust_id"), merge=True)]
    )
    named = enrich(
        named,
        [
            DimJoin(t["party_types"], {"party_type": "source_name"}, {"type_code": "type_code"}),
            DimJoin(
                t["offices"],
                {"ag_id": "id"},
                {"office_id": "id", "mngm_office_id": "mngm_office_id", "ag_addr": "ag_addr"},
                where=from_sources,
            ),
            DimJoin(t["operation_map"], {"group_id": "source_id"}, {"operation_target": "target"}),
            DimJoin(
                t["operations"],
                {"operation_target": "operation_code"},
                {
                    "operation_code": "operation_code",
                    "operation_name": "operation_name",
                    "operation_type_name": "operation_type_name",
                    "operation_grp_name": "operation_grp_name",
                },
            ),
            DimJoin(t["operation_channels"], {"operation_code": "operation_code"}),
            DimJoin(t["channel_map"], {"operator_name": "source"}, {"channel_code": "target"}),
            DimJoin(
                t["channels"],
                {"channel_code": "operation_channel_code"},
                {"channel_name": "operation_channel_name"},
            ),
        ],
    )
    named = enrich(
        named,
        [
            DimJoin(
                t["product_star"],
                {"product_group_id": "group3_id"},
                {"product_name": "product_name", "group_name2": "group_name2"},
            ),
            DimJoin(
                t["office_star"],
                {"mngm_office_id": "id"},
                {"branch_id": "id", "branch": "office"},
            ),
        ],
    )
    at_branch = flag_from_presence(F.col("channel_name"), "N", "Y")
    # Column names and constants of the event model.
    return event_row(
        named,
        {
            "OPERATION_ID": concat0(
                F.col("account_id"), F.lit("-"), F.col("account_source"), F.lit("-OPN")
            ),
            "SOURCE_CODE": F.col("source_id"),
            "OPERATION_CODE": "0",
            "OPERATION_CHANNEL_CODE": F.coalesce(F.col("channel_name"), F.lit("Unknown")),
            "OPERATION_START_DTTM": F.col("deal_fd"),
            "OPERATION_END_DTTM": "0",
            "PROCESS_NAME": "TBD",
            "PROCESS_STAGE_NAME": "TBD",
            "OPERATION_NAME": F.col("operation_name"),
            "OPERATION_METHOD_NAME": "SELF-SERVICE",
            "OPERATION_TYPE_NAME": F.col("operation_type_name"),
            "OPERATION_GRP_NAME": F.col("operation_grp_name"),
            "PARTYTYPE_CODE": F.col("type_code"),
            "STANDART_DURATION": "0",
            "STANDART_PASSED_FLAG": "0",
            "PRODUCT_NAME": F.upper("product_name"),
            "PRODUCTGRP_NAME": F.upper("group_name2"),
            "TARGET_CHANNEL_FLAG": at_branch,
            "FRONT_OFFICE_FLAG": at_branch,
            "OPERATION_STATUS_NAME": "COMPLETED",
            "CANCEL_FLAG": "N",
            "PARTY_ID": F.col("party_id"),
            "PARTY_SEGMENT_CODE": " ",
            "PARTY_FULL_NAME": _full_name("person_", MISSING_NAME),
            "PARTY_PHONE_NO": mask_phone(F.col("countrycode"), F.col("telephone")),
            "IB_REGESTRATION_FLAG": "0",
            "MB_REGISTRATION_FLAG": "0",
            "CURRENCY_CODE": F.when(F.col("crnc") == ROUBLE_CODE, F.lit(ROUBLE)),
            "OPERATION_NM_AMT": "0",
            "OPERATION_EQ_RUB": "0",
            "COMMISION_NM_AMT": "TBD",
            "COMISSION_EQ_RUB": "TBD",
            "EMPLOYEE_ID": F.col("employee_id"),
            "EMPLOYEE_CODE": "0",
            "EMPLOYEE_FULL_NAME": F.upper("operator_name"),
            "ORGSTRUCT_BRANCH_ID": F.upper(F.col("office_id").cast("string")),
            "ORGSTRUCT_BRANCH_CODE": F.upper(F.col("branch_id").cast("string")),
            "ORGSTRUCT_BRANCH_NAME": F.upper("branch"),
            "ATM_ID": "0",
            "ADDINFO_DESC": F.upper("ag_addr"),
        },
    )


def load_account_day(
    t: Mapping[str, DataFrame],
    day: dt.date,
    target: str,
    groups: Sequence[int] = ACCOUNT_GROUPS,
    first_day: dt.date = FIRST_DAY,
) -> None:
    """Load one day of the account feed into its folder; the other days stay as they are.

    Readers see the day before or after the load, never half of it. A rerun replaces the day alone, and empties it
    if there are no events any more. ``read_account_feed`` reads the folder.
    """
    events = account_open_events(t, day, groups, first_day)
    publish(events, target, F.to_date("OPERATION_START_DTTM"), replaces=[day])


def read_account_feed(
    t: Mapping[str, DataFrame], target: str, days: Sequence[dt.date] | None = None
) -> DataFrame:
    """The loaded days of the account feed, or just ``days``, with the feed's own columns."""
    schema = account_open_events(t, day=FIRST_DAY).schema
    return read_published(next(iter(t.values())).sparkSession, target, schema, days)


def migration_periods(links: DataFrame, migrations: DataFrame) -> DataFrame:
    """Which repayment account served a contract when: one period per account migration.

    Chunked by day, so that a contract with very many migrations does not meet in one task. Migrations grow
    with the contracts, so they are merged.
    """
    active = (
        (F.col("link_type") == REPAYMENT_LINK)
        & (F.col("fl_del") == 0)
        & (F.col("type") == ACTIVE_DEAL)
    )
    dated = enrich(
        links.filter(active).select("contract_id", "account_id", "dt_bgn", "dt_end"),
        [
            DimJoin(
                migrations,
                {"account_id": "old_acc_id"},
                {"migration_date": "migration_date"},
                merge=True,
            )
        ],
    )
    return change_intervals(
        dated, "contract_id", "migration_date", ["account_id"], chunk=F.col("migration_date")
    )


def early_repayment_events(
    t: Mapping[str, DataFrame],
    tie_break: Sequence[str] = ("id",),
    bucket_days: int = BUCKET_DAYS,
    product_bounded: bool = True,
) -> DataFrame:
    """One event per contract and repayment day, with the balance of the account that served
    the contract on that day.

    ``bucket_days`` guards contracts with very many migrations or product changes. ``product_bounded`` asks for
    product names valid on the day.

    Tables with rows per contract, account or client grow with the events and are merged. Those per client are put
    together before the events meet them, once and last, so that the joins before carry no names.
    """
    entered = t["repayments"].filter(F.col("operator_cre_id") != SYSTEM_OPERATOR)
    seed = latest_per_key(entered, ["contract_id", "dt"], ["prov_dt"], tie_break).select(
        "source_id",
        "id",
        "dt",
        "sem_id",
        "ag_id",
        "db_cust_id",
        "contract_id",
        "operator_cre_id",
        "db_accnt_id",
    )
    periods = migration_periods(t["account_contracts"], t["migrations"])
    # from the stored column: a superset of the seed's dates places the buckets as well
    span = date_span(t["repayments"], "dt")
    bounds = {
        "date_range": span,
        "at": "dt",
        "start": "start_dt",
        "start_default": "dt_bgn",
        "end": "migration_date",
        "end_default": "dt_end",
        "bucket_days": bucket_days,
        "merge": True,
    }
    events = open_interval_join(
        seed,
        periods,
        {"contract_id": "contract_id"},
        take={"repayment_account": "account_id"},
        **bounds,
    )

    # principal loan account, known by a balance on the day
    principal = (F.col("link_type") == PRINCIPAL_LINK) & (F.col("fl_del") == 0)
    loans = t["account_contracts"].filter(principal & (F.col("type") == ACTIVE_DEAL))
    known_balance = (F.col("source_id") == LOAN_SOURCE) & F.col("acct_blnc_eod").isNotNull()
    loan_days = enrich(
        seed.select("contract_id", "dt"),
        [
            DimJoin(
                loans, {"contract_id": "contract_id"}, {"loan_account": "account_id"}, "inner", merge=True
            ),
            DimJoin(
                t["account_balances"],
                {"loan_account": "accnt_id", "dt": "dt"},
                how="inner",
                where=known_balance,
                merge=True,
            ),
        ],
    )
    events = enrich(
        events,
        [
            DimJoin(
                loan_days,
                {"contract_id": "contract_id", "dt": "dt"},
                {"loan_account": "loan_account"},
                merge=True,
            ),
            DimJoin(
                t["repayment_balances"],
                {"repayment_account": "accnt_id", "dt": "dt"},
                {"balance_account": "accnt_id", "balance": "acct_blnc_eod"},
                merge=True,
            ),
        ],
    )
    # an account serving several contracts on the day repeats its balance row
    events = open_interval_join(
        events, periods, {"balance_account": "account_id"}, take={}, **bounds
    )

    phone = latest_per_key(
        t["phones"].filter(
            (F.col("is_deleted") == 0)
            & (F.col("primary_flag") == 1)
            & (F.col("phone_type") == MOBILE)
        ),
        ["hid_party"],
        ["startdate"],
        ["telephone"],
    )
    events = valid_at_join(
        events,
        t["product_validity"].filter(F.col("contract_type") == ASSET),
        {"contract_id": "contract_id", "loan_account": "account_id"},
        "dt",
        "date_from",
        "date_to",
        {"product_group_id": "product_group_id"},
        bucket_days=bucket_days,
        date_range=span,
        merge=True,
    )
    client = _client_lookup(t, phone, {"hid_party": "hid_party"}, split_phone=True)
    events = enrich(
        events,
        [
            DimJoin(t["accounts"], {"db_accnt_id": "id"}, {"crnc": "crnc"}, merge=True),
            DimJoin(client, {"db_cust_id": "cust_id"}, _same(client, "cust_id"), merge=True),
        ],
    )
    from_loans = F.col("source_id") == LOAN_SOURCE
    events = enrich(
        events,
        [
            DimJoin(
                t["offices"],
                {"ag_id": "id"},
                {"office_id": "id", "mngm_office_id": "mngm_office_id"},
                where=from_loans,
            ),
            DimJoin(
                t["office_star"],
                {"mngm_office_id": "id"},
                {"branch_id": "id", "branch": "office", "address": "address"},
            ),
            DimJoin(
                t["operators"],
                {"operator_cre_id": "id"},
                {"employee_id": "id", "operator_name": "descr"},
                where=from_loans,
            ),
        ],
    )
    product = {"product_name": "product_name", "group_name": "group_name"}
    on_group = {"product_group_id": "group3_id"}
    if product_bounded:
        events = valid_at_join(
            events, t["product_star"], on_group, "dt", "date_from", "date_to", product,
            bucket_days=bucket_days, date_range=span,
        )
    else:
        events = enrich(events, [DimJoin(t["product_star"], on_group, product)])
    events = enrich(
        events,
        [
            DimJoin(
                t["currencies"],
                {"crnc": "source_code", "source_id": "source_id"},
                {"currency": "target_code"},
            ),
        ],
    )
    # Column names and constants of the event model.
    return event_row(
        events,
        {
            "OPERATION_ID": concat0(F.col("id"), F.lit("-"), F.col("source_id")),
            "SOURCE_CODE": F.col("source_id"),
            "OPERATION_SOURCE_ID": F.col("sem_id"),
            "OPERATION_CHANNEL_CODE": "Branch",
            "OPERATION_START_DTTM": F.col("dt"),
            "OPERATION_END_DTTM": F.col("dt"),
            "PROCESS_NAME": "Loan Operations",
            "PROCESS_STAGE_NAME": "Loan Operations",
            "OPERATION_NAME": "Early Loan Repayment (Partial/Full)",
            "OPERATION_DIRECTION": "Not Defined",
            "OPERATION_METHOD_NAME": "Not Defined",
            "OPERATION_KIND_NAME": "Not Defined",
            "OPERATION_TYPE_NAME": "Retail Banking",
            "OPERATION_GRP_NAME": "Loan Operations",
            "PARTYTYPE_CODE": "FL",
            "STANDARD_DURATION": 0,
            "STANDARD_PASSED_FLAG": "U",
            "PRODUCT_NAME": F.upper("product_name"),
            "PRODUCTGRP_NAME": F.upper("group_name"),
            "TARGET_CHANNEL_FLAG": "N",
            "FRONT_OFFICE_FLAG": "Y",
            "OPERATION_STATUS_NAME": "Completed",
            "CANCEL_FLAG": "N",
            "PARTY_ID": F.col("hid_party"),
            "PARTY_SEGMENT_CODE": "Not Defined",
            "PARTY_FULL_NAME": _full_name("person_"),
            "PARTY_PHONE_NO": mask_phone(F.col("countrycode"), F.col("telephone")),
            "IB_REGISTRATION_FLAG": "U",
            "MB_REGISTRATION_FLAG": "U",
            "CURRENCY_CODE": F.col("currency"),
            "OPERATION_NM_AMT": F.coalesce(F.col("balance"), F.lit(0)),
            "OPERATION_EQ_RUB": 0,
            "COMMISSION_NM_AMT": 0,
            "COMMISSION_EQ_RUB": 0,
            "EMPLOYEE_ID": F.col("employee_id"),
            "EMPLOYEE_CODE": 0,
            "EMPLOYEE_FULL_NAME": F.upper("operator_name"),
            "ORGSTRUCT_BRANCH_ID": F.col("office_id"),
            "ORGSTRUCT_BRANCH_CODE": F.col("branch_id"),
            "ORGSTRUCT_BRANCH_NAME": F.upper("branch"),
            "ATM_ID": 0,
            "ADDINFO_DESC": F.upper("address"),
        },
    )
