"""Customer contacts: rate per active user, and the monthly pivot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hour_shift_day, rate_per
from ..operators.dedup import argmax_latest
from ..operators.joins import lookup_or_self
from ..operators.pivots import pivot_count_distinct
from ..operators.rolling import rolling_distinct
from ..operators.unions import union_sources

# Ticket types, excluded types and customer-facing channels.
CATEGORIES = {
    "technical": "Technical issue",
    "financial": "Financial issue",
    "content": "Content",
    "product": "Product",
    "partners": "Partners",
}
EXCLUDED_TYPES = ("Internal", "Automation", "Test", "Moderation", "None")
CHANNELS = (
    "Mail", "App (iOS)", "App (Android)", "Phone", "Chat", "Telegram", "Facebook", "Viber",
)

# Hours by which the two ticket systems' clocks are moved.
SERVICE_SHIFT, WORKFLOW_SHIFT = -3, 3

WINDOW_DAYS, WARM_UP_DAYS, PER_USERS = 7, 14, 100_000
_TICKET = ("service_number", "true_interaction_date", "service_type", "service_folder_2")


def merged_tickets(
    service: DataFrame, workflow: DataFrame, tie_break: Sequence[str], channel: bool = True
) -> DataFrame:
    """Tickets of both systems in one shape.

    The service desk stores final rows. The workflow tool stores changes: per ticket and
    creation day, each attribute's last known value counts.
    """
    columns = [*_TICKET, "service_channel"] if channel else list(_TICKET)
    latest = {"service_type": "category_1", "service_folder_2": "category_2"}
    if channel:
        latest["service_channel"] = "application_source"
    changes = workflow.withColumn("__day", hour_shift_day(F.col("create_date"), WORKFLOW_SHIFT))
    state = argmax_latest(changes, ["id", "__day"], latest, "last_modified_date", tie_break)
    shape = {c: c for c in columns}
    return union_sources(
        [
            (service, {**shape, "true_interaction_date": "interaction_date"}, SERVICE_SHIFT),
            (state, {**shape, "service_number": "id", "true_interaction_date": "__day"}, 0),
        ],
        "true_interaction_date",
    )


def contact_rate_by_category(
    events: DataFrame,
    family: DataFrame,
    service: DataFrame,
    workflow: DataFrame,
    start: dt.date,
    as_of: dt.date,
    event_name: str,
    country: str,
    categories: Mapping[str, str] = CATEGORIES,
    excluded_types: Sequence[str] = EXCLUDED_TYPES,
    channels: Sequence[str] = CHANNELS,
    tie_break: Sequence[str] = ("category_1", "category_2"),
    ordered: bool = True,
    user_col: str = "user_id",
    date_col: str = "event_date",
) -> DataFrame:
    """Per day in [start, as_of): active households and contacts per 100,000 of them, both
    as means over the trailing 7 days.

    Events shrink to distinct (user, day) before the household lookup joins, so a very
    active user costs one row a day.
    """
    first = F.lit(start - dt.timedelta(days=WARM_UP_DAYS))
    active = (
        events.filter(
            (F.col("name") == event_name)
            & (F.col("country") == country)
            & (F.col(date_col) >= first)
            & (F.col(date_col) < F.lit(as_of))
        )
        .select(user_col, F.col(date_col).alias("date_events"))
        .distinct()
    )
    households = lookup_or_self(active, user_col, family, "id", "parent_id", "household")
    users = rolling_distinct(
        households, "date_events", ["household"], WINDOW_DAYS, name="active", start=start, end=as_of
    )
    day = F.col("true_interaction_date")
    contacts = merged_tickets(service, workflow, tie_break).filter(
        (day >= first)
        & (day < F.lit(as_of))
        & ~F.col("service_type").isin(*excluded_types)
        & F.col("service_channel").isin(*channels)
    )
    tickets = rolling_distinct(
        contacts.withColumnRenamed("true_interaction_date", "date_events"),
        "date_events",
        ["service_number"],
        WINDOW_DAYS,
        name="tickets",
        categories={f"n_{c}": kind for c, kind in categories.items()},
        category_col="service_type",
        start=start,
        end=as_of,
    )
    daily_mean = F.col("active") / F.lit(WINDOW_DAYS)
    report = users.join(tickets, "date_events").select(
        "date_events",
        daily_mean.alias("dau_7day_avg"),
        *[
            rate_per(F.col(f"n_{c}") / F.lit(WINDOW_DAYS), daily_mean, PER_USERS).alias(f"cr_{c}")
            for c in categories
        ],
    )
    return report.orderBy("date_events") if ordered else report


def month_columns(first: dt.date, count: int) -> dict[str, dt.date]:
    """Column name to month start, e.g. ``jan_2020``, for consecutive months."""
    out = {}
    for i in range(count):
        year, month = divmod(first.year * 12 + first.month - 1 + i, 12)
        start = dt.date(year, month + 1, 1)
        out[start.strftime("%b_%Y").lower()] = start
    return out


def tickets_monthly_pivot(
    service: DataFrame,
    workflow: DataFrame,
    first_month: dt.date | None = None,
    months: int | None = None,
    tie_break: Iterable[str] = ("category_1", "category_2"),
    ordered: bool = True,
) -> DataFrame:
    """Distinct tickets per type and sub-type, one column per month.

    Months from ``first_month``, ``months`` of them; what is not given comes from the first and
    last ticket, which are looked up once while the plan is made. Tickets outside of given months
    keep their row and are in no column.
    """
    tickets = merged_tickets(service, workflow, list(tie_break), channel=False).withColumn(
        "__month", F.trunc("true_interaction_date", "MM")
    )
    if first_month is None or months is None:
        span = tickets.agg(F.min("__month").alias("lo"), F.max("__month").alias("hi")).first()
        first_month = first_month or span["lo"] or dt.date(1970, 1, 1)
        if months is None:
            last = span["hi"] or first_month
            months = 12 * (last.year - first_month.year) + last.month - first_month.month + 1
    keys = ["service_type", "service_folder_2"]
    wide = pivot_count_distinct(
        tickets, keys, "__month", month_columns(first_month, months), "service_number"
    )
    return wide.orderBy(*[F.col(k).asc_nulls_last() for k in keys]) if ordered else wide
