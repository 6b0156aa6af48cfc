"""Reading, slicing and writing tables."""

from .bucketed import bucket_together, buckets_for, write_bucketed
from .publish import publish, published_parts, read_published, vacuum
from .staged import CODEC, Steps, shuffles_released
from .tables import (
    event_day,
    footer_max,
    latest_snapshot,
    load,
    month_range,
    months_slice,
    read_newest,
    read_remote,
    trailing_days,
    window_to_max,
    write_table,
)

__all__ = [
    "CODEC",
    "Steps",
    "bucket_together",
    "buckets_for",
    "event_day",
    "footer_max",
    "latest_snapshot",
    "load",
    "month_range",
    "months_slice",
    "publish",
    "published_parts",
    "read_newest",
    "read_published",
    "read_remote",
    "shuffles_released",
    "trailing_days",
    "vacuum",
    "window_to_max",
    "write_bucketed",
    "write_table",
]
