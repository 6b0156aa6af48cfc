"""Scalar column helpers."""

from .scalars import (
    brand_prefix,
    concat0,
    flag_from_presence,
    has_value,
    hour_shift_day,
    lacks_value,
    mask_phone,
    month_index,
    or_zero,
    rate_per,
    safe_div,
    same_key,
)

__all__ = [
    "brand_prefix",
    "concat0",
    "flag_from_presence",
    "has_value",
    "hour_shift_day",
    "lacks_value",
    "mask_phone",
    "month_index",
    "or_zero",
    "rate_per",
    "safe_div",
    "same_key",
]
