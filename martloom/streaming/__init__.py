"""Continuous intake of the event table behind the active-user counts."""

from .active_users import daily_sketches, sliding_users, write_daily

__all__ = ["daily_sketches", "sliding_users", "write_daily"]
