"""Every operator and report as a query over the driver's tables, with its SQL check."""

from . import (  # noqa: F401  (registration)
    banking_reports,
    commerce_reports,
    filters,
    joins,
    measures,
    support_reports,
    windows,
)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
