"""The thirteen reports, each a composition of operators over its input tables."""

from .banking import account_open_events, early_repayment_events, load_account_day, read_account_feed
from .inventory import cost_gap_fill, fee_changes, inventory_aging_value, restock_signal
from .lifecycle import Market, newly_profitable
from .marketing import ad_efficiency
from .pnl import monthly_pnl
from .pnl_store import read_pnl, refresh_pnl
from .reimbursements import destroyed_unreimbursed, reimbursement_net
from .support import contact_rate_by_category, merged_tickets, tickets_monthly_pivot

__all__ = [
    "Market",
    "account_open_events",
    "ad_efficiency",
    "contact_rate_by_category",
    "cost_gap_fill",
    "destroyed_unreimbursed",
    "early_repayment_events",
    "fee_changes",
    "inventory_aging_value",
    "load_account_day",
    "merged_tickets",
    "monthly_pnl",
    "newly_profitable",
    "read_account_feed",
    "read_pnl",
    "refresh_pnl",
    "reimbursement_net",
    "restock_signal",
    "tickets_monthly_pivot",
]
