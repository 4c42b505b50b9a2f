from .scalars import (audit_date, brl_compound, distinct_from, epoch_to_text, pct_return,
                      price_diff, round_price, to_day, variation)
from .fetch_window import fetch_plan, fetch_window

__all__ = ["audit_date", "brl_compound", "distinct_from", "epoch_to_text", "pct_return",
           "price_diff", "round_price", "to_day", "variation", "fetch_plan", "fetch_window"]
