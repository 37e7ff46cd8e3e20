"""Column-level helpers: dates, DPD bands, decision tables."""

from stagecraft.functions.bands import is_npl
from stagecraft.functions.dates import date_lit
from stagecraft.functions.decision import decide

__all__ = ["date_lit", "decide", "is_npl"]
