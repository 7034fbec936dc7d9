"""Column-level functions (all native Catalyst expressions, no Python UDFs)."""

from ledgerlake.functions.codes import clean_label, normalize_code
from ledgerlake.functions.dates import joined_month, month_start
from ledgerlake.functions.ratio import ratio

__all__ = ["clean_label", "joined_month", "month_start", "normalize_code", "ratio"]
