from .clean import clean, clean_unique
from .dedupe import keep_first
from .quality import Checks, check_columns, issues, null_counts, validate
from .rfm import customer_value, rank_customers, with_rfm
from .skew import lookup_by_key

__all__ = [
    "check_columns",
    "Checks",
    "clean",
    "clean_unique",
    "customer_value",
    "issues",
    "keep_first",
    "lookup_by_key",
    "null_counts",
    "rank_customers",
    "validate",
    "with_rfm",
]
