from contentmart.functions.dates import (
    date_key,
    day_parts,
    days_before,
    now_ntz,
    ntz_literal,
    threshold_text,
    yyyymmdd_text,
)
from contentmart.functions.predicates import changed_since, is_live, is_removable

__all__ = [
    "changed_since",
    "date_key",
    "day_parts",
    "days_before",
    "is_live",
    "is_removable",
    "now_ntz",
    "ntz_literal",
    "threshold_text",
    "yyyymmdd_text",
]
