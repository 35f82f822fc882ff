"""Column expressions shared by batch and streaming code."""

from .casting import safe_numeric, value_or_default
from .dates import DATE_FORMATS, SOUTHERN_SEASONS, matched_format, parse_date, season_of
from .rates import band, conditional_percent, match_count, percent_where, tag

__all__ = [
    "DATE_FORMATS",
    "SOUTHERN_SEASONS",
    "band",
    "conditional_percent",
    "match_count",
    "matched_format",
    "parse_date",
    "percent_where",
    "safe_numeric",
    "season_of",
    "tag",
    "value_or_default",
]
