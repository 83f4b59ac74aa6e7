"""Column expressions (JVM-side, no Python UDFs)."""

from demandlens.functions.durations import iso_duration_seconds
from demandlens.functions.rates import (
    comment_rate,
    engagement_rate,
    exact_mean,
    like_rate,
    mean_of_hundredths,
    rate_pct,
    round_half_away,
    safe_divide,
)
from demandlens.functions.text import (
    header_keyword,
    is_section_header,
    lstrip_ws,
    parse_mdy,
    parse_score,
    split_last,
    strip_ws,
)

__all__ = [
    "comment_rate",
    "engagement_rate",
    "exact_mean",
    "header_keyword",
    "is_section_header",
    "iso_duration_seconds",
    "like_rate",
    "lstrip_ws",
    "mean_of_hundredths",
    "parse_mdy",
    "parse_score",
    "rate_pct",
    "round_half_away",
    "safe_divide",
    "split_last",
    "strip_ws",
]
