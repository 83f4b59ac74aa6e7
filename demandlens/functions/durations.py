"""ISO-8601 video durations (``PT1H2M3S``) to seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlens.functions.util import to_col

# Fixed patterns of the duration rule: hours only count when written right after
# "PT"; minutes and seconds are the first number before "M" / "S".
HOURS_PATTERN = r"PT(\d+)H"
MINUTES_PATTERN = r"(\d+)M"
SECONDS_PATTERN = r"(\d+)S"
DAYS_PATTERN = r"P(\d+)D"
STRICT_HOURS_PATTERN = r"T(\d+)H"


def _part(col: Column, pattern: str) -> Column:
    # regexp_extract yields '' when nothing matches; '' must not reach the cast.
    text = F.regexp_extract(col, pattern, 1)
    return F.coalesce(F.nullif(text, F.lit("")).cast("int"), F.lit(0))


def iso_duration_seconds(col="duration", strict_days: bool = False) -> Column:
    """hours * 3600 + minutes * 60 + seconds; a missing part counts 0, NULL gives 0.

    By default ``P1DT2H3M4S`` gives 184: days, and hours that do not directly follow
    ``PT``, are ignored, which is the established behaviour of the silver model.
    ``strict_days=True`` adds days * 86400 and reads hours after any ``T``.
    """
    c = to_col(col)
    if strict_days:
        return (
            _part(c, DAYS_PATTERN) * 86400
            + _part(c, STRICT_HOURS_PATTERN) * 3600
            + _part(c, MINUTES_PATTERN) * 60
            + _part(c, SECONDS_PATTERN)
        )
    return _part(c, HOURS_PATTERN) * 3600 + _part(c, MINUTES_PATTERN) * 60 + _part(c, SECONDS_PATTERN)
