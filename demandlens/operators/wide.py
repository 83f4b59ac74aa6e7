"""Wide-header clean-up: descriptive column names to short typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_wide(df: DataFrame, mapping, prefix: str = "", keep=(), on_error: str = "fail") -> DataFrame:
    """Select ``keep`` columns as they are (``(source, name)`` pairs rename) and, for each
    ``(suffix, name, type)`` of ``mapping``, the column ``prefix + suffix`` cast to
    ``type`` under ``name``. ``on_error="null"`` turns bad values into NULL instead
    of failing. A missing source column fails at plan time."""
    cols = []
    for item in keep:
        src, name = item if isinstance(item, tuple) else (item, item)
        cols.append(F.col(f"`{src}`").alias(name))
    for suffix, name, dtype in mapping:
        c = F.col(f"`{prefix}{suffix}`")
        if on_error == "fail":
            c = c.cast(dtype)
        elif on_error == "null":
            c = c.try_cast(dtype)
        else:
            raise ValueError(f"on_error must be 'fail' or 'null', got {on_error!r}")
        cols.append(c.alias(name))
    return df.select(*cols)
