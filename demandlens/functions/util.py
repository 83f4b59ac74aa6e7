"""Small helpers shared by the column functions and operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def as_list(cols) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def asc_last(cols: Iterable) -> list[Column]:
    """Ascending sort keys with NULLs last (the order SQL engines other than Spark default to)."""
    return [to_col(c).asc_nulls_last() for c in as_list(cols)]


def desc_last(cols: Iterable) -> list[Column]:
    return [to_col(c).desc_nulls_last() for c in as_list(cols)]


def sort_keys(spec) -> list[Column]:
    """Turn ``["a", ("b", "desc"), F.col("c").desc()]`` into sort Columns.

    Plain names sort ascending with NULLs last; ``(name, "desc")`` descending with
    NULLs last; Columns that already carry an ordering are used unchanged.
    """
    keys = []
    for item in as_list(spec):
        if isinstance(item, tuple):
            name, direction = item
            c = to_col(name)
            keys.append(c.desc_nulls_last() if direction.lower() == "desc" else c.asc_nulls_last())
        elif isinstance(item, Column):
            keys.append(item)
        else:
            keys.append(F.col(item).asc_nulls_last())
    return keys
