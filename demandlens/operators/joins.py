"""Joins against small relations, with the size checked before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.functions.text import strip_ws
from demandlens.functions.util import as_list

# Above these sizes a relation is joined by shuffle (sort-merge, with AQE
# splitting skewed partitions) instead of being copied to every executor.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 128 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` from one aggregate job: fixed-width columns by their
    width, text and binary by their actual byte length, nested values by their
    JSON length."""
    fixed = 0
    measured = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            measured.append(F.coalesce(F.sum(F.octet_length(c)), F.lit(0)))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            measured.append(F.coalesce(F.sum(F.octet_length(F.to_json(c))), F.lit(0)))
        else:
            fixed += _FIXED_WIDTH.get(type(f.dataType), 8)
    row = df.agg(F.count(F.lit(1)).alias("n"), *[m.alias(f"b{i}") for i, m in enumerate(measured)]).first()
    n = int(row["n"])
    return n, n * (fixed + 8) + sum(int(row[f"b{i}"]) for i in range(len(measured)))


def bounded_broadcast(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``broadcast(df)`` when ``df`` is measured at most ``max_rows`` rows and
    ``max_bytes`` bytes, else ``df`` unchanged (then Spark shuffles both sides).

    The measurement is one aggregate job, so call it on small or materialized
    relations (dimension tables, a latest top-k table); it is what makes the
    broadcast size proven rather than estimated.
    """
    n, size = measured_size(df)
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    take,
    how: str = "inner",
    normalize: bool = False,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Attach ``take`` columns of ``dim`` to ``fact`` by natural key.

    Inner by default, so facts without a dimension row drop out; duplicate
    dimension keys multiply facts (data checks report them). ``normalize=True``
    compares stripped, lower-cased keys.
    """
    key = "_dl_lookup_key"
    dk = F.col(dim_key)
    fk = F.col(fact_key)
    if normalize:
        dk = F.lower(strip_ws(dk))
        fk = F.lower(strip_ws(fk))
    small = dim.select(dk.alias(key), *as_list(take))
    small = bounded_broadcast(small, max_broadcast_rows)
    return fact.join(small, fk == small[key], how).drop(key)
