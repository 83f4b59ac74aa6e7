"""Surrogate ids, keyed de-duplication and request batching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlens.functions.util import as_list, sort_keys, to_col
from demandlens.session import materialize, partitions_for

_PID = "_dl_pid"
_MID = "_dl_mid"
_CNT = "_dl_cnt"
_OFF = "_dl_off"


def dense_ids(df: DataFrame, order, name: str = "id", num_partitions: int | None = None) -> DataFrame:
    """Prepend a dense 1..n BIGINT id that follows the sort order ``order``.

    Same numbering as ``ROW_NUMBER() OVER (ORDER BY order)`` (ascending, NULLs
    last), without moving the table into one partition:

    1. range-partition on the order keys, sort inside each partition and tag each
       row with (partition index, position);
    2. write the tagged rows once to the shared checkpoint folder - the range
       bounds come from a sample, so counting and numbering must read the *same*
       partitioning, and the written copy also cuts the lineage;
    3. count rows per partition (one small row per partition); the running sum
       of those counts is each partition's offset, broadcast back (its size is
       the partition count, not the data size);
    4. id = offset + position inside the partition + 1.

    Rows that tie on every order key get ids in arbitrary order among themselves
    (order by enough columns to make the order total); a large group of such ties
    is still spread over several partitions unless the rows are identical.
    """
    # Rows that tie on every order key are interchangeable; a hash of the whole row
    # as the last key lets the range bounds split a large group of such ties over
    # several partitions (deterministic, so a re-run map task places rows the same way).
    # It is a key only: the rows travel and are written without it.
    keys = [*sort_keys(order), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    n = num_partitions or partitions_for(df)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    tagged = materialize(
        ranged.select("*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID)),
        "dense_ids",
    )
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    # monotonically_increasing_id = (partition index << 33) + row position in the partition
    position = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    out = tagged.join(F.broadcast(offsets), _PID)
    return out.select((F.col(_OFF) + position + F.lit(1)).cast("bigint").alias(name), *[F.col(f"`{c}`") for c in df.columns])


def _asc_struct(order) -> Column:
    """Struct that compares like ORDER BY order ASC NULLS LAST."""
    fields = []
    for i, c in enumerate(as_list(order)):
        col = to_col(c)
        fields += [col.isNull().alias(f"n{i}"), col.alias(f"v{i}")]
    return F.struct(*fields)


def _desc_struct(order) -> Column:
    """Struct whose maximum is the first row of ORDER BY order DESC NULLS LAST."""
    fields = []
    for i, c in enumerate(as_list(order)):
        col = to_col(c)
        fields += [col.isNotNull().alias(f"n{i}"), col.alias(f"v{i}")]
    return F.struct(*fields)


def dedupe_first(df: DataFrame, keys, order) -> DataFrame:
    """Keep one row per ``keys``: the first in ascending ``order`` (NULLs last).

    NULL keys count as equal to each other (like ``dropDuplicates``). Runs as an
    aggregate with a map-side partial step, so a key holding a large share of the
    rows is reduced to one candidate per map task before the shuffle.
    """
    keys = as_list(keys)
    cols = df.columns
    payload = [c for c in cols if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    best = F.min_by(F.struct(*[F.col(f"`{c}`") for c in payload]), _asc_struct(order))
    agg = df.groupBy(*keys).agg(best.alias("_dl_row"))
    return agg.select(*keys, *[F.col(f"_dl_row.`{c}`").alias(c) for c in payload]).select(*[F.col(f"`{c}`") for c in cols])


def keep_last(df: DataFrame, keys, order) -> DataFrame:
    """Keep one row per ``keys``: the greatest in ``order`` (NULLs lowest), via a partial aggregate."""
    keys = as_list(keys)
    cols = df.columns
    payload = [c for c in cols if c not in keys]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in payload]), _desc_struct(order))
    agg = df.groupBy(*keys).agg(best.alias("_dl_row"))
    return agg.select(*keys, *[F.col(f"_dl_row.`{c}`").alias(c) for c in payload]).select(*[F.col(f"`{c}`") for c in cols])


def request_batches(df: DataFrame, key: str, size: int = 50) -> DataFrame:
    """Chunk the ``key`` values into comma-joined request batches of at most ``size`` ids.

    Batch ``b`` holds the values ranked ``b*size+1 .. (b+1)*size`` in ascending key
    order. Each group is bounded by ``size``, so gathering one batch is bounded too.
    Output: batch_id BIGINT (from 0), ids STRING, n_ids BIGINT.
    """
    ranked = dense_ids(df.select(key), [key], "_dl_rank")
    batch = F.floor((F.col("_dl_rank") - 1) / F.lit(size)).cast("bigint")
    return (
        ranked.withColumn("batch_id", batch)
        .groupBy("batch_id")
        .agg(
            F.array_join(F.sort_array(F.collect_list(key)), ",").alias("ids"),
            F.count(F.lit(1)).alias("n_ids"),
        )
    )


def not_null_all(cols) -> Column:
    return reduce(lambda a, b: a & b, [to_col(c).isNotNull() for c in as_list(cols)])
