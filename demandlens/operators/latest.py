"""Time-ordered operators: latest-batch top-k, latest snapshot, period growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlens.functions.util import as_list, sort_keys
from demandlens.operators.keys import keep_last, not_null_all
from demandlens.session import materialize, partitions_for


def latest_batch_top_k(
    df: DataFrame,
    group,
    time: str,
    order,
    k: int = 20,
    rank_col: str = "rn",
) -> DataFrame:
    """Rows of each group's latest batch (max ``time``), the first ``k`` by ``order``.

    Same rows as "join each group to its max time, then ROW_NUMBER() per (group,
    time) ordered by ``order``, keep rn <= k", in one window pass:

    * rank inside the group by time DESC then ``order`` and keep rank <= k - the
      newest batch ranks first, so its first k rows are exactly these ranks;
    * then keep the rows whose time equals the group's max among survivors
      (rank 1 always belongs to the newest batch).

    The rank filter sits directly on the window, so Spark plans a partial
    ``WindowGroupLimit`` before the shuffle: every map task sends at most k rows
    per group, and a group holding most of the table does not end up whole in
    one task. Rows with a NULL group key or NULL time never qualify.
    """
    group = as_list(group)
    valid = df.where(not_null_all([*group, time]))
    by_time = Window.partitionBy(*group).orderBy(F.col(time).desc(), *sort_keys(order))
    ranked = valid.withColumn(rank_col, F.row_number().over(by_time)).where(F.col(rank_col) <= k)
    newest = F.max(time).over(Window.partitionBy(*group))
    return (
        ranked.withColumn("_dl_newest", newest)
        .where(F.col(time) == F.col("_dl_newest"))
        .drop("_dl_newest")
        .withColumn(rank_col, F.col(rank_col).cast("bigint"))
    )


def latest_snapshot(df: DataFrame, entity, time: str, tie=()) -> DataFrame:
    """One row per entity: the one with the greatest (time, *tie).

    An aggregate (max_by) rather than a window, so hot entities are reduced
    map-side before the shuffle.
    """
    return keep_last(df, as_list(entity), [time, *as_list(tie)])


def period_growth(
    df: DataFrame,
    entity,
    time: str,
    value: str,
    tie=(),
    name: str = "growth",
    num_partitions: int | None = None,
) -> DataFrame:
    """``value - LAG(value)`` per entity in (time, *tie) order; NULL for the first row.

    A window partitioned by entity would send every row of an entity to one task. Here an
    entity may hold any share of the rows:

    1. range-partition on (entity, time, tie) - the sample-based bounds split a hot entity
       over several partitions - and write that once (so every later step sees the same
       partitioning);
    2. LAG inside each (partition, entity) chunk - chunks are bounded by the partition size;
    3. only the first entity of a partition can go on from the partition before. The last
       row of every partition (one row each, so their number is the partition count) is
       broadcast and patches the first row of that entity.
    """
    entity = as_list(entity)
    order = [time, *as_list(tie)]
    pid, keys = "_dl_chunk", [f"_dl_e{i}" for i in range(len(entity))]
    ranged = df.repartitionByRange(num_partitions or partitions_for(df), *sort_keys([*entity, *order]))
    tagged = materialize(ranged.select("*", F.spark_partition_id().alias(pid)), "period_growth")
    in_chunk = Window.partitionBy(pid, *entity).orderBy(*sort_keys(order))
    local = tagged.select(
        "*",
        F.lag(value).over(in_chunk).alias("_dl_prev"),
        (F.row_number().over(in_chunk) == 1).alias("_dl_head"),
    )
    ordering = F.struct(*[f for c in [*entity, *order] for f in (F.col(c).isNull(), F.col(c))])
    last = F.struct(*[F.col(c).alias(k) for c, k in zip(entity, keys)], F.col(value).alias("_dl_carry"))
    ends = tagged.groupBy(pid).agg(F.max_by(last, ordering).alias("_dl_last"))
    before = ends.select(pid, F.lag("_dl_last").over(Window.orderBy(pid)).alias("_dl_before")).select(pid, "_dl_before.*")
    goes_on = F.col("_dl_head")
    for c, k in zip(entity, keys):
        goes_on = goes_on & F.col(c).eqNullSafe(F.col(k))
    prev = F.when(goes_on, F.col("_dl_carry")).otherwise(F.col("_dl_prev"))
    joined = local.join(F.broadcast(before), pid, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(value) - prev).alias(name))


def growth_from_last(
    rows: DataFrame,
    last: DataFrame | None,
    entity,
    time: str,
    value: str,
    tie=(),
    name: str = "growth",
) -> tuple[DataFrame, DataFrame]:
    """(growth of ``rows``, the new last rows): one run of a growth that goes on between runs.

    ``last`` holds each entity's greatest (time, *tie) row so far with ``value``, as the run
    before returned it; it seeds the LAG, so no older row is read. Runs over slices in time
    order give together what one run over all rows gives. Rows that are older than their
    entity's last one would change growth that has been given out: :func:`late_entities`
    finds them, their entities are to be rebuilt from all rows.
    """
    entity, order = as_list(entity), [time, *as_list(tie)]
    kept = list(dict.fromkeys([*entity, *order, value]))
    if last is not None:
        seeds = last.select(*kept, *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in kept])
        both = rows.select("*", F.lit(False).alias("_dl_seed")).unionByName(seeds.withColumn("_dl_seed", F.lit(True)))
    else:
        both = rows.select("*", F.lit(False).alias("_dl_seed"))
    out = period_growth(both, entity, time, value, tie=tie, name=name).where(~F.col("_dl_seed")).drop("_dl_seed")
    place = F.struct(*[f for c in order for f in (F.col(c).isNull(), F.col(c))])  # the order of the LAG, NULLs last
    carried = [c for c in kept if c not in entity]
    ends = both.groupBy(*entity).agg(F.max_by(F.struct(*carried), place).alias("_dl_last"))
    return out, ends.select(*entity, *[F.col(f"_dl_last.`{c}`").alias(c) for c in carried])


def late_entities(rows: DataFrame, last: DataFrame, entity, time: str, tie=()) -> DataFrame:
    """Entities with a row that is not after their last one (NULL times sort last)."""
    entity, order = as_list(entity), [time, *as_list(tie)]
    place = F.struct(*[f for c in order for f in (F.col(c).isNull(), F.col(c))])
    least = rows.groupBy(*entity).agg(F.min(place).alias("_dl_least"))
    before = last.select(*[F.col(c).alias(f"_dl_of_{i}") for i, c in enumerate(entity)], place.alias("_dl_last"))
    same = [F.col(c).eqNullSafe(F.col(f"_dl_of_{i}")) for i, c in enumerate(entity)]
    return least.join(before, [*same, F.col("_dl_least") <= F.col("_dl_last")], "left_semi").select(*entity)
