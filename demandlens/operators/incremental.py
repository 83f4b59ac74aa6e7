"""Incremental work selection: which keys still need fetching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.functions.util import asc_last


def select_keys(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Distinct non-NULL ``key`` values; with ``limit``, the first ``limit`` in key order.

    The limit is taken in key order so repeated runs pick the same keys; Spark plans
    it as a per-partition top-n followed by a merge (``TakeOrderedAndProject``).
    """
    out = df.where(F.col(key).isNotNull()).select(key).distinct()
    if limit:
        out = out.orderBy(*asc_last(key)).limit(limit)
    return out


def pending_keys(
    candidates: DataFrame,
    done: DataFrame | None,
    key: str,
    limit: int | None = None,
    done_key: str | None = None,
    mode: str = "missing",
    time_col: str | None = None,
    as_of=None,
    max_age_days: int | None = None,
) -> DataFrame:
    """Keys of ``candidates`` that still need work.

    * ``mode="missing"``: keys with no row in ``done`` (anti-join). ``done=None``
      means the target table does not exist yet, so every key is pending.
    * ``mode="stale"``: keys whose newest ``done`` row (by ``time_col``) is older
      than ``as_of - max_age_days`` days, plus keys never done.

    ``done`` keys are de-duplicated map-side before the anti-join shuffle.
    """
    pending = candidates.where(F.col(key).isNotNull()).select(key).distinct()
    if done is not None:
        dk = F.col(done_key or key)
        if mode == "missing":
            seen = done.where(dk.isNotNull()).select(dk.alias(key)).distinct()
        elif mode == "stale":
            if time_col is None or as_of is None or max_age_days is None:
                raise ValueError("mode='stale' needs time_col, as_of and max_age_days")
            cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(max_age_days))
            seen = (
                done.where(dk.isNotNull())
                .groupBy(dk.alias(key))
                .agg(F.max(time_col).alias("_dl_last"))
                .where(F.col("_dl_last") >= cutoff)
                .select(key)
            )
        else:
            raise ValueError(f"unknown mode {mode!r}")
        pending = pending.join(seen, key, "left_anti")
    if limit:
        pending = pending.orderBy(*asc_last(key)).limit(limit)
    return pending


def pending_from_tables(
    spark: SparkSession,
    candidates_table: str,
    done_table: str,
    key: str,
    limit: int | None = None,
) -> DataFrame:
    """Table-level form: a missing ``done_table`` (first run) selects every candidate."""
    done = spark.table(done_table) if spark.catalog.tableExists(done_table) else None
    return pending_keys(spark.table(candidates_table), done, key, limit=limit)
