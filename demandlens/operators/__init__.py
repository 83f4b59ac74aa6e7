"""DataFrame -> DataFrame operators; every one takes column names as arguments."""

from demandlens.operators.checks import check_not_null, check_references, check_table, check_unique, union_checks
from demandlens.operators.incremental import pending_from_tables, pending_keys, select_keys
from demandlens.operators.joins import bounded_broadcast, lookup
from demandlens.operators.keys import dedupe_first, dense_ids, keep_last, request_batches
from demandlens.operators.latest import growth_from_last, late_entities, latest_batch_top_k, latest_snapshot, period_growth
from demandlens.operators.metrics import dedup_report, observe_rows
from demandlens.operators.sketches import distinct_sketches, merge_sketches
from demandlens.operators.stable_ids import IdStore
from demandlens.operators.wide import clean_wide

__all__ = [
    "IdStore",
    "bounded_broadcast",
    "check_not_null",
    "check_references",
    "check_table",
    "check_unique",
    "clean_wide",
    "dedup_report",
    "dedupe_first",
    "dense_ids",
    "distinct_sketches",
    "growth_from_last",
    "keep_last",
    "late_entities",
    "latest_batch_top_k",
    "latest_snapshot",
    "lookup",
    "merge_sketches",
    "observe_rows",
    "pending_from_tables",
    "pending_keys",
    "period_growth",
    "request_batches",
    "select_keys",
    "union_checks",
]
