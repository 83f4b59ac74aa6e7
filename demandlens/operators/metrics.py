"""Run metrics (row counts, removed duplicates) collected while a job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter to ``df``; the count is filled in by the next action on it
    (no extra job). Read it with ``observation.get["rows"]`` after that action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def dedup_report(before: Observation, after: Observation) -> dict[str, int]:
    """{rows, kept, removed_duplicates} from the two counters around a de-duplication."""
    rows = int(before.get["rows"])
    kept = int(after.get["rows"])
    return {"rows": rows, "kept": kept, "removed_duplicates": rows - kept}
