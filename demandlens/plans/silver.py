"""Silver models: typed, keyed tables built from the bronze landing tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.functions.durations import iso_duration_seconds
from demandlens.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, lookup
from demandlens.operators.keys import dense_ids
from demandlens.operators.wide import clean_wide
from demandlens.plans.census_columns import (
    AREA_NAME_HEADER,
    CENSUS_COLUMNS,
    ESTIMATE_MARKER,
    GEOGRAPHY_ID_HEADER,
    YEAR_HEADER_PATTERN,
    header_for,
)

TS = "timestamp_ntz"


def _cast(col, dtype: str, on_error: str):
    if on_error == "fail":
        return col.cast(dtype)
    if on_error == "null":
        return col.try_cast(dtype)
    raise ValueError(f"on_error must be 'fail' or 'null', got {on_error!r}")


def silver_keywords(bronze_keywords: DataFrame, on_error: str = "fail", number=dense_ids) -> DataFrame:
    """keyword_id, keyword, filename, ingested_at; ids follow (keyword, filename, ingested_at).

    ``number(rows, keys, name)`` gives the ids: dense ones of this rebuild, or those of an
    :class:`~demandlens.operators.stable_ids.IdStore`, which stay between rebuilds."""
    base = bronze_keywords.select(
        "keyword",
        "filename",
        _cast(F.col("ingested_at"), TS, on_error).alias("ingested_at"),
    )
    return number(base, ["keyword", "filename", "ingested_at"], "keyword_id")


def survey_year(columns: list[str]) -> int | None:
    """Year of the first header containing "Estimate" that starts with four digits."""
    for name in columns:
        if ESTIMATE_MARKER in name:
            m = re.match(YEAR_HEADER_PATTERN, name)
            if m:
                return int(m.group(0))
    return None


def silver_census(bronze_census: DataFrame, on_error: str = "fail", number=dense_ids) -> DataFrame:
    """Wide census headers renamed and cast; region_id follows (geography_id, area name).

    The year comes from the headers themselves (plan-time, from the schema), so a
    file for another year maps the same way. Without any "<year> Estimate" header
    the result is empty, with the full schema.
    """
    year = survey_year(bronze_census.columns)
    keep = [(GEOGRAPHY_ID_HEADER, "geography_id"), (AREA_NAME_HEADER, "geographic_area_name")]
    if year is None:
        cols = [F.col(f"`{src}`").cast("string").alias(name) for src, name in keep]
        cols.append(F.lit(None).cast("int").alias("survey_year"))
        cols += [F.lit(None).cast(dtype).alias(name) for _, name, dtype in CENSUS_COLUMNS]
        base = bronze_census.where(F.lit(False)).select(*cols)
    else:
        wide = clean_wide(bronze_census, CENSUS_COLUMNS, prefix=header_for(year, ""), keep=keep, on_error=on_error)
        base = wide.select(
            F.col("geography_id").cast("string").alias("geography_id"),
            F.col("geographic_area_name").cast("string").alias("geographic_area_name"),
            F.lit(year).cast("int").alias("survey_year"),
            *[name for _, name, _ in CENSUS_COLUMNS],
        )
    return number(base, ["geography_id", "geographic_area_name", "total_population"], "region_id")


def silver_google_trends(
    bronze_trends: DataFrame,
    census: DataFrame,
    keywords: DataFrame,
    normalize_keys: bool = False,
    on_error: str = "fail",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    number=dense_ids,
) -> DataFrame:
    """Interest rows keyed by keyword_id and region_id; unmatched names drop out."""
    t = lookup(bronze_trends, census, "region", "geographic_area_name", ["region_id"],
               max_broadcast_rows=max_broadcast_rows)
    t = lookup(t, keywords, "keyword", "keyword", ["keyword_id"], normalize=normalize_keys,
               max_broadcast_rows=max_broadcast_rows)
    base = t.select(
        "keyword_id",
        "region_id",
        "interest_score",
        "begin_date",
        "end_date",
        "filename",
        _cast(F.col("retrieved_at"), TS, on_error).alias("retrieved_at"),
    )
    order = ["keyword_id", "region_id", "begin_date", "end_date", "filename", "retrieved_at", "interest_score"]
    return number(base, order, "trend_id")


def silver_search_results(
    bronze_search: DataFrame,
    keywords: DataFrame,
    normalize_keys: bool = False,
    on_error: str = "fail",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    number=dense_ids,
) -> DataFrame:
    """Search rows keyed by keyword_id, times cast; ids follow (keyword, time, video, ...)."""
    s = lookup(bronze_search, keywords, "search_keyword", "keyword", ["keyword_id"],
               normalize=normalize_keys, max_broadcast_rows=max_broadcast_rows)
    base = s.select(
        "video_id",
        "keyword_id",
        "title",
        "description",
        "channel_id",
        "channel_title",
        _cast(F.col("publish_time"), TS, on_error).alias("publish_time"),
        _cast(F.col("searched_at"), TS, on_error).alias("searched_at"),
    )
    order = ["keyword_id", "searched_at", "video_id", "channel_id", "title", "description",
             "channel_title", "publish_time"]
    return number(base, order, "search_result_id")


def silver_video_statistics(bronze_stats: DataFrame, strict_days: bool = False, on_error: str = "fail") -> DataFrame:
    """Statistics snapshots with duration_seconds; a pure projection (no shuffle)."""
    return bronze_stats.select(
        "video_id",
        "view_count",
        "like_count",
        "comment_count",
        "duration",
        iso_duration_seconds("duration", strict_days=strict_days).alias("duration_seconds"),
        _cast(F.col("retrieved_at"), TS, on_error).alias("retrieved_at"),
    )
