"""Search and statistics API responses (JSON documents) to bronze rows.

One input row per response document. Documents are parsed with a declared
schema (no inference pass), items are exploded with their position (the
relevance rank), and missing paths give NULL. A document that is not valid JSON
or whose ``items`` is no list fails the job; :func:`split_malformed` sets such
documents aside first where a run should go on without them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.functions.util import as_list
from demandlens.operators.keys import dedupe_first

_S = T.StringType()

SEARCH_RESPONSE_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StructType([T.StructField("videoId", _S)])),
        T.StructField("snippet", T.StructType([
            T.StructField("title", _S),
            T.StructField("description", _S),
            T.StructField("channelId", _S),
            T.StructField("channelTitle", _S),
            T.StructField("publishTime", _S),
        ])),
    ]))),
])

STATISTICS_RESPONSE_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", _S),
        # a map, so that an absent counter and a null one differ
        T.StructField("statistics", T.MapType(_S, _S)),
        T.StructField("contentDetails", T.StructType([T.StructField("duration", _S)])),
    ]))),
])

SEARCH_COLUMNS = ["video_id", "search_keyword", "title", "description", "channel_id", "channel_title",
                  "publish_time", "searched_at"]
STATISTICS_COLUMNS = ["video_id", "view_count", "like_count", "comment_count", "duration", "retrieved_at"]


STRICT = {"mode": "FAILFAST"}
_CORRUPT = "_corrupt_record"


def split_malformed(responses: DataFrame, schema: T.StructType, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(documents that parse, the others) of ``responses``, both with its own columns."""
    lenient = T.StructType([*schema.fields, T.StructField(_CORRUPT, _S)])
    parsed = F.from_json(body, lenient, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    bad = F.coalesce(parsed[_CORRUPT].isNotNull(), F.lit(False))
    return responses.where(~bad), responses.where(bad)


def _stamp(value):
    if value is None:
        return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return F.lit(value).cast("string")


def flatten_search(df: DataFrame, body: str = "body", keyword: str = "keyword", searched_at=None,
                   keep=()) -> DataFrame:
    """One row per ``items[]`` entry: the 8 bronze search columns plus ``position``.

    ``searched_at`` is one UTC text stamp for the run (default: now); ``keep``
    names input columns carried along (e.g. the response order).
    """
    keep = as_list(keep)
    parsed = df.select(*keep, F.col(keyword).alias("_dl_kw"), F.from_json(body, SEARCH_RESPONSE_SCHEMA, STRICT).alias("_dl_r"))
    items = parsed.select(*keep, "_dl_kw", F.posexplode("_dl_r.items").alias("position", "_dl_item"))
    it = F.col("_dl_item")
    return items.select(
        *keep,
        it["id"]["videoId"].alias("video_id"),
        F.col("_dl_kw").alias("search_keyword"),
        it["snippet"]["title"].alias("title"),
        it["snippet"]["description"].alias("description"),
        it["snippet"]["channelId"].alias("channel_id"),
        it["snippet"]["channelTitle"].alias("channel_title"),
        it["snippet"]["publishTime"].alias("publish_time"),
        _stamp(searched_at).alias("searched_at"),
        F.col("position").cast("bigint").alias("position"),
    )


def flatten_statistics(df: DataFrame, body: str = "body", retrieved_at=None, keep=()) -> DataFrame:
    """One row per ``items[]`` entry: counters as BIGINT (absent counter = 0; a counter
    that is null or not a number fails the job, as a strict cast), duration text."""
    keep = as_list(keep)
    parsed = df.select(*keep, F.from_json(body, STATISTICS_RESPONSE_SCHEMA, STRICT).alias("_dl_r"))
    items = parsed.select(*keep, F.posexplode("_dl_r.items").alias("position", "_dl_item"))
    it = F.col("_dl_item")

    def counter(name: str):
        stats = it["statistics"]
        there = F.coalesce(F.map_contains_key(stats, name), F.lit(False))
        value = F.try_element_at(stats, F.lit(name))
        missing = F.raise_error(F.concat(F.lit(f"{name} is null for "), F.coalesce(it["id"], F.lit("?")))).cast("bigint")
        return F.when(~there, F.lit(0).cast("bigint")).when(value.isNull(), missing).otherwise(value.cast("bigint"))

    return items.select(
        *keep,
        it["id"].alias("video_id"),
        counter("viewCount").alias("view_count"),
        counter("likeCount").alias("like_count"),
        counter("commentCount").alias("comment_count"),
        it["contentDetails"]["duration"].alias("duration"),
        _stamp(retrieved_at).alias("retrieved_at"),
        F.col("position").cast("bigint").alias("position"),
    )


def ingest_search(responses: DataFrame, order, body: str = "body", keyword: str = "keyword",
                  searched_at=None) -> DataFrame:
    """Search responses of one run -> bronze rows, one per video_id: the first in
    (``order`` of the responses, result position) wins."""
    order = as_list(order)
    flat = flatten_search(responses, body=body, keyword=keyword, searched_at=searched_at, keep=order)
    first = dedupe_first(flat, ["video_id"], [*order, "position"])
    return first.select(*SEARCH_COLUMNS)


def ingest_statistics(responses: DataFrame, order, body: str = "body", retrieved_at=None) -> DataFrame:
    """Statistics responses of one run -> bronze rows, one per video_id (first wins)."""
    order = as_list(order)
    flat = flatten_statistics(responses, body=body, retrieved_at=retrieved_at, keep=order)
    first = dedupe_first(flat, ["video_id"], [*order, "position"])
    return first.select(*STATISTICS_COLUMNS)
