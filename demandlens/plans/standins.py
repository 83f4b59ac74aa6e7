"""Bronze-shaped stand-in inputs projected from the driver's test tables.

The test tables hold no keyword, search or video data, so each function here
only *shapes* rows of the test tables into the schema a bronze table has (see
FIXTURES.md section 4). None of them does the work of the job that reads it;
the silver and gold code runs unchanged on real bronze tables.
The same projections are written in SQL for the DuckDB oracle
(``oracle_queries.py``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.plans.census_columns import AREA_NAME_HEADER, CENSUS_COLUMNS, GEOGRAPHY_ID_HEADER, header_for

KEYWORDS_FILE = "csv/keywords.csv"
INGESTED_AT = "2025-08-01 00:00:00"
TRENDS_BEGIN = _dt.date(2024, 8, 18)
TRENDS_END = _dt.date(2025, 8, 18)
TRENDS_RETRIEVED_AT = "2025-08-19 06:00:00"
CENSUS_YEAR = 2024
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One keyword per part brand (lower-cased)."""
    part = table(spark, sf_dir, "part")
    return (
        part.where(F.col("p_brand").isNotNull())
        .select(F.lower("p_brand").alias("keyword"))
        .distinct()
        .select("keyword", F.lit(KEYWORDS_FILE).alias("filename"), F.lit(INGESTED_AT).alias("ingested_at"))
    )


def _video_id(orderkey):
    return F.concat(F.lit("v"), orderkey.cast("string"))


def bronze_search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search row per line item: video = order, keyword = part brand, channel = supplier,
    published at the order date, searched in the quarter of the ship date (text stamps)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey).join(part, li.l_partkey == part.p_partkey)  # the texts join last
    return j.select(
        _video_id(F.col("l_orderkey")).alias("video_id"),
        F.lower("p_brand").alias("search_keyword"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("description"),
        F.concat(F.lit("UC"), F.col("l_suppkey").cast("string")).alias("channel_id"),
        F.concat(F.lit("Channel "), F.col("l_suppkey").cast("string")).alias("channel_title"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publish_time"),
        F.date_format(F.date_trunc("quarter", "l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("searched_at"),
    )


def bronze_video_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statistics snapshot per line item: video = order, retrieved on the ship date."""
    li = table(spark, sf_dir, "lineitem")
    qty = F.floor("l_quantity").cast("bigint").cast("string")
    line = F.col("l_linenumber").cast("string")
    duration = (
        F.when(F.col("l_returnflag") == "A",
               F.concat(F.lit("PT"), (F.col("l_linenumber") - 1).cast("string"), F.lit("H"), line, F.lit("M"), qty, F.lit("S")))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("PT"), line, F.lit("M"), qty, F.lit("S")))
        .otherwise(F.concat(F.lit("P"), line, F.lit("DT"), line, F.lit("M")))
    )
    return li.select(
        _video_id(F.col("l_orderkey")).alias("video_id"),
        F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("bigint").alias("view_count"),
        (F.floor("l_quantity").cast("bigint") * F.lit(10)).alias("like_count"),
        F.col("l_linenumber").cast("bigint").alias("comment_count"),
        duration.alias("duration"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("retrieved_at"),
    )


def interest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keyword, region, n): line items per part brand and customer nation."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    j = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(orders, li.l_orderkey == orders.o_orderkey)
        .join(cust, orders.o_custkey == cust.c_custkey)
        .join(nation, cust.c_nationkey == nation.n_nationkey)
    )
    return j.groupBy(F.lower("p_brand").alias("keyword"), F.col("n_name").alias("region")).agg(
        F.count(F.lit(1)).alias("n")
    )


def bronze_google_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional interest: score 0..100 from the (brand, nation) line-item count."""
    c = interest_counts(spark, sf_dir)
    return c.select(
        "keyword",
        "region",
        (F.col("n") % 101).cast("bigint").alias("interest_score"),
        F.lit(TRENDS_BEGIN).alias("begin_date"),
        F.lit(TRENDS_END).alias("end_date"),
        F.concat(F.lit("csv/google_trends/"), F.col("keyword"), F.lit(".csv")).alias("filename"),
        F.lit(TRENDS_RETRIEVED_AT).alias("retrieved_at"),
    )


def census_value_sql() -> list[tuple[str, str, str]]:
    """(header, SQL expression over the nation aggregates, type) for every census column.

    Aggregates: n (customers), s1..s5 (percent of customers per market segment),
    top (max account balance). The expressions are plain arithmetic so Spark and
    DuckDB evaluate them identically.
    """
    out = []
    counts = {"total_population": "n * 1000", "total_housing_units": "n * 400", "citizen_18_and_over_population": "n * 700"}
    j = 0
    for suffix, name, dtype in CENSUS_COLUMNS:
        if dtype == "bigint":
            expr = counts[name]
        elif name == "median_age_years":
            expr = "25.0 + top / 500.0"
        else:
            expr = f"s{j % 5 + 1} / {1 + j // 5}.0"
            j += 1
        out.append((header_for(CENSUS_YEAR, suffix), expr, dtype))
    return out


def bronze_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide census export per nation, headers "2024 Estimate!!...", numbers as landed (bigint / double)."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    j = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    n = F.count(F.lit(1))
    shares = [
        (F.sum(F.when(F.col("c_mktsegment") == seg, 1).otherwise(0)).cast("double") * F.lit(100.0) / n.cast("double")).alias(f"s{i + 1}")
        for i, seg in enumerate(SEGMENTS)
    ]
    agg = j.groupBy("n_nationkey", "n_name").agg(n.alias("n"), F.max("c_acctbal").alias("top"), *shares)
    cols = [
        F.concat(F.lit("0400000US"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(GEOGRAPHY_ID_HEADER),
        F.col("n_name").alias(AREA_NAME_HEADER),
    ]
    for header, expr, dtype in census_value_sql():
        cols.append(F.expr(expr).cast("bigint" if dtype == "bigint" else "double").alias(header))
    return agg.select(*cols)


# Sectioned export stand-in: one file per (brand, ship year), one data line per
# line item, split into "blocks" (file splits) by order-key range. Files of
# STOP_YEAR get an empty-keyword header at the start of block STOP_BLOCK.
TRENDS_DIR = "csv/google_trends/"
PREAMBLE = "Category: All categories"
ORDERS_PER_BLOCK = 2000
STOP_YEAR = 2001
STOP_BLOCK = 3
SECTION_ORDER = ["kind", "k1", "k2", "k3", "k4", "k5"]
SECTIONS_RETRIEVED_AT = "2025-08-19 07:00:00"


def section_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(filename, block, kind, k1..k5, line): the text lines of sectioned export files."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    j = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(orders, li.l_orderkey == orders.o_orderkey)
        .join(cust, orders.o_custkey == cust.c_custkey)
        .join(nation, cust.c_nationkey == nation.n_nationkey)
    )
    year = F.year("l_shipdate")
    filename = F.concat(F.lit(TRENDS_DIR), F.lower("p_brand"), F.lit("_"), year.cast("string"), F.lit(".csv"))
    score = (
        F.when(F.col("l_quantity") <= 2, F.lit("<1"))
        .when(F.col("l_discount") == 0, F.lit(""))
        .when(F.col("l_tax") == 0, F.lit("n/a"))
        .otherwise(F.floor("l_quantity").cast("bigint").cast("string"))
    )
    eol = F.when(F.col("o_orderstatus") == "F", F.lit("\r")).otherwise(F.lit(""))
    data = j.select(
        filename.alias("filename"),
        F.col("p_brand").alias("brand"),
        year.alias("year"),
        (F.floor(F.col("l_orderkey") / ORDERS_PER_BLOCK) + 1).cast("bigint").alias("block"),
        F.lit(3).alias("kind"),
        F.col("l_orderkey").alias("k1"),
        F.col("l_partkey").alias("k2"),
        F.col("l_suppkey").alias("k3"),
        F.col("l_linenumber").alias("k4"),
        F.col("l_shipdate").alias("k5"),
        F.concat(F.col("n_name"), F.lit(","), score, eol).alias("line"),
    )
    files = data.select("filename", "brand", "year").distinct()
    yy = F.lpad((F.col("year") % 100).cast("string"), 2, "0")

    def extra(kind: int, block: int, line) -> DataFrame:
        return files.select(
            "filename", "brand", "year",
            F.lit(block).cast("bigint").alias("block"),
            F.lit(kind).alias("kind"),
            F.lit(None).cast("bigint").alias("k1"),
            F.lit(None).cast("bigint").alias("k2"),
            F.lit(None).cast("bigint").alias("k3"),
            F.lit(None).cast("int").alias("k4"),
            F.lit(None).cast("timestamp_ntz").alias("k5"),
            line.alias("line"),
        )

    header = F.concat(F.lit("Region,"), F.col("brand"), F.lit(": (1/1/"), yy, F.lit(" - 12/31/"), yy, F.lit(")"))
    stop = F.concat(F.lit("Region,: (1/1/"), yy, F.lit(" - 12/31/"), yy, F.lit(")"))
    parts = [
        extra(0, 0, F.lit(PREAMBLE)),
        extra(1, 0, F.lit("  ")),
        extra(2, 0, header),
        extra(0, STOP_BLOCK, stop).where(F.col("year") == STOP_YEAR),
        data,
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("filename", "block", *SECTION_ORDER, "line")


# API-response stand-ins: one JSON document per line item. Search responses of
# returned items ("R") carry a second, empty item ({"id": {}}); statistics
# responses of "N" items lack likeCount.
RESPONSE_KEYS = ["o1", "o2", "o3", "o4", "o5"]
SEARCHED_AT = "2025-08-18 09:00:00"
STATS_RETRIEVED_AT = "2025-08-18 10:00:00"


def _line_keys():
    return [F.col(c).alias(a) for c, a in zip(
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"], RESPONSE_KEYS)]


def search_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keyword, o1..o5, body): a search response document per line item."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    j = li.join(part, li.l_partkey == part.p_partkey).join(orders, li.l_orderkey == orders.o_orderkey)
    snippet = F.struct(
        F.col("p_name").alias("title"),
        F.col("p_type").alias("description"),
        F.concat(F.lit("UC"), F.col("l_suppkey").cast("string")).alias("channelId"),
        F.concat(F.lit("Channel "), F.col("l_suppkey").cast("string")).alias("channelTitle"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishTime"),
    )
    item = F.struct(F.struct(_video_id(F.col("l_orderkey")).alias("videoId")).alias("id"), snippet.alias("snippet"))
    empty = F.struct(F.struct(F.lit(None).cast("string").alias("videoId")).alias("id"),
                     F.lit(None).cast(snippet_type()).alias("snippet"))
    items = F.when(F.col("l_returnflag") == "R", F.array(item, empty)).otherwise(F.array(item))
    return j.select(F.lower("p_brand").alias("keyword"), *_line_keys(),
                    F.to_json(F.struct(items.alias("items"))).alias("body"))


def snippet_type() -> str:
    return ("struct<title:string,description:string,channelId:string,channelTitle:string,"
            "publishTime:string>")


def statistics_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o1..o5, body): a statistics response document per line item."""
    li = table(spark, sf_dir, "lineitem")
    qty = F.floor("l_quantity").cast("bigint")
    line = F.col("l_linenumber").cast("string")
    duration = (
        F.when(F.col("l_returnflag") == "A",
               F.concat(F.lit("PT"), (F.col("l_linenumber") - 1).cast("string"), F.lit("H"), line, F.lit("M"),
                        qty.cast("string"), F.lit("S")))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("PT"), line, F.lit("M"), qty.cast("string"), F.lit("S")))
        .otherwise(F.concat(F.lit("P"), line, F.lit("DT"), line, F.lit("M")))
    )
    counters = F.struct(
        F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("bigint").cast("string").alias("viewCount"),
        F.when(F.col("l_returnflag") != "N", (qty * F.lit(10)).cast("string")).alias("likeCount"),
        F.col("l_linenumber").cast("bigint").cast("string").alias("commentCount"),
    )
    item = F.struct(_video_id(F.col("l_orderkey")).alias("id"), counters.alias("statistics"),
                    F.struct(duration.alias("duration")).alias("contentDetails"))
    return li.select(*_line_keys(), F.to_json(F.struct(F.array(item).alias("items"))).alias("body"))
