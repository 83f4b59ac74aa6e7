"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query is the stand-in projection of the test tables (same as
``demandlens/plans/standins.py``), the silver tables and the report, worked out from the
measures' definitions: statistics are summed per video first and reports add those sums up
over the videos picked per keyword, growth joins every numbered row with the one before,
the regional report repeats a row as often as its keyword has picks. Sectioned exports are
numbered line by line over the whole file, and responses go through DuckDB's own JSON
functions. Tie-breakers and NULL ordering are explicit and the arithmetic has the DOUBLE form
of the Spark code.
"""

from __future__ import annotations

from demandlens.plans.census_columns import CENSUS_COLUMNS, header_for
from demandlens.plans.standins import (
    CENSUS_YEAR,
    ORDERS_PER_BLOCK,
    PREAMBLE,
    SECTIONS_RETRIEVED_AT,
    STOP_BLOCK,
    STOP_YEAR,
    TRENDS_DIR,
    SEARCHED_AT,
    STATS_RETRIEVED_AT,
    INGESTED_AT,
    KEYWORDS_FILE,
    SEGMENTS,
    TRENDS_BEGIN,
    TRENDS_END,
    TRENDS_RETRIEVED_AT,
    census_value_sql,
)

AS_OF = "2025-08-20 12:00:00"
STATS_DONE_BEFORE = "1998-01-01 00:00:00"


# ---------------------------------------------------------------- expressions
def rnd(expr: str, digits: int) -> str:
    """Scaled round, same form as demandlens.functions.rates.round_half_away."""
    if digits == 0:
        return f"round(CAST({expr} AS DOUBLE), 0)"
    scale = f"{10.0 ** digits!r}"
    return f"(round(CAST({expr} AS DOUBLE) * {scale}, 0) / {scale})"


def rate(num: str, den: str) -> str:
    return rnd(f"CAST({num} AS DOUBLE) * 100.0 / CAST(NULLIF({den}, 0) AS DOUBLE)", 2)


def cents(expr: str) -> str:
    """A two-decimal rate as whole hundredths, so that sums are exact."""
    return f"CAST(round({expr} * 100.0, 0) AS BIGINT)"


def mean(expr: str) -> str:
    return pooled(f"{expr}", f"CASE WHEN {expr} IS NOT NULL THEN 1 END")


def pooled(total: str, n: str) -> str:
    """A mean from partial totals and their counts."""
    return f"(CAST(SUM({total}) AS DOUBLE) / CAST(SUM({n}) AS DOUBLE))"


def duration_seconds(col: str, strict_days: bool = False) -> str:
    def part(p: str) -> str:
        return f"COALESCE(CAST(NULLIF(regexp_extract({col}, '{p}', 1), '') AS INTEGER), 0)"

    if strict_days:
        return (f"({part('P(\\d+)D')} * 86400 + {part('T(\\d+)H')} * 3600 + {part('(\\d+)M')} * 60"
                f" + {part('(\\d+)S')})")
    return f"({part('PT(\\d+)H')} * 3600 + {part('(\\d+)M')} * 60 + {part('(\\d+)S')})"


LIKE = rate("vs.like_count", "vs.view_count")
COMMENT = rate("vs.comment_count", "vs.view_count")
ENGAGE = rate("vs.like_count + vs.comment_count", "vs.view_count")


# ---------------------------------------------------------------- stand-ins
def _census_sql() -> str:
    shares = ",\n      ".join(
        f"CAST(SUM(CASE WHEN c.c_mktsegment = '{seg}' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE) AS s{i + 1}"
        for i, seg in enumerate(SEGMENTS)
    )
    cols = ",\n    ".join(
        f"CAST({expr} AS {'BIGINT' if dtype == 'bigint' else 'DOUBLE'}) AS \"{header}\""
        for header, expr, dtype in census_value_sql()
    )
    return f"""SELECT '0400000US' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS "Geography",
    n_name AS "Geographic Area Name",
    {cols}
  FROM (SELECT nat.n_nationkey, nat.n_name, COUNT(*) AS n, max(c.c_acctbal) AS top,
      {shares}
    FROM customer c JOIN nation nat ON c.c_nationkey = nat.n_nationkey
    GROUP BY nat.n_nationkey, nat.n_name)"""


_QTY = "CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR)"
_LINE = "CAST(l_linenumber AS VARCHAR)"

CTES: dict[str, tuple[list[str], str]] = {
    "b_keywords": ([], f"""SELECT DISTINCT lower(p_brand) AS keyword, '{KEYWORDS_FILE}' AS filename,
    '{INGESTED_AT}' AS ingested_at FROM part WHERE p_brand IS NOT NULL"""),
    "b_search": ([], """SELECT 'v' || CAST(l.l_orderkey AS VARCHAR) AS video_id, lower(p.p_brand) AS search_keyword,
    p.p_name AS title, p.p_type AS description,
    'UC' || CAST(l.l_suppkey AS VARCHAR) AS channel_id, 'Channel ' || CAST(l.l_suppkey AS VARCHAR) AS channel_title,
    strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS publish_time,
    strftime(date_trunc('quarter', l.l_shipdate), '%Y-%m-%d %H:%M:%S') AS searched_at
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "b_stats": ([], f"""SELECT 'v' || CAST(l_orderkey AS VARCHAR) AS video_id,
    CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS view_count,
    CAST(floor(l_quantity) AS BIGINT) * 10 AS like_count,
    CAST(l_linenumber AS BIGINT) AS comment_count,
    CASE WHEN l_returnflag = 'A' THEN 'PT' || CAST(l_linenumber - 1 AS VARCHAR) || 'H' || {_LINE} || 'M' || {_QTY} || 'S'
         WHEN l_returnflag = 'N' THEN 'PT' || {_LINE} || 'M' || {_QTY} || 'S'
         ELSE 'P' || {_LINE} || 'DT' || {_LINE} || 'M' END AS duration,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS retrieved_at
  FROM lineitem"""),
    "interest_counts": ([], """SELECT lower(p.p_brand) AS keyword, nat.n_name AS region, COUNT(*) AS n
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation nat ON c.c_nationkey = nat.n_nationkey
  GROUP BY lower(p.p_brand), nat.n_name"""),
    "b_trends": (["interest_counts"], f"""SELECT keyword, region, CAST(n % 101 AS BIGINT) AS interest_score,
    DATE '{TRENDS_BEGIN.isoformat()}' AS begin_date, DATE '{TRENDS_END.isoformat()}' AS end_date,
    'csv/google_trends/' || keyword || '.csv' AS filename, '{TRENDS_RETRIEVED_AT}' AS retrieved_at
  FROM interest_counts"""),
    "b_census": ([], _census_sql()),
    # ------------------------------------------------------------ silver
    "s_keywords": (["b_keywords"], """SELECT ROW_NUMBER() OVER (ORDER BY keyword NULLS LAST, filename NULLS LAST,
      ingested_at NULLS LAST) AS keyword_id, keyword, filename, ingested_at
  FROM (SELECT keyword, filename, CAST(ingested_at AS TIMESTAMP) AS ingested_at FROM b_keywords)"""),
    "s_census": (["b_census"], """SELECT ROW_NUMBER() OVER (ORDER BY geography_id NULLS LAST,
      geographic_area_name NULLS LAST, total_population NULLS LAST) AS region_id, *
  FROM (SELECT CAST("Geography" AS VARCHAR) AS geography_id,
      CAST("Geographic Area Name" AS VARCHAR) AS geographic_area_name,
      CAST(""" + str(CENSUS_YEAR) + """ AS INTEGER) AS survey_year,
      """ + ",\n      ".join(
        f"CAST(\"{header_for(CENSUS_YEAR, suffix)}\" AS {'BIGINT' if dtype == 'bigint' else 'FLOAT'}) AS {name}"
        for suffix, name, dtype in CENSUS_COLUMNS
    ) + "\n    FROM b_census)"),
    "s_trends": (["b_trends", "s_census", "s_keywords"], """SELECT ROW_NUMBER() OVER (ORDER BY keyword_id NULLS LAST,
      region_id NULLS LAST, begin_date NULLS LAST, end_date NULLS LAST, filename NULLS LAST, retrieved_at NULLS LAST,
      interest_score NULLS LAST) AS trend_id, *
  FROM (SELECT k.keyword_id, c.region_id, t.interest_score, t.begin_date, t.end_date, t.filename,
      CAST(t.retrieved_at AS TIMESTAMP) AS retrieved_at
    FROM b_trends t JOIN s_census c ON c.geographic_area_name = t.region JOIN s_keywords k ON k.keyword = t.keyword)"""),
    "s_search": (["b_search", "s_keywords"], """SELECT ROW_NUMBER() OVER (ORDER BY keyword_id NULLS LAST,
      searched_at NULLS LAST, video_id NULLS LAST, channel_id NULLS LAST, title NULLS LAST, description NULLS LAST,
      channel_title NULLS LAST, publish_time NULLS LAST) AS search_result_id, *
  FROM (SELECT s.video_id, k.keyword_id, s.title, s.description, s.channel_id, s.channel_title,
      CAST(s.publish_time AS TIMESTAMP) AS publish_time, CAST(s.searched_at AS TIMESTAMP) AS searched_at
    FROM b_search s JOIN s_keywords k ON k.keyword = s.search_keyword)"""),
    "s_stats": (["b_stats"], f"""SELECT video_id, view_count, like_count, comment_count, duration,
    {duration_seconds('duration')} AS duration_seconds,
    CAST(retrieved_at AS TIMESTAMP) AS retrieved_at
  FROM b_stats"""),
    # ------------------------------------------------------------ shared by the reports
    "picks": (["s_search"], """SELECT r.video_id, keyword_id, r.channel_id, r.channel_title FROM (
    SELECT keyword_id, unnest(list({'video_id': video_id, 'channel_id': channel_id, 'channel_title': channel_title}
      ORDER BY video_id NULLS LAST, search_result_id)[1:20]) AS r
    FROM s_search SEMI JOIN (SELECT keyword_id, max(searched_at) AS searched_at FROM s_search GROUP BY keyword_id) newest
      USING (keyword_id, searched_at)
    GROUP BY keyword_id)"""),
    "video_sums": (["s_stats"], f"""SELECT video_id, COUNT(view_count) AS n, SUM(view_count) AS views, MAX(view_count) AS most,
    MIN(view_count) AS least, COUNT(like_pct) AS n_like, SUM({cents("like_pct")}) AS likes,
    COUNT(comment_pct) AS n_comment, SUM({cents("comment_pct")}) AS comments, COUNT(both_pct) AS n_both,
    SUM({cents("both_pct")}) AS boths, MAX(both_pct) AS most_both, COUNT(duration_seconds) AS n_seconds,
    SUM(duration_seconds) AS seconds
  FROM (SELECT vs.*, {LIKE} AS like_pct, {COMMENT} AS comment_pct, {ENGAGE} AS both_pct FROM s_stats vs)
  GROUP BY video_id"""),
}


def with_ctes(final: str, *needed: str) -> str:
    """Prefix ``final`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in needed:
        visit(name)
    body = ",\n".join(f"{name} AS (\n  {CTES[name][1]}\n)" for name in order)
    return f"WITH {body}\n{final}"


# ---------------------------------------------------------------- gold
SECONDS = pooled("v.seconds", "v.n_seconds")

CHANNEL_INSIGHTS = with_ctes(f"""SELECT p.channel_id, p.channel_title, COUNT(DISTINCT p.video_id) AS total_videos_tracked,
  COUNT(DISTINCT k.keyword) AS keywords_appeared_in, CAST(SUM(v.views) AS BIGINT) AS total_channel_views,
  {pooled("v.views", "v.n")} AS avg_views_per_video, MAX(v.most) AS best_performing_video_views,
  MIN(v.least) AS lowest_performing_video_views,
  {pooled("v.likes", "v.n_like")} / 100.0 AS avg_channel_like_rate,
  {pooled("v.comments", "v.n_comment")} / 100.0 AS avg_channel_comment_rate,
  {pooled("v.boths", "v.n_both")} / 100.0 AS avg_channel_engagement_rate,
  {SECONDS} AS avg_video_duration_seconds, {rnd(f"{SECONDS} / 60.0", 1)} AS avg_video_duration_minutes
FROM picks p JOIN video_sums v USING (video_id) JOIN s_keywords k USING (keyword_id)
GROUP BY ALL HAVING total_videos_tracked > 1 ORDER BY total_channel_views DESC""", "picks", "video_sums", "s_keywords")

BUSINESS_KPIS = with_ctes(f"""SELECT DATE '{AS_OF[:10]}' AS report_date, TIMESTAMP '{AS_OF}' AS generated_at,
  COUNT(DISTINCT p.video_id) AS total_videos_monitored, COUNT(DISTINCT p.keyword_id) AS total_keywords_tracked,
  COUNT(DISTINCT p.channel_id) AS total_channels_monitored, CAST(SUM(v.views) AS BIGINT) AS total_ecosystem_views,
  {rnd(pooled("v.views", "v.n"), 0)} AS avg_video_views, MAX(v.most) AS highest_video_views,
  {rnd(pooled("v.boths", "v.n_both") + " / 100.0", 2)} AS avg_engagement_rate,
  {rnd("MAX(v.most_both)", 2)} AS max_engagement_rate, {rnd(f"{SECONDS} / 60.0", 1)} AS avg_video_duration_minutes
FROM picks p JOIN video_sums v USING (video_id)""", "picks", "video_sums")

_OF_KEYWORD = "FROM s_trends t WHERE t.keyword_id = k.keyword_id"
KEYWORD_MARKET = with_ctes(f"""SELECT k.keyword_id, k.keyword, COUNT(DISTINCT p.video_id) AS competing_videos,
  COUNT(DISTINCT p.channel_id) AS competing_channels, {pooled("v.views", "v.n")} AS avg_video_performance,
  MAX(v.most) AS best_video_performance, MIN(v.least) AS lowest_video_performance,
  {pooled("v.boths", "v.n_both")} / 100.0 AS avg_engagement_rate, MAX(v.most_both) AS max_engagement_rate,
  ifnull((SELECT {mean("t.interest_score")} {_OF_KEYWORD}), CAST(0 AS DOUBLE)) AS avg_regional_interest,
  ifnull((SELECT MAX(t.interest_score) {_OF_KEYWORD}), 0) AS max_regional_interest,
  (SELECT COUNT(DISTINCT t.region_id) {_OF_KEYWORD}) AS regions_with_interest
FROM s_keywords k JOIN picks p USING (keyword_id) JOIN video_sums v USING (video_id)
GROUP BY k.keyword_id, k.keyword
ORDER BY avg_video_performance DESC, avg_engagement_rate DESC""", "picks", "video_sums", "s_keywords", "s_trends")


def _geographic(dedupe: bool) -> str:
    """A region's interest in a keyword, once for every pick of the keyword (or once)."""
    shares = ", ".join(f"r.{g}_alone_or_combination_percentage" for g in ("white", "black", "asian", "some_other_race"))
    ages = lambda *bands: "(" + " + ".join(f"r.population_{b}_percentage" for b in bands) + ")"
    copies = "1" if dedupe else "COUNT(*)"
    return with_ctes(f"""SELECT t.keyword_id, k.keyword, t.region_id, r.geographic_area_name AS region_name, t.interest_score,
  r.total_population, {rnd("CAST(r.total_population AS DOUBLE) * (CAST(t.interest_score AS DOUBLE) / 100.0)", 0)}
    AS estimated_interested_population,
  r.median_age_years, r.total_population_female_percentage, r.total_population_male_percentage,
  {ages("15_to_19", "20_to_24")} AS gen_z_percentage, {ages("25_to_34")} AS millennial_percentage,
  {ages("35_to_44", "45_to_54")} AS gen_x_percentage,
  {ages("55_to_59", "60_to_64", "65_and_over")} AS baby_boomer_plus_percentage,
  CAST({rnd(f"100.0 - CAST(list_max([{shares}]) AS DOUBLE)", 1)} AS FLOAT) AS diversity_index
FROM (SELECT keyword_id, unnest(range({copies})) AS pick FROM picks GROUP BY keyword_id) f
JOIN s_trends t USING (keyword_id) JOIN s_census r USING (region_id) JOIN s_keywords k USING (keyword_id)
ORDER BY k.keyword NULLS LAST, t.interest_score DESC""", "picks", "s_trends", "s_census", "s_keywords")


GEOGRAPHIC = _geographic(False)
GEOGRAPHIC_DEDUP = _geographic(True)

_SNAPSHOT_ORDER = ", ".join(f"s.{c} NULLS LAST" for c in ("retrieved_at", "view_count", "like_count", "comment_count", "duration_seconds"))


def _stepped(growth_over: str) -> str:
    """Snapshots beside the search rows of their video as vs, with ``step``: the views less
    those of the row numbered one before, over the snapshots or over the joined rows."""
    search = "r.search_result_id, r.keyword_id, r.title, r.channel_id, r.channel_title, r.publish_time"
    joined = "JOIN s_search r ON r.video_id = s.video_id"
    if growth_over == "joined":
        rows = f"SELECT s.*, {search}, ROW_NUMBER() OVER (PARTITION BY s.video_id ORDER BY {_SNAPSHOT_ORDER}, r.search_result_id) AS i FROM s_stats s {joined}"
    else:
        rows = f"SELECT s.*, ROW_NUMBER() OVER (PARTITION BY s.video_id ORDER BY {_SNAPSHOT_ORDER}) AS i FROM s_stats s"
    step = "SELECT n.*, n.view_count - b.view_count AS step FROM numbered_rows n LEFT JOIN numbered_rows b ON b.video_id = n.video_id AND b.i + 1 = n.i"
    both = step if growth_over == "joined" else f"SELECT s.*, {search} FROM ({step}) s {joined}"
    return f"(WITH numbered_rows AS ({rows}) {both}) vs JOIN s_keywords k USING (keyword_id)"


_REPORTED = "vs.video_id, k.keyword, vs.title, vs.channel_title, vs.publish_time, CAST(vs.retrieved_at AS DATE) AS performance_date, vs.view_count, vs.like_count, vs.comment_count, vs.step AS daily_view_growth"


def _trending(growth_over: str) -> str:
    return with_ctes(f"""SELECT {_REPORTED}, {ENGAGE} AS engagement_rate,
  CAST(CAST(vs.retrieved_at AS DATE) - CAST(vs.publish_time AS DATE) AS BIGINT) AS days_since_publish
FROM {_stepped(growth_over)} ORDER BY performance_date DESC, view_count DESC""", "s_stats", "s_search", "s_keywords")


def _time_series(growth_over: str) -> str:
    return with_ctes(f"""SELECT {_REPORTED}, vs.channel_id, vs.duration_seconds, {LIKE} AS like_rate, {COMMENT} AS comment_rate,
  {ENGAGE} AS engagement_rate
FROM {_stepped(growth_over)} ORDER BY performance_date DESC, view_count DESC""", "s_stats", "s_search", "s_keywords")


# ---------------------------------------------------------------- silver and operators
SILVER_KEYWORDS = with_ctes("SELECT * FROM s_keywords", "s_keywords")
SILVER_CENSUS = with_ctes("SELECT * FROM s_census", "s_census")
SILVER_TRENDS = with_ctes("SELECT * FROM s_trends", "s_trends")
SILVER_SEARCH = with_ctes("SELECT * FROM s_search", "s_search")
SILVER_STATS = with_ctes("SELECT * FROM s_stats", "s_stats")

ENGAGEMENT_RATES = with_ctes(f"""SELECT vs.video_id, vs.retrieved_at, vs.view_count,
  {LIKE} AS like_rate, {COMMENT} AS comment_rate, {ENGAGE} AS engagement_rate
FROM s_stats vs""", "s_stats")

ISO_DURATIONS = with_ctes(f"""SELECT video_id, retrieved_at, duration,
  {duration_seconds('duration')} AS duration_seconds,
  {duration_seconds('duration', strict_days=True)} AS duration_seconds_strict
FROM b_stats""", "b_stats")

LATEST_TOP_K = """SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l.l_returnflag
    ORDER BY l.l_orderkey NULLS LAST, l.l_partkey NULLS LAST, l.l_suppkey NULLS LAST, l.l_linenumber NULLS LAST) AS rn
FROM lineitem l
WHERE l.l_returnflag IS NOT NULL
  AND l.l_shipdate = (SELECT max(x.l_shipdate) FROM lineitem x WHERE x.l_returnflag = l.l_returnflag)
QUALIFY rn <= 20"""

LATEST_SNAPSHOT = """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS pick
  FROM events) WHERE pick = 1"""

PERIOD_GROWTH = """SELECT *, value - LAG(value) OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id NULLS LAST) AS growth
FROM events"""

DENSE_IDS = """SELECT ROW_NUMBER() OVER (ORDER BY o_orderdate NULLS LAST, o_orderkey NULLS LAST) AS order_seq, *
FROM orders"""

STABLE_IDS = """SELECT ROW_NUMBER() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY o_orderdate NULLS LAST, o_orderkey NULLS LAST)
  + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F') END AS order_seq, *
FROM orders"""

APPROX_DISTINCT = """SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS distinct_parts, TRUE AS estimate_is_near
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag"""

DEDUPE_FIRST = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS LAST, l_partkey NULLS LAST,
      l_suppkey NULLS LAST, l_shipdate NULLS LAST) AS pick
  FROM lineitem) WHERE pick = 1"""

SELECT_KEYWORDS = with_ctes("""SELECT DISTINCT keyword FROM b_keywords WHERE keyword IS NOT NULL
ORDER BY keyword LIMIT 50""", "b_keywords")

_PENDING = f"""SELECT DISTINCT sr.video_id FROM b_search sr
LEFT JOIN (SELECT * FROM b_stats WHERE CAST(retrieved_at AS TIMESTAMP) < TIMESTAMP '{STATS_DONE_BEFORE}') vs
  ON sr.video_id = vs.video_id
WHERE sr.video_id IS NOT NULL AND vs.video_id IS NULL"""

PENDING_IDS = with_ctes(f"SELECT video_id FROM ({_PENDING}) ORDER BY video_id LIMIT 2000", "b_search", "b_stats")

PENDING_STALE = with_ctes("""SELECT DISTINCT sr.video_id FROM b_search sr
WHERE sr.video_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM s_stats vs WHERE vs.video_id = sr.video_id
  GROUP BY vs.video_id HAVING max(vs.retrieved_at) >= TIMESTAMP '2001-06-01 00:00:00' - INTERVAL 365 DAY)""",
    "b_search", "s_stats")

REQUEST_BATCHES = with_ctes(f"""SELECT CAST(floor((rn - 1) / 50) AS BIGINT) AS batch_id,
  string_agg(video_id, ',' ORDER BY video_id) AS ids, COUNT(*) AS n_ids
FROM (SELECT video_id, ROW_NUMBER() OVER (ORDER BY video_id) AS rn FROM ({_PENDING}))
GROUP BY 1""", "b_search", "b_stats")


# ---------------------------------------------------------------- sectioned exports
WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
MDY = r"(1[0-2]|0[1-9]|[1-9])/(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])/([0-9]{2})"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _lstrip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+', '')"


def _rstrip(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+$', '')"


def _mdy(x: str) -> str:
    def g(i: int) -> str:
        return f"CAST(trim(regexp_extract({x}, '^{MDY}$', {i})) AS INTEGER)"

    year = f"(CASE WHEN {g(3)} < 69 THEN 2000 + {g(3)} ELSE 1900 + {g(3)} END)"
    return (f"(CASE WHEN regexp_full_match({x}, '{MDY}') THEN "
            f"TRY_CAST(printf('%04d-%02d-%02d', {year}, {g(1)}, {g(2)}) AS DATE) END)")


_SCORE_TEXT = """CASE WHEN l_quantity <= 2 THEN '<1' WHEN l_discount = 0 THEN '' WHEN l_tax = 0 THEN 'n/a'
      ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) END"""
_YY = "lpad(CAST(year % 100 AS VARCHAR), 2, '0')"

CTES["section_lines"] = ([], f"""SELECT filename, block, kind, k1, k2, k3, k4, k5, line FROM (
    SELECT '{TRENDS_DIR}' || lower(p.p_brand) || '_' || CAST(year(l.l_shipdate) AS VARCHAR) || '.csv' AS filename,
      p.p_brand AS brand, year(l.l_shipdate) AS year,
      CAST(floor(l.l_orderkey / {ORDERS_PER_BLOCK}) + 1 AS BIGINT) AS block, 3 AS kind,
      l.l_orderkey AS k1, l.l_partkey AS k2, l.l_suppkey AS k3, l.l_linenumber AS k4, l.l_shipdate AS k5,
      nat.n_name || ',' || ({_SCORE_TEXT}) || (CASE WHEN o.o_orderstatus = 'F' THEN chr(13) ELSE '' END) AS line
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation nat ON c.c_nationkey = nat.n_nationkey
  ) data
  UNION ALL
  SELECT filename, CAST(0 AS BIGINT), 0, NULL, NULL, NULL, NULL, NULL, '{PREAMBLE}' FROM files
  UNION ALL
  SELECT filename, CAST(0 AS BIGINT), 1, NULL, NULL, NULL, NULL, NULL, '  ' FROM files
  UNION ALL
  SELECT filename, CAST(0 AS BIGINT), 2, NULL, NULL, NULL, NULL, NULL,
    'Region,' || brand || ': (1/1/' || {_YY} || ' - 12/31/' || {_YY} || ')' FROM files
  UNION ALL
  SELECT filename, CAST({STOP_BLOCK} AS BIGINT), 0, NULL, NULL, NULL, NULL, NULL,
    'Region,: (1/1/' || {_YY} || ' - 12/31/' || {_YY} || ')' FROM files WHERE year = {STOP_YEAR}""")
CTES["files"] = ([], f"""SELECT DISTINCT '{TRENDS_DIR}' || lower(p.p_brand) || '_' || CAST(year(l.l_shipdate) AS VARCHAR) || '.csv'
      AS filename, p.p_brand AS brand, year(l.l_shipdate) AS year
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation nat ON c.c_nationkey = nat.n_nationkey""")
CTES["section_lines"] = (["files"], CTES["section_lines"][1])

SECTION_BODY = f"""SELECT keyword, region, interest_score, begin_date, end_date, filename,
  '{SECTIONS_RETRIEVED_AT}' AS retrieved_at
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY keyword, region, begin_date, end_date ORDER BY filename, ln) AS pick
  FROM (
    SELECT filename, ln, keyword, begin_date, end_date,
      {_strip("substr(t, 1, length(t) - rp)")} AS region,
      CASE WHEN {_strip("substr(t, length(t) - rp + 2)")} = '<1' THEN CAST(1 AS BIGINT)
           WHEN regexp_full_match({_strip("substr(t, length(t) - rp + 2)")}, '[+-]?[0-9]+')
             THEN TRY_CAST({_strip("substr(t, length(t) - rp + 2)")} AS BIGINT) END AS interest_score
    FROM (
      SELECT s.filename, s.ln, h.kw AS keyword, h.bd AS begin_date, h.ed AS end_date,
        {_strip("s.line")} AS t, strpos(reverse({_strip("s.line")}), ',') AS rp
      FROM state s JOIN dated h ON h.filename = s.filename AND h.ln = s.hdr_ln
      WHERE s.stopped = 0
    ) WHERE t <> '' AND rp > 0
  ) WHERE interest_score IS NOT NULL
) WHERE pick = 1"""

CTES["numbered"] = (["section_lines"], """SELECT *, ROW_NUMBER() OVER (PARTITION BY filename
      ORDER BY block, kind, k1, k2, k3, k4, k5) AS ln
  FROM section_lines""")
CTES["edges"] = (["numbered"], f"""SELECT filename, min(ln) FILTER (WHERE {_strip("line")} <> '') AS f,
    max(ln) FILTER (WHERE {_strip("line")} <> '') AS l
  FROM numbered GROUP BY filename""")
CTES["adjusted"] = (["numbered", "edges"], f"""SELECT n.*, CASE
      WHEN n.ln = e.f AND n.ln = e.l THEN {_strip("n.line")}
      WHEN n.ln = e.f THEN {_lstrip("n.line")}
      WHEN n.ln = e.l THEN {_rstrip("n.line")}
      ELSE n.line END AS raw
  FROM numbered n LEFT JOIN edges e ON n.filename = e.filename""")
CTES["headers"] = (["adjusted"], f"""SELECT *,
    (starts_with(raw, 'Region') AND contains(raw, '(') AND contains(raw, ')') AND contains(raw, ' - ')) AS is_h,
    lower({_strip("split_part(" + _strip("substr(raw, 8)") + ", ':', 1)")}) AS kw0,
    regexp_extract(raw, '\\(([^)]+)\\)', 1) AS rng
  FROM adjusted""")
CTES["dated"] = (["headers"], f"""SELECT *,
    CASE WHEN is_h AND contains(raw, ':') AND kw0 <> '' THEN kw0 END AS kw,
    is_h AND NOT (contains(raw, ':') AND kw0 <> '') AS stop,
    CASE WHEN ok THEN b END AS bd, CASE WHEN ok THEN e END AS ed
  FROM (
    SELECT *, (b IS NOT NULL AND e IS NOT NULL) AS ok FROM (
      SELECT *,
        CASE WHEN rng <> '' AND len(string_split(rng, ' - ')) = 2
          THEN {_mdy(_strip("string_split(rng, ' - ')[1]"))} END AS b,
        CASE WHEN rng <> '' AND len(string_split(rng, ' - ')) = 2
          THEN {_mdy(_strip("string_split(rng, ' - ')[2]"))} END AS e
      FROM headers))""")
CTES["state"] = (["dated"], """SELECT *,
    max(CASE WHEN stop THEN 1 ELSE 0 END) OVER w AS stopped,
    max(CASE WHEN kw IS NOT NULL THEN ln END) OVER w AS hdr_ln
  FROM dated
  WINDOW w AS (PARTITION BY filename ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")


# ---------------------------------------------------------------- API responses
_VID = "'v' || CAST(l.l_orderkey AS VARCHAR)"
_KEYS = "l.l_orderkey AS o1, l.l_partkey AS o2, l.l_suppkey AS o3, l.l_linenumber AS o4, l.l_shipdate AS o5"
_SEARCH_ITEM = f"""json_object('id', json_object('videoId', {_VID}), 'snippet', json_object(
      'title', p.p_name, 'description', p.p_type,
      'channelId', 'UC' || CAST(l.l_suppkey AS VARCHAR), 'channelTitle', 'Channel ' || CAST(l.l_suppkey AS VARCHAR),
      'publishTime', strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ')))"""

FLATTEN_SEARCH = f"""WITH resp AS (
  SELECT lower(p.p_brand) AS keyword, {_KEYS},
    json_object('items', CASE WHEN l.l_returnflag = 'R'
      THEN json_array({_SEARCH_ITEM}, json_object('id', json_object()))
      ELSE json_array({_SEARCH_ITEM}) END) AS body
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
), items AS (
  SELECT keyword, o1, o2, o3, o4, o5,
    unnest(CAST(json_extract(body, '$.items') AS JSON[])) AS item,
    unnest(range(CAST(json_array_length(body, '$.items') AS BIGINT))) AS position
  FROM resp
)
SELECT video_id, search_keyword, title, description, channel_id, channel_title, publish_time, searched_at FROM (
  SELECT item->'id'->>'videoId' AS video_id, keyword AS search_keyword,
    item->'snippet'->>'title' AS title, item->'snippet'->>'description' AS description,
    item->'snippet'->>'channelId' AS channel_id, item->'snippet'->>'channelTitle' AS channel_title,
    item->'snippet'->>'publishTime' AS publish_time, '{SEARCHED_AT}' AS searched_at,
    ROW_NUMBER() OVER (PARTITION BY item->'id'->>'videoId'
      ORDER BY keyword, o1, o2, o3, o4, o5, position) AS pick
  FROM items
) WHERE pick = 1"""

_STATS_COUNTERS = """'viewCount', CAST(CAST(floor(l.l_extendedprice * l.l_discount) AS BIGINT) AS VARCHAR)"""
_STATS_DURATION = ("CASE WHEN l.l_returnflag = 'A' THEN 'PT' || CAST(l.l_linenumber - 1 AS VARCHAR) || 'H' || "
                   "CAST(l.l_linenumber AS VARCHAR) || 'M' || CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || 'S' "
                   "WHEN l.l_returnflag = 'N' THEN 'PT' || CAST(l.l_linenumber AS VARCHAR) || 'M' || "
                   "CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || 'S' "
                   "ELSE 'P' || CAST(l.l_linenumber AS VARCHAR) || 'DT' || CAST(l.l_linenumber AS VARCHAR) || 'M' END")
_LIKES = "'likeCount', CAST(CAST(floor(l.l_quantity) AS BIGINT) * 10 AS VARCHAR)"
_COMMENTS = "'commentCount', CAST(CAST(l.l_linenumber AS BIGINT) AS VARCHAR)"

FLATTEN_STATISTICS = f"""WITH resp AS (
  SELECT {_KEYS},
    json_object('items', json_array(json_object('id', {_VID},
      'statistics', CASE WHEN l.l_returnflag <> 'N'
        THEN json_object({_STATS_COUNTERS}, {_LIKES}, {_COMMENTS})
        ELSE json_object({_STATS_COUNTERS}, {_COMMENTS}) END,
      'contentDetails', json_object('duration', {_STATS_DURATION})))) AS body
  FROM lineitem l
), items AS (
  SELECT o1, o2, o3, o4, o5,
    unnest(CAST(json_extract(body, '$.items') AS JSON[])) AS item,
    unnest(range(CAST(json_array_length(body, '$.items') AS BIGINT))) AS position
  FROM resp
)
SELECT video_id, view_count, like_count, comment_count, duration, retrieved_at FROM (
  SELECT item->>'id' AS video_id,
    COALESCE(CAST(item->'statistics'->>'viewCount' AS BIGINT), 0) AS view_count,
    COALESCE(CAST(item->'statistics'->>'likeCount' AS BIGINT), 0) AS like_count,
    COALESCE(CAST(item->'statistics'->>'commentCount' AS BIGINT), 0) AS comment_count,
    item->'contentDetails'->>'duration' AS duration, '{STATS_RETRIEVED_AT}' AS retrieved_at,
    ROW_NUMBER() OVER (PARTITION BY item->>'id' ORDER BY o1, o2, o3, o4, o5, position) AS pick
  FROM items
) WHERE pick = 1"""


# ---------------------------------------------------------------- data checks
def _nn(table: str, cte: str, col: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{col}' AS columns, "
            f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {cte}")


def _uq(table: str, cte: str, cols: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'unique' AS check_name, '{cols}' AS columns, "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS failures "
            f"FROM (SELECT COUNT(*) AS n FROM {cte} GROUP BY {cols} HAVING COUNT(*) > 1)")


def _ref(table: str, child: str, parent: str, key: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'references' AS check_name, '{key}' AS columns, "
            f"CAST(COUNT(*) AS BIGINT) AS failures FROM {child} c "
            f"WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})")


DATA_CHECKS_BODY = "\nUNION ALL\n".join([
    _nn("silver_search_results", "s_search", "video_id"),
    _nn("silver_search_results", "s_search", "keyword_id"),
    _nn("silver_search_results", "s_search", "searched_at"),
    _nn("silver_video_statistics", "s_stats", "video_id"),
    _nn("silver_video_statistics", "s_stats", "retrieved_at"),
    _uq("silver_keywords", "s_keywords", "keyword_id"),
    _uq("silver_keywords", "s_keywords", "keyword"),
    _uq("silver_search_results", "s_search", "search_result_id"),
    _uq("silver_video_statistics", "s_stats", "video_id,retrieved_at"),
    _ref("silver_search_results", "s_search", "s_keywords", "keyword_id"),
    _ref("silver_google_trends", "s_trends", "s_census", "region_id"),
    _ref("silver_video_statistics", "s_stats", "s_search", "video_id"),
])


def oracle_sql() -> dict[str, str]:
    return {
        "channel_insights": CHANNEL_INSIGHTS,
        "business_kpis": BUSINESS_KPIS,
        "keyword_market": KEYWORD_MARKET,
        "geographic_insights": GEOGRAPHIC,
        "geographic_insights_dedup": GEOGRAPHIC_DEDUP,
        "trending": _trending("joined"),
        "trending_snapshots": _trending("snapshots"),
        "video_time_series": _time_series("joined"),
        "video_time_series_snapshots": _time_series("snapshots"),
        "dimension_ids": SILVER_KEYWORDS,
        "wide_header_clean": SILVER_CENSUS,
        "lookup_facts": SILVER_TRENDS,
        "search_facts": SILVER_SEARCH,
        "statistics_clean": SILVER_STATS,
        "engagement_rates": ENGAGEMENT_RATES,
        "iso_duration_seconds": ISO_DURATIONS,
        "latest_top_k": LATEST_TOP_K,
        "latest_snapshot": LATEST_SNAPSHOT,
        "period_growth": PERIOD_GROWTH,
        "dense_ids": DENSE_IDS,
        "dedupe_first": DEDUPE_FIRST,
        "stable_ids": STABLE_IDS,
        "growth_in_runs": PERIOD_GROWTH,
        "approx_distinct": APPROX_DISTINCT,
        "channel_insights_refreshed": CHANNEL_INSIGHTS,
        "keyword_market_refreshed": KEYWORD_MARKET,
        "trending_refreshed": _trending("snapshots"),
        "select_keywords": SELECT_KEYWORDS,
        "pending_ids": PENDING_IDS,
        "pending_ids_stale": PENDING_STALE,
        "request_batches": REQUEST_BATCHES,
        "section_lines": with_ctes(SECTION_BODY, "numbered", "state"),
        "flatten_search": FLATTEN_SEARCH,
        "flatten_statistics": FLATTEN_STATISTICS,
        "data_checks": with_ctes(DATA_CHECKS_BODY, "s_search", "s_stats", "s_keywords", "s_trends", "s_census"),
    }
