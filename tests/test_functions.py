import datetime as dt

from pyspark.sql import functions as F

from demandlens.functions import (
    engagement_rate,
    iso_duration_seconds,
    like_rate,
    mean_of_hundredths,
    parse_mdy,
    parse_score,
    rate_pct,
    round_half_away,
    split_last,
    strip_ws,
)


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_rates_zero_and_null_views(spark):
    rows = [(10, 5, 1000), (10, 5, 0), (3, 1, None), (1, 0, 3)]
    df = spark.createDataFrame(rows, "like_count long, comment_count long, view_count long")
    out = df.select(like_rate().alias("l"), engagement_rate().alias("e")).collect()
    assert [(r.l, r.e) for r in out] == [(1.0, 1.5), (None, None), (None, None), (33.33, 33.33)]


def test_round_half_away_scaled(spark):
    vals = [(1.005,), (2.5,), (-2.5,), (0.125,), (None,)]
    assert one(spark, round_half_away("x", 2), vals, "x double") == [1.0, 2.5, -2.5, 0.13, None]
    assert one(spark, round_half_away("x", 0), vals, "x double") == [1.0, 3.0, -3.0, 0.0, None]


def test_rate_pct_digits(spark):
    assert one(spark, rate_pct("a", "b", 1), [(1, 3)], "a long, b long") == [33.3]


def test_mean_of_hundredths_is_order_free(spark):
    df = spark.range(0, 1000).select((F.col("id") % 97 / F.lit(7.0)).alias("x"))
    df = df.select(round_half_away("x", 2).alias("x"))
    a = df.repartition(1).agg(mean_of_hundredths("x")).first()[0]
    b = df.repartition(13).agg(mean_of_hundredths("x")).first()[0]
    assert a == b


def test_iso_durations(spark):
    rows = [("PT1H2M3S",), ("PT45S",), ("PT2H",), ("P0D",), ("P1DT2H3M4S",), (None,), ("PT10M",)]
    assert one(spark, iso_duration_seconds("d"), rows, "d string") == [3723, 45, 7200, 0, 184, 0, 600]
    strict = one(spark, iso_duration_seconds("d", strict_days=True), rows, "d string")
    assert strict[4] == 86400 + 7200 + 184


def test_strip_ws_python_semantics(spark):
    rows = [(" a b \r",), ("\t x　",), ("",), (None,)]
    assert one(spark, strip_ws("s"), rows, "s string") == ["a b", "x", "", None]


def test_parse_mdy_pivot_and_invalid(spark):
    rows = [("8/18/24",), ("1/1/68",), ("1/1/69",), ("2/30/24",), ("13/1/24",), ("02/29/24",), ("1/1/2024",), ("x",)]
    assert one(spark, parse_mdy("s"), rows, "s string") == [
        dt.date(2024, 8, 18), dt.date(2068, 1, 1), dt.date(1969, 1, 1), None, None, dt.date(2024, 2, 29), None, None]


def _headers(spark, lines):
    from demandlens.sources.sections import with_header

    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    return with_header(rows, "line").orderBy("i").collect()


def test_header_dates_both_or_none(spark):
    ranges = ["8/18/24 - 8/18/25", "8/18/24 - 2/30/25", "vit c - ", "1/1/24 - 2/1/24 - 3/1/24", " 1/1/24 -  2/1/24 "]
    out = _headers(spark, [f"Region,Serum: ({r})" for r in ranges])
    assert [(r._dl_hdr.begin_date, r._dl_hdr.end_date) for r in out] == [
        (dt.date(2024, 8, 18), dt.date(2025, 8, 18)), (None, None), (None, None), (None, None),
        (dt.date(2024, 1, 1), dt.date(2024, 2, 1))]


def test_parse_score(spark):
    rows = [("<1",), ("7",), ("+4",), ("4.7",), ("",), ("1_000",), ("-3",), (None,)]
    assert one(spark, parse_score("s"), rows, "s string") == [1, 7, 4, None, None, None, -3, None]


def test_split_last(spark):
    rows = [('"East, Upper",7',), ("no comma",), ("a,",)]
    out = spark.createDataFrame(rows, "s string").select(split_last("s").alias("p")).collect()
    assert [(r.p.head, r.p.tail) if r.p else None for r in out] == [('"East, Upper"', "7"), None, ("a", "")]


def test_header_lines(spark):
    out = _headers(spark, ["Region,Serum: (1/1/24 - 2/1/24)", "Region,: (1/1/24 - 2/1/24)", "X,5", "  Region,B: (a - b)", " "])
    assert out[0]._dl_hdr.keyword == "serum" and out[0]._dl_hdr.begin_date == dt.date(2024, 1, 1)
    assert [r._dl_stop for r in out] == [False, True, False, False, False] and out[2]._dl_hdr is None
    assert [r._dl_lead for r in out] == [False, False, False, True, True] and [r._dl_nb for r in out] == [True] * 4 + [False]


def test_clean_wide(spark):
    from demandlens.operators import clean_wide

    df = spark.createDataFrame([("g1", "12", "4.5", "x")], "`ID!!a` string, `P!!n` string, `P!!f` string, `P!!bad` string")
    out = clean_wide(df, [("n", "n", "bigint"), ("f", "f", "float")], prefix="P!!", keep=[("ID!!a", "id")]).first()
    assert (out.id, out.n, out.f) == ("g1", 12, 4.5)
    bad = clean_wide(df, [("bad", "b", "int")], prefix="P!!", on_error="null").first()
    assert bad.b is None
