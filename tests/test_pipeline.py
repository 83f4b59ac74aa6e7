"""End-to-end on tiny invented inputs: landing, silver, gold, export, streaming."""

import datetime as dt
import json
import os

import pytest

from demandlens.plans import gold as G
from demandlens.plans.pipeline import (
    Layout,
    build_all,
    pending_video_ids,
    statistics_requests,
)
from demandlens.plans.silver import silver_census
from demandlens.sources.csv_landing import land_csv
from demandlens.sources.responses import flatten_search, flatten_statistics
from demandlens.sources.sinks import export_jdbc, read_table, save_table

CENSUS_CSV = """GEO_ID,NAME,X1,X2,X3
Geography,Geographic Area Name,2023 Estimate!!SEX AND AGE!!Total population,2023 Estimate!!SEX AND AGE!!Total population!!Male,Other
g01,"Northland, North",1200,48.5,z
g02,Southland,3400,50.25,z
"""


def test_census_label_row_landing_and_clean(spark, tmp_dir):
    src = os.path.join(tmp_dir, "csv")
    os.makedirs(os.path.join(src, "google_trends"))
    with open(os.path.join(src, "census.csv"), "w") as fh:
        fh.write(CENSUS_CSV)
    with open(os.path.join(src, "keywords.csv"), "w") as fh:
        fh.write("keyword\nserum\nsunscreen\n")
    with open(os.path.join(src, "google_trends", "t.csv"), "w") as fh:
        fh.write("Region,Serum: (1/1/24 - 2/1/24)\nX,1\n")
    written = land_csv(spark, src, os.path.join(tmp_dir, "parquet"), ingested_at="2025-01-01 00:00:00")
    assert sorted(os.path.basename(p) for p in written.values()) == ["census.parquet", "keywords.parquet"]
    census = spark.read.parquet(os.path.join(tmp_dir, "parquet", "census.parquet"))
    assert census.columns[:3] == ["Geography", "Geographic Area Name",
                                  "2023 Estimate!!SEX AND AGE!!Total population"]
    assert census.count() == 2
    kw = spark.read.parquet(os.path.join(tmp_dir, "parquet", "keywords.parquet"))
    assert sorted(r.keyword for r in kw.collect()) == ["serum", "sunscreen"]
    assert set(kw.columns) == {"keyword", "filename", "ingested_at"}
    # the silver mapping reads the year from the headers: 2023 here
    from demandlens.plans import census_columns as cc
    full = census
    for suffix, _, _ in cc.CENSUS_COLUMNS[2:]:
        full = full.withColumn(cc.header_for(2023, suffix), full["Other"].substr(0, 0))
    full = full.drop("Other").replace("", None)
    out = silver_census(full, on_error="null").orderBy("region_id").collect()
    assert [(r.region_id, r.geography_id, r.survey_year, r.total_population) for r in out] == [
        (1, "g01", 2023, 1200), (2, "g02", 2023, 3400)]
    assert abs(out[1].total_population_male_percentage - 50.25) < 1e-6


def test_census_without_year_headers_is_empty(spark):
    df = spark.createDataFrame([("g", "n")], "Geography string, `Geographic Area Name` string")
    out = silver_census(df)
    assert out.count() == 0 and "total_population" in out.columns


def _bronze(spark, root):
    L = Layout(root)
    kw = spark.createDataFrame([("serum", "k.csv", "2025-01-01 00:00:00"), ("sunscreen", "k.csv", "2025-01-01 00:00:00"),
                                ("toner", "k.csv", "2025-01-01 00:00:00")], "keyword string, filename string, ingested_at string")
    census = spark.createDataFrame(
        [("g1", "Northland", 1000, 40.0, 60.0), ("g2", "Southland", 2000, 55.0, 45.0)],
        "Geography string, `Geographic Area Name` string, total long, white double, black double")
    from demandlens.plans import census_columns as cc
    cols = [census["Geography"], census["`Geographic Area Name`"]]
    for suffix, name, dtype in cc.CENSUS_COLUMNS:
        src = {"total_population": "total", "white_alone_or_combination_percentage": "white",
               "black_alone_or_combination_percentage": "black"}.get(name)
        val = census[src] if src else (census["white"] / 10)
        cols.append(val.cast("bigint" if dtype == "bigint" else "double").alias(cc.header_for(2024, suffix)))
    census = census.select(*cols)
    trends = spark.createDataFrame(
        [("serum", "Northland", 80, dt.date(2024, 1, 1), dt.date(2024, 2, 1), "t", "2025-01-01 00:00:00"),
         ("serum", "Southland", 20, dt.date(2024, 1, 1), dt.date(2024, 2, 1), "t", "2025-01-01 00:00:00"),
         ("sunscreen", "Nowhere", 50, dt.date(2024, 1, 1), dt.date(2024, 2, 1), "t", "2025-01-01 00:00:00")],
        "keyword string, region string, interest_score long, begin_date date, end_date date, filename string, retrieved_at string")
    search = spark.createDataFrame(
        [("v1", "serum", "t1", "d", "c1", "C1", "2024-01-01T00:00:00Z", "2025-01-02 00:00:00"),
         ("v2", "serum", "t2", "d", "c1", "C1", "2024-01-01T00:00:00Z", "2025-01-02 00:00:00"),
         ("v3", "serum", "t3", "d", "c2", "C2", "2024-01-05T00:00:00Z", "2025-01-01 00:00:00"),
         ("v1", "sunscreen", "t1", "d", "c1", "C1", "2024-01-01T00:00:00Z", "2025-01-02 00:00:00"),
         ("v4", "SERUM", "t4", "d", "c3", "C3", "2024-01-01T00:00:00Z", "2025-01-02 00:00:00")],
        "video_id string, search_keyword string, title string, description string, channel_id string, "
        "channel_title string, publish_time string, searched_at string")
    stats = spark.createDataFrame(
        [("v1", 100, 10, 5, "PT1M", "2025-01-02 00:00:00"), ("v1", 150, 12, 6, "PT1M", "2025-01-03 00:00:00"),
         ("v2", 0, 1, 1, "PT30S", "2025-01-02 00:00:00"), ("v3", 40, 2, 2, None, "2025-01-02 00:00:00")],
        "video_id string, view_count long, like_count long, comment_count long, duration string, retrieved_at string")
    for name, df in [("keywords", kw), ("census", census), ("google_trends", trends), ("search_results", search),
                     ("video_statistics", stats)]:
        save_table(df, L.bronze(name))
    return L


def test_golden_pipeline(spark, tmp_dir):
    L = _bronze(spark, tmp_dir)
    paths = build_all(spark, tmp_dir, as_of="2025-01-10 00:00:00")
    assert set(paths) >= {"gold_channel_insights", "gold_business_kpis", "silver_search_results"}
    read = lambda n: spark.read.parquet(paths[n])
    # keyword ids follow keyword order; "SERUM" does not match "serum" (exact lookup)
    assert [(r.keyword_id, r.keyword) for r in read("silver_keywords").orderBy("keyword_id").collect()] == [
        (1, "serum"), (2, "sunscreen"), (3, "toner")]
    assert read("silver_search_results").count() == 4
    # unmatched region "Nowhere" drops out of silver trends
    assert read("silver_google_trends").count() == 2
    ch = {r.channel_id: r for r in read("gold_channel_insights").collect()}
    # latest serum batch = 2025-01-02 (v1, v2), sunscreen batch (v1); c1 has v1 twice (2 snapshots x 2 keywords)
    assert set(ch) == {"c1"}
    c1 = ch["c1"]
    assert (c1.total_videos_tracked, c1.keywords_appeared_in, c1.total_channel_views) == (2, 2, 500)
    assert c1.lowest_performing_video_views == 0 and c1.best_performing_video_views == 150
    kpi = read("gold_business_kpis").first()
    assert (kpi.total_videos_monitored, kpi.total_keywords_tracked, kpi.total_channels_monitored) == (2, 2, 1)
    assert kpi.report_date == dt.date(2025, 1, 10)
    km = {r.keyword: r for r in read("gold_keyword_market_analysis").collect()}
    assert km["sunscreen"].regions_with_interest == 0 and km["sunscreen"].avg_regional_interest == 0.0
    assert km["serum"].regions_with_interest == 2 and km["serum"].avg_regional_interest == 50.0
    geo = read("gold_geographic_insights").collect()
    # serum has 2 latest top-k rows, 2 regions -> 4 rows (fan-out)
    assert len(geo) == 4
    north = [r for r in geo if r.region_name == "Northland"][0]
    assert north.estimated_interested_population == 800.0 and abs(north.diversity_index - 40.0) < 1e-6
    tr = read("gold_trending_analysis").where("video_id = 'v1'").orderBy("performance_date", "keyword").collect()
    assert [r.daily_view_growth for r in tr] == [None, 0, 50, 0]  # joined rows: repeats show 0
    ts = G.gold_trending_analysis(read("silver_search_results"), read("silver_video_statistics"),
                                  read("silver_keywords"), growth_over="snapshots")
    assert sorted(r.daily_view_growth is None for r in ts.where("video_id = 'v1'").collect()) == [False, False, True, True]
    pend = pending_video_ids(spark, L)
    assert [r.video_id for r in pend.collect()] == ["v4"]
    assert statistics_requests(spark, L).first().ids == "v4"


def test_flatten_fixture_responses(spark):
    search = json.dumps({"items": [{"id": {"videoId": "v1"}, "snippet": {
        "title": "t", "description": "d", "channelId": "c1", "channelTitle": "C", "publishTime": "2024-01-02T03:04:05Z"}},
        {"id": {}}]})
    df = spark.createDataFrame([("serum", search)], "keyword string, body string")
    rows = flatten_search(df, searched_at="2025-01-01 00:00:00").collect()
    assert [(r.video_id, r.search_keyword, r.title, r.position) for r in rows] == [
        ("v1", "serum", "t", 0), (None, "serum", None, 1)]
    stats = json.dumps({"items": [{"id": "v1", "statistics": {"viewCount": "12"},
                                   "contentDetails": {"duration": "PT1M"}}, {"id": "v2"}]})
    rows = flatten_statistics(spark.createDataFrame([(stats,)], "body string")).collect()
    assert [(r.video_id, r.view_count, r.like_count, r.comment_count, r.duration) for r in rows] == [
        ("v1", 12, 0, 0, "PT1M"), ("v2", 0, 0, 0, None)]


def test_jdbc_export_in_process_derby(spark):
    url = "jdbc:derby:memory:dltest;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([("c1", 10), ("c2", 20)], "channel_id string, total long")
    export_jdbc(df, url, "GOLD_T", props)
    export_jdbc(df.limit(1), url, "GOLD_T", props)  # replace mode
    back = spark.read.jdbc(url, "GOLD_T", properties=props)
    assert back.count() == 1


def test_streaming_landing_available_now(spark, tmp_dir):
    from demandlens.streaming.landing import stream_search_responses, stream_statistics_responses, stream_trend_files

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write("Region,Serum: (1/1/24 - 2/1/24)\nX,5\nX,6\n")
    L = Layout(os.path.join(tmp_dir, "lake"))
    q = stream_trend_files(spark, src, L, os.path.join(tmp_dir, "ck1"), retrieved_at="2025-01-01 00:00:00")
    q.awaitTermination(120)
    rows = read_table(spark, L.bronze("google_trends")).collect()
    assert [(r.keyword, r.region, r.interest_score) for r in rows] == [("serum", "X", 5)]
    with open(os.path.join(src, "b.csv"), "w") as fh:
        fh.write("Region,Serum: (1/1/24 - 2/1/24)\nX,9\nY,7\n")
    for ck in ("ck1", "ck1b"):  # the next batch, and a second stream that takes all files as its batch 0
        stream_trend_files(spark, src, L, os.path.join(tmp_dir, ck), retrieved_at="2025-01-01 00:00:00").awaitTermination(120)
        got = sorted((r.region, r.interest_score) for r in read_table(spark, L.bronze("google_trends")).collect())
        assert got == [("X", 5), ("Y", 7)]
    stats_src = os.path.join(tmp_dir, "stats")
    os.makedirs(stats_src)
    with open(os.path.join(stats_src, "r1.json"), "w") as fh:
        fh.write(json.dumps({"items": [{"id": "v1", "statistics": {"viewCount": "3"}}]}) + "\n")
    for ck in ("ck2", "ck3"):  # a batch written again (its checkpoint was lost) leaves the same rows
        q = stream_statistics_responses(spark, stats_src, L, os.path.join(tmp_dir, ck))
        q.awaitTermination(120)
        assert [(r.video_id, r.view_count) for r in read_table(spark, L.bronze("video_statistics")).collect()] == [("v1", 3)]
    search_src = os.path.join(tmp_dir, "search")
    os.makedirs(search_src)
    with open(os.path.join(search_src, "s1.json"), "w") as fh:
        fh.write(json.dumps({"keyword": "serum", "items": [{"id": {"videoId": "v1"}}, {"id": {"videoId": "v2"}}, {"id": {"videoId": "v1"}}]}) + "\n")
    for ck in ("ck4", "ck5"):
        stream_search_responses(spark, search_src, L, os.path.join(tmp_dir, ck), searched_at="2025-01-01 00:00:00").awaitTermination(120)
        assert sorted((r.video_id, r.search_keyword) for r in read_table(spark, L.bronze("search_results")).collect()) == [("v1", "serum"), ("v2", "serum")]


@pytest.mark.parametrize("growth_over", ["sideways"])
def test_growth_mode_validated(spark, growth_over):
    df = spark.createDataFrame([("v", 1)], "video_id string, keyword_id long")
    with pytest.raises(ValueError):
        G.gold_trending_analysis(df, df, df, growth_over=growth_over)


def test_trend_ingest_metrics_and_kpi_latest_only(spark, tmp_dir):
    from demandlens.plans.pipeline import ingest_trend_files

    src = os.path.join(tmp_dir, "trends")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write("Region,Serum: (1/1/24 - 2/1/24)\nX,5\nX,6\nY,<1\n")
    with open(os.path.join(src, "b.csv"), "w") as fh:
        fh.write("Region,Serum: (1/1/24 - 2/1/24)\nX,9\n")
    L = Layout(os.path.join(tmp_dir, "lake"))
    report = ingest_trend_files(spark, src, L, retrieved_at="2025-01-01 00:00:00")
    assert report == {"rows": 4, "kept": 2, "removed_duplicates": 2}
    rows = sorted((r.region, r.interest_score) for r in spark.read.parquet(L.bronze("google_trends")).collect())
    assert rows == [("X", 5), ("Y", 1)]

    top = spark.createDataFrame([("v1", 1, "c1")], "video_id string, keyword_id long, channel_id string")
    kw = spark.createDataFrame([(1, "serum")], "keyword_id long, keyword string")
    stats = spark.createDataFrame(
        [("v1", 100, 1, 1, 60, dt.datetime(2025, 1, 1)), ("v1", 300, 1, 1, 60, dt.datetime(2025, 1, 2))],
        "video_id string, view_count long, like_count long, comment_count long, duration_seconds int, "
        "retrieved_at timestamp_ntz")
    all_rows = G.gold_business_kpis(top, stats, kw, as_of="2025-01-03 00:00:00").first()
    latest = G.gold_business_kpis(top, stats, kw, as_of="2025-01-03 00:00:00", latest_only=True).first()
    assert (all_rows.total_ecosystem_views, latest.total_ecosystem_views) == (400, 300)


def _intermediates(spark):
    from demandlens.session import checkpoint_root

    root = os.path.join(checkpoint_root(spark).removeprefix("file:"), "demandlens")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_build_all_removes_its_intermediates(spark, tmp_dir):
    from demandlens.session import materialize

    keep = materialize(spark.range(3), "keep_me")
    _bronze(spark, tmp_dir)
    before = _intermediates(spark)
    build_all(spark, tmp_dir, as_of="2025-01-10 00:00:00")
    assert _intermediates(spark) == before and keep.count() == 3
    with pytest.raises(Exception):  # a failing build leaves nothing either
        build_all(spark, tmp_dir, as_of="no time at all")
    assert _intermediates(spark) == before


def test_command_line_jobs(spark, tmp_dir, capsys):
    from demandlens.__main__ import main

    _bronze(spark, tmp_dir)
    main(["build", "--root", tmp_dir, "--as-of", "2025-01-10 00:00:00"])
    built = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert "gold_channel_insights" in built
    main(["requests", "--root", tmp_dir])
    printed = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert printed[-1] == {"batches": 1} and printed[0]["n_ids"] == len(printed[0]["ids"].split(","))
    main(["requests", "--root", tmp_dir, "--out", os.path.join(tmp_dir, "requests")])
    assert spark.read.json(os.path.join(tmp_dir, "requests")).count() == 1
    capsys.readouterr()
    main(["export", "--root", tmp_dir, "--url", "jdbc:derby:memory:clitest;create=true",
          "--properties", '{"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}'])
    exported = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert exported["gold_geographic_insights"] == 4 and len(exported) == 6


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        fh.write(text)


def test_csv_dialect(spark, tmp_dir):
    _write(f"{tmp_dir}/in/a.csv", 'k,v,K\n"say ""hi"", you",1,x\n"two\nlines",2,y\n"",3,\n')
    _write(f"{tmp_dir}/in/sub/b.csv", "k,v,k,\na,1,2,3\n")
    land_csv(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", add_provenance=False)
    a = spark.read.parquet(f"{tmp_dir}/out/a.parquet")
    assert a.columns == ["k", "v", "K.1"] and a.schema["v"].dataType.simpleString() == "int"
    assert sorted((r[0] or "", r[1], r[2]) for r in a.collect()) == [("", 3, None), ('say "hi", you', 1, "x"), ("two\nlines", 2, "y")]
    assert spark.read.parquet(f"{tmp_dir}/out/sub/b.parquet").columns == ["k", "v", "k.1", "Unnamed: 3"]


def test_label_row_wider_than_preamble(spark, tmp_dir):
    _write(f"{tmp_dir}/in/census.csv", 'Census table DP05\nGeography,"Name, full",Name,Name\ng1,n1,1,2\nGeography,"Name, full",Name,Name\ng2,"n\n2",3,4\n')
    land_csv(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", add_provenance=False)
    got = spark.read.parquet(f"{tmp_dir}/out/census.parquet")
    assert got.columns == ["Geography", "Name, full", "Name", "Name.1"]
    # only the label row itself goes, not a data row that repeats it
    assert sorted(tuple(r) for r in got.collect()) == [("Geography", "Name, full", "Name", "Name"), ("g1", "n1", "1", "2"), ("g2", "n\n2", "3", "4")]
    _write(f"{tmp_dir}/in2/census.csv", "only a preamble\n")
    land_csv(spark, f"{tmp_dir}/in2", f"{tmp_dir}/out2", add_provenance=False)
    assert spark.read.parquet(f"{tmp_dir}/out2/census.parquet").count() == 0


def test_malformed_responses_fail_or_are_set_aside(spark):
    from demandlens.sources.responses import SEARCH_RESPONSE_SCHEMA, split_malformed

    good = json.dumps({"items": [{"id": {"videoId": "v1"}}]})
    rows = [("k", good), ("k", good[:-4]), ("k", '{"items": {"id": 1}}'), ("k", "{}"), ("k", None)]
    df = spark.createDataFrame(rows, "keyword string, body string")
    for bad in rows[1:3]:
        with pytest.raises(Exception):
            flatten_search(spark.createDataFrame([bad], df.schema)).collect()
    fine, bad = split_malformed(df, SEARCH_RESPONSE_SCHEMA)
    assert sorted(r.body for r in bad.collect()) == sorted(r[1] for r in rows[1:3])
    assert [r.video_id for r in flatten_search(fine).collect()] == ["v1"]
    null = spark.createDataFrame([('{"items": [{"id": "v", "statistics": {"viewCount": null}}]}',)], "body string")
    with pytest.raises(Exception, match="viewCount is null for v"):
        flatten_statistics(null).collect()


def test_empty_trend_run_keeps_the_table(spark, tmp_dir):
    from demandlens.plans.pipeline import ingest_trend_files

    L = Layout(f"{tmp_dir}/lake")
    _write(f"{tmp_dir}/t1/a.csv", "Region,Serum: (1/1/24 - 2/1/24)\nX,5\n")
    _write(f"{tmp_dir}/t2/a.csv", "nothing here\n")
    assert ingest_trend_files(spark, f"{tmp_dir}/t1", L)["kept"] == 1
    assert ingest_trend_files(spark, f"{tmp_dir}/t2", L)["kept"] == 0
    assert spark.read.parquet(L.bronze("google_trends")).count() == 1


def test_raw_files_to_reports_by_command_line(spark, tmp_dir, capsys):
    """CSV, sectioned exports and responses in, reports out, only by the jobs."""
    from demandlens.__main__ import main
    from demandlens.plans import census_columns as cc

    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    labels = ["Geography", "Geographic Area Name", *[cc.header_for(2023, x) for x, _, _ in cc.CENSUS_COLUMNS]]
    labels = list(dict.fromkeys(labels))
    values = lambda g, n: [g, n, *["100" if "otal population" in x and "!!" + "Male" not in x else "10" for x in labels[2:]]]
    line = lambda xs: ",".join('"' + x + '"' for x in xs) + "\n"
    _write(f"{raw}/census.csv", "DP05\n" + line(labels) + line(values("g1", "Northland")) + line(values("g2", "Southland")))
    _write(f"{raw}/keywords.csv", "keyword\nserum\ntoner\n")
    _write(f"{raw}/google_trends/a.csv", "Region,Serum: (1/1/24 - 2/1/24)\nNorthland,80\nSouthland,20\n")
    item = lambda v: {"id": {"videoId": v}, "snippet": {"title": v, "channelId": "c1", "channelTitle": "C", "publishTime": "2024-12-01T00:00:00Z"}}
    _write(f"{tmp_dir}/search/s.json", json.dumps({"keyword": "serum", "items": [item("v1"), item("v2")]}) + "\n\n")
    main(["land-csv", "--src", raw, "--root", lake, "--database", "landed"])
    main(["ingest-trends", "--src", f"{raw}/google_trends", "--root", lake])
    main(["ingest-search", "--src", f"{tmp_dir}/search", "--root", lake, "--stamp", "2025-01-01 00:00:00"])
    capsys.readouterr()
    main(["requests", "--root", lake])  # first run: there is no statistics table yet
    assert json.loads(capsys.readouterr().out.splitlines()[0])["ids"] == "v1,v2"
    _write(f"{tmp_dir}/stats/a.json", json.dumps({"items": [{"id": "v1", "statistics": {"viewCount": "100", "likeCount": "5"}, "contentDetails": {"duration": "PT1M"}}]}) + "\n")
    main(["ingest-statistics", "--src", f"{tmp_dir}/stats", "--root", lake, "--stamp", "2025-01-02 00:00:00"])
    main(["ingest-statistics", "--src", f"{tmp_dir}/stats", "--root", lake, "--stamp", "2025-01-03 00:00:00"])
    L = Layout(lake)
    assert spark.read.parquet(L.bronze("video_statistics")).count() == 2
    capsys.readouterr()
    main(["requests", "--root", lake])
    assert json.loads(capsys.readouterr().out.splitlines()[0])["ids"] == "v2"
    main(["build", "--root", lake, "--as-of", "2025-01-10 00:00:00"])
    geo = spark.read.parquet(L.gold("geographic_insights")).collect()
    assert {r.region_name for r in geo} == {"Northland", "Southland"}
    assert spark.read.parquet(L.gold("trending_analysis")).count() == 2
    # the same from a catalog database
    from demandlens.sources.csv_landing import register_tables

    register_tables(spark, "landed", {n: L.bronze(n) for n in ("google_trends", "search_results", "video_statistics")})
    assert {t.name for t in spark.catalog.listTables("landed")} == {"census", "keywords", "google_trends", "search_results", "video_statistics"}
    assert [r.video_id for r in pending_video_ids(spark, L, database="landed").collect()] == ["v2"]
    assert len(build_all(spark, f"{tmp_dir}/lake2", as_of="2025-01-10 00:00:00", database="landed")) == 11
    spark.sql("DROP TABLE landed.video_statistics")
    assert pending_video_ids(spark, L, database="landed").count() == 2
    spark.sql("DROP DATABASE landed CASCADE")
