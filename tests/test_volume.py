"""Steps that send or write each row once: their results by brute force, and the shape that keeps them small."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from demandlens.operators import stable_ids
from demandlens.operators.keys import dense_ids
from demandlens.plans import gold as G
from demandlens.plans import refresh
from demandlens.session import materialize

SEARCH = "video_id string, keyword_id long, title string, description string, channel_id string, channel_title string, publish_time timestamp_ntz, searched_at timestamp_ntz, search_result_id long"
STATS = "video_id string, view_count long, like_count long, comment_count long, duration string, duration_seconds long, retrieved_at timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def _tables(spark):
    rng = random.Random(4)
    videos = [None, "many", "v1", "v2", "v3", 'v"4']
    search, n = [], 0
    for _ in range(160):
        v, n = rng.choice(videos), n + 1
        title = rng.choice([None, "", 'a "b", [c]\n', "é\\u0041", "1"])
        search.append((v, rng.choice([None, 1, 2, 3, 9]), title, "d", rng.choice([None, "c"]), "C", T0 + dt.timedelta(microseconds=n), T0, n))
    stats = [(rng.choice([*videos, "v9"]), rng.choice([None, 5, rng.randrange(99)]), k, 1, "PT1M", 60, rng.choice([None, T0 + dt.timedelta(hours=rng.randrange(90))])) for k in range(120)]
    keywords = [(1, "one"), (2, "two"), (2, "again"), (3, None)]
    return (search, stats, keywords, spark.createDataFrame(search, SEARCH), spark.createDataFrame(stats, STATS),
            spark.createDataFrame(keywords, "keyword_id long, keyword string"))


def _expected(search, stats, keywords, mode):
    out = []
    for v in {s[0] for s in stats} - {None}:
        last = lambda x: (x is None, x if x is not None else 0)
        snaps = sorted((s for s in stats if s[0] == v), key=lambda s: ((s[6] is None, s[6] or T0), *map(last, (s[1], s[2], s[3], s[5]))))
        found = [s for s in search if s[0] == v]
        first = min((s[8] for s in found), default=None)
        for i, s in enumerate(snaps):
            before = snaps[i - 1][1] if i else None
            growth = None if before is None or s[1] is None else s[1] - before
            for r in found:
                for kid, kw in keywords:
                    if kid == r[1]:
                        g = growth if mode == "snapshots" or r[8] == first else (None if s[1] is None else 0)
                        out.append((v, kw, r[2], r[5], r[4], r[6], s[6] and s[6].date(), s[1], s[2], g))
    return sorted(map(repr, out))


@pytest.mark.parametrize("hot", ["none", "one", "all"])
@pytest.mark.parametrize("mode", ["joined", "snapshots"])
def test_growth_rows_by_brute_force(spark, monkeypatch, mode, hot):
    search, stats, keywords, s, t, k = _tables(spark)
    many = spark.createDataFrame([("many",)], "video_id string").select(G._bucket()).first()[0]
    monkeypatch.setattr(G, "_hot_buckets", lambda *_: {"none": [], "one": [many], "all": None}[hot])
    monkeypatch.setattr(G, "PACK", 7)  # a video's search rows take several packs
    for ordered in (True, False):
        got = G.gold_video_performance_time_series(s, t, k, growth_over=mode, ordered=ordered).select(
            "video_id", "keyword", "title", "channel_title", "channel_id", "publish_time", "performance_date", "view_count", "like_count", "daily_view_growth")
        assert sorted(repr(tuple(r)) for r in got.collect()) == _expected(search, stats, keywords, mode)


def test_rows_multiply_behind_the_sort(spark):
    *_, s, t, k = _tables(spark)
    plan = G.gold_trending_analysis(s, t, k)._jdf.queryExecution().optimizedPlan().toString()
    # a plan prints its top first: the rows of the packs come out above the sort
    assert plan.index("Generate explode(from_json") < plan.index("Sort [")


def test_hot_buckets(spark):
    ids = spark.range(9000).select(F.when(F.col("id") < 5000, "hot").otherwise(F.col("id").cast("string")).alias("video_id"))
    few = spark.range(10).select(F.col("id").cast("string").alias("video_id"))
    want = [r[0] for r in spark.createDataFrame([("hot",)], "video_id string").select(G._bucket()).collect()]
    assert G._hot_buckets(few, ids) == want == G._hot_buckets(ids, few) and G._hot_buckets(few, few) == []


def test_ids_written_rows_do_not_carry_the_salt(spark, monkeypatch):
    written = []
    monkeypatch.setattr("demandlens.operators.keys.materialize", lambda df, name: written.append(df.columns) or df)
    dense_ids(spark.range(5), ["id"], "n")
    assert len(written) == 1 and not [c for c in written[0] if "salt" in c]


def test_store_numbers_whole_rows_with_one_copy(spark, tmp_dir, monkeypatch):
    written, real = [], stable_ids.materialize
    monkeypatch.setattr(stable_ids, "materialize", lambda df, name: written.append(name) or real(df, name))
    store = stable_ids.IdStore(spark, f"{tmp_dir}/whole")
    number = lambda rows: sorted(map(repr, map(tuple, store.number(spark.createDataFrame(rows, "k string, v int"), ["k", "v"], "id").collect())))
    assert number([("b", 1), (None, 1), ("b", 1), ("a", None)]) == sorted(map(repr, [(1, "a", None), (2, "b", 1), (3, "b", 1), (4, None, 1)]))
    assert number([("b", 1), ("b", 1), ("b", 1), ("c", 0)]) == sorted(map(repr, [(2, "b", 1), (3, "b", 1), (5, "b", 1), (6, "c", 0)]))
    assert number([("c", 0), (None, 1)]) == sorted(map(repr, [(6, "c", 0), (4, None, 1)]))
    assert written == ["stable_rows"] * 3


def test_report_groups_are_written_once(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(refresh, "materialize", lambda *_: pytest.fail("rows written aside"))
    rows = spark.range(300).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    refresh.replace_groups(spark, f"{tmp_dir}/once/r", "k", rows.select("k"), rows)
    refresh.replace_groups(spark, f"{tmp_dir}/once/r", "k", spark.createDataFrame([(5,), (6,)], "k long"), spark.createDataFrame([(5, "new")], "k long, v string"))
    got = {r.k: r.v for r in spark.read.parquet(f"{tmp_dir}/once/r").collect()}
    assert got.pop(5) == "new" and sorted(got) == [i for i in range(300) if i not in (5, 6)] and set(got.values()) == {"old"}


def test_exchanges_go_when_their_frame_is_written(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    shuffles = lambda: {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = shuffles()
    rows = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "exchanges")
    deadline = time.time() + 20
    while shuffles() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before
    assert rows.count() == 7 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_ids_travel_only_where_they_count(spark):
    *_, s, t, k = _tables(spark)
    plan = lambda mode: G.gold_trending_analysis(s, t, k, growth_over=mode)._jdf.queryExecution().optimizedPlan().toString()
    assert "_dl_least" in plan("joined") and "_dl_least" not in plan("snapshots")


def test_multiplied_rows_are_written_where_they_are(spark, tmp_dir):
    *_, s, t, k = _tables(spark)
    rows = G.gold_trending_analysis(s, t, k, growth_over="snapshots", ordered=None, dealt=refresh.dealt_by(spark, "video_id"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" not in plan and "_dl_part_of_bucket" in plan
    refresh.replace_groups(spark, f"{tmp_dir}/dealt", "video_id", rows.select("video_id").distinct(), rows, dealt=True)
    files = spark.read.parquet(f"{tmp_dir}/dealt").select(refresh.BUCKET, "_metadata.file_name").distinct().groupBy(refresh.BUCKET).count().collect()
    assert files and {r[1] for r in files} == {1}  # a bucket's rows met in one task
    assert sorted(map(repr, spark.read.parquet(f"{tmp_dir}/dealt").drop(refresh.BUCKET).collect())) == sorted(map(repr, rows.collect()))
