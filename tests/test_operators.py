import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandlens.operators import (
    dedupe_first,
    dense_ids,
    latest_batch_top_k,
    latest_snapshot,
    pending_keys,
    period_growth,
    request_batches,
    select_keys,
)


def test_dense_ids_dense_unique_ordered(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 50), f"k{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    out = dense_ids(df, ["a", "b"], "id", num_partitions=7).collect()
    ids = sorted(r.id for r in out)
    assert ids == list(range(1, 501))
    by_id = sorted(out, key=lambda r: r.id)
    keys = [(r.a, r.b) for r in by_id]
    assert keys == sorted(keys)


def test_dense_ids_nulls_last_and_stable(spark):
    df = spark.createDataFrame([(None,), (3,), (1,), (None,), (2,)], "a int")
    first = sorted((r.id, r.a) for r in dense_ids(df, ["a"], "id").collect())
    assert [a for _, a in first] == [1, 2, 3, None, None]
    again = sorted((r.id, r.a) for r in dense_ids(df.repartition(3), ["a"], "id", num_partitions=2).collect())
    assert first == again


def _self_join_top_k(df, k):
    latest = df.groupBy("g").agg(F.max("t").alias("lt"))
    j = df.join(latest, (df.g == latest.g) & (df.t == latest.lt)).select(df["*"])
    w = Window.partitionBy("g", "t").orderBy(F.col("v").asc_nulls_last(), "id")
    return j.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def test_latest_batch_top_k_matches_self_join(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(2000):
        g = rnd.choice(["a", "a", "a", "b", "c", None])  # one hot group
        t = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 3))
        rows.append((i, g, t if rnd.random() > 0.02 else None, rnd.choice([None, f"v{rnd.randint(0, 40)}"])))
    df = spark.createDataFrame(rows, "id int, g string, t timestamp_ntz, v string")
    for k in (1, 5, 20, 1000):
        got = latest_batch_top_k(df, ["g"], "t", ["v", "id"], k=k)
        exp = _self_join_top_k(df, k)
        a = sorted(tuple(r) for r in got.select("id", "g", "t", "v", "rn").collect())
        b = sorted(tuple(r) for r in exp.select("id", "g", "t", "v", "rn").collect())
        assert a == b


def test_latest_batch_top_k_plans_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("timestamp").alias("t"), "id")
    plan = latest_batch_top_k(df, ["g"], "t", ["id"], k=20)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dedupe_first_order_nulls_and_idempotent(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), (None, 5, "p"), (None, 4, "q"), ("b", None, "n"), ("b", 9, "m")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    out = dedupe_first(df, ["k"], ["o"])
    got = sorted((r.k or "", r.o, r.v) for r in out.collect())
    assert got == [("", 4, "q"), ("a", 1, "y"), ("b", 9, "m")]
    twice = sorted((r.k or "", r.o, r.v) for r in dedupe_first(out, ["k"], ["o"]).collect())
    assert twice == got


def test_request_batches_cover_each_id_once(spark):
    df = spark.createDataFrame([(f"v{i:04d}",) for i in range(237)], "video_id string")
    out = request_batches(df, "video_id", size=50).orderBy("batch_id").collect()
    assert [r.n_ids for r in out] == [50, 50, 50, 50, 37]
    ids = [i for r in out for i in r.ids.split(",")]
    assert ids == sorted(f"v{i:04d}" for i in range(237))


def test_pending_keys_modes(spark):
    cand = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("a",)], "video_id string")
    done = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 3, 1))], "video_id string, retrieved_at timestamp_ntz")
    assert sorted(r.video_id for r in pending_keys(cand, done, "video_id").collect()) == ["c"]
    assert sorted(r.video_id for r in pending_keys(cand, None, "video_id").collect()) == ["a", "b", "c"]
    assert [r.video_id for r in pending_keys(cand, None, "video_id", limit=2).collect()] == ["a", "b"]
    stale = pending_keys(cand, done, "video_id", mode="stale", time_col="retrieved_at",
                         as_of="2024-03-05 00:00:00", max_age_days=10)
    assert sorted(r.video_id for r in stale.collect()) == ["a", "c"]
    assert [r.keyword for r in select_keys(spark.createDataFrame(
        [("z",), ("a",), (None,), ("a",)], "keyword string"), "keyword", limit=1).collect()] == ["a"]


def test_period_growth_and_latest_snapshot(spark):
    rows = [("v1", dt.datetime(2024, 1, 1), 10), ("v1", dt.datetime(2024, 1, 2), 25),
            ("v1", dt.datetime(2024, 1, 3), 20), ("v2", dt.datetime(2024, 1, 1), 5)]
    df = spark.createDataFrame(rows, "video_id string, t timestamp_ntz, views long")
    g = period_growth(df, "video_id", "t", "views", name="growth").orderBy("video_id", "t").collect()
    assert [r.growth for r in g] == [None, 15, -5, None]
    last = sorted((r.video_id, r.views) for r in latest_snapshot(df, "video_id", "t").collect())
    assert last == [("v1", 20), ("v2", 5)]


def test_period_growth_equals_one_window(spark):


    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        e = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])
        t = None if rnd.random() < 0.01 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 500))
        rows.append((i, e, t, rnd.choice([None, rnd.randint(0, 1000)])))
    df = spark.createDataFrame(rows, "id int, e string, t timestamp_ntz, v long")
    w = Window.partitionBy("e").orderBy(F.col("t").asc_nulls_last(), "id")
    plain = df.withColumn("g", F.col("v") - F.lag("v").over(w))
    for n in (1, 7, 40):
        split = period_growth(df, "e", "t", "v", tie=["id"], name="g", num_partitions=n)
        assert sorted((r.id, r.g) for r in split.collect()) == sorted((r.id, r.g) for r in plain.collect())
        assert split.columns == plain.columns
    assert period_growth(df.limit(0), "e", "t", "v").count() == 0


@pytest.mark.parametrize("growth_over", ["joined", "snapshots"])
def test_hot_video_is_spread_over_tasks(spark, growth_over):
    from demandlens.plans import gold as G
    from demandlens.session import materialize

    start = dt.datetime(2024, 1, 1)
    ts = lambda c: F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(mins=c.cast("int"))
    ids = spark.range(24_000)
    video = F.when(F.col("id") < 20_000, F.lit("hot")).otherwise(F.concat(F.lit("v"), (F.col("id") % 400).cast("string")))
    stats = ids.select(video.alias("video_id"), F.col("id").alias("view_count"), F.lit(1).cast("long").alias("like_count"),
                       F.lit(1).cast("long").alias("comment_count"), F.lit("PT1M").alias("duration"),
                       F.lit(60).alias("duration_seconds"), ts(F.col("id")).alias("retrieved_at"))
    search = spark.range(410).select(
        F.when(F.col("id") < 10, F.lit("hot")).otherwise(F.concat(F.lit("v"), (F.col("id") - 10).cast("string"))).alias("video_id"),
        F.lit(1).cast("long").alias("keyword_id"), F.lit("t").alias("title"), F.lit("c").alias("channel_id"),
        F.lit("C").alias("channel_title"), ts(F.lit(0)).alias("publish_time"), F.col("id").alias("search_result_id"))
    keywords = spark.createDataFrame([(1, "k")], "keyword_id long, keyword string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            # else this little input meets in one map task, which cannot be split
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = G.gold_trending_analysis(search, stats, keywords, growth_over=growth_over, ordered=False)
        written = materialize(out.withColumn("task", F.spark_partition_id()), "hot_video")
        per_task = [r["count"] for r in written.groupBy("task").count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(per_task) == 204_000
    # one video makes 98 % of the rows; no task has a fifth of them
    assert max(per_task) < sum(per_task) / 5, per_task


def test_bounded_broadcast_measures_rows_and_bytes(spark):
    from demandlens.operators.joins import bounded_broadcast, measured_size

    df = spark.createDataFrame([("abc", 1), ("de", None), (None, 3)], "s string, n long")
    rows, size = measured_size(df)
    assert rows == 3 and size == 3 * (8 + 8) + 5
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(bounded_broadcast(df)).lower()
    assert "broadcast" not in plan(bounded_broadcast(df, max_bytes=10)).lower()
    assert "broadcast" not in plan(bounded_broadcast(df, max_rows=2)).lower()



def test_lookup_exact_and_normalized(spark):
    from demandlens.operators.joins import lookup

    fact = spark.createDataFrame([("serum",), ("SERUM ",), ("toner",)], "kw string")
    dim = spark.createDataFrame([(1, "serum")], "keyword_id long, keyword string")
    exact = lookup(fact, dim, "kw", "keyword", ["keyword_id"]).collect()
    assert [(r.kw, r.keyword_id) for r in exact] == [("serum", 1)]
    norm = sorted((r.kw, r.keyword_id) for r in lookup(fact, dim, "kw", "keyword", ["keyword_id"], normalize=True).collect())
    assert norm == [("SERUM ", 1), ("serum", 1)]


def test_dense_ids_split_a_huge_tie_group(spark):
    df = spark.createDataFrame([(1 if i % 10 else 2, i) for i in range(2000)], "a int, b int")
    out = dense_ids(df, ["a"], "id", num_partitions=6)
    per_part = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    rows = sorted((r.id, r.a) for r in out.collect())
    assert [i for i, _ in rows] == list(range(1, 2001))
    assert [a for _, a in rows] == sorted(a for a in [1 if i % 10 else 2 for i in range(2000)])
    assert len(per_part) > 1
