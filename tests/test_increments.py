"""Ids, growth, sketches, checks and replacement over several runs."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from demandlens.operators.checks import check_not_null, check_table, check_unique, union_checks
from demandlens.operators.latest import growth_from_last, late_entities, period_growth
from demandlens.operators.sketches import distinct_sketches, estimate, merge_sketches
from demandlens.operators.stable_ids import IdStore
from demandlens.sources.sinks import export_jdbc, save_table


def test_ids_stay_when_rows_come_and_go(spark, tmp_dir):
    store = IdStore(spark, f"{tmp_dir}/ids")
    schema = "k string, v int"

    def number(*rows):
        out = store.number(spark.createDataFrame(list(rows), schema), ["k", "v"], "id")
        assert out.columns == ["id", "k", "v"]
        return sorted(((r.k, r.v), r.id) for r in out.collect()) if rows else out.collect()

    assert store.number(spark.createDataFrame([], schema), ["k", "v"], "id").count() == 0
    first = [("b", 1), ("a", 2), ("a", 2), ("a", None)]
    one = store.number(spark.createDataFrame(first, schema), ["k", "v"], "id").collect()
    ids = sorted((r.id, r.k, r.v) for r in one)
    assert [i for i, *_ in ids] == [1, 2, 3, 4] and [x[1] for x in ids] == ["a", "a", "a", "b"] and ids[2][2] is None
    more = first + [("a", 1), ("a", 2), ("0", 0)]
    two = store.number(spark.createDataFrame(more, schema), ["k", "v"], "id").collect()
    assert {(r.id, r.k, r.v) for r in one} < {(r.id, r.k, r.v) for r in two}
    assert sorted(r.id for r in two) == list(range(1, 8))
    # rows that went leave their ids unused, and get them back
    assert number(("b", 1)) == [(("b", 1), 4)]
    three = store.number(spark.createDataFrame(more, schema), ["k", "v"], "id").collect()
    assert sorted(map(tuple, three), key=str) == sorted(map(tuple, two), key=str)


def test_growth_over_runs_is_the_growth_over_all(spark):
    rng = random.Random(2)
    rows = sorted({(rng.choice("abcde"), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(300)), rng.randrange(3), rng.randrange(100)) for _ in range(400)},
                  key=lambda r: (r[1], r[2]))
    rows.append(("a", None, 1, 7))
    schema = "e string, t timestamp_ntz, n int, v int"
    tied = lambda df: df.dropDuplicates(["e", "t", "n"])
    rows = [tuple(r) for r in tied(spark.createDataFrame(rows, schema)).collect()]
    rows.sort(key=lambda r: (r[1] is None, r[1] or dt.datetime.max, r[2]))
    whole = sorted(map(str, period_growth(spark.createDataFrame(rows, schema), "e", "t", "v", tie=["n"]).collect()))
    for cuts in ([0, 100, 101, 250, len(rows)], [0, 1, len(rows)]):
        # slices in time order; an equal time may be cut where the tie goes on
        got, last = [], None
        for i, j in zip(cuts, cuts[1:]):
            part = spark.createDataFrame(rows[i:j], schema)
            if last is not None:
                assert late_entities(part, last, "e", "t", tie=["n"]).count() == 0
            out, ends = growth_from_last(part, last, "e", "t", "v", tie=["n"])
            got += out.collect()
            last = spark.createDataFrame(ends.collect(), ends.schema)
        assert sorted(map(str, got)) == whole
    late = spark.createDataFrame([("b", dt.datetime(2023, 1, 1), 0, 1), ("zz", dt.datetime(2023, 1, 1), 0, 1)], schema)
    assert [r.e for r in late_entities(late, last, "e", "t", tie=["n"]).collect()] == ["b"]


def test_sketches_merge(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("day"), (F.col("id") % 50_000).alias("v"))
    by_day = distinct_sketches(df, ["g", "day"], "v")
    for r in merge_sketches(by_day, ["g"]).select("g", estimate().alias("n")).collect():
        assert abs(r.n - 50_000) < 0.03 * 50_000


def test_checks_of_a_table_in_one_scan(spark, tmp_dir):
    rows = [(1, "a", None), (1, "b", 2), (2, None, 2), (None, None, 2), (None, None, None)]
    spark.createDataFrame(rows, "k int, n string, v int").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    got = check_table(df, "t", ["k", "n", "v"], ["k", ["n", "v"], ["k", "n"]])
    want = union_checks([check_not_null(df, ["k", "n", "v"], "t"), check_unique(df, ["k"], "t"), check_unique(df, ["n", "v"], "t"), check_unique(df, ["k", "n"], "t")])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    empty = check_table(df.limit(0), "t", ["k"], ["k", "n"]).collect()
    assert [(r.check_name, r.columns, r.failures) for r in empty] == [("not_null", "k", 0), ("unique", "k", 0), ("unique", "n", 0)]


def test_a_failing_rebuild_leaves_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/tables/t"
    save_table(spark.range(5), path)
    bad = spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="half-way"):
        save_table(bad, path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(f"{tmp_dir}/tables") == ["t"]
    save_table(spark.read.parquet(path).where("id > 1"), path)  # rebuilt from itself
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3, 4] and os.listdir(f"{tmp_dir}/tables") == ["t"]


def test_a_failing_export_leaves_the_old_table(spark):
    url, props = "jdbc:derby:memory:replace;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = lambda: sorted(r.ID for r in spark.read.jdbc(url, "REPORT", properties=props).collect())
    frame = lambda n: spark.range(n).select(F.col("id").alias("ID"))
    for n in (3, 5):
        export_jdbc(frame(n), url, "REPORT", props)
        assert rows() == list(range(n))
    bad = spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("bigint").alias("ID"))
    with pytest.raises(Exception, match="half-way"):
        export_jdbc(bad, url, "REPORT", props)
    assert rows() == list(range(5))
    export_jdbc(frame(1), url, "REPORT", props)
    assert rows() == [0]


@pytest.mark.parametrize("name, keys", [
    ("channel_insights", [("total_channel_views", True)]),
    ("keyword_market", [("avg_video_performance", True), ("avg_engagement_rate", True)]),
    ("geographic_insights", [("keyword", False), ("interest_score", True)]),
    ("trending", [("performance_date", True), ("view_count", True)]),
    ("video_time_series", [("performance_date", True), ("view_count", True)]),
])
def test_reports_come_in_their_order(spark, name, keys):
    from demandlens.plans.queries import QUERIES

    rows = QUERIES[name](spark, SF_SMALL).select(*[k for k, _ in keys]).collect()
    assert len(rows) > 1

    def before(a, b):  # a may stand before b: NULLs last in either direction
        for (key, down), x, y in zip(keys, a, b):
            if x != y:
                return y is None or (x is not None and (x > y if down else x < y))
        return True

    assert all(before(tuple(a), tuple(b)) for a, b in zip(rows, rows[1:]))
