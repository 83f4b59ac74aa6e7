"""Incremental refresh: a batch of new search rows and statistics brings the reports up to date.

Instead of rebuilding every report, a batch

1. is added to the silver facts as a sub-folder of its own (a batch that is tried again replaces
   its rows; their ids come from the id store, so they stay),
2. brings the latest top-k table up to date from its old rows and the batch alone (the newest
   search of a keyword is either in the old table or in the batch),
3. gives the changed groups of each report: channels, keywords and videos that it touches, also
   through the videos of the top-k table. They are written down before the top-k table changes,
   so a retry finds them,
4. rebuilds these groups with the reports' own code over the filtered facts and puts them in
   place: reports are partitioned by a hash of their key, and the touched partitions are replaced
   (by rename, when all are written) by their unchanged groups and the rebuilt ones.

The result is that of a full rebuild over all batches. The dimensions (keywords, census, interest)
are those of the last full build: a change there changes every group, so it calls for one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.operators.joins import bounded_broadcast
from demandlens.plans import gold as G
from demandlens.plans import silver as S
from demandlens.plans.pipeline import Layout
from demandlens.session import materialize, scratch, settings
from demandlens.sources.sinks import save_batch, save_table, table_exists

BUCKET = "_dl_bucket"
BUCKETS = 64

#: The key of each report's groups.
REPORT_KEYS = {
    "channel_insights": "channel_id",
    "keyword_market_analysis": "keyword_id",
    "geographic_insights": "keyword_id",
    "trending_analysis": "video_id",
    "video_performance_time_series": "video_id",
}


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


#: Rows dealt by bucket and a part of it stay where they are: joins on them and the video need no other
#: exchange, and a task, which has few buckets then, writes them side by side instead of sorting by bucket.
DEALT = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.maxConcurrentOutputFileWriters": str(BUCKETS)}


def dealt_by(spark: SparkSession, key: str) -> dict[str, Column]:
    """The bucket of ``key`` and a part of the bucket, so that buckets and parts fill the shuffle partitions."""
    parts = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // BUCKETS)
    part = F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(parts)).cast("int")
    return {BUCKET: bucket_of(key), "_dl_part_of_bucket": part}


def of_keys(df: DataFrame, keys: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``column`` is (or with "left_anti" is not) among ``keys``, NULL included."""
    wanted = keys.select(F.col(keys.columns[0]).alias("_dl_wanted"))
    return df.join(wanted, df[column].eqNullSafe(F.col("_dl_wanted")), how)


def replace_groups(spark: SparkSession, path: str, key: str, changed: DataFrame, fresh: DataFrame, dealt: bool = False) -> None:
    """Put the groups ``fresh`` (``dealt``: by :func:`dealt_by` already) in place of the groups
    ``changed`` of the report at ``path``.

    A changed group without fresh rows goes. Only partitions that hold a changed group are
    read and written; their numbers (BUCKETS at most) are all that reaches the driver."""
    touched = sorted(r[0] for r in changed.select(bucket_of(changed.columns[0])).distinct().collect())
    rows = fresh.withColumn(BUCKET, bucket_of(key))
    if table_exists(spark, path=path):
        schema = T.StructType([*fresh.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        old = spark.read.schema(schema).parquet(path).where(F.col(BUCKET).isin(touched))
        kept = of_keys(old, changed, key, "left_anti")
        rows = (kept.repartition(F.col(BUCKET)) if dealt else kept).unionByName(rows)
    rows = rows if dealt else rows.repartition(F.col(BUCKET))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    staged = jvm.org.apache.hadoop.fs.Path(folder.getParent(), f".{folder.getName()}.staged-{uuid.uuid4().hex[:12]}")
    try:
        # written once, beside the report; complete partitions take their place by rename
        with settings(spark, DEALT if dealt else {}):
            rows.write.option("compression", "zstd").partitionBy(BUCKET).parquet(staged.toString())
        fs.mkdirs(folder)
        for bucket in touched:
            part = jvm.org.apache.hadoop.fs.Path(folder, f"{BUCKET}={bucket}")
            new = jvm.org.apache.hadoop.fs.Path(staged, f"{BUCKET}={bucket}")
            replaced = jvm.org.apache.hadoop.fs.Path(staged, f"_replaced-{bucket}")
            had = fs.exists(part)
            if had and not fs.rename(part, replaced):
                raise OSError(f"cannot move {part.toString()} aside")
            # a partition without rows goes
            if fs.exists(new) and not fs.rename(new, part):
                if had:
                    fs.rename(replaced, part)
                raise OSError(f"cannot move the new rows to {part.toString()}")
    finally:
        fs.delete(staged, True)


class LiveReports:
    """The reports under ``<root>/live`` and the tables that a refresh works on.

    ``dimensions``: the silver tables keywords, census and google_trends (by default those that
    the last full build wrote under ``root``)."""

    def __init__(self, spark: SparkSession, root: str, dimensions: dict[str, DataFrame] | None = None, growth_over: str = "joined", k: int = G.TOP_K):
        self.spark, self.root, self.growth_over, self.k = spark, root.rstrip("/"), growth_over, k
        layout = Layout(root)
        self.dimensions = dimensions or {n: spark.read.parquet(layout.silver(n)) for n in ("keywords", "census", "google_trends")}
        self.ids = layout.ids(spark, "live_search_results")

    def path(self, name: str) -> str:
        return f"{self.root}/live/{name}"

    def report(self, name: str) -> DataFrame:
        """A report as it stands (rows in no order)."""
        if name == "business_kpis":
            return self.spark.read.parquet(self.path("gold_business_kpis"))
        schema = self.spark.read.parquet(self.path(f"columns/{name}")).schema  # a report may have no file at all
        return self.spark.read.schema(schema).parquet(self.path(f"gold_{name}")).drop(BUCKET)

    def _facts(self, name: str, schema) -> DataFrame:
        reader = self.spark.read.schema(schema).option("recursiveFileLookup", "true")
        return reader.parquet(self.path(name))

    def refresh(self, search: DataFrame, statistics: DataFrame, batch: str, as_of=None, reports=None) -> None:
        """Take one batch of bronze search rows and statistics; ``batch`` names it."""
        spark, keywords = self.spark, self.dimensions["keywords"]
        with scratch(spark):
            save_batch(S.silver_search_results(search, keywords, number=self.ids.number), self.path("search_results"), batch)
            save_batch(S.silver_video_statistics(statistics), self.path("video_statistics"), batch)
            new_search = spark.read.parquet(f"{self.path('search_results')}/{batch}")
            new_stats = spark.read.parquet(f"{self.path('video_statistics')}/{batch}")
            all_search = self._facts("search_results", new_search.schema)
            all_stats = self._facts("video_statistics", new_stats.schema)

            old_top = spark.read.parquet(self.path("latest_top_k")) if table_exists(spark, path=self.path("latest_top_k")) else None
            top, changed = self._changes(old_top, new_search, new_stats, batch)
            save_table(top, self.path("latest_top_k"))
            top = spark.read.parquet(self.path("latest_top_k"))

            for name, build in self._builders(top, all_search, all_stats, changed).items():
                if reports is None or name in reports:
                    key, fresh = REPORT_KEYS[name], build()
                    save_table(fresh.limit(0), self.path(f"columns/{name}"))
                    replace_groups(spark, self.path(f"gold_{name}"), key, changed[key], fresh, dealt=key == "video_id")
            if reports is None or "business_kpis" in reports:  # one group, from the top-k videos
                save_table(G.gold_business_kpis(top, all_stats, keywords, as_of=as_of), self.path("gold_business_kpis"))

    def _changes(self, old_top: DataFrame | None, new_search: DataFrame, new_stats: DataFrame, batch: str):
        """(new top-k table, changed keys by column): written, so that a retry has them all."""
        # the newest batch of a keyword is that of its old rows or of the new ones: each is cut to k rows first
        top = G.latest_searches_top_k(new_search, self.k).select(*new_search.columns)
        if old_top is not None:
            both = old_top.select(*new_search.columns).unionByName(top).dropDuplicates(["search_result_id"])
            top = G.latest_searches_top_k(both, self.k)
        else:
            top = G.latest_searches_top_k(top, self.k)
        top = materialize(top, "refresh_top")
        searched = materialize(new_search.select("keyword_id").distinct(), "refresh_keywords")
        counted = new_stats.select("video_id").distinct()
        both = top if old_top is None else top.select("keyword_id", "channel_id", "video_id").unionByName(old_top.select("keyword_id", "channel_id", "video_id"))
        both = both.select("keyword_id", "channel_id", "video_id")
        touched = materialize(of_keys(both, searched, "keyword_id").unionByName(of_keys(both, counted, "video_id")), "refresh_touched")
        keys = {
            "keyword_id": touched.select("keyword_id").unionByName(searched),
            "channel_id": touched.select("channel_id"),
            "video_id": counted.unionByName(new_search.select("video_id")),
        }
        changed = {}
        for column, found_keys in keys.items():
            path = self.path(f"changed/{column}")
            attempts = f"{path}/{batch}"
            before = read_or_none(self.spark, attempts, found_keys.schema)
            rows = materialize(found_keys.unionByName(before).distinct(), "refresh_changed")
            save_batch(rows, path, batch)
            changed[column] = bounded_broadcast(self.spark.read.parquet(attempts))
        return top, changed

    def _builders(self, top, search, stats, changed) -> dict[str, Callable[[], DataFrame]]:
        keywords, census, trends = (self.dimensions[n] for n in ("keywords", "census", "google_trends"))
        of = lambda df, column: of_keys(df, changed[column], column)

        def history(report):
            # written once: the facts of changed videos are joined and windowed several times
            found = materialize(of(search, "video_id"), "refresh_search")
            known = materialize(of(stats, "video_id"), "refresh_stats")
            return report(found, known, keywords, growth_over=self.growth_over, ordered=None, dealt=dealt_by(self.spark, "video_id"))

        return {
            "channel_insights": lambda: G.gold_channel_insights(of(top, "channel_id"), stats, keywords),
            "keyword_market_analysis": lambda: G.gold_keyword_market_analysis(of(top, "keyword_id"), stats, keywords, of(trends, "keyword_id")),
            "geographic_insights": lambda: G.gold_geographic_insights(of(top, "keyword_id"), of(trends, "keyword_id"), keywords, census),
            "trending_analysis": lambda: history(G.gold_trending_analysis),
            "video_performance_time_series": lambda: history(G.gold_video_performance_time_series),
        }


def read_or_none(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet folder, or no rows where there is none yet."""
    return spark.read.schema(schema).parquet(path) if table_exists(spark, path=path) else spark.createDataFrame([], schema)
