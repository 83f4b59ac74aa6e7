"""Scheduled landing as Structured Streaming file sources.

Instead of listing every file on every run, a file-stream source remembers
which files it has already taken (in its checkpoint). ``trigger(availableNow)``
processes whatever arrived since the last run and stops, so a scheduler can
start it like a batch job. Batches are written through ``foreachBatch`` into a sub-folder of
the bronze table that is named after the stream and the batch, so a batch that is tried again
replaces its own rows.

Search and statistics rows are de-duplicated over all batches by keyed state: the first row of
every video lives in the state store (RocksDB, in the checkpoint), and a batch hands on only the
videos that it saw first. A batch reads the state of its own keys, never the table; a batch that
is tried again starts from the state before it. ``once_per`` bounds the state: a video may
come again in the next period, and a period that has ended leaves the store.

Interest rows (whose parsing needs whole files) are de-duplicated within the files of a batch,
and against the keys of the other batches.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from demandlens.functions.util import as_list
from demandlens.plans.pipeline import Layout
from demandlens.session import scratch
from demandlens.sources.responses import (
    SEARCH_COLUMNS,
    SEARCH_RESPONSE_SCHEMA,
    STATISTICS_COLUMNS,
    STATISTICS_RESPONSE_SCHEMA,
    flatten_search,
    flatten_statistics,
    split_malformed,
)
from demandlens.sources.sections import DEDUP_KEYS, parse_sections, sections_to_bronze
from demandlens.sources.sinks import read_table, save_batch, table_exists


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _line_stream(spark: SparkSession, src_dir: str, path_glob: str | None = None, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(src_dir).select(
        F.col("_metadata.file_path").alias("filename"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def _start(stream: DataFrame, handler, checkpoint_location: str, available_now: bool, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(handler).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stream_trend_files(spark: SparkSession, src_dir: str, layout: Layout, checkpoint_location: str,
                       retrieved_at=None, filename_prefix: str | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """New sectioned export files -> parsed, de-duplicated rows appended to bronze google_trends."""

    def handle(batch: DataFrame, epoch_id: int) -> None:
        lines = batch.withColumn("pos", F.monotonically_increasing_id())
        with scratch(spark):
            rows = sections_to_bronze(parse_sections(lines, order=["pos"]), order=["pos"],
                                      retrieved_at=retrieved_at, filename_prefix=filename_prefix)
            path, name = layout.bronze("google_trends"), f"stream-{epoch_id}"
            if table_exists(spark, path=path):
                others = read_table(spark, path).where(~F.col("_metadata.file_path").contains(f"/{name}/")).select(*DEDUP_KEYS).distinct()
                same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(others[k]) for k in DEDUP_KEYS])
                rows = rows.join(others, same, "left_anti")
            save_batch(rows, path, name)

    return _start(_line_stream(spark, src_dir), handle, checkpoint_location, available_now)


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their order inside a task's read, ``pos`` (a stream has no row ids)."""

    def number(batches):
        n = 0
        for batch in batches:
            pos = pa.array(range(n, n + batch.num_rows), pa.int64())
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pos], names=[*batch.schema.names, "pos"])

    return lines.mapInArrow(number, "filename string, block bigint, line string, pos bigint")


RESPONSE_ORDER = ["filename", "block", "pos"]
_AT = "_dl_at"


def _documents(spark: SparkSession, src_dir: str, max_files: int | None) -> DataFrame:
    """New response documents: (filename, block, pos, keyword, body)."""
    lines = _numbered(_line_stream(spark, src_dir, max_files=max_files))
    docs = lines.withColumnRenamed("line", "body").where(F.trim("body") != "")
    return docs.withColumn("keyword", F.get_json_object("body", "$.keyword"))


def first_seen(rows: DataFrame, key: str, order, once_per: str | None = None) -> DataFrame:
    """The rows of a stream that are the first of their ``key``: of all batches, the earliest
    batch wins, inside a batch the least ``order``. With ``once_per`` (an interval) the first
    of every period of that length, by the time of the batch.

    Keyed state of one row a key (a minimum, kept in the state store). A batch has one time,
    which a repeated batch keeps, so a group whose first row carries it is new in this batch."""
    order = [*as_list(order)]
    rows = rows.withColumn(_AT, F.current_timestamp())
    keys = [F.col(key).alias("_dl_key")]
    if once_per:
        rows = rows.withWatermark(_AT, "0 seconds")  # rows carry their batch's time, so none is late
        keys.append(F.window(_AT, once_per).alias("_dl_period"))
    payload = [c for c in rows.columns if c not in (_AT, *order)]
    first = rows.groupBy(*keys).agg(F.min(F.struct(_AT, *order, *payload)).alias("_dl_first"))
    return first.where(F.col(f"_dl_first.{_AT}") == F.current_timestamp()).select("_dl_first.*").drop(_AT)


def _new_to_table(spark: SparkSession, rows: DataFrame, path: str, name: str, key: str, stamp: str, once_per: str | None) -> DataFrame:
    """For the first batch of a stream whose table has rows of earlier jobs: the rows whose key
    the table does not hold (in the same period)."""
    if not table_exists(spark, path=path):
        return rows
    # with the schema given, a folder that a failed batch left without files is an empty table
    table = spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(path)
    held = table.where(~F.col("_metadata.file_path").contains(f"/{name}/")).withColumn("_dl_key", F.col(key))
    same = rows[key].eqNullSafe(F.col("_dl_key"))
    if once_per:
        period = [F.window(F.to_timestamp(c), once_per)["start"] for c in (rows[stamp], F.col(stamp))]
        held = held.select("_dl_key", period[1].alias("_dl_start")).distinct()
        rows = rows.withColumn("_dl_start_of", period[0])
        return rows.join(held, same & F.col("_dl_start_of").eqNullSafe(F.col("_dl_start")), "left_anti").drop("_dl_start_of")
    return rows.join(held.select("_dl_key").distinct(), same, "left_anti")


def _land_first_seen(spark: SparkSession, flat: DataFrame, columns, path: str, stamp: str, once_per, checkpoint_location: str,
                     available_now: bool) -> StreamingQuery:
    def handle(batch: DataFrame, epoch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        name = f"stream-{stream}-{epoch_id}"
        rows = batch.select(*columns)
        if epoch_id == 0:  # the state is empty, the table need not be
            rows = _new_to_table(spark, rows, path, name, "video_id", stamp, once_per)
        save_batch(rows, path, name)

    # state on local disk beside the heap, snapshots in the checkpoint; a stream keeps the store it began with
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    first = first_seen(flat, "video_id", [*RESPONSE_ORDER, "position"], once_per)
    return _start(first, handle, checkpoint_location, available_now, mode="update")


def stream_search_responses(spark: SparkSession, src_dir: str, layout: Layout, checkpoint_location: str,
                            searched_at=None, available_now: bool = True, once_per: str | None = "1 day",
                            skip_malformed: bool = False, max_files: int | None = None) -> StreamingQuery:
    """New response files (one JSON document per line: {"keyword": ..., "items": [...]}) ->
    bronze search_results, the first row of a video in every ``once_per`` period (None: ever).

    A document that does not parse fails the batch; ``skip_malformed`` leaves such documents
    to :func:`stream_malformed_responses`."""
    docs = _documents(spark, src_dir, max_files)
    if skip_malformed:
        docs = split_malformed(docs, SEARCH_RESPONSE_SCHEMA)[0]
    flat = flatten_search(docs, searched_at=searched_at, keep=RESPONSE_ORDER)
    return _land_first_seen(spark, flat, SEARCH_COLUMNS, layout.bronze("search_results"), "searched_at", once_per, checkpoint_location, available_now)


def stream_statistics_responses(spark: SparkSession, src_dir: str, layout: Layout, checkpoint_location: str,
                                retrieved_at=None, available_now: bool = True, once_per: str | None = None,
                                skip_malformed: bool = False, max_files: int | None = None) -> StreamingQuery:
    """New statistics response files (one JSON document per line) -> bronze video_statistics, the
    first row of a video (a video with statistics is not taken again; ``once_per``: in every
    such period). Malformed documents as in :func:`stream_search_responses`."""
    docs = _documents(spark, src_dir, max_files)
    if skip_malformed:
        docs = split_malformed(docs, STATISTICS_RESPONSE_SCHEMA)[0]
    flat = flatten_statistics(docs, retrieved_at=retrieved_at, keep=RESPONSE_ORDER)
    return _land_first_seen(spark, flat, STATISTICS_COLUMNS, layout.bronze("video_statistics"), "retrieved_at", once_per, checkpoint_location, available_now)


RESPONSE_SCHEMAS = {"search_results": SEARCH_RESPONSE_SCHEMA, "video_statistics": STATISTICS_RESPONSE_SCHEMA}


def stream_malformed_responses(spark: SparkSession, src_dir: str, layout: Layout, checkpoint_location: str, table: str,
                               available_now: bool = True) -> StreamingQuery:
    """The quarantine beside a stream with ``skip_malformed``: documents of new response files of
    bronze ``table`` that do not parse, with their place, appended to bronze ``<table>_malformed``."""
    bad = split_malformed(_documents(spark, src_dir, None), RESPONSE_SCHEMAS[table])[1]
    path = layout.bronze(f"{table}_malformed")
    writer = bad.select("filename", "block", "body").writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
