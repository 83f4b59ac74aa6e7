"""CSV landing: every CSV under a prefix becomes a Parquet table (bronze).

Each file is its own table (keywords.csv -> keywords). The files are listed on the driver
(metadata only) and surveyed together: one scan finds which files have quoted line breaks, one
their header lines. Files with the same header are read by one scan and written by one job,
whose output is cut by file; the folders then take their places by rename. Files of one header
share their inferred types: those that hold for all of them.

Quoted fields may hold doubled quotes and line breaks. A file without such breaks is read in
splits by the CSV reader. In any other, the records are cut first (:func:`cut_records`), also
split by split: no file is read by one task. Lines there end at "\\n" or "\\r\\n". A quote that is
never closed makes one record of the rest of its file, as in every CSV parser.
"""

from __future__ import annotations

import csv
import datetime as _dt
import io
import posixpath
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.functions.text import strip_ws
from demandlens.operators.joins import bounded_broadcast
from demandlens.session import delete_folders, materialize, scratch
from demandlens.sources.sections import read_lines
from demandlens.sources.sinks import replace_path

# Header groups landed at the same time.
PARALLEL_GROUPS = 8
DIALECT = {"quote": '"', "escape": '"'}
# Where a text stands: at a field's start, inside a plain field, inside quotes, behind a quote
# that closes its field unless another one follows.
FIELD_START, IN_FIELD, QUOTED, CLOSING = 0, 1, 2, 3


def list_files(spark: SparkSession, root: str, suffix: str = ".csv") -> list[str]:
    """Recursive listing of ``root`` through the Hadoop file system (works for local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    it = fs.listFiles(path, True)
    out = []
    while it.hasNext():
        p = it.next().getPath().toString()
        if p.endswith(suffix):
            out.append(p)
    return sorted(out)


def ends_open(line: Column, inside: bool) -> Column:
    """Does the line end inside a quoted field, when it begins inside one or (not ``inside``)
    at the start of a record? Quotes within a plain field are text."""
    pieces = F.split(line, '"', -1)
    first = F.get(pieces, F.lit(0))
    at_start = F.when((first == "") | first.endswith(","), FIELD_START).otherwise(IN_FIELD)

    def behind_quote(state, piece):
        return (
            F.when(state.isin(FIELD_START, CLOSING), QUOTED)
            .when((state == QUOTED) & (piece == ""), CLOSING)
            .when(piece.endswith(","), FIELD_START)
            .otherwise(IN_FIELD)
        )

    begin = F.lit(QUOTED) if inside else at_start
    end = F.aggregate(F.slice(pieces, 2, F.size(pieces)), begin, behind_quote)
    return F.when(line.contains('"'), end == QUOTED).otherwise(F.lit(inside))


def cut_records(lines: DataFrame) -> DataFrame:
    """CSV records (filename, block, pos, record) of ``read_lines`` rows, in any number of splits.

    A line maps "begins inside quotes" to "ends inside quotes". It keeps the state, turns it
    or sets it, so the state behind a line is that of the last setting line, turned once for
    every turning line since. A window over each split counts turns and carries the last
    setting, for both possible states at the split's begin; one row a split then settles
    which of them holds, and to which record the split's first lines belong. (block, pos) is
    the place of a record's first line. Blank records are left out.
    """
    in_split = Window.partitionBy("filename", "block").orderBy("pos")
    so_far = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = F.col("line")
    rows = lines.select("*", ends_open(line, False).cast("int").alias("o"), ends_open(line, True).cast("int").alias("i"))
    rows = rows.select("*", (F.sum(F.when(F.col("o") > F.col("i"), 1).otherwise(0)).over(so_far) % 2).cast("int").alias("turned"))
    setting = F.when(F.col("o") == F.col("i"), F.col("o").bitwiseXOR(F.col("turned")))
    rows = rows.select("*", F.last(setting, ignorenulls=True).over(so_far).alias("set"))
    rows = rows.select("*", F.lag("turned", 1, 0).over(in_split).alias("turned_before"), F.lag("set").over(in_split).alias("set_before"))

    def before(start: Column) -> Column:
        return F.coalesce(F.col("set_before"), start).bitwiseXOR(F.col("turned_before"))

    rows = rows.select(
        "filename", "block", "pos", "line", "turned", "set", "turned_before", "set_before",
        *[F.last(F.when(before(F.lit(s)) == 0, F.col("pos")), ignorenulls=True).over(so_far).alias(f"record_{s}") for s in (0, 1)],
        F.lead("pos").over(in_split).isNull().alias("is_last"),
    )
    rows = materialize(rows, "csv-lines")

    # One row a split.
    splits = rows.where("is_last").select("filename", "block", "turned", "set", "record_0", "record_1")
    over_splits = Window.partitionBy("filename").orderBy("block")
    until = over_splits.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = over_splits.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("*", (F.sum("turned").over(until) % 2).cast("int").alias("all_turned"))
    # "set" already holds its split's own turns up to it; those of earlier splits come on top.
    turns_before = F.col("all_turned").bitwiseXOR(F.col("turned"))
    splits = splits.select("*", F.last(F.col("set").bitwiseXOR(turns_before), ignorenulls=True).over(until).alias("all_set"))
    splits = splits.select(
        "*",
        F.coalesce(F.lag("all_set").over(over_splits), F.lit(0))
        .bitwiseXOR(F.coalesce(F.lag("all_turned").over(over_splits), F.lit(0))).alias("start"),
    )
    own = F.when(F.col("start") == 0, F.col("record_0")).otherwise(F.col("record_1"))
    last_record = F.when(own.isNotNull(), F.struct("block", own.alias("pos")))
    splits = splits.select("filename", "block", "start", F.last(last_record, ignorenulls=True).over(earlier).alias("carried"))

    rows = rows.drop("is_last").join(bounded_broadcast(splits), ["filename", "block"])
    own = F.when(F.col("start") == 0, F.col("record_0")).otherwise(F.col("record_1"))
    rows = rows.select(
        "filename", "block", "pos", "line",
        before(F.col("start")).alias("b"),
        F.coalesce(F.col("set"), F.col("start")).bitwiseXOR(F.col("turned")).alias("a"),
        F.coalesce(F.when(own.isNotNull(), F.struct("block", own.alias("pos"))), F.col("carried")).alias("at"),
    )
    whole = (F.col("b") == 0) & (F.col("a") == 0)
    single = rows.where(whole).select("filename", "block", "pos", F.col("line").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("block", "pos", "line")))
    broken = (
        rows.where(~whole).groupBy("filename", "at").agg(parts.alias("parts"))
        .select("filename", "at.block", "at.pos", F.array_join(F.col("parts.line"), "\n").alias("record"))
    )
    records = single.unionByName(broken)
    record = F.col("record")
    records = records.withColumn("record", F.when(record.endswith("\r"), F.left(record, F.length(record) - 1)).otherwise(record))
    return records.where(strip_ws(record) != "")


def _fields(record: str) -> list[str]:
    return next(csv.reader(io.StringIO(record, newline=""), strict=False), [])


def unique_labels(labels: list[str]) -> list[str]:
    """Column names from a label row: blank ones named by position, repeated ones numbered
    ("x", "x.1", ...). Names that differ in case only count as repeated, as table columns do."""
    taken: set[str] = set()
    out = []
    for i, label in enumerate(labels):
        base = label if label.strip() else f"Unnamed: {i}"
        name, k = base, 0
        while name.lower() in taken:
            k += 1
            name = f"{base}.{k}"
        taken.add(name.lower())
        out.append(name)
    return out


def _schema_of(records: DataFrame, width: int) -> list[T.DataType]:
    """Types that the CSV reader infers for record texts."""
    spark = records.sparkSession
    texts = records.select("record")
    if width > 1:  # a row of that many empty fields comes first: the reader takes the width from it
        texts = spark.range(1).select(F.lit("," * (width - 1)).alias("record")).union(texts)
    strings = getattr(texts._jdf, "as")(spark.sparkContext._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(inferSchema="true", **DIALECT)
    types = [f.dataType for f in reader._df(reader._jreader.csv(strings)).schema.fields]
    return (types + [T.StringType()] * width)[:width]


def _parse(records: DataFrame, types: list[T.DataType]) -> DataFrame:
    """Records as columns _c0, _c1, ... behind their filename."""
    ddl = ", ".join(f"_c{i} {t.simpleString()}" for i, t in enumerate(types))
    return records.select("filename", F.from_csv("record", ddl, DIALECT).alias("r")).select("filename", "r.*")


class _Group:
    """Files with the same header: how to read them in one scan."""

    def __init__(self, labels: list[str], files: list[str], body: DataFrame | None, text: bool):
        self.labels, self.files, self.body, self.text = labels, files, body, text

    def read(self, spark: SparkSession, paths: dict[str, str], schema=None, infer: bool = True) -> DataFrame:
        """Rows of all files: "_dl_file" and the columns, named by the labels or the schema."""
        names = unique_labels(self.labels) if schema is None else [f.name for f in schema.fields]
        if not names:
            return spark.createDataFrame([], "_dl_file string")
        types = None if schema is None else [f.dataType for f in schema.fields]
        if types is None and (self.text or not infer):
            types = [T.StringType()] * len(names)
        if self.body is not None:
            rows = _parse(self.body, types or _schema_of(self.body, len(names))).withColumnRenamed("filename", "_dl_file")
        else:
            where = [paths[f] for f in self.files]
            reader = spark.read.options(header="true", **DIALECT)
            if types is None:
                types = [f.dataType for f in reader.option("inferSchema", "true").csv(where).schema.fields]
            plain = T.StructType([T.StructField(f"_c{i}", t) for i, t in enumerate(types)])
            rows = reader.schema(plain).csv(where).select(F.col("_metadata.file_path").alias("_dl_file"), "*")
        return rows.toDF("_dl_file", *names)


def _scan_name(name: str) -> str:
    return re.sub("^file:/+", "file:/", name)


def _scan_names(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """{file name as the scans give it: path}."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = {}
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        out[_scan_name(path.getFileSystem(conf).makeQualified(path).toUri().toString())] = p
    return out


def _survey(spark: SparkSession, paths: list[str], label_rows: set[str]) -> tuple[list[_Group], dict[str, str]]:
    """The files by header, and {name in the scans: path}. Those of ``label_rows`` have a
    preamble first and their header second. Two scans of all lines, and one more of the
    files whose records have to be cut first."""
    if not paths:
        return [], {}
    by_name = _scan_names(spark, paths)
    lines = read_lines(spark, paths, recursive=False)
    found = lines.groupBy("filename").agg(F.max(ends_open(F.col("line"), False)).alias("open")).collect()
    names = {r.filename: by_name[_scan_name(r.filename)] for r in found}
    first = lines.where((F.col("block") == 0) & (strip_ws(F.col("line")) != ""))
    heads = {r.filename: r.line.removesuffix("\r") for r in first.groupBy("filename").agg(F.min_by("line", "pos").alias("line")).collect()}
    plain: dict[str, list[str]] = {}
    cut = []
    for r in found:
        if r.open or names[r.filename] in label_rows or r.filename not in heads:
            cut.append(r.filename)
        else:
            plain.setdefault(heads[r.filename], []).append(r.filename)
    groups = [_Group(_fields(head), sorted(files), None, False) for head, files in plain.items()]
    lost = sorted(set(paths) - set(names.values()))  # empty files
    names.update({p: p for p in lost})
    if lost:
        groups.append(_Group([], lost, None, False))
    if not cut:
        return groups, names

    records = materialize(cut_records(read_lines(spark, [names[f] for f in cut], recursive=False)), "csv-records")
    place = F.row_number().over(Window.partitionBy("filename").orderBy("block", "pos"))
    tops = records.select("*", place.alias("n")).where("n <= 2").collect()
    top = {(r.filename, r.n): r for r in tops}
    by_head: dict[tuple, list] = {}
    for f in cut:
        labelled = names[f] in label_rows
        at = top.get((f, 2 if labelled else 1))
        if at is None:  # blank, or a preamble alone
            only = top.get((f, 1))
            groups.append(_Group(_fields(only.record) if only else [], [f], records.where("false"), True))
        else:
            by_head.setdefault((labelled, at.record), []).append(at)
    for (labelled, head), found_at in by_head.items():
        files = sorted(r.filename for r in found_at)
        starts = spark.createDataFrame([(r.filename, r.block, r.pos) for r in found_at], "filename string, b long, p long")
        behind = (F.col("block") > F.col("b")) | ((F.col("block") == F.col("b")) & (F.col("pos") > F.col("p")))
        body = records.join(bounded_broadcast(starts), "filename").where(behind).select("filename", "record")
        groups.append(_Group(_fields(head), files, body, labelled))
    return groups, names


def read_csv(spark: SparkSession, path: str, infer_schema: bool = True, schema=None) -> DataFrame:
    """Header CSV with type inference (a second pass over the file) or a declared schema."""
    (group,), names = _survey(spark, [path], set())
    return group.read(spark, names, schema, infer_schema).drop("_dl_file")


def read_csv_label_row(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose first row is a preamble and whose *second* row holds the column names.

    The names come from the second record, however wide the preamble is or however many lines
    the two take. Values stay text; the silver model casts them.
    """
    (group,), names = _survey(spark, [path], {path})
    return group.read(spark, names).drop("_dl_file")


def target_path(src_root: str, dst_root: str, file_path: str, suffix: str = ".parquet") -> str:
    """csv/<rel>.csv -> <destination root>/<rel><suffix>."""
    src = src_root.rstrip("/")
    rel = file_path[len(src) + 1:] if file_path.startswith(src + "/") else posixpath.basename(file_path)
    if src.startswith("/") and file_path.startswith("file:"):
        local = file_path[len("file:"):]
        rel = local[len(src) + 1:] if local.startswith(src + "/") else posixpath.basename(local)
    if rel.endswith(".csv"):
        rel = rel[: -len(".csv")] + suffix
    return f"{dst_root.rstrip('/')}/{rel}"


def land_csv(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    label_row_files=("census.csv",),
    exclude_prefixes=("google_trends",),
    ingested_at: str | None = None,
    add_provenance: bool = True,
    suffix: str = ".parquet",
    schemas: dict | None = None,
) -> dict[str, str]:
    """Convert every CSV under ``src_root`` to Parquet under ``dst_root``.

    ``label_row_files`` (base names) use the preamble + label-row layout; paths below any of
    ``exclude_prefixes`` (relative) are skipped - the sectioned interest exports live next to
    the CSVs but are not CSV. With ``add_provenance`` each table gets ``filename`` and
    ``ingested_at`` columns. ``suffix=""`` with a bronze folder as ``dst_root`` puts the
    tables where the models read them. ``schemas`` ({base name: schema}) spares inference.
    A file without any record gives a table of the provenance columns alone (none without
    them). Returns {source file: written path}.
    """
    stamp = ingested_at or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    relative = {p: target_path(src_root, "", p, ".csv").lstrip("/") for p in list_files(spark, src_root)}
    skipped = tuple(p.rstrip("/") + "/" for p in exclude_prefixes)
    paths = [p for p, name in relative.items() if not name.startswith(skipped)]
    target = {p: target_path(src_root, dst_root, p, suffix) for p in paths}
    jvm = spark.sparkContext._jvm

    def land(group: _Group, schema, names: dict[str, str]) -> None:
        files = spark.createDataFrame([(f, i, relative[names[f]]) for i, f in enumerate(group.files)], "_dl_file string, _dl_n int, _dl_name string")
        rows = group.read(spark, names, schema).join(F.broadcast(files), "_dl_file").drop("_dl_file")
        if add_provenance:
            rows = rows.withColumn("filename", F.col("_dl_name")).withColumn("ingested_at", F.lit(stamp))
        rows = rows.drop("_dl_name")
        staged = f"{dst_root.rstrip('/')}/.landing-{uuid.uuid4().hex[:12]}"
        try:
            rows.write.partitionBy("_dl_n").parquet(staged)
            empty = spark.createDataFrame([], rows.drop("_dl_n").schema)
            for i, f in enumerate(group.files):
                part = jvm.org.apache.hadoop.fs.Path(f"{staged}/_dl_n={i}")
                fs = part.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

                def place(new: str) -> None:
                    if not fs.exists(part):  # a file without rows
                        empty.write.parquet(new)
                        return
                    to = jvm.org.apache.hadoop.fs.Path(new)
                    fs.mkdirs(to.getParent())
                    if not fs.rename(part, to):
                        raise OSError(f"cannot move the rows of {f}")

                replace_path(spark, target[names[f]], place)
        finally:
            delete_folders(spark, [staged])

    with scratch(spark):
        labelled = {p for p in paths if posixpath.basename(p) in label_row_files}
        groups, names = _survey(spark, paths, labelled)
        tasks = []
        for group in groups:
            by_schema: dict[str | None, list[str]] = {}
            for f in group.files:
                base = posixpath.basename(names[f])
                by_schema.setdefault(base if base in (schemas or {}) and names[f] not in labelled else None, []).append(f)
            for base, files in by_schema.items():
                part = _Group(group.labels, files, None if group.body is None else group.body.where(F.col("filename").isin(files)), group.text)
                tasks.append((part if len(by_schema) > 1 else group, (schemas or {}).get(base), names))
        if not add_provenance:
            tasks = [t for t in tasks if t[0].labels]
        with ThreadPoolExecutor(PARALLEL_GROUPS) as pool:
            list(pool.map(lambda t: land(*t), tasks))
    return {names[f]: target[names[f]] for group, _, names in tasks for f in group.files}


def register_tables(spark: SparkSession, database: str, paths: dict[str, str]) -> list[str]:
    """Catalog tables of ``database`` over written Parquet folders ({table: path})."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in paths.items():
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
    return sorted(paths)
