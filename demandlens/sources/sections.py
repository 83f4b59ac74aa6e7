"""Sectioned regional-interest exports: text files with "Region,<keyword>: (dates)" headers.

Rules (applied per file, in line order):

1. The file is stripped as a whole, then split on "\\n" (CR stays on the line).
2. A line is a section header when, unstripped, it starts with "Region" and holds
   "(", ")" and " - ".
3. Header keyword: characters after the first seven, up to the first ":",
   stripped and lower-cased; dates: the first parenthesised group, "m/d/yy - m/d/yy";
   any date problem makes both dates NULL and keeps the keyword.
4. A header without a keyword stops the file; rows read before it are kept.
5. Every line (headers too) is stripped; blank lines are skipped; the rest is
   split at the last comma into region and score.
6. Score "<1" is 1, otherwise an integer; anything else skips the line.
7. Lines before the first header are dropped; a later header re-keys what follows.
8. Rows are de-duplicated on (keyword, region, begin_date, end_date), first file
   (path order) and first line winning.

Of rule 1 only the left strip of the file's first non-blank line can change a
result (it can turn that line into a header). The right strip of the last line
cannot: it only matters when the line ends in " - " plus blanks, and such a
line is the last one and never parses as a score.

Scale: a file is never read into one row or one task. Lines are read split by split
("block"), once:

* a window over (file, split) carries the state line by line inside the split. Rows
  before a split's first header go out as pending, and the split's last line carries its
  summary (last header, stop flag, whether it holds text, the header reading of its first
  non-blank line). Both are written, narrow, as one table;
* a window over the summaries (one row a split) carries the state of all earlier splits. It is
  joined to the written rows (broadcast while it is small) and settles them.

A single huge file therefore spreads over as many tasks as it has splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlens.functions.text import (
    FIRST_PARENTHESES,
    RANGE_SEPARATOR,
    header_keyword,
    is_section_header,
    lstrip_ws,
    parse_mdy,
    parse_score,
    split_last,
    strip_ws,
)
from demandlens.functions.util import as_list
from demandlens.operators.joins import bounded_broadcast
from demandlens.operators.keys import dedupe_first
from demandlens.session import materialize

OUTPUT_COLUMNS = ["keyword", "region", "interest_score", "begin_date", "end_date", "filename", "retrieved_at"]
DEDUP_KEYS = ["keyword", "region", "begin_date", "end_date"]


def read_lines(spark: SparkSession, paths, recursive: bool = True, path_glob: str | None = None) -> DataFrame:
    """Lines of text files as (filename, block, pos, line).

    ``block`` is the byte offset of the file split the line was read from and
    ``pos`` increases with the line order inside a split, so (block, pos) is the
    line order within a file. Lines end at "\\n" only, so a CR stays on its line.
    """
    reader = spark.read.option("lineSep", "\n")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.text(as_list(paths))
    return df.select(
        F.col("_metadata.file_path").alias("filename"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def with_header(df: DataFrame, line_col: str) -> DataFrame:
    """Add the header reading of the left-stripped line, in stages.

    Columns added: _dl_nb (non-blank), _dl_lead (line has leading blanks),
    _dl_hdr (struct(keyword, begin_date, end_date) or NULL), _dl_stop (a header
    without keyword). Each stage reads plain columns, so the generated code stays
    small even though the date rule references its parts several times.
    """
    line = F.col(line_col)
    df = df.select("*", lstrip_ws(line).alias("_dl_raw"), (strip_ws(line) != "").alias("_dl_nb"))
    raw = F.col("_dl_raw")
    df = df.select("*", (raw != line).alias("_dl_lead"), is_section_header(raw).alias("_dl_is_h"))
    # Everything below only runs for header lines.
    is_h = F.col("_dl_is_h")
    df = df.select(
        "*",
        F.when(is_h, header_keyword(raw)).alias("_dl_kw"),
        F.when(is_h, F.nullif(F.regexp_extract(raw, FIRST_PARENTHESES, 1), F.lit(""))).alias("_dl_rng"),
    )
    df = df.select("*", F.split(F.col("_dl_rng"), RANGE_SEPARATOR, -1).alias("_dl_parts"))
    parts = F.col("_dl_parts")
    df = df.select(
        "*",
        (F.col("_dl_rng").isNotNull() & (F.size(parts) == 2)).alias("_dl_shape"),
        strip_ws(F.get(parts, 0)).alias("_dl_btxt"),
        strip_ws(F.get(parts, 1)).alias("_dl_etxt"),
    )
    df = df.select(
        "*",
        F.when(F.col("_dl_shape"), parse_mdy(F.col("_dl_btxt"))).alias("_dl_b"),
        F.when(F.col("_dl_shape"), parse_mdy(F.col("_dl_etxt"))).alias("_dl_e"),
    )
    ok = F.col("_dl_shape") & F.col("_dl_b").isNotNull() & F.col("_dl_e").isNotNull()
    kw = F.col("_dl_kw")
    df = df.select(
        "*",
        F.when(is_h & kw.isNotNull(), F.struct(
            kw.alias("keyword"),
            F.when(ok, F.col("_dl_b")).alias("begin_date"),
            F.when(ok, F.col("_dl_e")).alias("end_date"),
        )).alias("_dl_hdr"),
        (is_h & kw.isNull()).alias("_dl_stop"),
    )
    return df.drop("_dl_raw", "_dl_is_h", "_dl_kw", "_dl_rng", "_dl_parts", "_dl_shape", "_dl_btxt", "_dl_etxt",
                   "_dl_b", "_dl_e")


def parse_sections(
    lines: DataFrame,
    order=("pos",),
    file_col: str = "filename",
    block_col: str = "block",
    line_col: str = "line",
) -> DataFrame:
    """Apply rules 1-7 to a line table; returns rows with their (file, block, order) position.

    ``lines`` holds one row per line with the file name, the split (``block_col``)
    and ``order`` columns that sort lines inside a split. Output columns: keyword,
    region, interest_score, begin_date, end_date, filename, the block and the
    order columns (for the first-wins de-duplication).
    """
    order = as_list(order)
    fb = [file_col, block_col]
    # Parse every line once. A line with leading blanks is never a header as
    # read; only as the file's first non-blank line (left-stripped) can it be one,
    # so one reading of the left-stripped line serves both cases.
    lines = with_header(lines, line_col)
    in_split = Window.partitionBy(*fb).orderBy(*order)
    upto_here = in_split.rowsBetween(Window.unboundedPreceding, 0)
    nonblank = F.col("_dl_nb").cast("int")
    state = lines.select(
        *fb,
        *order,
        line_col,
        "_dl_nb",
        "_dl_hdr",
        "_dl_stop",
        F.last(F.when(~F.col("_dl_lead"), F.col("_dl_hdr")), ignorenulls=True).over(upto_here).alias("_dl_hdr_in"),
        F.max((~F.col("_dl_lead") & F.col("_dl_stop")).cast("int")).over(upto_here).alias("_dl_stop_in"),
        F.sum(nonblank).over(upto_here).alias("_dl_n_text"),
        F.lead(F.lit(1)).over(in_split).isNull().alias("_dl_end"),
    )
    # The first non-blank line of the split, read as the first one of its file.
    leads = F.col("_dl_nb") & (F.col("_dl_n_text") == 1)
    state = state.select(
        "*",
        F.last(F.when(leads, F.col("_dl_hdr")), ignorenulls=True).over(upto_here).alias("_dl_alt_hdr"),
        F.coalesce(F.max(F.when(leads, F.col("_dl_stop").cast("int"))).over(upto_here), F.lit(0)).alias("_dl_alt_stop"),
    )

    # Rules 5-7, as far as they need no other split.
    text = strip_ws(F.col(line_col))
    parts = split_last(text, ",")
    score = parse_score(strip_ws(parts["tail"]))
    has_row = (F.col("_dl_stop_in") == 0) & (text != "") & parts.isNotNull()
    read = state.select(
        *fb,
        *order,
        "_dl_hdr_in",
        "_dl_stop_in",
        "_dl_alt_hdr",
        "_dl_alt_stop",
        (F.col("_dl_n_text") > 0).alias("_dl_has_text"),
        "_dl_end",
        F.when(has_row, strip_ws(parts["head"])).alias("region"),
        F.when(has_row, score).alias("interest_score"),
    )
    read = materialize(read.where(F.col("_dl_end") | F.col("interest_score").isNotNull()), "section_rows")

    # One row a split: the state of the splits before it.
    splits = read.where("_dl_end")
    first_text = F.min(F.when(F.col("_dl_has_text"), F.col(block_col))).over(Window.partitionBy(file_col))
    splits = splits.select("*", F.coalesce(F.col(block_col) == first_text, F.lit(False)).alias("_dl_first"))
    # A raw header always follows the first non-blank line, so it wins when present.
    header = F.coalesce(F.col("_dl_hdr_in"), F.when(F.col("_dl_first"), F.col("_dl_alt_hdr")))
    stop = F.greatest("_dl_stop_in", F.when(F.col("_dl_first"), F.col("_dl_alt_stop")).otherwise(0))
    earlier = Window.partitionBy(file_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    carry = splits.select(
        *[F.col(c).alias(f"_dl_of_{i}") for i, c in enumerate(fb)],
        "_dl_first",
        F.last(header, ignorenulls=True).over(earlier).alias("_dl_hdr_carry"),
        F.coalesce(F.max(stop).over(earlier), F.lit(0)).alias("_dl_stop_carry"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_dl_of_{i}")) for i, c in enumerate(fb)]
    rows = read.where(F.col("interest_score").isNotNull()).join(bounded_broadcast(carry), same)
    current = F.coalesce("_dl_hdr_in", F.when(F.col("_dl_first"), F.col("_dl_alt_hdr")), "_dl_hdr_carry")
    stopped = (F.col("_dl_stop_carry") == 1) | (F.col("_dl_first") & (F.col("_dl_alt_stop") == 1))
    return rows.select("*", current.alias("_dl_current")).where(~stopped & F.col("_dl_current").isNotNull()).select(
        "_dl_current.keyword",
        "region",
        "interest_score",
        "_dl_current.begin_date",
        "_dl_current.end_date",
        F.col(file_col).alias("filename"),
        *[F.col(c) for c in fb if c != file_col],
        *[F.col(c) for c in order],
    )


def sections_to_bronze(
    rows: DataFrame,
    order=("pos",),
    block_col: str = "block",
    retrieved_at=None,
    filename_prefix: str | None = None,
) -> DataFrame:
    """Rule 8 plus the bronze columns: first row per key wins, stamped with ``retrieved_at``.

    ``retrieved_at`` is one UTC stamp for the whole run ("YYYY-MM-DD HH:MM:SS"
    text; default: now). ``filename_prefix`` is removed from the file names.
    """
    order = as_list(order)
    ordered = dedupe_first(rows, DEDUP_KEYS, ["filename", block_col, *order])
    fname = F.col("filename")
    if filename_prefix:
        fname = F.when(fname.startswith(filename_prefix),
                       fname.substr(F.lit(len(filename_prefix) + 1), F.length(fname))).otherwise(fname)
    stamp = F.lit(retrieved_at) if retrieved_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return ordered.select(
        "keyword", "region", "interest_score", "begin_date", "end_date",
        fname.alias("filename"), stamp.cast("string").alias("retrieved_at"),
    )


def read_sections(
    spark: SparkSession,
    paths,
    retrieved_at=None,
    filename_prefix: str | None = None,
    recursive: bool = True,
    path_glob: str | None = None,
) -> DataFrame:
    """Read sectioned export files into the bronze interest table (7 columns)."""
    lines = read_lines(spark, paths, recursive=recursive, path_glob=path_glob)
    rows = parse_sections(lines, order=["pos"])
    return sections_to_bronze(rows, order=["pos"], retrieved_at=retrieved_at, filename_prefix=filename_prefix)
