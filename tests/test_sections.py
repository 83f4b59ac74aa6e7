"""Sectioned export parsing: rows written out by hand, files built from known rows, and
invariances (split sizes, trailing blanks)."""

import datetime as dt
import os
import random

from demandlens.sources.sections import parse_sections, read_lines, read_sections, sections_to_bronze

FIXTURE = "\n".join([
    "Category: All",
    "",
    "Region,Sunscreen: (8/18/24 - 8/18/25)",
    "Northland,<1",
    '"East, Upper",7',
    "Southland,",
    "Southland,55",
    "Southland,60",
    "Region,Serum (vit c): (1/1/24 - 2/1/24)",
    "Northland, 9",
    "Region,: (1/1/24 - 2/1/24)",
    "Northland,3",
])


D = dt.date


def built_files(seed: int, n_files: int, n_rows: int, stops=()) -> tuple[dict[str, str], set[tuple]]:
    """Files put together from known rows, and the rows that must come out: of each
    (keyword, region, dates) the first in file and line order."""
    rnd = random.Random(seed)
    files, first = {}, {}
    for f in range(n_files):
        name, lines, section = f"file{f:02d}.csv", [], None
        stopped = False
        for i in range(rnd.randint(0, n_rows)):
            kind = rnd.choices(["section", "undated", "row", "less", "bad", "blank", "note", "stop"], [3, 1, 14, 3, 2, 2, 1, 1 if f in stops else 0])[0]
            if kind == "section":
                begin, end = (D(2020 + rnd.randint(0, 9), rnd.randint(1, 9), rnd.randint(1, 9)) for _ in range(2))
                section = (f"kw{rnd.randint(1, 6)}", begin, end)
                lines.append(f"Region,Kw{section[0][2:]}: " + "({0.month}/{0.day}/{0:%y} - {1.month}/{1.day}/{1:%y})".format(begin, end))
            elif kind == "undated":
                section = (f"odd{i}", None, None)
                lines.append(f"Region, ODD{i} : (13/1/24 - 2/1/24)")
            elif kind in ("row", "less"):
                region, score = f"N{rnd.randint(1, 9)}", rnd.randint(0, 100)
                lines.append(f"{region},{score}" if kind == "row" else f" {region} , <1 ")
                if section and not stopped:
                    first.setdefault((section[0], region, *section[1:]), (score if kind == "row" else 1, name))
            else:
                lines.append({"bad": f"N{rnd.randint(1, 9)}, x", "blank": " ", "note": "Note without a score", "stop": "Region, : (1/1/24 - 2/1/24)"}[kind])
                stopped |= kind == "stop"
        # a leading blank would be taken off the first line; begin with a plain one
        files[name] = "\n".join(["Category: All categories", *lines])
    return files, {(k, region, score, b, e, name) for (k, region, b, e), (score, name) in first.items()}


def run_spark(spark, files: dict[str, str], block_lines: int | None = None, seed: int = 0):
    """Feed the files as a line table; each file cut into splits of random size."""
    rnd = random.Random(seed)
    rows = []
    for name, content in files.items():
        lines = content.split("\n")
        start, block = 0, 0
        while start < len(lines):
            size = block_lines or rnd.randint(1, 4)
            for i, line in enumerate(lines[start:start + size]):
                rows.append((name, block, start + i, line))
            start += size
            block += 1000
    df = spark.createDataFrame(rows, "filename string, block long, pos long, line string")
    out = sections_to_bronze(parse_sections(df, order=["pos"]), order=["pos"], retrieved_at="2025-01-01 00:00:00")
    return {(r.keyword, r.region, r.interest_score, r.begin_date, r.end_date, r.filename) for r in out.collect()}


def test_fixture_rows(spark):
    got = run_spark(spark, {"f1": FIXTURE}, block_lines=100)
    assert got == {
        ("sunscreen", "Northland", 1, dt.date(2024, 8, 18), dt.date(2025, 8, 18), "f1"),
        ("sunscreen", '"East, Upper"', 7, dt.date(2024, 8, 18), dt.date(2025, 8, 18), "f1"),
        ("sunscreen", "Southland", 55, dt.date(2024, 8, 18), dt.date(2025, 8, 18), "f1"),
        ("serum (vit c)", "Northland", 9, None, None, "f1"),
    }


EDGE_FILES = {
    "a.csv": "Region,Alpha: (1/1/68 - 1/1/69)\r\nX,5\r\nY,<1\r\n  Region,Beta: (1/1/24 - 2/1/24)\r\nZ,3\r\n",
    "b.csv": "   Region,Gamma: (13/45/24 - 1/1/25)\nX,4\nX,6\nRegion,Alpha: (1/1/68 - 1/1/69)\nX,9\n",
    "c.csv": "\n\n  Region,Delta: (2/30/24 - 3/1/24)\nQ,+4\nQ,1_000\nR,4.7\nRegion,Eps\n,8\n",
    "d.csv": "junk\nRegion, : (1/1/24 - 2/1/24)\nX,1\n",
    "e.csv": "Region,Zeta: (1/1/24 - 2/1/24)\nA,1\nRegion,Eta: no dates - here\nA,2\nRegion,Theta (1/1/24 - 2/1/24)\nA,3\n",
    "f.csv": "",
    "g.csv": "Region,Iota: (1/1/24 - 2/1/24),5\nB,2\nRegion,Kappa: (1/1/24 - 2/1/24 - 3/1/24)\nB,3\n",
}


# What each file above must give, written out by hand.
EDGE_ROWS = {
    # two-digit years turn over at 69; a header with blanks before it is no header but a row
    # ("  Region,Beta: ..." has no number after its last comma), so Z still belongs to alpha
    ("alpha", "X", 5, D(2068, 1, 1), D(1969, 1, 1), "a.csv"),
    ("alpha", "Y", 1, D(2068, 1, 1), D(1969, 1, 1), "a.csv"),
    ("alpha", "Z", 3, D(2068, 1, 1), D(1969, 1, 1), "a.csv"),
    # blanks at the very start of a file do not count: gamma is a header; month 13 gives no
    # dates; the second X of gamma is a repeat, and so is alpha's X, which a.csv holds
    ("gamma", "X", 4, None, None, "b.csv"),
    # leading empty lines do not count; February 30 gives no dates; +4 is a number, 1_000 and
    # 4.7 are none; "Region,Eps" without brackets is a row without a number; an empty region
    # is a region
    ("delta", "Q", 4, None, None, "c.csv"),
    ("delta", "", 8, None, None, "c.csv"),
    # d.csv: a header without a keyword ends the file; f.csv is empty
    # e.csv: eta has no brackets, so its line is a row without a number and A a repeat; theta
    # has no colon, which ends the file
    ("zeta", "A", 1, D(2024, 1, 1), D(2024, 2, 1), "e.csv"),
    # a header may be a row as well; three dates are none
    ("iota", "Region,Iota: (1/1/24 - 2/1/24)", 5, D(2024, 1, 1), D(2024, 2, 1), "g.csv"),
    ("iota", "B", 2, D(2024, 1, 1), D(2024, 2, 1), "g.csv"),
    ("kappa", "B", 3, None, None, "g.csv"),
}


def test_edge_files_across_splits(spark):
    for seed in range(4):
        assert run_spark(spark, EDGE_FILES, seed=seed) == EDGE_ROWS
    assert run_spark(spark, EDGE_FILES, block_lines=1) == EDGE_ROWS


def test_trailing_blanks_change_nothing(spark):
    padded = {name: text + "\n \n\t\r\n" for name, text in EDGE_FILES.items()}
    assert run_spark(spark, padded, block_lines=2) == EDGE_ROWS


def test_built_files_give_their_rows(spark):
    files, expected = built_files(11, 12, 40, stops=(3, 5, 8))
    assert len(expected) > 60
    for seed in range(3):
        assert run_spark(spark, files, seed=seed) == expected


def test_read_sections_from_files(spark, tmp_dir):
    for name, content in EDGE_FILES.items():
        with open(os.path.join(tmp_dir, name), "w", newline="") as fh:
            fh.write(content)
    out = read_sections(spark, tmp_dir, retrieved_at="2025-01-01 00:00:00", filename_prefix=f"file:{tmp_dir}/")
    got = {(r.keyword, r.region, r.interest_score, r.begin_date, r.end_date, r.filename) for r in out.collect()}
    assert got == EDGE_ROWS
    assert out.columns == ["keyword", "region", "interest_score", "begin_date", "end_date", "filename", "retrieved_at"]


def test_read_sections_with_files_cut_into_many_splits(spark, tmp_dir):
    files, expected = built_files(21, 3, 900, stops=(2,))
    for name, content in files.items():
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(content)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        lines = read_lines(spark, tmp_dir)
        assert lines.select("filename", "block").distinct().count() > 10  # files really are split
        out = read_sections(spark, tmp_dir, retrieved_at="2025-01-01 00:00:00", filename_prefix=f"file:{tmp_dir}/")
        got = {(r.keyword, r.region, r.interest_score, r.begin_date, r.end_date, r.filename) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == expected
