"""CSV landing: records cut split by split, files grouped by header."""

import csv
import io
import os
import random
from contextlib import contextmanager

import pytest

from demandlens.sources.csv_landing import cut_records, land_csv, read_csv, read_csv_label_row
from demandlens.sources.sections import read_lines


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        fh.write(text)


@contextmanager
def split_bytes(spark, n):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _random_csv(rng, rows, end):
    """A file of three text fields: quoted ones with commas, quotes and line breaks, plain ones
    with quotes inside (those are text)."""
    def field(i):
        kind = rng.random()
        if kind < 0.3:
            return "".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) + str(i)
        if kind < 0.5:
            return 'x"' + rng.choice(["y", "", '"', 'y"z'])
        inner = "".join(rng.choice(["a", ",", '""', end, " ", "b", 'c""', ""]) for _ in range(rng.randint(0, 14)))
        return f'"q{inner}"'
    lines = ["u,v,w"] + [",".join([f"r{i}", field(i), field(i)]) for i in range(rows)]
    return end.join(lines) + (end if rng.random() < 0.7 else "")


@pytest.mark.parametrize("seed,size", [(1, 7), (2, 23), (3, 61), (4, 400), (5, 1 << 20)])
def test_records_on_random_splits(spark, tmp_dir, seed, size):
    rng = random.Random(seed)
    want = []
    for k in range(3):
        text = _random_csv(rng, 60, rng.choice(["\n", "\r\n"]))
        _write(f"{tmp_dir}/in/f{k}.csv", text)
        want += [tuple(r) for r in list(csv.reader(io.StringIO(text, newline="")))[1:]]
    with split_bytes(spark, size):
        got = []
        for k in range(3):
            df = read_csv(spark, f"{tmp_dir}/in/f{k}.csv", infer_schema=False)
            assert df.columns == ["u", "v", "w"]
            got += [tuple(r) for r in df.collect()]
    assert sorted(got) == sorted(want)


def test_cut_records_state_over_many_splits(spark, tmp_dir):
    # one field over hundreds of splits, a doubled quote on a split's edge, a quote in a plain field
    long = "\n".join(f'line {i} ""x"",' for i in range(300))
    _write(f"{tmp_dir}/a.csv", f'k,v\n1,"{long}"\n2,in"ch\n3,"end"\n\n4,"never closed,\nto the end\n')
    with split_bytes(spark, 11):
        rows = cut_records(read_lines(spark, f"{tmp_dir}/a.csv", recursive=False)).orderBy("block", "pos").collect()
    assert [r.record for r in rows] == ["k,v", f'1,"{long}"', '2,in"ch', '3,"end"', '4,"never closed,\nto the end']


def test_heads_of_any_length(spark, tmp_dir):
    wide = "\n".join(f"note {i}" for i in range(500))
    _write(f"{tmp_dir}/census.csv", f'"{wide}"\n"Name\n{wide}",Total\nx,1\n')
    with split_bytes(spark, 900):
        df = read_csv_label_row(spark, f"{tmp_dir}/census.csv")
        assert df.columns == [f"Name\n{wide}", "Total"] and [tuple(r) for r in df.collect()] == [("x", "1")]
        df = read_csv(spark, f"{tmp_dir}/census.csv")
    assert df.columns == [wide]


def test_inference_behind_line_breaks(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", 'n,d,t,s\n1,1.5,2024-01-02,"a\nb"\n2,,2024-01-03\n')
    df = read_csv(spark, f"{tmp_dir}/a.csv")
    assert [t for _, t in df.dtypes] == ["int", "double", "date", "string"]
    assert sorted((r.n, r.d, r.s) for r in df.collect()) == [(1, 1.5, "a\nb"), (2, None, None)]


def test_many_files_land_by_header(spark, tmp_dir):
    for i in range(120):
        if i % 3 == 0:
            _write(f"{tmp_dir}/in/d{i % 7}/a {i}.csv", f"id,name\n{i},n{i}\n{i + 1},m\n")
        elif i % 3 == 1:
            _write(f"{tmp_dir}/in/b%{i}.csv", f"id,score\n{i},0.5\n")
        else:
            _write(f"{tmp_dir}/in/c{i}.csv", f'id,text\n{i},"two\nlines {i}"\n')
    _write(f"{tmp_dir}/in/only_header.csv", "id,name\n")
    _write(f"{tmp_dir}/in/empty.csv", "")
    scheduler = spark._jsparkSession.sparkContext().dagScheduler()
    before = scheduler.numTotalJobs()
    out = land_csv(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", ingested_at="2025-01-01 00:00:00")
    assert scheduler.numTotalJobs() - before <= 60  # not with the number of files
    assert len(out) == 122
    a = spark.read.parquet(f"{tmp_dir}/out/d0/a 0.parquet")
    assert a.dtypes == [("id", "int"), ("name", "string"), ("filename", "string"), ("ingested_at", "string")]
    assert sorted(map(tuple, a.collect())) == [(0, "n0", "d0/a 0.csv", "2025-01-01 00:00:00"), (1, "m", "d0/a 0.csv", "2025-01-01 00:00:00")]
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{tmp_dir}/out/c119.parquet").collect()] == [(119, "two\nlines 119")]
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{tmp_dir}/out/b%118.parquet").collect()] == [(118, 0.5)]
    header = spark.read.parquet(f"{tmp_dir}/out/only_header.parquet")
    assert header.columns[:2] == ["id", "name"] and header.count() == 0
    empty = spark.read.parquet(f"{tmp_dir}/out/empty.parquet")
    assert empty.columns == ["filename", "ingested_at"] and empty.count() == 0
    assert not [f for f in os.listdir(f"{tmp_dir}/out") if f.startswith(".landing")]
    # landed anew, the tables are replaced
    _write(f"{tmp_dir}/in/only_header.csv", "id,name\n7,x\n")
    land_csv(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    assert spark.read.parquet(f"{tmp_dir}/out/only_header.parquet").count() == 1
