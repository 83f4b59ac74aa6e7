import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np
from oracle_compare import compare, duck

from demandlens.llm import line_dedup as ld

SF = "/root/testdata/sf0.01"


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    f = ld.CuckooFilter(4000)  # too small on purpose: some keys overflow
    f.insert_all(keys)
    assert f.contains(keys).all()
    f = ld.CuckooFilter.loads(f.dumps())
    assert all(f.delete(int(k)) for k in keys[:3000]) and f.contains(keys[3000:]).all()
    assert f.contains(rng.integers(0, 2**64, 5000, dtype=np.uint64)).mean() < 0.01
    one = ld.CuckooFilter(0)
    for k in keys[:300]:
        one.insert(int(k))
    assert one.contains(keys[:300]).all() and not ld.CuckooFilter(1).contains(keys).any()


def test_lines_match_sql(spark):
    r = compare("op7", ld.op7_line_dedup(spark, SF), duck(SF), ld.OP7_SQL)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r


LINE = "A shared line of text"
ROWS = [
    (3, f"{LINE}\nown words here\n\t{LINE.upper()} "), (1, f"x\n {LINE}"), (2, "short\nshort"), (4, "short\n" + "é" * 9), (5, "é" * 9 + "\n" + "é" * 10),
    (6, "é" * 10), (None, LINE), (None, None), (7, ""), (8, "twice in one\ntwice in one"), (8, "twice in one"), (9, "y " * 40000 + "\n" + LINE),
]


def brute(rows):
    """{(id, text): kept text} by the rule."""
    norm = lambda s: "".join(c.lower() if c < "\x80" else c for c in s.strip(" \t\n\r\x0b\x0c"))
    rank = lambda i: ld.order_id and (i is None, i or 0)
    first, holders = {}, {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = norm(line)
            holders.setdefault(k, set()).add(rank(i))
    for k, h in holders.items():
        if len(h) > 1 and len(k) >= 10:
            first[k] = min(h)
    return sorted((str(i), len((t or "").split("\n")), "\n".join(x for x in (t or "").split("\n") if first.get(norm(x), rank(i)) == rank(i))) for i, t in rows)


def result(df):
    return sorted((str(r.doc_id), r.n_lines, bytes(r.kept).decode()) for r in df.collect())


def test_odd_rows_and_both_ways_to_the_counts(spark):
    df = spark.createDataFrame([(*r, "k") for r in ROWS], "doc_id long, text string, keys string")
    index = ld.LineIndex.build(df)
    assert result(index.dedupe(df)) == brute(ROWS)
    assert result(index.dedupe(df, max_filter_bytes=0)) == brute(ROWS)
    kept = ld.drop_shared_lines(df)
    assert kept.columns == df.columns and sorted(r.text for r in kept.collect() if r.text is not None) == sorted(t for (i, n, t), r in zip(brute(ROWS), sorted(ROWS, key=lambda r: (str(r[0]), len((r[1] or "").split("\n"))))) if r[1] is not None)
    assert ld.LineIndex.build(df.limit(0)).dedupe(df.limit(0)).count() == 0


def test_insert_and_delete_equal_a_fresh_build(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    first = df.where("doc_id in (3, 2, 5, 8)")
    index = ld.LineIndex.build(first).insert(df.where("doc_id is null or doc_id not in (3, 2, 5, 8)"))
    assert result(index.dedupe(df)) == brute(ROWS)
    fewer = [r for r in ROWS if r[0] not in (1, 6)]
    index = index.delete(df.where("doc_id in (1, 6)"))
    assert result(index.dedupe(spark.createDataFrame(fewer, df.schema))) == brute(fewer)
    again = index.insert(df.where("doc_id in (1, 6)"))
    assert result(again.dedupe(df)) == brute(ROWS)
    assert {tuple(r) for r in again.counts.collect()} == {tuple(r) for r in ld.LineIndex.build(df).counts.collect()}


def test_rows_without_id_lose_their_own_lines_only(spark):
    # a third of the rows has no id: each has lines of its own and lines of earlier documents
    rows = [(i if i % 3 else None, f"own line number {i}\nshared by many {i % 7}\nshared with one {i // 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = ld.LineIndex.build(df)
    assert result(index.dedupe(df)) == brute(rows)
    gone = index.removals(df)
    assert gone.count() > 200 and max(len(r.gone) for r in gone.collect()) <= 3


def test_insert_raises_the_number_of_shards(spark, monkeypatch):
    monkeypatch.setattr(ld, "KEYS_PER_SHARD", 10)
    rows = [(i, f"shared line {i // 2}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = ld.LineIndex.build(df.where("doc_id < 4"))
    grown = index.insert(df.where("doc_id >= 4"))
    assert (index.n_shards, grown.n_shards) == (1, 10)
    assert result(grown.dedupe(df)) == brute(rows)
