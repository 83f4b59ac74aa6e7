import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np
from oracle_compare import compare, duck

from demandlens.llm import topk_search as tk

SF = "/root/testdata/sf0.01"


def test_bounds_hold_and_top_is_exact():
    rng = np.random.default_rng(0)
    for n, d, lo, hi in ((200, 8, -5, 6), (30, 3, 0, 2), (5, 64, -40, 40), (50, 4, -(2**40), 2**40)):
        v, ids = rng.integers(lo, hi, (n, d)), rng.permutation(n).astype(np.int64)
        q, qid = v[:7], ids[:7]
        exact = q @ v.T
        if hi < 2**20:
            lists = tk.SortedLists(v.astype(np.float64))
            for share in (0.1, 0.5, 0.9, 1.0):
                lower, upper = lists.bounds(q.astype(np.float64), share)
                assert (lower <= exact).all() and (upper >= exact).all()
            for k in (1, 4, 20):
                a, b, c = tk.block_top(v, ids, q, qid, k)
                for i, x in enumerate(qid):
                    got = sorted(zip(-c[a == x], b[a == x]))[:k]
                    want = sorted((-s, j) for s, j in zip(exact[i], ids) if j != x)[:k]
                    assert [tuple(map(int, g)) for g in got] == [tuple(map(int, w)) for w in want]


def test_search_matches_sql(spark):
    r = compare("op5", tk.op5_nra_topk(spark, SF), duck(SF), tk.OP5_SQL)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r


def test_odd_rows_and_small_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)], 1) for i in range(70)]
    rows += [(71, None, 1), (72, [1.0, None, 0.0, 0.0], 1), (73, [float("nan")] * 4, 1), (74, [float("inf")] * 4, 1), (80, [], 1), (81, [], 1), (None, [1.0] * 4, 1), (100, [0.5, 0.5], 1), (101, [0.25, 1.0], 1), (5, rows[5][1], 1), (20, rows[20][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    v = tk.quantised(df)
    got = tk.top_k(v, v.where("vec_id % 20 = 0"), k=6, candidate_block=9, query_block=2).collect()
    fine = [(i, [int(np.floor(64 * x)) for x in e]) for i, e, _ in rows if i is not None and e is not None and not any(x is None or not np.isfinite(x) for x in e)]
    want = []
    for i, e in {(i, tuple(e)) for i, e in fine if i % 20 == 0}:
        best = sorted((-sum(a * b for a, b in zip(e, f)), j) for j, f in fine if j != i and len(f) == len(e))[:6]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert tk.top_k(v.limit(0), v.limit(0)).count() == 0
