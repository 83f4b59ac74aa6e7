import os
import sys
import tracemalloc

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np
import pyarrow as pa
import pytest
from oracle_compare import compare, duck

from demandlens.llm import ngram_join as nj, text

SF = "/root/testdata/sf0.01"


def similar(a, b, percent):
    o = len(np.intersect1d(a, b))
    return 100 * o >= percent * (len(a) + len(b) - o)


def family(rng, size, copies, most):
    """Sets that differ from a common one in a few elements each."""
    base = rng.integers(0, 2**64, size, dtype=np.uint64)
    out = [np.unique(base)]
    for _ in range(copies):
        k = int(rng.integers(0, most + 1))
        keep = rng.permutation(size)[int(rng.integers(0, k + 1)) :]
        out.append(np.unique(np.concatenate([base[keep], rng.integers(0, 2**64, k, dtype=np.uint64)])))
    return [s for s in out if len(s)]


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_linked_sets_send_a_common_hash(percent):
    rng = np.random.default_rng(percent)
    pairs = 0
    for size in [1, 2, 3, 5, 6, 7, 8, 9, 12, 13, 20, 40, 90, 200, 600]:
        for _ in range(30):
            sets = family(rng, size, 4, max(1, size // 6))
            routes = [set(nj.route_hashes(s, nj.Bands(percent)).tolist()) for s in sets]
            for i in range(len(sets)):
                for j in range(i):
                    if similar(sets[i], sets[j], percent):
                        pairs += 1
                        assert routes[i] & routes[j], (size, len(sets[i]), len(sets[j]))
    assert pairs > 500


def test_tree_links_give_the_components_of_all_pairs():
    rng = np.random.default_rng(5)
    for percent in (50, 80, 85):
        for _ in range(25):
            sets = [s for size in (1, 3, 9, 30, 31) for s in family(rng, size, 6, max(1, size // 4))]
            sets += [sets[0], sets[3]]
            comp = list(range(len(sets)))
            for _ in sets:
                for i in range(len(sets)):
                    for j in range(len(sets)):
                        if similar(sets[i], sets[j], percent):
                            comp[i] = comp[j] = min(comp[i], comp[j])
            links = nj.tree_links(sets, percent)
            assert all(similar(sets[i], sets[j], percent) for i, j in links)
            assert len(links) == len(sets) - len(set(comp))
            labels = [c if i % 2 else 1000 + i for i, c in enumerate(comp)]
            assert len(nj.tree_links(sets, percent, labels)) + len(sets) - len(set(labels)) == len(sets) - len(set(comp))


def test_outlines_lose_no_link():
    rng = np.random.default_rng(9)
    dropped = 0
    for percent in (70, 80, 85):
        for _ in range(25):
            sets = [s for size in (1, 5, 40, 63, 64, 65, 130, 500, 520) for s in family(rng, size, 5, max(1, size // 3))]
            labels = rng.integers(0, len(sets) // 2, len(sets))
            keep = nj.may_link(np.array([len(s) for s in sets]), [nj.outline(s) for s in sets], labels, percent)
            dropped += (~keep).sum()
            for i, a in enumerate(sets):
                for j, b in enumerate(sets):
                    if labels[i] != labels[j] and similar(a, b, percent):
                        assert keep[i] and keep[j]
    assert dropped > 1000


def test_rows_without_an_id_meet_their_own_sets_only(spark):
    texts = [" ".join(f"{k % 9}a{k}x{i}" if i % 7 else f"s{i}" for i in range(40)) for k in range(300)]
    df = spark.createDataFrame([(None, t) for t in texts] * 2, "doc_id long, text string")
    chosen = nj._classes(df, 4).groupBy("class").agg(nj.F.min(nj.F.struct("doc", "digest")).alias("f")).select("class", "f.doc", "f.digest")
    joined = nj._ided(df).join(chosen, ["doc", "digest"])
    assert joined.count() == 600 and nj._sets(df, chosen, 4).count() == 300


def test_components_match_sql(spark):
    r = compare("op8", nj.op8_ngram_join(spark, SF), duck(SF), nj.OP8_SQL)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r


def brute(rows, words, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    comp = [nj.order_id and (2**63 - 1 if i is None else i) for i, _ in rows]
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    return sorted((str(i), len(s), str(None if c == 2**63 - 1 else c)) for (i, _), s, c in zip(rows, sets, comp))


def test_odd_rows_and_split_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "CHUNK_SETS", 4)
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in range(60)]
    rows = [(100, None), (101, ""), (102, " \n"), (103, "one two"), (104, "One TWO"), (105, "one two three"), (None, "one two"), (106, "É x"), (107, "é x"), (50, "rep rep rep rep rep rep"), (51, "rep rep rep rep"), (7, "y " * 20000 + "z")]
    for k in range(40):  # a chain of growing differences: near ones link, far ones do not
        text = base[:]
        for p in range(k // 4):
            text[p * 5] = f"v{p}"
        text[int(rng.integers(50, 60))] = f"u{k % 7}"
        rows.append((200 - k, " ".join(text)))
    rows += [rows[-1], (200 - 39, rows[-1][1] + " tail")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class int")
    for words, percent in ((4, 85), (5, 80), (2, 70)):
        got = nj.components(df, words, percent).select(nj.original_id("doc"), "n", nj.original_id("component_doc")).collect()
        assert sorted((str(a), n, str(c)) for a, n, c in got) == brute(rows, words, percent)
    kept = nj.keep_one(df, 4, 85)
    want = {(i, c) for i, n, c in brute(rows, 4, 85) if i == c}
    assert kept.columns == df.columns and {str(r.doc_id) for r in kept.collect()} == {i for i, _ in want}
    assert nj.components(df.limit(0)).count() == 0 and nj.keep_one(df.limit(0)).count() == 0


def test_rows_that_share_an_id_or_have_none_stay_unless_linked(spark):
    text = lambda k: " ".join(f"t{k}x{i}" for i in range(30))
    rows = [(None, text(k)) for k in range(6)]  # six texts without an id
    rows += [(None, text(0)), (None, text(1) + " tail"), (None, text(7)), (3, text(7))]  # copies of those and of a real id
    rows += [(4, text(8)), (4, text(9)), (4, text(9)), (5, text(9)), (6, text(8) + " tail")]  # two texts under one id
    rows += [(None, ""), (None, None), (4, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in nj.keep_one(df, 4, 85).collect()]
    assert len(kept) == len(set(kept)) == 6 + 1 + 2 + 3
    texts = {t: i for i, t in kept if t and t.strip()}
    assert {k for k in range(10) if text(k) in texts or text(k) + " tail" in texts} == set(range(10)) - {6}
    assert texts[text(7)] == 3 and texts[text(8)] == texts[text(9)] == 4


def test_only_texts_that_may_link_travel(spark, monkeypatch):
    rng = np.random.default_rng(4)
    common = [f"c{i}" for i in range(60)]  # a passage, so that unlike documents meet in segments
    rows = [(k, " ".join(common + [f"w{k}x{i}" for i in range(int(rng.integers(50, 70)))])) for k in range(400)]
    rows += [(1000 + k, rows[k][1] + " tail") for k in range(0, 400, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    asked, sets = [], nj._sets

    def counted(documents, chosen, words):
        asked.append({r["class"] for r in chosen.select("class").collect()})
        return sets(documents, chosen, words)

    met = nj._routes(df, 4, 85).groupBy("route").agg(nj.F.collect_set("class").alias("c")).where("size(c) > 1")
    assert met.select(nj.F.explode("c")).distinct().count() > 300
    monkeypatch.setattr(nj, "_sets", counted)
    got = {r.doc_id: r.component_id for r in nj.components(df, 4, 85).select(nj.original_id("doc").alias("doc_id"), nj.original_id("component_doc").alias("component_id")).collect()}
    assert got == {i: i - 1000 if i >= 1000 else i for i, _ in rows}
    assert all(len(c) <= 60 for c in asked) and len(set().union(*asked)) >= 20


def test_the_filter_of_wanted_texts_loses_none(spark, monkeypatch):
    keys = spark.range(20_000).selectExpr("nullif(id % 7000, -1) AS doc", "xxhash64(id) AS digest")
    others = spark.range(20_000, 60_000).selectExpr("id AS doc", "xxhash64(id) AS digest")
    passed = lambda: (keys.where(nj._key_filter(keys)).count(), others.where(nj._key_filter(keys)).count())
    held, more = passed()
    assert held == 20_000 and more < 2_000
    monkeypatch.setattr(nj, "PAGE_BITS", 10)
    assert passed()[0] == 20_000
    monkeypatch.setattr(nj, "MAX_FILTER_BITS", 12)  # full: nearly all pass, none is lost
    assert passed()[0] == 20_000


def test_workers_hold_one_slice_of_texts(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = [None if k % 50 == 0 else " ".join(f"{x:x}" for x in rng.integers(0, 2**40, 8 * (k % 40))) + "é" for k in range(6000)]
    texts[7] = "long " * 100_000
    batch = pa.RecordBatch.from_arrays([pa.array(range(6000)), pa.array(texts)], names=["doc", "text"])
    parts = [(p.column("doc").to_pylist(), t) for p, t in text.text_blocks(batch, nj.SET_BYTES)]
    assert [d for docs, _ in parts for d in docs] == list(range(6000))
    assert [t for _, of in parts for t in of] == text.as_bytes(texts)
    assert all(len(of) == 1 or sum(map(len, of)) <= nj.SET_BYTES for _, of in parts) and len(parts) < 100
    assert not list(text.text_blocks(batch.slice(0, 0)))
    monkeypatch.setattr(text, "_POWERS", {})
    small = batch.slice(8)  # without the long one
    tracemalloc.start()
    for _, of in text.text_blocks(small, nj.SET_BYTES):
        nj.ngram_sets(of, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert small.nbytes > 8 << 20 and peak < 32 << 20

    key, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", [], nj.materialize
    monkeypatch.setattr(nj, "materialize", lambda df, name: seen.append((name, spark.conf.get(key, None))) or write(df, name))
    before = spark.conf.get(key, None)
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert nj.keep_one(df).count() == 1 and spark.conf.get(key, None) == before
    assert {c for n, c in seen if n in ("join_classes", "join_members", "join_near", "join_links")} == {nj.BATCHES[key]}
