import re

import pytest
from pyspark.sql import functions as F

from demandlens.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h " * 5, "x\ny\nx\n\n\n x\nx", "é ñ 漢字 \U0001f600 | ## <b>", "\x1c\x1d a\xa0b c",
    " ".join(f"w{i}" for i in range(30)), " ".join(f"w{i % 13}" for i in range(40)), "long " * 3000, " ".join(f"v{i}" for i in range(9)) + "\n" + " ".join(f"v{i}" for i in range(9)),
]


def test_base_counts_match_brute_force():
    got = q.base_counts([b"" if t is None else t.encode() for t in TEXTS])
    for i, t in enumerate(TEXTS):
        assert tuple(int(got[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counts(t), t


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_verdict_follows_held_out_labels(tables):
    documents, labels = tables
    train, test = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    got = q.quality_rules(documents, q.fit(documents, train)).join(test, "doc_id").where("not base_failed")
    right, n = got.agg(F.sum((F.col("kept") == (F.col("quality") == 1)).cast("int")), F.count("*")).first()
    assert n > 50 and right / n > 0.9


def test_odd_rows(spark, tables):
    rows = spark.createDataFrame([(1, None, "p"), (None, "a b", None), (1, "x " * 50, "p"), (1, "x " * 50, "p")], "doc_id long, text string, kept string")
    got = q.quality_rules(rows, None).collect()
    assert len(got) == 4 and all(r.base_failed and not r.kept for r in got)
    assert q.quality_rules(rows.limit(0), None).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id long, quality int")
    assert q.fit(rows, labels) is None
    assert q.keep_good(rows, labels).columns == rows.columns


def test_several_texts_of_one_id_teach_the_same(spark):
    rows = [(i % 40, f"good words of text {i} " * 6 if i % 2 else f"bad # $ things {i} " * 6) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    a, b = [q.fit(df, labels) for df in (docs, docs.repartition(5))]
    assert (a.weights == b.weights).all() and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)


def test_features_of_the_sample_do_not_come_to_the_driver(spark, monkeypatch):
    texts = {i: f"good words of text {i} " * 6 if i % 2 else f"bad # $ things {i} " * 6 if i else "" for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    parts = [b for i, t in texts.items() for b in q._sparse_rows([q.pa.RecordBatch.from_pydict({"text": [t], "y": [i % 2]})])]
    rows = sorted((r["y"], r["bucket"], r["value"]) for b in parts for r in b.to_pylist())
    again = list(q._fit_rows([q.pa.RecordBatch.from_pylist([dict(zip(("y", "bucket", "value"), r)) for r in rows[k : k + 7]], schema=q._SPARSE) for k in range(0, len(rows), 7)]))

    def here(*_):
        raise AssertionError("fitted in the driver")

    for name in ("_csr", "_logistic", "_scores"):
        monkeypatch.setattr(q, name, here)
    got = q.fit(docs.repartition(3), labels)
    assert len(again) == 1 and again[0].to_pylist()[0] == {"weights": got.weights.tobytes(), "bias": got.bias, "slope": got.slope, "offset": got.offset}
