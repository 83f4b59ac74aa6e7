import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from demandlens.llm import lm_score as lm

W, P = 1 << 17, 1 << 18


def brute(rows, targets):
    """Both models with dictionaries over words and pairs."""
    split = lambda t: (t or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for i, t in rows:
        w = split(t)
        for k in ([0, 1] if i in targets else [1]):
            words[k].update(w)
            pairs[k].update(zip(w, w[1:]))
    out = []
    for i, t in rows:
        w, losses = split(t), []
        for k in range(2):
            total, loss = sum(words[k].values()), 0.0
            for j, x in enumerate(w):
                p = (words[k][x] + lm.ADD) / (total + lm.ADD * W)
                if j and words[k][w[j - 1]]:
                    p = lm.PAIR_SHARE * pairs[k][w[j - 1], x] / words[k][w[j - 1]] + (1 - lm.PAIR_SHARE) * p
                loss -= math.log(p)
            losses.append(loss / len(w) if w else None)
        out.append((str(i), len(w), *losses))
    return sorted(out, key=str)


ROWS = [(1, "A good text, a good word"), (2, "bad word bad word"), (3, None), (4, ""), (5, "good text again"), (None, "a text"), (6, "the word " * 30000), (2, "bad word bad word"), (7, "é ñ é")]


def test_losses_match_dictionaries(spark):
    df = spark.createDataFrame([(*r, 1.0) for r in ROWS], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (5, 1), (5, 1), (2, 1), (2, 0), (None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    got = lm.score(df, lm.count_models(df, lm.good_ids(labels), W, P)).collect()
    got = sorted(((str(r.doc_id), r.n_tokens, r.target_loss, r.background_loss) for r in got), key=str)
    for a, b in zip(got, brute(ROWS, {1, 5})):
        assert a[:2] == b[:2]
        assert a[2:] == b[2:] if b[2] is None else a[2:] == pytest.approx(b[2:], rel=1e-5)
    assert lm.score(df.limit(0), lm.count_models(df.limit(0), lm.good_ids(labels), W, P)).count() == 0


def test_good_documents_score_lower(spark):
    d = "/root/testdata/sf0.01"
    got = lm.op6_cross_entropy(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    mean = {r.quality: r[1] for r in got.groupBy("quality").avg("score").collect()}
    assert mean[1] < mean[0] and got.count() == 399


@pytest.mark.parametrize("sizes", [(16, 1000), (16, 3, 5), (16, 0, 0)])
def test_every_word_and_pair_has_its_own_count(spark, monkeypatch, sizes):
    """Vocabulary, bytes of a chunk, keys of a range: many chunks and ranges, down to one text and one key."""
    rows = [(i, " ".join(f"w{(i * k * k + k) % 211}" for k in range(40))) for i in range(60)] + ROWS[:6] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    targets = set(range(0, 60, 3))
    got = lm.score(df, lm.count_models(df, spark.createDataFrame([(i,) for i in targets], "doc_id long"), *sizes)).collect()
    words = {w for _, t in rows for w in (t or "").lower().split()}
    monkeypatch.setitem(globals(), "W", len(words))
    got = sorted(((str(r.doc_id), r.n_tokens, r.target_loss, r.background_loss) for r in got), key=str)
    want = brute(rows, targets)
    assert len(got) == len(want) and len(words) > 200
    for a, b in zip(got, want):
        assert a[:2] == b[:2]
        assert a[2:] == b[2:] if b[2] is None else a[2:] == pytest.approx(b[2:], rel=1e-6)


def test_other_documents_are_scored_by_the_same_models(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    models = lm.count_models(df, spark.createDataFrame([(1,), (5,)], "doc_id long"), W, 64, 4)
    own = {(r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in lm.score(df, models).collect()}
    other = df.where("doc_id in (1, 2, 3, 7)").withColumn("bytes", F.lit("x"))
    got = [(r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in lm.score(other, models).collect()]
    assert len(got) == 5 and set(got) <= own
    new = lm.score(spark.createDataFrame([(9, "unseen words here")], "doc_id long, text string"), models).first()
    uniform = [math.log((n + lm.ADD * W) / lm.ADD) for n in models.totals]
    assert new.n_tokens == 3 and [new.target_loss, new.background_loss] == pytest.approx(uniform)


def test_files_and_batches_hold_few_chunks(spark, monkeypatch):
    """A chunk is one row of megabytes: neither a file nor a batch may hold all those of a task."""
    held, real = [], lm.materialize
    monkeypatch.setattr(lm, "materialize", lambda *a: held.append([spark.conf.get(k) for k in lm.BATCHES]) or real(*a))
    df = spark.createDataFrame([(i, "some text here") for i in range(100)], "doc_id long, text string").coalesce(1)
    models = lm.count_models(df, df.select("doc_id"), W, 1)
    assert models.chunks.count() == lm.score(df, models).count() == 100
    files = models.chunks.groupBy(F.input_file_name()).count().collect()
    assert max(r[1] for r in files) <= lm.FILE_CHUNKS
    assert held == [list(lm.BATCHES.values())] * 3
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "4096"
