import hashlib
import random

import numpy as np
import pytest

from demandlens.llm import suffix_dedup as sd
from demandlens.llm import tables


def brute(rows):
    """(id, bytes, removed, spans, digest) with a dictionary of all 100-byte strings. Texts of one
    id go by their 8-byte BLAKE2 digest, a signed number."""
    order = lambda b: int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "big", signed=True)
    docs = sorted({(tables.NULL_ID if i is None else i, order((t or "").encode()), (t or "").encode()) for i, t in rows})
    seen, result = set(), {}
    for i, v, b in docs:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - sd.LENGTH + 1):
            s = b[p : p + sd.LENGTH]
            if s in seen:
                gone[p : p + sd.LENGTH] = True
            seen.add(s)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        result[i, b] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted((str(i), *result[tables.NULL_ID if i is None else i, (t or "").encode()]) for i, t in rows)


def answer(df):
    out = sd.remove_repeats(df).collect()
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out)


def test_every_window_has_one_anchor_by_content():
    rng = random.Random(1)
    same = bytes(rng.choices(b"abcd", k=300))
    texts = [bytes(rng.choices(b"abcd", k=n)) + same + bytes(rng.choices(b"abcd", k=50)) for n in (0, 10, 77, 500)] + [b"a" * 500, b"", b"x" * 99, b"y" * 100]
    text, rank, run, first, more = sd.anchors(texts)
    for i, t in enumerate(texts):
        starts = sorted(p for f, m in zip(first[text == i], more[text == i]) for p in range(f, f + m + 1))
        assert starts == list(range(max(0, len(t) - 99)))
    # inside the common part, runs are named alike
    names = [set(run[(text == i)]) for i in range(4)]
    assert len(names[0] & names[1] & names[2] & names[3]) >= 1


@pytest.mark.parametrize("batch,crowd,many", [(10000, 2000, 8), (3, 2000, 8), (3, 0, 2), (7, 5, 3)])
def test_odd_rows_match_brute_force(spark, monkeypatch, batch, crowd, many):
    monkeypatch.setattr(sd, "CROWD", crowd)
    monkeypatch.setattr(sd, "MANY_RUNS", many)
    rng = random.Random(batch)
    word = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    passage, licence = word(400), word(150)
    rows = [(i, word(rng.randint(0, 300)) + passage[rng.randint(0, 80) : rng.randint(150, 400)] + word(rng.randint(0, 120))) for i in range(40)]
    rows += [(50 + i, word(60) + licence + word(60)) for i in range(30)]
    rows += [(90, None), (91, ""), (92, "a" * 1000), (93, "ab" * 400), (94, "a" * 99), (95, "a" * 100), (None, rows[3][1]), (None, None), (3, rows[3][1]), (3, rows[5][1]), (96, passage), (97, passage), (98, word(99) + "z"), (2, "漢" * 200), (99, "b" * 20 + "漢" * 60 + word(5000))]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, at int")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert answer(df) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sd.remove_repeats(df.limit(0)).count() == 0


def test_documents_match_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert answer(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_many_texts_without_an_id(spark):
    rng = random.Random(11)
    shared = ["".join(rng.choices("abcdef", k=160)) for _ in range(40)]
    rows = [(None, f"short {k}" if k % 3 else f"{k} " + rng.choice(shared) + "".join(rng.choices("ghijk", k=rng.choice([0, 40, 150])))) for k in range(5000)]
    rows += [(7, rows[0][1]), (7, rows[3][1]), (7, rows[3][1])]
    assert answer(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
