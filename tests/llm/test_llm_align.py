"""Token alignment against whole-text tokenization and all overlaps."""

import hashlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from demandlens.llm import token_align as ta

A, B = ta.vocabulary_path(ta.VOCABULARY_A), ta.vocabulary_path(ta.VOCABULARY_B)


def whole(text):
    """Ids of both sides with byte ranges, from the libraries on the whole text; None without tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return None
    t = whole.__dict__.setdefault("t", Tokenizer.from_file(A))
    t.encode_special_tokens = True
    sp = whole.__dict__.setdefault("sp", sentencepiece.SentencePieceProcessor(model_file=B))
    sides = []
    for ids, token in ((t.encode(" " + text, add_special_tokens=False).ids, ta.byte_level(A).token), (sp.encode(text), ta.piece_model(B).token)):
        at, rows = 0, []
        for i in ids:
            rows.append((i, at, at + len(token[i])))
            at += len(token[i])
        if b"".join(token[i] for i in ids) != (" " + text).encode():
            return None
        sides.append(rows)
    return sides


def brute(text):
    sides = whole(text)
    if sides is None:
        return (0, 0, 0, 0, ""), Counter()
    a, b = sides
    links = Counter((x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2])
    cuts = sorted({x[2] for x in a} & {y[2] for y in b})
    groups, last = [], 0
    for c in cuts:
        groups.append(",".join(str(x[0]) for x in a if last < x[2] <= c) + "|" + ",".join(str(y[0]) for y in b if last < y[2] <= c))
        last = c
    return (len(a), len(b), len(groups), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest()), links


def flat(row):
    n_a, n_b, groups, links, sha, pairs, times = row
    return (n_a, n_b, groups, links, sha), Counter({(int(p) >> 32, int(p) & 0xFFFFFFFF): int(t) for p, t in zip(pairs, times)})


words = st.sampled_from(["the", "ofthw", "don't", "<|endoftext|>", "</s>", "<s>", "ﬁ", "漢字", "Ünï", "1234567", "▁", "▁x", "a　b", "x", "\n", "  ", "\t", " ", "é", "\x00", "\U0001f600", "\x1c", "\x85"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.lists(words, max_size=12).map(" ".join), st.text(max_size=30), st.lists(words, max_size=12).map("".join)), min_size=1, max_size=5))
def test_units_align_like_whole_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = [flat(r) for r in ta.Aligner(A, B).texts(texts)]
    assert got == [brute(t) for t in texts]


def test_slices_and_lanes_do_not_change_the_result(monkeypatch):
    texts = ["then again thtionoues erreoror " * 40, None, "", "x" * 900 + " y " * 30, "▁ bad", "a b\n\nc  d " * 25]
    want = [brute(t) for t in texts]
    for lane, slice_, stored in ((8, 50, 10), (512, 300, 1 << 20), (1 << 20, 1 << 20, 0)):
        monkeypatch.setattr(ta, "LANE_CHARS", lane)
        monkeypatch.setattr(ta, "SLICE_CHARS", slice_)
        monkeypatch.setattr(ta, "STORED_UNITS", stored)
        assert [flat(r) for r in ta.Aligner(A, B).texts(texts)] == want


def table_of(texts):
    parts = [brute(t) for t in texts]
    docs = Counter(p for _, links in parts for p in links)
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(top.get(a, 0), n)
    return [
        (head[0], head[1], head[2], head[3], sum(t for p, t in links.items() if docs[p] == top[p[0]]), sum(t * docs[p] for p, t in links.items()), head[4])
        for head, links in parts
    ]


def test_documents(spark):
    texts = [None, "", "the cat sat on the mat", "the cat sat on the mat", "the dog, the Dog <s>", "▁", "tail of thw " * 60, "other words entirely", "z" * 3000]
    df = spark.createDataFrame([(i if i != 3 else None, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, pair int, row int")
    want = sorted(map(str, zip([0, 1, 2, None, 4, 5, 6, 7, 8], table_of(texts))))
    for frequent in (1 << 20, 5, 1):
        rows = ta.with_counts(ta.align_documents(df), frequent).collect()
        got = sorted(str((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256))) for r in rows)
        assert got == want
    assert ta.with_counts(ta.align_documents(df.limit(0))).count() == 0


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = [d for d in docs if len(d.text or "") < 500]
    got = {r.doc_id: r for r in ta.op12_token_align(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in short:
        (n_a, n_b, groups, links, sha), _ = brute(d.text)
        r = got[d.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (n_a, n_b, groups, links, sha)
