import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from demandlens.llm import bpe

PATH = bpe.vocabulary_path()


def whole(text):
    ids = bpe.encode(text or "", PATH)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def chunked(text, size):
    old, bpe.OVERLAP_CHARS = bpe.OVERLAP_CHARS, 8
    try:
        n = max(1, -(-len(text) // size))
        starts = []
        for k in range(n):
            part = text[k * size : (k + 1) * size + 8]
            starts.append(bpe.boundaries(part, k * size, k * size + len(part) >= len(text)))
        at = bpe.cuts(lambda i, j: text[i:j], starts, len(text), size)
    finally:
        bpe.OVERLAP_CHARS = old
    return [text[i:j] for i, j in zip(at, [*at[1:], len(text)])]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("ab's 'rell1  \n\t.,é漢 \x1c")), st.characters(codec="utf-8")), min_size=1, max_size=200), st.integers(5, 40))
def test_stitched_pieces_encode_like_the_whole(text, size):
    pieces = chunked(text, size)
    assert "".join(pieces) == text
    ids = [i for p in pieces for i in bpe.encode(p, PATH)]
    assert ids == bpe.encode(text, PATH)
    assert bpe.decode(ids, PATH) == text.encode()


def test_documents(spark):
    texts = [None, "", "a", "don't we'll  see\n\n  it's", "wörd " * 3000, "x" * 5000, " " * 3000 + "end", "wörd " * 3000, "漢字 and 1234 " * 700]
    df = spark.createDataFrame([(i if i != 3 else None, t, "z") for i, t in enumerate(texts)] + [(4, "wörd " * 3000, "z")], "doc_id long, text string, row string")
    got = bpe.encode_digests(df, chunk_chars=2000).collect()
    want = sorted((str(i if i != 3 else None), *whole(t)) for i, t in enumerate(texts)) + [("4", *whole(texts[4]))]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe.encode_digests(df.limit(0)).count() == 0
    parts = bpe.encode_documents(df, chunk_chars=2000).where("doc_id = 8").orderBy("part").collect()
    assert len(parts) > 1 and [i for p in parts for i in p.ids] == bpe.encode(texts[8], PATH)
