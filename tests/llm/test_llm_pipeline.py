import hashlib

import corpus_pipeline as cp
from demandlens.llm import bpe, quality_rules
from demandlens.llm.tables import table

SF = "/root/testdata/sf0.001"


def norm(line):
    return "".join(c.lower() if c < "\x80" else c for c in line.strip(" \t\n\r\x0b\x0c"))


def dedupe_lines(rows):
    holders = {}
    for i, t in rows:
        for line in t.split("\n"):
            holders.setdefault(norm(line), set()).add(i)
    lost = {k: min(h) for k, h in holders.items() if len(h) > 1 and len(k) >= 10}
    return [(i, "\n".join(x for x in t.split("\n") if lost.get(norm(x), i) == i)) for i, t in rows]


def keep_one(rows):
    sets = {}
    for i, t in rows:
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    comp = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if comp[a] != comp[b] and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return [(i, t) for i, t in rows if comp[i] == i]


def test_stages_against_brute_force(spark):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "entropy_mix", "byte_bpe"]
    docs = table(spark, SF, "documents")
    steps = {}
    for name, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, SF), "t")
        steps[name] = docs.collect()
    columns = table(spark, SF, "documents").columns
    assert all(list(steps[n][0].asDict()) == columns for n in list(steps)[:4])
    all_docs = table(spark, SF, "documents")
    verdict = {r.doc_id: r.kept for r in quality_rules.quality_rules(all_docs, quality_rules.fit(all_docs, table(spark, SF, "labels"))).collect()}
    good = sorted((r.doc_id, r.text) for r in all_docs.collect() if verdict[r.doc_id])
    assert sorted((r.doc_id, r.text) for r in steps["quality_rules"]) == good
    good = dedupe_lines(good)
    assert sorted((r.doc_id, r.text) for r in steps["line_dedup"]) == good and all(r.n_chars == len(r.text) for r in steps["line_dedup"])
    good = keep_one(good)
    assert sorted((r.doc_id, r.text) for r in steps["ngram_join"]) == good
    texts = dict(good)
    mixed = [(r.doc_id, r.text) for r in steps["entropy_mix"]]
    assert all(texts[i] == t for i, t in mixed) and max(map(mixed.count, mixed)) <= 2
    want = sorted((i, len(x := bpe.encode(t, bpe.vocabulary_path())), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, t in mixed)
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in steps["byte_bpe"]) == want
    assert sorted(map(str, cp.run(spark, SF).collect())) == sorted(map(str, steps["byte_bpe"]))


def test_odd_tables(spark, tmp_dir):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "w " * 30, "en", None, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/a/labels.parquet")
    df.write.parquet(f"{tmp_dir}/a/documents.parquet")
    assert cp.run(spark, f"{tmp_dir}/a").count() == 0
    spark.read.parquet(f"{tmp_dir}/a/labels.parquet").write.parquet(f"{tmp_dir}/b/labels.parquet")
    df.limit(0).write.parquet(f"{tmp_dir}/b/documents.parquet")
    assert cp.run(spark, f"{tmp_dir}/b").count() == 0
