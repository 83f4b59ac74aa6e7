import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from demandlens.llm import toxicity as tx


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


TERMS = [("aba", False, 2.0), ("ababa", False, 3.0), ("bacab", False, 3.5), ("abcabcabca", False, 4.0), ("cccc", True, 5.0), ("cbacba", True, 6.0)]


def brute(word):
    best = 0.0
    for term, stem, weight in TERMS:
        most = tx.edits_allowed(term, stem)
        d = min(distance(word[:n], term) for n in range(len(word) + 1)) if stem else distance(word, term)
        if d <= most and (not stem or word):
            best = max(best, weight * tx.EDIT_DISCOUNT**d)
    return best


AUTOMATON = tx.LexiconAutomaton(TERMS)


@settings(max_examples=1500, deadline=None)
@given(st.text("abc", max_size=12))
def test_automaton_equals_edit_distances(word):
    found = AUTOMATON.match(word)
    assert abs((found[0] * tx.EDIT_DISCOUNT ** found[1] if found else 0.0) - brute(word)) < 1e-12


def test_context_separates_quotation():
    hits = {"idiot": (4.0, 0)}
    plain = tx.context_sums("what an idiot he is", hits)
    quote = tx.context_sums('he wrote the word "idiot" on the wall', hits)
    address = tx.context_sums("you idiot", hits)
    assert address[0] > plain[0] > quote[0] and quote[1] > 0 == plain[1]


def test_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in tx.op3_toxicity(spark, d).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    right = sum(p == y for p, y in held) / len(held)
    assert right > 0.95 and sum(p and y for p, y in held) > 0.7 * sum(y for _, y in held)


def test_odd_rows(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(6)) + (" utter fool " if i % 4 == 0 else " plain words here ") + f"v{i}", int(i % 4 == 0)) for i in range(120)]
    df = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, score double")
    model = tx.fit(df, spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (5, 1), (500, 0)], "doc_id long, toxic int"))
    odd = spark.createDataFrame([(1, "utter fool", 0.0), (2, "utterr f00l", 0.0), (3, None, 0.0), (4, "", 0.0), (None, "plain", 0.0), (6, "plain " * 50000, 0.0), (1, "utter fool", 0.0)], df.schema)
    got = [(r.doc_id, r.score) for r in tx.toxicity(odd, model).collect()]
    by = dict(got)
    assert len(got) == 7 and by[1] > 0.7 and by[2] > 0.3 and max(by[3], by[4], by[6], by[None]) < 0.2 and by[3] == by[4]
    none = tx.fit(df, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert all(r.score < 1e-9 for r in tx.toxicity(odd, none).collect()) and tx.toxicity(odd.limit(0), none).count() == 0


def test_masked_short_terms():
    a = tx.LexiconAutomaton([("fool", False, 2.0)])
    assert all(a.match(w) == (2.0, 1) for w in ("f0ol", "fo*l", "fo*ol", "1ool")) and a.match("fool") == (2.0, 0)
    assert not any(a.match(w) for w in ("foul", "pool", "fol", "ofol", "f00l", "fooll", "f*o*l"))


def test_inflected_terms_keep_their_edits(spark):
    """Stems of equal evidence: the longest; forms of a stem without edits have theirs."""
    forms = ["grobianly", "grobianic"], ["idiot", "idiots"]
    rows = [(f"{forms[0][i % 2]} {forms[1][i % 2]} a{i}", 1) for i in range(40)] + [(f"plain words b{i}", 0) for i in range(40)]
    terms = tx.learn_lexicon(spark.createDataFrame(rows, "text string, y int"), 40, 40)
    assert {t for t, stem, _ in terms if stem} == {"grobian", "idio"}
    a = tx.LexiconAutomaton(terms)
    assert all(a.match(w)[1] == 1 for w in ("gxobianly", "robianic", "ixiot", "id*ots", "idi0t")) and a.match("idiotic")[1] == 0


def test_near_copies_of_the_sample(spark):
    base = [f"w{i}" for i in range(200)]
    near = base[:198] + ["x", "y"]  # most five-word runs are shared
    half = base[:100] + [f"z{i}" for i in range(100)]
    rows = [(1, 0, base), (2, 1, near), (3, 1, base), (4, 1, half), (5, 0, half), (6, 0, near), (7, 0, [])]
    df = spark.createDataFrame([(i, y, " ".join(w)) for i, y, w in rows], "doc_id long, y int, text string")
    # copies go only within a label, and only those that are alike
    assert {tuple(r) for r in tx._unlike(df).collect()} == {(1, 0), (2, 1), (4, 1), (5, 0), (7, 0)}


def test_learned_terms_have_no_bound_and_reruns_agree(spark):
    words = [f"{a}{b}{c}gr" for a in "bcdfghjklmnp" for b in "aeiouy" for c in "qrstvwxzbcdfghjklmnp"][:1100]
    rows = [(" ".join(words[k] for k in range(i % 40, len(words), 40)) + f" t{i}", 1) for i in range(1600)] + [(f"plain text {i}", 0) for i in range(1600)]
    terms = tx.learn_lexicon(spark.createDataFrame(rows, "text string, y int"), 1600, 1600)
    assert all(any(w == t or (stem and w.startswith(t)) for t, stem, _ in terms) for w in words[:50] + words[-50:])
    # several texts of one id: always the same one is learned from
    docs = spark.createDataFrame([(i % 60, f"utter fool {i}" if i % 2 else f"plain words {i}") for i in range(240)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    a, b = [tx.fit(df, labels) for df in (docs, docs.repartition(7))]
    assert (sorted(a.terms), a.bias, a.weights) == (sorted(b.terms), b.bias, b.weights)
