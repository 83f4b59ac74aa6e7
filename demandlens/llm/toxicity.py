"""Toxicity by a learned lexicon, matched with misspellings, in context.

The lexicon (words, and stems that many words share) is learned from labelled rows: terms
whose documents are toxic far more often than chance. It is stored in a trie and intersected
with the Levenshtein automata of its terms: the product is run as one automaton over the
characters of a word, built as it is used, so a word that is near no term is left after a
few characters. A hit counts by its term's weight, less by edit, and by its context window:
quotation (quotation marks around it, or a word of reporting nearby) against address. Words
of clean documents that are near a term are ordinary words, not misspellings of it. A
logistic regression on the document's sums of abusive and of quoted hits gives the score.

Learning uses at most ``PER_CLASS`` labelled rows of each class, one of each group of near
copies (of several texts of one id, the one with the least digest). Scoring reads whole texts.
Defined results: NULL and empty texts score like a text without hits; a NULL doc_id is not
held out and never learned from; repeated rows score alike; without labels of both classes
every score is 0; an empty table gives an empty result; only ``doc_id`` and ``text`` of the
documents are read, and the score depends on the text alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.tables import labelled_sample, table
from demandlens.llm.text import U64, Words, as_bytes, mix
from demandlens.session import materialize

# Fixed values of the query.
FOLDS, HELD_OUT = 3, 1
TOXIC_AT = 0.7

#: Labelled rows of each class to learn from, at most. What is learned from them (terms, words
#: near terms) has no bound of its own.
PER_CLASS = 6000
#: Hashes of a sampled text's signature, and how many of them near copies share.
SIGNATURE, ALIKE = 64, 0.8
#: Evidence that a term must give (log likelihood ratio) and its least log odds.
EVIDENCE = 18.0
LEAST_ODDS = 3.0
STEM_CHARS = range(4, 8)
#: Letters of the terms that match with one sign or digit wrong, too many or swapped only.
MASKED_CHARS = 4
#: Words before and after a hit that make its context.
CONTEXT = 6
EDIT_DISCOUNT = 0.7
QUOTES = "\"“”„«»‘’'"
# Fixed word lists of the context rule, in the languages of the corpus.
REPORTING = frozenset("said says called calls quoted quote word term wrote sagte sagt nannte zitat wort dit disait appelé mot dijo dice llamó palabra cita".split())
ADDRESS = frozenset("you your youre du dich dein deine ihr tu te toi ton vous votre tú usted tus eres".split())

# A word may be broken up by one sign of masking between its letters.
WORD = re.compile(r"[^\W_]+(?:[*$@!'’-][^\W_]+)*")


def edits_allowed(term: str, stem: bool) -> int:
    n = len(term)
    if stem:
        return int(n >= 6)
    return 0 if n < 5 else 1 if n < 10 else 2


def own_edits(word: str, stem: str) -> bool:
    """Whether a word has misspellings of its own that a stem it starts with does not match."""
    return edits_allowed(word, False) > edits_allowed(stem, True) or len(word) == MASKED_CHARS


# ------------------------------------------------------------------ automaton
@dataclass
class _Node:
    children: dict[str, int] = field(default_factory=dict)
    word: tuple[float, int] | None = None  # (weight, edits allowed) of the term that ends here
    stem: tuple[float, int] | None = None
    most: int = 0  # edits that some term below allows


class LexiconAutomaton:
    """Trie of the terms intersected with their Levenshtein automata.

    A state is a set of (trie node, edits); the next state is found once per character and
    kept. :meth:`match` gives a word's best (weight, edits), or None."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.nodes = [_Node()]
        self.short = {term: weight for term, stem, weight in terms if not stem and len(term) == MASKED_CHARS}
        self.masked: dict[tuple[int, str], float] = {}
        for term, weight in self.short.items():
            for i in range(MASKED_CHARS):
                key = (i, term[:i] + term[i + 1 :])
                self.masked[key] = max(weight, self.masked.get(key, weight))
        for term, stem, weight in terms:
            at, allowed, path = 0, edits_allowed(term, stem), [0]
            for c in term:
                if c not in self.nodes[at].children:
                    self.nodes[at].children[c] = len(self.nodes)
                    self.nodes.append(_Node())
                at = self.nodes[at].children[c]
                path.append(at)
            setattr(self.nodes[at], "stem" if stem else "word", (weight, allowed))
            for p in path:
                self.nodes[p].most = max(self.nodes[p].most, allowed)
        self.states: list[tuple[tuple[int, int], ...]] = []
        self.ids: dict[tuple, int] = {}
        self.steps: list[dict[str, int]] = []
        self.ends: list[tuple[float, int] | None] = []
        self.stems: list[tuple[float, int] | None] = []
        self.start = self._state({0: 0})

    def _closed(self, at: dict[int, int]) -> dict[int, int]:
        """With the nodes that leaving out characters of a term reaches."""
        todo = list(at.items())
        while todo:
            node, edits = todo.pop()
            if edits < self.nodes[node].most:
                for child in self.nodes[node].children.values():
                    if edits + 1 <= self.nodes[child].most and at.get(child, 99) > edits + 1:
                        at[child] = edits + 1
                        todo.append((child, edits + 1))
        return at

    def _state(self, at: dict[int, int]) -> int:
        at = self._closed(at)
        key = tuple(sorted(at.items()))
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            for kind, out in (("word", self.ends), ("stem", self.stems)):
                best = None
                for node, edits in key:
                    term = getattr(self.nodes[node], kind)
                    if term and edits <= term[1] and (best is None or term[0] * EDIT_DISCOUNT**edits > best[0] * EDIT_DISCOUNT ** best[1]):
                        best = (term[0], edits)
                out.append(best)
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        at: dict[int, int] = {}
        for node, edits in self.states[state]:
            n = self.nodes[node]
            child = n.children.get(c)
            if child is not None and at.get(child, 99) > edits:
                at[child] = edits
            if edits < n.most:
                if at.get(node, 99) > edits + 1:  # a character too many
                    at[node] = edits + 1
                for other in n.children.values():  # a wrong character
                    if edits + 1 <= self.nodes[other].most and at.get(other, 99) > edits + 1:
                        at[other] = edits + 1
        out = self._state(at) if at else -1
        self.steps[state][c] = out
        return out

    def _masked(self, word: str) -> tuple[float, int] | None:
        """A short term with one sign or digit in it that stands for a letter, is too many or
        has changed places."""
        found = []
        for i, c in enumerate(word):
            if not c.isalpha():
                less = word[:i] + word[i + 1 :]
                found += [self.masked.get((i, less)) if len(word) == MASKED_CHARS else self.short.get(less)]
                found += [self.short.get(word[:j] + word[j + 1] + word[j] + word[j + 2 :]) for j in (i - 1, i) if 0 <= j < len(word) - 1]
        best = max((w for w in found if w), default=None)
        return (best, 1) if best else None

    def match(self, word: str) -> tuple[float, int] | None:
        state, best = self.start, None
        if MASKED_CHARS <= len(word) <= MASKED_CHARS + 1 and word not in self.short and not word.isalpha():
            best = self._masked(word)
        better = lambda a, b: a if a and (b is None or a[0] * EDIT_DISCOUNT ** a[1] > b[0] * EDIT_DISCOUNT ** b[1]) else b
        for c in word:
            following = self.steps[state].get(c)
            state = self._step(state, c) if following is None else following
            if state < 0:
                return best
            if self.stems[state]:
                best = better(self.stems[state], best)
        return better(self.ends[state], best)


# ------------------------------------------------------------------ documents
@dataclass
class ToxicityModel:
    terms: list[tuple[str, bool, float]]  # (term, is a stem, weight)
    ordinary: frozenset[str] = frozenset()  # words that only look like a term
    bias: float = 0.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)

    def score(self, f: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(f @ np.array(self.weights) + self.bias, -50, 50)))


class Scanner:
    """Finds the hits of whole texts; words known to be near no term are remembered."""

    REMEMBERED = 500_000

    def __init__(self, terms, ordinary=frozenset()):
        self.automaton = LexiconAutomaton(terms)
        self.ordinary = ordinary
        self.hits: dict[str, tuple[float, int]] = {}
        self.clean: set[str] = set()

    def features(self, text: str) -> tuple[float, float, float]:
        low = text.lower()
        words = set(WORD.findall(low))
        for word in words - self.clean:
            if word not in self.hits:
                found = self.automaton.match(word)
                if found and (not found[1] or word not in self.ordinary):
                    self.hits[word] = found
                else:
                    self.clean.add(word)
        if len(self.clean) > self.REMEMBERED:
            self.clean = set()
        if len(self.hits) > self.REMEMBERED:
            self.hits = {w: h for w, h in self.hits.items() if w in words}
        if not any(w in self.hits for w in words):
            return 0.0, 0.0, 0.0
        abuse, quoted = context_sums(low, self.hits)
        return math.log1p(abuse), math.log1p(quoted), min(abuse, 1.0)


def context_sums(low: str, hits: dict[str, tuple[float, int]]) -> tuple[float, float]:
    """Sums of the hits' strengths, abusive and quoted, by their context windows."""
    spans = [(m.group(), m.start(), m.end()) for m in WORD.finditer(low)]
    abuse = quoted = 0.0
    for i, (word, start, end) in enumerate(spans):
        found = hits.get(word)
        if not found:
            continue
        strength = found[0] * EDIT_DISCOUNT ** found[1]
        left, right = max(0, i - CONTEXT), min(len(spans), i + CONTEXT + 1)
        near = {w for w, _, _ in spans[left:right]}
        before, after = low[spans[left][1] : start], low[end : spans[right - 1][2] + 1]
        marked = any(q in before for q in QUOTES[:6]) and any(q in after for q in QUOTES[:6])
        marked = marked or low[max(0, start - 1) : start] in QUOTES and low[end : end + 1] in QUOTES and start > 0 and end < len(low)
        if near & ADDRESS:
            abuse += 1.5 * strength
        elif marked or near & REPORTING:
            quoted += strength
            abuse += 0.25 * strength
        else:
            abuse += strength
    return abuse, quoted


# ------------------------------------------------------------------ learning
def learnable() -> Column:
    """Rows that may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT


def _term_counts(batches):
    """Documents per term and class, summed over the task's rows (a bounded sample)."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
            words = set(WORD.findall((text or "").lower()))
            terms = {(w, False) for w in words} | {(w[:n], True) for w in words for n in STEM_CHARS if len(w) > n}
            counts[y].update(terms)
    for y, c in counts.items():
        items = list(c.items())
        for k in range(0, len(items), 50_000):
            part = items[k : k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for (t, _), _ in part], pa.string()), pa.array([s for (_, s), _ in part], pa.bool_()), pa.array([n if y else 0 for _, n in part], pa.int64()), pa.array([0 if y else n for _, n in part], pa.int64())],
                names=["term", "stem", "toxic", "clean"],
            )


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[str, bool, float]]:
    """Terms of ``sample`` (text, y) with enough evidence."""
    if not n_toxic or not n_clean:
        return []
    counts = sample.select("text", "y").mapInArrow(_term_counts, "term string, stem boolean, toxic bigint, clean bigint").groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = materialize(counts.where("toxic >= 3"), "lexicon_counts")
    share = n_toxic / (n_toxic + n_clean)
    n = F.col("toxic") + F.col("clean")
    part = lambda k, p: F.when(k > 0, k * F.log(k / n / p)).otherwise(0.0)
    evidence = part(F.col("toxic"), share) + part(F.col("clean"), 1 - share)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1)))
    found = counts.select("term", "stem", "toxic", evidence.alias("evidence"), odds.alias("odds")).where(F.col("odds") >= LEAST_ODDS)
    # Of stems with the same evidence, the longest: it says most and allows edits.
    rows = found.where(F.col("evidence") >= EVIDENCE).orderBy(F.col("evidence").desc(), F.length("term").desc(), "term", "stem").collect()
    words = {r.term: r for r in rows if not r.stem}
    stems: dict[str, object] = {}
    for r in rows:
        if r.stem and not any(r.term.startswith(s) or s.startswith(r.term) for s in stems):
            # a stem of one word only is that word
            if not any(w.startswith(r.term) and words[w].toxic >= 0.8 * r.toxic for w in words):
                stems[r.term] = r
    out = [(r.term, True, min(8.0, r.odds)) for r in stems.values()]
    out += [(w, False, min(8.0, r.odds)) for w, r in words.items() if not any(w.startswith(s) for s in stems)]
    # The stem's evidence is that of its forms; they stay where they match misspellings that it does not.
    if stems:
        start = F.array(*[F.substring("term", 1, n) for n in STEM_CHARS])
        forms = found.where(~F.col("stem") & F.arrays_overlap(start, F.array(*[F.lit(s) for s in stems]))).orderBy(F.col("toxic").desc(), "term").collect()
        out += [(r.term, False, min(8.0, r.odds)) for r in forms if all(own_edits(r.term, s) for s in stems if r.term.startswith(s))]
    return out


N_FEATURES = 3


def _features(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """(y, f array) of every row (text, y)."""

    def run(batches):
        scanner = Scanner(model.terms, model.ordinary)
        for batch in batches:
            f = [list(scanner.features(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(f, pa.list_(pa.float64()))], names=["y", "f"])

    return documents.select("y", "text").mapInArrow(run, "y int, f array<double>")


def _ordinary_words(clean: DataFrame, terms) -> frozenset[str]:
    """Words of clean documents that differ from a term by edits."""

    def run(batches):
        automaton = LexiconAutomaton(terms)
        for batch in batches:
            near = [w for t in batch.column("text").to_pylist() for w in set(WORD.findall((t or "").lower())) if (m := automaton.match(w)) and m[1]]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["word"])

    return frozenset(r.word for r in clean.select("text").mapInArrow(run, "word string").distinct().collect())


def _signatures(batches):
    """Least hashes of each text's five-word runs under SIGNATURE orders: two texts share one
    with the probability of their sets' similarity."""
    for batch in batches:
        out = []
        for text in as_bytes(batch.column("text").to_pylist()):
            w = Words([text], lower=True)
            h = w.shingles(5)[1]
            h = h if len(h) else w.hash
            out.append([int(mix(h + U64(k)).min().astype(np.int64)) for k in range(SIGNATURE)] if len(h) else [0] * SIGNATURE)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "y", "h"])


def _unlike(sample: DataFrame) -> DataFrame:
    """(doc_id, y) of the sample's rows that are no near copy (similarity 0.8, estimated by
    signatures) of a row kept with the same label. Bounded: the driver gets one signature of
    each sampled row."""
    rows = sample.select("doc_id", "y", "text").mapInArrow(_signatures, "doc_id bigint, y int, h array<bigint>").collect()
    holders: dict[tuple[int, int, int], list[int]] = {}
    kept: list[tuple[int, int]] = []
    for r in sorted(rows, key=lambda r: (r.y, r.doc_id)):
        own = [(r.y, k, h) for k, h in enumerate(r.h)]
        shared = Counter(i for key in own for i in holders.get(key, ()))
        if max(shared.values(), default=0) >= ALIKE * SIGNATURE:
            continue
        for key in own:
            holders.setdefault(key, []).append(len(kept))
        kept.append((r.doc_id, r.y))
    return sample.sparkSession.createDataFrame(kept, "doc_id bigint, y int")


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", where=None, per_class: int = PER_CLASS) -> ToxicityModel:
    """Lexicon and score from the labelled rows that ``where`` allows."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = labelled_sample(labels, label, per_class, where).select("doc_id", F.col("y").cast("int").alias("y"))
    # Of several texts of one id, the one with the least digest.
    one = F.min_by("text", F.sha2("text", 256)).alias("text")
    sample = materialize(texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(one), "toxicity_sample")
    unlike = _unlike(sample)
    sample = sample.join(F.broadcast(unlike), ["doc_id", "y"])
    counts = {r.y: r["count"] for r in unlike.groupBy("y").count().collect()}
    terms = learn_lexicon(sample, counts.get(1, 0), counts.get(0, 0))
    if len(counts) < 2 or not terms:
        return ToxicityModel(terms, bias=-50.0)
    model = ToxicityModel(terms, _ordinary_words(sample.where("y = 0"), terms))
    rows = sorted((r.y, tuple(r.f)) for r in _features(sample, model).collect())
    x = np.array([[*f, 1.0] for _, f in rows])
    y = np.array([y for y, _ in rows], float)
    # A ridge towards a prior: abusive hits count, quoted ones do not.
    prior, ridge = np.array([1.5, 0.0, 3.0, -3.0]), np.diag([0.3, 0.3, 0.3, 1e-3])
    a = prior.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ (a - prior))
        a -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return ToxicityModel(model.terms, model.ordinary, float(a[-1]), tuple(float(v) for v in a[:-1]))


def toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row of ``documents``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # learned from PER_CLASS rows a class at most

    def run(batches):
        scanner = Scanner(shared.value.terms, shared.value.ordinary)
        for batch in batches:
            f = np.array([scanner.features(t or "") for t in batch.column("text").to_pylist()]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(f), pa.float64())], names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, score double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``, learned from the rows not held out."""
    documents = table(spark, sf_dir, "documents")
    scored = toxicity(documents, fit(documents, table(spark, sf_dir, "labels"), where=learnable()))
    held_out = F.coalesce(~learnable(), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))
