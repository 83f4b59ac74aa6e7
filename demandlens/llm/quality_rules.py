"""Quality rules: base counts and a hashed n-gram classifier.

Every text gets base counts (words, symbols, repeated lines, repeated word windows).
A logistic regression over hashed words and hashed character 3- and 4-grams is fitted on
labelled quality rows, its probability is calibrated on rows it was not fitted on
(Platt scaling), and whole texts are scored in Arrow batches against a fixed threshold.

Defined results: a NULL or empty text has no words and fails the base rules; repeated
rows get equal results; with no label of one class the classifier keeps everything; an
empty table gives an empty result; of the input only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.tables import labelled_sample, table
from demandlens.llm.text import U64, Words, as_bytes, blocks, group_sums, mix

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
WINDOW_WORDS = 8
MAX_REPEAT_PERCENT = 30

#: Size of the hashed feature space (three families share it).
BUCKETS = 1 << 18
#: Labelled rows of each class that the classifier is fitted and calibrated on, at most.
SAMPLE_PER_CLASS = 2000
#: A document is kept at this calibrated probability of good quality or above.
KEEP_AT = 0.5
#: Feature families are averages over their items, scaled by this.
SCALE = 30.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


@dataclass
class QualityModel:
    weights: np.ndarray  # BUCKETS float32
    bias: float
    slope: float  # calibration: sigmoid(slope * score + offset)
    offset: float

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * score + self.offset, -50, 50)))


# ------------------------------------------------------------------ base counts
def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The base counts of a block of texts (see the module docstring)."""
    n = len(texts)
    w = Words(texts)
    lead = ((w.buf & 0xC0) != 0x80).astype(np.int64)
    points = np.concatenate([[0], np.cumsum(lead)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[w.buf])])
    out = {
        "n_words": w.counts,
        "word_chars": group_sums(w.text, points[w.end] - points[w.start], n).astype(np.int64),
        "n_symbols": (symbols[w.text_start[1:]] - symbols[w.text_start[:-1]]).astype(np.int64),
        "n_dup_lines": np.fromiter((_dup_lines(t) for t in texts), np.int64, n),
        "n_repeat_words": _repeat_words(w, n),
    }
    return out


def _dup_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.split(None, 1):
            seen.add(line)
    return dup


def _repeat_words(w: Words, n: int) -> np.ndarray:
    """Words lying in an 8-word window that the same text holds twice or more."""
    text, h = w.shingles(WINDOW_WORDS)
    out = np.zeros(n, np.int64)
    if not len(h):
        return out
    order = np.lexsort((h, text))
    t, s = text[order], h[order]
    twin = (t[1:] == t[:-1]) & (s[1:] == s[:-1])
    if not twin.any():
        return out
    hit = np.zeros(len(h), bool)
    hit[order[1:][twin]] = True
    hit[order[:-1][twin]] = True
    # A window's first word: its rank inside the text plus the text's first word.
    starts = np.flatnonzero(w.text[: len(w.text) - WINDOW_WORDS + 1] == w.text[WINDOW_WORDS - 1 :])[hit]
    cover = np.zeros(len(w.text) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW_WORDS, -1)
    return group_sums(w.text, np.cumsum(cover[:-1]) > 0, n).astype(np.int64)


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


# ------------------------------------------------------------------ hashed features
def features(texts: list[bytes]):
    """(text index, bucket, value) of a block of texts: words, character 3- and 4-grams,
    each family averaged over the text."""
    n = len(texts)
    w = Words(texts)
    parts = [(w.text, (w.hash % U64(BUCKETS)).astype(np.int64))]
    points = np.frombuffer(b"\n".join([*texts, b""]).decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = (w.buf & 0xC0) != 0x80
    text_of = np.repeat(np.arange(n), np.diff(w.text_start))[lead]
    coded = mix(points.astype(np.uint64))
    for size in (3, 4):
        m = len(coded) - size + 1
        if m <= 0:
            continue
        h = coded[:m].copy()
        for k in range(1, size):
            h = h * U64(0x9E3779B97F4A7C15) + coded[k : k + m]
        same = text_of[:m] == text_of[size - 1 :]
        parts.append((text_of[:m][same], ((h[same] >> U64(20)) % U64(BUCKETS)).astype(np.int64)))
    for text, bucket in parts:
        per = np.bincount(text, minlength=n)
        yield text, bucket, SCALE / np.maximum(per, 1)[text]


def _score(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    total = np.zeros(len(texts))
    for text, bucket, value in features(texts):
        total += group_sums(text, weights[bucket] * value, len(texts))
    return total


# ------------------------------------------------------------------ fitting
def _sparse_rows(batches):
    for batch in batches:
        texts = as_bytes(batch.column("text").to_pylist())
        ys = batch.column("y").to_pylist()
        rows = {"y": [], "bucket": [], "value": []}
        for i, text in enumerate(texts):
            parts = list(features([text]))
            bucket = np.concatenate([p[1] for p in parts])
            value = np.concatenate([p[2] for p in parts])
            at, inverse = np.unique(bucket, return_inverse=True)
            rows["y"].append(ys[i])
            rows["bucket"].append(at.astype(np.int32).tobytes())
            rows["value"].append(np.bincount(inverse, weights=value, minlength=len(at)).astype(np.float32).tobytes())
            if len(rows["y"]) == 200:
                yield pa.RecordBatch.from_pydict(rows, schema=_SPARSE)
                rows = {"y": [], "bucket": [], "value": []}
        yield pa.RecordBatch.from_pydict(rows, schema=_SPARSE)


_SPARSE = pa.schema([("y", pa.int32()), ("bucket", pa.binary()), ("value", pa.binary())])


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> QualityModel | None:
    """Fit and calibrate on at most ``per_class`` labelled rows of each class (whole texts);
    None when a class has no row. Of several texts of one id, the one with the least digest is
    taken, so reruns learn the same. The features of the sample, which is bounded, are fitted
    in a task; the fitted model alone reaches the driver."""
    sample = labelled_sample(labels, label, per_class)
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min_by("text", F.sha2(F.col("text").cast("string"), 256)).alias("text"))
        .select("text", F.col("y").cast("int"))
        .mapInArrow(_sparse_rows, "y int, bucket binary, value binary")
    )
    # in one order, whatever the partitions were
    ordered = rows.repartition(1).sortWithinPartitions("y", "bucket", "value")
    model = ordered.mapInArrow(_fit_rows, "weights binary, bias double, slope double, offset double").first()
    return None if model is None else QualityModel(np.frombuffer(model.weights, np.float32), model.bias, model.slope, model.offset)


def _fit_rows(batches):
    """The model (one row) of all rows (y, bucket, value), or no row when a class has none."""
    ys, train, held, n = [], [], [], 0
    for batch in batches:
        y = batch.column("y").to_pylist()
        ys += y
        buckets, values = batch.column("bucket"), batch.column("value")
        for i in range(len(y)):  # a quarter of each class calibrates
            (held if (n + i) % 4 == 3 else train).append((np.frombuffer(buckets[i].as_buffer(), np.int32), np.frombuffer(values[i].as_buffer(), np.float32)))
        n += len(y)
    y = np.array(ys, float)
    out = np.arange(n) % 4 == 3
    y, y_held = y[~out], y[out]
    if len(set(y)) < 2:
        return
    if len(set(y_held)) < 2:
        held, y_held = train, y
    fitted, calibrating = _csr(train), _csr(held)
    del train, held  # the features are held once
    weights, bias = _logistic(*fitted, y)
    slope, offset = platt(_scores(*calibrating, weights, len(y_held)) + bias, y_held)
    yield pa.RecordBatch.from_pydict({"weights": [weights.astype(np.float32).tobytes()], "bias": [float(bias)], "slope": [slope], "offset": [offset]}, schema=_MODEL)


_MODEL = pa.schema([("weights", pa.binary()), *[(c, pa.float64()) for c in ("bias", "slope", "offset")]])


def _csr(rows):
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(b) for b, _ in rows])
    return row, np.concatenate([b for b, _ in rows]), np.concatenate([v for _, v in rows])


#: Features that one numpy call of the fit works on, so that its temporaries stay small.
SLICE = 1 << 19


def _scores(row, bucket, value, w, n: int) -> np.ndarray:
    """Sum of weight times value of every row."""
    out = np.zeros(n)
    for k in range(0, len(row), SLICE):
        s = slice(k, k + SLICE)
        out += np.bincount(row[s], weights=w[bucket[s]] * value[s], minlength=n)
    return out


def _logistic(row, bucket, value, y, steps: int = 80, rate: float = 0.3, l2: float = 1e-4):
    """Full-batch logistic regression (Adagrad steps), classes weighted equally."""
    n = len(y)
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, b = np.zeros(BUCKETS), 0.0
    gw, gb = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(steps):
        z = _scores(row, bucket, value, w, n) + b
        r = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight
        g = l2 * w
        for k in range(0, len(row), SLICE):
            s = slice(k, k + SLICE)
            g += np.bincount(bucket[s], weights=r[row[s]] * value[s], minlength=BUCKETS)
        gw += g * g
        gb += r.sum() ** 2
        w -= rate * g / np.sqrt(gw)
        b -= rate * r.sum() / np.sqrt(gb)
    return w, b


def platt(score: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(slope, offset) of sigmoid(slope * score + offset) by Newton steps, with Platt's
    smoothed targets and a small ridge so that separable scores stay finite."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([score, np.ones(len(y))])
    scale = max(float(np.abs(score).max(initial=0.0)), 1e-9)
    x[:, 0] /= scale
    a = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -50, 50)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - t) + 1e-3 * a)
        a -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(a[0] / scale), float(a[1])


# ------------------------------------------------------------------ scoring
RESULT = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, probability double"
_RESULT = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("probability", pa.float64())])


def judge(texts: list[bytes], model: QualityModel | None) -> dict[str, np.ndarray]:
    """Counts, verdict and probability of a block of texts."""
    out = base_counts(texts)
    out["base_failed"] = base_failed(out)
    if model is None:
        p = np.ones(len(texts))
    else:
        p = model.probability(_score(texts, model.weights) + model.bias)
    out["kept"] = ~out["base_failed"] & (p >= KEEP_AT)
    out["probability"] = p
    return out


def quality_rules(documents: DataFrame, model: QualityModel | None) -> DataFrame:
    """One row per row of ``documents``: base counts, base verdict, final verdict, probability."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS float32 values, a fixed size

    def run(batches):
        for batch in batches:
            texts = as_bytes(batch.column("text").to_pylist())
            ids = batch.column("doc_id").to_pylist()
            for i, j in blocks(texts):
                cols = judge(texts[i:j], shared.value)
                yield pa.RecordBatch.from_pydict({"doc_id": ids[i:j], **cols}, schema=_RESULT)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, RESULT)


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that pass the rules, with their own columns."""
    model = fit(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = as_bytes(batch.column("text").to_pylist())
            keep = np.concatenate([judge(texts[i:j], shared.value)["kept"] for i, j in blocks(texts)] or [np.zeros(0, bool)])
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over every whole text of ``documents``; fitted on ``labels.quality``."""
    documents = table(spark, sf_dir, "documents")
    return quality_rules(documents, fit(documents, table(spark, sf_dir, "labels")))
