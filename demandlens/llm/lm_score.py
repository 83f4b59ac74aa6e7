"""Language-model scoring by cross-entropy difference.

Two bigram models are counted over whole texts: the target model over the documents with
the target label, the background model over all documents. Every word (A-Z lower-cased) and
every pair of neighbouring words of the corpus has counts of its own. Both models have one
vocabulary: the words of the background, ``vocabulary`` at least. They are matched in form
too: the same interpolation of pair and word probabilities, the same additive smoothing. A
document's losses are its mean negative log probabilities per word under each; its score is
their difference (low: like the target).

Counting and looking up are one exchange. Texts are written in chunks; a chunk sends each of
its distinct words and pairs once, as sorted arrays by key range (steps between keys in byte
planes, compressed), with its own counts. A range
sums the counts of all chunks and answers each chunk in the order of its keys, so that no
keys travel back and no task or driver holds more than one range or chunk. A key in every
text is one entry a chunk.

Words, pairs and texts are equal where their 64-bit hashes are. Defined results: a NULL or
empty text has no words and NULL losses; a text longer than a chunk is a chunk of its own;
repeated rows count as often as they stand there and score alike; without target documents
the target model is uniform; ids with contradicting labels and NULL ids are no target; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.tables import table
from demandlens.llm.text import U64, Words, as_bytes, blocks, group_sums, mix
from demandlens.operators.joins import bounded_broadcast
from demandlens.session import materialize, settings

#: Least size of the shared vocabulary.
VOCABULARY = 1 << 20
#: Bytes of text in a chunk (a longer text is one chunk), and keys that a range gathers, about.
CHUNK_BYTES = 1 << 22
RANGE_KEYS = 1 << 20
#: Chunks in a file, and what a reader and a Python worker get at once: a chunk is one row of some
#: megabytes, so that the usual row groups and batches would be as large as a task's input.
FILE_CHUNKS = 8
BATCHES = {
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}
#: Share of the pair probability, and the additive count of the word probability.
PAIR_SHARE = 0.6
ADD = 0.1

_CHUNK = "chunk bigint, bytes bigint, ids array<bigint>, texts array<string>, targets array<boolean>"
_ASKED = "part bigint, chunk bigint, answered boolean, keys binary, target binary, background binary"
_ANSWER = "part bigint, chunk bigint, target binary, background binary, words bigint, target_words bigint, background_words bigint"
_SCORE = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, score double"


def _chunked(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """``rows`` (doc_id, text, is_target) in chunks, one row each, written once."""

    def run(batches):
        number, ids, texts, targets, size = TaskContext.get().partitionId() << 32, [], [], [], 0

        def chunk():
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), pa.array([ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.string())), pa.array([targets], pa.list_(pa.bool_()))], names=["chunk", "bytes", "ids", "texts", "targets"])

        for batch in batches:
            for doc, text, target in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "is_target"))):
                n = len((text or "").encode())
                if ids and size + n > chunk_bytes:
                    yield chunk()
                    number, ids, texts, targets, size = number + 1, [], [], [], 0
                ids.append(doc)
                texts.append(text or "")
                targets.append(target)
                size += n
        if ids:
            yield chunk()

    return materialize(rows.mapInArrow(run, _CHUNK), "lm_chunks", FILE_CHUNKS)


def _entries(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, word, pair with the word before, is first) of every word; the pair of a
    text's first word has no meaning."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool))]
    for i, j in blocks(texts):
        w = Words(texts[i:j], lower=True)
        first = np.zeros(len(w.text), bool)
        first[w.first[:-1][w.counts > 0]] = True
        before = np.concatenate([np.zeros(1, np.uint64), w.hash[:-1]]) if len(w.hash) else w.hash
        out.append((w.text + i, w.hash, mix(mix(before) * U64(3) + w.hash), first))
    return tuple(np.concatenate(x) for x in zip(*out))


def _distinct(texts: list[bytes]):
    """The entries of a chunk, and per kind (words, pairs) its sorted distinct keys and each
    occurrence's place among them."""
    text, word, pair, first = _entries(texts)
    return text, first, [np.unique(word, return_inverse=True), np.unique(pair[~first], return_inverse=True)]


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (((keys >> U64(32)) * U64(ranges)) >> U64(32)).astype(np.int64)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on by byte planes, so that the planes of small ones compress to nothing."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as the first one and the steps to the next."""
    return np.diff(keys, prepend=U64(0))


def _asked(chunks: DataFrame, ranges: int, counted: bool, answered: bool) -> DataFrame:
    """Each chunk's distinct keys by range (pairs stand in the parts after the words'), with the
    chunk's own counts if it is counted."""

    def run(batches):
        for batch in batches:
            for number, values, targets in zip(*(batch.column(c).to_pylist() for c in ("chunk", "texts", "targets"))):
                text, first, kinds = _distinct(as_bytes(values))
                mine = np.array(targets, bool)[text]
                for kind, ((keys, at), own) in enumerate(zip(kinds, (mine, mine[~first]))):
                    background = np.bincount(at, minlength=len(keys)).astype(np.int32)
                    target = np.bincount(at, own, len(keys)).astype(np.int32)
                    part = _range_of(keys, ranges)
                    begin = np.flatnonzero(np.diff(part, prepend=-1))
                    cut = [slice(i, j) for i, j in zip(begin, [*begin[1:], len(keys)])]
                    of = lambda x, wanted=True: pa.array([_packed(x[c]) if wanted else None for c in cut], pa.binary())  # noqa: B023, E731
                    sorted_keys = pa.array([_packed(_steps(keys[c])) for c in cut], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part[begin] + kind * ranges), pa.array([number] * len(cut), pa.int64()), pa.array([answered] * len(cut), pa.bool_()), sorted_keys, of(target, counted), of(background, counted)],
                        names=["part", "chunk", "answered", "keys", "target", "background"],
                    )

    return chunks.select("chunk", "texts", "targets").mapInArrow(run, _ASKED)


def _answers(asked: DataFrame) -> DataFrame:
    """Per part one row of its sums (chunk NULL: distinct words or pairs that are counted,
    their occurrences), and one row for each chunk that is answered: both models' counts in
    the order of its keys."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        keys = [np.cumsum(_unpacked(r["keys"]), dtype=np.uint64) for r in rows]
        own = [np.concatenate([np.zeros(len(k), np.uint64) if r[c] is None else _unpacked(r[c]) for r, k in zip(rows, keys)]) for c in ("target", "background")]
        ends = np.cumsum([len(k) for k in keys])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        target, background = (np.bincount(at, x, len(distinct)).astype(np.int64) for x in own)
        part = rows[0]["part"]
        out = [{"part": part, "words": int((background > 0).sum()), "target_words": int(target.sum()), "background_words": int(background.sum())}]
        for r, k, end in zip(rows, keys, ends):
            if r["answered"]:
                mine = at[end - len(k) : end]
                out.append({"part": part, "chunk": r["chunk"], "target": _packed(target[mine]), "background": _packed(background[mine])})
        whole = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("target", pa.binary()), ("background", pa.binary()), ("words", pa.int64()), ("target_words", pa.int64()), ("background_words", pa.int64())])
        return pa.Table.from_pylist(out, schema=whole)

    return materialize(asked.groupBy("part").applyInArrow(run, _ANSWER), "lm_answers")


@dataclass
class NgramModels:
    """The counted ``documents`` in ``chunks``, the ``answers`` to them, and what both models
    share: ``totals`` (words of the target and the background) and the vocabulary's size."""

    documents: DataFrame
    chunks: DataFrame
    answers: DataFrame
    ranges: int
    chunk_bytes: int
    totals: np.ndarray
    vocabulary: int


def _rows(documents: DataFrame, is_target) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), is_target.alias("is_target"))


def count_models(documents: DataFrame, targets: DataFrame, vocabulary: int = VOCABULARY, chunk_bytes: int = CHUNK_BYTES, range_keys: int = RANGE_KEYS) -> NgramModels:
    """The two models of ``documents``; ``targets`` (doc_id) names the target's documents."""
    with settings(documents.sparkSession, BATCHES):
        flags = bounded_broadcast(targets.where("doc_id is not null").select("doc_id").distinct().withColumn("is_target", F.lit(True)))
        chunks = _chunked(_rows(documents.select("doc_id", "text").join(flags, "doc_id", "left"), F.coalesce("is_target", F.lit(False))), chunk_bytes)
        # A word of a corpus has some five bytes, and hardly any pair of it is met twice in a chunk.
        ranges = 1 + (chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0] // 5) // max(1, range_keys)
        answers = _answers(_asked(chunks, ranges, True, True))
        sums = answers.where((F.col("part") < ranges) & F.col("chunk").isNull()).agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "target_words", "background_words"))).first()
        return NgramModels(documents, chunks, answers, ranges, chunk_bytes, np.array(sums[1:], float), max(vocabulary, sums[0]))


def score(documents: DataFrame, models: NgramModels) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every row of ``documents``.
    The counted documents have their answers already; others ask the counted chunks' counts."""
    with settings(documents.sparkSession, BATCHES):
        return _scored(documents, models)


def _scored(documents: DataFrame, models: NgramModels) -> DataFrame:
    chunks, answers, totals, vocabulary = models.chunks, models.answers, models.totals, models.vocabulary
    if documents is not models.documents:
        chunks = _chunked(_rows(documents, F.lit(False)), models.chunk_bytes)
        answers = _answers(_asked(chunks, models.ranges, False, True).union(_asked(models.chunks, models.ranges, True, False)))

    def run(chunk: pa.Table, found: pa.Table) -> pa.Table:
        ids, values = (chunk.column(c).to_pylist()[0] for c in ("ids", "texts"))
        text, first, kinds = _distinct(as_bytes(values))
        given = sorted(found.to_pylist(), key=lambda r: r["part"])
        counts = [np.concatenate([np.zeros(0, np.uint64), *(_unpacked(r[c]) for r in given)]) for c in ("target", "background")]
        n_words, place = len(kinds[0][0]), np.zeros(len(text), np.int64)
        place[~first] = n_words + kinds[1][1]
        tokens, losses = np.bincount(text, minlength=len(ids)), []
        for count, total in zip(counts, totals):
            word = count[kinds[0][1]].astype(float)
            p = (word + ADD) / (total + ADD * vocabulary)
            history = np.concatenate([np.zeros(1), word[:-1]]) if len(word) else word
            seen = ~first & (history > 0)
            p[seen] = PAIR_SHARE * count[place[seen]] / history[seen] + (1 - PAIR_SHARE) * p[seen]
            losses.append(group_sums(text, -np.log(p), len(ids)) / np.maximum(tokens, 1))
        none = tokens == 0
        columns = [pa.array(ids, pa.int64()), pa.array(tokens.astype(np.int64)), *(pa.array(x, mask=none) for x in (*losses, losses[0] - losses[1]))]
        return pa.Table.from_arrays(columns, names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    found = answers.where("chunk is not null").select("chunk", "part", "target", "background")
    return materialize(chunks.select("chunk", "ids", "texts").groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(run, _SCORE), "lm_scores")


def good_ids(labels: DataFrame, label: str = "quality") -> DataFrame:
    """Ids whose labels all say 1."""
    return labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y")).where("y = 1").select("doc_id")


def op6_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every whole text of ``documents``; the target model is
    counted over the documents labelled as of good quality."""
    documents = table(spark, sf_dir, "documents")
    return score(documents, count_models(documents, good_ids(table(spark, sf_dir, "labels"))))
