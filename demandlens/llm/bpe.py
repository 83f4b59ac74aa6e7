"""Byte-level BPE encoding and decoding with overlapping chunks.

A text longer than a chunk is cut into overlapping chunks that are pre-tokenised in
parallel. The pattern has no look-behind, so pre-tokens found from a true boundary on are
true ones: a chunk's boundaries count from the first boundary that it shares with its
predecessor inside their overlap. The pieces between shared boundaries are then encoded in
parallel (every pre-token separately) and their ids joined in order. Decoding concatenates
the raw bytes of the ids. Texts of one chunk need no stitching and are encoded in place.

Defined results: a NULL or empty text has no ids (digests of nothing); repeated rows get
equal results; a text without a shared boundary in an overlap (one run of a character class
longer than the overlap) is read on from the last true boundary until boundaries agree; an
empty table gives an empty result; of the input only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.tables import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters of a chunk, and how far it reaches into its successor.
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("chunked", pat_str=split_pattern(), mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _pattern():
    return regex.compile(split_pattern())


def encode(text: str, path: str) -> list[int]:
    return encoder(path).encode_ordinary(text)


def decode(ids: list[int], path: str) -> bytes:
    return encoder(path).decode_bytes(ids)


# ------------------------------------------------------------------ chunks
def boundaries(text: str, chunk: int, last: bool) -> np.ndarray:
    """Starts of the pre-tokens of a chunk. Its first match may be cut off on the left; the
    ones next to its right end may change with the text that follows, so a chunk that is not
    the last drops those that touch the end (a match and the white space before it)."""
    starts, ends = [], []
    for m in _pattern().finditer(text):
        starts.append(m.start())
        ends.append(m.end())
    if not last:
        # The last match touches the end; the one before may have ended by looking ahead to it.
        starts = starts[:-1]
    return np.array(starts, np.int64) + chunk


def cuts(text_of, starts: list[np.ndarray], length: int, chunk_chars: int) -> list[int]:
    """True pre-token starts, one near each chunk's beginning, at which the text may be cut.

    ``starts[k]`` are the boundaries found by chunk k. Chunk 0 begins at a true boundary.
    Chunk k takes over at the first boundary that it shares with the true ones before it."""
    out = [0]
    true = starts[0]
    for k in range(1, len(starts)):
        shared = np.intersect1d(true, starts[k][1:], assume_unique=True)  # the first may be cut off
        if len(shared):
            out.append(int(shared[0]))
            true = starts[k][np.searchsorted(starts[k], shared[0]) :]
        else:  # no agreement in the overlap: read on from the last true boundary
            end = min(length, (k + 1) * chunk_chars + OVERLAP_CHARS)
            begin = int(true[-1]) if len(true) else out[-1]
            true = boundaries(text_of(begin, end), begin, end == length)
            if not len(true):
                true = np.array([begin], np.int64)
    return out


# ------------------------------------------------------------------ Spark
RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encode_documents(documents: DataFrame, path: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(row, doc_id, part, n_parts, ids array<int>): the ids of every whole text, long texts
    as several parts in order. ``row`` tells the long texts apart (NULL for the others)."""
    path = path or vocabulary_path()
    rows = _rows(documents)
    short = rows.where(F.length("text") <= chunk_chars).select(
        F.lit(None).cast("string").alias("row"), "doc_id", F.lit(0).alias("part"), F.lit(1).alias("n_parts"), F.col("text").alias("piece")
    )
    return _encoded(short, path).unionByName(_encoded(long_pieces(rows, chunk_chars), path))


def _encoded(pieces: DataFrame, path: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 500):  # few rows at a time: ids take more memory than their text
                part = batch.slice(k, 500)
                ids = [encode(t, path) for t in part.column("piece").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("row", "doc_id", "part", "n_parts")], pa.array(ids, pa.list_(pa.int32()))],
                    names=["row", "doc_id", "part", "n_parts", "ids"],
                )

    return pieces.mapInArrow(run, "row string, doc_id bigint, part int, n_parts int, ids array<int>")


def long_pieces(rows: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Pieces of the texts of several chunks: chunks spread over all tasks, pre-tokenised,
    gathered by text (boundaries and the text itself, one text a group) and cut."""
    long = rows.where(F.length("text") > chunk_chars).select(
        F.sha2(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text")), 256).alias("row"), "doc_id", "text"
    )
    # repeated rows are cut once and counted
    long = long.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk_chars).cast("int"))).alias("chunk")
    chunks = long.select("row", "doc_id", "copies", F.length("text").alias("length"), chunk, "text").select(
        "row", "doc_id", "copies", "length", "chunk", F.substring("text", F.col("chunk") * chunk_chars + 1, F.lit(chunk_chars + OVERLAP_CHARS)).alias("piece")
    )
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(n, "row", "chunk")

    def mark(batches):
        for batch in batches:
            found = []
            for text, chunk, length in zip(batch.column("piece").to_pylist(), batch.column("chunk").to_pylist(), batch.column("length").to_pylist()):
                at = chunk * chunk_chars
                found.append(boundaries(text, at, at + len(text) >= length).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, "starts"])

    marked = spread.mapInArrow(mark, "row string, doc_id bigint, copies bigint, length int, chunk int, piece string, starts binary")

    def stitch(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        text = "".join(p[:chunk_chars] for p in pdf["piece"])
        starts = [np.frombuffer(s, np.int32).astype(np.int64) for s in pdf["starts"]]
        at = cuts(lambda i, j: text[i:j], starts, len(text), chunk_chars)
        ends = [*at[1:], len(text)]
        pieces = [text[i:j] for i, j in zip(at, ends)]
        one, copies = pdf.iloc[0], int(pdf["copies"].iloc[0])
        return pd.DataFrame({
            "row": [f"{one['row']} {c}" for c in range(copies) for _ in pieces], "doc_id": pd.array([one["doc_id"]] * copies * len(pieces), "Int64"),
            "part": list(range(len(pieces))) * copies, "n_parts": len(pieces), "piece": pieces * copies,
        })

    return marked.groupBy("row").applyInPandas(stitch, "row string, doc_id bigint, part int, n_parts int, piece string").repartition(n, "row", "part")


def encode_digests(documents: DataFrame, path: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per row of ``documents``: number of ids, digest of the ids, digest of the
    bytes that the ids decode to."""
    path = path or vocabulary_path()
    rows = _rows(documents)

    def whole(batches):
        for batch in batches:
            out = {"doc_id": batch.column("doc_id").to_pylist(), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in batch.column("text").to_pylist():
                ids = encode(text, path)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(_sha(",".join(map(str, ids)).encode()))
                out["decoded_sha256"].append(_sha(decode(ids, path)))
            yield pa.RecordBatch.from_pydict(out, schema=_RESULT)

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        h, d, n = hashlib.sha256(), hashlib.sha256(), 0
        for ids in pdf["ids"]:
            h.update((b"," if n and len(ids) else b"") + ",".join(map(str, ids)).encode())
            d.update(decode([int(i) for i in ids], path))
            n += len(ids)
        return pd.DataFrame({"doc_id": pd.array([pdf["doc_id"].iloc[0]], "Int64"), "n_tokens": [n], "ids_sha256": [h.hexdigest()], "decoded_sha256": [d.hexdigest()]})

    one = rows.where(F.length("text") <= chunk_chars).mapInArrow(whole, RESULT)
    many = _encoded(long_pieces(rows, chunk_chars), path).groupBy("row").applyInPandas(joined, RESULT)
    return one.unionByName(many)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every whole text of ``documents``."""
    return encode_digests(table(spark, sf_dir, "documents"))
