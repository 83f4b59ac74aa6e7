"""Line de-duplication with sharded cuckoo filters over exact reference counts.

The index keeps, per normalised line (its key), the exact set of documents that hold it.
From it come the reference counts (documents per key, first document) and, per shard of the
key space, a cuckoo filter of the shared keys (two documents or more). New documents add
references and fingerprints, deleted ones take theirs back, so line de-duplication can be
undone. Asked about documents, the filters pass over the lines that no other document holds;
the others are joined with the exact counts, so a false positive of a filter changes nothing.

A hot line is reduced map-side before it is shuffled (counts) and its documents are spread
by a salt where they meet the counts (removals). The filters together take a byte or two per
shared key; they are sent to the tasks only while that is below ``max_filter_bytes``;
beyond it every line goes to the join.

Defined results: a NULL or empty text is one empty line; a NULL doc_id is a document after
all others; rows of one doc_id are one document; repeated lines inside one document do not
count as shared; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.tables import order_id, original_id, table
from demandlens.llm.text import U64, as_bytes, mix as mix64
from demandlens.session import materialize

# Fixed values of the rule.
MIN_POINTS = 10

#: Shared keys of one filter shard, about.
KEYS_PER_SHARD = 200_000
MAX_FILTER_BYTES = 64 << 20
_SLOTS = 4
_KICKS = 500


# ------------------------------------------------------------------ cuckoo filter
class CuckooFilter:
    """Partial-key cuckoo filter: 16-bit fingerprints, four to a bucket, insert and delete.

    Keys are 64-bit hashes. Fingerprints that find no place after many moves go to an exact
    overflow list, so no key is ever lost."""

    def __init__(self, capacity: int):
        n = 1
        while n * _SLOTS * 0.9 < max(capacity, 1):
            n *= 2
        self.table = np.zeros((n, _SLOTS), np.uint16)
        self.overflow: list[int] = []

    def _place(self, keys: np.ndarray):
        fp = ((keys >> U64(48)) % U64(65535) + U64(1)).astype(np.uint16)
        mask = U64(len(self.table) - 1)
        first = (keys & mask).astype(np.int64)
        second = (first.astype(np.uint64) ^ mix64(fp.astype(np.uint64)) & mask).astype(np.int64)
        return fp, first, second

    def insert(self, key: int) -> None:
        fp, first, second = (int(x[0]) for x in self._place(np.array([key], np.uint64)))
        mask = len(self.table) - 1
        for at in (first, second):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = fp
                return
        at = second
        moved = []
        for k in range(_KICKS):
            slot = k % _SLOTS
            out = int(self.table[at, slot])
            moved.append((at, slot, out))
            self.table[at, slot] = fp
            fp, at = out, at ^ int(mix64(np.array([out], np.uint64))[0] & U64(mask))
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = fp
                return
        for at, slot, out in reversed(moved):  # undo: this key goes to the exact list
            self.table[at, slot] = out
        self.overflow.append(int(key))

    def insert_all(self, keys: np.ndarray) -> None:
        """Insert many: free slots of the first and second buckets are filled a round at a
        time for all keys together, the few left over one by one."""
        left = keys
        for _ in range(2 * _SLOTS):
            if not len(left):
                return
            fp, first, second = self._place(left)
            room1 = (self.table[first] == 0).any(1)
            room2 = (self.table[second] == 0).any(1)
            at = np.where(room1, first, second)
            able = room1 | room2
            _, lead = np.unique(np.where(able, at, -1 - np.arange(len(at))), return_index=True)
            lead = lead[able[lead]]
            self.table[at[lead], (self.table[at[lead]] == 0).argmax(1)] = fp[lead]
            rest = np.ones(len(left), bool)
            rest[lead] = False
            left = left[rest]
        for key in left:
            self.insert(int(key))

    def delete(self, key: int) -> bool:
        """Take one inserted key back."""
        if key in self.overflow:
            self.overflow.remove(key)
            return True
        fp, first, second = (x[0] for x in self._place(np.array([key], np.uint64)))
        for at in (first, second):
            hit = np.flatnonzero(self.table[at] == fp)
            if len(hit):
                self.table[at, hit[0]] = 0
                return True
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        fp, first, second = self._place(keys)
        found = (self.table[first] == fp[:, None]).any(1) | (self.table[second] == fp[:, None]).any(1)
        return found | np.isin(keys, np.array(self.overflow, np.uint64)) if self.overflow else found

    def dumps(self) -> bytes:
        return np.int64(len(self.table)).tobytes() + self.table.tobytes() + np.array(self.overflow, np.uint64).tobytes()

    @classmethod
    def loads(cls, data: bytes) -> CuckooFilter:
        out = cls(0)
        n = int(np.frombuffer(data[:8], np.int64)[0])
        end = 8 + n * _SLOTS * 2
        out.table = np.frombuffer(data[8:end], np.uint16).reshape(n, _SLOTS).copy()
        out.overflow = [int(x) for x in np.frombuffer(data[end:], np.uint64)]
        return out


# ------------------------------------------------------------------ lines and keys
def line_key(line: bytes) -> bytes | None:
    """The digest of a line's key; None for a key too short to count."""
    key = line.strip(b" \t\n\r\x0b\x0c").lower()  # both work on ASCII only for bytes
    if len(key) < MIN_POINTS or len(key) < 4 * MIN_POINTS and len(key.decode("utf-8")) < MIN_POINTS:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def key_hash(keys: list[bytes]) -> np.ndarray:
    """64 bits of each key digest."""
    return np.frombuffer(b"".join(k[:8] for k in keys), np.uint64)


def key_shard(keys: list[bytes], n_shards: int) -> np.ndarray:
    return np.frombuffer(b"".join(k[8:12] for k in keys), ">u4") % n_shards


def _ided(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(order_id("doc_id").alias("doc"), _part(text), text.alias("text"))


def _part(text):
    """Tells the rows of one document apart. Rows that share it lose the same keys, which is
    right for all rows of a document."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("part")


def _key_rows(batches):
    for batch in batches:
        docs, keys = [], []
        for doc, text in zip(batch.column("doc").to_pylist(), as_bytes(batch.column("text").to_pylist())):
            own = {k for k in map(line_key, text.split(b"\n")) if k is not None}
            docs += [doc] * len(own)
            keys += own
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(keys, pa.binary())], names=["doc", "key"])


def references(documents: DataFrame) -> DataFrame:
    """(doc, key): every key of every document (a document's rows may repeat it)."""
    return _ided(documents).drop("part").mapInArrow(_key_rows, "doc bigint, key binary")


# ------------------------------------------------------------------ index
class LineIndex:
    """The reference counts of a corpus and its filters.

    ``refs`` (doc, key) is the exact table, distinct; ``counts`` (key, n_docs, first_doc) and
    ``filters`` (shard, data) follow from it. Every change writes new tables under the shared
    checkpoint folder and returns a new index; the old one stays valid."""

    def __init__(self, refs: DataFrame, counts: DataFrame, filters: DataFrame, n_shards: int):
        self.refs, self.counts, self.filters, self.n_shards = refs, counts, filters, n_shards

    @classmethod
    def build(cls, documents: DataFrame) -> LineIndex:
        """The index of some documents, from nothing. The exact table is stated lazily: only
        its counts are written, which is all that de-duplication reads."""
        refs = references(documents).distinct()
        counts = materialize(_counts(refs), "line_counts")
        shared = counts.where("n_docs >= 2").count()
        n = max(1, -(-shared // KEYS_PER_SHARD))
        return cls(refs, counts, _filters(counts, n), n)

    def insert(self, documents: DataFrame) -> LineIndex:
        """The index with the documents' references added. Counts and fingerprints change
        only for keys that the new documents hold."""
        new = materialize(references(documents).distinct().join(self.refs, ["doc", "key"], "left_anti"), "line_new")
        delta = _counts(new).withColumnsRenamed({"n_docs": "dn", "first_doc": "df"})
        both = self.counts.join(delta, "key", "full")
        merged = both.select(
            "key",
            (F.coalesce("n_docs", F.lit(0)) + F.coalesce("dn", F.lit(0))).alias("n_docs"),
            F.least("first_doc", "df").alias("first_doc"),
            F.coalesce("n_docs", F.lit(0)).alias("was"),
        )
        return self._changed(materialize(self.refs.union(new), "line_refs"), merged)

    def delete(self, documents: DataFrame) -> LineIndex:
        """The index without the documents of these ids. Keys they held get their first
        document from the references that stay."""
        gone = documents.select(order_id("doc_id").alias("doc")).distinct()
        refs = materialize(self.refs.join(gone, "doc", "left_anti"), "line_refs")
        touched = self.refs.join(gone, "doc", "left_semi").select("key").distinct()
        after = _counts(refs.join(touched, "key", "left_semi"))
        was = F.col("n_docs").alias("was")
        same = self.counts.join(touched, "key", "left_anti").select("key", "n_docs", "first_doc", was)
        changed = touched.join(self.counts.select("key", was), "key").join(after, "key", "left").select(
            "key", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "first_doc", "was"
        )
        return self._changed(refs, same.union(changed))

    def _changed(self, refs: DataFrame, merged: DataFrame) -> LineIndex:
        merged = materialize(merged, "line_merged")
        counts = merged.where("n_docs > 0").select("key", "n_docs", "first_doc")
        need = -(-counts.where("n_docs >= 2").count() // KEYS_PER_SHARD)
        if need > 2 * self.n_shards:  # the shards have outgrown their filters
            return LineIndex(refs, counts, _filters(counts, need), need)
        moves = merged.where("(n_docs >= 2) <> (was >= 2)").select(
            _shard(F.col("key"), self.n_shards).alias("shard"), F.substring("key", 1, 8).alias("key"), (F.col("n_docs") >= 2).alias("added")
        )

        def update(old: pd.DataFrame, move: pd.DataFrame) -> pd.DataFrame:
            added = move["added"].to_numpy(bool)
            hashes = key_hash(list(move["key"])) if len(move) else np.zeros(0, np.uint64)
            f = CuckooFilter.loads(old["data"].iloc[0]) if len(old) else CuckooFilter(2 * KEYS_PER_SHARD)
            for key in hashes[~added]:
                f.delete(int(key))
            for key in hashes[added]:
                f.insert(int(key))
            shard = int((old if len(old) else move)["shard"].iloc[0])
            return pd.DataFrame({"shard": [shard], "data": [f.dumps()]})

        filters = self.filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInPandas(update, "shard int, data binary")
        return LineIndex(refs, counts, materialize(filters, "line_filters"), self.n_shards)

    # -------------------------------------------------------------- questions
    def _probe(self, max_filter_bytes: int):
        """(n_shards, filters by shard) for the tasks, or None when the filters are too large."""
        size = self.filters.agg(F.sum(F.length("data"))).first()[0] or 0
        if size > max_filter_bytes:
            return None
        return {r.shard: bytes(r.data) for r in self.filters.collect()}

    def removals(self, documents: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
        """(doc, part, gone): the keys whose lines a row loses, because an earlier document of
        the index holds them. A group is one text's keys, however many rows a document has."""
        maybe = materialize(_scan(documents, self._probe(max_filter_bytes), self.n_shards).select("doc", "part", F.explode("keys").alias("key")), "line_maybe")
        shared = self.counts.where("n_docs >= 2").select("key", "first_doc")
        # A hot key's documents meet its count on eight tasks, split on where still uneven.
        salt = F.explode(F.array(*[F.lit(i) for i in range(8)])).alias("salt")
        salted = maybe.withColumn("salt", F.pmod(F.xxhash64("doc", "part"), F.lit(8)).cast("int"))
        lost = salted.join(shared.select("key", "first_doc", salt), ["key", "salt"]).where("first_doc < doc")
        return lost.groupBy("doc", "part").agg(F.collect_set("key").alias("gone"))

    def dedupe(self, documents: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept): every row's text without the lines that an
        earlier document of the index holds; ``kept`` is UTF-8."""
        gone = self.removals(documents, max_filter_bytes)
        return _ided(documents).join(gone, ["doc", "part"], "left").mapInArrow(_drop_lines, "doc bigint, n_lines bigint, n_dropped bigint, kept binary").select(
            original_id("doc").alias("doc_id"), "n_lines", "n_dropped", "kept"
        )


def _counts(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc").alias("first_doc"))


def _shard(key, n: int):
    """The shard of :func:`key_shard` as a column."""
    return (F.conv(F.hex(F.substring(key, 9, 4)), 16, 10).cast("bigint") % n).cast("int")


def _filters(counts: DataFrame, n_shards: int) -> DataFrame:
    keys = counts.where("n_docs >= 2").select(_shard(F.col("key"), n_shards).alias("shard"), F.substring("key", 1, 8).alias("key"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = CuckooFilter(max(2 * len(pdf), 1024))
        f.insert_all(key_hash(list(pdf["key"])))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "data": [f.dumps()]})

    return materialize(keys.groupBy("shard").applyInPandas(build, "shard int, data binary"), "line_filters")


def _scan(documents: DataFrame, filters: dict[int, bytes] | None, n_shards: int) -> DataFrame:
    """(doc, part, keys): per row the distinct keys that a filter takes for shared."""
    shared = documents.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        own = None if shared.value is None else {s: CuckooFilter.loads(d) for s, d in shared.value.items()}
        for batch in batches:
            out = []
            for text in as_bytes(batch.column("text").to_pylist()):
                keys = list({k for k in map(line_key, text.split(b"\n")) if k is not None})
                if keys and own is not None:
                    hashes, shards = key_hash(keys), key_shard(keys, n_shards)
                    hit = np.zeros(len(keys), bool)
                    for s in np.unique(shards):
                        if s in own:
                            hit[shards == s] = own[s].contains(hashes[shards == s])
                    keys = [k for k, h in zip(keys, hit) if h]
                out.append(keys)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("part"), pa.array(out, pa.list_(pa.binary()))], names=["doc", "part", "keys"])

    return _ided(documents).mapInArrow(run, "doc bigint, part bigint, keys array<binary>")


def _drop_lines(batches):
    for batch in batches:
        cols = {"doc": batch.column("doc").to_pylist(), "n_lines": [], "n_dropped": [], "kept": []}
        for text, gone in zip(as_bytes(batch.column("text").to_pylist()), batch.column("gone").to_pylist()):
            lines = text.split(b"\n")
            kept = lines
            if gone:
                gone = set(gone)
                kept = [x for x in lines if line_key(x) not in gone]
            cols["n_lines"].append(len(lines))
            cols["n_dropped"].append(len(lines) - len(kept))
            cols["kept"].append(b"\n".join(kept))
        yield pa.RecordBatch.from_pydict(cols, schema=pa.schema([("doc", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.binary())]))


def drop_shared_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with the shared lines taken out of ``text`` and every other column kept.
    A text that loses no line stays as it is."""
    gone = LineIndex.build(documents).removals(documents)
    text = F.col("text").cast("string")
    rows = documents.select(F.struct("*").alias("_row"), order_id("doc_id").alias("doc"), _part(text), text.alias("text"))
    joined = rows.join(gone, ["doc", "part"], "left")

    def run(batches):
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                if gone and text is not None:
                    gone = set(gone)
                    text = b"\n".join(x for x in text.encode("utf-8").split(b"\n") if line_key(x) not in gone).decode("utf-8")
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string())], names=["_row", "text"])

    row = next(f for f in joined.schema.fields if f.name == "_row").dataType
    out = joined.select("_row", "text", "gone").mapInArrow(run, f"_row {row.simpleString()}, text string")
    return out.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in documents.columns])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared-line removal over every whole text of ``documents``: counts and the digest of
    what stays."""
    documents = table(spark, sf_dir, "documents")
    out = LineIndex.build(documents).dedupe(documents)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line_no
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (first_doc < k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (first_doc IS NULL OR first_doc = k.doc_id), '')) AS kept_sha256
FROM keyed k LEFT JOIN shared s ON s.key = k.key
GROUP BY k.doc_id
"""
