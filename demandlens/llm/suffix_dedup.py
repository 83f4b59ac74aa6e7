"""Removal of repeated byte strings by sparse prefix doubling.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier in the
corpus. Ranks are content names: the rank of a doubled length is the pair of ranks at a
position and one length further on. Spark sorts (rank, position) pairs at growing lengths
and drops the positions whose rank is unique:

1. Length 32, at anchors only. The anchor of a window of LENGTH bytes is its smallest
   32-byte rank, so equal windows have anchors at equal places and every window has one;
   anchors are 1 in 35 positions. The windows of an anchor are a run of starts; the name of
   the bytes they span tells whether all of them repeat an earlier run.
2. Length LENGTH, only at the windows of anchors whose rank is shared by differing runs
   (the edges of repeated passages): every one that is not the first of its rank goes. Equal
   windows have equal anchors, so the bytes of such runs are sorted by the anchor's rank
   once more and ranked where they meet.

Equal runs of one Arrow batch are reduced to their first before they are shuffled. A rank
with many differing runs (the edges of a passage that very many documents share) is dealt by
run at first and by the ranks of its windows then, equal ones of a batch again reduced to
their first, so it meets in no task. Texts travel compressed. Equality of strings is
equality of 64-bit ranks.

Defined results: a NULL text is empty; texts shorter than LENGTH stay whole; matches never
cross documents; a NULL doc_id stands after all others; different texts of one doc_id are
documents of their own, in an order of their digests, and equal rows of one doc_id are one
document with one result each; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlens.llm.tables import order_id, original_id, table
from demandlens.llm.text import U64, RangeHash, as_bytes, blocks, mix
from demandlens.session import materialize

# Fixed value of the rule.
LENGTH = 100
#: Length of an anchor's rank.
SHORT = 32
#: Differing runs of one rank in a batch from which on they are dealt by run.
MANY_RUNS = 8
#: Differing runs of one rank in all from which on their windows are dealt apart.
CROWD = 2000

_FIRST = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 256, dtype=np.uint64)
_DOUBLE = np.random.Generator(np.random.PCG64(8)).integers(0, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)


def ranks(buf: np.ndarray, length: int) -> np.ndarray:
    """The rank of the ``length`` bytes from every position on, by doubling; the last step
    pairs two ranks that overlap where the length is no power of two."""
    if len(buf) < length:
        return np.zeros(0, np.uint64)
    r, have, level = _FIRST[buf], 1, 0
    while 2 * have <= length:
        r = r[:-have] * _DOUBLE[level] + r[have:]
        have, level = 2 * have, level + 1
    if have < length:
        n = len(buf) - length + 1
        r = r[:n] * _DOUBLE[level] + r[length - have : length - have + n]
    return mix(r)


def anchors(texts: list[bytes], length: int = LENGTH):
    """(text index, rank, run name, first window start, further windows) of the anchors of a
    block of texts."""
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    buf = np.frombuffer(b"".join(texts), np.uint8)
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    r = ranks(buf, SHORT)
    bits = U64((1 << max(int(n).bit_length(), 1)) - 1)
    low = (r & ~bits) | np.arange(len(r), dtype=np.uint64)  # leftmost of equal ranks
    have, width = 1, length - SHORT + 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    m = n - length + 1
    low = np.minimum(low[:m], low[width - have : width - have + m])
    inside = np.zeros(n + 1, np.int64)
    long = np.flatnonzero(np.diff(starts) >= length)
    inside[starts[long]] += 1
    inside[starts[long + 1] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(inside[:m]) > 0)
    if not len(at):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    owner = (low[at] & bits).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.concatenate([new[1:], [len(at)]]) - 1
    first, more, owner = at[new], at[last] - at[new], owner[new]
    text = np.searchsorted(starts, first, side="right") - 1
    name = RangeHash(buf).of(first, first + more + length)
    name = mix(name + ((owner - first) * 256 + more).astype(np.uint64))
    return text, r[owner], name, first - starts[text], more


# ------------------------------------------------------------------ positions
def version(text: bytes) -> int:
    """64 bits that tell different texts of one doc_id apart; they also are their order."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)


def pack(first, more):
    """Window start and number of further windows in one BIGINT, in this order."""
    return (first << 8) | more


def _local_first(key: np.ndarray, doc: np.ndarray, ver: np.ndarray, at: np.ndarray):
    """Of a batch's rows: (rows in order, is first of its key, repeats the first's key but
    not its position). Equal rows count once: of them neither holds but for one."""
    order = np.lexsort((at, ver, doc, key))
    k, d, v, a = key[order], doc[order], ver[order], at[order]
    head = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(head, np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)
    later = (d != d[lead]) | (v != v[lead]) | (a != a[lead])
    return order, head, later


_ANCHOR = "rank bigint, run bigint, doc bigint, version bigint, at bigint, kind int"
# kinds: a run to be sorted; one dealt by run, its rank known to be shared by differing runs;
# a mark that tells so to the other batches; a run known to repeat an earlier one
SORTED, DEALT, MARK, REPEATED = range(4)


def _anchor_rows(batches):
    for batch in batches:
        docs, texts = np.array(batch.column("doc").to_pylist(), np.int64), as_bytes(batch.column("text").to_pylist())
        parts = []
        for i, j in blocks(texts):
            text, rank, run, first, more = anchors(texts[i:j])
            if len(text):
                v = np.fromiter((version(t) for t in texts[i:j]), np.int64, j - i)
                parts.append((rank, run, docs[i:j][text], v[text], pack(first, more)))
        if not parts:
            continue
        rank, run, doc, ver, at = (np.concatenate(x) for x in zip(*parts))
        key = mix(rank) + run
        order, head, later = _local_first(key, doc, ver, at)
        rank, run, doc, ver, at, key = rank[order], run[order], doc[order], ver[order], at[order], key[order]
        kind = np.where(later, REPEATED, SORTED).astype(np.int32)
        keep = head | later
        group = np.where(later, key ^ at.astype(np.uint64), rank)  # what is settled is dealt anywhere
        # ranks with many differing runs in this batch
        ranked, back, count = np.unique(rank[head], return_inverse=True, return_counts=True)
        many = np.zeros(len(rank), bool)
        many[np.flatnonzero(head)] = (count >= MANY_RUNS)[back]
        kind[many] = DEALT
        group = np.where(many, key, group)
        marks = np.repeat(ranked[count >= MANY_RUNS], 2)
        two = np.tile(np.array([-1, -2], np.int64), len(marks) // 2)
        zero = np.zeros(len(marks), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([group[keep].view(np.int64), marks.view(np.int64)])),
                pa.array(np.concatenate([run[keep].view(np.int64), two])),
                pa.array(np.concatenate([doc[keep], zero])),
                pa.array(np.concatenate([ver[keep], zero])),
                pa.array(np.concatenate([at[keep], zero])),
                pa.array(np.concatenate([kind[keep], np.full(len(marks), MARK, np.int32)])),
            ],
            names=["rank", "run", "doc", "version", "at", "kind"],
        )


_PIECE = "rank bigint, doc bigint, version bigint, at bigint, piece binary, repeated boolean"
_PIECES = pa.schema([("rank", pa.int64()), ("doc", pa.int64()), ("version", pa.int64()), ("at", pa.int64()), ("piece", pa.binary()), ("repeated", pa.bool_())])


def _edge_rows(batches):
    """The edge runs of each text: their bytes by the anchor's rank, or the full-length ranks
    of their windows where the anchor's rank is crowded."""
    for batch in batches:
        cold, parts, held = [], [], 0
        for doc, ver, z, runs in zip(*[batch.column(c).to_pylist() for c in ("doc", "version", "z", "runs")]):
            text = zstandard.decompress(z)
            at = np.array([r["at"] for r in runs], np.int64)
            crowded = np.array([r["crowded"] for r in runs], bool)
            first, more = (at >> 8) & 0xFFFFFFFF, at & 0xFF
            cold += [(r["rank"], doc, ver, r["at"], text[f : f + m + LENGTH]) for r, f, m, c in zip(runs, first.tolist(), more.tolist(), crowded) if not c]
            if crowded.any():
                p = _windows(first[crowded], more[crowded])
                parts.append((ranks(np.frombuffer(text, np.uint8), LENGTH)[p], np.full(len(p), doc, np.int64), np.full(len(p), ver, np.int64), pack(p, 0)))
                held += len(p)
            if len(cold) + held > 1 << 19:
                yield from _edge_batches(cold, parts)
                cold, parts, held = [], [], 0
        yield from _edge_batches(cold, parts)


def _windows(first: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The window starts of some runs, in order."""
    n = more + 1
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def _edge_batches(cold, parts):
    if cold:
        rank, doc, ver, at, piece = zip(*cold)
        yield pa.RecordBatch.from_arrays([pa.array(rank, pa.int64()), pa.array(doc, pa.int64()), pa.array(ver, pa.int64()), pa.array(at, pa.int64()), pa.array(piece, pa.binary()), pa.array([False] * len(rank))], schema=_PIECES)
    if parts:
        rank, doc, ver, at = (np.concatenate(x) for x in zip(*parts))
        order, head, later = _local_first(rank, doc, ver, at)
        keep = head | later
        rank, doc, ver, at, later = (x[keep] for x in (rank[order], doc[order], ver[order], at[order], later))
        rank = np.where(later, rank ^ mix(at.astype(np.uint64)), rank)  # what is settled is dealt anywhere
        yield pa.RecordBatch.from_arrays([pa.array(rank.view(np.int64)), pa.array(doc), pa.array(ver), pa.array(at), pa.nulls(len(rank), pa.binary()), pa.array(later)], schema=_PIECES)


def _settle(batches):
    """Of rows sorted by rank: the windows that are not the first of theirs, as runs."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        rank = batch.column("rank").to_numpy()
        new = int(np.searchsorted(rank, rank[-1]))  # the batch's last rank may go on
        if held and (rank[0] != last or new):
            own = int(np.searchsorted(rank, last, side="right")) if rank[0] == last else 0
            yield from _repeats([*held, batch.slice(0, own)])
            held = []
            batch, new = batch.slice(own), new - own
        if new > 0:
            yield from _repeats([batch.slice(0, new)])
            batch = batch.slice(new)
        held.append(batch)
        last = rank[-1]
    if held:
        yield from _repeats(held)


def _repeats(batches):
    rank, doc, ver, at, repeated = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in batches]) for c in ("rank", "doc", "version", "at", "repeated"))
    pieces = [x for b in batches for x in b.column("piece").to_pylist()]
    cold = np.array([x is not None for x in pieces], bool)
    own_rank = ~cold & ~repeated
    wr, wd, wv, wa = [rank[own_rank].view(np.uint64)], [doc[own_rank]], [ver[own_rank]], [at[own_rank]]
    if cold.any():
        own = [x for x in pieces if x is not None]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in own])[:-1]]).astype(np.int64)
        first, more = (at[cold] >> 8) & 0xFFFFFFFF, at[cold] & 0xFF
        wr.append(ranks(np.frombuffer(b"".join(own), np.uint8), LENGTH)[_windows(starts, more)])
        wd.append(np.repeat(doc[cold], more + 1))
        wv.append(np.repeat(ver[cold], more + 1))
        wa.append(pack(_windows(first, more), 0))
    wr, wd, wv, wa = (np.concatenate(x) for x in (wr, wd, wv, wa))
    order, _, later = _local_first(wr, wd, wv, wa)
    d, v, a = (np.concatenate([w[order][later], x[repeated]]) for w, x in ((wd, doc), (wv, ver), (wa, at)))
    if not len(d):
        return
    # windows one after the other are one run (of 256 at most)
    order = np.lexsort((a, v, d))
    d, v, a = d[order], v[order], a[order]
    cut_ = np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1]) | (a[1:] != a[:-1] + 256)])
    lead = np.maximum.accumulate(np.where(cut_, np.arange(len(d)), 0))
    head = np.flatnonzero((np.arange(len(d)) - lead) % 256 == 0)
    more = np.diff(np.concatenate([head, [len(d)]])) - 1
    yield pa.RecordBatch.from_arrays([pa.array(d[head]), pa.array(v[head]), pa.array(a[head] + more)], names=["doc", "version", "at"])


def _packed_texts(documents: DataFrame) -> DataFrame:
    """(doc, version, z): every text compressed."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = as_bytes(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array([version(t) for t in texts], pa.int64()), pa.array([packer.compress(t) for t in texts], pa.binary())], names=["doc", "version", "z"]
            )

    return _ided(documents).mapInArrow(run, "doc bigint, version bigint, z binary")


def _ided(documents: DataFrame) -> DataFrame:
    return documents.select(order_id("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))


def _by_text(rows: DataFrame, name: str) -> DataFrame:
    """(doc, version, name array): the positions of every text that has some."""
    return rows.groupBy("doc", "version").agg(F.collect_list("at").alias(name))


def repeated_windows(documents: DataFrame) -> DataFrame:
    """(doc, version, at): runs of windows that start earlier too, in packed positions."""
    place = F.struct("doc", "version", "at")
    runs = _ided(documents).mapInArrow(_anchor_rows, _ANCHOR)
    of_rank = Window.partitionBy("rank")
    of_run = Window.partitionBy("rank", "run").orderBy("doc", "version", "at")
    seen = runs.withColumn("first", F.first(place).over(of_run))
    for name, value in (("least", F.min("run")), ("most", F.max("run")), ("marked", F.max(F.col("kind") == MARK)), ("size", F.count(F.lit(1)))):
        seen = seen.withColumn(name, value.over(of_rank))
    repeated = (F.col("kind") == REPEATED) | (place != F.col("first"))
    edge = (F.col("kind") == DEALT) | (F.col("least") != F.col("most"))
    crowded = (F.col("kind") == DEALT) | F.col("marked") | (F.col("size") > CROWD)
    settled = seen.where((F.col("kind") != MARK) & (repeated | edge)).select(
        "doc", "version", "at", repeated.alias("repeated"), F.when(~repeated, F.col("rank")).alias("rank"), crowded.alias("crowded")
    )
    settled = materialize(settled, "suffix_runs")

    edges = settled.where("not repeated").distinct().groupBy("doc", "version").agg(F.collect_list(F.struct("at", "rank", "crowded")).alias("runs"))
    pieces = _packed_texts(documents).join(edges, ["doc", "version"]).select("doc", "version", "z", "runs").mapInArrow(_edge_rows, _PIECE)
    more = pieces.repartition("rank").sortWithinPartitions("rank", "doc", "version", "at").mapInArrow(_settle, "doc bigint, version bigint, at bigint")
    return settled.where("repeated").select("doc", "version", "at").union(more)


_RESULT = pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def cut(text: bytes, runs) -> tuple[list[tuple[int, int]], bytes]:
    """(maximal removed spans, remaining bytes) of a text and its packed repeated runs."""
    if not runs:
        return [], text
    runs = np.unique(np.array(runs, np.int64))
    cover = np.zeros(len(text) + 1, np.int64)
    first = runs >> 8
    np.add.at(cover, first, 1)
    np.add.at(cover, first + (runs & 0xFF) + LENGTH, -1)
    gone = np.cumsum(cover[:-1]) > 0
    edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
    spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
    return spans, np.frombuffer(text, np.uint8)[~gone].tobytes()


def remove_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of every row of ``documents``."""
    found = _by_text(materialize(repeated_windows(documents), "suffix_windows"), "runs")

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                out = {"doc": part.column("doc").to_pylist(), "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
                for z, runs in zip(part.column("z").to_pylist(), part.column("runs").to_pylist()):
                    text = zstandard.decompress(z)
                    spans, kept = cut(text, runs)
                    for c, x in zip(("n_bytes", "n_removed", "n_spans", "kept"), (len(text), len(text) - len(kept), len(spans), kept)):
                        out[c].append(x)
                yield pa.RecordBatch.from_pydict(out, schema=_RESULT)

    rows = _packed_texts(documents).join(found, ["doc", "version"], "left").select("doc", "z", "runs")
    out = rows.mapInArrow(run, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return out.select(original_id("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of 100-byte repeats from every whole text of ``documents``: counts and the
    digest of what stays."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
