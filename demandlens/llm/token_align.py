"""Alignment of two tokenizations of the same texts, and corpus-wide counts of linked ids.

Every text is cut at the single spaces between two other characters (units). Neither
tokenizer joins across such a place: side A's pattern begins a pre-token there and no piece
of side B holds a space behind another character (:func:`piece_model` checks that; if one
did, whole texts would be the units), so the units' ids are the whole text's ids. Units are
encoded once per task and remembered (a bounded store).

Runs of units form lanes. A state vector (pointer into A, pointer into B per lane) advances
all lanes of a batch at once: every step emits each lane's link (the two tokens overlap), a
cut where both tokens end, moves the pointer that ends first (both at a cut) and drops
finished lanes. Links become counts of id pairs per document; pairs are counted over the
corpus by partial aggregates, and joined back: the most frequent ones (a fixed number) by
broadcast, so no key of the other join is a hot one, all others by shuffle.

Defined results: a NULL or empty text, and one whose tokens do not give its bytes back, has no
tokens (zeros, digest ''); every row is a document of its own, repeated rows and NULL ids
too; a very long text is encoded unit by unit and aligned in slices of ``SLICE_CHARS``, what
grows with it are its bytes and its distinct pairs (a run without a cut is one unit, which the
libraries take whole); an empty table gives an empty result; of the input only ``doc_id`` and
``text`` are read. The vocabularies' paths are parameters.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.tables import table
from demandlens.session import materialize

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Characters of a lane, and of one round of lanes (a longer text takes several rounds).
LANE_CHARS = 512
SLICE_CHARS = 1 << 20
#: Units that a task remembers, and their tokens; the store is emptied beyond that.
STORED_UNITS = 1 << 19
STORED_TOKENS = 1 << 24
#: Pairs that are broadcast (17 bytes each); the others are joined by shuffle.
FREQUENT_PAIRS = 1 << 20

_CUT = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class Vocabulary:
    """One side: ids of units (each stands behind a space) and the bytes of every id."""

    encode: Callable[[list[str]], list[list[int]]]
    token: list[bytes]
    cuts: bool = True

    def __post_init__(self):
        self.size = np.fromiter(map(len, self.token), np.int64, len(self.token))


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    alphabet = _byte_of_char()
    token = [b""] * t.get_vocab_size()
    for entry, i in t.get_vocab().items():
        token[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()

    def encode(units: list[str]) -> list[list[int]]:
        return [e.ids for e in t.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]

    return Vocabulary(encode, token)


@lru_cache(maxsize=2)
def piece_model(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    token = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    joins = any("▁" in p.lstrip("▁") for p in pieces)
    return Vocabulary(lambda units: model.encode(units, num_threads=1), token, not joins)


class _Rows:
    """Rows of 32-bit ids, appended in batches and read by number."""

    def __init__(self):
        self.ids, self.ends = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)
        self.n_ids = self.n = 0

    def append(self, rows: list[list[int]]) -> np.ndarray:
        """Add rows; returns their lengths."""
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        total = int(lengths.sum())
        self.ids, self.ends = _room(self.ids, self.n_ids + total), _room(self.ends, self.n + len(rows))
        self.ids[self.n_ids : self.n_ids + total] = np.fromiter(chain.from_iterable(rows), np.int32, total)
        self.ends[self.n : self.n + len(rows)] = self.n_ids + np.cumsum(lengths)
        self.n_ids, self.n = self.n_ids + total, self.n + len(rows)
        return lengths

    def read(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the rows in order, end of each row among them)."""
        starts = np.where(numbers > 0, self.ends[numbers - 1], 0)
        lengths = self.ends[numbers] - starts
        ends = np.cumsum(lengths)
        return self.ids[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])], ends


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


class Units:
    """The remembered units of a task: ids on both sides, and whether both give the bytes back."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.vocabularies = (a, b)
        self._empty()

    def _empty(self) -> None:
        self.at: dict[str, int] = {}
        self.sides = (_Rows(), _Rows())
        self.ok = np.zeros(1 << 14, bool)

    def lookup(self, units: list[str]) -> np.ndarray:
        """Number of every unit in the store."""
        if self.sides[0].n > STORED_UNITS or self.sides[0].n_ids + self.sides[1].n_ids > STORED_TOKENS:
            self._empty()
        at = self.at
        new = [u for u in dict.fromkeys(units) if u not in at]
        if new:
            n = len(at)
            at.update(zip(new, range(n, n + len(new))))
            self.ok = _room(self.ok, n + len(new))
            want = [b" " + u.encode() for u in new]
            self.ok[n : n + len(new)] = np.logical_and(*[self._append(k, new, want) for k in (0, 1)])
        return np.fromiter(map(at.__getitem__, units), np.int64, len(units))

    def _append(self, side: int, new: list[str], want: list[bytes]) -> np.ndarray:
        """Encode units on one side; tells which give their bytes back."""
        v = self.vocabularies[side]
        rows = v.encode(new)
        lengths = self.sides[side].append(rows)
        sizes = np.concatenate([[0], np.cumsum(v.size[np.fromiter(chain.from_iterable(rows), np.int64, int(lengths.sum()))])])
        ends = np.cumsum(lengths)
        same = sizes[ends] - sizes[ends - lengths] == np.fromiter(map(len, want), np.int64, len(want))
        if same.all() and b"".join(map(v.token.__getitem__, chain.from_iterable(rows))) == b"".join(want):
            return same
        return np.fromiter((b"".join(map(v.token.__getitem__, ids)) == w for ids, w in zip(rows, want)), bool, len(want))


def lockstep(end_a: np.ndarray, end_b: np.ndarray, lanes_a: np.ndarray, lanes_b: np.ndarray):
    """Links and cuts of all lanes. ``end_*``: byte at which each token ends; ``lanes_*``: the
    lanes' first tokens and one past the last lane's. Returns the links' A and B tokens and, in
    order, the tokens one past each cut on either side."""
    i, j, stop = lanes_a[:-1].copy(), lanes_b[:-1].copy(), lanes_a[1:].copy()
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        a, b = end_a[i], end_b[j]
        i, j = i + (a <= b), j + (b <= a)
        cut = a == b
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    return np.concatenate(links_a), np.concatenate(links_b), np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


@dataclass
class Slice:
    """What a slice of a text (the whole of most) adds to its document."""

    n: tuple[int, int, int, int]  # tokens of A, of B, groups, links
    groups: bytes
    pairs: np.ndarray  # A id << 32 | B id, ascending
    times: np.ndarray


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_level(path_a), piece_model(path_b)
        self.units = Units(self.a, self.b)
        number = [str(i).encode() for i in range(max(len(self.a.token), len(self.b.token)))]
        na, nb = len(self.a.token), len(self.b.token)
        # The text of a token in a group list: id and what follows it.
        self.written = [n + b"," for n in number[:na]] + [n + b"|" for n in number[:na]] + [n + b"," for n in number[:nb]] + [n + b";" for n in number[:nb]]

    def split(self, text: str) -> list[str]:
        return _CUT.split(text) if self.a.cuts and self.b.cuts else [text]

    def round(self, slices: list[list[str]]) -> list[Slice | None]:
        """Align slices (lists of units); None for one that does not give its bytes back."""
        flat = [u for units in slices for u in units]
        numbers = self.units.lookup(flat)
        ok = self.units.ok[numbers]
        first = np.concatenate([[0], np.cumsum([len(s) for s in slices])])
        good = np.logical_and.reduceat(ok, first[:-1])
        out: list[Slice | None] = [None] * len(slices)
        use = np.flatnonzero(good)
        if not len(use):
            return out
        keep = np.repeat(good, np.diff(first))
        numbers = numbers[keep]
        chars = np.fromiter(map(len, flat), np.int64, len(flat))[keep]
        ids_a, ends_a = self.units.sides[0].read(numbers)
        ids_b, ends_b = self.units.sides[1].read(numbers)
        # Units at which the used slices begin, and those at which lanes do.
        slice_at = np.concatenate([[0], np.cumsum(np.diff(first)[use])])
        within = np.cumsum(chars) - chars
        lane = within // LANE_CHARS
        new_lane = np.concatenate([[True], lane[1:] != lane[:-1]])
        new_lane[slice_at[:-1]] = True
        lanes = np.flatnonzero(new_lane)
        to_a, to_b = np.concatenate([[0], ends_a]), np.concatenate([[0], ends_b])
        end = len(numbers)
        link_a, link_b, cut_a, cut_b = lockstep(
            np.cumsum(self.a.size[ids_a]), np.cumsum(self.b.size[ids_b]), to_a[[*lanes, end]], to_b[[*lanes, end]])
        # Group lists: a group's A tokens follow the B tokens of the groups before, its B tokens follow its A tokens.
        na, nb = len(self.a.token), len(self.b.token)
        group_a = np.searchsorted(cut_a, np.arange(len(ids_a)), side="right")
        group_b = np.searchsorted(cut_b, np.arange(len(ids_b)), side="right")
        before_b = np.concatenate([[0], cut_b])
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        code_a = ids_a.astype(np.int64)
        code_a[cut_a - 1] += na
        code_b = ids_b + 2 * na
        code_b[cut_b - 1] += nb
        code[np.arange(len(ids_a)) + before_b[group_a]] = code_a
        code[np.arange(len(ids_b)) + cut_a[group_b]] = code_b
        # Pairs of every slice, counted.
        first_a, first_b = to_a[slice_at], to_b[slice_at]
        owner = np.searchsorted(first_a[1:], link_a, side="right")
        keyed = (owner * na + ids_a[link_a]) * nb + ids_b[link_b]
        uniq, times = np.unique(keyed, return_counts=True)
        pair_owner = uniq // (na * nb)
        pair = ((uniq // nb) % na << 32) | uniq % nb
        pair_at = np.searchsorted(pair_owner, np.arange(len(use) + 1))
        n_links = np.bincount(owner, minlength=len(use))
        groups_at = np.searchsorted(cut_a, first_a, side="right")
        written = self.written
        for k, s in enumerate(use.tolist()):
            x, y = pair_at[k], pair_at[k + 1]
            text = b"".join(map(written.__getitem__, code[first_a[k] + first_b[k] : first_a[k + 1] + first_b[k + 1]].tolist()))
            n = (int(first_a[k + 1] - first_a[k]), int(first_b[k + 1] - first_b[k]), int(groups_at[k + 1] - groups_at[k]), int(n_links[k]))
            out[s] = Slice(n, text[:-1], pair[x:y], times[x:y].astype(np.int32))
        return out

    def texts(self, texts: list[str | None]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every text, in order."""
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        open_docs: dict[int, list] = {}

        def flush():
            nonlocal waiting, size
            if waiting:
                for (k, _), s in zip(waiting, self.round([u for _, u in waiting])):
                    self._add(open_docs, k, s)
            waiting, size = [], 0

        done = 0
        for k, text in enumerate(texts):
            if text:
                for units in _slices(self.split(text)):
                    waiting.append((k, units))
                    size += sum(map(len, units))
                    if size >= SLICE_CHARS:
                        flush()
            if not waiting:
                for d in range(done, k + 1):
                    yield _closed(open_docs.pop(d, None))
                done = k + 1
        flush()
        for d in range(done, len(texts)):
            yield _closed(open_docs.pop(d, None))

    @staticmethod
    def _add(open_docs: dict, k: int, s: Slice | None) -> None:
        have = open_docs.get(k)
        if s is None or (have is not None and have[0] is None):
            open_docs[k] = [None]
        elif have is None:
            open_docs[k] = [np.array(s.n, np.int64), hashlib.sha256(s.groups), s.pairs, s.times]
        else:
            have[0] += s.n
            have[1].update(b";" + s.groups)
            pairs, inverse = np.unique(np.concatenate([have[2], s.pairs]), return_inverse=True)
            have[3] = np.bincount(inverse, weights=np.concatenate([have[3], s.times])).astype(np.int32)
            have[2] = pairs


def _slices(units: list[str]) -> Iterator[list[str]]:
    """Runs of units of about SLICE_CHARS characters."""
    i = n = 0
    for j, u in enumerate(units):
        n += len(u) + 1
        if n >= SLICE_CHARS:
            yield units[i : j + 1]
            i, n = j + 1, 0
    if i < len(units):
        yield units[i:]


_NOTHING = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32))


def _closed(doc: list | None) -> tuple:
    if doc is None or doc[0] is None:
        return _NOTHING
    return (*doc[0].tolist(), doc[1].hexdigest(), doc[2], doc[3])


# ------------------------------------------------------------------ Spark
_ROW = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())),
])
ROW = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
#: Rows of a result batch (their pair lists are larger than their texts).
BATCH_ROWS = 256


def align_documents(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per row of ``documents``: numbers of tokens, groups and links, the digest of the
    groups, and the distinct linked id pairs (A id << 32 | B id) with their numbers of links."""
    path_a, path_b = path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B)

    def run(batches):
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(k, BATCH_ROWS)
                rows = list(zip(*aligner.texts(part.column("text").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, f.type) for c, f in zip(rows, list(_ROW)[1:])]], schema=_ROW)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ROW)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents each id pair is linked, and whether that is the
    highest of its A id."""
    counts = materialize(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "align_counts")
    a = F.shiftright("pair", 32)
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))  # one row per id of A's vocabulary
    return counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def with_counts(aligned: DataFrame, frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """``aligned`` (a written table) with ``n_best`` and ``count_sum`` instead of the pairs."""
    rows = aligned.withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "align_rows")
    counts = materialize(pair_counts(rows), "align_best")
    frequent = materialize(counts.orderBy(F.desc("n"), "pair").limit(frequent_pairs), "align_frequent")
    link = F.explode(F.arrays_zip("pairs", "times")).alias("link")
    links = rows.select("row", link).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    found = links.join(F.broadcast(frequent), "pair", "inner")
    if counts.count() > frequent_pairs:
        rare = counts.join(F.broadcast(frequent.select("pair")), "pair", "left_anti")
        other = links.join(F.broadcast(frequent.select("pair")), "pair", "left_anti")
        found = found.unionByName(other.join(rare, "pair"))
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    kept = [c for c in rows.columns if c not in ("pairs", "times", "row")]
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")]
    return rows.select("row", *kept).join(sums, "row", "left").select(*kept, *zero)


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the byte-level and the piece tokenization of every whole text of ``documents``."""
    out = with_counts(align_documents(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
