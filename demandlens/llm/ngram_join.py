"""N-gram Jaccard join on prefix trees, and the components of its links.

A document's set holds the hashes of its distinct word n-grams; documents with equal sets
are one class. The join runs in three steps.

1. Routing. For two sets to reach the threshold, their difference (elements of one only) is
   bounded by their sizes. The hash range is cut into one segment more than that bound, so
   two linked sets agree in a whole segment; each set sends a hash of each of its segments.
   Segments are fixed per size band; a set does so for its own band and the next. A segment
   without elements says nothing by itself: it is sent along with the following segment,
   whole and with each element left out, because where only empty segments agree, one of
   the following segments differs by one element at most. No linked pair is missed.
2. Blocks. Classes that sent equal hashes form a block, named by its smallest class. Each
   class first joins its smallest block only; after the components of those links are
   known, just the blocks that still hold several components are joined in full. Blocks are
   split into chunks of bounded size; pairs of chunks are joined in tasks of their own. Before
   either join a task sees the outlines of its sets (numbers of elements by cells of the
   hash); only the sets that these leave a link with another component are made again from
   their texts and travel.
3. Trie. A task stores its sets, in global hash order, in a prefix tree with merged paths.
   Each set walks the tree once: an overlap counted on a shared path counts for every set
   below it, a subtree is left when its remaining lengths cannot bring the overlap to the
   threshold, and when all its sets are in the walker's component already. A task returns
   at most one link less than it has sets, never all pairs of a group.

Links are then closed to components over written tables. Equality of sets and n-grams is
equality of 64-bit hashes. Defined results: a text with fewer words than an n-gram is one
n-gram of all of them; a NULL or empty text has an empty set and links with nothing; a NULL
doc_id stands after all others; rows of one doc_id link by their texts alone; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlens.llm.components import connected
from demandlens.llm.tables import order_id, original_id, table
from demandlens.llm.text import U64, Words, mix, text_blocks
from demandlens.operators.joins import bounded_broadcast
from demandlens.session import materialize, partitions_for, settings

#: n-gram words and least similarity in percent: of the query, and of near duplicates elsewhere.
QUERY_WORDS, QUERY_PERCENT = 4, 85
WORDS, PERCENT = 5, 80

#: Sets of a chunk, and their elements together, about.
CHUNK_SETS = 192
CHUNK_ELEMENTS = 400_000

#: Bytes of text that a task makes sets of at once, and of a batch that Spark hands to it. Two
#: workers and the buffers of their batches stand beside the heap in an executor's memory.
SET_BYTES = 1 << 18
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

#: Partitions of the routes for each of the session's: they are the largest rows that are sorted.
ROUTE_PARTS = 4

#: Logarithms of the bits of the filter of wanted texts, at most, and of its parts.
MAX_FILTER_BITS, PAGE_BITS = 29, 19


# ------------------------------------------------------------------ sets
def ngram_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text of a block."""
    w = Words(texts, lower=True)
    text, h = w.shingles(words)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    text, h = text[new], h[new]
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    out = [h[cut[i] : cut[i + 1]] for i in range(len(texts))]
    for i in np.flatnonzero((w.counts > 0) & (w.counts < words)):
        one = U64(w.counts[i])
        for x in w.hash[w.first[i] : w.first[i + 1]]:
            one = mix(np.array([one + x], np.uint64))[0]
        out[i] = np.array([one], np.uint64)
    return out


def class_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


# ------------------------------------------------------------------ routing
class Bands:
    """Size bands: linked sets are in one band or in neighbouring ones. Band j ends at size
    ``ends[j]``; ``segments(j)`` is one more than the largest difference of linked sets whose
    larger one is in band j."""

    def __init__(self, percent: int):
        self.percent = percent
        self.ends = [1]

    def _more(self) -> None:
        self.ends.append(max(self.ends[-1] + 1, self.ends[-1] * 100 // self.percent))

    def of(self, size: int) -> int:
        while self.ends[-1] < size:
            self._more()
        return bisect_left(self.ends, size)

    def segments(self, band: int) -> int:
        while len(self.ends) <= band:
            self._more()
        return 2 * self.ends[band] * (100 - self.percent) // (100 + self.percent) + 1


def route_hashes(s: np.ndarray, bands: Bands) -> np.ndarray:
    """The hashes that a set sends; linked sets have one in common at least."""
    own = bands.of(len(s))
    element = mix(s + U64(1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(element)])
    return np.concatenate([_segment_hashes(s, element, sums, j, bands.segments(j)) for j in (own, own + 1)])


def _segment_hashes(s: np.ndarray, element: np.ndarray, sums: np.ndarray, band: int, k: int) -> np.ndarray:
    cut = np.searchsorted(((s >> U64(32)) * U64(k)) >> U64(32), np.arange(k + 1, dtype=np.uint64))
    total, count = sums[cut[1:]] - sums[cut[:-1]], np.diff(cut)
    place = mix(np.arange(k, dtype=np.uint64) + (U64(band + 1) << U64(32)))
    whole = mix(total + place * (count.astype(np.uint64) * U64(2) + U64(1)))
    out = [whole[count > 0]]
    for i in np.flatnonzero(count == 0):
        j = (i + 1) % k
        tag = mix(place[i : i + 1] + U64(7))
        out.append(mix(whole[j : j + 1] + tag))
        if count[j]:
            less = total[j : j + 1] - element[cut[j] : cut[j + 1]]
            out.append(mix(mix(less + place[j : j + 1] * U64(2 * int(count[j]) - 1)) + tag))
    return np.concatenate(out)


# ------------------------------------------------------------------ trie
def needed(a, b, percent: int):
    """Least overlap of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


@dataclass
class _Node:
    """A merged path of the tree and the sets lo..hi (in tree order) below it."""

    path: np.ndarray
    lo: int
    hi: int
    end: int  # elements from the root to the end of the path
    least: int  # sizes of the sets
    most: int
    children: list


class PrefixTree:
    """Sorted sets in a prefix tree with merged paths."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        keys = [s.astype(">u8").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        common = [0]
        for x, y in zip(self.order, self.order[1:]):
            a, b = sets[x], sets[y]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            common.append(int(differ[0]) if len(differ) else n)
        self.common, self.sizes = np.array(common), np.array([len(sets[i]) for i in self.order])
        self.root = _Node(np.zeros(0, np.uint64), 0, len(sets), 0, int(self.sizes.min()), int(self.sizes.max()), [])
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node.hi - node.lo > 1:
                # a set that ends here stands first; the others part where neighbours have no more in common
                starts = [node.lo, *(node.lo + 1 + np.flatnonzero(self.common[node.lo + 1 : node.hi] <= node.end)).tolist(), node.hi]
                node.children = [self._node(i, j, node.end) for i, j in zip(starts, starts[1:])]
                todo += node.children

    def _node(self, lo: int, hi: int, depth: int) -> _Node:
        first, sizes = self.sets[self.order[lo]], self.sizes[lo:hi]
        end = len(first) if hi - lo == 1 else min(int(self.common[lo + 1 : hi].min()), int(sizes.min()))
        return _Node(first[depth:end], lo, hi, end, int(sizes.min()), int(sizes.max()), [])

    def walk(self, at: int, percent: int, skip, found) -> None:
        """Call ``found(i)`` for the sets before place ``at`` in tree order that are linked
        with the one there; ``skip(lo, hi)`` tells that a range of places needs no look."""
        x = self.sets[self.order[at]]
        n = len(x)
        todo = [(self.root, 0, 0)]  # with the overlap so far and the elements of x passed
        while todo:
            node, overlap, passed = todo.pop()
            if node.lo >= at or percent * node.least > 100 * n or 100 * node.most < percent * n or skip(node.lo, min(node.hi, at)):
                continue
            if len(node.path):
                rest = x[passed:]
                place = rest.searchsorted(node.path)
                hit = rest.take(place, mode="clip") == node.path if len(rest) else np.zeros(len(place), bool)
                overlap += int(np.count_nonzero(hit))
                passed += int(place[-1]) + int(hit[-1])
            if overlap + min(n - passed, node.most - node.end) < needed(n, node.least, percent):
                continue
            if not node.children:
                if 100 * overlap >= percent * (n + node.least - overlap):
                    found(node.lo)
                continue
            todo += [(child, overlap, passed) for child in reversed(node.children)]


def tree_links(sets: list[np.ndarray], percent: int, labels: list[int] | None = None) -> list[tuple[int, int]]:
    """Links (index pairs) that join the sets of a task to the components they form, given
    the components (``labels``) that they are in already."""
    tree = PrefixTree(sets)
    parent = list(range(len(sets)))  # by place in the tree

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    if labels is not None:
        first: dict[int, int] = {}
        for at, i in enumerate(tree.order):
            parent[top(at)] = top(first.setdefault(labels[i], at))
    links = []
    for at in range(1, len(sets)):

        def skip(lo, hi, at=at):
            own = top(at)
            return all(top(j) == own for j in range(lo, hi))

        def found(j, at=at):
            if top(at) != top(j):
                links.append((tree.order[at], tree.order[j]))
                parent[top(at)] = top(j)

        tree.walk(at, percent, skip, found)
    return links


# ------------------------------------------------------------------ Spark
def _classes(documents: DataFrame, words: int) -> DataFrame:
    """(doc, n, class, digest of the text, outline) of every row; an empty set has no class.
    Outlines have a byte a cell; there is none where a cell holds more than that."""

    def run(batches):
        for batch in batches:
            for part, texts in text_blocks(batch, SET_BYTES):
                sets = ngram_sets(texts, words)
                lines = [outline(s) if len(s) else None for s in sets]
                cells = [x.astype(np.uint8).tobytes() if x is not None and x.max() < 256 else None for x in lines]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()), part.column("digest"), pa.array(cells, pa.binary())],
                    names=["doc", "n", "class", "digest", "outline"],
                )

    return _ided(documents).mapInArrow(run, "doc bigint, n bigint, class bigint, digest bigint, outline binary")


def _ided(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(order_id("doc_id").alias("doc"), text.alias("text"), F.xxhash64(text).alias("digest"))


def _routes(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """(route, class, n): what every class sends, once for each task that meets it."""

    def run(batches):
        bands, met = Bands(percent), set()
        for batch in batches:
            for _, texts in text_blocks(batch, SET_BYTES):
                routes, classes, sizes = [], [], []
                for s in ngram_sets(texts, words):
                    if not len(s) or (c := class_of(s)) in met:
                        continue
                    met.add(c)
                    r = route_hashes(s, bands)
                    routes.append(r)
                    classes.append(np.full(len(r), c, np.int64))
                    sizes.append(np.full(len(r), len(s), np.int32))
                if routes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(routes).view(np.int64)), pa.array(np.concatenate(classes)), pa.array(np.concatenate(sizes))], names=["route", "class", "n"])

    return documents.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "route bigint, class bigint, n int")


def _key_filter(keys: DataFrame):
    """A column function that tells whether a row's (doc, digest) may be among ``keys``: a Bloom
    filter of about 16 bits a key and 64 MB at most. It lets some others pass, more when full."""
    bits = 1 << min(MAX_FILTER_BITS, max(PAGE_BITS, (16 * keys.count()).bit_length()))
    places = [F.pmod(F.xxhash64(F.lit(k), "doc", "digest"), F.lit(bits)).alias(f"p{k}") for k in range(3)]

    def page(pdf: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(1 << PAGE_BITS, bool)
        held[pdf["bit"].to_numpy(np.int64) & ((1 << PAGE_BITS) - 1)] = True
        return pd.DataFrame({"page": [int(pdf["page"].iloc[0])], "held": [np.packbits(held).tobytes()]})

    each = keys.select(F.explode(F.array(*places)).alias("bit")).withColumn("page", F.shiftright("bit", PAGE_BITS).cast("int"))
    table = np.zeros(bits // 8, np.uint8)
    for r in each.groupBy("page").applyInPandas(page, "page int, held binary").toLocalIterator():
        table[r.page << (PAGE_BITS - 3) : (r.page + 1) << (PAGE_BITS - 3)] = np.frombuffer(r.held, np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(table)

    def may_hold(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        out = np.ones(len(a), bool)
        for x in (a, b, c):
            at = x.to_numpy(np.int64)
            out &= (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
        return pd.Series(out)

    return F.pandas_udf(may_hold, "boolean")(*places)


def _sets(documents: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """The rows of ``chosen`` (class, doc, digest, ...; written) with the elements of their class,
    made from one text. Texts that no row asks for are left before the exchange."""

    def run(batches):
        for batch in batches:
            for part, texts in text_blocks(batch, SET_BYTES):
                sets = ngram_sets(texts, words)
                right = [len(s) > 0 and class_of(s) == c for c, s in zip(part.column("class").to_pylist(), sets)]
                part = part.drop_columns(["text"]).filter(pa.array(right, pa.bool_()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([s.tobytes() for s, r in zip(sets, right) if r], pa.binary())], names=[*part.schema.names, "elements"])

    of_text = ["doc", "digest"]
    # Rows of one doc_id and text shrink to one before they meet.
    one = _ided(documents).where(_key_filter(chosen.select(*of_text).distinct())).dropDuplicates(of_text)
    rows = one.join(chosen, of_text).drop(*of_text)
    others = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{others}, elements binary")


def _chunked(members: DataFrame) -> DataFrame:
    """``members`` (block, class, n, ...) with ``chunks`` of the block and the row's ``chunk``.
    Only blocks of several chunks are joined: at most one for CHUNK_SETS members."""
    size = members.groupBy("block").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("elements"))
    chunks = F.greatest(F.ceil(F.col("sets") / CHUNK_SETS), F.ceil(F.col("elements") / CHUNK_ELEMENTS)).cast("int")
    large = materialize(size.select("block", chunks.alias("chunks")).where("chunks > 1"), "join_large")
    found = members.join(bounded_broadcast(large), "block", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    return found.withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))


def outline(elements: np.ndarray) -> np.ndarray:
    """Numbers of elements by their low bits, in a power of two of about n / 2 cells."""
    cells = 1 << max(4, len(elements).bit_length() - 2)
    return np.bincount((elements & np.uint64(cells - 1)).astype(np.int64), minlength=cells)


def may_link(sizes: np.ndarray, outlines: list[np.ndarray], labels: np.ndarray, percent: int) -> np.ndarray:
    """Which sets may link with one of another label: two sets share at most the sum of the
    lesser numbers of every cell, so no link is lost."""
    out = np.zeros(len(sizes), bool)
    order = np.argsort(sizes, kind="stable")
    cells = np.fromiter(map(len, outlines), np.int64, len(outlines))
    tables = {c: (own := order[cells[order] == c], np.stack([outlines[k] for k in own])) for c in np.unique(cells).tolist()}
    for k in order.tolist():
        line = outlines[k]
        while len(line) >= 16:
            # sets of this level that are no larger, but large enough
            if len(line) in tables:
                own, table = tables[len(line)]
                fit = (sizes[own] <= sizes[k]) & (100 * sizes[own] >= percent * sizes[k]) & (labels[own] != labels[k])
                if fit.any():
                    both = np.minimum(table[fit], line).sum(axis=1)
                    near = own[fit][100 * both >= percent * (sizes[own[fit]] + sizes[k] - both)]
                    if len(near):
                        out[k] = True
                        out[near] = True
            if 100 * 2 * len(line) < percent * sizes[k]:
                break  # what has fewer cells is too small
            line = line[: len(line) // 2] + line[len(line) // 2 :]
    return out


def _near_tasks(rows: DataFrame, percent: int) -> DataFrame:
    """Of the tasks (block, i, j) of ``rows`` (block, i, j, class, label, doc, digest, n, outline):
    the classes that may link with one of another label, by their outlines."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("class")
        bare = pdf["outline"].isna().to_numpy()
        known = pdf[~bare]
        keep = may_link(known["n"].to_numpy(np.int64), [np.frombuffer(x, np.uint8).astype(np.int64) for x in known["outline"]], known["label"].to_numpy(np.int64), percent)
        out = pdf if bare.any() else known[keep]
        return out[["block", "i", "j", "class", "label", "doc", "digest"]]

    return rows.groupBy("block", "i", "j").applyInPandas(run, "block bigint, i int, j int, class bigint, label bigint, doc bigint, digest bigint")


def _join_tasks(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the tasks (block, i, j) of ``rows`` (block, i, j, class, elements, label)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("class")
        c, label = pdf["class"].to_numpy(np.int64), pdf["label"].to_numpy(np.int64)
        links = tree_links([np.frombuffer(e, np.uint64) for e in pdf["elements"]], percent, list(label)) if len(set(label)) > 1 else []
        return pd.DataFrame({"a": c[[x for x, _ in links]], "b": c[[y for _, y in links]]}, dtype=np.int64)

    return rows.groupBy("block", "i", "j").applyInPandas(run, "a bigint, b bigint")


def class_components(documents: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """(class, component): the smallest class that each linked class reaches; classes without
    links are missing. ``classes`` is the written result of :func:`_classes`."""
    sent = _routes(documents, words, percent).repartition(ROUTE_PARTS * partitions_for(documents), "route")
    together = Window.partitionBy("route")
    met = sent.withColumn("block", F.min("class").over(together)).withColumn("last", F.max("class").over(together)).where("block <> last")
    members = materialize(met.select("block", "class", "n").distinct(), "join_members")
    first = classes.where("class is not null").groupBy("class").agg(F.min(F.struct("doc", "digest", "n", "outline")).alias("first"))
    chosen = materialize(first.join(members.select("class").distinct(), "class").select("class", "first.*"), "join_chosen")

    def links_of(tasks: DataFrame) -> DataFrame:
        """The links within tasks (block, i, j, class, label)."""
        near = materialize(_near_tasks(tasks.join(chosen, "class"), percent), "join_near")
        return materialize(_join_tasks(_sets(documents, near, words), percent), "join_links")

    # First: every class in its smallest block, whose first class joins each chunk.
    small = members.groupBy("class", "n").agg(F.min("block").alias("block"))
    chunked = _chunked(small)
    heads = chunked.select("block", "chunk").distinct().select(F.col("block"), F.col("chunk"), F.col("block").alias("class"))
    tasks = chunked.select("block", "chunk", "class").union(heads).distinct()
    links = links_of(tasks.select("block", F.col("chunk").alias("i"), F.col("chunk").alias("j"), "class", F.col("class").alias("label")))
    known = connected(links)

    # Then: the blocks that hold several components, in full. A set is in many of them, mostly
    # beside others that share one passage with it.
    label = F.coalesce("label", F.col("class")).alias("label")
    labelled = members.join(known.withColumnRenamed("node", "class"), "class", "left").select("block", "class", "n", label)
    mixed = labelled.groupBy("block").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("block")
    chunked = _chunked(materialize(labelled.join(mixed, "block"), "join_mixed"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    tasks = chunked.select("block", "chunk", "class", "label", other).select(
        "block", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "class", "label"
    )
    more = links_of(tasks)
    return connected(links.union(more)).select(F.col("node").alias("class"), F.col("label").alias("component"))


def components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc, n, class, component_doc) of every row of ``documents``: ``doc`` and
    ``component_doc`` are order ids, the latter of the smallest document reached by links."""
    with settings(documents.sparkSession, BATCHES):
        classes = materialize(_classes(documents, words), "join_classes")
        linked = class_components(documents, classes, words, percent)
    by_class = classes.where("class is not null").groupBy("class").agg(F.min("doc").alias("doc"))
    named = by_class.join(linked, "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = named.groupBy("component").agg(F.min("doc").alias("component_doc"))
    of_class = materialize(named.join(smallest, "component").select("class", "component_doc"), "join_components")
    return classes.join(of_class, "class", "left").select("doc", "n", "class", F.coalesce("component_doc", "doc").alias("component_doc"))


def keep_one(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``documents`` without near duplicates: of each component one row stays, one of its
    smallest doc_id. Rows of one doc_id, or without any, whose texts are not linked are
    components of their own and all stay, as do all empty texts."""
    with settings(documents.sparkSession, BATCHES):
        classes = materialize(_classes(documents, words), "join_classes")
        linked = class_components(documents, classes, words, percent)
    by_class = classes.where("class is not null").groupBy("class").agg(F.min(F.struct("doc", "class", "digest")).alias("first"))
    named = by_class.join(linked, "class", "left").groupBy(F.coalesce("component", "class").alias("component")).agg(F.min("first").alias("first"))
    stay = materialize(named.select("first.doc", "first.digest"), "join_stay")
    rows = documents.select(F.struct("*").alias("_row"), order_id("doc_id").alias("doc"), F.xxhash64(F.col("text").cast("string")).alias("digest"), F.coalesce(F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")) > 0, F.lit(False)).alias("words"))
    # Rows of one doc_id and text shrink to one before they meet.
    one = rows.where("words").groupBy("doc", "digest").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return one.join(stay, ["doc", "digest"]).select("_row.*").union(rows.where(~F.col("words")).select("_row.*"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document of ``documents``: 4-word n-grams, similarity
    0.85 or more."""
    found = components(table(spark, sf_dir, "documents"), QUERY_WORDS, QUERY_PERCENT)
    return found.select(original_id("doc").alias("doc_id"), F.col("n").alias("n_shingles"), original_id("component_doc").alias("component_id"))


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - 3), lambda i: array_to_string(w[i + 1 : i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id
GROUP BY d.doc_id, s.n
"""
