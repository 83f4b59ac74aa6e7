"""Repair of damaged conversations by the cheapest edits of their turns.

Every row of a conversation becomes a symbol: its role's initial (s, u, a, other) and its first
fault (blank, duplicate, truncated or none). The signatures (symbols in order) of all
conversations are made distinct, sorted by their reversed text and walked with a stack: the
nodes are the distinct suffixes, so a suffix that many signatures share is one node
(suffix-shared automaton, minimised from the end). Each node holds, for every state of the
grammar ``(s?(ua)+)?``, the cheapest cost to go, the edits that begin it, the state after them
and how its audit text compares with the other states' ones; so ties are decided without
writing any audit out. A signature's audit is read along its nodes.

Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (required for blank and duplicate rows),
Insert an empty user or assistant turn 3; a truncated row that stays adds 3.

Hot conversations: positions come from a range-partitioned table of small rows, duplicates from a
map-side aggregate and a join on unique positions, signatures from bounded pieces. Only the
texts' digest of one conversation is a single stream, sorted by Spark and read row by row.

Defined results: a NULL role or text is one space, a NULL ``conv_id`` is one conversation of its
own; rows go by turn, NULL first, equal turns by role and digest of the text as given (repeated rows
stand next to each other); an empty role has no initial and fits nowhere; an empty table gives
an empty result, a conversation without rows an empty audit; a very long text is read by the
JVM for its fault and digest and streamed once; of the input only ``conv_id``, ``turn``, ``role`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.tables import order_id, original_id, table
from demandlens.operators.joins import bounded_broadcast
from demandlens.session import materialize, partitions_for

# Costs of the edits, in the order of their initials.
DELETE, INSERT, RETAIN, REROLE, TRUNCATED = 4, 3, 0, 3, 3

# Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES = range(4)
_AFTER = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
_INSERTED = (2, 2, 3, 2)  # the state after the one turn that may be inserted
_ACCEPTING = (True, False, False, True)

# A symbol is one letter: initial (s, u, a, other) times fault (none, blank, duplicate, truncated).
INITIALS = "sua?"
FAULTS = ("none", "blank", "duplicate", "truncated")
_FIRST = ord("A")


def symbol_parts(symbol: str) -> tuple[str, str]:
    k = ord(symbol) - _FIRST
    return INITIALS[k // 4], FAULTS[k % 4]


# A node's profile: costs less the least one, and ranks of the audit texts, by state.
Profile = tuple[tuple[int, ...], tuple[int, ...]]


def _ranked(options: list[tuple[int, str, int]], ranks: tuple[int, ...]) -> tuple[int, str, int]:
    """The cheapest of (cost, edits, next state); ties by the audit text: the edits never are a
    prefix of each other, so equal edits are told apart by what follows."""
    return min(options, key=lambda o: (o[0], o[1], ranks[o[2]]))


@lru_cache(maxsize=1 << 16)
def step(symbol: str, after: Profile) -> tuple[int, Profile, tuple[tuple[str, int], ...]]:
    """(least cost added, profile, (edits, next state) by state) of a node from the one after it."""
    initial, fault = symbol_parts(symbol)
    costs, ranks = after
    own = []
    for q in STATES:
        options = [(DELETE + costs[q], "D", q)]
        if fault in ("none", "truncated"):
            more = TRUNCATED if fault == "truncated" else 0
            if (initial, q) in _AFTER:
                to = _AFTER[initial, q]
                options.append((RETAIN + more + costs[to], "K", to))
            to = _INSERTED[q]  # the grammar allows one role of user and assistant in each state
            options.append((REROLE + more + costs[to], "R", to))
        own.append(options)
    best = []
    for q in STATES:
        first = _INSERTED[q]
        second = _INSERTED[first]
        options = own[q] + [(INSERT + c, "I" + e, t) for c, e, t in own[first]] + [(2 * INSERT + c, "II" + e, t) for c, e, t in own[second]]
        best.append(_ranked(options, ranks))
    least = min(b[0] for b in best)
    texts = [(e, ranks[t]) for _, e, t in best]
    order = sorted(set(texts))
    return least, (tuple(b[0] - least for b in best), tuple(order.index(x) for x in texts)), tuple((e, t) for _, e, t in best)


def end_node() -> tuple[int, Profile, tuple[str, ...]]:
    """Cost, profile and edits after the last row: turns inserted until the state is accepting."""
    texts = []
    for q in STATES:
        n = 0
        while not _ACCEPTING[q]:
            q, n = _INSERTED[q], n + 1
        texts.append("I" * n)
    costs = [INSERT * len(t) for t in texts]
    order = sorted(set(texts))
    return min(costs), (tuple(c - min(costs) for c in costs), tuple(order.index(t) for t in texts)), tuple(texts)


class SuffixAutomaton:
    """Walks signatures sorted by their reversed text; keeps the nodes of the last one's suffixes."""

    def __init__(self):
        least, profile, self.tail = end_node()
        self.symbols: list[str] = []  # from the end
        self.nodes: list[tuple[int, Profile, tuple]] = [(least, profile, ())]
        self.made = 0

    def repair(self, signature: str) -> tuple[int, str]:
        """(cost, audit) of a signature."""
        same, symbols = 0, self.symbols
        most = min(len(symbols), len(signature))
        while same < most and symbols[same] == signature[-1 - same]:
            same += 1
        del symbols[same:], self.nodes[same + 1 :]
        for symbol in reversed(signature[: len(signature) - same]):
            cost, profile, _ = self.nodes[-1]
            least, mine, edits = step(symbol, profile)
            self.nodes.append((cost + least, mine, edits))
            symbols.append(symbol)
            self.made += 1
        cost, profile, _ = self.nodes[-1]
        state, audit = 0, []
        for node in reversed(self.nodes[1:]):
            edits, state = node[2][state]
            audit.append(edits)
        return cost + profile[0][0], "".join(audit) + self.tail[state]


def illegal(signature: str) -> int:
    """Adjacent rows whose initials are none of su, ua, au."""
    initials = [symbol_parts(s)[0] for s in signature]
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))


# ------------------------------------------------------------------ rows
def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that a row's crc32 of ``conv_id:turn`` stands for (0 drops it, 1
    empties the text, 2 removes its full stops, 3 repeats it, 4 makes it a user's), with ``conv``
    as from ``order_id`` and the row's own ``was_role`` and ``was_text`` digest for its place."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    hurt = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = conversations.where(kind != 0).select(
        order_id("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"), role.alias("was_role"), F.unhex(F.md5(text.cast("binary"))).alias("was_text"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), hurt.alias("text"), F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.select("*", F.explode("copies").alias("copy")).drop("copies")


def _order() -> list[Column]:
    return [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("was_role"), F.col("was_text"), F.col("copy")]


def signatures(rows: DataFrame) -> DataFrame:
    """(conv, signature, gaps) of every conversation with rows."""
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(last == "", F.lit(1)).when(last.isin(".", "!", "?"), F.lit(0)).otherwise(F.lit(3))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(" "), "role", "text").cast("binary")))
    small = rows.select("conv", "turn", "was_role", "was_text", "copy", kind.alias("kind"), fault.alias("fault"), digest.alias("digest"))
    ranged = small.repartitionByRange(partitions_for(rows), *_order()).sortWithinPartitions(*_order())
    placed = ranged.select("conv", "turn", "kind", "fault", "digest", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    placed = materialize(placed, "repair_rows")
    firsts = placed.groupBy("conv", "digest").agg(F.min("place").alias("first")).select("first")  # one per distinct role and text
    marked = placed.join(firsts, F.col("place") == F.col("first"), "left")
    what = F.when(F.col("fault") == 1, F.lit(1)).when(F.col("first").isNull(), F.lit(2)).otherwise(F.col("fault"))
    symbol = F.char(F.lit(_FIRST) + 4 * F.col("kind") + what)
    # Pieces of a signature are bounded by the rows of a partition, pieces of a conversation by their number.
    cells = marked.select("conv", "part", F.struct("place", symbol.alias("symbol")).alias("cell"))
    pieces = cells.groupBy("conv", "part").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    pieces = pieces.select("conv", F.struct("part", F.array_join(F.col("cells.symbol"), "").alias("piece")).alias("piece"))
    whole = pieces.groupBy("conv").agg(F.sort_array(F.collect_list("piece")).alias("pieces")).select("conv", F.array_join("pieces.piece", "").alias("signature"))
    spans = placed.where("turn is not null").groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    return whole.join(spans, "conv", "left").select("conv", "signature", F.coalesce("gaps", F.lit(0)).alias("gaps"))


PLAN = "signature string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_PLAN = pa.schema([("signature", pa.string()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


def plans(signed: DataFrame) -> DataFrame:
    """Counts, cost and audit of every distinct signature."""
    distinct = signed.select("signature").distinct()
    order = F.reverse("signature")
    ranged = distinct.repartitionByRange(partitions_for(distinct), order).sortWithinPartitions(order)

    def walk(batches):
        automaton = SuffixAutomaton()
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                names = batch.column("signature").slice(k, 2000).to_pylist()
                out = {c: [] for c in _PLAN.names}
                for name in names:
                    cost, audit = automaton.repair(name)
                    faults = {f: sum(name.count(chr(_FIRST + 4 * i + j)) for i in range(4)) for j, f in enumerate(FAULTS)}
                    for c, v in zip(_PLAN.names, (name, faults["blank"], faults["duplicate"], faults["truncated"], illegal(name), cost, audit)):
                        out[c].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=_PLAN)

    return ranged.mapInArrow(walk, PLAN)


# ------------------------------------------------------------------ repaired conversations
def repaired_turns(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The turns that an audit makes of a conversation's rows."""
    state = 0
    for edit in audit:
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 2 else "user"
        state = _AFTER[role[:1], state]
        yield role, text


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_HEAD = pa.schema([("conv", pa.int64()), *[(c, pa.int64()) for c in NUMBERS], ("audit", pa.string())])
_RESULT = _HEAD.append(pa.field("repaired_sha256", pa.string()))
HEAD = "conv bigint, " + "".join(f"{c} bigint, " for c in NUMBERS) + "audit string"
TURNS = "conv bigint, turn bigint, role string, text string"


def _merged(conversations: DataFrame) -> DataFrame:
    """Rows of all conversations, each behind a head row with its numbers and audit, in order
    inside each partition."""
    rows = damaged(conversations)
    signed = materialize(signatures(rows), "repair_signed")
    found = materialize(plans(signed), "repair_plans")
    heads = signed.join(bounded_broadcast(found), "signature")
    all_ids = conversations.select(order_id("conv_id").alias("conv")).distinct()
    heads = all_ids.join(heads, "conv", "left").select("conv", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in NUMBERS], F.coalesce("audit", F.lit("")).alias("audit"))
    merged = rows.select(*rows.columns, F.lit(1).alias("kind")).unionByName(heads.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    order = _order()
    dealt = merged.repartition(partitions_for(conversations), "conv").sortWithinPartitions(order[0], "kind", *order[1:])
    return dealt.select("kind", "conv", "role", "text", *NUMBERS, "audit")


def _stream(batches) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """(head, its rows) of every conversation of a merged partition."""

    def rows():
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                yield from batch.slice(k, 256).to_pylist()

    it = rows()
    held = next(it, None)

    def turns():
        nonlocal held
        for row in it:
            if row["kind"] == 0:
                held = row
                return
            yield row["role"], row["text"]
        held = None

    while held is not None:
        head, own = held, turns()
        yield head, own
        for _ in own:  # rows that were not asked for
            pass


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of the repair, and the digest of
    the repaired turns (``role:text``, joined by line breaks)."""

    def run(batches):
        out = []
        for head, turns in _stream(batches):
            digest = hashlib.sha256()
            for k, (role, text) in enumerate(repaired_turns(head["audit"], turns)):
                digest.update((b"\n" if k else b"") + f"{role}:{text}".encode())
            out.append({**{c: head[c] for c in _HEAD.names}, "repaired_sha256": digest.hexdigest()})
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, schema=_RESULT)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=_RESULT)

    done = _merged(conversations).mapInArrow(run, HEAD + ", repaired_sha256 string")
    return done.select(original_id("conv").alias("conv_id"), *NUMBERS, "audit", "repaired_sha256")


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, turn (from 0), role, text."""
    schema = pa.schema([("conv", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        for head, turns in _stream(batches):
            wait, n = [], 0
            for k, (role, text) in enumerate(repaired_turns(head["audit"], turns)):
                wait.append({"conv": head["conv"], "turn": k, "role": role, "text": text})
                n += len(text)
                if n >= 1 << 20 or len(wait) == 1000:
                    yield pa.RecordBatch.from_pylist(wait, schema=schema)
                    wait, n = [], 0
            if wait:
                yield pa.RecordBatch.from_pylist(wait, schema=schema)

    return _merged(conversations).mapInArrow(run, TURNS).select(original_id("conv").alias("conv_id"), "turn", "role", "text")


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair of every conversation of ``conversations`` after the prescribed damage."""
    return repair(table(spark, sf_dir, "conversations"))
