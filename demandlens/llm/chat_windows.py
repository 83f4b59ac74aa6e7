"""Chat formatting: conversations as token-budgeted training windows with a loss mask.

A conversation's turns are dealt by turn number into blocks of ``BLOCK_TURNS``, so that a
conversation of any length is worked on by many tasks. Inside a block the prefix sums of the
turns' tokens choose turn-aligned spans. A window is the conversation's system turn (its first
turn, if that is one), up to ``HISTORY_TURNS`` turns before the span that fit
``HISTORY_TOKENS``, and the span. Only the span's assistant texts stand under the loss mask;
what is repeated (system turn, history) is masked, so every assistant text is trained once.

The template writes a turn as ``### Role: text </turn>`` and a line break. Backslashes, ``###``
and ``</turn>`` inside texts and roles are escaped, which :func:`unescape` undoes; a role other than
system, user and assistant is written after ``\\r``.

Defined results: a NULL text or role is empty; a NULL ``conv_id`` is one conversation of its
own; turns go by number, NULL first, equal numbers by role and text (repeated rows are turns of
their own); a turn longer than the budget has a window of its own that is over budget (history
is left out first), a system turn over half the budget is only in its own window; tokens of a
text are counted in pieces of ``PIECE_CHARS`` characters, and every piece of work streams, so a
very long text needs memory for itself only; an empty table gives an empty result; of the
input only ``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm.bpe import encoder, vocabulary_path
from demandlens.llm.tables import order_id, original_id, table
from demandlens.session import materialize, partitions_for

#: Tokens of a window, of its repeated history, and turns of that history.
BUDGET = 2048
HISTORY_TOKENS = 512
HISTORY_TURNS = 4
#: Turn numbers of a block (one unit of parallel work).
BLOCK_TURNS = 256
#: Characters of a text whose tokens are counted at once.
PIECE_CHARS = 32_768

# Fixed values of the template.
START = "### "
END = " </turn>\n"
NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {v: k for k, v in NAMES.items()}
_ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\t", ":": "\\c", "\n": "\\n"}
_IN_TEXT = re.compile(r"\\|###|</turn>")
_IN_ROLE = re.compile(r"\\|###|</turn>|:|\n")
_ESCAPED = re.compile(r"\\(.)", re.S)
_BACK = {v[1]: k for k, v in _ESCAPES.items()}
_TURN = re.compile(r"### ([^:\n]*): (.*?) </turn>\n", re.S)


def escape(text: str) -> str:
    """A text without control strings."""
    return _IN_TEXT.sub(lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def header(role: str) -> str:
    name = NAMES.get(role)
    return START + ("\\r" + _IN_ROLE.sub(lambda m: _ESCAPES[m[0]], role) if name is None else name) + ": "


def role_of(name: str) -> str:
    return unescape(name[2:]) if name.startswith("\\r") else _ROLES[name]


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn and where its (escaped) text begins and ends in it."""
    head, body = header(role), escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, begin, end) of every turn of a window, read from the window alone."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        yield role_of(m[1]), unescape(m[2]), m.start(2), m.end(2)
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted window")


# ------------------------------------------------------------------ windows
class Block:
    """Windows of one block of a conversation, turn by turn."""

    def __init__(self, budget: int, history_tokens: int, history_turns: int):
        self.budget, self.history_tokens = budget, history_tokens
        self.several, self.first = False, True  # blocks of the conversation; is this its first one?
        self.system: tuple[str, int] | None = None  # formatted, tokens: repeated in every window
        self.own_system: tuple[str, int] | None = None  # the same in the span of its own first window
        self.past: deque = deque(maxlen=history_turns)  # (formatted, tokens) of the turns before the span
        self.span: list[tuple[str, int, int, int, bool]] = []
        self.lead: list[tuple[str, int]] = []  # repeated turns of the open window
        self.total = self.begin = 0  # prefix sums of tokens: at the last turn, before the span
        self.windows = 0

    def mark(self, role: str, text: str | None, tokens: int) -> None:
        """The conversation has several blocks; ``text`` is its system turn, if that is before this block."""
        self.several, self.first = True, role == FIRST
        if text is not None and 2 * tokens <= self.budget:
            self.system = (format_turn(role, text)[0], tokens)

    def before(self, role: str, text: str, tokens: int) -> None:
        """A turn at the end of the block before this one."""
        turn = (format_turn(role, text)[0], tokens)
        if turn != self.system:
            self.past.append(turn)

    def history(self, tokens: int) -> list[tuple[str, int]]:
        """Turns to repeat in front of a span whose first turn has ``tokens`` tokens."""
        room = min(self.history_tokens, self.budget - tokens - (self.system[1] if self.system else 0))
        out: list[tuple[str, int]] = []
        for turn in reversed(self.past):
            room -= turn[1]
            if room < 0:
                break
            out.append(turn)
        return out[::-1]

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """Take one turn; returns the window that it closes, if any."""
        closed = None
        if self.span and self.total + tokens - self.begin > self.budget - sum(t for _, t in self.lead):
            closed = self.close()
        formatted, begin, end = format_turn(role, text)
        if not self.span:
            self.lead = ([self.system] if self.system else []) + self.history(tokens)
            if self.windows == 0 and self.first and role == "system" and 2 * tokens <= self.budget:
                self.own_system = (formatted, tokens)
        self.span.append((formatted, begin, end, tokens, role == "assistant"))
        self.total += tokens
        return closed

    def close(self) -> dict | None:
        if not self.span:
            return None
        repeated = sum(t for _, t in self.lead)
        parts, at, starts, ends = [t for t, _ in self.lead], sum(len(t) for t, _ in self.lead), [], []
        for formatted, begin, end, _, trained in self.span:
            if trained:
                starts.append(at + begin)
                ends.append(at + end)
            parts.append(formatted)
            at += len(formatted)
        tokens = self.total - self.begin + repeated
        window = {
            "window": self.windows, "n_repeated": len(self.lead), "n_turns": len(self.span), "n_tokens": tokens,
            "over_budget": tokens > self.budget, "text": "".join(parts), "loss_start": starts, "loss_end": ends,
        }
        if self.own_system and self.system is None:
            self.system = self.own_system
            self.span = self.span[1:]  # repeated as the system turn, not as history
        self.past.extend((t[0], t[3]) for t in self.span[-self.past.maxlen :] if self.past.maxlen)
        self.span, self.begin, self.windows = [], self.total, self.windows + 1
        return window


_WINDOW = pa.schema([
    ("conv", pa.int64()), ("block", pa.int64()), ("several", pa.bool_()), ("window", pa.int64()), ("n_repeated", pa.int32()), ("n_turns", pa.int64()),
    ("n_tokens", pa.int64()), ("over_budget", pa.bool_()), ("text", pa.string()), ("loss_start", pa.list_(pa.int32())), ("loss_end", pa.list_(pa.int32())),
])
WINDOW = "conv bigint, block bigint, several boolean, window bigint, n_repeated int, n_turns bigint, n_tokens bigint, over_budget boolean, text string, loss_start array<int>, loss_end array<int>"
#: Characters of result rows that are gathered before they are handed on.
OUT_CHARS = 1 << 20
#: A block number before all others, of turns without a number.
_NO_TURN = -(2**60)
#: Role of the mark in the first block of a conversation of several ones.
FIRST = "first"


def _batches(rows: Iterator[dict], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Record batches of about OUT_CHARS characters."""
    wait, n = [], 0
    for row in rows:
        wait.append(row)
        n += size(row)
        if n >= OUT_CHARS or len(wait) >= 10_000:
            yield pa.RecordBatch.from_pylist(wait, schema=schema)
            wait, n = [], 0
    if wait:
        yield pa.RecordBatch.from_pylist(wait, schema=schema)


def _rows(batches, names) -> Iterator[tuple]:
    """Rows of record batches, few at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            yield from zip(*[part.column(n).to_pylist() for n in names])


def count_tokens(role: str, text: str, path: str) -> int:
    formatted = format_turn(role, text)[0]
    return sum(len(encoder(path).encode_ordinary(formatted[k : k + PIECE_CHARS])) for k in range(0, len(formatted), PIECE_CHARS))


def _turns(conversations: DataFrame) -> DataFrame:
    turn = F.col("turn").cast("bigint")
    block = F.when(turn.isNull(), F.lit(_NO_TURN)).otherwise(F.floor((turn - F.pmod(turn, F.lit(BLOCK_TURNS))) / BLOCK_TURNS).cast("bigint"))
    return conversations.select(
        order_id("conv_id").alias("conv"), block.alias("block"), turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _marks(turns: DataFrame) -> DataFrame:
    """A row for every block of a conversation of several blocks: with its system turn (if its
    first turn is one) in every block but the first."""
    blocks = turns.groupBy("conv").agg(
        F.collect_set("block").alias("blocks"), F.min(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "role")).alias("first"))
    several = blocks.where(F.size("blocks") > 1)
    system = several.where(F.col("first.role") == "system").select(F.col("conv").alias("of"), F.col("first.turn").alias("at"))
    texts = turns.where(F.col("role") == "system").join(system, (F.col("conv") == F.col("of")) & F.col("turn").eqNullSafe(F.col("at"))).groupBy("of").agg(F.min("text").alias("text"))
    marks = several.select("conv", F.array_min("blocks").alias("least"), F.explode("blocks").alias("block")).join(texts, F.col("conv") == F.col("of"), "left")
    later = F.col("block") != F.col("least")
    return marks.select(
        "conv", "block", F.lit(None).cast("bigint").alias("turn"), F.when(later, F.lit("system")).otherwise(F.lit(FIRST)).alias("role"),
        F.when(later, F.col("text")).alias("text"), F.array(F.struct(F.lit(0).alias("kind"), F.col("block").alias("to"))).alias("places"),
    )


def windows(conversations: DataFrame, path: str | None = None, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS) -> DataFrame:
    """The windows of all conversations (``conv`` as from ``order_id``), in order inside each
    partition, all of a block in one. ``several``: its conversation has more than one block."""
    path = path or vocabulary_path()
    turns = _turns(conversations)

    def counted(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                n = [count_tokens(r, t, path) if t is not None else 0 for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64())], names=[*part.schema.names, "tokens"])

    # The last turn numbers of a block are also sent to the next one, as its history.
    here = F.struct(F.lit(2).alias("kind"), F.col("block").alias("to"))
    ahead = F.struct(F.lit(1).alias("kind"), (F.col("block") + 1).alias("to"))
    late = F.pmod("turn", F.lit(BLOCK_TURNS)) >= BLOCK_TURNS - history_turns
    places = F.when(late, F.array(here, ahead)).otherwise(F.array(here))
    rows = turns.withColumn("places", places).unionByName(_marks(turns))
    kind = "places array<struct<kind:int,to:bigint>>"
    rows = rows.mapInArrow(counted, f"conv bigint, block bigint, turn bigint, role string, text string, {kind}, tokens bigint")
    rows = rows.select("conv", F.explode("places").alias("p"), "turn", "role", "text", "tokens").select("conv", F.col("p.to").alias("block"), F.col("p.kind").alias("kind"), "turn", "role", "text", "tokens")
    dealt = rows.repartition(partitions_for(conversations), "conv", "block").sortWithinPartitions("conv", "block", "kind", F.col("turn").asc_nulls_first(), "role", "text")

    def formed(batches):
        def run():
            at, block = None, None

            def out(window):
                return {"conv": at[0], "block": at[1], "several": block.several, **window}

            for conv, b, kind, role, text, tokens in _rows(batches, ("conv", "block", "kind", "role", "text", "tokens")):
                if at != (conv, b):
                    if block is not None and (w := block.close()):
                        yield out(w)
                    at, block = (conv, b), Block(budget, history_tokens, history_turns)
                if kind == 0:
                    block.mark(role, text, tokens)
                elif kind == 1:
                    block.before(role, text, tokens)
                elif w := block.add(role, text, tokens):
                    yield out(w)
            if block is not None and (w := block.close()):
                yield out(w)

        return _batches(run(), _WINDOW, lambda r: len(r["text"]))

    return dealt.mapInArrow(formed, WINDOW)


def format_conversations(conversations: DataFrame, **settings) -> DataFrame:
    """(conv_id, block, window, n_repeated, n_turns, n_tokens, over_budget, text, loss_start,
    loss_end) of every window: the first ``n_repeated`` turns of ``text`` are repeated ones, loss
    spans are code points of ``text``."""
    out = windows(conversations, **settings)
    return out.select(original_id("conv").alias("conv_id"), *[c for c in out.columns if c not in ("conv", "several")])


# ------------------------------------------------------------------ reading back
_READ = pa.schema([
    ("conv", pa.int64()), ("block", pa.int64()), ("window", pa.int64()), ("several", pa.bool_()), ("n_turns", pa.int64()), ("formatted_chars", pa.int64()),
    ("loss_chars", pa.int64()), ("turns_sha256", pa.string()), ("loss_sha256", pa.string()), ("turns", pa.binary()), ("loss", pa.binary()),
])
READ = "conv bigint, block bigint, window bigint, several boolean, n_turns bigint, formatted_chars bigint, loss_chars bigint, turns_sha256 string, loss_sha256 string, turns binary, loss binary"


class Digest:
    """Running digests of a conversation that is read back."""

    def __init__(self):
        self.n_turns = self.formatted_chars = self.loss_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, n_turns: int, formatted_chars: int, loss_chars: int, turns: bytes, loss: bytes) -> None:
        self.n_turns += n_turns
        self.formatted_chars += formatted_chars
        self.loss_chars += loss_chars
        self.turns.update(turns)
        self.loss.update(loss)

    def row(self) -> dict:
        return {
            "n_turns": self.n_turns, "formatted_chars": self.formatted_chars, "loss_chars": self.loss_chars,
            "turns_sha256": self.turns.hexdigest(), "loss_sha256": self.loss.hexdigest(),
        }


def read_window(text: str, n_repeated: int, starts: list[int], ends: list[int]) -> tuple[int, int, int, bytes, bytes]:
    """(turns, formatted characters, characters under the mask, their bytes) of a window's own turns."""
    own = [(role, body) for k, (role, body, _, _) in enumerate(parse(text)) if k >= n_repeated]
    loss = "".join(unescape(text[i:j]) for i, j in zip(starts, ends))
    return len(own), len(text), len(loss), "".join(f"{role}\n{body}\n" for role, body in own).encode(), loss.encode()


def read_back(formed: DataFrame) -> DataFrame:
    """Conversations as their windows give them back: number of turns, digest of the turns,
    characters and digest under the loss mask, characters of all windows. A conversation of one
    block is digested where its windows are made; for the others the bytes read back are
    gathered in order and digested as a stream (a digest is sequential by nature)."""

    def read(batches):
        def run():
            at, digest = None, None
            for conv, block, window, several, n_repeated, text, starts, ends in _rows(batches, ("conv", "block", "window", "several", "n_repeated", "text", "loss_start", "loss_end")):
                if at is not None and at != (conv, block):
                    yield {"conv": at[0], "block": at[1], "window": 0, "several": False, **digest.row()}
                    at = None
                part = read_window(text, n_repeated, starts, ends)
                if several:
                    yield {
                        "conv": conv, "block": block, "window": window, "several": True, "n_turns": part[0], "formatted_chars": part[1],
                        "loss_chars": part[2], "turns": part[3], "loss": part[4],
                    }
                    continue
                if at is None:
                    at, digest = (conv, block), Digest()
                digest.add(*part)
            if at is not None:
                yield {"conv": at[0], "block": at[1], "window": 0, "several": False, **digest.row()}

        return _batches(run(), _READ, lambda r: len(r.get("turns") or b"") + len(r.get("loss") or b""))

    rows = materialize(formed.mapInArrow(read, READ), "chat_read")
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    parts = rows.where("several").select("conv", "block", "window", "n_turns", "formatted_chars", "loss_chars", "turns", "loss")
    dealt = parts.repartition(partitions_for(rows), "conv").sortWithinPartitions("conv", "block", "window")
    schema = pa.schema([("conv", pa.int64()), *[_READ.field(n) for n in names]])

    def join(batches):
        def run():
            at, digest = None, None
            for conv, *part in _rows(batches, ("conv", "n_turns", "formatted_chars", "loss_chars", "turns", "loss")):
                if conv != at:
                    if at is not None:
                        yield {"conv": at, **digest.row()}
                    at, digest = conv, Digest()
                digest.add(*part)
            if at is not None:
                yield {"conv": at, **digest.row()}

        return _batches(run(), schema, lambda r: 200)

    whole = dealt.mapInArrow(join, "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return rows.where("not several").select("conv", *names).unionByName(whole).select(original_id("conv").alias("conv_id"), *names)


def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``, and conversation -7 whose texts hold the template's control strings,
    formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(odd).alias("text"))
    return read_back(windows(rows.unionByName(own)))
