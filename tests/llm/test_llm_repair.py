"""Conversation repair against a search over all edits with whole audit texts."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandlens.llm import chat_repair as cr

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}  # what may follow the last turn


def cheapest(symbols):
    """(cost, audit, turns) by trying every edit; states are (row, last initial, inserted here)."""

    @lru_cache(None)
    def go(k, last, room):
        out = []
        if k == len(symbols) and last in ("", "a"):
            out.append((0, "", ()))
        if room:
            for r in NEXT[last]:
                if r in "ua":
                    c, a, t = go(k, r, room - 1)
                    out.append((c + 3, "I" + a, ((None, r), *t)))
        if k < len(symbols):
            initial, fault = symbols[k]
            c, a, t = go(k + 1, last, 4)
            out.append((c + 4, "D" + a, t))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                for r in NEXT[last]:
                    if r in "ua":
                        c, a, t = go(k + 1, r, 4)
                        out.append((c + 3 + more, "R" + a, ((k, r), *t)))
                    if r == initial:
                        c, a, t = go(k + 1, r, 4)
                        out.append((c + more, "K" + a, ((k, None), *t)))
        return min(out, key=lambda x: x[:2]) if out else (10**9, "Z", ())

    return go(0, "", 4)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from([chr(cr._FIRST + k) for k in range(16)]), max_size=14).map("".join), min_size=1, max_size=8))
def test_automaton_finds_the_cheapest_least_audit(signatures):
    automaton = cr.SuffixAutomaton()
    for s in sorted(set(signatures), key=lambda x: x[::-1]):
        assert automaton.repair(s) == cheapest(tuple(map(cr.symbol_parts, s)))[:2]


def test_shared_suffixes_are_one_node():
    automaton = cr.SuffixAutomaton()
    tail = "AEI" * 50
    for s in sorted(("A" + tail, "E" + tail, "B" + tail), key=lambda x: x[::-1]):
        automaton.repair(s)
    assert automaton.made == 150 + 3


def brute(rows):
    """The contract's columns from rows (conv_id, turn, role, text)."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, [])
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        key = (t is not None, t or 0, r, hashlib.md5(x.encode()).digest())
        if k == 0:
            continue
        new = "user" if k == 4 else r
        y = "" if k == 1 else re.sub(r"[.!?]", "", x) if k == 2 else x
        convs[c] += [(*key, 0, new, y, t)] + ([(*key, 1, new, y, t)] if k == 3 else [])
    out = {}
    for c, own in convs.items():
        own.sort(key=lambda v: v[:5])
        seen, symbols, turns = set(), [], []
        for *_, r, x, t in own:
            core = x.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (r, x) in seen else "none" if core[-1] in ".!?" else "truncated"
            seen.add((r, x))
            symbols.append((r[:1], fault))
            turns.append((r, x))
        cost, audit, plan = cheapest(tuple(symbols))
        made = [(turns[k] if r is None else ({"u": "user", "a": "assistant"}[r], turns[k][1] if k is not None else "")) for k, r in plan]
        numbers = [v[-1] for v in own if v[-1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        faults = [f for _, f in symbols]
        bad = sum(x + y not in ("su", "ua", "au") for (x, _), (y, _) in zip(symbols, symbols[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest()
        out[c] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], bad, cost, audit, digest)
    return out


def table_of(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def sample():
    rng = random.Random(3)
    texts = ["Fine.", "cut off", "", " \n", "What?", "Yes! ", "é。", "same.", "a.\x1c"]
    roles = ["user", "assistant", "system", "tool", "", "usher", None]
    rows = []
    for c in range(150):
        for t in rng.sample(range(-3, 30), rng.choice([0, 1, 2, 6, 9])):
            rows.append((c, t, rng.choice(roles[: rng.choice([3, 7])]), rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}."))
    rows += [(500, t, ["user", "assistant"][t % 2], f"long {t % 40}" + "." * (t % 3)) for t in range(110)]
    rows += [(None, t, "user", "x.") for t in (None, None, 1, 1, 2)] + [(501, None, None, None), (501, None, "user", "Yes."), (502, 3, "user", "z " * 100_000)]
    return rows


def test_conversations(spark):
    rows = sample()
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, audit int")
    assert table_of(cr.repair(df)) == brute(rows)
    assert cr.repair(df.limit(0)).count() == 0
    # the repaired conversations keep to the grammar and carry the digest's text
    want = {c: v[-1] for c, v in brute(rows).items()}
    got = {}
    for r in cr.repaired(df).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    for c, turns in got.items():
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in turns))
        assert hashlib.sha256("\n".join(f"{r}:{x}" for r, x in turns).encode()).hexdigest() == want[c]


def test_a_hot_conversation_is_cut_into_pieces(spark):
    hot = spark.range(30_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("same.").alias("text"))
    r = cr.repair(hot).collect()[0]
    assert r.duplicate + r.blank + r.truncated + 1 <= 33_000 and len(r.audit) > 25_000 and r.duplicate > 20_000


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert table_of(cr.op13_chat_repair(spark, sf)) == brute(rows)
