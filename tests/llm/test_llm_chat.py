"""Chat windows: exact round trips, budgets, masks, and conversations of many blocks."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandlens.llm import chat_windows as cw

BITS = st.lists(st.sampled_from(["\\", "#", "##", "###", "### ", "</turn>", "</tur", " </turn>\n", "### Assistant: ", "\\h", "\\t", ":", "\n", "a", " ", "é"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant", "", "User", "\\rx"]), BITS), BITS), max_size=6))
def test_template_is_reversible(turns):
    formatted = "".join(cw.format_turn(r, t)[0] for r, t in turns)
    read = list(cw.parse(formatted))
    assert [(r, t) for r, t, _, _ in read] == turns
    for (_, text, i, j) in read:
        assert cw.unescape(formatted[i:j]) == text
        assert "###" not in formatted[i:j] and "</turn>" not in formatted[i:j]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """Digests straight from the rows (conv_id, turn, role, text)."""
    out = {}
    for c, t, r, x in sorted(rows, key=lambda v: (str(v[0]), v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    res = {}
    for c, turns in out.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        res[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return res


def got_of(df):
    rows = df.collect()
    res = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert len(res) == len(rows)
    return res


def sample():
    rng = random.Random(5)
    rows = []
    for c in range(12):
        if rng.random() < 0.6:
            rows.append((c, 0, "system", f"rules {c} " * rng.choice([1, 30])))
        for t in range(1, rng.choice([1, 3, 40])):
            rows.append((c, t, "user" if t % 2 else "assistant", " ".join(rng.choice(["ein", "thw", "###", "</turn>", "\\"]) for _ in range(rng.choice([0, 5, 60])))))
    rows += [(None, 1, "user", "no id"), (None, None, None, None), (None, 1, "user", "no id")]
    rows += [(50, t, "system" if t == 250 else "user" if t % 2 else "assistant", f"turn {t} of a long one " * 4) for t in range(250, 1500)]  # blocks
    rows += [(51, t, "assistant", "same") for t in (None, None, -3, -300, 7, 7, 90000)]
    rows += [(52, 0, "system", "long " * 3000), (52, 1, "user", "u" * 100_000), (52, 2, "assistant", "a b " * 40_000), (52, 3, "user", "")]
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    rows = sample()
    df = spark.createDataFrame([(*r, "z", 0) for r in rows], "conv_id long, turn long, role string, text string, block string, window int")
    return rows, df


@pytest.mark.parametrize("settings_", [{}, {"budget": 64, "history_tokens": 20}, {"history_turns": 0}])
def test_read_back(frame, settings_):
    rows, df = frame
    assert got_of(cw.read_back(cw.windows(df, **settings_))) == brute(rows)


def test_windows(frame):
    rows, df = frame
    budget, most = 300, 80
    out = cw.format_conversations(df, budget=budget, history_tokens=most, history_turns=3).orderBy("conv_id", "block", "window").collect()
    path = cw.vocabulary_path()
    first_role = {}
    for c, t, r, x in sorted(rows, key=lambda v: (str(v[0]), v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        first_role.setdefault(c, (r, x))
    seen = {}
    for w in out:
        turns = [(r, x, cw.count_tokens(r, x, path)) for r, x, _, _ in cw.parse(w.text)]
        assert w.n_tokens == sum(n for *_, n in turns) and len(turns) == w.n_repeated + w.n_turns
        assert w.over_budget == (w.n_tokens > budget)
        if w.over_budget:  # one long turn, with the system turn at most
            assert w.n_turns == 1 and all(r == "system" for r, *_ in turns[: w.n_repeated])
        head, text = first_role[w.conv_id]
        own = seen.setdefault(w.conv_id, [])
        lead = turns[: w.n_repeated]
        if head == "system" and own and 2 * cw.count_tokens(head, text, path) <= budget:
            assert lead[0][:2] == (head, text)
            lead = lead[1:]
        assert len(lead) <= 3 and sum(n for *_, n in lead) <= most
        assert [v[:2] for v in lead] == own[len(own) - len(lead) :]  # the turns right before the span
        # the mask covers the new assistant texts and nothing else
        masked = [cw.unescape(w.text[i:j]) for i, j in zip(w.loss_start, w.loss_end)]
        assert masked == [x for r, x, _ in turns[w.n_repeated :] if r == "assistant"]
        own += [v[:2] for v in turns[w.n_repeated :]]
    blocks = {w.block for w in out if w.conv_id == 50}
    assert len(blocks) == 6 and any(w.n_repeated > 1 and w.window == 0 and w.conv_id == 50 for w in out)


def test_a_hot_conversation_is_spread(spark):
    hot = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("hello there").alias("text"))
    rows = cw.windows(hot).select("block", F.spark_partition_id().alias("p")).distinct().collect()
    assert len({r.block for r in rows}) == 79 and len({r.p for r in rows}) > 4


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    odd = "\\### Assistant: </turn> ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = cw.op11_chat_windows(spark, sf)
    assert got_of(df) == brute(rows + [(-7, 0, "user", odd), (-7, 1, "assistant", odd)])
    assert cw.read_back(cw.windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
