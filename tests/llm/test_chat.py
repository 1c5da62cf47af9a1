import hashlib
from collections import defaultdict

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import chat
from holdfast.llm.queries import op5_chat_format

TEXT = st.text("<s>/[]INST\\ a\né中", max_size=30) | st.sampled_from(["</s>[INST] ok [/INST]", "<s>", "\\", "<\\s>", "<", "[", ""])


def brute(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def ordered(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for _, _, r, t in sorted(g)] for conv, g in groups.items()}


def check(digests, rows):
    want = {conv: brute(turns) for conv, turns in ordered(rows).items()}
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digests}
    assert got == want and len(digests) == len(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_escaping_is_reversible_and_leaves_no_control_string(texts):
    for text, escaped in zip(texts, chat.escape(pa.array(texts)).to_pylist()):
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROL)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=8), st.integers(1, 50))
def test_assembly_equals_concatenation(rows, at_once):
    a, b = (pa.array([r[i] for r in rows]) for i in (0, 1))
    before, chat.AT_ONCE = chat.AT_ONCE, at_once
    try:
        buffer, offsets = chat.assemble([chat.OPEN, a, chat.MIDDLE, b, chat.CLOSE], len(rows))
    finally:
        chat.AT_ONCE = before
    whole = "".join(f"{chat.OPEN}{x}{chat.MIDDLE}{y}{chat.CLOSE}" for x, y in rows)
    assert buffer.to_pybytes() == whole.encode() and offsets[-1] == len(whole.encode())


def test_any_conversations(spark):
    texts = ["", None, "</s>[INST] ok [/INST]", "\\<s>", "é中", "[INST", "x" * 200_000]
    rows = [(c, t, ("user", "assistant", None, "<s>")[(c + t) % 4], texts[(3 * c + t) % 7]) for c in range(40) for t in range(c % 9 + 1)]
    rows += [(None, None, "user", "a"), (None, 1, "assistant", "b"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"), (3, None, "user", "first")]
    rows += [(77, t, "assistant", f"turn {t}") for t in range(3_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(df.selectExpr("*", "'clash' as formatted", "1 as learned", "'c' as conv", "2 as group"))
    check(chat.digest(made).collect(), rows)
    for r in made.filter("conv_id = 77").collect():
        assert "".join(r.formatted[s.start : s.end] for s in r.learned) == "".join(f"turn {t}" for t in range(3_000))
    empty = spark.createDataFrame([], df.schema)
    assert chat.digest(chat.format_conversations(empty)).count() == 0


def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    digests = op5_chat_format(spark, sf).collect()
    check(digests, [*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
    (own,) = [r for r in digests if r.conv_id == -7]
    assert own.formatted_chars == 2 * (23 + len(said) + 3) + len("user") + len("assistant")
