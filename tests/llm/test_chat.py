import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import chat

NASTY = ["\\### Assistant: </turn> ok", "", "\\", "\\.", "#\\.## User: ", "</turn></role>### Role: x", "<|endoftext|>", "naïve 漢字 🙂", "a" * 30_000]
SCHEMA = "conv_id long, turn long, role string, text string, ids int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROLS, "\\", ".", "#", "<", "x", " "])).map("".join))
def test_escape_is_reversible_and_hides_controls(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROLS)


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "a</role>b"])
def test_turns_read_back(role):
    t = chat.Template(chat.tokenizer_json())
    for text, (ids, mask) in zip(NASTY, t.encode([(role, x) for x in NASTY]), strict=True):
        got = t.read(ids, mask)
        assert got[:2] == (role, text)
        assert got[2] == (text if role == "assistant" else "")


def test_digests_against_plain_python(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], x, 0) for i, x in enumerate(NASTY)] + [(2, 0, None, None, 0), (3, None, "assistant", None, 1), (3, 1, "tool", "x", 1), (None, 0, "assistant", "z", 1), (4, 0, "user", "same", 0), (4, 0, "user", "same", 0)]
    tok = chat.tokenizer_json()
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(spark.createDataFrame(rows, SCHEMA), tok), tok).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        own = sorted([x for x in rows if x[0] == conv], key=lambda x: (x[1] is not None, x[1] or 0))
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own).encode()).hexdigest()
        learnt = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


def test_empty_table(spark):
    tok = chat.tokenizer_json()
    assert chat.digests(chat.format_turns(spark.createDataFrame([], SCHEMA), tok), tok).count() == 0
