import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from caseweave.llm import chat_format as cf

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "s>", "a", "é", "/", "\n", "INST]"]
texts = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)
T = cf.BracketTemplate()


@settings(max_examples=300, deadline=None)
@given(texts)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    assert T.unescape(T.escape(text)) == text
    assert not any(c in T.escape(text) for c in T.CONTROLS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", ""]), texts), max_size=8), st.integers(1, 9))
def test_spans_for_any_window(turns, window):
    output, spans, bad = cf.locate(T.render, turns, window)
    assert bad == -1 and T.parse(output) == turns
    assert [T.unescape(output[a:b]) for _, _, a, b in spans] == [text for _, text in turns]
    assert "".join(output[a:b] for a, b, _, _ in spans) == output


def test_template_that_rewrites_history_is_found():
    def render(turns):
        return "".join(f"<{r}>{t if i == len(turns) - 1 else t.replace('think ', '')}</{r}>" for i, (r, t) in enumerate(turns))

    assert cf.locate(render, [("u", "a"), ("a", "think b"), ("u", "c")])[1:] == (None, 2)
    assert cf.locate(render, [("u", "a"), ("a", "b")])[2] == -1


def test_template_that_depends_on_place_falls_back_to_whole_prefixes():
    def render(turns):
        return "".join(f"<{i}>{t}</{i}>" for i, (_, t) in enumerate(turns))

    turns = [("u", f"t{i}") for i in range(9)]
    output, spans, bad = cf.locate(render, turns, window=3)
    assert bad == -1 and [output[a:b] for _, _, a, b in spans] == [t for _, t in turns]


def test_long_conversation_streams(spark):
    random.seed(3)
    rows = [(1, k, "assistant" if k % 2 else "user", random.choice(PIECES) * 3) for k in range(700)]
    out = cf.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert out.n_turns == 700 and out.loss_sha256 == hashlib.sha256("".join(t for _, k, _, t in rows if k % 2).encode()).hexdigest()


def test_nulls_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, n_turns long"
    rows = [(1, 0, "user", "x", 5), (1, 0, "user", "x", 5), (1, 1, None, None, 5), (None, 0, "assistant", "y", 5), (1, None, "system", "z", 5)]
    df = spark.createDataFrame(rows, schema)
    out = {r.conv_id: r for r in cf.format_conversations(df).collect()}
    assert out[1].n_turns == 4 and T.parse(out[1].formatted)[0] == ("system", "z") and T.parse(out[1].formatted)[-1] == ("", "")
    assert out[None].loss_chars == 1
    assert cf.format_conversations(df.limit(0)).count() == 0
