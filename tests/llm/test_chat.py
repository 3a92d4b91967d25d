"""Chat examples: reversible, and each reply once under the loss mask."""

from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import chat

tricky = st.text(alphabet=st.sampled_from("<|\\im_start end>\n" + "aé👍"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(tricky)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.just("assistant"), st.just("user"), tricky), tricky), min_size=1, max_size=6))
def test_examples_of_any_turns(turns):
    made = list(chat.examples_of(turns))
    assert chat.read_turns(made[-1][0]) == turns
    replies = [chat.unescape(text[a:b]) for text, a, b in made if text[a:b] or a != b or text[:a].endswith("assistant\n")]
    wanted = [text for role, text in turns if role == "assistant"]
    assert [r for r in replies if r] == [w for w in wanted if w]
    for text, a, b in made:
        assert 0 <= a <= b <= len(text)


def test_frame(spark):
    rows = [
        (1, 2, "assistant", "second", 0),
        (1, 0, "system", None, 0),
        (1, 1, "user", "first <|im_end|>", 0),
        (1, 3, "user", "last", 0),
        (2, 0, "user", "alone", 0),
        (3, 0, "assistant", "hi", 0),
        (3, 0, "assistant", "hi", 0),
        (None, None, None, None, 0),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example int")
    made = chat.expand(turns)
    found = {}
    for row in chat.read_back(made).collect():
        found.setdefault(row["conv_id"], {})[row["example"]] = row
    assert found[1][0]["reply"] == "second" and found[1][0]["turns"] is None
    assert [tuple(t) for t in found[1][1]["turns"]] == [
        ("system", ""),
        ("user", "first <|im_end|>"),
        ("assistant", "second"),
        ("user", "last"),
    ]
    assert found[2][0]["reply"] == ""
    assert [found[3][n]["reply"] for n in (0, 1)] == ["hi", "hi"]
    assert [tuple(t) for t in found[None][0]["turns"]] == [("", "")]
    assert chat.expand(turns.limit(0)).count() == 0


def test_long_conversation_is_handed_on_in_parts(spark, monkeypatch):
    turns = spark.range(400).selectExpr(
        "7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat('word ', 50) as text"
    )
    made = chat.expand(turns)
    assert made.count() == 200
    assert made.filter("is_last").count() == 1
