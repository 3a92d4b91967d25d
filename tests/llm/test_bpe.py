"""BPE against the tokenizers library."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickloom.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)

TEXTS = [
    "",
    " ",
    "\n\n  a  b \t\n c   ",
    "It's they'll I'D we've 12345 ½ ² 東京 naïve ﬁ",
    "<|endoftext|> a<|endoftext|><|endoftext|>b <|endoftext",
    "x" * 5000,
    "ab " * 3000,
    "\x1c\x1d a\u00a0b\u2003c\u3000d\u0085e",
    "👩‍👩‍👧 e\u0301 \U0001f600\U0010ffff\x00",
    "__init__ a_b -- ... !?",
]


def _ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_text_are_the_library_s(text):
    encoder = bpe.encoder(PATH)
    ids = encoder.encode(text)
    assert ids == _ids(text)
    assert encoder.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert packing.token_ids(text, PATH).tolist() == ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"])))
def test_any_text(text):
    encoder = bpe.encoder(PATH)
    ids = encoder.encode(text)
    assert ids == _ids(text)
    assert encoder.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert packing.token_ids(text, PATH).tolist() == ids


def test_memory_is_bounded_and_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.BytePairEncoder(PATH)
    text = "one two three four five one two six seven eight nine one"
    assert encoder.encode(text) == encoder.encode(text) == _ids(text)
    assert len(encoder.memory) + len(encoder.memory.older) <= 7


def test_frames(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 5), (3, "two words", 5), (3, "two words", 5), (None, "x", 5)],
        "doc_id long, text string, ids int",
    )
    encoded = bpe.encode(docs, PATH)
    assert encoded.columns == ["doc_id", "ids"]
    found = sorted(map(tuple, bpe.decode(encoded, PATH).collect()), key=str)
    assert found == sorted(
        [(1, ""), (2, ""), (3, "two words"), (3, "two words"), (None, "x")], key=str
    )
    assert bpe.encode(docs.limit(0), PATH).count() == 0
