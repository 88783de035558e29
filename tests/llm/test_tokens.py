import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from tidewatch.llm.tokens import WORD, Encoder, with_end

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = [
    "", " ", "\n\n", "don't they'll WE'RE 'tis ''s", "a  b\t\tc \n d", "x  y", "x  y", "été  là", "é É́",
    "foo...bar!?baz", "a<|endoftext|>b <|startoftext|>", "A<|ENDOFTEXT|>b", "İstanbul ſtraße ΑΣ", "12 345 6a7", "日本語 テキスト。", "\x1c a\x1db \x85 c", "end ", "  lead",
]


def encoded(name, texts):
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    encoder = Encoder.of(public_tokenizers.path(name))
    ids, bounds = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), at)
    whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])], whole


@pytest.mark.parametrize("name", FILES)
def test_odd_texts(name):
    got, want = encoded(name, ODD)
    assert got == want


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.'-sStT1é  ́"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_any_text(name, texts):
    got, want = encoded(name, texts)
    assert got == want


def test_end_ids():
    ids, bounds = with_end(np.array([5, 6, 7], np.uint32), np.array([0, 2, 2, 3]), 1)
    assert ids.tolist() == [5, 6, 1, 1, 7, 1]
    assert bounds.tolist() == [0, 3, 4, 6]


@pytest.mark.parametrize("name", FILES)
def test_plain_words_go_to_the_model(name):
    """The shortcut for plain words is in use and gives the library's ids; all else goes the whole way."""
    encoder = Encoder(public_tokenizers.path(name))
    rng = np.random.default_rng(1)
    letters = [*"abcdefghijklmnopqrstuvwxyz", *map(chr, range(0xDF, 0xF7)), *map(chr, range(0xF8, 0x100))]
    words = [str(rng.choice(["", " "])) + "".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(3_000)]
    assert encoder.lead is not None and all(WORD.fullmatch(w) for w in words)
    assert not any(map(WORD.fullmatch, ["", " ", "  a", "a b", "don't", " É", "a1", "÷", "é", "\ta"]))
    whole = [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]

    class Unused:
        def encode_batch_fast(self, texts, add_special_tokens):
            assert not texts
            return []

    encoder.tokenizer = Unused()
    assert encoder._ids(words) == whole
