"""The automaton against the library's tokenizer and against plain merging."""

import hashlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidewatch.llm import bpe_automaton
from tidewatch.llm.bpe_automaton import Automaton, AutomatonEncoder, Labels
from tidewatch.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n\n", "don't they'll WE'RE 'tis ''s", "a  b\t\tc \n d", "été  là", "foo...bar!?baz", "a<|endoftext|>b <|endoftext|><|endoftext|>", "<|endo", "ftext|>",
       "日本語 テキスト。", "a" * 700, "-" * 300 + "x", "ab" * 400, "\x1c a\x1db \x85 c", "é" * 200, "0123456789" * 30]


def plainly(merges, word):
    """Merge by merge, leftmost first."""
    parts = [bytes([b]) for b in word]
    for u, v in merges:
        out = []
        for x in parts:
            if out and out[-1] == u and x == v:
                out[-1] = u + v
            else:
                out.append(x)
        parts = out
    return parts


def paths(automaton, words):
    tokens, begin = automaton.paths(words)
    return [[automaton.labels[t] for t in tokens[a:b]] for a, b in zip(begin[:-1], begin[1:])]


@settings(max_examples=25, deadline=None)
@given(st.data())
def test_gadgets_against_plain_merging(data):
    made = [b"a", b"b", b"c"]
    merges = []
    for _ in range(data.draw(st.integers(0, 12))):
        u, v = data.draw(st.sampled_from(made)), data.draw(st.sampled_from(made))
        if u + v not in made and len(u + v) < 9:
            merges.append((u, v))
            made.append(u + v)
    automaton = Automaton(merges)
    words = [bytes(w) for n in range(7) for w in product(b"abc", repeat=n)] + [b"a" * 70, b"ab" * 40, b"aab" * 30]
    want = [plainly(merges, w) for w in words]
    assert paths(automaton, words) == want
    for w, parts in zip(words, want):
        assert [automaton.labels[t] for t in automaton.one(w)] == parts


def test_arcs_are_the_neighbours_that_occur():
    """S(t) has arc x exactly when t and x are how their joint text is tokenized."""
    merges = [(b"a", b"b"), (b"b", b"a"), (b"ab", b"a"), (b"a", b"a"), (b"aa", b"aa")]
    automaton = Automaton(merges)
    tokens = [t for t in range(automaton.size) if automaton.labels[t].strip(b"ab") == b"" and plainly(merges, automaton.labels[t]) == [automaton.labels[t]]]
    for t, x in product(tokens, tokens):
        alone = plainly(merges, automaton.labels[t] + automaton.labels[x]) == [automaton.labels[t], automaton.labels[x]]
        assert bool(automaton.follows(np.array([t]), np.array([x]))[0]) == alone


@pytest.mark.parametrize("merges", [[(b"ab", b"c")], [(b"a", b"b"), (b"a", b"b")]])
def test_improper_merges_are_refused(merges):
    with pytest.raises(ValueError):
        Automaton(merges)


def encoded(texts):
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    encoder = AutomatonEncoder.of(FILE)
    ids, bounds = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), at)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])], Labels.of(FILE).texts(ids, bounds)


def library(texts):
    return [x.ids for x in Tokenizer.from_file(FILE).encode_batch(texts, add_special_tokens=False)]


def test_odd_texts():
    assert encoded(ODD) == (library(ODD), ODD)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.'-sStTheaoin1é  ́"), st.characters(codec="utf-8")), max_size=60), max_size=6))
def test_any_text(texts):
    assert encoded(texts) == (library(texts), texts)


def test_rows_and_queries(spark, folder, odd, odd_rows, nothing):
    tokenizer = Tokenizer.from_file(FILE)

    def plain(i, text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        spelled = ",".join(map(str, ids))
        return i, len(ids), hashlib.sha256(spelled.encode()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op12_bpe_automaton"](spark, folder).collect())) == sorted(plain(*r) for r in docs)
    both = bpe_automaton.decode(bpe_automaton.encode(odd, FILE), FILE)
    assert sorted((str(r.doc_id), r.text) for r in both.collect()) == sorted((str(i), t or "") for i, t in odd_rows)
    assert sorted(map(tuple, bpe_automaton.round_trip(odd, FILE).collect()), key=str) == sorted((plain(*r) for r in odd_rows), key=str)
    assert bpe_automaton.decode(bpe_automaton.encode(nothing, FILE), FILE).count() == bpe_automaton.round_trip(nothing, FILE).count() == 0
    broken = spark.createDataFrame([(1, bytearray(np.array([220, 128], "<u4").tobytes())), (2, None)], "doc_id long, ids binary")
    assert {r.doc_id: r.text for r in bpe_automaton.decode(broken, FILE).collect()} == {1: tokenizer.decode([220, 128], skip_special_tokens=False), 2: ""}
