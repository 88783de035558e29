"""Licence scans: Aho-Corasick over normalised words, and a shunting-yard evaluation of licence expressions.

Each text is lowered (A-Z), everything but letters, digits and characters beyond ASCII becomes one
blank, and one automaton finds every notice phrase and every identifier tag in a single pass over
the words. A phrase counts only as whole words. Where the tag occurs, the expressions behind it are
read from the text as written and evaluated:

    expression := term (OR term)* ; term := factor (AND factor)* ; factor := id [WITH exception] | ( expression )

Labels: the base ones (mit, apache, gpl), one for every notice phrase of `NOTICES`, and `spdx:<id>`
for every licence of an expression (lower case, with `+exception` for WITH). The score is how
freely the text may be used, from 0 to 1: a licence has the value of its family in `FREEDOM`, OR
takes the larger value, AND the smaller, WITH lifts a value halfway to the next family; notices of
one text add up as AND. Without any finding the score is 0. An expression that can't be parsed
gives the label `spdx:invalid` and no value.

Null text counts as empty. Repeated rows are all returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import KEY, keyed, text_array

#: Base phrases and their labels; fixed by the contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: More notice phrases: label and family.
NOTICES = {
    "mit license": ("notice:mit", "permissive"),
    "apache license": ("notice:apache", "permissive"),
    "general public license": ("notice:gpl", "copyleft"),
    "lesser general public license": ("notice:lgpl", "weak-copyleft"),
    "affero general public license": ("notice:agpl", "network-copyleft"),
    "mozilla public license": ("notice:mpl", "weak-copyleft"),
    "bsd license": ("notice:bsd", "permissive"),
    "isc license": ("notice:isc", "permissive"),
    "cc by": ("notice:cc-by", "permissive"),
    "cc by sa": ("notice:cc-by-sa", "copyleft"),
    "cc by nc": ("notice:cc-by-nc", "non-commercial"),
    "creative commons attribution": ("notice:cc-by", "permissive"),
    "public domain": ("notice:public-domain", "public-domain"),
    "all rights reserved": ("notice:all-rights-reserved", "reserved"),
}
FREEDOM = {"public-domain": 1.0, "permissive": 0.9, "weak-copyleft": 0.6, "copyleft": 0.4, "network-copyleft": 0.3, "non-commercial": 0.2, "unknown": 0.1, "reserved": 0.0}
#: Family by the beginning of an identifier, the longest one that fits.
FAMILIES = {
    "mit": "permissive", "apache": "permissive", "bsd": "permissive", "isc": "permissive", "zlib": "permissive", "cc-by": "permissive",
    "cc0": "public-domain", "unlicense": "public-domain", "lgpl": "weak-copyleft", "mpl": "weak-copyleft", "epl": "weak-copyleft",
    "gpl": "copyleft", "cc-by-sa": "copyleft", "agpl": "network-copyleft", "cc-by-nc": "non-commercial",
}
TAG = "spdx license identifier"
TAGGED = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.I | re.A)
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*", re.A)
OPERATORS = {"OR": 1, "AND": 2, "WITH": 3}

_SPACED = bytearray(range(256))
for _c in range(128):
    _SPACED[_c] = _c + 32 if 65 <= _c <= 90 else _c if 48 <= _c <= 57 or 97 <= _c <= 122 else 32
_SPACED = bytes(_SPACED)


def family(name: str) -> str:
    fits = [p for p in FAMILIES if name == p or name.startswith(p + "-")]
    return FAMILIES[max(fits, key=len)] if fits else "unknown"


def postfix(expression: str) -> list[str]:
    """Tokens of an expression in postfix order, by the shunting-yard algorithm; ValueError if it is none."""
    out, stack, operand_next = [], [], True
    for token in TOKEN.findall(expression):
        rank = OPERATORS.get(token.upper())
        if token == "(" or rank is None and token != ")":
            if not operand_next:
                break  # the expression ends where two operands meet: what follows is prose
            if token == "(":
                stack.append(token)
            else:
                out.append(token)
                operand_next = False
        elif operand_next:
            raise ValueError(f"{token} where a licence should stand")
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        else:
            while stack and stack[-1] != "(" and OPERATORS[stack[-1]] >= rank:
                out.append(stack.pop())
            stack.append(token.upper())
            operand_next = True
    if operand_next or "(" in stack:
        raise ValueError("the expression is not complete")
    return out + stack[::-1]


def lifted(value: float) -> float:
    above = [v for v in FREEDOM.values() if v > value]
    return (value + min(above)) / 2 if above else value


def evaluate(expression: str) -> tuple[float, set[str]]:
    """Value and licence names of an expression."""
    stack: list[tuple[float, set[str]]] = []
    for token in postfix(expression):
        if token in OPERATORS:
            (b, names_b), (a, names_a) = stack.pop(), stack.pop()
            if token == "WITH":
                if len(names_a) != 1 or len(names_b) != 1:
                    raise ValueError("WITH joins one licence and one exception")
                stack.append((lifted(a), {f"{next(iter(names_a))}+{next(iter(names_b))}"}))
            else:
                stack.append(((max if token == "OR" else min)(a, b), names_a | names_b))
        else:
            name = token.lower()
            stack.append((FREEDOM[family(name.rstrip("+"))], {name}))
    return stack[0]


@lru_cache(1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan_text(text: str) -> tuple[int, list[tuple[str, int]], set[str], float]:
    """(words, base places as (label, word), labels of the method, score)."""
    words = text.encode().translate(_SPACED).split()
    joined = " " + b" ".join(words).decode() + " "
    places, notices, labels, values, tagged = [], [], set(), [], False
    passed = number = 0  # how far words are counted, and the number of blanks up to there
    for end, phrase in automaton().iter(joined):
        if phrase in BASE:
            start = end - len(phrase)
            # Places come by their end, and phrases are short: the count goes on from just before the last one.
            number, passed = (number + joined.count(" ", passed, start), start) if start >= passed else (number - joined.count(" ", start, passed), start)
            places.append((BASE[phrase], number - 1))
        if phrase in NOTICES:
            notices.append((end - len(phrase), end, phrase))
        tagged |= phrase == TAG
    reach = -1
    for start, end, phrase in sorted(notices, key=lambda x: (x[0], -x[1])):
        if end > reach:  # a phrase within a longer one is not a notice of its own
            reach, (label, kind) = end, NOTICES[phrase]
            labels.add(label)
            values.append(FREEDOM[kind])
    if tagged:
        for m in TAGGED.finditer(text):
            try:
                value, names = evaluate(m[1])
            except ValueError:
                labels.add("spdx:invalid")
            else:
                values.append(value)
                labels |= {f"spdx:{n}" for n in names}
    return len(words), places, labels, min(values, default=0.0)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    for batch in batches:
        found = [scan_text(t) for t in text_array(batch.column("text")).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            *(batch.column(c) for c in ("doc_id", *KEY)), pa.array([f[0] for f in found], pa.int64()),
            pa.array([[{"label": label, "word": w} for label, w in f[1]] for f in found], place),
            pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())), pa.array([f[3] for f in found], pa.float64()),
        ], ["doc_id", *KEY, "n_words", "places", "own_labels", "score"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, _id, _hash, n_words, places, own_labels, score): one row for each row of `docs`."""
    schema = "doc_id long, _id long, _hash long, n_words long, places array<struct<label: string, word: long>>, own_labels array<string>, score double"
    return keyed(docs).mapInArrow(_scanned, schema)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of `scan`."""
    words, base = F.transform("places", lambda p: p["word"]), F.array_distinct(F.transform("places", lambda p: p["label"]))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, "own_labels")), ",").alias("labels"), "score",
    )
