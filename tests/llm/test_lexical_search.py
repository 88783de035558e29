"""Search against SQL and against plain scoring; the sharing graph against its items."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from oracle import connect, differences
from tidewatch.llm import lexical_search
from tidewatch.llm.queries import ORACLES, QUERIES


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plainly(docs, items, top=20):
    lists = [(i, terms(t)) for i, t in docs]
    count, total = sum(bool(w) for _, w in lists), sum(len(w) for _, w in lists)
    having = Counter(t for _, w in lists for t in set(w))
    by_item = {}
    for i, t in dict.fromkeys(items):
        by_item.setdefault(i, []).extend(terms(t))
    out = []
    for item, wanted in by_item.items():
        scores = []
        for i, words in lists:
            tf, score = Counter(words), 0
            m = 75 + 25 * len(words) * count // max(total, 1)
            for t in wanted:
                if tf[t]:
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * having[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
            if score:
                scores.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_query_against_sql(spark, folder):
    assert differences(QUERIES["op13_lexical_search"](spark, folder), connect(folder), ORACLES["op13_lexical_search"]) == []


@pytest.mark.parametrize("block", [lexical_search.BLOCK, 4])
def test_odd_rows(spark, odd, odd_rows, nothing, block, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    rows = [(1, "The RIVER of the north"), (1, "The RIVER of the north"), (2, None), (3, ""), (4, "river north boats the the the"), (5, "river north boats songs"),
            (5, "three two"), (None, "one three"), (6, "nowhere"), (7, "été1")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    got = lexical_search.search(odd, items, top=4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plainly(odd_rows, rows, 4)
    assert lexical_search.search(nothing, items).count() == 0
    assert lexical_search.search(odd, items.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 9), st.integers(1, 3), max_size=8), max_size=8))
def test_shared_sums(items):
    graph = lexical_search.share(items, 10)
    sums = lexical_search.Accumulators(graph, np.ones(10, np.int64), 1, 1)
    doc, term = np.meshgrid(np.arange(3), np.arange(10))
    # counts are chosen so that only the weights matter
    sums.weights = np.arange(1, 11)
    one = sums.weights * (10**9 // (1000 + 12 * 100))
    got = sums.scores(np.ones(3, np.int64), doc.ravel(), term.ravel(), np.ones(30, np.int64))
    assert [r.tolist() for r in got] == [[sum(c * int(one[t]) for t, c in item.items())] * 3 for item in items]


def test_work_is_shared():
    rng = np.random.default_rng(3)
    common = [rng.choice(50, 12, replace=False) for _ in range(4)]
    items = [{int(t): 1 for t in np.concatenate([common[k % 4], 50 + rng.choice(500, 3)])} for k in range(200)]
    graph = lexical_search.share(items, 550)
    assert graph.additions < sum(len(i) - 1 for i in items) / 2
