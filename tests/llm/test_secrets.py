"""The base part against a plain version on whole tables, and the network on kinds it has never seen."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import secrets
from tidewatch.llm.queries import QUERIES

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain_base(text):
    """The contract's three patterns, word for word."""
    found = [("assign", m) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 12]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ["assign", "access", "hex"]
    spans = sorted((m.start(), order.index(kind), m.end()) for kind, m in found)
    return [f"{order[k]}:{a}:{b}" for a, k, b in spans]


def test_query_against_plain(spark, folder):
    got = {r.doc_id: r for r in QUERIES["op4_secrets"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, text in rows:
        base, r = plain_base(text or ""), got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex")]
        assert [x for x in r.spans.split(",") if x and not x.startswith("network")] == base


def marked(net, runs):
    """Share of the runs that get a span of the network in a plain sentence."""
    found = secrets.all_spans([f"we saw the value {r} in the notes today" for r in runs], secrets.Folds((net, net)))
    return np.mean([any(kind == 3 for _, kind, _ in spans) for spans in found])


@pytest.fixture(scope="module")
def half_seen():
    """Whole kinds are held out on both sides: secrets and ordinary runs."""
    shapes, forms = ("chat", "mail", "package", "deploy", "model"), ("doi", "isbn", "version", "class", "order")
    net = secrets.fixed(tuple(s for s in secrets.SHAPES if s not in shapes), tuple(f for f in secrets.FORMS if f not in forms))
    return net, shapes, forms


def test_secrets_of_unseen_shapes_are_found(half_seen):
    net, shapes, _ = half_seen
    rng = np.random.default_rng(1)
    assert all(marked(net, [secrets.token(rng, s) for _ in range(200)]) >= 0.9 for s in shapes)


def test_ordinary_runs_of_unseen_kinds_are_left_alone(half_seen):
    net, _, forms = half_seen
    rng = np.random.default_rng(2)
    for form in forms:
        runs = [r for r in (secrets.written(rng, str(rng.choice(secrets.FORMS[form]))) for _ in range(400)) if len(r) >= secrets.LEAST]
        assert marked(net, runs) <= 0.02, form


def test_short_rests_are_judged():
    class Digits:
        """Marks what holds a digit."""
        threshold = 0.5

        def probability(self, frames):
            inside = frames[:, secrets.CONTEXT : secrets.CONTEXT + secrets.INSIDE]
            return ((inside >= 48) & (inside < 58)).any(axis=1).astype(float)

    text = "0123456789abcdef.Zq81"
    assert [(a, b) for a, kind, b in secrets.all_spans([text], Digits())[0] if kind == 3] == [(16, 21)]


def test_a_findings_count_switches_nothing(spark):
    """One finding more or less changes weights, not the method: every table has its own two networks."""
    sentence = "see {} there"
    texts = [sentence.format(f"{i:016x}") for i in range(3)] + ["plain words only"]
    small, none = (secrets.train(spark.createDataFrame([(i, t) for i, t in enumerate(part)], "doc_id long, text string")) for part in (texts, texts[3:]))
    rng = np.random.default_rng(3)
    for net in (small, none):
        assert isinstance(net, secrets.Folds) and len(set(map(id, net.nets))) == 2
        for n in net.nets:
            assert marked(n, [secrets.token(rng, "github") for _ in range(50)]) >= 0.9
            assert marked(n, [secrets.written(rng, secrets.FORMS["phone"][0]) + "-1" for _ in range(50)]) <= 0.02


def test_every_finding_is_fitted_on(spark):
    """More findings than any bound of rows: all of them are in the parts, and the threshold keeps the recall of all that are held."""
    rng = np.random.default_rng(4)
    texts = [f"we saw {rng.bytes(10).hex()} and /{secrets.spoken(rng, 9)}/{secrets.spoken(rng, 9)}/ there" for _ in range(6_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = secrets.parts(docs, rows=1_500).collect()
    own = [r for r in table if r.kind == 0]
    for label in (0, 1):
        assert len({bytes(r.frame) for r in own if r.label == label}) == sum(r.label == label for r in own) == 6_000
    sizes = Counter((r.net, r.part) for r in own)
    assert {k for k, _ in sizes} == {0, 1} and len(sizes) >= 8 and max(sizes.values()) <= 2_000
    net = secrets.train(docs, rows=1_500)
    for k, one in enumerate(net.nets):
        held = [r for r in own if r.net == k and r.held]
        score = one.probability(np.array([np.frombuffer(r.frame, np.uint8) for r in held]))
        assert np.mean(score[[r.label == 1 for r in held]] >= one.threshold) >= secrets.RECALL - 1e-9
        assert marked(one, [secrets.token(rng, "github") for _ in range(50)]) >= 0.9
        assert marked(one, [secrets.written(rng, secrets.FORMS["phone"][0]) + "-1" for _ in range(50)]) <= 0.02


def test_every_finding_fits_one_network_and_calibrates_the_other(spark, monkeypatch):
    """No share of the findings is left to the threshold or to the weights alone; only ordinary runs that both networks judge fit neither."""
    rng = np.random.default_rng(6)
    around = "and so on for quite a few words {} and so on for quite a few more"
    both = {0: "/usr/lib/python3/site-packages/module.py", 1: "0123456789abcdef0123"}
    texts = [f"we saw {rng.bytes(10).hex()} and /{secrets.spoken(rng, 9)}/{secrets.spoken(rng, 9)}/ there" for _ in range(300)]
    texts += [f"{i} {around.format(run)} {i}" for run in both.values() for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    calls, plain = [], secrets.calibrated
    monkeypatch.setattr(secrets, "calibrated", lambda net, *counts: calls.append(counts) or plain(net, *counts))
    table = secrets.parts(docs, rows=100)
    judged = {k: {(bytes(r.frame), r.label) for r in table.filter(f"kind = 0 AND net = {k}").collect()} for k in (0, 1)}
    fits = {k: [(bytes(r.frame), r.label) for r in secrets.fitted(table).filter(f"kind = 0 AND net = {k}").collect()] for k in (0, 1)}
    shared = {run: (secrets.codes(around.format(run), 32, 32 + len(run)).tobytes(), label) for label, run in both.items()}
    assert len(judged[0] | judged[1]) == 602 and judged[0] & judged[1] == {shared[both[0]]}
    assert sorted(fits[0] + fits[1]) == sorted((judged[0] | judged[1]) - {shared[both[0]]})
    assert all(not set(fits[k]) & judged[k] for k in (0, 1))
    secrets.train(docs, rows=100)
    counted = [int(counts[kinds == 0].sum()) for kinds, _, _, counts in calls[-2:]]
    assert counted == [len(judged[0]), len(judged[1])]
