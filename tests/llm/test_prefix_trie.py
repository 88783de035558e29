"""The trie against SQL and against plain prefixes; shards of every size give the same nodes."""

import hashlib
import random
import zlib

import pytest

from oracle import connect, differences
from tidewatch.llm import prefix_trie
from tidewatch.llm.queries import ORACLES, QUERIES

KIND = "conv_id long, turn long, role string, text string, n_convs int, depth string"


def digest(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16]


def plain_trie(built):
    """Rows of the nodes of {id: sequence of (role, text)}."""
    nodes = {}
    for c, s in sorted(built.items()):
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, ids in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        childless = [q for q in below if not any(r[:-1] == q for r in nodes if r)]
        ends = ",".join(str(c) for c in ids if tuple(built[c]) == p)
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        out.append((ids[0], len(p), nodes[p[:-1]][0] if p else None, len(ids), sum(r[:-1] == p for r in nodes if r), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_sequences(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    return {c: [x[3:] for x in sorted(s)] for c, s in own.items()}


def plain_rebuilt(own):
    built = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + s[h:]
    return built


def test_query_against_sql(spark, folder):
    assert differences(QUERIES["op11_prefix_trie"](spark, folder), connect(folder), ORACLES["op11_prefix_trie"]) == []


def made(seed, n=80):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        words = [rng.choice("ab") for _ in range(rng.choice([1, 2, 3, 5, 6, 9]))] if c % 3 else list("abababab")
        rows += [(c, k, "user" if k % 2 else None, "é" * (w == "a") + w, 1, "x") for k, w in enumerate(words)]
    rows += [(None, 0, "user", "lost", 1, "x"), (200, None, "user", "first", 1, "x"), (200, 1, None, None, 1, "x"), (200, 1, "user", "tie", 1, "x"), (200, 1, "user", "tie", 1, "x")]
    rows += [(10**12 + k, 0, "user", "far", 1, "x") for k in (0, 1)] + [(300, k, "r", str(k), 1, "x") for k in range(700)] + [(301, k, "r", str(k), 1, "x") for k in range(700)]
    return rows


@pytest.mark.parametrize("bound", [1, 7, 100, prefix_trie.SHARD_TURNS])
def test_shards_of_any_size(spark, bound):
    rows = made(bound, 40)
    turns = spark.createDataFrame(rows, KIND).repartition(5)
    found = prefix_trie.sequences(turns)
    short = [r for r in rows if r[0] not in (300, 301)]
    got = prefix_trie.trie(found.filter("conv_id NOT IN (300, 301)"), bound)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(plain_sequences(short))


def test_long_equal_sequences(spark):
    rows = [r for r in made(0) if r[0] in (300, 301)]
    rows[-1] = (301, 699, "r", "other", 1, "x")
    got = prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame(rows, KIND)), 100).collect()
    assert len(got) == 702
    root = next(r for r in got if r.depth == 0)
    assert (root.conv_id, root.n_convs, root.n_leaves, root.saved_tokens) == (300, 2, 2, sum(len(str(k)) for k in range(699)))


def test_rebuilt_heads(spark):
    rows = made(5)
    turns = spark.createDataFrame([r for r in rows if r[0] not in (300, 301)], KIND)
    got = prefix_trie.trie(prefix_trie.shared_heads(prefix_trie.sequences(turns)))
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(plain_rebuilt(plain_sequences([r for r in rows if r[0] not in (300, 301)])))


def test_many_copies_are_hashed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 8)
    ids = random.Random(1).sample(range(-300, 5000), 400)
    turns = spark.createDataFrame([(c, 0, "user", "same", 1, "x") for c in ids], KIND).repartition(4)
    got = {r.depth: r for r in prefix_trie.trie(prefix_trie.sequences(turns)).collect()}
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert (got[1].conv_id, got[1].n_convs, got[0].saved_tokens, got[0].n_leaves) == (min(ids), 400, 4 * 399, 1)


def test_empty_and_turnless(spark):
    turns = spark.createDataFrame([], KIND)
    assert prefix_trie.trie(prefix_trie.sequences(turns)).count() == 0
    one = prefix_trie.sequences(spark.createDataFrame([(1, 0, "a", "b", 1, "x")], KIND)).selectExpr("conv_id", "slice(turns, 1, 0) AS turns")
    empty = hashlib.sha256(b"1").hexdigest()
    assert [tuple(r) for r in prefix_trie.trie(one).collect()] == [(1, 0, None, 1, 0, 1, 0, empty)]
