"""Prefix trie of conversations by vertical bitmaps.

Input rows are turns (conv_id, turn, role, text). A conversation is the sequence of its (role, text) by
turn, a null turn first; equal turn numbers are ordered by the digest of role and text. Null role
or text is empty. Rows without conv_id belong to no conversation and are left out.

1. `sequences`: a turn becomes a 16-byte digest (SHA-256 of role and text, the role's length before them)
   and the bytes of its text; texts go no further. `rebuilt` replaces the first turns of a
   conversation by those of another. Equal sequences are one row with a count (`distinct_sequences`).
2. `shards`: sequences are dealt by their first turn; where a group holds more than `SHARD_TURNS`
   turns it is dealt by its first 2, 4, 8 ... turns, until no group is larger. Different sequences end up
   apart at the latest when a prefix is longer than both, so the bound holds for any table whose single sequences keep it.
3. `trie_of`, inside a task, for some whole shards: an index of (position, turn) -> bitset of sequences,
   numbered by smallest member. Depth first, a node's bitset is intersected with the posting of
   the turn that its lowest remaining sequence has next; that is a child, its members leave the
   rest, until the rest is empty. Popcounts (of bit planes of the copy counts) give members,
   the lowest bit the smallest member, the bitset of that length the sequence that ends here.
4. Nodes above the shards occur in several tasks. They come as parts under the digest of their
   prefix and are added up by Spark: members, leaves and saved bytes of what hangs below; then each such node's own
   saving is added to itself and every node above it, from the path it carries.
5. End lists are SHA-256 over ascending decimal ids. Ids travel as sorted lists of at most `BLOCK_IDS` ids
   (one row for each sequence and range of ids) and are hashed as a stream, a block at a time,
   so a sequence that a third of all conversations share takes no memory, only the time of one hash.

Memory: a task holds about `SHARD_TURNS` turns and their bitsets, and one row: a single sequence's turns
(24 bytes each) have to fit. Nothing is collected but counts.

An empty table has no members, hence no root and no rows. Turnless conversations (possible after
rebuilding) are members of the root alone. Repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import importable, small_enough, stored

SHARD_TURNS = 50_000
BLOCK_IDS = 1 << 15
NOTHING = hashlib.sha256(b"").hexdigest()
PART = "upper boolean, key binary, depth long, path array<binary>, above binary, conv_id long, parent_conv_id long, own long, n_convs long, n_children long, n_leaves long, saved long, ends binary"


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id and turns: array of (digest, bytes) in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", F.struct("turn", F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("d"), F.octet_length(text).cast("long").alias("b")).alias("x")
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return ordered.select("conv_id", F.transform("x", lambda t: F.struct(t.d.alias("d"), t.b.alias("b"))).alias("turns"))


def rebuilt(found: DataFrame, base: Column, head: Column) -> DataFrame:
    """The first `head` turns of conversation `base` (both from conv_id), then the own turns after the first `head`."""
    rows = found.select("conv_id", "turns", base.alias("base"), head.cast("int").alias("head"))
    first = found.select(F.col("conv_id").alias("base"), F.col("turns").alias("theirs"))
    none = F.slice("turns", 1, 0)
    own = F.when(F.size("turns") > F.col("head"), F.slice("turns", F.col("head") + 1, F.size("turns"))).otherwise(none)
    return rows.join(first, "base", "left").select("conv_id", F.concat(F.coalesce(F.slice("theirs", 1, F.col("head")), none), own).alias("turns"))


def prefix_key(length: int | None = None) -> Column:
    """Digest of the first turns (of all if no length is given)."""
    part = F.col("turns") if length is None else F.slice("turns", 1, length)
    spelled = F.concat_ws("", F.transform(part, lambda t: F.hex(t.d)))
    return F.unhex(F.sha2(F.concat(F.size(part).cast("string"), F.lit(":"), spelled), 256))


def distinct_sequences(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each different sequence once: seq, turns, copies, conv_id (smallest); and the ids of each one in blocks: seq, block, ids."""
    keyed = found.select(prefix_key().alias("seq"), "conv_id", "turns")
    # Copies are counted before the turns move: one row of a sequence for each task.
    once = keyed.groupBy("seq").agg(F.first("turns").alias("turns"), F.count("*").alias("copies"), F.min("conv_id").alias("conv_id"))
    bits = BLOCK_IDS.bit_length() - 1
    block = F.shiftright("conv_id", bits)
    blocks = keyed.select("seq", block.alias("block"), "conv_id").groupBy("seq", "block").agg(F.sort_array(F.collect_set("conv_id")).alias("ids"))
    return once, blocks


def ends_hashes(blocks: DataFrame) -> DataFrame:
    """seq and the SHA-256 of its ids, block after block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            out = []
            for seq, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist()):
                if seq != current:
                    if state:
                        out.append((current, state.hexdigest()))
                    current, state, lead = seq, hashlib.sha256(), ""
                state.update((lead + ",".join(map(str, ids))).encode())
                lead = ","
            yield pa.RecordBatch.from_pylist([{"seq": s, "ends_sha256": h} for s, h in out], ENDS)
        if state:
            yield pa.RecordBatch.from_pylist([{"seq": current, "ends_sha256": state.hexdigest()}], ENDS)

    ordered = blocks.repartition("seq").sortWithinPartitions("seq", "block").select("seq", "ids")
    return ordered.mapInArrow(run, "seq binary, ends_sha256 string")


ENDS = pa.schema([("seq", pa.binary()), ("ends_sha256", pa.string())])


def shards(once: DataFrame, bound: int = SHARD_TURNS) -> DataFrame:
    """`once` with `shard` (digest of a prefix) and `level` (its length): groups of at most `bound` turns, or one sequence."""
    done, rest, level = [], once, 1
    while True:
        keyed = rest.withColumn("shard", prefix_key(level)).withColumn("level", F.lit(level))
        sums = keyed.groupBy("shard").agg(F.sum(F.size("turns") + 1).alias("turns"), F.count("*").alias("n"))
        large = stored(sums.filter((F.col("turns") > bound) & (F.col("n") > 1)).select("shard"), "trie-large")
        if large.isEmpty():
            done.append(keyed)
            break
        if small_enough(large, 32):
            large = F.broadcast(large)
        done.append(keyed.join(large, "shard", "left_anti"))
        rest, level = stored(keyed.join(large, "shard", "left_semi").select(*once.columns), "trie-rest"), 2 * level
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def bits(word: int) -> Iterator[int]:
    while word:
        low = word & -word
        yield low.bit_length() - 1
        word ^= low


class Bitmaps:
    """The vertical index of some sequences, given by ascending smallest member."""

    def __init__(self, rows: list[tuple[bytes, list[tuple[bytes, int]], int, int, int]]):
        self.rows = rows
        self.postings: list[dict[bytes, int]] = []
        self.length: dict[int, int] = {}
        self.planes: list[int] = []
        for k, (_, turns, copies, _, _) in enumerate(rows):
            one = 1 << k
            while len(self.postings) < len(turns):
                self.postings.append({})
            for p, (d, _) in enumerate(turns):
                self.postings[p][d] = self.postings[p].get(d, 0) | one
            self.length[len(turns)] = self.length.get(len(turns), 0) | one
            for plane in bits(copies):
                while len(self.planes) <= plane:
                    self.planes.append(0)
                self.planes[plane] |= one

    def members(self, node: int) -> int:
        return sum((node & plane).bit_count() << k for k, plane in enumerate(self.planes))


def trie_of(rows: list[tuple[bytes, list[tuple[bytes, int]], int, int, int]]) -> list[dict]:
    """Nodes of (seq, turns, copies, smallest member, level) rows of whole shards, those above the shards as parts."""
    rows = sorted(rows, key=lambda r: r[3])
    index = Bitmaps(rows)
    nodes: list[dict] = []
    root = (1 << len(rows)) - 1
    stack = [(root, 0, -1, (prefix_digest([]),), 0)]
    while stack:
        node, depth, above, path, own = stack.pop()
        first = (node & -node).bit_length() - 1
        _, turns, _, smallest, level = rows[first]
        upper = depth < level
        n = index.members(node)
        ends = node & index.length.get(depth, 0)
        at = len(nodes)
        nodes.append({
            "upper": upper, "key": path[-1] if upper else None, "depth": depth, "path": list(path) if upper else None, "above": nodes[above]["key"] if depth else None,
            "conv_id": smallest, "parent_conv_id": nodes[above]["conv_id"] if depth else None, "own": own, "n_convs": n, "n_children": 0, "n_leaves": 0,
            "saved": 0 if upper else (n - 1) * own, "ends": rows[(ends & -ends).bit_length() - 1][0] if ends else None, "_above": above,
        })
        if depth:
            nodes[above]["n_children"] += 1
        rest = node & ~ends
        while rest:
            low = (rest & -rest).bit_length() - 1
            theirs, level = rows[low][1], rows[low][4]
            d, size = theirs[depth]
            child = node & index.postings[depth][d]
            rest &= ~child
            below = path + (prefix_digest(theirs[: depth + 1]),) if depth + 1 < level else path
            stack.append((child, depth + 1, at, below, size))
    for x in reversed(nodes):
        if not x["upper"]:
            x["n_leaves"] += not x["n_children"]
        if x["depth"]:
            up = nodes[x["_above"]]
            up["n_leaves"] += x["n_leaves"]
            up["saved"] += x["saved"]
    return nodes


def prefix_digest(turns: list[tuple[bytes, int]]) -> bytes:
    """The same digest as `prefix_key`."""
    return hashlib.sha256(f"{len(turns)}:{''.join(d.hex().upper() for d, _ in turns)}".encode()).digest()


def _parts(dealt: DataFrame, bound: int) -> DataFrame:
    """Nodes and parts of nodes of all shards; each task goes through its shards in groups."""
    importable(dealt.sparkSession)
    kinds = pa.schema([("upper", pa.bool_()), ("key", pa.binary()), ("depth", pa.int64()), ("path", pa.list_(pa.binary())), ("above", pa.binary()), *[(c, pa.int64()) for c in ("conv_id", "parent_conv_id", "own", "n_convs", "n_children", "n_leaves", "saved")], ("ends", pa.binary())])

    def written(rows: list) -> Iterator[pa.RecordBatch]:
        nodes = trie_of(rows)
        for lo in range(0, len(nodes), 10_000):
            part = nodes[lo : lo + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([x[f.name] for x in part], f.type) for f in kinds], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns, last = [], 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "seq", "d", "b", "copies", "conv_id", "level")]
            for shard, seq, d, b, copies, smallest, level in zip(*columns):
                if shard != last and turns >= bound:
                    yield from written(held)
                    held, turns = [], 0
                held.append((seq, list(zip(d, b)), copies, smallest, level))
                turns, last = turns + len(d) + 1, shard
        if held:
            yield from written(held)

    rows = dealt.repartition("shard").sortWithinPartitions("shard").select("shard", "seq", F.col("turns.d").alias("d"), F.col("turns.b").alias("b"), "copies", "conv_id", "level")
    return rows.mapInArrow(run, PART)


def _looked_up(df: DataFrame, side: DataFrame, key: str, width: int) -> DataFrame:
    """Left join; `side` has one row for each key and is broadcast if its counted size allows."""
    return df.join(F.broadcast(side) if small_enough(side, width) else side, key, "left")


def trie(found: DataFrame, bound: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of `found` (conv_id, turns), one row each.

    conv_id is the smallest member; n_leaves and saved_tokens are summed over the node and all below
    it, a node saving the bytes of its last text for each member but one; ends_sha256 is the hash of the ids
    of those whose last turn is here.
    """
    found = stored(found, "trie-sequences")
    once, blocks = distinct_sequences(found)
    parts = stored(_parts(shards(stored(once, "trie-distinct"), bound), bound), "trie-parts")
    lower, upper = parts.filter("NOT upper"), parts.filter("upper")
    # Nodes above the shards, added up over the tasks.
    merged = stored(upper.groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("path").alias("path"), F.first("above").alias("above"), F.min("conv_id").alias("conv_id"), F.first("own").alias("own"),
        F.sum("n_convs").alias("n_convs"), F.max("ends").alias("ends"),
    ), "trie-upper")
    names = stored(merged.select(F.col("key").alias("above"), F.col("conv_id").alias("named")), "trie-names")
    # Sums over what hangs below: complete nodes are in the parts already, nodes above the shards add themselves to their path.
    children = merged.select(F.col("above").alias("key")).unionByName(lower.select(F.col("above").alias("key"))).filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("children"))
    merged = merged.join(children, "key", "left").withColumn("children", F.coalesce("children", F.lit(0)))
    added = merged.select(F.explode("path").alias("key"), ((F.col("n_convs") - 1) * F.col("own")).alias("saved"), (F.col("children") == 0).cast("long").alias("n_leaves"))
    below = upper.select("key", "saved", "n_leaves").unionByName(added).groupBy("key").agg(F.sum("saved").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    top = merged.join(below, "key").select(
        "conv_id", "depth", "above", "n_convs", F.col("children").alias("n_children"), "n_leaves", "saved_tokens", "ends", F.lit(None).cast("long").alias("parent"),
    )
    rest = lower.select("conv_id", "depth", "above", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends", F.col("parent_conv_id").alias("parent"))
    inside, edge = rest.filter("above IS NULL"), rest.filter("above IS NOT NULL").unionByName(top)
    edge = _looked_up(edge, names, "above", 48).withColumn("parent", F.col("named")).select(*inside.columns)
    nodes = inside.unionByName(edge)
    # Most nodes end nothing: they get a key of their own that no sequence has, so that they stay spread.
    nodes = nodes.withColumn("seq", F.coalesce("ends", F.encode(F.concat_ws(" ", "conv_id", "depth"), "utf-8")))
    return nodes.join(ends_hashes(blocks), "seq", "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def shared_heads(found: DataFrame) -> DataFrame:
    """Conversations that begin with turns of the first of their five: crc32 of the id decides how many."""
    c = F.col("conv_id")
    return rebuilt(found, c - c % 5, F.crc32(c.cast("string").cast("binary")) % 9)
