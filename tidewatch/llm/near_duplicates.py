"""MinHash near-duplicates through an inverted join of signature coordinates.

Contract of a link: 100 * |A and B| >= PERCENT * |A or B| over the sets of distinct five-word shingles.

1. One pass turns each text into its shingle set, the set's digest and `COORDINATES` minima of
   random permutations. Equal sets become one class, so copies cost nothing further.
2. Every class is posted under its (coordinate, value) pairs. Pairs that occur once are skipped.
   A class keeps its rarest `COORDINATES - MATCHES + 1` pairs as prefix: classes that agree in
   MATCHES coordinates share a pair of their prefixes, however common their other pairs are.
3. A first round links the members of each posting list to its most central class (the one whose pairs
   are the most common). What still lies in different components after it is compared pair by
   pair, under an exact bound: a shingle that no other remaining class holds is missing from every
   partner, so with u such shingles J(A, B) <= (|A| - u) / max(|A|, |B| + u). So a family of n near
   copies costs about n comparisons, and no link between components is lost.
4. A candidate pair must agree in MATCHES coordinates; then the full sets decide.

At similarity 0.85 a pair agrees in 109 of 128 coordinates on average; the chance of fewer than 90
is about 2 in 100,000, and falls with the similarity. That is the only approximation.

Texts without words have an empty set and stay alone. Null ids: a row without id never names a
component; it stays only if its whole group has no id. Repeated rows are copies with the same id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import KEY, keyed, small_enough, stored, text_chunks, without
from tidewatch.llm.components import components
from tidewatch.llm.shingles import SEED, shingle_sets

PERCENT = 85
COORDINATES = 128
MATCHES = 90
PREFIX = COORDINATES - MATCHES + 1
PIVOT_ROUNDS = 1

_FACTORS = np.random.default_rng(SEED + 1).integers(1, 2**63, (2, COORDINATES), dtype=np.uint64)
_FACTORS[0] = _FACTORS[0] * np.uint64(2) + np.uint64(1)
_PLACES = np.arange(COORDINATES, dtype=np.int64) << 32


def signature(shingles: np.ndarray) -> np.ndarray:
    """COORDINATES tokens: the coordinate in the high half, the top 32 bits of the minimum in the low half."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048, None] * _FACTORS[0]
        part += _FACTORS[1]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.int64) | _PLACES


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, at in text_chunks(batches):
        sets = shingle_sets(data, at)
        yield pa.RecordBatch.from_arrays([
            *(rows.column(c) for c in ("doc_id", *KEY)),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
            pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
        ], ["doc_id", *KEY, "n_shingles", "digest", "signature"])


def signatures(docs: DataFrame) -> DataFrame:
    schema = "doc_id long, _id long, _hash long, n_shingles long, digest binary, signature array<long>"
    return keyed(docs).mapInArrow(_signed, schema)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, at in text_chunks(batches):
        yield pa.RecordBatch.from_arrays(
            [rows.column("node"), pa.array([s.tobytes() for s in shingle_sets(data, at)], pa.binary())], ["node", "shingles"]
        )


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, at in text_chunks(batches):
        sets = [s.view(np.int64) for s in shingle_sets(data, at)]
        yield pa.RecordBatch.from_arrays([rows.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y")):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= PERCENT * (len(both) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


class Candidates:
    """Classes of equal sets and their posting lists; turns candidate pairs into proven links."""

    def __init__(self, docs: DataFrame):
        self.docs = keyed(docs)
        self.signed = stored(signatures(docs), "signatures")
        found = self.signed.filter("digest IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("first_id"), F.min(F.struct(*KEY)).alias("_at"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"),
        )
        found = found.select("digest", "first_id", "_at.*", "n", "signature", F.monotonically_increasing_id().alias("node"))
        self.classes = stored(found, "classes")
        self.postings = stored(self._posted(), "postings")

    def _posted(self) -> DataFrame:
        tokens = self.classes.select("node", F.explode("signature").alias("token"))
        shared = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
        own = tokens.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("_t"))
        own = own.filter(F.size("_t") >= MATCHES).select(
            "node", F.slice("_t", 1, F.size("_t") - (COORDINATES - PREFIX)).alias("_p"),
            F.aggregate("_t", F.lit(0.0), lambda s, x: s + F.log2(x["df"])).alias("weight"),
        )
        own = own.join(self.classes.select("node", "n"), "node")
        return own.select("node", "n", "weight", F.explode("_p").alias("_x")).select("node", "n", "weight", "_x.token")

    def texts(self, nodes: DataFrame) -> DataFrame:
        """(node, text) of one document of each class in `nodes` (a row for each repeated row of it)."""
        wanted = stored(self.classes.select("node", *KEY).join(nodes, "node", "left_semi"), "wanted")
        return self.docs.join(F.broadcast(wanted) if small_enough(wanted, 24) else wanted, KEY).select("node", "text")

    def sets(self, posts: DataFrame) -> DataFrame:
        """(node, shingles, u) of the classes of `posts`; u counts the shingles that no other of them holds."""
        found = self.texts(posts.select("node").distinct()).mapInArrow(_shingles, "node long, shingles array<long>")
        found = stored(found.groupBy("node").agg(F.first("shingles").alias("shingles")), "shingles")
        rows = found.select("node", F.explode("shingles").alias("shingle"))
        alone = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other")
        alone = alone.groupBy("node").agg(F.count("*").alias("u"))
        return found.join(alone, "node", "left").withColumn("u", F.coalesce("u", F.lit(0)))

    def links(self, pairs: DataFrame) -> DataFrame:
        """(a, b) of the distinct pairs (a, b) whose full sets are similar enough."""
        near = lambda side: self.classes.select(F.col("node").alias(side), F.col("signature").alias(f"_{side}"))
        pairs = pairs.join(near("a"), "a").join(near("b"), "b").filter(F.size(F.array_intersect("_a", "_b")) >= MATCHES)
        pairs = stored(pairs.select("a", "b"), "pairs")
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        sets = stored(self.texts(nodes).mapInArrow(_sets, "node long, shingles binary"), "sets")
        side = lambda k, v: sets.select(F.col("node").alias(k), F.col("shingles").alias(v))
        both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
        return stored(both.select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long").distinct(), "links")


def pairs_with(posts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Pairs of a posting list's members and the class chosen for the list, unless in one component or too different by size."""
    met = posts.join(chosen, "token").filter(f"root <> p.root AND 100 * least(n, p.n) >= {PERCENT} * greatest(n, p.n)")
    return met.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()


def links_within(posts: DataFrame, sets: DataFrame) -> DataFrame:
    """All links between members of a posting list that lie in different components.

    The join's condition holds, from cheap to dear: the bound by size and unshared shingles, the
    list being the first that both are posted in, and the comparison of the full sets.
    """
    own = posts.join(sets, "node").filter(f"100 * (n - u) >= {PERCENT} * n")
    lists = own.groupBy("node").agg(F.collect_list("token").alias("lists"))
    own = stored(own.join(lists, "node").select("token", "node", "n", "u", "root", "lists", "shingles"), "last")
    a, b = own.alias("a"), own.alias("b")
    bound = f"100 * (a.n - a.u) >= {PERCENT} * greatest(a.n, b.n + a.u) AND 100 * (b.n - b.u) >= {PERCENT} * greatest(b.n, a.n + b.u)"
    once = F.array_min(F.array_intersect("a.lists", "b.lists")) == F.col("a.token")
    common = F.size(F.array_intersect("a.shingles", "b.shingles"))
    near = 100 * common >= PERCENT * (F.col("a.n") + F.col("b.n") - common)
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & F.expr(f"a.node < b.node AND a.root <> b.root AND {bound}") & once & near)
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, _id, _hash, n_shingles, component_id, kept, group): one row for each row of `docs`.

    `group` tells the components apart, also those without any id; it is NULL for texts without words.
    """
    candidates = Candidates(docs)
    roots, links = None, None
    for turn in range(PIVOT_ROUNDS + 1):
        posts = candidates.postings
        if roots is None:
            posts = posts.withColumn("root", F.col("node"))
        else:
            posts = posts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        # Only lists that still hold two components are of interest.
        mixed = posts.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("token")
        posts = stored(posts.join(mixed, "token", "left_semi"), "mixed")
        if links is not None and posts.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            pick = F.struct((F.col("weight") if turn == 0 else F.xxhash64("node")).alias("w"), "node", "n", "root")
            found = candidates.links(pairs_with(posts, posts.groupBy("token").agg(F.max(pick).alias("p"))))
        else:
            found = stored(links_within(posts, candidates.sets(posts)), "links")
        links = found if links is None else links.unionByName(found)
        roots = stored(components(links), "roots")
    classes = candidates.classes.select("digest", "first_id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = classes.join(least, "root").select("digest", "component_id", F.col("root").alias("group"))
    whole = candidates.signed.select("doc_id", *KEY, "n_shingles", "digest").join(classes, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return whole.select("doc_id", *KEY, "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "group")


def first_of_each(docs: DataFrame) -> DataFrame:
    """One row of `docs`, all columns, of each group of near duplicates; texts without words stay.

    It is the row with the smallest id (null is the largest), then the smallest hash of its text. Of rows
    equal in both, the one whose columns have the smallest hash stays.
    """
    key, found = F.struct(F.col("doc_id").isNull().alias("none"), *KEY), near_duplicates(docs)
    found = stored(found.filter("`group` IS NOT NULL").select("group", *KEY, key.alias("key")), "grouped")
    first = found.groupBy("group").agg(F.min("key").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    several = stored(found.join(first, "group").groupBy(*KEY).agg(F.bool_and(F.col("key") == F.col("first")).alias("stays"), F.count("*").alias("n")), "several")
    rest, again = without(docs, several.filter("NOT stays")), several.filter("stays AND n > 1").select(*KEY)
    if again.isEmpty():
        return rest
    keyed_rows = rest.select(F.struct(*rest.columns).alias("_row"), F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    one = keyed_rows.join(again, KEY, "left_semi").groupBy(*KEY).agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return without(rest, again).unionByName(one.select("_row.*"))
