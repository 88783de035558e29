"""Ranked lexical search of many items at once, sharing what their terms have in common.

Terms are runs of letters and digits (A-Z lowered). A document scores for an item the sum of
`w * (10^9 tf div (1000 tf + 12 m))` over the item's terms with repeats; see `weight` and `length_part`.

1. Items are taken in blocks of about `BLOCK` different terms (one block for most benchmarks). One pass over
   the documents keeps, for each, its length and the counts of the block's terms; totals and document
   frequencies are added up from there, over all documents.
2. `share` mines term sets that items have in common: an item is its set of (term, repeats), most
   used first; the most frequent neighbours become one new node, in rounds, until no two nodes stand
   side by side in two items. That is a graph in which an item, or a set that several items share,
   is the sum of two or more earlier nodes.
3. `Accumulators` holds partial scores of some documents: a row for each node, a column for each
   document. Rows are filled once from the leaves up, however many items use them; items add up
   what is left of them.
4. A task keeps each item's best `top` rows (ties at the limit by document id), and a window over
   what the tasks kept ranks them. A document that the ranking needs is among its task's best, so nothing is lost.

Memory: a chunk of documents times the nodes of a block, about `CELLS` numbers. The driver holds
one block: its terms and its items. An item's different terms are never split. Shuffled are `top` rows
for each item and task.

Documents: null or empty text has no terms and scores nothing; repeated rows and null ids count and rank
like any other (null ids last among equals). Items: equal rows count once, several texts of one
id (null is an id too) are one item with the terms of all; items without terms have no rows.
All arithmetic is in 64-bit integers as long as 25 * n * N stays below 2^63.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import ALNUM_WORD, ascii_lower, keyed, stored, text_chunks
from tidewatch.llm.shingles import ALNUM, word_marks

TOP = 20
BLOCK = 50_000
CELLS = 4 << 20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def weight(documents: int, having: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def length_part(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    return 100 - 25 + (25 * n * documents) // max(terms, 1)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, repeats."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(ALNUM_WORD), F.lit(0))
    return items.select("item_id", "text").distinct().select("item_id", F.explode(words).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("repeats"))


def term_counts(data: np.ndarray, at: np.ndarray, vocabulary: pa.Array) -> tuple[np.ndarray, ...]:
    """Terms of each text; then text, term and count of all vocabulary terms, by text."""
    solid, first = word_marks(data, at, ALNUM)
    edge = first.copy()
    edge[1:] |= solid[1:] != solid[:-1]
    edge[:1] = True
    begin = np.flatnonzero(edge)
    if not len(begin):
        return np.zeros(len(at) - 1, np.int64), *([np.zeros(0, np.int64)] * 3)
    offsets = np.append(begin, len(data)).astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(_FOLD[data].tobytes())]).dictionary_encode()
    known = pc.fill_null(pc.index_in(coded.dictionary, value_set=vocabulary), -1).to_numpy().astype(np.int64)
    term, text = known[coded.indices.to_numpy()], np.searchsorted(at, begin, side="right") - 1
    n = np.bincount(text[solid[begin]], minlength=len(at) - 1)
    key, count = np.unique(text[term >= 0] * len(vocabulary) + term[term >= 0], return_counts=True)
    return n, key // max(len(vocabulary), 1), key % max(len(vocabulary), 1), count


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n (terms), terms and counts (of the vocabulary, by place in it) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array([t.encode() for t in vocabulary], pa.large_binary())
        for rows, data, at in text_chunks(batches):
            n, text, term, count = term_counts(data, at, known)
            cuts = pa.array(np.searchsorted(text, np.arange(len(at))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (term, count)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n.astype(np.int64)), *lists], ["doc_id", "n", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, counts array<int>")


def frequencies(posted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; a task sends each term once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(total[term])], ["term", "n"])

    out = np.zeros(size, np.int64)
    for r in posted.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


@dataclass(frozen=True)
class Shared:
    """Nodes: the terms; `repeated` (term, repeats); then `rounds` of sums of two nodes. Items add up `nodes`."""

    terms: int
    repeated: np.ndarray
    rounds: list[np.ndarray]
    nodes: list[np.ndarray]

    @property
    def size(self) -> int:
        return self.terms + len(self.repeated) + sum(map(len, self.rounds))

    @property
    def additions(self) -> int:
        """Sums of two rows that one document costs."""
        return sum(map(len, self.rounds)) + sum(max(len(n) - 1, 0) for n in self.nodes)


def share(items: list[dict[int, int]], terms: int) -> Shared:
    """The sharing graph of items given as {term: repeats}."""
    repeated = sorted({(t, c) for item in items for t, c in item.items() if c > 1})
    leaf = {tc: terms + k for k, tc in enumerate(repeated)}
    sets = [[leaf.get((t, c), t) for t, c in item.items()] for item in items]
    used = Counter(x for s in sets for x in s)
    rows = [sorted(s, key=lambda x: (-used[x], x)) for s in sets]
    size, rounds = terms + len(repeated), []
    while True:
        pairs = Counter(p for row in rows for p in zip(row, row[1:]))
        chosen: dict[int, tuple[int, int]] = {}
        taken: set[int] = set()
        for (a, b), n in sorted(pairs.items(), key=lambda x: (-x[1], x[0])):
            if n < 2:
                break
            if not {a, b} & taken:  # the nodes of a round are apart, so that all its sums are independent
                taken |= {a, b}
                chosen[a] = (b, size)
                size += 1
        if not chosen:
            break
        rounds.append(np.array([(a, b) for a, (b, _) in chosen.items()], np.int64))
        for k, row in enumerate(rows):
            new, i = [], 0
            while i < len(row):
                b, node = chosen.get(row[i], (None, 0))
                if i + 1 < len(row) and row[i + 1] == b:
                    new.append(node)
                    i += 2
                else:
                    new.append(row[i])
                    i += 1
            rows[k] = new
    return Shared(terms, np.array(repeated, np.int64).reshape(-1, 2), rounds, [np.array(r, np.int64) for r in rows])


class Accumulators:
    """Scores of documents for all items of a block, each node's row filled once."""

    def __init__(self, graph: Shared, weights: np.ndarray, documents: int, terms: int):
        self.graph, self.weights, self.documents, self.terms = graph, weights, documents, terms
        self.width = max(1, CELLS // max(graph.size, 1))

    def scores(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        """A row for each item, a column for each of the documents 0..len(n)."""
        g = self.graph
        rows = np.zeros((g.size, len(n)), np.int64)
        m = length_part(n, self.documents, self.terms)
        rows[term, doc] = self.weights[term] * ((1_000_000_000 * count) // (1000 * count + 12 * m[doc]))
        done = g.terms + len(g.repeated)
        rows[g.terms : done] = rows[g.repeated[:, 0]] * g.repeated[:, 1:]
        for pairs in g.rounds:
            rows[done : done + len(pairs)] = rows[pairs[:, 0]] + rows[pairs[:, 1]]
            done += len(pairs)
        return np.stack([rows[nodes].sum(axis=0) for nodes in g.nodes]) if g.nodes else rows[:0]


class Best:
    """The best rows of each item so far: score, whether the id is null, id."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)
        self.rows = [np.zeros((3, 0), np.int64) for _ in range(items)]

    def add(self, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least[:, None]
        for item in np.flatnonzero(good.any(axis=1)).tolist():
            at = np.flatnonzero(good[item])
            rows = np.concatenate([self.rows[item], np.stack([scores[item, at], null[at], ids[at]])], axis=1)
            rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[: self.top]]
            self.rows[item] = rows
            if rows.shape[1] == self.top:
                self.least[item] = rows[0, -1]


def ranked_block(posted: DataFrame, ids: DataFrame, graph: Shared, weights: np.ndarray, documents: int, terms: int, top: int) -> DataFrame:
    """The ranking of a block's items; `ids` gives each item's place and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, best = Accumulators(graph, weights, documents, terms), Best(len(graph.nodes), top)
        for batch in batches:
            for lo in range(0, batch.num_rows, sums.width):
                rows = batch.slice(lo, sums.width)
                size = pc.list_value_length(rows.column("terms")).to_numpy().astype(np.int64)
                lists = [rows.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "counts")]
                found = sums.scores(rows.column("n").to_numpy(), np.repeat(np.arange(rows.num_rows), size), *lists)
                doc = rows.column("doc_id").cast(pa.int64())
                best.add(found, doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64), doc.fill_null(0).to_numpy())
        for item, (score, null, doc) in enumerate(best.rows):
            columns = [pa.array(np.full(len(score), item)), pa.array(doc, mask=null.astype(bool)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    kept = posted.mapInArrow(run, "item long, doc_id long, score long")
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = kept.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's best `top` documents of all, those with score above 0."""
    spark = docs.sparkSession
    terms = stored(item_terms(items), "search-terms")
    kind = items.schema["item_id"].dataType.simpleString()
    blocks = -(-max(terms.count(), 1) // BLOCK)
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = []
    for b in range(blocks):
        rows = terms.filter(block == b).collect()
        if not rows:
            continue
        vocabulary = sorted({r["term"] for r in rows})
        place = {t: k for k, t in enumerate(vocabulary)}
        sets: dict = {}
        for r in rows:
            sets.setdefault(r["item_id"], {})[place[r["term"]]] = r["repeats"]
        names = sorted(sets, key=lambda x: (x is not None, x))
        posted = stored(postings(docs, vocabulary), "search-postings")
        total = posted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        weights = np.array([weight(total["documents"], int(n)) for n in frequencies(posted, len(vocabulary))], np.int64)
        ids = spark.createDataFrame(list(enumerate(names)), f"item long, item_id {kind}")
        graph = share([sets[i] for i in names], len(vocabulary))
        ranked = ranked_block(posted, ids, graph, weights, total["documents"], total["terms"], top)
        found.append(ranked if blocks == 1 else stored(ranked, "search-ranked"))
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out
