"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window is `WINDOW` consecutive words of an item; an item of fewer words is one window. A
document word is hit when any window of any item occurs over it.

1. Fingerprints: of every `w` consecutive hashes of k words, the smallest is kept (all positions
   that hold it). Two texts that share `w + k - 1` words share a whole such run, hence a fingerprint.
   With k = 5 and `w` from the shortest item of five or more words (10 at most), every shared
   window is found. Items of one to four words have no k-gram; all their n-grams are looked up.
2. The documents' fingerprints meet the benchmark's. The benchmark side is distinct and is
   broadcast only when its stored size is under the bounds; otherwise it is a shuffle join.
3. Hits are extended: every window around a hit is spelled out and joined to the items' windows
   on its words, so the result is exact whatever the hashes do. Only documents with a hit are cut
   into words again; the number of words of every row comes out of the first pass with the hits.

Work and rows grow with the documents: one row for each fingerprint before the join, then only
those that hit. Nothing is gathered but the positions and items of one document.

Null text or text without words: nothing is hit. Items without words occur nowhere; repeated
item ids count once. Repeated document rows and null ids are judged by their text and all kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import ALNUM_WORD, KEY, ascii_lower, keyed, small_enough, stored, without

WINDOW = 10
GRAM = 5


@dataclass(frozen=True)
class Grams:
    """Fingerprints of `k` words, one of `w` in a row kept, for items whose windows have `lengths` words."""

    k: int
    w: int
    lengths: tuple[int, ...]


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(ALNUM_WORD), F.lit(0))


def gram_kinds(items: DataFrame) -> list[Grams]:
    """The kinds of fingerprints that the items' lengths call for; at most WINDOW different lengths exist."""
    found = sorted(r[0] for r in items.select(F.least(F.size("_words"), F.lit(WINDOW)).alias("n")).filter("n > 0").distinct().collect())
    long = tuple(n for n in found if n >= GRAM)
    kinds = [Grams(n, 1, (n,)) for n in found if n < GRAM]
    return kinds + ([Grams(GRAM, min(long) - GRAM + 1, long)] if long else [])


def fingerprints(df: DataFrame, kind: Grams, keep: list[str], whole: bool = False) -> DataFrame:
    """A row (*keep, n_words, _at, _print) for each kept k-gram of `_words`; with `whole` one more for each row of `df`, at -1.

    The explodes are outer ones: an inner explode lets the optimiser push `size(array) > 0` below the
    projections, where each array would be computed again inside the next one's lambda.
    """
    hashed = df.select(*keep, F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    grams = F.transform(
        F.sequence(F.lit(0), F.size("_h") - kind.k), lambda i: F.xxhash64(*[F.get("_h", i + j) for j in range(kind.k)])
    )
    rows = hashed.select(*keep, F.size("_h").alias("n_words"), F.when(F.size("_h") >= kind.k, grams).alias("_g"))
    found = lambda g, p: F.struct(p.alias("_at"), g.alias("_print"))
    if kind.w == 1:
        chosen = F.transform("_g", found)
    else:
        least = F.transform(
            F.sequence(F.lit(0), F.size("_g") - kind.w), lambda i: F.least(*[F.get("_g", i + j) for j in range(kind.w)])
        )
        rows = rows.select(*keep, "n_words", "_g", F.when(F.size("_g") >= kind.w, least).alias("_m"))
        # A gram is the smallest of some run that holds it exactly when the largest of those runs' minima is the gram.
        chosen = F.transform("_g", lambda g, p: F.when(g == F.greatest(*[F.get("_m", p - j) for j in range(kind.w)]), found(g, p)))
        chosen = F.filter(chosen, lambda x: x.isNotNull())
    if whole:
        # The row's own hash in place of a print deals these rows evenly if the prints are joined by a shuffle.
        own = F.array(F.struct(F.lit(-1).alias("_at"), F.xxhash64(*keep).alias("_print")))
        chosen = F.concat(own, F.coalesce(chosen, F.array().cast("array<struct<_at: int, _print: bigint>>")))
    rows = rows.select(*keep, "n_words", F.explode_outer(chosen).alias("_x"))
    return rows.filter(F.col("_x").isNotNull()).select(*keep, "n_words", "_x._at", "_x._print")


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, _window): the words of each window with blanks between them, once for each item."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - WINDOW, F.lit(0)))
    spelled = F.transform(starts, lambda i: F.array_join(F.slice("_words", i + 1, WINDOW), " "))
    return items.filter(F.size("_words") > 0).select("item_id", F.explode_outer(F.array_distinct(spelled)).alias("_window")).distinct()


def met(rows: DataFrame, prints: DataFrame, small: bool) -> DataFrame:
    """The rows whose print is in `prints` (distinct), and those at -1."""
    known = prints.withColumn("_known", F.lit(True))
    return rows.join(F.broadcast(known) if small else known, "_print", "left").filter("_at < 0 OR _known").drop("_known")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, _id, _hash, n_words, n_hit, item_ids): one row for each row of `docs`; item_ids are sorted as strings."""
    items = stored(benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.coalesce("text", F.lit(""))).alias("_words")), "items")
    texts = keyed(docs).select("doc_id", *KEY, words(F.col("text")).alias("_words"))
    kinds = gram_kinds(items)
    if not kinds:
        return texts.select("doc_id", *KEY, F.size("_words").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"))

    hits = None
    for kind in kinds:
        wanted = items.filter(F.least(F.size("_words"), F.lit(WINDOW)).isin(list(kind.lengths)))
        prints = stored(fingerprints(wanted, kind, []).select("_print").distinct(), "prints")
        found = met(fingerprints(texts, kind, ["doc_id", *KEY], hits is None), prints, small_enough(prints, 8))
        # Every window that holds the k-gram found at `_at`, as (start, length).
        spans = [F.struct((F.col("_at") - back).alias("s"), F.lit(n).alias("n")) for n in kind.lengths for back in range(n - kind.k + 1)]
        found = found.select("doc_id", *KEY, F.col("n_words").cast("long").alias("n_words"), F.when(F.col("_at") >= 0, F.array(*spans)).alias("_spans"))
        hits = found if hits is None else hits.unionByName(found)
    hits = stored(hits, "hits")
    rows = hits.filter("_spans IS NULL").drop("_spans")
    near = hits.filter("_spans IS NOT NULL").select(*KEY, F.explode("_spans").alias("_span")).filter("_span.s >= 0")
    near = stored(near.groupBy(*KEY).agg(F.collect_set("_span").alias("_spans")), "near")

    near_small = small_enough(near, F.size("_spans") * 16 + 32)
    again = keyed(docs).join(F.broadcast(near) if near_small else near, KEY).select(*KEY, "_spans", words(F.col("text")).alias("_words"))
    spans = F.filter("_spans", lambda x: x["s"] + x["n"] <= F.size("_words"))
    spelled = F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["n"].alias("n"), F.array_join(F.slice("_words", x["s"] + 1, x["n"]), " ").alias("w")))
    judged = stored(again.select(*KEY, spelled.alias("_spelled")), "spelled")

    windows = stored(item_windows(items), "windows")
    places = judged.select(*KEY, F.explode("_spelled").alias("_x")).select(*KEY, "_x.s", "_x.n", F.col("_x.w").alias("_window"))
    proven = places.join(F.broadcast(windows) if small_enough(windows, F.octet_length("_window") + F.octet_length("item_id")) else windows, "_window")
    by_doc = proven.groupBy(*KEY).agg(F.collect_set(F.struct("s", "n")).alias("_hit"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    # Words covered: each hit window adds what lies beyond the furthest end so far.
    reach = F.aggregate(
        F.array_sort("_hit"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["s"] + x["n"]).alias("end"),
            (acc["total"] + F.greatest(F.lit(0), x["s"] + x["n"] - F.greatest(acc["end"], x["s"]))).alias("total"),
        ),
    )["total"]
    by_doc = by_doc.select(*KEY, reach.cast("long").alias("n_hit"), "item_ids")
    whole = rows.join(by_doc, KEY, "left")
    return whole.select(
        "doc_id", *KEY, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of `contamination`."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of `docs`, all columns, in which no window of the benchmark occurs."""
    return without(docs, contamination(docs, benchmark).filter("n_hit > 0"))
