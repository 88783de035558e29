"""Quality rules: a threshold table compiled into Spark projections (no user functions).

`RULES` names a ratio and the range in which a text is kept; `verdict` turns the table into one
boolean column. The measures come from projections over the text and its word array only, so a
document never leaves its row: no shuffle, no join, work in proportion to the text.

Repeated windows are found inside the row: hashes of eight consecutive words (64 bits), which are
all distinct in most texts; only other texts sort them and mark the neighbours that are equal.

Null text counts as empty: zero everywhere, base_failed, not kept. Repeated rows are judged alike
and all returned; other columns of the input are carried along, and measures replace columns of
the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import BLANK_WORD

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Frequent short words of English, German, French and Spanish; fixed values.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "was", "with",
    "der", "die", "das", "und", "den", "von", "ist", "ein", "zu", "mit",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "est",
    "que", "el", "los", "se", "las", "por", "con", "una", "y", "es",
]
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """Keep texts whose `top / bottom` lies within [low, high]; a bottom under `least` (1 or more) passes."""

    name: str
    top: str
    bottom: str
    low: float
    high: float
    least: int = 1


RULES = [
    Rule("mean_word_chars", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", 0.0, 0.1),
    Rule("stop_word_share", "n_stop", "n_words", 0.01, 1.0, 50),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", 0.0, 0.5),
]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_stop", "n_lines", "n_dup_lines", "n_repeat_words"]


def stop_pattern() -> str:
    """Stop words as whole words of a text whose words stand between single blanks on either side."""
    forms = [form for word in STOP_WORDS for form in (word, word.capitalize())]
    return f" (?:{'|'.join(forms)}) "


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """`_row`, a struct of all columns of `docs`, and the columns of MEASURES (long)."""
    kept = ["_row"]
    body = F.coalesce(F.col(text), F.lit(""))
    words = docs.select(
        F.struct(*docs.columns).alias("_row"), body.alias("_body"), F.regexp_extract_all(body, F.lit(BLANK_WORD), F.lit(0)).alias("_words"),
        F.filter(F.split(body, "\n", -1), lambda line: line.rlike(BLANK_WORD)).alias("_lines"),
    )
    counted = words.select(
        *kept, "_lines", F.size("_words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        (F.length("_body") - F.length(F.regexp_replace("_body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.regexp_count(F.concat(F.lit(" "), F.concat_ws("  ", "_words"), F.lit(" ")), F.lit(stop_pattern())).cast("long").alias("n_stop"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
        lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]),
    )
    hashed = counted.withColumn("_windows", F.when(F.col("n_words") >= WINDOW, windows))
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = hashed.withColumn(
        "_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), pairs)
    )
    twin = lambda x, i: F.coalesce(F.get("_sorted", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("_sorted", i + 1)["h"] == x["h"], F.lit(False))
    marked = repeated.withColumn("_starts", F.sort_array(F.transform(F.filter("_sorted", twin), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_starts", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda total, x: total + x,
    )
    lines = F.size("_lines")
    return marked.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_stop", lines.cast("long").alias("n_lines"),
        (lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_starts").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def verdict(rules: list[Rule] = RULES) -> Column:
    """All rules of the table as one boolean expression."""
    passed = ~base_failed()
    for rule in rules:
        share = F.col(rule.top) / F.when(F.col(rule.bottom) >= rule.least, F.col(rule.bottom))
        passed &= F.coalesce(share.between(rule.low, rule.high), F.lit(True))
    return passed


def judged(docs: DataFrame, rules: list[Rule], text: str) -> DataFrame:
    return measure(docs, text).withColumns({"base_failed": base_failed(), "kept": verdict(rules)})


def apply_rules(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """`docs` with the measures, `base_failed` and `kept`."""
    added = [*MEASURES, "base_failed", "kept"]
    return judged(docs, rules, text).select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in added], *added)


def good_documents(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """Rows of `docs`, all columns as they are, that the rules keep.

    A plain filter on `kept` would be pushed below the projections, where every measure is spelled
    out again inside the next one's lambda; the outer explode of none or one row is not.
    """
    chosen = judged(docs, rules, text).select(F.explode_outer(F.when(F.col("kept"), F.array("_row"))).alias("_row"))
    return chosen.filter(F.col("_row").isNotNull()).select("_row.*")
