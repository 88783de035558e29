"""One query for each operator over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.functions.storage import fresh_folder
from tidewatch.llm import bpe_automaton, decontaminate, lexical_search, licenses, near_duplicates, packing, passages, prefix_trie, quality_classifier as quality, quality_rules as rules, secrets, sql, suffix_dedup, token_files, toxicity
from tidewatch.llm.common import documents
from tidewatch.llm.registry import ORACLES, QUERIES, query  # noqa: F401

#: Folder of the public vocabulary files; the module that comes with them knows it.
TOKENIZERS = None


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_quality_rules", sql.QUALITY_RULES)
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.apply_rules(documents(spark, folder).select("doc_id", "text")).select(*columns)


@query("op10_decontaminate", sql.CONTAMINATION)
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")
    return decontaminate.digest(decontaminate.contamination(documents(spark, folder).select("doc_id", "text"), benchmark))


@query("op7_near_duplicates")
def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates.near_duplicates(documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op3_token_files")
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_folder(spark, "tokens")
    token_files.write_tokens(documents(spark, folder).select("doc_id", "text"), target, tokenizer("word_bpe_49k.json"), 2)
    return token_files.digest(token_files.read_tokens(spark, target))


@query("op6_packing")
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(packing.pack(documents(spark, folder).select("doc_id", "text"), tokenizer("byte_bpe_50k.json"), 1))


@query("op4_secrets")
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return secrets.digest(secrets.scan(docs, secrets.train(docs)))


@query("op9_licenses")
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digest(licenses.scan(documents(spark, folder).select("doc_id", "text")))


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held_out = quality.remainder(4) == 2
    return quality.predicted(quality.score(docs, quality.train(docs, labels, "quality", ~held_out)), held_out)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    held_out = quality.remainder(3) == 1
    return quality.predicted(toxicity.score(docs, toxicity.train(docs, labels, "toxic", ~held_out)), held_out)


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return suffix_dedup.digest(suffix_dedup.removed(docs), passages.shared(docs))


@query("op12_bpe_automaton")
def op12_bpe_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_automaton.round_trip(documents(spark, folder).select("doc_id", "text"), tokenizer("byte_bpe_50k.json"))


@query("op13_lexical_search", sql.LEXICAL_SEARCH)
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")
    return lexical_search.search(documents(spark, folder).select("doc_id", "text"), items)


@query("op11_prefix_trie", sql.PREFIX_TRIE)
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie(prefix_trie.shared_heads(prefix_trie.sequences(turns)))
