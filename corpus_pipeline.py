"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes what a stage returns as
Parquet to the shared folder and hands the reread table to the next one. All but the last return
the columns of `documents`:

    quality_rules    documents that the threshold table rejects go
    near_duplicates  of each group of near copies the document with the smallest id stays
    decontaminate    documents in which a benchmark window occurs go
    secrets          findings are masked in the text, n_chars follows; every document stays
    packing          the pieces of the packed sequences (the contract's columns of op6)

Empty tables pass through every stage. What a stage does with nulls, repeated rows and other odd
cases is told in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontaminate, near_duplicates, packing, quality_rules, secrets
from tidewatch.llm.common import documents, stored
from tidewatch.llm.queries import tokenizer


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return quality_rules.good_documents(docs)


def keep_first(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return near_duplicates.first_of_each(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")
    return decontaminate.clean_documents(docs, benchmark)


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return secrets.redact(docs, secrets.train(docs))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.digest(packing.pack(docs, tokenizer("byte_bpe_50k.json"), 1))


STAGES = [
    ("quality_rules", keep_good),
    ("near_duplicates", keep_first),
    ("decontaminate", keep_clean),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: SQL can express neither the network's spans nor the tokenizer; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
