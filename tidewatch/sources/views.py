"""Role views over the sample tables: which table column plays which part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.sources.tables import read_table

# The sample taxonomy; '4-NOT SPECIFIED' is left out to reach the default.
PRIORITY_TAXONOMY = {"1-URGENT": "urgent", "2-HIGH": "urgent", "3-MEDIUM": "normal", "5-LOW": "normal"}


def connections(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem with its order and part: the widest record view."""
    items, orders, parts = (read_table(spark, folder, t) for t in ("lineitem", "orders", "part"))
    return (
        items.join(orders, items.l_orderkey == orders.o_orderkey)
        .join(parts, items.l_partkey == parts.p_partkey)
        .select(
            "l_orderkey", "l_linenumber",
            F.col("p_brand").alias("service"), F.col("l_linestatus").alias("protocol_type"),
            F.col("o_orderstatus").alias("flag"), F.col("o_orderpriority").alias("label"),
            F.col("l_extendedprice").alias("src_bytes"), F.col("l_quantity").alias("dst_bytes"),
            F.col("l_discount").alias("discount_rate"), F.col("l_tax").alias("tax_rate"),
            F.col("p_size").alias("size"), F.col("o_totalprice").alias("total"),
            (F.col("l_returnflag") == "R").cast("int").alias("is_anomaly"),
        )
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem alone with the return flag as target."""
    return read_table(spark, folder, "lineitem").withColumn("is_anomaly", (F.col("l_returnflag") == "R").cast("int"))


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    return documents.join(labels, "doc_id").select(
        "doc_id", F.col("source").alias("service"), F.col("lang").alias("protocol_type"),
        "n_chars", "quality", F.col("toxic").alias("is_anomaly"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def embedding_cells(spark: SparkSession, folder: str) -> DataFrame:
    """(label, feature, value): one row per vector component."""
    vectors = read_table(spark, folder, "embeddings")
    return vectors.select("label", F.posexplode("embedding").alias("_p", "_v")).select(
        "label", F.format_string("f%02d", "_p").alias("feature"), F.col("_v").cast("double").alias("value")
    )
