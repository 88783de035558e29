"""Queries: cleaning, splitting, encoding, preparation of records, scoring with known weights."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

from tidewatch.operators import clean, encode, explore, models, targets
from tidewatch.operators.stages import (
    ColumnDropper, ConstantDropper, IndicatorEncoder, LogColumns, PopulationScaler, RateEncoder, ValueGrouper, sparse_indicators,
)
from tidewatch.functions.scalars import numeric_columns
from tidewatch.plans.registry import query, shown
from tidewatch.sources import views
from tidewatch.sources.tables import read_table

# Coefficients of the linear score used where a fitted model would differ by solver.
WEIGHTS = {"l_quantity_scaled": 0.4, "l_extendedprice_scaled": -0.3, "l_discount_scaled": 0.8, "l_tax_scaled": 0.1}
INTERCEPT = -0.2
SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def md5_hash(key: str) -> Column:
    """52-bit hash that DuckDB can compute too."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 13), 16, 10).cast("double")


def _split_sql(table: str, key: str, stratum: str) -> str:
    return f"""
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY {stratum}
                         ORDER BY ('0x' || substr(md5({key}::VARCHAR), 1, 13))::UBIGINT)
                       <= floor(0.2::DOUBLE * count(*) OVER (PARTITION BY {stratum}) + 0.5) THEN 'test' ELSE 'train' END AS split
        FROM {table}"""


# Cleaning stages ----------------------------------------------------------------------------


@query("log1p_features", """
    SELECT c_custkey, c_acctbal, round(ln(1 + greatest(c_acctbal, 0)), 6) AS c_acctbal_log FROM customer""")
def log1p_features(spark, folder):
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return shown(LogColumns(columns=["c_acctbal", "absent"]).transform(customers))


@query("constant_drop", "SELECT c_custkey, c_nationkey FROM customer")
def constant_drop(spark, folder):
    customers = read_table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", F.lit(1).alias("always_one"),
        F.when(F.col("c_nationkey") == 3, F.lit("x")).alias("x_or_null"),
    )
    return ConstantDropper(columns=["c_nationkey", "always_one", "x_or_null", "absent"]).fit(customers).transform(customers)


@query("value_group", """
    SELECT l_linenumber, CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS attempts_grouped, count(*) AS rows
    FROM lineitem GROUP BY 1, 2""")
def value_group(spark, folder):
    items = read_table(spark, folder, "lineitem").select("l_linenumber", (F.col("l_linenumber") - 1).alias("attempts"))
    grouped = ValueGrouper(column="attempts").transform(items)
    return grouped.groupBy("l_linenumber", "attempts_grouped").agg(F.count("*").alias("rows"))


@query("value_group_observed", """
    SELECT DISTINCT l_linenumber AS value, l_linenumber NOT IN (0, 1) AS unexpected FROM lineitem""")
def value_group_observed(spark, folder):
    return ValueGrouper(column="l_linenumber").observed(read_table(spark, folder, "lineitem"))


@query("correlated_drop", """
    SELECT l_orderkey, l_linenumber, l_quantity, count(*) AS rows FROM lineitem GROUP BY 1, 2, 3""")
def correlated_drop(spark, folder):
    items = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax")
    kept = ColumnDropper(columns=["l_extendedprice", "l_tax", "absent"]).transform(items)
    return kept.groupBy(*kept.columns).agg(F.count("*").alias("rows"))


@query("feature_select", """
    SELECT n_chars, quality, count(*) AS rows FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2""")
def feature_select(spark, folder):
    documents = views.labelled_documents(spark, folder)
    numbers = numeric_columns(targets.drop_leakage(documents), exclude=["doc_id"])
    return documents.select(*numbers).groupBy(*numbers).agg(F.count("*").alias("rows"))


@query("feature_pipeline_flow", """
    WITH d AS (SELECT DISTINCT p_brand, l_linestatus, o_orderstatus, o_orderpriority, l_extendedprice, l_quantity,
                      p_size, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_anomaly
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
    SELECT 'desconocido' AS attack_category, is_anomaly, CASE WHEN p_size = 1 THEN 0 ELSE 1 END AS su_attempted_grouped,
           count(*) AS rows, round(avg(ln(1 + l_extendedprice)), 6) AS mean_src_log,
           round(avg(ln(1 + l_quantity)), 6) AS mean_dst_log
    FROM d GROUP BY 2, 3""")
def feature_pipeline_flow(spark, folder):
    from tidewatch.plans.flows import prepare_features

    raw = views.connections(spark, folder).select(
        "service", "protocol_type", "flag", "label", "src_bytes", "dst_bytes", "is_anomaly",
        (F.col("size") - 1).alias("su_attempted"), F.lit(0).alias("num_outbound_cmds"),
    )
    prepared, _ = prepare_features(raw)
    return shown(
        prepared.groupBy("attack_category", "is_anomaly", "su_attempted_grouped").agg(
            F.count("*").alias("rows"), F.avg("src_bytes_log").alias("mean_src_log"), F.avg("dst_bytes_log").alias("mean_dst_log"),
        )
    )


# Split and encoders -------------------------------------------------------------------------

DOCS = """(SELECT doc_id, source AS service, lang, n_chars, quality, toxic AS is_anomaly FROM documents JOIN labels USING (doc_id))"""
DOC_SPLIT = _split_sql(DOCS, "doc_id", "is_anomaly")


def _split_documents(spark, folder):
    documents = views.labelled_documents(spark, folder)
    return encode.stratified_split(documents, "is_anomaly", ["doc_id"], hashed=md5_hash("doc_id"))


@query("split_stratified", f"""
    SELECT event_id, is_anomaly, split
    FROM ({_split_sql("(SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_anomaly FROM events)", "event_id", "is_anomaly")})""")
def split_stratified(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", (F.col("event_type") == "error").cast("int").alias("is_anomaly"))
    return encode.stratified_split(events, "is_anomaly", ["event_id"], hashed=md5_hash("event_id"))


@query("split_summary", f"""
    SELECT split, count(*) AS rows, round(avg(is_anomaly), 6) AS anomaly_share FROM ({DOC_SPLIT}) GROUP BY 1""")
def split_summary(spark, folder):
    return shown(explore.split_summary(_split_documents(spark, folder)))


@query("target_encode", f"""
    WITH s AS ({DOC_SPLIT}),
         r AS (SELECT service, avg(is_anomaly) AS rate FROM s WHERE split = 'train' GROUP BY 1)
    SELECT doc_id, split, round(coalesce(rate, (SELECT avg(is_anomaly) FROM s WHERE split = 'train')), 6) AS service_anomaly_rate
    FROM s LEFT JOIN r USING (service)""")
def target_encode(spark, folder):
    rows = _split_documents(spark, folder)
    encoder = RateEncoder().fit(rows.where(F.col("split") == "train"))
    return shown(encoder.transform(rows).select("doc_id", "split", "service_anomaly_rate"))


@query("one_hot", f"""
    SELECT doc_id, {", ".join(f"CASE WHEN lang = '{x}' THEN 1 ELSE 0 END AS protocol_type_{x}" for x in ("de", "en", "es", "fr"))}
    FROM ({DOC_SPLIT})""")
def one_hot(spark, folder):
    rows = _split_documents(spark, folder)
    encoder = IndicatorEncoder(columns=["protocol_type"]).fit(rows.where(F.col("split") == "train"))
    return encoder.transform(rows).drop("service", "n_chars", "quality", "is_anomaly", "split")


@query("one_hot_sparse", f"""
    WITH s AS ({DOC_SPLIT}), c AS (SELECT service, row_number() OVER (ORDER BY count(*) DESC, service) - 1 AS i FROM s WHERE split = 'train' GROUP BY service)
    SELECT doc_id, coalesce(i, (SELECT count(*) FROM c))::INTEGER AS place, 1.0::DOUBLE AS value, (SELECT count(*) + 1 FROM c)::INTEGER AS size FROM s LEFT JOIN c USING (service)""")
def one_hot_sparse(spark, folder):
    """The sparse form for columns of many values: the one place of each row's vector that is set."""
    rows = _split_documents(spark, folder)
    encoder = sparse_indicators(["service"]).fit(rows.where(F.col("split") == "train").orderBy("doc_id"))
    dense = vector_to_array("service_vector")
    encoded = encoder.transform(rows).select("doc_id", dense.alias("v"))
    place = F.array_position("v", F.lit(1.0)).cast("int") - 1
    return encoded.select("doc_id", place.alias("place"), F.get("v", place).alias("value"), F.size("v").alias("size"))


_SCALE_SQL = ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}_scaled" for c in SCALED
)
_LINEAR_SQL = f"""
    SELECT l_orderkey, l_linenumber, l_partkey, is_anomaly, 1 / (1 + exp(-({INTERCEPT}
           {" ".join(f"+ ({w}::DOUBLE) * {c}" for c, w in WEIGHTS.items())}))) AS score
    FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_anomaly, {_SCALE_SQL} FROM lineitem)"""


def _scaled(spark, folder):
    items = views.items(spark, folder)
    return PopulationScaler(columns=SCALED).fit(items).transform(items)


@query("standard_scale", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {", ".join(f"round({c}_scaled, 6) + 0.0 AS {c}_scaled" for c in SCALED)}
    FROM (SELECT *, {_SCALE_SQL} FROM lineitem)""")
def standard_scale(spark, folder):
    return shown(_scaled(spark, folder).select("l_orderkey", "l_linenumber", "l_partkey", *[f"{c}_scaled" for c in SCALED]))


@query("score_fixed_linear", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, round(score, 6) AS score FROM ({_LINEAR_SQL})""")
def score_fixed_linear(spark, folder):
    scored = _scaled(spark, folder).withColumn("score", encode.linear_score(WEIGHTS, INTERCEPT))
    return shown(scored.select("l_orderkey", "l_linenumber", "l_partkey", "score"))


@query("decision_columns", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, score >= 0.5 AS anomaly, round(score, 4) AS anomaly_score, 'linear-1' AS model_version
    FROM ({_LINEAR_SQL})""")
def decision_columns(spark, folder):
    decided = encode.decide(_scaled(spark, folder), encode.linear_score(WEIGHTS, INTERCEPT), "linear-1")
    return decided.select("l_orderkey", "l_linenumber", "l_partkey", "anomaly", "anomaly_score", "model_version")


# Records to be scored -----------------------------------------------------------------------

EXPECTED = ["src_bytes", "dst_bytes", "src_bytes_log", "dst_bytes_log", "count", "su_attempted_grouped",
            "service_anomaly_rate", "protocol_type_tcp", "protocol_type_udp", "flag_SF", "never_seen"]


def _partial_records(spark, folder):
    """Events as partial records: a number inside JSON, text where a number belongs, gaps."""
    return read_table(spark, folder, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("src_bytes"),
        F.col("event_type").alias("dst_bytes"),
        F.when(F.col("user_id") % 2 == 0, F.lit("udp")).alias("protocol_type"),
        F.when(F.col("event_type") == "error", F.lit(2)).alias("su_attempted"),
    )


_NUMBER = "coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0)"


@query("coerce_defaults", f"""
    SELECT event_id, {_NUMBER} AS src_bytes, 0.0::DOUBLE AS dst_bytes, round(ln(1 + greatest({_NUMBER}, 0)), 6) AS src_bytes_log,
           0.0::DOUBLE AS dst_bytes_log, 0.0::DOUBLE AS count, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS su_attempted_grouped,
           0.5::DOUBLE AS service_anomaly_rate, 0 AS protocol_type_tcp, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS protocol_type_udp,
           1 AS "flag_SF", 0 AS never_seen
    FROM events""")
def coerce_defaults(spark, folder):
    return shown(encode.prepare_records(_partial_records(spark, folder), expected=EXPECTED, keep=["event_id"]))


@query("align_columns", """
    SELECT event_id, value, 0 AS absent, user_id FROM events""")
def align_columns(spark, folder):
    return encode.align_columns(read_table(spark, folder, "events"), ["value", "absent", "user_id"], keep=["event_id"])


@query("verified_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def verified_distinct(spark, folder):
    return clean.verified_distinct(read_table(spark, folder, "events").select("user_id", "event_type"))[0]


@query("balanced_weights", """
    SELECT toxic, count(*) AS rows, round(any_value((SELECT count(*) FROM labels)) / (2.0 * count(*)), 6) AS weight FROM labels GROUP BY 1""")
def balanced_weights(spark, folder):
    weighted = models.with_balanced_weight(read_table(spark, folder, "labels"), "toxic")
    return shown(weighted.groupBy("toxic").agg(F.count("*").alias("rows"), F.max("_weight").alias("weight")))
