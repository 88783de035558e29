"""Queries: targets, gates, quality profile, exploration."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F, types as T

from tidewatch.functions.scalars import long_form
from tidewatch.functions.storage import fresh_folder
from tidewatch.operators import clean, explore, gates, profile, targets
from tidewatch.plans.registry import query, shown
from tidewatch.sources import runlog, tables, views
from tidewatch.sources.tables import read_table

PRIORITIES = "CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'urgent' WHEN '3-MEDIUM' THEN 'normal' WHEN '5-LOW' THEN 'normal' ELSE 'desconocido' END"
ITEM_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# Targets ------------------------------------------------------------------------------------


@query("service_risk_top15", """
    SELECT p_brand AS service, round(avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 6) AS anomaly_rate,
           count(*) AS connections
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_brand HAVING count(*) >= 50
    ORDER BY avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) DESC, p_brand LIMIT 15""")
def service_risk_top15(spark, folder):
    services = read_table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("service"))
    return shown(explore.service_risk_by_key(views.items(spark, folder), "l_partkey", services, "p_partkey", "service"))


@query("raw_normalise", """
    SELECT doc_id, source AS label, lang, md5(text) AS text_md5, length(text) AS characters FROM documents""")
def raw_normalise(spark, folder):
    raw = read_table(spark, folder, "documents").select(
        "doc_id", "lang", F.encode("text", "UTF-8").alias("text"), F.encode("source", "UTF-8").alias("target")
    )
    return tables.normalise_raw(raw).select(
        "doc_id", "label", "lang", F.md5("text").alias("text_md5"), F.length("text").alias("characters")
    )


@query("label_normalise", """
    SELECT concat('b''', o_orderpriority, '..''') AS label,
           rtrim(replace(replace(concat('b''', o_orderpriority, '..'''), 'b''', ''), '''', ''), '.') AS clean,
           count(*) AS rows
    FROM orders GROUP BY o_orderpriority""")
def label_normalise(spark, folder):
    raw = read_table(spark, folder, "orders").select(F.concat(F.lit("b'"), "o_orderpriority", F.lit("..'")).alias("label"))
    return raw.withColumn("clean", targets.clean_label(F.col("label"))).groupBy("label", "clean").agg(F.count("*").alias("rows"))


@query("taxonomy_map", f"""
    SELECT o_orderpriority AS label, {PRIORITIES} AS attack_category, count(*) AS rows FROM orders GROUP BY 1, 2""")
def taxonomy_map(spark, folder):
    orders = read_table(spark, folder, "orders").select(F.col("o_orderpriority").alias("label"))
    mapped = targets.add_category(orders, mapping=views.PRIORITY_TAXONOMY)
    return mapped.groupBy("label", "attack_category").agg(F.count("*").alias("rows"))


@query("binary_target", f"""
    SELECT o_orderpriority AS label, CASE WHEN {PRIORITIES} <> 'normal' THEN 1 ELSE 0 END AS is_anomaly,
           CASE WHEN o_orderpriority <> '5-LOW' THEN 1 ELSE 0 END AS is_other_label, count(*) AS rows
    FROM orders GROUP BY 1, 2, 3""")
def binary_target(spark, folder):
    orders = read_table(spark, folder, "orders").select(F.col("o_orderpriority").alias("label"))
    mapped = targets.add_anomaly(targets.add_category(orders, mapping=views.PRIORITY_TAXONOMY))
    both = targets.add_anomaly(mapped, source="label", clean=True, normal="5-LOW", output="is_other_label")
    return both.groupBy("label", "is_anomaly", "is_other_label").agg(F.count("*").alias("rows"))


# Gates --------------------------------------------------------------------------------------


@query("gate_table", """
    WITH g AS (SELECT count(*) AS c FROM events GROUP BY ts, user_id, event_type, value, props),
         t AS (SELECT sum(c)::DOUBLE AS n, (sum(c - 1) / sum(c))::DOUBLE AS r FROM g)
    SELECT 1 AS position, 'not_empty' AS gate, n AS observed, 0.0::DOUBLE AS threshold, n > 0 AS passed FROM t
    UNION ALL SELECT 2, 'minimum_rows', n, 1000.0, n >= 1000 FROM t
    UNION ALL SELECT 3, 'column_count', 5.0, 42.0, false FROM t
    UNION ALL SELECT 4, 'required_columns', 1.0, 1.0, true FROM t
    UNION ALL SELECT 5, 'duplicate_rate', round(r, 6), 0.9, r < 0.9 FROM t""")
def gate_table(spark, folder):
    """All columns but the row id, which would tell every copy apart."""
    return shown(gates.gate_table(read_table(spark, folder, "events").drop("event_id"), min_rows=1000, required=["event_type"]))


_TYPED = "(SELECT user_id, event_type, CASE WHEN event_id % 3 = 0 THEN 'test' ELSE 'train' END AS split, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_anomaly FROM events)"


@query("gates_while_writing", f"""
    WITH g AS (SELECT *, count(*) AS c FROM {_TYPED} GROUP BY ALL),
         t AS (SELECT sum(c)::DOUBLE AS n, (sum(c - 1) / sum(c))::DOUBLE AS r FROM g)
    SELECT 'not_empty' AS name, NULL AS key, n AS value, n > 0 AS passed FROM t
    UNION ALL SELECT 'minimum_rows', NULL, n, n >= 1000 FROM t
    UNION ALL SELECT 'column_count', NULL, 4, true FROM t
    UNION ALL SELECT 'required_columns', NULL, 1, true FROM t
    UNION ALL SELECT 'duplicate_rate', NULL, round(r, 6), r < 0.9 FROM t
    UNION ALL SELECT 'total_null_cells', NULL, 0, NULL FROM t
    UNION ALL SELECT 'rows', split, count(*), NULL FROM g GROUP BY split
    UNION ALL SELECT 'anomaly_share', split, round(avg(is_anomaly), 6), NULL FROM g GROUP BY split
    UNION ALL SELECT 'stored', NULL, count(*), NULL FROM g""")
def gates_while_writing(spark, folder):
    """Gate figures and split summary gathered by the write of the cleaned table itself."""
    rows = lambda session: read_table(session, folder, "events").select(
        "user_id", "event_type", F.when(F.col("event_id") % 3 == 0, "test").otherwise("train").alias("split"), (F.col("event_type") == "error").cast("int").alias("is_anomaly"))
    path = fresh_folder(spark, "clean")
    found, facts = gates.write_distinct(spark, rows, path, "split", "is_anomaly", min_rows=1000, expected_columns=4, required=["event_type"])
    none = F.lit(None)
    stored = tables.read_parquet(spark, path).agg(F.count("*").cast("double").alias("value"))
    return shown(profile.union_all([
        found.select(F.col("gate").alias("name"), none.cast("string").alias("key"), F.col("observed").alias("value"), "passed"),
        facts.select(F.col("fact").alias("name"), "key", "value", none.cast("boolean").alias("passed")),
        stored.select(F.lit("stored").alias("name"), none.cast("string").alias("key"), "value", none.cast("boolean").alias("passed")),
    ]))


@query("guarded_rows", """
    SELECT event_type, count(*) AS rows FROM events WHERE user_id IS NOT NULL GROUP BY 1""")
def guarded_rows(spark, folder):
    """Rows behind a hard stop that is part of the plan: a rule for each row, and gates over the table."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    past = gates.only_past(events, gates.gate_table(events, min_rows=1, expected_columns=4, required=["event_type"]))
    return gates.guarded(past, {"user known": F.col("user_id").isNotNull(), "value not negative": F.col("value") >= 0}).groupBy("event_type").agg(F.count("*").alias("rows"))


@query("clean_rules", """
    SELECT 'required_columns' AS rule, true AS passed UNION ALL SELECT 'no_nulls', (SELECT bool_and(value IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL) FROM events)
    UNION ALL SELECT 'numeric_types', true UNION ALL SELECT 'non_negative', (SELECT bool_and(value >= 0) FROM events)
    UNION ALL SELECT 'binary_login', (SELECT bool_and(event_type IN ('view', 'click')) FROM events)""")
def clean_rules(spark, folder):
    """The assertions on the cleaned table, with roles for its columns."""
    events = read_table(spark, folder, "events").select(
        F.col("value").alias("duration"), F.col("value").alias("src_bytes"), F.col("user_id").alias("dst_bytes"),
        F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1).otherwise(2).alias("logged_in"), F.col("event_type").alias("label"))
    return gates.clean_table_rules(events)


# Missing values, duplicates -----------------------------------------------------------------

DOCS_WITH_LABELS = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _documents_with_labels(spark, folder):
    documents = read_table(spark, folder, "documents")
    return documents.join(read_table(spark, folder, "labels"), "doc_id", "left")


@query("null_profile", f"""
    SELECT 'quality' AS "column", count(*) - count(quality) AS nulls FROM {DOCS_WITH_LABELS}
    UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM {DOCS_WITH_LABELS}""")
def null_profile(spark, folder):
    return profile.null_profile(_documents_with_labels(spark, folder))


@query("total_nulls", f"""
    SELECT (2 * count(*) - count(quality) - count(toxic))::BIGINT AS total_null_cells FROM {DOCS_WITH_LABELS}""")
def total_nulls(spark, folder):
    return profile.total_nulls(_documents_with_labels(spark, folder))


@query("encoded_missing", """
    SELECT 'o_orderpriority' AS "column", count(*) AS tokens FROM orders
    WHERE o_orderpriority IN ('?', '-', 'unknown', 'none', '4-NOT SPECIFIED')""")
def encoded_missing(spark, folder):
    return profile.encoded_missing(read_table(spark, folder, "orders"), ["?", "-", "unknown", "none", "4-NOT SPECIFIED"])


@query("cardinality", """
    SELECT 'text' AS "column", count(DISTINCT text) AS distinct_values FROM documents
    UNION ALL SELECT 'lang', count(DISTINCT lang) FROM documents
    UNION ALL SELECT 'source', count(DISTINCT source) FROM documents""")
def cardinality(spark, folder):
    return profile.cardinality(read_table(spark, folder, "documents"))


@query("duplicate_profile", """
    SELECT sum(c)::BIGINT AS rows, sum(c - 1)::BIGINT AS duplicate_rows, round(sum(c - 1) / sum(c) * 100, 2) AS duplicate_pct
    FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang)""")
def duplicate_profile(spark, folder):
    return profile.duplicate_profile(read_table(spark, folder, "documents").select("text", "lang"))


@query("dedup_global", """
    SELECT DISTINCT lang, n_chars, md5(text) AS text_md5 FROM documents""")
def dedup_global(spark, folder):
    """No text leaves the task that read it."""
    distinct = clean.dedup_files(read_table(spark, folder, "documents"), ["text", "lang", "n_chars"])
    return distinct.select("lang", "n_chars", F.md5("text").alias("text_md5"))


@query("dedup_in_class", """
    SELECT DISTINCT user_id, event_type FROM events WHERE event_type = 'view'
    UNION ALL SELECT user_id, event_type FROM events WHERE event_type <> 'view'""")
def dedup_in_class(spark, folder):
    return clean.dedup_in_class(read_table(spark, folder, "events").select("user_id", "event_type"), "event_type", "view")


@query("duplicate_rows_marked", """
    SELECT event_id, user_id, event_type,
           row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1 AS is_duplicate
    FROM events""")
def duplicate_rows_marked(spark, folder):
    rows = read_table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return clean.mark_duplicates(rows, ["user_id", "event_type"], "event_id")


# Consistency, types, domains ----------------------------------------------------------------


@query("inconsistent_rows", """
    SELECT 'returned_while_open' AS rule, count(*) AS rows FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'O' AND l_discount = 0
    UNION ALL SELECT 'single_free_of_tax', count(*) FROM lineitem
    WHERE l_quantity = 1 AND l_tax = 0 AND l_discount = 0""")
def inconsistent_rows(spark, folder):
    rules = {
        "returned_while_open": (
            {"l_returnflag", "l_linestatus", "l_discount"},
            (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O") & (F.col("l_discount") == 0),
        ),
        "single_free_of_tax": (
            {"l_quantity", "l_tax", "l_discount"},
            (F.col("l_quantity") == 1) & (F.col("l_tax") == 0) & (F.col("l_discount") == 0),
        ),
        "needs_absent_column": ({"l_shipmode"}, F.lit(True)),
    }
    return profile.inconsistent_rows(read_table(spark, folder, "lineitem"), rules)


@query("type_check", """
    SELECT 'lang' AS "column", 'text' AS expected, 'text' AS actual, true AS matches, 0::BIGINT AS not_numbers
    UNION ALL SELECT 'n_chars', 'text', 'numeric', false, 0
    UNION ALL SELECT 'doc_id', 'numeric', 'numeric', true, count(*) - count(TRY_CAST(doc_id AS DOUBLE)) FROM documents
    UNION ALL SELECT 'source', 'numeric', 'text', false, count(source) - count(TRY_CAST(source AS DOUBLE)) FROM documents""")
def type_check(spark, folder):
    expected = {"lang": "text", "n_chars": "text", "doc_id": "numeric", "source": "numeric"}
    return profile.type_profile(read_table(spark, folder, "documents"), expected)


@query("unexpected_categories", """
    SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS rows FROM orders
    WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 2
    UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 2""")
def unexpected_categories(spark, folder):
    allowed = {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}
    return profile.unexpected_categories(read_table(spark, folder, "orders"), allowed)


@query("impossible_values", """
    SELECT 'c_acctbal_negativos' AS finding, count(*) AS rows FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'c_nationkey_fuera_de_[0,1]', count(*) FROM customer WHERE c_nationkey < 0 OR c_nationkey > 1""")
def impossible_values(spark, folder):
    return profile.impossible_values(read_table(spark, folder, "customer"), ["c_custkey", "c_acctbal"], ["c_nationkey"])


# Spread -------------------------------------------------------------------------------------


def _outlier_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"""
        SELECT '{c}' AS feature, count(*) FILTER ({c} < lo OR {c} > hi) AS outliers,
               round(count(*) FILTER ({c} < lo OR {c} > hi) / count(*) * 100, 2) AS pct
        FROM {table}, (SELECT q[1] - 3 * (q[2] - q[1]) AS lo, q[2] + 3 * (q[2] - q[1]) AS hi, q[2] - q[1] AS iqr
                       FROM (SELECT quantile_cont({c}::DOUBLE, [0.25::DOUBLE, 0.75::DOUBLE]) AS q FROM {table}))
        WHERE iqr <> 0 HAVING count(*) FILTER ({c} < lo OR {c} > hi) > 0""" for c in columns)


ALL_OUTLIERS = " UNION ALL ".join([
    _outlier_sql("lineitem", ITEM_COLUMNS), _outlier_sql("events", ["value", "user_id"]), _outlier_sql("documents", ["n_chars"]),
])


@query("outliers_iqr3", _outlier_sql("documents", ["doc_id", "n_chars"]))
def outliers_iqr3(spark, folder):
    return profile.outliers_iqr(read_table(spark, folder, "documents"))


@query("top5_outlier_columns", f"SELECT * FROM ({ALL_OUTLIERS}) ORDER BY pct DESC, feature LIMIT 5")
def top5_outlier_columns(spark, folder):
    cells = profile.union_all([
        long_form(read_table(spark, folder, "lineitem"), ITEM_COLUMNS),
        long_form(read_table(spark, folder, "events"), ["value", "user_id"]),
        long_form(read_table(spark, folder, "documents"), ["n_chars"]),
    ])
    return profile.top_outliers(profile.outliers_long(cells))


@query("skewness_adjusted", """
    SELECT 'l_quantity' AS feature, round(skewness(l_quantity), 6) + 0.0 AS skewness FROM lineitem
    UNION ALL SELECT 'l_extendedprice', round(skewness(l_extendedprice), 6) + 0.0 FROM lineitem
    UNION ALL SELECT 'l_discount', round(skewness(l_discount), 6) + 0.0 FROM lineitem
    UNION ALL SELECT 'l_tax', round(skewness(l_tax), 6) + 0.0 FROM lineitem""")
def skewness_adjusted(spark, folder):
    return shown(profile.skewness(read_table(spark, folder, "lineitem"), ITEM_COLUMNS, limit=None))


@query("high_skewness", """
    SELECT 'n_chars' AS feature, round(skewness(n_chars), 6) AS skewness FROM documents HAVING abs(skewness(n_chars)) > 3
    UNION ALL SELECT 'doc_id', round(skewness(doc_id), 6) FROM documents HAVING abs(skewness(doc_id)) > 3""")
def high_skewness(spark, folder):
    return shown(profile.skewness(read_table(spark, folder, "documents")))


@query("zscore_extremes", """
    WITH m AS (SELECT avg(value) AS mv, stddev_pop(value) AS sv, avg(user_id) AS mu, stddev_pop(user_id) AS su FROM events),
         f AS (SELECT abs((value - mv) / sv) > 5 OR abs((user_id - mu) / su) > 5 AS far, event_type = 'error' AS hit FROM events, m)
    SELECT count(*) FILTER (far) AS extreme_rows, round(count(*) FILTER (far) / count(*) * 100, 2) AS extreme_pct,
           count(*) FILTER (far AND hit) AS anomaly_overlap,
           round(count(*) FILTER (far AND hit) / greatest(count(*) FILTER (far), 1) * 100, 1) AS overlap_pct
    FROM f""")
def zscore_extremes(spark, folder):
    events = read_table(spark, folder, "events")
    return profile.zscore_extremes(events, ["value", "user_id"], (F.col("event_type") == "error").cast("int"))


# Correlation --------------------------------------------------------------------------------

PLANTED = "(SELECT *, 2 * l_extendedprice + 1 AS gross, CASE WHEN l_linenumber <> 1 THEN l_extendedprice END AS later_price FROM lineitem)"
PLANTED_COLUMNS = [*ITEM_COLUMNS, "gross", "later_price"]


def _planted(spark, folder):
    """lineitem with a linear copy and a column with gaps, so that pairs pass the limit."""
    return views.items(spark, folder).withColumns({
        "gross": 2 * F.col("l_extendedprice") + 1,
        "later_price": F.when(F.col("l_linenumber") != 1, F.col("l_extendedprice")),
    })


def _pair_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM {PLANTED}"
        for i, a in enumerate(columns) for b in columns[i + 1:]
    )


@query("correlation_matrix", f"SELECT feature_a, feature_b, round(r, 6) + 0.0 AS r FROM ({_pair_sql(PLANTED_COLUMNS)})")
def correlation_matrix(spark, folder):
    return shown(profile.correlation_pairs(_planted(spark, folder), PLANTED_COLUMNS))


@query("correlated_pairs", f"""
    SELECT feature_a, feature_b, round(abs(r), 3) AS abs_r FROM ({_pair_sql(PLANTED_COLUMNS)}) WHERE abs(r) > 0.9
    ORDER BY abs_r DESC, feature_a, feature_b LIMIT 10""")
def correlated_pairs(spark, folder):
    return profile.strongest_pairs(profile.correlated_pairs(_planted(spark, folder), PLANTED_COLUMNS))


@query("target_correlation", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 6) + 0.0 AS r FROM {PLANTED}"
    for c in PLANTED_COLUMNS))
def target_correlation(spark, folder):
    return shown(profile.target_correlation(_planted(spark, folder), PLANTED_COLUMNS))


# Classes ------------------------------------------------------------------------------------


@query("class_imbalance", """
    SELECT o_orderpriority AS class, count(*) AS rows, round(count(*) / (SELECT count(*) FROM orders) * 100, 3) AS pct
    FROM orders GROUP BY 1""")
def class_imbalance(spark, folder):
    return profile.class_distribution(read_table(spark, folder, "orders"), "o_orderpriority")


@query("imbalance_ratio", """
    WITH c AS (SELECT toxic AS k, count(*) AS n FROM labels GROUP BY 1)
    SELECT (SELECT k FROM c ORDER BY n DESC, k LIMIT 1) AS majority, (SELECT k FROM c ORDER BY n, k LIMIT 1) AS minority,
           round((SELECT max(n) / min(n) FROM c), 1) AS ratio""")
def imbalance_ratio(spark, folder):
    return shown(profile.class_imbalance(read_table(spark, folder, "labels"), "toxic"), 1)


@query("category_counts", f"SELECT {PRIORITIES} AS class, count(*) AS rows FROM orders GROUP BY 1")
def category_counts(spark, folder):
    orders = read_table(spark, folder, "orders").select(F.col("o_orderpriority").alias("label"))
    return explore.class_counts(targets.add_category(orders, mapping=views.PRIORITY_TAXONOMY), "attack_category")


@query("median_by_class", """
    SELECT o_orderpriority AS class, 'src_bytes' AS feature, round(quantile_cont(l_extendedprice, 0.5::DOUBLE), 6) AS median
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    UNION ALL SELECT o_orderpriority, 'dst_bytes', round(quantile_cont(l_quantity, 0.5::DOUBLE), 6)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def median_by_class(spark, folder):
    return shown(explore.median_by_class(_classed_bytes(spark, folder), "label", ["src_bytes", "dst_bytes"], keep_input=True))


def _classed_bytes(spark, folder):
    items, orders = read_table(spark, folder, "lineitem"), read_table(spark, folder, "orders")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderpriority").alias("label"),
        F.col("l_extendedprice").alias("src_bytes"), F.col("l_quantity").alias("dst_bytes"),
    )


@query("mean_by_class", """
    SELECT source AS class, round(avg(n_chars), 6) AS mean FROM documents GROUP BY 1""")
def mean_by_class(spark, folder):
    return shown(explore.mean_by_class(read_table(spark, folder, "documents"), "source", "n_chars"))


@query("boxplot_by_class", """
    WITH x AS (SELECT lang AS class, 'n_chars' AS feature, ln(1 + greatest(n_chars, 0)::DOUBLE) AS v FROM documents),
         q AS (SELECT class, feature, quantile_cont(v, [0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE]) AS q FROM x GROUP BY 1, 2)
    SELECT class, feature, round(q[1], 6) AS q1, round(q[2], 6) AS median, round(q[3], 6) AS q3,
           round(least(q[1], min(v) FILTER (v >= q[1] - 1.5 * (q[3] - q[1]))), 6) AS whisker_low,
           round(greatest(q[3], max(v) FILTER (v <= q[3] + 1.5 * (q[3] - q[1]))), 6) AS whisker_high
    FROM x JOIN q USING (class, feature) GROUP BY class, feature, q""")
def boxplot_by_class(spark, folder):
    return shown(explore.boxplot_by_class(read_table(spark, folder, "documents"), "lang", ["n_chars"]))


@query("crosstab_pct", """
    WITH t AS (SELECT o_orderpriority AS class, count(*) AS n, count(*) FILTER (l_linestatus = 'F') AS f,
                      count(*) FILTER (l_linestatus = 'O') AS o
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
    SELECT class, 'F' AS value, round(f / n * 100, 1) AS pct FROM t
    UNION ALL SELECT class, 'O', round(o / n * 100, 1) FROM t
    UNION ALL SELECT class, 'X', 0.0 FROM t""")
def crosstab_pct(spark, folder):
    items, orders = read_table(spark, folder, "lineitem"), read_table(spark, folder, "orders")
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey)
    return explore.crosstab_pct(joined, "o_orderpriority", "l_linestatus", ["F", "O", "X"])


@query("histogram_by_class", """
    WITH x AS (SELECT event_type AS class, value::DOUBLE AS v FROM events),
         r AS (SELECT class, count(*) AS n, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 20 AS step FROM x GROUP BY 1),
         g AS (SELECT class, v, n, lo, step, least(floor((v - lo) / (hi - lo) * 20), 19)::INTEGER AS g FROM x JOIN r USING (class)),
         b AS (SELECT class, g - CASE WHEN v < g * step + lo THEN 1 ELSE 0 END
                      + CASE WHEN v >= (g + 1) * step + lo AND g <> 19 THEN 1 ELSE 0 END AS bin FROM g),
         c AS (SELECT class, bin, count(*) AS k FROM b GROUP BY 1, 2)
    SELECT r.class, t.i::INTEGER AS bin, round(t.i * step + lo, 6) AS left_edge, coalesce(k, 0) AS rows,
           round(coalesce(k, 0) / (n * step), 6) AS density
    FROM r CROSS JOIN range(20) t(i) LEFT JOIN c ON c.class = r.class AND c.bin = t.i""")
def histogram_by_class(spark, folder):
    return shown(explore.histogram_by_class(read_table(spark, folder, "events"), "event_type", "value"))


@query("quality_report")
def quality_report(spark, folder):
    """All checks as one findings table (each check has its own query with SQL above)."""
    view = views.connections(spark, folder).drop("l_orderkey", "l_linenumber")
    return shown(profile.quality_report(targets.add_category(view)))


# Sources ------------------------------------------------------------------------------------


@query("nan_profile", """
    SELECT 'missing' AS "check", 'value' AS "column", count(*) FILTER (event_id % 50 = 0 OR value IS NULL) AS "rows" FROM events
    UNION ALL SELECT 'impossible', 'value_negativos', count(*) FILTER (event_id % 50 <> 0 AND value - 50 < 0) FROM events
    UNION ALL SELECT 'impossible', 'value_rate_fuera_de_[0,1]', count(*) FILTER (event_id % 50 <> 0 AND (value / 50 < 0 OR value / 50 > 1)) FROM events""")
def nan_profile(spark, folder):
    """NaN in a stored table is missing after reading: no range rule and no count takes it for a number."""
    nan = lambda value: F.when(F.col("event_id") % 50 == 0, F.lit(float("nan"))).otherwise(value)
    events = read_table(spark, folder, "events").select("event_id", nan(F.col("value") - 50).alias("value"), nan(F.col("value") / 50).alias("value_rate"))
    path = fresh_folder(spark, "nan")
    tables.write_table(events, path)
    stored = tables.read_parquet(spark, path)
    missing = profile.null_profile(stored, ["value"]).select(F.lit("missing").alias("check"), "column", F.col("nulls").alias("rows"))
    impossible = profile.impossible_values(stored, ["value"], ["value_rate"])
    return missing.unionByName(impossible.select(F.lit("impossible").alias("check"), F.col("finding").alias("column"), "rows"))


_GAPS = "(SELECT event_id, event_type, CASE WHEN event_id % 50 <> 0 THEN value END AS value, CASE WHEN event_id % 30 <> 0 THEN user_id::DOUBLE END AS user_id FROM events)"


@query("nan_derived", f"""
    WITH m AS (SELECT avg(value) AS mv, stddev_pop(value) AS sv, avg(user_id) AS mu, stddev_pop(user_id) AS su FROM {_GAPS})
    SELECT 'missing' AS "check", 'value' AS "column", count(*) FILTER (value IS NULL)::DOUBLE AS found FROM {_GAPS}
    UNION ALL SELECT 'missing', 'user_id', count(*) FILTER (user_id IS NULL) FROM {_GAPS}
    UNION ALL SELECT 'impossible', 'value_fuera_de_[0,1]', count(*) FILTER (value < 0 OR value > 1) FROM {_GAPS}
    UNION ALL SELECT 'extreme', 'rows', count(*) FILTER (abs((value - mv) / sv) > 3 OR abs((user_id - mu) / su) > 3) FROM {_GAPS}, m
    UNION ALL SELECT 'skewness', 'value', round(skewness(value), 6) FROM {_GAPS}
    UNION ALL SELECT 'correlation', 'value', round(corr(value, user_id), 6) + 0.0 FROM {_GAPS}""")
def nan_derived(spark, folder):
    """NaN that comes up inside a plan is missing for every check, as if a reader had cleaned it."""
    nan = lambda column, every: F.when(F.col("event_id") % every == 0, F.lit(float("nan"))).otherwise(F.col(column).cast("double")).alias(column)
    events = read_table(spark, folder, "events").select("event_id", "event_type", nan("value", 50), nan("user_id", 30))
    shown_as = lambda check, frame, column, found: frame.select(F.lit(check).alias("check"), column.alias("column"), F.col(found).cast("double").alias("found"))
    return shown(profile.union_all([
        shown_as("missing", profile.null_profile(events), F.col("column"), "nulls"),
        shown_as("impossible", profile.impossible_values(events, [], ["value"]), F.col("finding"), "rows"),
        shown_as("extreme", profile.zscore_extremes(events, ["value", "user_id"], limit=3), F.lit("rows"), "extreme_rows"),
        shown_as("skewness", profile.skewness(events, ["value"], limit=None), F.col("feature"), "skewness"),
        shown_as("correlation", profile.correlation_pairs(events, ["value", "user_id"]), F.col("feature_a"), "r"),
    ]))


@query("csv_roundtrip", """
    SELECT event_id, event_type, CASE WHEN event_id % 40 <> 0 THEN round(value, 6) END AS value, CASE WHEN event_id % 40 = 0 THEN 'n/a' END AS bad_value
    FROM events""")
def csv_roundtrip(spark, folder):
    """Written as CSV and read with types; unreadable cells are listed, not lost."""
    events = read_table(spark, folder, "events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 40 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value")
    )
    path = fresh_folder(spark, "csv")
    tables.write_table(events, path, "csv")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    back = tables.read_csv(spark, path, schema, bad_cells="bad")
    return shown(back.select("event_id", "event_type", "value", F.col("bad")["value"].alias("bad_value")))


@query("csv_quarantine", """
    WITH l AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN concat(event_id, ',', user_id, ',', event_type, ',extra') WHEN event_id % 89 = 0 THEN event_id::VARCHAR
                      ELSE concat(event_id, ',', user_id, ',', event_type) END AS line FROM events)
    SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, NULL AS line FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
    UNION ALL SELECT NULL, NULL, NULL, line FROM l WHERE event_id % 97 = 0 OR event_id % 89 = 0""")
def csv_quarantine(spark, folder):
    """A feed in which some lines have a cell too many or too few: each line is read once, as a row or as it stands."""
    events = read_table(spark, folder, "events")
    line = F.concat_ws(",", "event_id", "user_id", "event_type")
    broken = F.when(F.col("event_id") % 97 == 0, F.concat(line, F.lit(",extra"))).when(F.col("event_id") % 89 == 0, F.col("event_id").cast("string")).otherwise(line)
    path = fresh_folder(spark, "feed")
    # Every part file of the feed begins with the header, as its readers expect.
    parts = events.select(broken.alias("event_id,user_id,event_type"))
    parts.write.options(header=True, quote="", escapeQuotes=False, sep="\x01").csv(path)
    table, quarantine = tables.read_csv_checked(spark, path)
    none = lambda *names: [F.lit(None).cast("string").alias(c) for c in names]
    return table.select("*", *none("line")).unionByName(quarantine.select(*none("event_id", "user_id", "event_type"), "line"))


@query("run_log_twice", """
    SELECT event_type AS run_name, md5(event_type) AS fingerprint, 'FINISHED' AS status FROM events GROUP BY 1""")
def run_log_twice(spark, folder):
    """Runs appended to a stored log, with copies inside one call and again in a second call."""
    runs = read_table(spark, folder, "events").select(
        F.col("event_type").alias("run_name"), F.md5(F.col("event_type")).alias("fingerprint"), F.lit(runlog.FINISHED).alias("status")
    )
    path = fresh_folder(spark, "runs")
    for _ in range(2):
        runlog.append_runs(path, runs)
    return runlog.read_runs(path, spark)


@query("run_log_writers", """
    SELECT event_type AS run_name, md5(event_type) AS fingerprint, 'FINISHED' AS status FROM events GROUP BY 1
    UNION ALL SELECT concat('user ', user_id), md5(user_id::VARCHAR), 'FAILED' FROM events GROUP BY user_id""")
def run_log_writers(spark, folder):
    """Four writers at the same time, all with the same finished runs; failed ones come from one of them only."""
    events = read_table(spark, folder, "events")
    runs = events.select(F.col("event_type").alias("run_name"), F.md5("event_type").alias("fingerprint"), F.lit(runlog.FINISHED).alias("status")).distinct()
    user = F.col("user_id").cast("string")
    failed = events.select(F.concat(F.lit("user "), user).alias("run_name"), F.md5(user).alias("fingerprint"), F.lit("FAILED").alias("status")).distinct()
    path = fresh_folder(spark, "runs")
    with ThreadPoolExecutor(4) as writers:
        list(writers.map(lambda n: runlog.append_runs(path, runs.unionByName(failed) if n == 2 else runs, f"writer-{n}"), range(4)))
    return runlog.read_runs(path, spark)
