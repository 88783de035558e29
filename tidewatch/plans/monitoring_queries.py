"""Queries: evaluation, drift, batch validation, service figures, behaviour windows, run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.scalars import long_form
from tidewatch.functions.storage import fresh_folder, materialize
from tidewatch.operators import batches, behaviour, drift, evaluate, service, states
from tidewatch.plans.registry import query, shown
from tidewatch.sources import runlog, views
from tidewatch.sources.tables import read_table

# Evaluation ---------------------------------------------------------------------------------

PREDICTED = """(SELECT l_returnflag AS category, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
                 CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS prediction, l_discount + l_tax / 10 AS score FROM lineitem)"""
CELLS = f"""(SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM {PREDICTED})"""
SCORES = f"""(SELECT tn + fp AS n0, fn + tp AS n1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fp + fn) AS f0,
              tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1,
              (tn + tp) / (tn + fp + fn + tp) AS acc FROM {CELLS})"""
AUC = f"""(SELECT sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM (
             SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
             FROM (SELECT score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM {PREDICTED} GROUP BY 1)))"""


def _predicted(spark, folder):
    return read_table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("category"), (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_discount") >= 0.05).cast("int").alias("prediction"), (F.col("l_discount") + F.col("l_tax") / 10).alias("score"),
    )


@query("confusion", f"""
    SELECT 0 AS real, 0 AS predicted, tn AS rows FROM {CELLS} UNION ALL SELECT 0, 1, fp FROM {CELLS}
    UNION ALL SELECT 1, 0, fn FROM {CELLS} UNION ALL SELECT 1, 1, tp FROM {CELLS}""")
def confusion(spark, folder):
    return evaluate.confusion(_predicted(spark, folder), "label", "prediction")


@query("class_report", f"""
    SELECT 'normal' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, n0 AS support FROM {SCORES}
    UNION ALL SELECT 'anomalía', round(p1, 6), round(r1, 6), round(f1, 6), n1 FROM {SCORES}
    UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n0 + n1 FROM {SCORES}
    UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n0 + n1 FROM {SCORES}
    UNION ALL SELECT 'weighted avg', round((p0 * n0 + p1 * n1) / (n0 + n1), 6), round((r0 * n0 + r1 * n1) / (n0 + n1), 6),
                     round((f0 * n0 + f1 * n1) / (n0 + n1), 6), n0 + n1 FROM {SCORES}""")
def class_report(spark, folder):
    return shown(evaluate.class_report(_predicted(spark, folder), "label", "prediction"))


@query("category_recall", f"""
    SELECT category, count(*) AS total, count(*) FILTER (label = prediction) AS detected,
           count(*) FILTER (label <> prediction) AS missed, round(count(*) FILTER (label = prediction) / count(*), 6) AS recall
    FROM {PREDICTED} GROUP BY 1""")
def category_recall(spark, folder):
    return shown(evaluate.category_recall(_predicted(spark, folder), "category", "label", "prediction"))


@query("auc_exact", f"SELECT round(auc, 6) AS auc FROM {AUC}")
def auc_exact(spark, folder):
    return shown(evaluate.roc_auc(_predicted(spark, folder), "score", "label"))


@query("model_health", f"""
    SELECT round((SELECT avg(prediction) FROM {PREDICTED}), 4) AS anomaly_rate, round(p1, 4) AS precision, round(r1, 4) AS recall,
           round(f1, 4) AS f1_score, round((SELECT auc FROM {AUC}), 4) AS auc_roc FROM {SCORES}""")
def model_health(spark, folder):
    return evaluate.model_health(_predicted(spark, folder), "label", "prediction", "score")


@query("run_metrics", f"""
    SELECT 'accuracy' AS metric, round(acc, 6) AS value FROM {SCORES}
    UNION ALL SELECT 'precision_macro', round((p0 + p1) / 2, 6) FROM {SCORES}
    UNION ALL SELECT 'recall_binary', round(r1, 6) FROM {SCORES}
    UNION ALL SELECT 'recall_macro', round((r0 + r1) / 2, 6) FROM {SCORES}
    UNION ALL SELECT 'f1_binary', round(f1, 6) FROM {SCORES}
    UNION ALL SELECT 'f1_macro', round((f0 + f1) / 2, 6) FROM {SCORES}
    UNION ALL SELECT 'f1_weighted', round((f0 * n0 + f1 * n1) / (n0 + n1), 6) FROM {SCORES}
    UNION ALL SELECT 'auc', round(auc, 6) FROM {AUC}""")
def run_metrics(spark, folder):
    return shown(evaluate.run_metrics(_predicted(spark, folder), "label", "prediction", "score"))


# Drift --------------------------------------------------------------------------------------

BINS = 10
_PROBS = "[" + ", ".join(f"{i / BINS}::DOUBLE" for i in range(BINS + 1)) + "]"


def psi_sql(reference: str, production: str, keys: list[str] = ()) -> str:
    """PSI per (feature, keys…) of two long relations (feature, value, keys…)."""
    by = ", ".join(["feature", *keys])
    return f"""
        WITH ref AS ({reference}), prod AS ({production}),
        q AS (SELECT feature, quantile_cont(value, {_PROBS}) AS q FROM ref GROUP BY 1),
        e AS (SELECT feature, list_concat([q[1] - 1e-5::DOUBLE], q[2:10], [q[11] + 1e-5::DOUBLE]) AS e FROM q),
        rb AS (SELECT feature, CASE WHEN value = e[11] THEN 9 WHEN value > e[11] THEN NULL
                      ELSE len(list_filter(e, lambda t: t <= value)) - 1 END AS b FROM ref JOIN e USING (feature)),
        pb AS (SELECT {by}, CASE WHEN value = e[11] THEN 9 WHEN value > e[11] THEN NULL
                      ELSE len(list_filter(e, lambda t: t <= value)) - 1 END AS b FROM prod JOIN e USING (feature)),
        rs AS (SELECT feature, i, count(*) FILTER (b = i) / count(*) AS r FROM rb, range({BINS}) t(i) GROUP BY 1, 2),
        ps AS (SELECT {by}, i, count(*) FILTER (b = i) / count(*) AS p FROM pb, range({BINS}) t(i) GROUP BY {by}, i),
        z AS (SELECT {by}, CASE WHEN r = 0 THEN 1e-4::DOUBLE ELSE r END AS r, CASE WHEN p = 0 THEN 1e-4::DOUBLE ELSE p END AS p
              FROM ps JOIN rs USING (feature, i))
        SELECT {by}, sum((p - r) * ln(p / r)) AS psi FROM z GROUP BY {by}"""


def ks_sql(reference: str, production: str) -> str:
    """KS per feature of two long relations; small samples by a walk over the lattice, step by step."""
    return f"""
        WITH RECURSIVE u AS (SELECT feature, value, 1 AS r, 0 AS p FROM ({reference}) UNION ALL SELECT feature, value, 0, 1 FROM ({production})),
        c AS (SELECT feature, value, sum(r) AS r, sum(p) AS p FROM u GROUP BY 1, 2),
        w AS (SELECT feature, sum(r) OVER (PARTITION BY feature ORDER BY value) / nullif(sum(r) OVER (PARTITION BY feature), 0) AS cr,
                     sum(p) OVER (PARTITION BY feature ORDER BY value) / nullif(sum(p) OVER (PARTITION BY feature), 0) AS cp,
                     sum(r) OVER (PARTITION BY feature) AS n, sum(p) OVER (PARTITION BY feature) AS m FROM c),
        d AS (SELECT feature, n::BIGINT AS n_reference, m::BIGINT AS n_production, max(abs(cr - cp)) AS ks FROM w GROUP BY 1, 2, 3),
        walk AS (
          SELECT feature, 0 AS i, 0 AS j, n_reference AS n, n_production AS m, round(ks * n_reference * n_production)::BIGINT AS h, 1.0::DOUBLE AS p
          FROM d WHERE n_reference * n_production <= {drift.EXACT_PATHS} AND ks > 0
          UNION ALL
          SELECT feature, i2, j2, n, m, h, sum(p2) FROM (
            SELECT feature, i + k AS i2, j + 1 - k AS j2, n, m, h, p * (CASE WHEN k = 1 THEN n - i ELSE m - j END) / (n + m - i - j) AS p2
            FROM walk, (VALUES (0), (1)) t(k) WHERE i + j < n + m)
          WHERE i2 <= n AND j2 <= m AND abs(i2 * m - j2 * n) < h GROUP BY feature, i2, j2, n, m, h
        ),
        stayed AS (SELECT feature, p FROM walk WHERE i = n AND j = m),
        s AS (SELECT *, sqrt(n_reference::DOUBLE * n_production / (n_reference + n_production)) AS root FROM d),
        t AS (SELECT *, CASE WHEN ks <= 0 THEN 0.0::DOUBLE ELSE root * greatest(ks - 1::DOUBLE / lcm(n_reference, n_production), 0) + CASE
                 WHEN greatest(n_reference, n_production) > 2 * least(n_reference, n_production) THEN 1 / (2 * sqrt(greatest(n_reference, n_production)::DOUBLE))
                 WHEN greatest(n_reference, n_production) % least(n_reference, n_production) = 0 THEN 2 / (3 * sqrt(greatest(n_reference, n_production)::DOUBLE))
                 ELSE 2 / (5 * sqrt(greatest(n_reference, n_production)::DOUBLE)) END END AS k FROM s)
        SELECT feature, n_reference, n_production, ks, CASE WHEN ks IS NULL THEN NULL WHEN n_reference * n_production <= {drift.EXACT_PATHS} THEN 1 - coalesce(stayed.p, 0) ELSE least(greatest(CASE
                 WHEN k <= 0 THEN 1.0
                 WHEN k < 1 THEN 1 - sqrt(2 * pi()) / k * list_sum(list_transform(range(1, 101), lambda j: exp(-((2 * j - 1) * (2 * j - 1)) * pi() * pi() / (8 * k * k))))
                 ELSE list_sum(list_transform(range(1, 101), lambda j: CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * k * k))) END, 0.0), 1.0) END AS p_value
        FROM t LEFT JOIN stayed USING (feature)"""


_CELLS = "SELECT label, printf('f%02d', i - 1) AS feature, embedding[i]::DOUBLE AS value FROM embeddings, range(1, 65) t(i)"
EMB_REF, EMB_PROD = f"SELECT * FROM ({_CELLS}) WHERE label < 5", f"SELECT * FROM ({_CELLS}) WHERE label >= 5"


def _embedding_sides(spark, folder):
    cells = views.embedding_cells(spark, folder)
    return tuple(cells.where(side).select("feature", "value") for side in ("label < 5", "label >= 5"))


@query("psi_by_feature", f"SELECT feature, round(psi, 6) AS psi FROM ({psi_sql(EMB_REF, EMB_PROD)})")
def psi_by_feature(spark, folder):
    return shown(drift.psi_long(*_embedding_sides(spark, folder)))


@query("ks_by_feature", f"""
    SELECT feature, n_reference, n_production, round(ks, 6) AS ks, round(p_value, 6) AS p_value FROM ({ks_sql(EMB_REF, EMB_PROD)})""")
def ks_by_feature(spark, folder):
    return shown(drift.ks_long(*_embedding_sides(spark, folder)))


_BALANCES = "SELECT n_name AS feature, {0}_acctbal::DOUBLE AS value FROM {1} JOIN nation ON {0}_nationkey = n_nationkey"


@query("ks_small_samples", f"""
    SELECT feature, n_reference, n_production, round(ks, 6) AS ks, round(p_value, 6) AS p_value
    FROM ({ks_sql(_BALANCES.format("s", "supplier"), _BALANCES.format("c", "customer"))})""")
def ks_small_samples(spark, folder):
    """Balances of suppliers against customers of each nation: a few values on one side, so sizes matter."""
    nations = read_table(spark, folder, "nation")
    side = lambda table, letter: read_table(spark, folder, table).join(F.broadcast(nations), F.col(f"{letter}_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("feature"), F.col(f"{letter}_acctbal").alias("value"))
    return shown(drift.ks_long(side("supplier", "s"), side("customer", "c")))


_LONG_EVENTS = """SELECT week, 'value' AS feature, value::DOUBLE AS value FROM (SELECT *, (dayofmonth(ts) - 1) // 7 AS week FROM events)
                  UNION ALL SELECT (dayofmonth(ts) - 1) // 7, 'user_id', user_id::DOUBLE FROM events"""
_FIRST_WEEK, _LATER_WEEKS = f"SELECT * FROM ({_LONG_EVENTS}) WHERE week = 0", f"SELECT * FROM ({_LONG_EVENTS}) WHERE week > 0"
_STATUS = "CASE WHEN psi < 0.1 THEN 'OK' WHEN psi < 0.25 THEN 'WARNING' ELSE '{}' END AS status"


def _weeks(spark, folder):
    events = views.events(spark, folder).withColumn("week", F.floor((F.dayofmonth("ts") - 1) / 7))
    return events.where("week = 0"), events.where("week > 0")


@query("psi_by_batch", f"""
    SELECT feature, week, round(psi, 6) AS psi, {_STATUS.format('ALERT')} FROM ({psi_sql(_FIRST_WEEK, _LATER_WEEKS, ["week"])})""")
def psi_by_batch(spark, folder):
    return shown(drift.psi_by_batch(*_weeks(spark, folder), ["value", "user_id"], "week"))


@query("weekly_states", """
    WITH x AS (SELECT 'value' AS feature, CASE WHEN event_id % 50 <> 0 THEN value::DOUBLE END AS value FROM events UNION ALL SELECT 'user_id', user_id::DOUBLE FROM events)
    SELECT feature, count(value) AS n, count(*) - count(value) AS missing, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean,
           round(stddev_pop(value), 6) AS std, round(skewness(value), 6) AS skewness, true AS ranks_near, true AS distinct_near FROM x GROUP BY feature""")
def weekly_states(spark, folder):
    """States of each week, stored one week after the other, against the exact figures of all rows."""
    events = views.events(spark, folder).select(
        F.floor((F.dayofmonth("ts") - 1) / 7).alias("week"), F.when(F.col("event_id") % 50 != 0, F.col("value")).alias("value"), "user_id")
    features, path = ["value", "user_id"], fresh_folder(spark, "states")
    for week in range(5):
        states.add_part(states.column_states(events.where(F.col("week") == week), features, "week"), path)
    total = materialize(states.merged(states.read_states(spark, path)))
    cells = long_form(events, features)
    near = states.rank_gaps(total, cells, [0.05, 0.25, 0.5, 0.75, 0.95]).groupBy("feature").agg((F.max("gap") <= 2 * states.RANK_ERROR).alias("ranks_near"))
    exact = cells.where("value IS NOT NULL").groupBy("feature").agg(F.count_distinct("value").alias("_exact"))
    found = states.profile(total).join(near, "feature").join(exact, "feature")
    close = F.abs(F.col("distinct_values") - F.col("_exact")) <= 0.1 * F.col("_exact")
    return shown(found.select("feature", "n", "missing", "low", "high", "mean", "std", "skewness", "ranks_near", close.alias("distinct_near")))


_DOC_SIDE = """SELECT 'n_chars' AS feature, n_chars::DOUBLE AS value FROM documents WHERE {0}
               UNION ALL SELECT 'doc_id', doc_id::DOUBLE FROM documents WHERE {0}"""
_EN, _NOT_EN = _DOC_SIDE.format("lang = 'en'"), _DOC_SIDE.format("lang <> 'en'")


@query("drift_status", f"""
    SELECT feature, round(psi, 4) AS psi, round(p_value, 4) AS ks_p_value, {_STATUS.format('ALERT (DRIFT DETECTED)')}
    FROM ({psi_sql(_EN, _NOT_EN)}) JOIN ({ks_sql(_EN, _NOT_EN)}) USING (feature)""")
def drift_status(spark, folder):
    documents = read_table(spark, folder, "documents")
    english = F.col("lang") == "en"
    return drift.drift_table(documents.where(english), documents.where(~english), ["n_chars", "doc_id", "absent"])


_PRICES = "SELECT o_orderpriority AS priority, 'price' AS feature, l_extendedprice::DOUBLE * (CASE WHEN o_orderpriority = '1-URGENT' THEN 3 ELSE 1 END) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


@query("retrain_decision", f"""
    WITH psi AS ({psi_sql(f"SELECT * FROM ({_PRICES}) WHERE priority = '5-LOW'", f"SELECT * FROM ({_PRICES}) WHERE priority <> '5-LOW'", ["priority"])}),
         perf AS (SELECT o_orderpriority AS priority, count(*) FILTER (l_discount < CASE WHEN o_orderpriority = '2-HIGH' THEN 0.02 ELSE 0.095 END) / count(*) AS performance
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
         j AS (SELECT priority, psi, CASE WHEN priority = '1-URGENT' THEN performance / 2 ELSE performance END AS performance FROM psi JOIN perf USING (priority))
    SELECT priority, round(psi, 6) AS psi, round(performance, 6) AS performance, psi > 0.25 AND performance < 0.80 AS should_retrain,
           CASE WHEN psi > 0.25 AND performance < 0.80 THEN printf('retrain: drift (psi %.4f) and degraded performance (%.4f)', psi, performance)
                WHEN psi > 0.25 THEN printf('watch: drift (psi %.4f) but performance holds (%.4f)', psi, performance)
                WHEN performance < 0.80 THEN printf('investigate: no drift (psi %.4f) but degraded performance (%.4f)', psi, performance)
                ELSE 'keep: no drift and no degradation' END AS reason
    FROM j""")
def retrain_decision(spark, folder):
    items, orders = read_table(spark, folder, "lineitem"), read_table(spark, folder, "orders")
    rows = materialize(items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderpriority").alias("priority"), "l_discount", "l_extendedprice"
    ))
    shifted = F.col("l_extendedprice") * F.when(F.col("priority") == "1-URGENT", 3).otherwise(1)
    priced = rows.withColumn("price", shifted)
    low = F.col("priority") == "5-LOW"
    psi = drift.psi_by_batch(priced.where(low), priced.where(~low), ["price"], "priority").select("priority", "psi")
    hit = F.col("l_discount") < F.when(F.col("priority") == "2-HIGH", 0.02).otherwise(0.095)
    performance = rows.groupBy("priority").agg(F.avg(hit.cast("int")).alias("_p")).select(
        "priority", F.when(F.col("priority") == "1-URGENT", F.col("_p") / 2).otherwise(F.col("_p")).alias("performance")
    )
    return shown(drift.retraining_decision(psi.join(performance, "priority")))


# Batch validation ---------------------------------------------------------------------------

EXPECTED_FIELDS = {"amount": "numeric", "user": "numeric", "kind": "categorical", "region": "numeric"}
KINDS, AMOUNTS = ["view", "click", "purchase"], (0, 250)
_BATCHES = """(SELECT event_id, event_type AS batch, CASE WHEN user_id = 3 THEN NULL ELSE value::VARCHAR END AS amount,
               CASE WHEN user_id = 7 THEN 'siete' ELSE user_id::VARCHAR END AS user, event_type AS kind, 'x' AS extra FROM events)"""
_INCIDENTS = f"""
    SELECT batch, 'SCHEMA_ERROR' AS type, 'HIGH' AS severity, NULL AS "column", NULL AS row_id, NULL AS value, 'Columnas faltantes: [''region'']' AS detail FROM {_BATCHES} GROUP BY batch
    UNION ALL SELECT batch, 'SCHEMA_MODIFICATION', 'MEDIUM', NULL, NULL, NULL, 'Columnas inesperadas: [''extra'']' FROM {_BATCHES} GROUP BY batch
    UNION ALL SELECT batch, 'DUPLICATED_ROWS', 'LOW', NULL, NULL, sum(c - 1)::BIGINT::VARCHAR, printf('Se encontraron %d filas duplicadas', sum(c - 1)::BIGINT)
              FROM (SELECT batch, count(*) AS c FROM {_BATCHES} GROUP BY batch, amount, "user", kind, extra) GROUP BY batch HAVING sum(c - 1) > 0
    UNION ALL SELECT batch, 'MISSING_VALUES', 'MEDIUM', 'amount', NULL, count(*)::VARCHAR, printf('Columna ''amount'' tiene %d valores nulos', count(*))
              FROM {_BATCHES} WHERE amount IS NULL GROUP BY batch
    UNION ALL SELECT batch, 'EXTREME_OUTLIER', 'HIGH', 'amount', event_id::VARCHAR, amount, printf('Fila %d, ''amount'' con valor fuera de rango: %s', event_id, amount)
              FROM {_BATCHES} WHERE TRY_CAST(amount AS DOUBLE) < 0 OR TRY_CAST(amount AS DOUBLE) > 250
    UNION ALL SELECT batch, 'EXTREME_OUTLIER', 'HIGH', 'user', event_id::VARCHAR, "user", printf('Fila %d, ''user'' con valor fuera de rango: %s', event_id, "user")
              FROM {_BATCHES} WHERE TRY_CAST("user" AS DOUBLE) < 0 OR TRY_CAST("user" AS DOUBLE) > 250
    UNION ALL SELECT batch, 'INCORRECT_DATATYPE', 'HIGH', 'user', event_id::VARCHAR, "user", printf('Fila %d, ''user'' esperaba tipo numérico pero recibió: %s', event_id, "user")
              FROM {_BATCHES} WHERE TRY_CAST("user" AS DOUBLE) IS NULL
    UNION ALL SELECT batch, 'UNKNOWN_CATEGORY', 'HIGH', 'kind', event_id::VARCHAR, kind, printf('Fila %d, ''kind'' contiene categoría no registrada: %s', event_id, kind)
              FROM {_BATCHES} WHERE kind NOT IN ('view', 'click', 'purchase')"""


def event_batches(events):
    return events.select(
        "event_id", F.col("event_type").alias("batch"),
        F.when(F.col("user_id") != 3, F.col("value").cast("string")).alias("amount"),
        F.when(F.col("user_id") == 7, F.lit("siete")).otherwise(F.col("user_id").cast("string")).alias("user"),
        F.col("event_type").alias("kind"), F.lit("x").alias("extra"),
    )


@query("batch_incidents", _INCIDENTS)
def batch_incidents(spark, folder):
    rows = event_batches(read_table(spark, folder, "events"))
    return batches.batch_incidents(rows, EXPECTED_FIELDS, "event_id", "batch", KINDS, AMOUNTS)


_VERDICT = """
    SELECT batch, CASE WHEN bool_or(severity = 'HIGH') THEN 'FAILED' ELSE 'PASSED_WITH_WARNINGS' END AS status,
           CASE WHEN bool_or(severity = 'HIGH') THEN 'BLOCKED_BATCH' ELSE 'WARNED_BATCH' END AS action, count(severity)::BIGINT AS total_incidents
    FROM (SELECT DISTINCT batch FROM {0}) LEFT JOIN ({1}) USING (batch) GROUP BY batch"""
#: The same feed without the column whose absence blocks every batch, and with users in words left out: some batches pass.
FEED_FIELDS = {"amount": "numeric", "kind": "categorical", "extra": "categorical"}
_FEED = "(SELECT event_id, batch, amount, kind, 'view' AS extra FROM {0} WHERE amount IS NULL OR amount::DOUBLE <= 250)".format(_BATCHES)
_FEED_INCIDENTS = f"""
    SELECT batch, 'LOW' AS severity FROM (SELECT batch, count(*) AS c FROM {_FEED} GROUP BY batch, amount, kind, extra) GROUP BY batch HAVING sum(c - 1) > 0
    UNION ALL SELECT batch, 'MEDIUM' FROM {_FEED} WHERE amount IS NULL GROUP BY batch
    UNION ALL SELECT batch, 'HIGH' FROM {_FEED} WHERE TRY_CAST(amount AS DOUBLE) < 0
    UNION ALL SELECT batch, 'HIGH' FROM {_FEED} WHERE kind NOT IN ('view', 'click', 'purchase')"""


def event_feed(events):
    rows = event_batches(events).where("amount IS NULL OR CAST(amount AS DOUBLE) <= 250")
    return rows.select("event_id", "batch", "amount", "kind", F.lit("view").alias("extra"))


@query("batch_verdict", _VERDICT.format(_BATCHES, _INCIDENTS))
def batch_verdict(spark, folder):
    rows = event_batches(read_table(spark, folder, "events"))
    return batches.counted_verdict(rows, EXPECTED_FIELDS, "event_id", "batch", KINDS, AMOUNTS)


@query("batch_route", f"""
    SELECT event_id, batch, amount, kind, extra, status <> 'FAILED' AS accepted FROM {_FEED} JOIN ({_VERDICT.format(_FEED, _FEED_INCIDENTS)}) USING (batch)""")
def batch_route(spark, folder):
    """All columns of the rows, accepted or in quarantine by the verdict on all of them."""
    rows = event_feed(read_table(spark, folder, "events"))
    verdict = batches.counted_verdict(rows, FEED_FIELDS, "event_id", "batch", KINDS, AMOUNTS)
    accepted, quarantine = batches.route(rows, verdict, "batch")
    return accepted.withColumn("accepted", F.lit(True)).unionByName(quarantine.withColumn("accepted", F.lit(False)))


@query("append_rows", """
    SELECT doc_id AS id, lang AS word FROM documents UNION ALL SELECT event_id, event_type FROM events""")
def append_rows(spark, folder):
    documents = read_table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("word"))
    events = read_table(spark, folder, "events").select(F.col("event_type").alias("word"), F.col("event_id").alias("id"))
    return documents.unionByName(events)


# Service figures ----------------------------------------------------------------------------

HOURLY_SQL = """
    WITH h AS (SELECT date_trunc('hour', ts) AS w, count(*) AS request_count, count(*) FILTER (event_type = 'error') AS error_count FROM events GROUP BY 1)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, request_count, error_count, 3600.0::DOUBLE AS elapsed,
           round(3600.0::DOUBLE / request_count * 1000, 2) AS latency_ms_per_req, round(request_count / 3600.0::DOUBLE, 2) AS throughput_req_per_sec,
           round(error_count / request_count, 4) AS error_rate, round(1 - error_count / request_count, 4) AS availability
    FROM h"""


def as_text(df, *columns):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


@query("service_metrics_hourly", HOURLY_SQL)
def service_metrics_hourly(spark, folder):
    counts = service.window_counts(views.events(spark, folder), "ts", F.col("event_type") == "error")
    return as_text(service.service_metrics(counts), "window_start")


# Behaviour windows --------------------------------------------------------------------------


def _range_sql(span: str) -> str:
    frame = f"ORDER BY ts RANGE BETWEEN INTERVAL {span} PRECEDING AND CURRENT ROW"
    return f"""
        WITH w AS (SELECT event_id, count(*) OVER (PARTITION BY user_id {frame}) AS n, count(*) OVER (PARTITION BY event_type {frame}) AS m,
                          count(*) OVER (PARTITION BY user_id, event_type {frame}) AS s,
                          sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id {frame}) AS hs,
                          sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type {frame}) AS ss,
                          sum(CASE WHEN value < 5 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id {frame}) AS hr,
                          sum(CASE WHEN value < 5 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type {frame}) AS sr FROM events)
        SELECT event_id, n AS count, m AS srv_count, round(hs / n, 6) AS serror_rate, round(ss / m, 6) AS srv_serror_rate,
               round(hr / n, 6) AS rerror_rate, round(sr / m, 6) AS srv_rerror_rate, round(s / n, 6) AS same_srv_rate,
               round(1 - s / n, 6) AS diff_srv_rate, round(1 - s / m, 6) AS srv_diff_host_rate FROM w"""


def _range_features(spark, folder, seconds):
    events = views.events(spark, folder)
    added = behaviour.two_second_features(
        events, "user_id", "event_type", "ts", F.col("value") > 50, F.col("value") < 5, seconds=seconds
    )
    return shown(added.drop("ts", "user_id", "event_type", "value", "props"))


@query("window_2s_counts", _range_sql("2 SECONDS"))
def window_2s_counts(spark, folder):
    return _range_features(spark, folder, 2)


@query("window_1h_counts", _range_sql("3600 SECONDS"))
def window_1h_counts(spark, folder):
    return _range_features(spark, folder, 3600)


_LAST = "ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW"
_RECENT = "ORDER BY k RANGE BETWEEN 99 PRECEDING AND CURRENT ROW"


LAST_SQL = f"""
    WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, CASE WHEN value > 50 THEN 1 ELSE 0 END AS e,
                      CASE WHEN value < 5 THEN 1 ELSE 0 END AS r, event_id % 7 AS port, event_id % 4 AS source FROM events),
         w AS (SELECT event_id, count(*) OVER (PARTITION BY user_id {_LAST}) AS n, count(*) OVER (PARTITION BY user_id, event_type {_RECENT}) AS m,
                      sum(e) OVER (PARTITION BY user_id {_LAST}) AS hs, sum(e) OVER (PARTITION BY user_id, event_type {_RECENT}) AS ss,
                      sum(r) OVER (PARTITION BY user_id {_LAST}) AS hr, sum(r) OVER (PARTITION BY user_id, event_type {_RECENT}) AS sr,
                      count(*) OVER (PARTITION BY user_id, port {_RECENT}) AS sp, count(*) OVER (PARTITION BY user_id, event_type, source {_RECENT}) AS so FROM k)
    SELECT event_id, n AS dst_host_count, m AS dst_host_srv_count, round(m / n, 6) AS dst_host_same_srv_rate, round(1 - m / n, 6) AS dst_host_diff_srv_rate,
           round(hs / n, 6) AS dst_host_serror_rate, round(ss / m, 6) AS dst_host_srv_serror_rate,
           round(hr / n, 6) AS dst_host_rerror_rate, round(sr / m, 6) AS dst_host_srv_rerror_rate,
           round(sp / n, 6) AS dst_host_same_src_port_rate, round(1 - so / m, 6) AS dst_host_srv_diff_host_rate FROM w"""


@query("window_100_rates", LAST_SQL)
def window_100_rates(spark, folder):
    added = behaviour.hundred_connection_features(
        views.events(spark, folder).withColumns({"port": F.col("event_id") % 7, "source": F.col("event_id") % 4}),
        "user_id", "event_type", "ts", "event_id", F.col("value") > 50, F.col("value") < 5, "port", "source",
    )
    return shown(added.drop("ts", "user_id", "event_type", "value", "props", "port", "source"))


# Run log ------------------------------------------------------------------------------------


@query("table_fingerprint", """
    SELECT count(*) AS rows, sum(('0x' || substr(md5(concat_ws(chr(31), doc_id::VARCHAR, text, lang, source, n_chars::VARCHAR)), 1, 15))::UBIGINT::HUGEINT)::VARCHAR AS checksum
    FROM documents""")
def table_fingerprint(spark, folder):
    documents = read_table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return runlog.table_fingerprint(documents, portable=True)


_RUNS = """(SELECT event_type AS run_name, md5(concat(event_type, '|', count(*))) AS fingerprint, count(*) AS rows, min(value) AS lowest,
            CASE WHEN min(event_id) % 2 = 0 THEN 'FINISHED' ELSE 'FAILED' END AS status FROM events GROUP BY 1)"""


@query("run_log_append", f"""
    SELECT run_name, fingerprint, rows, lowest, status FROM {_RUNS}
    UNION ALL SELECT run_name, fingerprint, rows, lowest, 'FINISHED' FROM {_RUNS}
    WHERE fingerprint NOT IN (SELECT fingerprint FROM {_RUNS} WHERE status = 'FINISHED')""")
def run_log_append(spark, folder):
    log = read_table(spark, folder, "events").groupBy(F.col("event_type").alias("run_name")).agg(
        F.count("*").alias("rows"), F.min("value").alias("lowest"),
        F.when(F.min("event_id") % 2 == 0, "FINISHED").otherwise("FAILED").alias("status"),
    ).select("run_name", F.md5(F.concat("run_name", F.lit("|"), F.col("rows").cast("string"))).alias("fingerprint"), "rows", "lowest", "status")
    again = log.withColumn("status", F.lit(runlog.FINISHED))
    return log.unionByName(runlog.new_runs(log, again))
