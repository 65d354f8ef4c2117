"""Rules, baselines, the forest and the quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions import scalars
from ledgerlens.operators import cleanse, forest, model, quality, rules
from ledgerlens.plans.queries.base import AMOUNT, GEO, VELOCITY, alerts, facts, geo, gold, high_amount, query, velocity
from ledgerlens.sources import scans
from ledgerlens.sources.tables import AS_OF, dirty_transactions, table, transactions

SEVERITY_SQL = "round(CAST(CAST(least(raw_severity, 1.0) AS FLOAT) AS DOUBLE), 4) AS severity_score"


def shown_alerts(df, description: bool = True):
    cols = ["transaction_id", "reason_code", F.round(F.col("severity_score").cast("double"), 4).alias("severity_score")]
    return df.select(*cols, *(["description"] if description else []))


@query("detect_velocity_attack", f"SELECT transaction_id, reason_code, {SEVERITY_SQL}, description FROM {{velocity}}")
def detect_velocity_attack(spark, sf):
    return shown_alerts(velocity(transactions(spark, sf)))


@query("detect_high_amount", f"SELECT transaction_id, reason_code, {SEVERITY_SQL}, description FROM {{high_amount}}")
def detect_high_amount(spark, sf):
    return shown_alerts(high_amount(transactions(spark, sf)))


@query("detect_geo_impossible", f"SELECT transaction_id, reason_code, {SEVERITY_SQL} FROM {{geo}}")
def detect_geo_impossible(spark, sf):
    return shown_alerts(geo(transactions(spark, sf)), description=False)


@query("haversine", """
SELECT transaction_id, round(km, 3) AS distance_km, round(hours, 6) AS hours FROM {speeds}""")
def haversine(spark, sf):
    return rules.hops(transactions(spark, sf)).select(
        "transaction_id", F.round("hop.km", 3).alias("distance_km"), F.round("hop.hours", 6).alias("hours"))


@query("user_baseline", "SELECT user_id, avg6 / 1000000.0::DOUBLE AS avg_amount, round(stddev_amount, 4) AS stddev_amount, n FROM {baseline}")
def user_baseline(spark, sf):
    base = rules.user_baseline(transactions(spark, sf), as_of=AS_OF)
    return base.withColumn("stddev_amount", F.round("stddev_amount", 4))


@query("join_user_baseline", """
SELECT transaction_id, user_id, CAST(amount AS DOUBLE) AS amount, avg6 / 1000000.0::DOUBLE AS avg_amount FROM {t} JOIN {baseline} USING (user_id)""")
def join_user_baseline(spark, sf):
    t = transactions(spark, sf)
    joined = rules.join_user_baseline(t.select("transaction_id", "user_id", "amount"), rules.user_baseline(t, as_of=AS_OF))
    return joined.select("transaction_id", "user_id", "amount", "avg_amount")


@query("alert_envelope", """
SELECT md5(transaction_id || '|' || reason_code || '|' || alert_date) AS alert_id, transaction_id, reason_code, status,
  CAST(severity_score AS DOUBLE) AS rule_score, CAST(alert_date AS VARCHAR) AS alert_date FROM {alerts}""")
def alert_envelope(spark, sf):
    return alerts(transactions(spark, sf)).select("alert_id", "transaction_id", "reason_code", "status", "rule_score", "alert_date")


@query("alert_counts", """
SELECT reason_code, count(*) AS alerts FROM {alerts} GROUP BY 1 UNION ALL SELECT 'TOTAL', count(*) FROM {alerts}""")
def alert_counts(spark, sf):
    return rules.alert_counts(alerts(transactions(spark, sf)))


@query("rule_precision", """
SELECT * FROM (WITH j AS (SELECT a.reason_code, a.transaction_id, t.is_fraud FROM (
    SELECT DISTINCT transaction_id, reason_code FROM {alerts} UNION ALL SELECT DISTINCT transaction_id, 'ANY' FROM {alerts}) a
  JOIN {t} t USING (transaction_id)), total AS (SELECT count(*) FILTER (WHERE is_fraud) AS n FROM {t})
SELECT reason_code, count(*) AS alerted, count(*) FILTER (WHERE is_fraud) AS true_positives,
  round(CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) * 100.0::DOUBLE / count(*), 4) AS precision_pct,
  round(CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) * 100.0::DOUBLE / (SELECT n FROM total), 4) AS recall_pct FROM j GROUP BY 1)""")
def rule_precision(spark, sf):
    t = transactions(spark, sf)
    return rules.rule_precision(alerts(t), t.select("transaction_id", "is_fraud"))


# ---------------------------------------------------------------- forest

@query("fit_scaler", """
SELECT feature, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std, count(*) AS rows FROM (
  SELECT unnest(['amount', 'latitude', 'longitude']) AS feature, unnest([CAST(amount AS DOUBLE), CAST(latitude AS DOUBLE), CAST(longitude AS DOUBLE)]) AS v
  FROM {dirty} WHERE latitude IS NOT NULL) GROUP BY 1""")
def fit_scaler(spark, sf):
    out = forest.fit_scaler(dirty_transactions(spark, sf))
    return out.select("feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "rows")


@query("train_isolation_forest", "SELECT tree, node, feature, round(threshold, 9) AS threshold, round(path, 9) AS path, sample_size FROM {trees_t}")
def train_isolation_forest(spark, sf):
    nodes = forest.train_isolation_forest(scans.scan_features(transactions(spark, sf)))
    return nodes.withColumns({c: F.round(c, 9) for c in ("threshold", "path")})


@query("score_isolation_forest", "SELECT transaction_id, ml_score FROM {scored_dirty}")
def score_isolation_forest(spark, sf):
    rows = scans.scan_features(dirty_transactions(spark, sf))
    return forest.score_isolation_forest(rows, forest.train_isolation_forest(rows)).select("transaction_id", "ml_score")


@query("ml_alerts", """
SELECT transaction_id, 'ML_ANOMALY' AS reason_code, score AS severity_score, 'Isolation Forest score: ' || printf('%.4f', score) AS description
FROM (SELECT transaction_id, least(CAST(amount AS DOUBLE) / 100.0::DOUBLE, 1.0) AS score FROM {t})
WHERE score > 0.7 AND transaction_id NOT IN (SELECT transaction_id FROM {geo})""")
def ml_alerts(spark, sf):
    t = transactions(spark, sf)
    score = F.least(F.col("amount").cast("double") / F.lit(100.0), F.lit(1.0))
    return forest.ml_alerts(t.select("transaction_id", score.alias("ml_score")), geo(t))


# ---------------------------------------------------------------- quality

def checks_sql(source: str, checks: dict[str, str]) -> str:
    """A result row per check; each value is the SQL condition of a failing row."""
    counts = ", ".join(f"count(*) FILTER (WHERE {cond}) AS c{i}" for i, cond in enumerate(checks.values()))
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", n AS evaluated, c{i} AS failed, c{i} = 0 AS success FROM r" for i, name in enumerate(checks))
    return f"SELECT * FROM (WITH r AS (SELECT count(*) AS n, {counts} FROM {source}) {rows})"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _silver_shape(df):
    return cleanse.stamp_processed(cleanse.hash_pii(df), AS_OF)


FILLED_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, TRUE AS present, count({expr}) AS filled FROM {{dirty}}" for c, expr in
    {**{c: c for c in S.SILVER_REQUIRED_COLUMNS}, "timestamp": "event_ts", "ip_address_hash": "ip_address", "_silver_processed_at": "*"}.items())


@query("expect_columns", FILLED_SQL + " UNION ALL SELECT 'source_file', FALSE, NULL")
def expect_columns(spark, sf):
    """Which columns exist, and in how many rows those that do are filled."""
    df = _silver_shape(dirty_transactions(spark, sf))
    wanted = [*S.SILVER_REQUIRED_COLUMNS, "source_file"]
    cells = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("filled")) for c in wanted if c in df.columns]
    filled = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return quality.expect_columns(df, wanted).join(filled, "column_name", "left")


@query("forbid_column", "SELECT count(*) AS rows, count(DISTINCT sha256(ip_address)) AS hashes FROM {t}")
def forbid_column(spark, sf):
    clean = quality.forbid_column(cleanse.hash_pii(transactions(spark, sf)))
    return clean.agg(F.count("*").alias("rows"), F.count_distinct("ip_address_hash").alias("hashes"))


@query("expect_not_null", checks_sql("{dirty}", {f"not_null({c})": f"{c} IS NULL" for c in ("transaction_id", "user_id", "merchant_id", "amount", "latitude")}))
def expect_not_null(spark, sf):
    return quality.run_checks(dirty_transactions(spark, sf), [quality.expect_not_null(c) for c in
                                                              ("transaction_id", "user_id", "merchant_id", "amount", "latitude")])


def _unique_sql(source: str, key: str) -> str:
    return (f"SELECT 'unique({key})' AS \"check\", CAST(sum(n) AS BIGINT) AS evaluated, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS failed, "
            f"coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 AS success FROM (SELECT {key}, count(*) AS n FROM {source} WHERE {key} IS NOT NULL GROUP BY 1)")


@query("expect_unique", f"{_unique_sql('{dirty}', 'transaction_id')} UNION ALL {_unique_sql('{dirty}', 'user_id')}")
def expect_unique(spark, sf):
    return quality.run_checks(dirty_transactions(spark, sf), [quality.expect_unique("transaction_id"), quality.expect_unique("user_id")])


@query("expect_between", checks_sql("{dirty}", {
    "between(amount)": "amount NOT BETWEEN 0.01 AND 1000000", "between(latitude)": "latitude NOT BETWEEN -90 AND 90",
    "between(longitude)": "longitude NOT BETWEEN -180 AND 180"}))
def expect_between(spark, sf):
    return quality.run_checks(dirty_transactions(spark, sf), [
        quality.expect_between("amount", "0.01", "1000000"), quality.expect_between("latitude", -90, 90),
        quality.expect_between("longitude", -180, 180)])


@query("expect_in_set", checks_sql("{dirty}", {
    f"in_set({c})": f"{c} NOT IN ({quoted(v)})" for c, v in (("currency", S.CURRENCIES), ("transaction_type", S.TRANSACTION_TYPES),
                                                            ("status", S.STATUSES), ("payment_method", S.PAYMENT_METHODS))}))
def expect_in_set(spark, sf):
    return quality.run_checks(dirty_transactions(spark, sf), [
        quality.expect_in_set("currency", S.CURRENCIES), quality.expect_in_set("transaction_type", S.TRANSACTION_TYPES),
        quality.expect_in_set("status", S.STATUSES), quality.expect_in_set("payment_method", S.PAYMENT_METHODS)])


@query("expect_length", checks_sql("{dirty}", {"length(ip_address_hash)": "length(sha256(ip_address)) <> 64", "length(device_id)": "length(device_id) <> 12"}))
def expect_length(spark, sf):
    return quality.run_checks(cleanse.hash_pii(dirty_transactions(spark, sf)),
                              [quality.expect_length("ip_address_hash", 64), quality.expect_length("device_id", 12)])


@query("expect_expression", checks_sql("{dirty}", {"expression(amount > 0)": "NOT amount > 0", "expression(latitude < longitude)": "NOT latitude < longitude"}))
def expect_expression(spark, sf):
    return quality.run_checks(dirty_transactions(spark, sf), [
        quality.expect_expression("amount > 0", F.col("amount") > 0),
        quality.expect_expression("latitude < longitude", F.col("latitude") < F.col("longitude"))])


@query("assert_empty", """
SELECT 'fraud_score_range' AS test, count(*) AS failing FROM {fact} WHERE fraud_score < 0 OR fraud_score > 1
UNION ALL SELECT 'positive_revenue', count(*) FROM {dirty} WHERE amount <= 0""")
def assert_empty(spark, sf):
    scored = quality.fraud_score_out_of_range(gold(spark, sf)["fact"])
    quality.assert_empty(scored, "fraud_score_range")
    negative = quality.non_positive_amounts(dirty_transactions(spark, sf))
    return scored.agg(F.lit("fraud_score_range").alias("test"), F.count("*").alias("failing")).unionAll(
        negative.agg(F.lit("positive_revenue").alias("test"), F.count("*").alias("failing")))


@query("expect_values_present", """
SELECT unnest(['VELOCITY_ATTACK', 'HIGH_AMOUNT', 'GEO_IMPOSSIBLE', 'ML_ANOMALY']) AS reason_code
EXCEPT SELECT reason_code FROM {alerts}""")
def expect_values_present(spark, sf):
    expected = spark.createDataFrame([(r,) for r in S.REASON_CODES], "reason_code string")
    return quality.missing_values(gold(spark, sf)["alerts"], "reason_code", expected)


@query("expect_min_rows", """
SELECT 'min_rows(3000)' AS "check", n AS evaluated, greatest(3000 - n, 0) AS failed, n >= 3000 AS success FROM (
  SELECT date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) + 1 AS n FROM orders)
UNION ALL SELECT 'min_rows(1)', count(*), greatest(1 - count(*), 0), count(*) >= 1 FROM {fact0}""")
def expect_min_rows(spark, sf):
    days = quality.run_checks(model.calendar_of(table(spark, sf, "orders"), "o_orderdate"), [quality.expect_min_rows(3000)])
    return days.unionAll(quality.run_checks(gold(spark, sf)["fact"], [quality.expect_min_rows(1)]))


@query("expect_foreign_key", """
SELECT 'foreign_key(user_id)' AS "check", count(*) AS failed, count(DISTINCT user_id) AS failed_keys FROM {t}
  WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'foreign_key(l_partkey)', count(*), count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def expect_foreign_key(spark, sf):
    customers = table(spark, sf, "customer").where("c_acctbal >= 0")
    parts = table(spark, sf, "part").where("p_size > 10")
    return quality.expect_foreign_key(transactions(spark, sf), customers, "user_id", "c_custkey").unionAll(
        quality.expect_foreign_key(table(spark, sf, "lineitem"), parts, "l_partkey", "p_partkey"))


@query("check_staging", """
SELECT * FROM (WITH r AS (SELECT count(*) AS n, count(*) FILTER (WHERE transaction_id IS NULL) AS a, count(*) FILTER (WHERE user_id IS NULL) AS b,
  count(*) FILTER (WHERE merchant_id IS NULL) AS c, count(*) FILTER (WHERE amount IS NULL) AS d, count(*) FILTER (WHERE amount <= 0) AS e FROM {dirty}),
u AS (SELECT count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS n, max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS f FROM {dirty}),
m AS (SELECT count(*) AS n FROM (SELECT DISTINCT merchant_id, mcc_code, country_code FROM {dirty}))
SELECT 'transactions' AS table_name, 'not_null(transaction_id)' AS "check", n AS evaluated, a AS failed, a = 0 AS success FROM r
UNION ALL SELECT 'transactions', 'not_null(user_id)', n, b, b = 0 FROM r UNION ALL SELECT 'transactions', 'not_null(merchant_id)', n, c, c = 0 FROM r
UNION ALL SELECT 'transactions', 'not_null(amount)', n, d, d = 0 FROM r UNION ALL SELECT 'transactions', 'expression(amount > 0)', n, e, e = 0 FROM r
UNION ALL SELECT 'users', 'not_null(user_id)', n, CAST(f AS BIGINT), f = 0 FROM u UNION ALL SELECT 'merchants', 'not_null(merchant_id)', n, 0, TRUE FROM m)""")
def check_staging(spark, sf):
    rows = dirty_transactions(spark, sf)
    return quality.check_staging(model.stage_fact(rows), model.stage_users(rows), model.stage_merchants(rows))


@query("duplicate_keys", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "orders"), "o_custkey")


@query("run_suite", "SELECT * FROM (" + checks_sql("{dirty}", {
    **{f"not_null({c})": f"{c} IS NULL" for c in ("transaction_id", "user_id", "merchant_id", "amount")},
    "not_null(timestamp)": "event_ts IS NULL", "not_null(_silver_processed_at)": "FALSE",
    "between(amount)": "amount NOT BETWEEN 0.01 AND 1000000", "in_set(currency)": f"currency NOT IN ({quoted(S.CURRENCIES)})",
    "in_set(transaction_type)": "FALSE", "in_set(status)": "FALSE", "in_set(payment_method)": "FALSE",
    "between(latitude)": "latitude NOT BETWEEN -90 AND 90", "between(longitude)": "longitude NOT BETWEEN -180 AND 180",
    "length(ip_address_hash)": "FALSE"}) + f") UNION ALL {_unique_sql('{dirty}', 'transaction_id')}")
def run_suite(spark, sf):
    rows = quality.run_suite(_silver_shape(dirty_transactions(spark, sf)), quality.silver_suite(), label="silver",
                             required=S.SILVER_REQUIRED_COLUMNS, forbidden=("ip_address",), raise_on_failure=False)["results"]
    return spark.createDataFrame([(r["check"], r["evaluated"], r["failed"], r["success"]) for r in rows],
                                 "check string, evaluated bigint, failed bigint, success boolean")
