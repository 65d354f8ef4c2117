"""Staging, dimensions, facts, history, upsert and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions import scalars
from ledgerlens.operators import forest, kpis, model, quality, rules
from ledgerlens.plans.queries.base import (alerts, dims, event_calendar, facts, gold, query, staged_facts)
from ledgerlens.sources import tables
from ledgerlens.sources.tables import AS_OF, dirty_transactions, table, transactions

NEWEST_USER = """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, transaction_id DESC) AS r FROM {t}) WHERE r = 1"""


# ---------------------------------------------------------------- staging

@query("stage_fact", """
SELECT transaction_id, user_id, merchant_id, time_sk, CAST(amount AS DOUBLE) AS amount, currency, transaction_type, status, payment_method,
  FALSE AS is_flagged_fraud, 0.0::DOUBLE AS fraud_score, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, country_code
FROM {t}""")
def stage_fact(spark, sf):
    return model.stage_fact(transactions(spark, sf))


@query("stage_users", f"SELECT user_id, country_code, NULL::VARCHAR AS email_hash, NULL::VARCHAR AS risk_tier FROM ({NEWEST_USER})")
def stage_users(spark, sf):
    return model.stage_users(transactions(spark, sf))


@query("stage_merchants", "SELECT DISTINCT merchant_id, mcc_code, country_code FROM {t}")
def stage_merchants(spark, sf):
    return model.stage_merchants(transactions(spark, sf))


@query("stg_transactions", """
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, FALSE AS is_flagged_fraud, 0.0::DOUBLE AS fraud_score, event_ts AS loaded_at FROM {t}""")
def stg_transactions(spark, sf):
    new = staged_facts(transactions(spark, sf)).withColumn("fraud_score", F.lit(None).cast(S.SCORE))
    old = new.withColumns({"loaded_at": F.expr("loaded_at - INTERVAL 1 DAY"), "amount": (F.col("amount") + 1).cast(S.AMOUNT)})
    return model.stg_transactions(new.unionByName(old)).select("transaction_id", "amount", "is_flagged_fraud", "fraud_score", "loaded_at")


@query("stg_users", f"SELECT user_id, country_code, '' AS email_hash, 'low' AS risk_tier FROM ({NEWEST_USER})")
def stg_users(spark, sf):
    staged = model.stage_users(transactions(spark, sf), AS_OF)
    return model.stg_users(staged).drop("loaded_at")


@query("stg_merchants", """
SELECT merchant_id, 'Unknown' AS merchant_name, min(mcc_code) AS mcc_code, min(country_code) AS country_code FROM {t} GROUP BY 1""")
def stg_merchants(spark, sf):
    return model.stg_merchants(model.stage_merchants(transactions(spark, sf), AS_OF)).drop("loaded_at")


# ---------------------------------------------------------------- keys and joins

@query("fact_user_key", """
SELECT transaction_id, user_id, CASE WHEN user_id IN (SELECT c_custkey FROM customer) THEN md5(CAST(user_id AS VARCHAR)) END AS user_sk FROM {dirty}""")
def fact_user_key(spark, sf):
    users, _ = dims(spark, sf)
    return model.fact_user_key(dirty_transactions(spark, sf).select("transaction_id", "user_id"), users)


@query("fact_merchant_key", """
SELECT transaction_id, merchant_id, CASE WHEN merchant_id IN (SELECT p_partkey FROM part) THEN md5(CAST(merchant_id AS VARCHAR)) END AS merchant_sk FROM {t}""")
def fact_merchant_key(spark, sf):
    _, merchants = dims(spark, sf)
    return model.fact_merchant_key(transactions(spark, sf).select("transaction_id", "merchant_id"), merchants)


@query("fact_calendar", """
SELECT transaction_id, time_sk, CAST(partition_date AS VARCHAR) AS date, isodow(partition_date) IN (6, 7) AS is_weekend FROM {t}""")
def fact_calendar(spark, sf):
    staged = model.stage_fact(transactions(spark, sf)).select("transaction_id", "time_sk")
    return model.fact_calendar(staged, event_calendar(spark, sf)).select("transaction_id", "time_sk", "date", "is_weekend")


@query("drop_unresolved_keys", """
SELECT transaction_id, md5(CAST(user_id AS VARCHAR)) AS user_sk, md5(CAST(merchant_id AS VARCHAR)) AS merchant_sk FROM {dirty}
WHERE user_id IN (SELECT c_custkey FROM customer) AND merchant_id IN (SELECT p_partkey FROM part)""")
def drop_unresolved_keys(spark, sf):
    users, merchants = dims(spark, sf)
    rows = dirty_transactions(spark, sf).select("transaction_id", "user_id", "merchant_id")
    keyed = model.fact_merchant_key(model.fact_user_key(rows, users), merchants)
    return model.drop_unresolved_keys(keyed).select("transaction_id", "user_sk", "merchant_sk")


@query("filter_by_watermark", """
SELECT transaction_id, event_ts FROM {t} WHERE event_ts > (SELECT max(event_ts) FROM {t} WHERE event_ts < TIMESTAMP '2024-01-16')""")
def filter_by_watermark(spark, sf):
    t = transactions(spark, sf).withColumnRenamed("timestamp", "event_ts")
    loaded = t.where("event_ts < TIMESTAMP'2024-01-16'").withColumnRenamed("event_ts", "created_at")
    return model.filter_by_watermark(t, loaded, "event_ts").select("transaction_id", "event_ts")


@query("staged_vs_gold", """
SELECT transaction_id, coalesce(user_id IN (SELECT c_custkey FROM customer) AND merchant_id IN (SELECT p_partkey FROM part), FALSE) AS in_gold FROM {dirty}""")
def staged_vs_gold(spark, sf):
    staged = staged_facts(dirty_transactions(spark, sf))
    return kpis.staged_vs_gold(staged, model.fct_transactions(staged, *dims(spark, sf))).select("transaction_id", "in_gold")


@query("orphan_facts", "SELECT transaction_id, user_id FROM {t} WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def orphan_facts(spark, sf):
    known = table(spark, sf, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("user_id"))
    return quality.orphan_facts(transactions(spark, sf).select("transaction_id", "user_id"), known, "user_id")


@query("new_alerts_only", """
SELECT transaction_id FROM {t} WHERE amount > 20 AND transaction_id NOT IN (SELECT transaction_id FROM {high_amount})""")
def new_alerts_only(spark, sf):
    t = transactions(spark, sf)
    found = rules.detect_high_amount(t, as_of=AS_OF)
    return forest.new_alerts_only(t.where("amount > 20").select("transaction_id"), found)


FLAG_SQL = "SELECT transaction_id, max(severity_score) AS severity FROM {alerts} WHERE status = 'open' GROUP BY 1"


@query("flag_join", f"SELECT transaction_id, CAST(severity AS DOUBLE) AS severity FROM {{fact0}} LEFT JOIN ({FLAG_SQL}) USING (transaction_id)")
def flag_join(spark, sf):
    return model.flag_join(gold(spark, sf)["fact"], gold(spark, sf)["alerts"]).select("transaction_id", F.col("_severity").alias("severity"))


# ---------------------------------------------------------------- dimensions

@query("surrogate_key", "SELECT c_custkey AS user_id, md5(CAST(c_custkey AS VARCHAR)) AS user_sk, md5(c_custkey || '|' || c_name) AS pair_sk FROM customer")
def surrogate_key(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), scalars.surrogate_key("c_custkey").alias("user_sk"),
                                               scalars.surrogate_key("c_custkey", "c_name").alias("pair_sk"))


@query("dim_time", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_sk, CAST(d AS VARCHAR) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend,
  FALSE AS is_holiday, rpad(monthname(d), 9, ' ') AS month_name, CAST(week(d) AS INTEGER) AS week_of_year
FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
def dim_time(spark, sf):
    return model.dim_time(model.calendar_of(table(spark, sf, "orders"), "o_orderdate"))


def _two_days(spark, sf):
    """Yesterday's users, and today's: only customers with orders, their tier set by the largest one."""
    first = tables.users(spark, sf)
    biggest = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.max("o_totalprice").alias("top"))
    today = first.join(biggest, "user_id").withColumn("risk_tier", F.when(F.col("top") > 450000, "high").otherwise(F.col("risk_tier")))
    return first, today.drop("top")


def _history(spark, sf):
    first, today = _two_days(spark, sf)
    known = first.where("risk_tier <> 'low'")  # low-risk users are new today
    empty = known.select("user_id", "email_hash", "risk_tier", "country_code", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("updated_at", "timestamp"), ("valid_from", "timestamp"), ("valid_to", "timestamp"), ("scd_id", "string"))]).limit(0)
    day1 = model.scd2_snapshot(empty, known, as_of="2024-01-01 00:00:00")
    return model.scd2_snapshot(day1, today, as_of="2024-01-02 00:00:00")


HISTORY_SQL = """
  SELECT coalesce(a.user_id, b.user_id) AS user_id, a.risk_tier AS old_tier, b.risk_tier AS new_tier, a.user_id IS NOT NULL AS had, b.user_id IS NOT NULL AS has
  FROM (SELECT * FROM {users_in} WHERE risk_tier <> 'low') a FULL OUTER JOIN (
    SELECT u.user_id, CASE WHEN top > 450000 THEN 'high' ELSE risk_tier END AS risk_tier FROM {users_in} u
    JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY 1) o ON o.o_custkey = u.user_id) b ON a.user_id = b.user_id"""
D1, D2 = "TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-01-02'"


@query("scd2_snapshot", f"""
WITH j AS ({HISTORY_SQL}),
v AS (
  SELECT user_id, old_tier AS risk_tier, {D1} AS valid_from, CASE WHEN NOT has OR old_tier <> new_tier THEN {D2} END AS valid_to FROM j WHERE had
  UNION ALL SELECT user_id, new_tier, {D2}, NULL FROM j WHERE has AND (NOT had OR old_tier <> new_tier))
SELECT v.user_id, u.email_hash, v.risk_tier, u.country_code, valid_from AS updated_at, valid_from, valid_to,
  md5(CAST(v.user_id AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR)) AS scd_id
FROM v JOIN {{users_in}} u ON u.user_id = v.user_id""".replace("WITH j AS", "SELECT * FROM (WITH j AS") + ")")
def scd2_snapshot(spark, sf):
    return _history(spark, sf)


@query("history_late_days", """
SELECT * FROM (WITH seen AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) > 200000 AS high FROM orders GROUP BY 1, 2),
full_days AS (SELECT DISTINCT make_date(year(d), 1, 1) AS f FROM seen),
listed AS (SELECT user_id, make_date(year(d) + 1, 1, 1) AS d, bool_or(high) AS high FROM seen GROUP BY 1, 2),
events AS (SELECT * FROM seen WHERE d NOT IN (SELECT f FROM full_days) UNION ALL SELECT * FROM listed WHERE d IN (SELECT f FROM full_days)),
steps AS (SELECT *, lead(d) OVER w AS following, lag(high) OVER w AS before_it, (SELECT min(f) FROM full_days WHERE f > d) AS f
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY d)),
ended AS (SELECT *, CASE WHEN following IS NULL OR f < following THEN f END AS closed FROM steps),
opened AS (SELECT *, before_it IS NULL OR before_it <> high OR lag(closed) OVER (PARTITION BY user_id ORDER BY d) IS NOT NULL AS opens FROM ended),
runs AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY user_id ORDER BY d) AS run FROM opened),
versions AS (SELECT user_id, bool_or(high) AS high, min(d) AS since, max(closed) AS closed, run FROM runs GROUP BY user_id, run)
SELECT user_id, CASE WHEN high THEN 'high' ELSE 'low' END AS risk_tier, CAST(since AS TIMESTAMP) AS valid_from,
  CAST(coalesce(closed, lead(since) OVER (PARTITION BY user_id ORDER BY since)) AS TIMESTAMP) AS valid_to FROM versions)""")
def history_late_days(spark, sf):
    """Customers by the days of their orders, all customers of a year listed on the next year's first day; the odd years' orders come late."""
    when = F.col("o_orderdate").cast("date")
    tier = F.when(F.max("o_totalprice") > 200000, "high").otherwise("low").alias("risk_tier")
    fixed = [F.md5(F.col("user_id").cast("string")).alias("email_hash"), "risk_tier", F.lit(None).cast("string").alias("country_code"), "partition_date"]
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "user_id")
    seen = orders.groupBy("user_id", when.alias("partition_date")).agg(tier).select("user_id", *fixed)
    listed = orders.groupBy("user_id", F.make_date(F.year(when) + 1, F.lit(1), F.lit(1)).alias("partition_date")).agg(tier).select("user_id", *fixed)
    # One row for each year.
    full_days = [r[0] for r in orders.select(F.make_date(F.year(when), F.lit(1), F.lit(1)).alias("first_day")).distinct().collect()]
    listed = listed.where(F.col("partition_date").isin(full_days))
    empty = seen.limit(0).select("user_id", "email_hash", "risk_tier", "country_code", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("updated_at", "timestamp"), ("valid_from", "timestamp"), ("valid_to", "timestamp"), ("scd_id", "string"))])
    first, late = min(full_days), min(d for d in full_days if d.year % 2)
    early = model.daily_profiles(seen.where(F.year("partition_date") % 2 == 0), listed, full_days)
    history = model.scd2_rebuild(empty, early, first, full_days=full_days)
    daily = model.daily_profiles(seen, listed, full_days)
    return model.scd2_rebuild(history, daily, late, full_days=full_days).select("user_id", "risk_tier", "valid_from", "valid_to")


@query("dim_users", f"""
SELECT * FROM (WITH j AS ({HISTORY_SQL})
SELECT md5(CAST(user_id AS VARCHAR)) AS user_sk, user_id, new_tier AS risk_tier, CASE WHEN had AND old_tier = new_tier THEN {D1} ELSE {D2} END AS valid_from,
  TRUE AS is_current FROM j WHERE has)""")
def dim_users(spark, sf):
    return model.dim_users(_history(spark, sf)).select("user_sk", "user_id", "risk_tier", "valid_from", "is_current")


@query("dim_merchants", """
SELECT md5(CAST(m AS VARCHAR)) AS merchant_sk, m AS merchant_id, coalesce(p_name, 'Unknown') AS merchant_name, mcc_code, country_code,
  round(coalesce(p_size / 100.0::DOUBLE, 0), 4) AS risk_score, TIMESTAMP '2024-01-31' AS created_at
FROM (SELECT merchant_id AS m, min(mcc_code) AS mcc_code, min(country_code) AS country_code FROM {t} GROUP BY 1) LEFT JOIN part ON p_partkey = m""")
def dim_merchants(spark, sf):
    raw = table(spark, sf, "part").select(F.col("p_partkey").alias("merchant_id"), F.col("p_name").alias("merchant_name"),
                                          (F.col("p_size") / 100).cast(S.SCORE).alias("risk_score"))
    staged = model.stg_merchants(model.stage_merchants(transactions(spark, sf), AS_OF))
    return model.dim_merchants(staged, AS_OF, raw)


@query("incremental_upsert", """
SELECT transaction_id, CAST(CASE WHEN is_fraud THEN amount + 1 ELSE amount END AS DOUBLE) AS amount, status FROM {t}""")
def incremental_upsert(spark, sf):
    t = transactions(spark, sf).select("transaction_id", "amount", "status", "is_fraud", "transaction_type")
    target = t.where("transaction_type <> 'purchase'")
    changed = t.where("is_fraud OR transaction_type = 'purchase'").withColumn(
        "amount", F.when(F.col("is_fraud"), (F.col("amount") + 1).cast(S.AMOUNT)).otherwise(F.col("amount")))
    once = model.incremental_upsert(target, changed, "transaction_id")
    return model.incremental_upsert(once, changed, "transaction_id").select("transaction_id", "amount", "status")


FACT_SQL = "transaction_id, user_sk, merchant_sk, time_sk, CAST(amount AS DOUBLE) AS amount, status, country_code, created_at"


@query("fct_transactions", f"SELECT {FACT_SQL} FROM {{fact0}}")
def fct_transactions(spark, sf):
    return facts(spark, sf).select("transaction_id", "user_sk", "merchant_sk", "time_sk", "amount", "status", "country_code", "created_at")


@query("apply_fraud_flags", f"SELECT transaction_id, is_flagged_fraud, CAST(fraud_score AS DOUBLE) AS fraud_score FROM {{fact}}")
def apply_fraud_flags(spark, sf):
    log = alerts(transactions(spark, sf))
    return model.apply_fraud_flags(facts(spark, sf), log).select("transaction_id", "is_flagged_fraud", "fraud_score")


KPI_MART_SQL = """
SELECT CAST(txn_date AS VARCHAR) AS txn_date, total_transactions, completed_transactions, CAST(daily_tpv AS DOUBLE) AS daily_tpv,
  avg_txn_value, fraud_alerts, fraud_rate_pct, CAST(tpv_30d AS DOUBLE) AS tpv_30d,
  round(fraud_rate_7d_avg, 6) AS fraud_rate_7d_avg FROM {kpi_mart}"""
RISK_MART_SQL = """
SELECT CAST(alert_date AS VARCHAR) AS alert_date, reason_code, severity_bucket, status, alert_count, avg_severity,
  CAST(max_severity AS DOUBLE) AS max_severity, unique_transactions FROM {risk_mart}"""


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("mart_executive_kpis", KPI_MART_SQL)
def mart_executive_kpis(spark, sf):
    g = gold(spark, sf)
    return rounded(model.mart_executive_kpis(g["fact"], g["days"]), "fraud_rate_7d_avg")


@query("mart_fraud_summary", RISK_MART_SQL)
def mart_fraud_summary(spark, sf):
    return model.mart_fraud_summary(alerts(transactions(spark, sf)))


@query("daily_kpis", """
SELECT CAST(txn_date AS VARCHAR) AS txn_date, total_transactions, completed_transactions, CAST(daily_tpv AS DOUBLE) AS daily_tpv,
  avg_txn_value, fraud_alerts, fraud_rate_pct FROM {daily}""")
def daily_kpis(spark, sf):
    g = gold(spark, sf)
    return model.daily_kpis(model.fact_calendar(g["fact"], g["days"]))


@query("fraud_summary", RISK_MART_SQL)
def fraud_summary(spark, sf):
    return model.fraud_summary(gold(spark, sf)["alerts"])


@query("mart_order", """
SELECT CAST(txn_date AS VARCHAR) AS day, NULL::VARCHAR AS reason_code, total_transactions AS n FROM {kpi_mart}
UNION ALL SELECT CAST(alert_date AS VARCHAR), reason_code, alert_count FROM {risk_mart}""")
def mart_order(spark, sf):
    g = gold(spark, sf)
    kpi = model.mart_order(g["kpi_mart"]).select(F.col("txn_date").alias("day"), F.lit(None).cast("string").alias("reason_code"),
                                                 F.col("total_transactions").alias("n"))
    risk = model.mart_order(g["risk_mart"]).select(F.col("alert_date").alias("day"), "reason_code", F.col("alert_count").alias("n"))
    return kpi.unionAll(risk)
