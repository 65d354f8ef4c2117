"""Dashboards, monitors and reports over the stored gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import kpis, ledger
from ledgerlens.plans.queries.base import gold, query, staged_facts
from ledgerlens.sources.tables import AS_OF, dirty_transactions

SINCE = {d: f"TIMESTAMP '2024-01-31' - INTERVAL {d} DAY" for d in (7, 14, 30)}
EXACT = "CAST(sum({0}) AS DOUBLE) / count({0})"
DONE = "FILTER (WHERE status = 'completed')"
RATE = "round(CAST(count(*) FILTER (WHERE is_flagged_fraud) AS DOUBLE) * 100.0::DOUBLE / nullif(count(*), 0), {0})"
AVG_SEVERITY = "CAST(sum(severity_score) AS DOUBLE) / count(*)"


@query("headline_kpis", f"""
SELECT CAST(coalesce(sum(daily_tpv), 0) AS DOUBLE) AS tpv, CAST(coalesce(sum(total_transactions), 0) AS BIGINT) AS total_txns,
  round(coalesce(avg(avg_txn_value), 0), 6) AS avg_txn_value, round(coalesce(avg(fraud_rate_pct), 0), 6) AS fraud_rate_pct
FROM {{kpi_mart}} WHERE txn_date >= {SINCE[30]}""")
def headline_kpis(spark, sf):
    out = kpis.headline_kpis(gold(spark, sf)["kpi_mart"], AS_OF)
    return out.withColumns({c: F.round(c, 6) for c in ("avg_txn_value", "fraud_rate_pct")})


@query("platform_totals", f"""
SELECT count(*) AS total_txns, CAST(sum(amount) {DONE} AS DOUBLE) AS tpv, count(*) FILTER (WHERE is_flagged_fraud) AS fraud_count FROM {{fact}}""")
def platform_totals(spark, sf):
    return kpis.platform_totals(gold(spark, sf)["fact"])


@query("volume_trend_14d", f"""
SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS date, CAST(sum(amount) AS DOUBLE) AS daily_amount FROM {{fact}}
WHERE status = 'completed' AND created_at >= {SINCE[14]} GROUP BY 1""")
def volume_trend_14d(spark, sf):
    return kpis.volume_trend(gold(spark, sf)["fact"], AS_OF, ledger=gold(spark, sf)["ledger"])


@query("tpv_trend", f"SELECT CAST(txn_date AS VARCHAR) AS date, CAST(daily_tpv AS DOUBLE) AS daily_tpv FROM {{kpi_mart}} WHERE txn_date >= {SINCE[30]}")
def tpv_trend(spark, sf):
    return kpis.tpv_trend(gold(spark, sf)["kpi_mart"], AS_OF)


@query("tpv_trend_from_fact", """
SELECT CAST(partition_date AS VARCHAR) AS date, CAST(sum(amount) AS DOUBLE) AS daily_tpv FROM {fact}
WHERE status = 'completed' AND time_sk >= 20240101 GROUP BY 1""")
def tpv_trend_from_fact(spark, sf):
    g = gold(spark, sf)
    return kpis.tpv_trend_from_fact(g["fact"], g["days"], AS_OF)


@query("count_by", "SELECT payment_method, count(*) AS count FROM {fact} WHERE time_sk >= 20240101 GROUP BY 1")
def count_by(spark, sf):
    return kpis.count_by(gold(spark, sf)["fact"], "payment_method", AS_OF)


@query("count_by_type", "SELECT transaction_type, count(*) AS count FROM {fact} WHERE time_sk >= 20240101 GROUP BY 1")
def count_by_type(spark, sf):
    return kpis.count_by(gold(spark, sf)["fact"], "transaction_type", AS_OF)


@query("kpis_from_fact", f"""
SELECT CAST(sum(amount) {DONE} AS DOUBLE) AS tpv, count(*) AS total_txns, CAST(sum(amount) {DONE} AS DOUBLE) / count(*) {DONE} AS avg_txn_value,
  {RATE.format(4)} AS fraud_rate_pct FROM {{fact}} WHERE time_sk >= 20240101""")
def kpis_from_fact(spark, sf):
    return kpis.kpis_from_fact(gold(spark, sf)["fact"], AS_OF)


@query("mart_stat", f"""
SELECT 'tpv' AS panel, CAST(sum(daily_tpv) AS DOUBLE) AS value FROM {{kpi_mart}} WHERE txn_date >= {SINCE[30]}
UNION ALL SELECT 'fraud_rate', round(avg(fraud_rate_pct), 6) FROM {{kpi_mart}} WHERE txn_date >= {SINCE[30]}
UNION ALL SELECT 'transactions', CAST(sum(total_transactions) AS DOUBLE) FROM {{kpi_mart}} WHERE txn_date >= {SINCE[30]}
UNION ALL SELECT 'severity', round({AVG_SEVERITY}, 6) FROM {{alerts}} WHERE alert_timestamp >= {SINCE[7]}""")
def mart_stat(spark, sf):
    g = gold(spark, sf)
    panels = {
        "tpv": kpis.mart_stat(g["kpi_mart"], "daily_tpv", "sum", AS_OF),
        "fraud_rate": kpis.mart_stat(g["kpi_mart"], "fraud_rate_pct", "avg", AS_OF),
        "transactions": kpis.mart_stat(g["kpi_mart"], "total_transactions", "sum", AS_OF),
        "severity": kpis.mart_stat(kpis.recent_alert_rows(g["alerts"], AS_OF, 7, g["alert_ledger"]), "severity_score", "avg", AS_OF, days=7,
                                   time="alert_timestamp", kind="timestamp"),
    }
    return kpis.union_reports([df.select(F.lit(name).alias("panel"), F.round(F.col("value").cast("double"), 6).alias("value"))
                               for name, df in panels.items()])


@query("alert_kpis", f"""
SELECT count(*) AS total_alerts, count(*) FILTER (WHERE status = 'open') AS open_alerts, round({AVG_SEVERITY}, 3) AS avg_severity,
  count(DISTINCT transaction_id) AS unique_txns FROM {{alerts}} WHERE alert_timestamp >= {SINCE[7]} AND status IN ('open', 'investigating')""")
def alert_kpis(spark, sf):
    return kpis.alert_kpis(gold(spark, sf)["alerts"], AS_OF, ledger=gold(spark, sf)["alert_ledger"])


@query("alerts_by_rule", f"""
SELECT reason_code, count(*) AS count, {AVG_SEVERITY} AS avg_severity FROM {{alerts}} WHERE alert_timestamp >= {SINCE[7]} GROUP BY 1""")
def alerts_by_rule(spark, sf):
    return kpis.alerts_by_rule(gold(spark, sf)["alerts"], AS_OF, ledger=gold(spark, sf)["alert_ledger"])


@query("alert_timeline", f"""
SELECT CAST(alert_date AS VARCHAR) AS alert_date, reason_code, count(*) AS alert_count FROM {{alerts}} WHERE alert_timestamp >= {SINCE[7]} GROUP BY ALL""")
def alert_timeline(spark, sf):
    return kpis.alert_timeline(gold(spark, sf)["alerts"], AS_OF, ledger=gold(spark, sf)["alert_ledger"])


@query("severity_distribution", f"""
SELECT CASE WHEN severity_score >= 0.8 THEN 'Critical (0.8-1.0)' WHEN severity_score >= 0.5 THEN 'High (0.5-0.8)'
  WHEN severity_score >= 0.2 THEN 'Medium (0.2-0.5)' ELSE 'Low (0-0.2)' END AS severity_bucket, count(*) AS count
FROM {{alerts}} WHERE alert_timestamp >= {SINCE[7]} GROUP BY 1""")
def severity_distribution(spark, sf):
    return kpis.severity_distribution(gold(spark, sf)["alerts"], AS_OF, ledger=gold(spark, sf)["alert_ledger"])


@query("recent_alerts", f"""
SELECT alert_timestamp, transaction_id, reason_code, round(CAST(severity_score AS DOUBLE), 3) AS severity_score, status FROM {{alerts}}
WHERE alert_timestamp >= {SINCE[7]} ORDER BY alert_timestamp DESC, transaction_id, reason_code LIMIT 50""")
def recent_alerts(spark, sf):
    return kpis.recent_alerts(gold(spark, sf)["alerts"], AS_OF, ledger=gold(spark, sf)["alert_ledger"]).drop("description")


@query("open_alert_count", "SELECT count(*) AS open_count FROM {alerts} WHERE status = 'open'")
def open_alert_count(spark, sf):
    return kpis.open_alert_count(gold(spark, sf)["alerts"])


@query("alerts_by_country", f"""
SELECT country_code, count(*) AS alerts FROM {{alerts}} JOIN {{fact}} USING (transaction_id) WHERE alert_timestamp >= {SINCE[30]}
GROUP BY 1 ORDER BY alerts DESC, country_code LIMIT 10""")
def alerts_by_country(spark, sf):
    g = gold(spark, sf)
    return kpis.alerts_by_country(g["alerts"], g["fact"], AS_OF, ledger=g["alert_ledger"])


LAYERS_SQL = """
SELECT 'fact_transactions' AS layer, count(*) AS row_count, max(created_at) AS last_updated FROM {fact}
UNION ALL SELECT 'alerts_log', count(*), max(alert_timestamp) FROM {alerts}
UNION ALL SELECT 'dim_users', count(*), TIMESTAMP '2024-01-01' FROM customer
UNION ALL SELECT 'dim_merchants', count(*), TIMESTAMP '2024-01-01' FROM part"""


@query("layer_counts", LAYERS_SQL)
def layer_counts(spark, sf):
    g = gold(spark, sf)
    return kpis.layer_counts(g["fact"], g["alerts"], g["users"], g["merchants"])


@query("union_reports", LAYERS_SQL.replace(", max(created_at) AS last_updated", "").replace(", max(alert_timestamp)", "").replace(", TIMESTAMP '2024-01-01'", ""))
def union_reports(spark, sf):
    g = gold(spark, sf)
    named = {"fact_transactions": g["fact"], "alerts_log": g["alerts"], "dim_users": g["users"], "dim_merchants": g["merchants"]}
    return kpis.union_reports([df.agg(F.lit(name).alias("layer"), F.count("*").alias("row_count")) for name, df in named.items()])


@query("rejection_rate", f"""
SELECT CAST(CAST(d.event_ts AS DATE) AS VARCHAR) AS load_date, count(*) AS staged_rows, count(f.transaction_id) AS gold_rows,
  round(CAST(count(*) - count(f.transaction_id) AS DOUBLE) * 100.0::DOUBLE / count(*), 2) AS rejection_pct
FROM {{dirty}} d LEFT JOIN (SELECT transaction_id FROM {{checked}} WHERE ok) f USING (transaction_id) WHERE d.event_ts >= {SINCE[7]} GROUP BY 1""")
def rejection_rate(spark, sf):
    from ledgerlens.operators.cleanse import validate_rows
    staged = staged_facts(dirty_transactions(spark, sf))
    kept = validate_rows(dirty_transactions(spark, sf), AS_OF)
    return kpis.rejection_rate(staged, kept, AS_OF)


@query("fraud_rate_window", f"""
SELECT {RATE.format(4)} AS fraud_rate_pct FROM {{fact}} WHERE created_at >= TIMESTAMP '2024-01-30'""")
def fraud_rate_window(spark, sf):
    return kpis.fraud_rate_window(gold(spark, sf)["fact"], AS_OF, ledger=gold(spark, sf)["ledger"])


@query("ingest_gauge", """
SELECT count(*) AS rows, least(CAST(count(*) AS DOUBLE) / 10000.0::DOUBLE * 100.0::DOUBLE, 100.0::DOUBLE) AS pct_of_target FROM {fact}
WHERE created_at >= TIMESTAMP '2024-01-30'""")
def ingest_gauge(spark, sf):
    return kpis.ingest_gauge(gold(spark, sf)["fact"], AS_OF, ledger=gold(spark, sf)["ledger"])


ODD_TIME = "2024-01-29 21:17:30.5"


@query("recent_load", f"""
SELECT n AS hours, count(transaction_id) AS rows, count(*) FILTER (WHERE is_flagged_fraud) AS flagged, count(*) {DONE} AS done_rows,
  CAST(sum(amount) {DONE} AS DOUBLE) AS done_amount
FROM (VALUES (0), (1), (5), (48)) v(n) LEFT JOIN {{fact}} ON created_at >= TIMESTAMP '{ODD_TIME}' - to_hours(n) GROUP BY n""")
def recent_load(spark, sf):
    """Spans that begin within an hour: the rest of that hour comes from the facts."""
    g = gold(spark, sf)
    return kpis.union_reports([ledger.recent_load(g["fact"], g["ledger"], ODD_TIME, hours=n).agg(F.lit(n).alias("hours"), *[F.sum(c).alias(c) for c in ledger.MEASURES])
                               for n in (0, 1, 5, 48)])


@query("fact_ledger", f"""
SELECT time_sk, date_trunc('hour', created_at) AS hour, count(*) AS rows, count(*) FILTER (WHERE is_flagged_fraud) AS flagged,
  count(*) {DONE} AS done_rows, CAST(sum(amount) {DONE} AS DOUBLE) AS done_amount FROM {{fact}} GROUP BY ALL""")
def fact_ledger(spark, sf):
    return gold(spark, sf)["ledger"]


@query("freshness", "SELECT max(created_at) AS last_updated FROM {fact}")
def freshness(spark, sf):
    return kpis.freshness(gold(spark, sf)["fact"])


def _monitor_sql(name: str, value: str, threshold: float, op: str, source: str) -> str:
    return (f"SELECT '{name}' AS monitor, v AS value, {threshold}::DOUBLE AS threshold, coalesce(v {op} {threshold}, FALSE) AS breached "
            f"FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {source})")


@query("monitor_low_ingest", _monitor_sql("low_ingest", "count(*)", 100.0, "<", "{fact} WHERE created_at >= TIMESTAMP '2024-01-30 23:00:00'"))
def monitor_low_ingest(spark, sf):
    return kpis.monitor_low_ingest(gold(spark, sf)["fact"], AS_OF, ledger=gold(spark, sf)["ledger"])


@query("monitor_fraud_spike", _monitor_sql("fraud_spike", RATE.format(2), 10.0, ">", "{fact} WHERE created_at >= TIMESTAMP '2024-01-30 23:00:00'"))
def monitor_fraud_spike(spark, sf):
    return kpis.monitor_fraud_spike(gold(spark, sf)["fact"], AS_OF, ledger=gold(spark, sf)["ledger"])


@query("monitor_open_backlog", _monitor_sql("open_backlog", "count(*)", 50.0, ">", "{alerts} WHERE status = 'open' AND alert_timestamp < TIMESTAMP '2024-01-30'"))
def monitor_open_backlog(spark, sf):
    return kpis.monitor_open_backlog(gold(spark, sf)["alerts"], AS_OF)


@query("backfill_report", """
SELECT 'fact_transactions' AS item, count(*) AS total FROM {fact} UNION ALL SELECT 'mart_executive_kpis', count(*) FROM {kpi_mart}
UNION ALL SELECT 'current_users', count(DISTINCT c_custkey) FROM customer""")
def backfill_report(spark, sf):
    g = gold(spark, sf)
    return kpis.backfill_report(g["fact"], g["kpi_mart"], g["users"])
