"""Scans, parsing, validation, windows and sets over the transaction rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions import scalars
from ledgerlens.operators import cleanse, kpis, model, windows
from ledgerlens.plans.queries.base import alerts, gold, landed, once, query
from ledgerlens.session import scratch_path
from ledgerlens.sources import scans, tables
from ledgerlens.sources.tables import AS_OF, dirty_transactions, table, transactions

T_COLUMNS = ["transaction_id", "user_id", "merchant_id", "amount", "currency", "event_ts", "status", "latitude", "longitude", "country_code"]


def shown(df, *columns):
    return df.withColumnRenamed("timestamp", "event_ts").select(*(columns or T_COLUMNS))


SHOWN_SQL = ("transaction_id, user_id, merchant_id, CAST(amount AS DOUBLE) AS amount, currency, event_ts, status, "
             "CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, country_code")
FOLDER_SQL = "strftime(event_ts, '%Y/%m/%d/') || lpad(CAST(hour(event_ts) // 6 * 6 AS VARCHAR), 2, '0')"


# ---------------------------------------------------------------- sources

@query("scan_raw_jsonl", f"SELECT transaction_id, {FOLDER_SQL} AS folder FROM {{t}}")
def scan_raw_jsonl(spark, sf):
    lines = scans.scan_raw_jsonl(spark, f"{landed(spark, sf)}/raw/transactions/*/*/*/*")
    return lines.select(F.get_json_object("raw_data", "$.transaction_id").cast("long").alias("transaction_id"),
                        F.regexp_extract("source_file", r"/transactions/(\d{4}/\d{2}/\d{2}/\d{2})/", 1).alias("folder"))


@query("landing_path", f"SELECT {FOLDER_SQL} AS folder, count(*) AS lines FROM {{t}} GROUP BY 1")
def landing_path(spark, sf):
    root = landed(spark, sf)
    days = [str(r[0]) for r in model.calendar_of(table(spark, sf, "events"), "ts").collect()]  # one row per day
    slots = table(spark, sf, "events").select(F.floor(F.hour("ts") / 6) * 6).distinct().collect()  # four rows
    wanted = [scans.landing_path(root, d, h[0]) for d in days for h in slots]
    paths = [p for p in wanted if scans.path_exists(spark, p)]
    folder = F.regexp_extract("source_file", r"/transactions/(\d{4}/\d{2}/\d{2}/\d{2})/", 1)
    return scans.scan_raw_jsonl(spark, paths).groupBy(folder.alias("folder")).agg(F.count("*").alias("lines"))


def _layer(spark, sf) -> str:
    def build():
        path = scratch_path(spark, "layer")
        transactions(spark, sf).write.partitionBy("partition_date").parquet(path)
        return path
    return once(spark, sf, "layer", build)


@query("scan_layer", """
SELECT CAST(partition_date AS VARCHAR) AS partition_date, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS amount
FROM {t} WHERE partition_date >= DATE '2024-01-02' GROUP BY 1""")
def scan_layer(spark, sf):
    days = model.calendar_of(table(spark, sf, "events"), "ts").where("date >= DATE'2024-01-02'").collect()
    layer = scans.scan_layer(spark, _layer(spark, sf), [str(d[0]) for d in days])
    return layer.groupBy("partition_date").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))


@query("scan_or_empty", "SELECT 'present' AS layer, count(*) AS rows FROM {t} UNION ALL SELECT 'absent', 0")
def scan_or_empty(spark, sf):
    out, shape = [], spark.read.parquet(_layer(spark, sf)).schema
    for name, path in (("present", _layer(spark, sf)), ("absent", f"{_layer(spark, sf)}-absent")):
        df = scans.scan_or_empty(spark, path, shape)
        out.append(df.agg(F.lit(name).alias("layer"), F.count("*").alias("rows")))
    return kpis.union_reports(out)


@query("scan_features", """
SELECT transaction_id, user_id, CAST(amount AS DOUBLE) AS amount, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
FROM {t}""")
def scan_features(spark, sf):
    return scans.scan_features(scans.scan_layer(spark, _layer(spark, sf)))


@query("calendar", """
SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date
FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d FROM orders)""")
def calendar(spark, sf):
    return model.calendar_of(table(spark, sf, "orders"), "o_orderdate")


@query("scan_entity", """
SELECT 'users' AS entity, user_id AS key, risk_tier AS detail FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, risk_tier FROM {users_in})
UNION ALL SELECT 'merchants', CAST(p_partkey AS VARCHAR), p_name FROM part
UNION ALL SELECT 'disputes', 'd-' || transaction_id, CAST(event_ts AS VARCHAR) FROM (
  SELECT transaction_id, date_trunc('second', event_ts) AS event_ts FROM {t} WHERE status = 'disputed')
UNION ALL SELECT 'transactions', CAST(transaction_id AS VARCHAR), CAST(amount AS VARCHAR) FROM {t}""")
def scan_entity(spark, sf):
    root = scratch_path(spark, "entities")
    raw = {
        "users": tables.users(spark, sf),
        "merchants": tables.merchants(spark, sf),
        "disputes": transactions(spark, sf).where("status = 'disputed'").select(
            F.concat(F.lit("d-"), F.col("transaction_id").cast("string")).alias("dispute_id"), "transaction_id", "user_id",
            F.lit("open").alias("status"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("opened_at")),
        "transactions": tables.raw_json(transactions(spark, sf)).select("value"),
    }
    for name, df in raw.items():
        (df.write.text if name == "transactions" else df.write.json)(f"{root}/{name}")
    shape = {"users": ("user_id", "risk_tier"), "merchants": ("merchant_id", "merchant_name"),
             "disputes": ("dispute_id", "opened_at"), "transactions": ("transaction_id", "amount")}
    return kpis.union_reports([
        scans.scan_entity(spark, f"{root}/{e}", e).select(F.lit(e).alias("entity"), F.col(k).alias("key"), F.col(d).cast("string").alias("detail"))
        for e, (k, d) in shape.items()])


# ---------------------------------------------------------------- parsing and casts

def raw_lines(spark, sf):
    """JSON lines; those of failed events are cut off in the middle."""
    t = transactions(spark, sf)
    return tables.raw_json(t.withColumn("timestamp", F.col("timestamp"))).join(
        t.select("transaction_id", "is_fraud"), "transaction_id").select(
        F.when(F.col("is_fraud"), F.substring("value", 1, 20)).otherwise(F.col("value")).alias("raw_data"), "timestamp")


@query("bronze_metadata", """
SELECT transaction_id, TIMESTAMP '2024-01-31' AS ingestion_timestamp, '2024-01-30' AS partition_date, 'batch-1' AS bronze_batch_id FROM {t}""")
def bronze_metadata(spark, sf):
    lines = tables.raw_json(transactions(spark, sf))
    return cleanse.bronze_metadata(lines.select("transaction_id"), as_of=AS_OF, partition_date="2024-01-30", batch_id="batch-1")


@query("parse_raw_json", """
SELECT CASE WHEN NOT is_fraud THEN CAST(transaction_id AS VARCHAR) END AS transaction_id, CASE WHEN NOT is_fraud THEN CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN NOT is_fraud THEN CAST(amount AS DOUBLE) END AS amount, CASE WHEN NOT is_fraud THEN currency END AS currency,
  CASE WHEN NOT is_fraud THEN status END AS status, CASE WHEN NOT is_fraud THEN ip_address END AS ip_address,
  CASE WHEN NOT is_fraud THEN device_id END AS device_id, CASE WHEN NOT is_fraud THEN CAST(latitude AS DOUBLE) END AS latitude,
  CASE WHEN NOT is_fraud THEN mcc_code END AS mcc_code
FROM {t}""")
def parse_raw_json(spark, sf):
    parsed = cleanse.parse_raw_json(raw_lines(spark, sf).drop("timestamp"))
    return parsed.select("transaction_id", "user_id", "amount", "currency", "status", "ip_address", "device_id", "latitude", "mcc_code")


@query("cast_types", """
SELECT transaction_id, CASE WHEN NOT is_fraud THEN CAST(amount AS DOUBLE) END AS amount, CASE WHEN NOT is_fraud THEN event_ts END AS event_ts,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
FROM {t}""")
def cast_types(spark, sf):
    t = transactions(spark, sf)
    text = t.withColumns({"amount": F.when(F.col("is_fraud"), "n/a").otherwise(F.col("amount").cast("string")),
                          "timestamp": F.when(F.col("is_fraud"), "yesterday").otherwise(F.col("timestamp").cast("string")),
                          "latitude": F.col("latitude").cast("string"), "longitude": F.col("longitude").cast("string")})
    return shown(cleanse.cast_types(text), "transaction_id", "amount", "event_ts", "latitude", "longitude")


@query("hash_pii", "SELECT transaction_id, sha256(ip_address) AS ip_address_hash FROM {t}")
def hash_pii(spark, sf):
    return cleanse.hash_pii(transactions(spark, sf).select("transaction_id", "ip_address"))


@query("stamp_processed", "SELECT transaction_id, TIMESTAMP '2024-01-31' AS _silver_processed_at FROM {t}")
def stamp_processed(spark, sf):
    return cleanse.stamp_processed(transactions(spark, sf).select("transaction_id"), AS_OF)


@query("severity_bucket", """
SELECT transaction_id, reason_code, CASE WHEN severity_score >= 0.8 THEN 'critical' WHEN severity_score >= 0.5 THEN 'high'
  WHEN severity_score >= 0.2 THEN 'medium' ELSE 'low' END AS severity_bucket,
  CASE WHEN severity_score >= 0.8 THEN 'Critical (0.8-1.0)' WHEN severity_score >= 0.5 THEN 'High (0.5-0.8)'
  WHEN severity_score >= 0.2 THEN 'Medium (0.2-0.5)' ELSE 'Low (0-0.2)' END AS severity_range
FROM {alerts}""")
def severity_bucket(spark, sf):
    return gold(spark, sf)["alerts"].select(
        F.col("transaction_id").cast("long"), "reason_code", scalars.severity_bucket().alias("severity_bucket"),
        scalars.severity_range_label().alias("severity_range"))


@query("enforce_schema", f"SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, "
       "CAST(amount AS DOUBLE) AS amount, event_ts, sha256(ip_address) AS ip_address_hash, CAST(latitude AS DOUBLE) AS latitude, "
       "TIMESTAMP '2024-01-31' AS _silver_processed_at FROM {t}")
def enforce_schema(spark, sf):
    t = cleanse.stamp_processed(cleanse.hash_pii(transactions(spark, sf)), AS_OF).withColumns(
        {"ingestion_timestamp": F.col("timestamp"), "source_file": F.lit("events")})
    return shown(cleanse.enforce_schema(t), "transaction_id", "user_id", "amount", "event_ts", "ip_address_hash", "latitude",
                 "_silver_processed_at")


# ---------------------------------------------------------------- filters

@query("drop_blank_lines", "SELECT transaction_id FROM {t} WHERE transaction_type IN ('purchase', 'withdrawal')")
def drop_blank_lines(spark, sf):
    t = transactions(spark, sf)
    line = (F.when(F.col("transaction_type") == "refund", "").when(F.col("transaction_type") != "transfer", F.col("ip_address")))
    return cleanse.drop_blank_lines(t.withColumn("raw_data", line)).select("transaction_id")


@query("validate_rows", f"SELECT {SHOWN_SQL} FROM {{checked}} WHERE ok")
def validate_rows(spark, sf):
    return shown(cleanse.validate_rows(dirty_transactions(spark, sf), AS_OF))


@query("reject_counts", """
SELECT rule, rejected FROM (SELECT
  count(*) FILTER (WHERE transaction_id IS NULL) AS transaction_id_present, count(*) FILTER (WHERE user_id IS NULL) AS user_id_present,
  count(*) FILTER (WHERE merchant_id IS NULL) AS merchant_id_present, count(*) FILTER (WHERE amount IS NULL) AS amount_present,
  count(*) FILTER (WHERE event_ts IS NULL) AS timestamp_present, count(*) FILTER (WHERE amount IS NULL OR amount <= 0) AS amount_positive,
  count(*) FILTER (WHERE event_ts IS NULL OR event_ts > TIMESTAMP '2024-01-31') AS timestamp_not_future,
  count(*) FILTER (WHERE currency NOT IN ('USD','EUR','GBP','JPY','CAD','MXN','BRL')) AS currency_known,
  count(*) FILTER (WHERE transaction_type NOT IN ('purchase','refund','transfer','withdrawal')) AS transaction_type_known,
  count(*) FILTER (WHERE status NOT IN ('completed','pending','failed','disputed')) AS status_known,
  count(*) FILTER (WHERE payment_method NOT IN ('card','bank_transfer','wallet','crypto')) AS payment_method_known,
  count(*) FILTER (WHERE latitude NOT BETWEEN -90 AND 90) AS latitude_in_range,
  count(*) FILTER (WHERE longitude NOT BETWEEN -180 AND 180) AS longitude_in_range FROM {dirty})
UNPIVOT (rejected FOR rule IN (COLUMNS(*)))""")
def reject_counts(spark, sf):
    return cleanse.reject_counts(dirty_transactions(spark, sf), AS_OF)


@query("reject_stats", """
SELECT 2 * n AS input_rows, good AS output_rows, 2 * n - good AS rejected_rows, 2 * (n - good) AS invalid_rows, good AS duplicate_rows,
  round(CAST(2 * n - good AS DOUBLE) * 100.0::DOUBLE / (2 * n), 2) AS rejection_pct
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE ok) AS good FROM {checked})""")
def reject_stats(spark, sf):
    rows = dirty_transactions(spark, sf)
    return cleanse.reject_stats(rows.unionAll(rows), AS_OF)


@query("lookback", """
SELECT 'timestamp' AS kind, count(*) AS rows FROM {t} WHERE event_ts >= TIMESTAMP '2024-01-24 00:00:00'
UNION ALL SELECT 'date', count(*) FROM {t} WHERE partition_date >= DATE '2024-01-24'
UNION ALL SELECT 'key', count(*) FROM {t} WHERE time_sk >= 20240124""")
def lookback(spark, sf):
    t = transactions(spark, sf).withColumn("time_sk", scalars.time_key("partition_date"))
    columns = {"timestamp": "timestamp", "date": "partition_date", "key": "time_sk"}
    return kpis.union_reports([
        scalars.lookback(t, c, AS_OF, days=7, kind=k).agg(F.lit(k).alias("kind"), F.count("*").alias("rows")) for k, c in columns.items()])


@query("status_filter", "SELECT transaction_id, reason_code, status FROM {alerts} WHERE status IN ('open', 'investigating')")
def status_filter(spark, sf):
    rows = kpis.status_filter(gold(spark, sf)["alerts"], ("open", "investigating"))
    return rows.select(F.col("transaction_id").cast("long"), "reason_code", "status")


# ---------------------------------------------------------------- windows and sets

@query("dedup_latest", """
SELECT transaction_id, CAST(CASE WHEN is_fraud THEN amount + 1 ELSE amount END AS DOUBLE) AS amount,
  CASE WHEN is_fraud THEN event_ts + INTERVAL 1 HOUR ELSE event_ts END AS ingestion_timestamp FROM {t}""")
def dedup_latest(spark, sf):
    t = transactions(spark, sf).withColumn("ingestion_timestamp", F.col("timestamp"))
    later = t.where("is_fraud").withColumns({"ingestion_timestamp": F.expr("timestamp + INTERVAL 1 HOUR"),
                                             "amount": (F.col("amount") + 1).cast(S.AMOUNT)})
    return cleanse.dedup_latest(t.unionByName(later)).select("transaction_id", "amount", "ingestion_timestamp")


@query("rolling_count", "SELECT transaction_id, user_id, n AS rolling_count FROM {rolled}")
def rolling_count(spark, sf):
    return windows.rolling_count(transactions(spark, sf).select("transaction_id", "user_id", "timestamp"), seconds=3600).select(
        "transaction_id", "user_id", "rolling_count")


@query("lag_previous", """
SELECT transaction_id, user_id, prev_ts, CAST(prev_lat AS DOUBLE) AS prev_lat, CAST(prev_lon AS DOUBLE) AS prev_lon, prev_country FROM {hops}""")
def lag_previous(spark, sf):
    out = windows.lag_previous(transactions(spark, sf), "user_id", "timestamp", "transaction_id",
                               ["timestamp", "latitude", "longitude", "country_code"])
    return out.select("transaction_id", "user_id", F.col("_prev.timestamp").alias("prev_ts"), F.col("_prev.latitude").alias("prev_lat"),
                      F.col("_prev.longitude").alias("prev_lon"), F.col("_prev.country_code").alias("prev_country"))


def _order_days(spark, sf):
    price = F.col("o_totalprice").cast(S.AMOUNT)
    return table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"), F.sum(price).alias("total"))


@query("rolling_sum_30", """
SELECT CAST(d AS VARCHAR) AS d, CAST(sum(total) OVER (ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rows_30,
  CAST(sum(total) OVER (ORDER BY d RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS days_30 FROM {order_days}""")
def rolling_sum_30(spark, sf):
    days = _order_days(spark, sf)
    return days.select("d", windows.rolling_over_days(days, "total", F.sum, 30, "d").alias("rows_30"),
                       windows.rolling_over_days(days, "total", F.sum, 30, "d", calendar_days=True).alias("days_30"))


@query("rolling_avg_7", """
SELECT CAST(d AS VARCHAR) AS d, round(avg(n) OVER (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS avg_7 FROM {order_days}""")
def rolling_avg_7(spark, sf):
    days = _order_days(spark, sf)
    return days.select("d", F.round(windows.rolling_over_days(days, "n", F.avg, 7, "d"), 6).alias("avg_7"))


@query("distinct_on", """
SELECT user_id, transaction_id, event_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, transaction_id DESC) AS r FROM {t}) WHERE r = 1""")
def distinct_on(spark, sf):
    return shown(windows.distinct_on(transactions(spark, sf), ["user_id"], [F.col("timestamp").desc(), F.col("transaction_id").desc()]),
                 "user_id", "transaction_id", "event_ts")


@query("distinct_rows", "SELECT DISTINCT user_id, country_code, payment_method FROM {t}")
def distinct_rows(spark, sf):
    return model.distinct_rows(transactions(spark, sf), ["user_id", "country_code", "payment_method"])


@query("drop_duplicates", "SELECT user_id, currency FROM {t} GROUP BY ALL")
def drop_duplicates(spark, sf):
    return transactions(spark, sf).select("user_id", "currency").dropDuplicates(["user_id"])


@query("limit_rows", """
SELECT transaction_id, event_ts FROM {t} ORDER BY event_ts DESC, transaction_id LIMIT 5""")
def limit_rows(spark, sf):
    return kpis.limit_rows(shown(transactions(spark, sf), "transaction_id", "event_ts"), 5, [F.col("event_ts").desc(), "transaction_id"])


@query("union_alerts", """
SELECT transaction_id, reason_code, CAST(severity_score AS DOUBLE) AS severity_score, alert_timestamp, status,
  NULL::DOUBLE AS ml_score, CAST(severity_score AS DOUBLE) AS rule_score FROM {alerts}""")
def union_alerts(spark, sf):
    return alerts(transactions(spark, sf)).select("transaction_id", "reason_code", "severity_score", "alert_timestamp", "status",
                                                  "ml_score", "rule_score")
