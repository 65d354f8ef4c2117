"""Sinks, jobs and streams: each writes a lake table and returns what is in it afterwards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions.scalars import time_key
from ledgerlens.operators import cleanse, forest, model
from ledgerlens.plans import jobs
from ledgerlens.plans.layout import Lake
from ledgerlens.plans.queries.base import AMOUNT, GEO, VELOCITY, alerts, landed, once, query
from ledgerlens.plans.queries.cleansing import _layer
from ledgerlens.session import drop_path, scratch_path
from ledgerlens.sources import scans, sinks, tables
from ledgerlens.sources.key_index import KeyIndex
from ledgerlens.sources.tables import AS_OF, table, transactions
from ledgerlens.streaming import streams

THRESHOLDS = {"velocity": VELOCITY, "amount": AMOUNT, "geo": GEO}


def _days(spark, sf) -> list[str]:
    """The days of the events table; one value per day."""
    return [str(r[0]) for r in model.calendar_of(table(spark, sf, "events"), "ts").collect()]


def one_row(spark, sf, **values):
    """Job metrics as a one-row table."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def _bronze(t):
    lines = tables.raw_json(t).select(F.col("value").alias("raw_data"), F.to_date("timestamp").alias("partition_date"))
    stamped = cleanse.bronze_metadata(lines.withColumn("source_file", F.lit("events")), as_of=AS_OF, partition_date="2024-01-30", batch_id="b")
    return stamped.withColumn("partition_date", F.to_date(F.get_json_object("raw_data", "$.timestamp"))).select(*S.BRONZE.names)


# ---------------------------------------------------------------- sinks

@query("write_bronze", "SELECT CAST(partition_date AS VARCHAR) AS partition_date, 2 * count(*) AS rows FROM {t} GROUP BY 1")
def write_bronze(spark, sf):
    path = scratch_path(spark, "bronze")
    for _ in range(2):  # bronze appends, so two runs leave two copies
        sinks.write_bronze(_bronze(transactions(spark, sf)), path)
    return scans.scan_layer(spark, path).groupBy("partition_date").agg(F.count("*").alias("rows"))


@query("write_silver", """
SELECT CAST(partition_date AS VARCHAR) AS partition_date, count(*) AS rows,
  CAST(sum(CASE WHEN partition_date >= DATE '2024-01-16' THEN amount + 1 ELSE amount END) AS DOUBLE) AS amount FROM {t} GROUP BY 1""")
def write_silver(spark, sf):
    path = scratch_path(spark, "silver")
    t = transactions(spark, sf)
    sinks.write_silver(t, path)
    again = t.where("partition_date >= DATE'2024-01-16'").withColumn("amount", (F.col("amount") + 1).cast(S.AMOUNT))
    sinks.write_silver(again, path)  # replaces the days it holds, keeps the others
    return scans.scan_layer(spark, path).groupBy("partition_date").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))


@query("write_staging", "SELECT count(*) AS returned, count(*) AS stored FROM {t}")
def write_staging(spark, sf):
    path = scratch_path(spark, "staging")
    for _ in range(2):
        rows = sinks.write_staging(model.stage_fact(transactions(spark, sf), AS_OF), path)
    return spark.read.parquet(path).agg(F.lit(rows).cast("long").alias("returned"), F.count("*").alias("stored"))


@query("upsert_partitions", """
SELECT transaction_id, time_sk, CAST(amount AS DOUBLE) AS amount, status, is_fraud AND transaction_id % 4 = 0 AS is_flagged_fraud FROM {t}""")
def upsert_partitions(spark, sf):
    """Facts come by parts; rows that were first loaded for the day before move to their own day, found through the key index."""
    t = transactions(spark, sf).select("transaction_id", "amount", "status", (F.col("is_fraud") & (F.col("transaction_id") % 4 == 0)).alias("is_flagged_fraud"),
                                       F.lit(0).cast(S.SCORE).alias("fraud_score"), "partition_date", "is_fraud")
    facts = lambda rows, day: rows.withColumn("time_sk", time_key(day)).drop("partition_date", "is_fraud")
    path, index = scratch_path(spark, "facts"), KeyIndex(scratch_path(spark, "fact-keys"))
    for part in (facts(t.where("transaction_id % 3 > 0").withColumn("amount", (F.col("amount") + 1).cast(S.AMOUNT)), F.date_sub("partition_date", 1)),
                 facts(t.where("transaction_id % 3 = 0 OR is_fraud"), F.col("partition_date")),
                 facts(t.where("transaction_id % 3 > 0 AND NOT is_fraud"), F.col("partition_date"))):
        sinks.upsert_partitions(part, path, index=index)
    return spark.read.parquet(path).select("transaction_id", "time_sk", "amount", "status", "is_flagged_fraud")


@query("append_alerts", "SELECT reason_code, count(*) AS stored, count(*) AS first_run, 0::BIGINT AS second_run FROM {alerts} GROUP BY 1")
def append_alerts(spark, sf):
    path = scratch_path(spark, "log")
    batch = alerts(transactions(spark, sf))
    first, second = sinks.append_alerts(batch, path), sinks.append_alerts(batch, path)
    pick = {name: F.create_map(*[F.lit(x) for kv in counts.items() for x in kv])[F.col("reason_code")].cast("long").alias(name)
            for name, counts in (("first_run", first), ("second_run", second))}
    return spark.read.parquet(path).groupBy("reason_code").agg(F.count("*").alias("stored")).select("reason_code", "stored", *pick.values())


@query("materialize", """
SELECT how, transaction_id, CAST(amount AS DOUBLE) AS amount FROM {t}, (SELECT unnest(['view', 'table', 'incremental']) AS how)""")
def materialize(spark, sf):
    t = transactions(spark, sf).select("transaction_id", "amount", "is_fraud")
    out = None
    for how in ("view", "table", "incremental"):
        path = scratch_path(spark, how)
        if how == "incremental":  # the first load misses the failed events, the second brings all
            sinks.materialize(t.where("not is_fraud"), how, "t", path, "transaction_id")
        part = sinks.materialize(t, how, "ledgerlens_t", path, "transaction_id").select(F.lit(how).alias("how"), "transaction_id", "amount")
        out = part if out is None else out.unionAll(part)
    return out


@query("audit_record", "SELECT 'silver_cleanse' AS job_name, 'run-' || r AS run_id, count(*) AS input_rows FROM {t}, range(1, 3) g(r) GROUP BY r")
def audit_record(spark, sf):
    path = scratch_path(spark, "audit")
    rows = transactions(spark, sf).count()
    for i in (1, 2):
        sinks.audit_record(spark, path, "silver_cleanse", f"run-{i}", input_rows=rows)
    return spark.read.json(path).select("job_name", "run_id", "input_rows")


@query("save_model", "SELECT tree, count(*) AS nodes, max(sample_size) AS sample_size, 3 AS features FROM {trees_t} GROUP BY 1")
def save_model(spark, sf):
    path = scratch_path(spark, "model")
    rows = scans.scan_features(transactions(spark, sf))
    sinks.save_model(forest.train_isolation_forest(rows), forest.fit_scaler(rows), path)
    trees, scaler = sinks.load_model(spark, path)
    return trees.groupBy("tree").agg(F.count("*").alias("nodes"), F.max("sample_size").alias("sample_size")).withColumn("features", F.lit(scaler.count()).cast("int"))


# ---------------------------------------------------------------- jobs

def _lake_with(spark, sf, last: str) -> str:
    """A lake built up to a stage once; the jobs leave the same tables when they run again."""
    order = ["bronze", "silver", "gold", "alerts"]
    if last == "bronze":
        def build():
            root = scratch_path(spark, "lake")
            jobs.run_bronze_ingest(spark, root, _days(spark, sf), as_of=AS_OF, raw_root=landed(spark, sf))
            return root
    else:
        root_before = _lake_with(spark, sf, order[order.index(last) - 1])

        def build():
            if last == "silver":
                jobs.run_silver_cleanse(spark, root_before, _days(spark, sf), as_of=AS_OF)
            elif last == "gold":
                jobs.run_gold_modeling(spark, root_before, _days(spark, sf), as_of=AS_OF)
            else:
                jobs.run_anomaly_detection(spark, root_before, _days(spark, sf), as_of=AS_OF, **THRESHOLDS)
            return root_before
    return once(spark, sf, f"lake-{last}", build)


@query("run_bronze_ingest", """
SELECT CAST(partition_date AS VARCHAR) AS partition_date, count(*) AS rows, (SELECT count(*) FROM {t}) AS input_rows,
  (SELECT count(*) FROM {t}) AS output_rows, 0::BIGINT AS blank_lines FROM {t} GROUP BY 1""")
def run_bronze_ingest(spark, sf):
    root = scratch_path(spark, "lake")
    m = jobs.run_bronze_ingest(spark, root, _days(spark, sf), as_of=AS_OF, raw_root=landed(spark, sf))
    per_day = scans.scan_layer(spark, Lake(root).bronze).groupBy("partition_date").agg(F.count("*").alias("rows"))
    return per_day.select("*", *[F.lit(m[k]).cast("long").alias(k) for k in ("input_rows", "output_rows", "blank_lines")])


@query("run_silver_cleanse", """
SELECT n AS input_rows, good AS output_rows, n - good AS rejected_rows, n - good AS invalid_rows, 0::BIGINT AS duplicate_rows,
  round(CAST(n - good AS DOUBLE) * 100.0::DOUBLE / n, 2) AS rejection_pct, good AS stored, hashes
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE ok) AS good, count(DISTINCT sha256(ip_address)) FILTER (WHERE ok) AS hashes FROM {checked})""")
def run_silver_cleanse(spark, sf):
    root = _lake_with(spark, sf, "bronze")
    m = jobs.run_silver_cleanse(spark, root, _days(spark, sf), as_of=AS_OF)
    kept = ("input_rows", "output_rows", "rejected_rows", "invalid_rows", "duplicate_rows")
    stored = spark.read.schema(S.SILVER).parquet(Lake(root).silver)
    return stored.agg(*[F.lit(m[k]).cast("long").alias(k) for k in kept], F.lit(m["rejection_pct"]).alias("rejection_pct"),
                      F.count("*").alias("stored"), F.count_distinct("ip_address_hash").alias("hashes"))


@query("run_gold_modeling", """
SELECT 'fact_transactions' AS item, count(*) AS rows FROM {silver} UNION ALL SELECT 'dim_users', count(DISTINCT user_id) FROM {silver}
UNION ALL SELECT 'dim_merchants', count(DISTINCT merchant_id) FROM {silver}
UNION ALL SELECT 'users_history', count(*) FROM (
  SELECT *, lag(country_code) OVER (PARTITION BY user_id ORDER BY partition_date) AS before FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, partition_date ORDER BY event_ts DESC, CAST(transaction_id AS VARCHAR) DESC) AS r FROM {silver}) WHERE r = 1)
  WHERE before IS NULL OR before <> country_code""")
def run_gold_modeling(spark, sf):
    lake = Lake(_lake_with(spark, sf, "gold"))
    jobs.run_gold_modeling(spark, lake.root, _days(spark, sf), as_of=AS_OF)  # once more: nothing doubles
    names = ("fact_transactions", "dim_users", "dim_merchants", "users_history")
    parts = [spark.read.parquet(lake.gold(n)).agg(F.lit(n).alias("item"), F.count("*").alias("rows")) for n in names]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


BY_DAY_ALERTS = ("SELECT * FROM {velocity_by_day} UNION ALL SELECT * FROM {high_amount_by_day} UNION ALL SELECT * FROM {geo_by_day}")


@query("run_anomaly_detection", f"""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(CAST(event_ts AS DATE) AS VARCHAR) AS alert_date, reason_code,
  round(CAST(CAST(least(raw_severity, 1.0) AS FLOAT) AS DOUBLE), 4) AS severity_score, 0::BIGINT AS second_run FROM ({BY_DAY_ALERTS})""")
def run_anomaly_detection(spark, sf):
    root = _lake_with(spark, sf, "alerts")
    again = jobs.run_anomaly_detection(spark, root, _days(spark, sf), as_of=AS_OF, **THRESHOLDS)
    log = jobs.alerts_log(spark, Lake(root)).where("reason_code <> 'ML_ANOMALY'")
    return log.select("transaction_id", "alert_date", "reason_code", "severity_score", F.lit(again["total_alerts"]).cast("long").alias("second_run"))


@query("run_ml_scoring", f"""
SELECT count(*) AS first_run, 0::BIGINT AS second_run FROM {{scored_silver}}
WHERE ml_score > 0.7 AND transaction_id NOT IN (SELECT transaction_id FROM ({BY_DAY_ALERTS}))""")
def run_ml_scoring(spark, sf):
    root = _lake_with(spark, sf, "alerts")
    first = jobs.run_ml_scoring(spark, root, _days(spark, sf), train=True, as_of=AS_OF)
    second = jobs.run_ml_scoring(spark, root, _days(spark, sf), as_of=AS_OF)
    return one_row(spark, sf, first_run=first["ml_alerts"], second_run=second["ml_alerts"])


@query("rejection_report", """
SELECT CASE WHEN partition_date < DATE '2024-01-10' THEN '2024-01-26' WHEN partition_date < DATE '2024-01-20' THEN '2024-01-28' ELSE '2024-01-30' END AS load_date,
  count(*) AS staged_rows, count(*) FILTER (WHERE partition_date <> DATE '2024-01-12') AS gold_rows,
  round(CAST(count(*) FILTER (WHERE partition_date = DATE '2024-01-12') AS DOUBLE) * 100.0::DOUBLE / count(*), 2) AS rejection_pct FROM {silver} GROUP BY 1""")
def rejection_report(spark, sf):
    """Three runs on three dates, one of them twice; a day of facts is taken away before the report."""
    root, days = scratch_path(spark, "lake"), _days(spark, sf)
    jobs.run_bronze_ingest(spark, root, days, as_of=AS_OF, raw_root=landed(spark, sf))
    jobs.run_silver_cleanse(spark, root, days, as_of=AS_OF)
    parts = [[d for d in days if d < "2024-01-10"], [d for d in days if "2024-01-10" <= d < "2024-01-20"], [d for d in days if d >= "2024-01-20"]]
    for part, load in zip([parts[0], *parts], ("2024-01-26 01:00:00", "2024-01-26 02:00:00", "2024-01-28 01:00:00", "2024-01-30 01:00:00")):
        jobs.run_gold_modeling(spark, root, part, as_of=load)
    drop_path(spark, f"{Lake(root).gold('fact_transactions')}/time_sk=20240112")
    return jobs.rejection_report(spark, root, AS_OF)


FLAGGED_SQL = f"""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, a.severity IS NOT NULL AS is_flagged_fraud, coalesce(a.severity, 0.0::DOUBLE) AS fraud_score
FROM {{silver}} LEFT JOIN (SELECT transaction_id, max(round(CAST(CAST(least(raw_severity, 1.0) AS FLOAT) AS DOUBLE), 4)) AS severity
  FROM ({BY_DAY_ALERTS}) GROUP BY 1) a USING (transaction_id)"""


@query("run_all_layers", FLAGGED_SQL)
def run_all_layers(spark, sf):
    root = scratch_path(spark, "lake")
    jobs.run_all_layers(spark, root, _days(spark, sf), as_of=AS_OF, raw_root=landed(spark, sf), **THRESHOLDS)
    return spark.read.parquet(Lake(root).gold("fact_transactions")).select("transaction_id", "is_flagged_fraud", "fraud_score")


@query("backfill", """
SELECT CAST(partition_date AS VARCHAR) AS txn_date, count(*) AS total_transactions, CAST(sum(amount) FILTER (WHERE status = 'completed') AS DOUBLE) AS daily_tpv
FROM {silver} GROUP BY 1""")
def backfill(spark, sf):
    root = scratch_path(spark, "lake")
    days = _days(spark, sf)
    jobs.run_bronze_ingest(spark, root, days, as_of=AS_OF, raw_root=landed(spark, sf))
    jobs.backfill(spark, root, days, as_of=AS_OF, **THRESHOLDS)
    return spark.read.parquet(Lake(root).gold("mart_executive_kpis")).select("txn_date", "total_transactions", "daily_tpv")


JOBS_SQL = f"""
SELECT 'silver' AS item, CAST(partition_date AS VARCHAR) AS day, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS value FROM {{silver}} GROUP BY 2
UNION ALL SELECT 'mart', CAST(partition_date AS VARCHAR), count(*), CAST(sum(amount) FILTER (WHERE status = 'completed') AS DOUBLE) FROM {{silver}} GROUP BY 2
UNION ALL SELECT 'alerts ' || reason_code, CAST(CAST(event_ts AS DATE) AS VARCHAR), count(*), 0 FROM ({BY_DAY_ALERTS}) GROUP BY 1, 2
UNION ALL SELECT 'history', CAST(partition_date AS VARCHAR), count(*), 0 FROM (
  SELECT *, lag(country_code) OVER (PARTITION BY user_id ORDER BY partition_date) AS before FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, partition_date ORDER BY event_ts DESC, CAST(transaction_id AS VARCHAR) DESC) AS r FROM {{silver}}) WHERE r = 1)
  WHERE before IS NULL OR before <> country_code GROUP BY 2"""


def _lake_content(spark, root):
    """Rows per day of what the jobs left: silver, user history by the day it holds from, alerts and the mart."""
    lake, none = Lake(root), F.lit(0.0).alias("value")
    day = F.col("day").cast("string")
    parts = [
        scans.scan_layer(spark, lake.silver, "all", S.SILVER).groupBy(F.lit("silver").alias("item"), F.col("partition_date").alias("day"))
        .agg(F.count("*").alias("rows"), F.sum("amount").cast("double").alias("value")),
        spark.read.parquet(lake.gold("mart_executive_kpis")).select(
            F.lit("mart").alias("item"), F.col("txn_date").alias("day"), F.col("total_transactions").alias("rows"), F.col("daily_tpv").cast("double").alias("value")),
        jobs.alerts_log(spark, lake).groupBy(F.concat(F.lit("alerts "), "reason_code").alias("item"), F.col("alert_date").alias("day"))
        .agg(F.count("*").alias("rows")).select("*", none),
        spark.read.parquet(lake.gold("users_history")).groupBy(F.lit("history").alias("item"), F.to_date("valid_from").alias("day"))
        .agg(F.count("*").alias("rows")).select("*", none)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).withColumn("day", day)


@query("jobs_day_by_day", JOBS_SQL)
def jobs_day_by_day(spark, sf):
    """The jobs run in steps of a few days each, in order; without a clock."""
    root, days = scratch_path(spark, "lake"), _days(spark, sf)
    jobs.run_bronze_ingest(spark, root, days, as_of=AS_OF, raw_root=landed(spark, sf))
    for part in (days[:1], days[1:2], days[2:11], days[11:]):
        jobs.backfill(spark, root, part, as_of=AS_OF, **THRESHOLDS)
    return _lake_content(spark, root)


@query("jobs_mixed", JOBS_SQL)
def jobs_mixed(spark, sf):
    """A late start: history and facts of the last days first, then all days at once."""
    root, days = scratch_path(spark, "lake"), _days(spark, sf)
    jobs.run_bronze_ingest(spark, root, days, as_of=AS_OF, raw_root=landed(spark, sf))
    late = days[20:]
    jobs.run_silver_cleanse(spark, root, late, as_of=AS_OF)
    jobs.run_gold_modeling(spark, root, late, as_of=AS_OF)
    jobs.backfill(spark, root, days, as_of=AS_OF, **THRESHOLDS)
    return _lake_content(spark, root)


# ---------------------------------------------------------------- streams

def _drain(*started) -> None:
    for q in started:
        q.awaitTermination()


@query("stream_bronze", "SELECT CAST(partition_date AS VARCHAR) AS partition_date, count(*) AS rows FROM {t} GROUP BY 1")
def stream_bronze(spark, sf):
    path, checkpoint = scratch_path(spark, "stream-bronze"), scratch_path(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        _drain(streams.start_append(streams.stream_bronze(spark, f"{landed(spark, sf)}/raw/transactions/*/*/*/*", "b"), path, checkpoint,
                                    partition_by="partition_date"))
    return scans.scan_layer(spark, path).groupBy("partition_date").agg(F.count("*").alias("rows"))


@query("stream_silver", "SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(amount AS DOUBLE) AS amount, event_ts FROM {silver}")
def stream_silver(spark, sf):
    bronze = Lake(_lake_with(spark, sf, "bronze")).bronze
    path = scratch_path(spark, "stream-silver")
    _drain(streams.start_append(streams.stream_silver(spark, bronze, AS_OF, lateness="60 days"), path, scratch_path(spark, "checkpoint"),
                                partition_by="partition_date"))
    return scans.scan_layer(spark, path).select("transaction_id", "amount", F.col("timestamp").alias("event_ts"))


def _events(spark, sf):
    layer = _layer(spark, sf)
    return spark.readStream.schema(spark.read.parquet(layer).schema).parquet(layer)


FEED_FILES, FEED_STEPS = 4, 6


def _feed(spark, sf):
    """The events as a stream of micro-batches in order of arrival, each up to half an hour late, so that many come after events of
    the next micro-batches; at the end a row without user lets the watermark pass them all."""
    def build():
        t = transactions(spark, sf)
        arrival = F.unix_seconds("timestamp") + F.pmod(F.xxhash64("transaction_id"), F.lit(1800))
        first, last = t.agg(F.min(arrival), F.max(arrival)).first()
        path, step = scratch_path(spark, "feed"), (last - first) // FEED_STEPS + 1
        for k in range(FEED_STEPS):
            # As many files for each step, and as many a trigger: one step is one micro-batch.
            t.where(F.floor((arrival - first) / step) == k).repartition(FEED_FILES).write.mode("append").parquet(path)
        end = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "timestamp" else F.timestamp_seconds(F.lit(last + 90 * 86400)).alias(f.name) for f in t.schema]
        spark.range(1).select(*end).write.mode("append").parquet(path)
        return path
    path = once(spark, sf, "feed", build)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", FEED_FILES).parquet(path)


@query("stream_velocity", "SELECT transaction_id, reason_code, round(CAST(CAST(least(raw_severity, 1.0) AS FLOAT) AS DOUBLE), 4) AS severity_score, description FROM {velocity}")
def stream_velocity(spark, sf):
    streams.use_rocksdb_state(spark)
    path = scratch_path(spark, "stream-velocity")
    _drain(streams.start_append(streams.stream_velocity(_feed(spark, sf), **VELOCITY), path, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(path).withColumn("severity_score", F.round(F.col("severity_score").cast("double"), 4))


@query("stream_geo", "SELECT transaction_id, reason_code, round(CAST(CAST(least(raw_severity, 1.0) AS FLOAT) AS DOUBLE), 4) AS severity_score FROM {geo}")
def stream_geo(spark, sf):
    streams.use_rocksdb_state(spark)
    path = scratch_path(spark, "stream-geo")
    _drain(streams.start_append(streams.stream_geo(_feed(spark, sf), **GEO), path, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(path).select("transaction_id", "reason_code", F.round(F.col("severity_score").cast("double"), 4).alias("severity_score"))


@query("stream_daily_kpis", """
SELECT CAST(partition_date AS VARCHAR) AS txn_date, count(*) AS total_transactions, count(*) FILTER (WHERE status = 'completed') AS completed_transactions,
  CAST(sum(amount) FILTER (WHERE status = 'completed') AS DOUBLE) AS daily_tpv FROM {t} GROUP BY 1""")
def stream_daily_kpis(spark, sf):
    path = scratch_path(spark, "stream-kpis")
    _drain(streams.start_upsert_days(streams.stream_daily_kpis(_events(spark, sf)), path, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(path).select("txn_date", "total_transactions", "completed_transactions", "daily_tpv")
