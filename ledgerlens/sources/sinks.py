"""Writers: layer tables, staging, the alert log, the fact table, models and audit lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerlens import schemas as S
from ledgerlens.operators.ledger import alert_ledger
from ledgerlens.operators.model import incremental_upsert, keep_flags
from ledgerlens.session import drop_path, scratch
from ledgerlens.sources.key_index import KeyIndex
from ledgerlens.sources.scans import path_exists, scan_or_empty


def _write_counted(df: DataFrame, write) -> int:
    """Write and return the number of rows, counted in the same pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _by_partition(df: DataFrame, partition: str, many: bool) -> DataFrame:
    """Gather rows of many table partitions into files of even size; a hot partition is split.

    A single partition needs no shuffle: each task writes one file of it.
    """
    return df.hint("rebalance", partition) if many else df


def write_bronze(df: DataFrame, path: str, *, many_days: bool = False) -> int:
    return _write_counted(_by_partition(df, "partition_date", many_days),
                          lambda d: d.write.mode("append").partitionBy("partition_date").parquet(path))


def replace_partitions(df: DataFrame, path: str, partition: str, *, many: bool = False) -> int:
    """Replace the partitions present in `df`, keep all others."""
    return _write_counted(_by_partition(df, partition, many), lambda d: d.write.mode("overwrite")
                          .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def replace_days(df: DataFrame, path: str, days: list, partition: str = "partition_date", *, many: bool = False) -> int:
    """Replace the named partitions; one that gets no row is removed. Days found in the rows but not named are replaced too."""
    spark, got = df.sparkSession, Observation()
    counted = _by_partition(df, partition, many).observe(got, F.count(F.lit(1)).alias("rows"), F.collect_set(partition).alias("days"))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    filled = {str(d) for d in got.get["days"]}
    _drop_partitions(spark, path, partition, [d for d in days if str(d) not in filled])
    return got.get["rows"]


def write_silver(df: DataFrame, path: str, *, many_days: bool = False, days: list | None = None) -> int:
    return replace_days(df, path, days or [], many=many_days)


def write_staging(df: DataFrame, target: str, *, jdbc: dict | None = None) -> int:
    """Overwrite a staging table and return its row count; `jdbc` sends it to a database instead."""
    if jdbc is None:
        return _write_counted(df, lambda d: d.write.mode("overwrite").parquet(target))
    return _write_counted(df, lambda d: d.write.format("jdbc").options(**{"batchsize": "1000", "truncate": "true", **jdbc})
                          .option("dbtable", target).mode("overwrite").save())


def log_staged(staged: DataFrame, path: str) -> None:
    """Keep which rows a run staged, by load date; staging itself holds the last run only. A repeated run adds its keys again, which readers count once."""
    rows = staged.select("transaction_id", "time_sk", "loaded_at", F.to_date("loaded_at").alias("load_date"))
    rows.write.mode("append").partitionBy("load_date").parquet(path)


def overwrite_table(df: DataFrame, path: str) -> int:
    """Overwrite a table that `df` does not read from."""
    return _write_counted(df, lambda d: d.write.mode("overwrite").parquet(path))


def rewrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Overwrite a table that `df` may read from: the rows are staged first."""
    def write(d):
        writer = d.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    with scratch(df.sparkSession) as keep:
        return _write_counted(keep(df, "rewrite"), write)


def append_alerts(alerts: DataFrame, path: str, *, one_per_transaction: bool = False, ledger_path: str | None = None) -> dict[str, int]:
    """Append the alerts that the log does not hold yet; a re-run adds nothing. The days it touches are booked in the alert ledger, if one is named.

    The batch is evaluated once. Only the days it touches are read from the log.
    With `one_per_transaction`, a transaction that has any alert gets no further one.
    """
    with scratch(alerts.sparkSession) as keep:
        batch = keep(alerts, "alerts")
        days = [r[0] for r in batch.select("alert_date").distinct().collect()]
        counts = _append_alerts(batch, path, one_per_transaction, days)
        if ledger_path and days:
            log = scan_or_empty(batch.sparkSession, path, S.ALERTS).where(F.col("alert_date").isin(days))
            replace_days(alert_ledger(log), ledger_path, days, "alert_date")
        return counts


def _append_alerts(batch: DataFrame, path: str, one_per_transaction: bool, days: list) -> dict[str, int]:
    spark = batch.sparkSession
    log = scan_or_empty(spark, path, S.ALERTS)
    if one_per_transaction:
        fresh = batch.join(log.select("transaction_id"), "transaction_id", "left_anti")
    else:
        known = log.where(F.col("alert_date").isin(days)) if days else log.limit(0)
        fresh = batch.join(known.select("alert_id"), "alert_id", "left_anti")
    seen = Observation()
    per_reason = [F.count_if(F.col("reason_code") == r).alias(r) for r in S.REASON_CODES]
    (fresh.observe(seen, *per_reason).write.mode("append").partitionBy("alert_date").parquet(path))
    return {r: seen.get[r] for r in S.REASON_CODES}


def upsert_partitions(batch: DataFrame, path: str, key: str = "transaction_id", partition: str = "time_sk", *,
                      keep_fraud_flags: bool = True, whole: list | None = None, index: KeyIndex | None = None) -> tuple[int, list]:
    """Insert or replace rows by key, rewriting only the partitions that change.

    A key may already sit in another partition than the batch row. With an `index`, only partitions that it names for
    keys of the batch are looked into (a table without one is indexed first); else the key column of the whole target
    is. Returns the rows written and the partitions touched.

    `whole` names partitions that the batch holds completely: their other rows go, and a
    key that the target holds in a later partition, outside of `whole`, stays there. The
    result then does not depend on the order or grouping in which partitions come.
    """
    with scratch(batch.sparkSession) as keep:
        return _upsert(keep(batch, "upsert-batch"), path, key, partition, keep_fraud_flags, whole, index, keep)


def _upsert(incoming: DataFrame, path: str, key: str, partition: str, keep_fraud_flags: bool, whole: list | None, index: KeyIndex | None, keep) -> tuple[int, list]:
    spark = incoming.sparkSession
    if not path_exists(spark, path):
        if index:
            index.build(incoming.select(key, partition))
        found = sorted(r[0] for r in incoming.select(partition).distinct().collect())
        return replace_partitions(incoming, path, partition, many=len(found) > 1), found
    schema = T.StructType([f for f in incoming.schema if f.name != partition] + [incoming.schema[partition]])
    target = spark.read.schema(schema).parquet(path)
    holding = _held(target, incoming, key, partition, index, keep)
    if whole is not None:
        elsewhere = keep(holding.where(~F.col(partition).isin(whole)).groupBy(key).agg(F.max(partition).alias("_held")), "held")
        incoming = incoming.join(elsewhere, key, "left").where(F.col("_held").isNull() | (F.col("_held") < F.col(partition))).drop("_held")
        moved = elsewhere.join(incoming.select(key), key, "left_semi").select("_held")
        holding = holding.join(moved.distinct(), F.col("_held") == F.col(partition), "left_semi")
    # One row per partition at most.
    touched = {r[0] for r in holding.select(partition).union(incoming.select(partition)).distinct().collect()} | set(whole or [])
    slice_ = target.where(F.col(partition).isin(list(touched)))
    if keep_fraud_flags:
        incoming = keep_flags(incoming, slice_, key)
    left = slice_ if whole is None else slice_.where(~F.col(partition).isin(whole))
    merged = keep(incremental_upsert(left, incoming, key), "upsert")
    rows = replace_days(merged, path, sorted(touched), partition, many=len(touched) > 1)
    return rows, sorted(touched)


def _held(target: DataFrame, incoming: DataFrame, key: str, partition: str, index: KeyIndex | None, keep) -> DataFrame:
    """(key, partition) of the target's rows whose key the batch has."""
    if index is not None:
        spark = target.sparkSession
        if not index.is_built(spark):
            index.build(target.select(key, partition))
        known = keep(index.lookup(incoming), "known-keys")
        # The index is ahead of the table at any time: what it lacks is not there.
        index.add(incoming, known)
        # One value per partition at most.
        target = target.where(F.col(partition).isin([r[0] for r in known.select(partition).distinct().collect()]))
    return target.select(key, partition).join(incoming.select(key), key, "left_semi")


def _drop_partitions(spark: SparkSession, path: str, partition: str, values: list) -> None:
    """Remove partitions that lost their last row; dynamic overwrite leaves them in place."""
    for value in values:
        drop_path(spark, f"{path.rstrip('/')}/{partition}={value}")


def materialize(df: DataFrame, how: str, name: str, path: str | None = None, key: str | None = None) -> DataFrame:
    """Publish a model as a view, a table, or an incrementally updated table."""
    spark = df.sparkSession
    if how == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if how == "table":
        rewrite_table(df, path)
    elif how == "incremental":
        if path_exists(spark, path):
            rewrite_table(incremental_upsert(spark.read.parquet(path), df, key), path)
        else:
            df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown materialization {how!r}")
    return spark.read.parquet(path)


def audit_record(spark: SparkSession, path: str, job: str, run_id: str, **metrics) -> dict:
    """Append one JSON line about a run."""
    entry = {"job_name": job, "run_id": run_id, "timestamp": dt.datetime.now(dt.timezone.utc).isoformat(), **metrics}
    columns = [F.lit(v).alias(k) for k, v in entry.items()]
    spark.range(1, numPartitions=1).select(*columns).write.mode("append").json(path)
    return entry


def save_model(nodes: DataFrame, scaler: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{path}/trees")
    scaler.write.mode("overwrite").parquet(f"{path}/scaler")


def load_model(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    if not path_exists(spark, f"{path}/trees"):
        raise FileNotFoundError(f"no trained model under {path}; train one first")
    return spark.read.parquet(f"{path}/trees"), spark.read.parquet(f"{path}/scaler")
