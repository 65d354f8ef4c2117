"""Dashboard, monitoring and report queries. Every one takes its "now" as `as_of`."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions.scalars import instant, lookback, mean, percent, severity_range_label, time_key
from ledgerlens.operators.ledger import recent_load, recent_rows


def status_filter(alerts: DataFrame, statuses: tuple[str, ...] = ("open",)) -> DataFrame:
    return alerts.where(F.col("status").isin(*(statuses or ("open",))))


def _done_amount():
    return F.when(F.col("status") == "completed", F.col("amount"))


# ---------------------------------------------------------------- executive

def headline_kpis(mart: DataFrame, as_of, days: int = 30) -> DataFrame:
    zero = F.lit(0)
    return lookback(mart, "txn_date", as_of, days=days, kind="date").agg(
        F.coalesce(F.sum("daily_tpv"), zero).alias("tpv"),
        F.coalesce(F.sum("total_transactions"), zero).alias("total_txns"),
        F.coalesce(F.avg("avg_txn_value"), zero).alias("avg_txn_value"),
        F.coalesce(F.avg("fraud_rate_pct"), zero).alias("fraud_rate_pct"))


def kpis_from_fact(facts: DataFrame, as_of, days: int = 30) -> DataFrame:
    flagged = F.count_if("is_flagged_fraud")
    return lookback(facts, "time_sk", as_of, days=days, kind="key").agg(
        F.sum(_done_amount()).alias("tpv"), F.count("*").alias("total_txns"), mean(_done_amount()).alias("avg_txn_value"),
        percent(flagged, F.count("*"), 4).alias("fraud_rate_pct"))


def platform_totals(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count("*").alias("total_txns"), F.sum(_done_amount()).alias("tpv"),
                     F.count_if("is_flagged_fraud").alias("fraud_count"))


def volume_trend(facts: DataFrame, as_of, days: int = 14, ledger: DataFrame | None = None) -> DataFrame:
    """Completed volume per day of loading; with the load ledger, whole hours come from it."""
    if ledger is not None:
        loads = recent_load(facts, ledger, as_of, days=days).where(F.col("done_rows") > 0)
        return loads.groupBy(F.to_date("hour").alias("date")).agg(F.sum("done_amount").alias("daily_amount")).orderBy("date")
    recent = lookback(facts, "created_at", as_of, days=days).where(F.col("status") == "completed")
    return recent.groupBy(F.to_date("created_at").alias("date")).agg(F.sum("amount").alias("daily_amount")).orderBy("date")


def tpv_trend(mart: DataFrame, as_of, days: int = 30) -> DataFrame:
    return lookback(mart, "txn_date", as_of, days=days, kind="date").select(F.col("txn_date").alias("date"), "daily_tpv").orderBy("date")


def tpv_trend_from_fact(facts: DataFrame, calendar: DataFrame, as_of, days: int = 30) -> DataFrame:
    per_key = (lookback(facts, "time_sk", as_of, days=days, kind="key").where(F.col("status") == "completed")
               .groupBy("time_sk").agg(F.sum("amount").alias("daily_tpv")))
    return per_key.join(calendar.select("time_sk", "date"), "time_sk").select("date", "daily_tpv").orderBy("date")


def count_by(facts: DataFrame, column: str, as_of, days: int = 30) -> DataFrame:
    return (lookback(facts, "time_sk", as_of, days=days, kind="key").groupBy(column)
            .agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), column))


def mart_stat(mart: DataFrame, column: str, aggregate: str, as_of, days: int = 30, *, time: str = "txn_date", kind: str = "date") -> DataFrame:
    """A one-number panel."""
    how = {"sum": F.sum, "avg": F.avg}[aggregate]
    return lookback(mart, time, as_of, days=days, kind=kind).agg(how(column).alias("value"))


# ---------------------------------------------------------------- fraud

def recent_alert_rows(alerts: DataFrame, as_of, days: int, ledger: DataFrame | None = None) -> DataFrame:
    """Alerts raised since; with the alert ledger only the days that have such alerts are read."""
    if ledger is None:
        return lookback(alerts, "alert_timestamp", as_of, days=days)
    return recent_rows(alerts, ledger, as_of, partition="alert_date", ts="alert_timestamp", days=days)


def alert_kpis(alerts: DataFrame, as_of, days: int = 7, statuses: tuple[str, ...] = ("open", "investigating"),
               ledger: DataFrame | None = None) -> DataFrame:
    rows = status_filter(recent_alert_rows(alerts, as_of, days, ledger), statuses)
    return rows.agg(
        F.count("*").alias("total_alerts"), F.count_if(F.col("status") == "open").alias("open_alerts"),
        F.round(mean("severity_score"), 3).alias("avg_severity"), F.count_distinct("transaction_id").alias("unique_txns"))


def alerts_by_rule(alerts: DataFrame, as_of, days: int = 7, ledger: DataFrame | None = None) -> DataFrame:
    return (recent_alert_rows(alerts, as_of, days, ledger).groupBy("reason_code")
            .agg(F.count("*").alias("count"), mean("severity_score").alias("avg_severity")).orderBy(F.col("count").desc(), "reason_code"))


def alert_timeline(alerts: DataFrame, as_of, days: int = 7, ledger: DataFrame | None = None) -> DataFrame:
    return (recent_alert_rows(alerts, as_of, days, ledger)
            .groupBy(F.to_date("alert_timestamp").alias("alert_date"), "reason_code")
            .agg(F.count("*").alias("alert_count")).orderBy("alert_date", "reason_code"))


def severity_distribution(alerts: DataFrame, as_of, days: int = 7, ledger: DataFrame | None = None) -> DataFrame:
    return (recent_alert_rows(alerts, as_of, days, ledger).groupBy(severity_range_label().alias("severity_bucket"))
            .agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), "severity_bucket"))


def recent_alerts(alerts: DataFrame, as_of, days: int = 7, limit: int = 50, ledger: DataFrame | None = None) -> DataFrame:
    """The newest alerts; a top-n, so each task keeps n rows only."""
    return (recent_alert_rows(alerts, as_of, days, ledger)
            .select("alert_timestamp", "transaction_id", "reason_code", F.round("severity_score", 3).alias("severity_score"),
                    "description", "status")
            .orderBy(F.col("alert_timestamp").desc(), "transaction_id", "reason_code").limit(limit))


def open_alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("status") == "open").agg(F.count("*").alias("open_count"))


def alerts_by_country(alerts: DataFrame, facts: DataFrame, as_of, days: int = 30, limit: int = 10, ledger: DataFrame | None = None) -> DataFrame:
    """A fact's day is that of its alert or later, so facts before the first alert's day are not read."""
    recent = recent_alert_rows(alerts, as_of, days, ledger)
    per_transaction = recent.groupBy("transaction_id").agg(F.count("*").alias("_n"))
    first_day = recent.agg(time_key(F.min("alert_date"))).scalar()
    return (facts.where(F.col("time_sk") >= first_day).select("transaction_id", "country_code").join(per_transaction, "transaction_id")
            .groupBy("country_code").agg(F.sum("_n").alias("alerts"))
            .orderBy(F.col("alerts").desc(), "country_code").limit(limit))


# ---------------------------------------------------------------- health

def union_reports(parts: list[DataFrame]) -> DataFrame:
    out, *rest = parts
    for part in rest:
        out = out.unionAll(part)
    return out


def layer_counts(facts: DataFrame, alerts: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    tables = {"fact_transactions": (facts, "created_at"), "alerts_log": (alerts, "created_at"),
              "dim_users": (users.where("is_current"), "valid_from"), "dim_merchants": (merchants, "created_at")}
    return union_reports([
        df.agg(F.lit(name).alias("layer"), F.count("*").alias("row_count"), F.max(ts).alias("last_updated"))
        for name, (df, ts) in tables.items()])


def staged_vs_gold(staged: DataFrame, facts: DataFrame) -> DataFrame:
    """Staged rows with a mark whether the fact table has them."""
    known = facts.select("transaction_id", F.lit(True).alias("_in_gold"))
    return staged.join(known, "transaction_id", "left").withColumn("in_gold", F.coalesce("_in_gold", F.lit(False))).drop("_in_gold")


def rejection_rate(staged: DataFrame, facts: DataFrame, as_of, days: int = 7) -> DataFrame:
    recent = lookback(staged.select("transaction_id", "loaded_at"), "loaded_at", as_of, days=days)
    lost = F.count_if(~F.col("in_gold"))
    return (staged_vs_gold(recent, facts).groupBy(F.to_date("loaded_at").alias("load_date"))
            .agg(F.count("*").alias("staged_rows"), F.count_if("in_gold").alias("gold_rows"),
                 percent(lost, F.count("*"), 2).alias("rejection_pct")).orderBy(F.col("load_date").desc()))


def staged_log_rejections(log: DataFrame, facts: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The same over the log of all runs. Load dates before the span are not read, nor facts before the first staged day: a row
    that came again later is a fact of that later day."""
    start = instant(as_of) - F.make_dt_interval(F.lit(days))
    recent = lookback(log.where(F.col("load_date") >= F.to_date(start)), "loaded_at", as_of, days=days)
    first_day = recent.agg(F.min("time_sk")).scalar()
    # A key that several runs of one date staged counts once, by its newest time.
    once = recent.groupBy("load_date", "transaction_id").agg(F.max("loaded_at").alias("loaded_at")).drop("load_date")
    return rejection_rate(once, facts.where(F.col("time_sk") >= first_day), as_of, days)


def _load_since(facts: DataFrame, ledger: DataFrame | None, as_of, hours: int) -> DataFrame:
    """rows and flagged of the facts loaded in the last hours, one row."""
    if ledger is None:
        return lookback(facts, "created_at", as_of, hours=hours).agg(F.count("*").alias("rows"), F.count_if("is_flagged_fraud").alias("flagged"))
    zero = F.lit(0).cast("long")
    return recent_load(facts, ledger, as_of, hours=hours).agg(
        F.coalesce(F.sum("rows"), zero).alias("rows"), F.coalesce(F.sum("flagged"), zero).alias("flagged"))


def fraud_rate_window(facts: DataFrame, as_of, hours: int = 24, digits: int = 4, ledger: DataFrame | None = None) -> DataFrame:
    return _load_since(facts, ledger, as_of, hours).select(percent(F.col("flagged"), F.col("rows"), digits).alias("fraud_rate_pct"))


def ingest_gauge(facts: DataFrame, as_of, hours: int = 24, target: int = 10_000, ledger: DataFrame | None = None) -> DataFrame:
    share = F.col("rows").cast("double") / F.lit(float(target)) * 100.0
    return _load_since(facts, ledger, as_of, hours).select("rows", F.least(share, F.lit(100.0)).alias("pct_of_target"))


def freshness(facts: DataFrame) -> DataFrame:
    return facts.agg(F.max("created_at").alias("last_updated"))


def _monitor(value_row: DataFrame, name: str, threshold: float, *, above: bool) -> DataFrame:
    value = F.col("value").cast("double")
    broken = value > threshold if above else value < threshold
    return value_row.select(F.lit(name).alias("monitor"), value.alias("value"), F.lit(float(threshold)).alias("threshold"),
                            F.coalesce(broken, F.lit(False)).alias("breached"))


def monitor_low_ingest(facts: DataFrame, as_of, hours: int = 1, minimum: int = 100, ledger: DataFrame | None = None) -> DataFrame:
    return _monitor(_load_since(facts, ledger, as_of, hours).select(F.col("rows").alias("value")), "low_ingest", minimum, above=False)


def monitor_fraud_spike(facts: DataFrame, as_of, hours: int = 1, maximum: float = 10.0, ledger: DataFrame | None = None) -> DataFrame:
    rate = fraud_rate_window(facts, as_of, hours, 2, ledger).withColumnRenamed("fraud_rate_pct", "value")
    return _monitor(rate, "fraud_spike", maximum, above=True)


def monitor_open_backlog(alerts: DataFrame, as_of, hours: int = 24, maximum: int = 50) -> DataFrame:
    stale = alerts.where((F.col("status") == "open") & (F.col("alert_timestamp") < instant(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))))
    return _monitor(stale.agg(F.count("*").alias("value")), "open_backlog", maximum, above=True)


def backfill_report(facts: DataFrame, mart: DataFrame, users: DataFrame) -> DataFrame:
    return union_reports([
        facts.agg(F.lit("fact_transactions").alias("item"), F.count("*").alias("total")),
        mart.agg(F.lit("mart_executive_kpis").alias("item"), F.count("*").alias("total")),
        users.where("is_current").agg(F.lit("current_users").alias("item"), F.count_distinct("user_id").alias("total"))])


def limit_rows(df: DataFrame, n: int, order: list) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def time_sk_floor(as_of, days: int = 30):
    """The smallest yyyymmdd key of a lookback."""
    return time_key(F.to_date(instant(as_of) - F.make_dt_interval(F.lit(days))))
