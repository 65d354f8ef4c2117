"""The load ledger: how many rows each partition of a table got in each hour, so that questions about the last hours need not read it.

Facts are partitioned by their transactions' day and asked by the time they were loaded, alerts by their day and the time they were
raised; neither time bounds the partition. The ledger has one row per partition and hour that has rows. Whole hours of a question
are summed from the ledger; for the rest, and for questions that need the rows themselves, it names the partitions to read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.scalars import instant

MEASURES = ("rows", "flagged", "done_rows", "done_amount")


def fact_ledger(facts: DataFrame) -> DataFrame:
    """time_sk, hour, rows, flagged, done_rows, done_amount."""
    return facts.groupBy("time_sk", F.date_trunc("hour", "created_at").alias("hour")).agg(*_measures())


def alert_ledger(alerts: DataFrame) -> DataFrame:
    """alert_date, hour, rows."""
    return alerts.groupBy("alert_date", F.date_trunc("hour", "alert_timestamp").alias("hour")).agg(F.count("*").alias("rows"))


def _measures() -> list[Column]:
    done = F.col("status") == "completed"
    return [F.count("*").alias("rows"), F.count_if("is_flagged_fraud").alias("flagged"), F.count_if(done).alias("done_rows"),
            F.sum(F.when(done, F.col("amount"))).alias("done_amount")]


def _start(as_of, days: int, hours: int) -> Column:
    return instant(as_of) - F.make_dt_interval(F.lit(days), F.lit(hours))


def _parts(ledger: DataFrame, partition: str, when: Column) -> DataFrame:
    """The partitions of some ledger rows, one row each, which is as many as there are days: small enough to broadcast."""
    return F.broadcast(ledger.where(when).select(partition).distinct())


def recent_rows(df: DataFrame, ledger: DataFrame, as_of, *, partition: str, ts: str, days: int = 0, hours: int = 0) -> DataFrame:
    """Rows whose time is at or after `as_of` minus the span, read from the partitions that the ledger names for it."""
    start = _start(as_of, days, hours)
    named = _parts(ledger, partition, F.col("hour") >= F.date_trunc("hour", start))
    return df.where(F.col(ts) >= start).join(named, partition, "left_semi")


def recent_load(facts: DataFrame, ledger: DataFrame, as_of, *, days: int = 0, hours: int = 0) -> DataFrame:
    """hour and MEASURES of the facts loaded at or after `as_of` minus the span, some rows per hour.

    Only the hour that the span begins in is read from the facts, in the partitions that have rows of it; a span that begins on the
    hour reads none.
    """
    start = _start(as_of, days, hours)
    hour = F.date_trunc("hour", start)
    within = hour < start
    next_ = F.when(within, hour + F.expr("INTERVAL '1' HOUR")).otherwise(hour)
    whole = ledger.where(F.col("hour") >= next_).select("hour", *MEASURES)
    named = _parts(ledger, "time_sk", within & (F.col("hour") == hour))
    edge = facts.where(within & (F.col("created_at") >= start) & (F.col("created_at") < next_)).join(named, "time_sk", "left_semi")
    # A partial hour has one row; typed as the ledger's so that sums of sums keep their width.
    first = edge.agg(*_measures()).select(hour.alias("hour"), *MEASURES)
    return whole.unionByName(first)


def ledger_gaps(facts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Partitions whose rows the ledger does not count right. The facts are counted by partition, no column of theirs is read."""
    counted = facts.groupBy("time_sk").agg(F.count("*").alias("there"))
    booked = ledger.groupBy("time_sk").agg(F.sum("rows").alias("booked"))
    return counted.join(booked, "time_sk", "full_outer").where(~F.col("there").eqNullSafe(F.col("booked")))
