"""Star schema: staging shapes, dimensions, user history, facts, flags and marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerlens import schemas as S
from ledgerlens.functions.scalars import (as_col, day_literal, instant, mean, percent, severity_bucket, surrogate_key, time_key)
from ledgerlens.operators.skew import HEAVY_ROWS, count_per_key, heavy_keys, salted_join
from ledgerlens.operators.windows import distinct_on, rolling_over_days

# ---------------------------------------------------------------- calendar


def calendar(spark: SparkSession, first="2020-01-01", last="2030-12-31") -> DataFrame:
    """One row per day between two dates, both included."""
    span = F.sequence(day_literal(first), day_literal(last), F.expr("INTERVAL '1' DAY"))
    return spark.range(1).select(F.explode(span).alias("date"))


def calendar_of_keys(df: DataFrame, key: str = "time_sk") -> DataFrame:
    """The days that a table has rows of, from its yyyymmdd key: with the key as partition column, no data is read."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().select(F.to_date(F.col(key).cast("string"), "yyyyMMdd").alias("date"))


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """The calendar that spans a time column of a table."""
    span = df.agg(F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last"))
    return span.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL '1' DAY"))).alias("date"))


def dim_time(days: DataFrame) -> DataFrame:
    d = F.col("date")
    iso_day = F.weekday(d) + 1
    return days.select(
        time_key(d).alias("time_sk"), "date",
        *[part(d).cast("short").alias(name) for name, part in
          (("year", F.year), ("month", F.month), ("day", F.dayofmonth), ("quarter", F.quarter))],
        iso_day.cast("short").alias("day_of_week"), (iso_day >= 6).alias("is_weekend"), F.lit(False).alias("is_holiday"),
        F.rpad(F.date_format(d, "MMMM"), 9, " ").alias("month_name"), F.weekofyear(d).cast("short").alias("week_of_year"))


# ---------------------------------------------------------------- staging

def _loaded(df: DataFrame, as_of) -> DataFrame:
    return df if as_of is None else df.withColumn("loaded_at", instant(as_of))


def stage_fact(silver: DataFrame, as_of=None) -> DataFrame:
    kept = ["amount", "currency", "transaction_type", "status", "payment_method"]
    # The silver stamp travels along as the fact's load watermark.
    stamp = [c for c in ("_silver_processed_at",) if c in silver.columns]
    return _loaded(silver.select(
        "transaction_id", "user_id", "merchant_id", time_key("partition_date").alias("time_sk"), *kept,
        F.lit(False).alias("is_flagged_fraud"), F.lit(0).cast(S.SCORE).alias("fraud_score"),
        "latitude", "longitude", "country_code", *stamp), as_of)


def stage_users(silver: DataFrame, as_of=None, order: list[Column] | None = None) -> DataFrame:
    """One row per user, from their newest transaction; absent profile columns become NULL."""
    newest = order or [F.col("timestamp").desc_nulls_last(), F.col("transaction_id").desc_nulls_last()]
    optional = [F.col(c) if c in silver.columns else F.lit(None).cast("string").alias(c) for c in ("email_hash", "risk_tier")]
    used = [c for c in ("user_id", "country_code", "email_hash", "risk_tier", "timestamp", "transaction_id") if c in silver.columns]
    return _loaded(distinct_on(silver.select(*used), ["user_id"], newest).select("user_id", "country_code", *optional), as_of)


def stage_users_by_day(silver: DataFrame) -> DataFrame:
    """One row per user and day, from the user's newest transaction of the day."""
    order = [F.col("timestamp").desc_nulls_last(), F.col("transaction_id").desc_nulls_last()]
    optional = [F.col(c) if c in silver.columns else F.lit(None).cast("string").alias(c) for c in ("email_hash", "risk_tier")]
    one = distinct_on(silver, ["user_id", "partition_date"], order)
    return one.select("partition_date", "user_id", "country_code", *optional)


def stage_merchants(silver: DataFrame, as_of=None) -> DataFrame:
    return _loaded(distinct_rows(silver, ["merchant_id", "mcc_code", "country_code"]), as_of)


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def stg_transactions(staged: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One row per transaction, newest load first, with flag and score defaults."""
    order = order or [F.col("loaded_at").desc_nulls_last(), F.xxhash64(*staged.columns)]
    return distinct_on(staged, ["transaction_id"], order).withColumns({
        "is_flagged_fraud": F.coalesce("is_flagged_fraud", F.lit(False)),
        "fraud_score": F.coalesce(F.col("fraud_score").cast(S.SCORE), F.lit(0).cast(S.SCORE))})


def stg_users(staged: DataFrame, order: list[Column] | None = None) -> DataFrame:
    order = order or [F.col("loaded_at").desc_nulls_last(), F.xxhash64(*staged.columns)]
    defaults = {"country_code": "XX", "email_hash": "", "risk_tier": "low"}
    one = distinct_on(staged, ["user_id"], order)
    return one.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def stg_merchants(staged: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One row per merchant; the smallest (mcc, country) pair among equally old rows."""
    order = order or [F.col("loaded_at").desc_nulls_last(), F.col("mcc_code"), F.col("country_code")]
    name = F.coalesce("merchant_name", F.lit("Unknown")) if "merchant_name" in staged.columns else F.lit("Unknown")
    return distinct_on(staged, ["merchant_id"], order).withColumn("merchant_name", name)


# ---------------------------------------------------------------- user history

def scd2_snapshot(history: DataFrame, incoming: DataFrame, key: str = "user_id",
                  tracked: tuple[str, ...] = ("email_hash", "risk_tier", "country_code"), *, as_of,
                  strategy: str = "check", updated_at: str = "updated_at", hard_deletes: bool = True) -> DataFrame:
    """The full history after one more batch of current rows.

    `check` opens a version when a tracked column differs (NULLs compare as equal);
    `timestamp` when the incoming row is newer. Keys that vanished are closed if
    `hard_deletes`. Applying a batch twice changes nothing.
    """
    if strategy not in ("check", "timestamp"):
        raise ValueError(f"unknown strategy {strategy!r}")
    now = instant(as_of)
    stamp = F.col(updated_at) if strategy == "timestamp" else now
    batch = distinct_on(incoming, [key], [F.col(updated_at).desc_nulls_last(), F.xxhash64(*incoming.columns)]
                        if updated_at in incoming.columns else [F.xxhash64(*incoming.columns)])
    new = batch.select(F.col(key).alias("_k"), F.struct(*tracked, stamp.alias("updated_at")).alias("_new"))
    is_open = F.col("valid_to").isNull()
    old = history.where(is_open).select(F.col(key).alias("_old_k"), F.struct(*history.columns).alias("_old"))

    joined = old.join(new, F.col("_old_k") == F.col("_k"), "full_outer")
    had, has = F.col("_old_k").isNotNull(), F.col("_k").isNotNull()
    if strategy == "check":
        differs = ~F.lit(True)
        for c in tracked:
            differs = differs | ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    else:
        differs = F.col("_new.updated_at") > F.col("_old.updated_at")
    since = F.col("_new.updated_at")
    opened = F.struct(*[_history_field(c, key, tracked, since) for c in history.columns])
    closed = F.col("_old").withField("valid_to", F.coalesce(since, now))
    versions = (
        F.when(had & has & ~differs, F.array("_old"))
        .when(had & has, F.array(closed, opened))
        .when(had, F.array(closed if hard_deletes else F.col("_old")))
        .otherwise(F.array(opened)))
    return history.where(~is_open).unionByName(joined.select(F.inline(versions)))


def _history_field(column: str, key: str, tracked, since: Column) -> Column:
    value = {
        key: F.col("_k"),
        "updated_at": since,
        "valid_from": since,
        "valid_to": F.lit(None).cast("timestamp"),
        "scd_id": F.md5(F.concat_ws("|", F.col("_k").cast("string"), since.cast("string"))),
        **{c: F.col(f"_new.{c}") for c in tracked},
    }
    return value[column].alias(column)


def scd2_from_days(history: DataFrame, daily: DataFrame, key: str = "user_id",
                   tracked: tuple[str, ...] = ("email_hash", "risk_tier", "country_code"), day: str = "partition_date", full_days: list = ()) -> DataFrame:
    """The history after many days at once: what applying `scd2_snapshot` day by day
    gives (with hard deletes on `full_days`, without on others), in one window per key instead of a rewrite per day.
    Days up to the start of a key's open version are already in the history and are
    left out, so applying the same days again changes nothing.

    `daily` holds at most one row per key and day, so a window group has at most one
    row per day and the open row. A key is closed by the first of `full_days` after one of its
    rows that comes before its next row: on a full day, all keys that are left have a row.
    """
    is_open = F.col("valid_to").isNull()
    since = F.col(day).cast("timestamp")
    steps = daily.select(key, *tracked, since.alias("updated_at"), since.alias("valid_from"), F.lit(False).alias("_old"),
                         F.lit(None).cast("string").alias("scd_id"))
    start = history.where(is_open).select(key, *tracked, "updated_at", "valid_from", F.lit(True).alias("_old"), "scd_id")
    order = Window.partitionBy(key).orderBy(F.col("_old").desc(), "valid_from")
    known_until = F.max(F.when(F.col("_old"), F.col("valid_from"))).over(Window.partitionBy(key))
    fresh = F.col("_old") | F.col("_known").isNull() | (F.col("valid_from") > F.col("_known"))
    rows = _next_full_day(start.unionByName(steps), full_days).withColumn("_known", known_until).where(fresh)
    following = F.lead("valid_from").over(order)
    rows = rows.withColumn("_closed", F.when(following.isNull() | (F.col("_full") < following), F.col("_full")))
    rows = rows.withColumns({
        "_before": F.lag(F.struct(*tracked)).over(order), "_gap": F.lag("_closed").over(order).isNotNull(),
        "_end": F.min("_closed").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    opens = rows.where(F.col("_old") | F.col("_gap") | F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.struct(*tracked)))
    versions = opens.withColumns({
        "valid_to": F.least("_end", F.lead("valid_from").over(order)),
        "scd_id": F.coalesce("scd_id", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col("valid_from").cast("string"))))})
    return history.where(~is_open).unionByName(versions.select(*history.columns))


def _next_full_day(rows: DataFrame, full_days: list) -> DataFrame:
    """Adds `_full`, the first full day after a row's start. The lookup has one row per calendar day from the first full day to the last."""
    if not full_days:
        return rows.withColumn("_full", F.lit(None).cast("timestamp"))
    full = sorted(set(full_days))
    before = full[0] - dt.timedelta(days=1)
    spans = rows.sparkSession.createDataFrame(list(zip([before, *full[:-1]], full)), "start date, until date")
    lookup = spans.select(F.explode(F.sequence("start", F.date_sub("until", 1))).alias("_at"), F.col("until").cast("timestamp").alias("_full"))
    return rows.withColumn("_at", F.greatest(F.to_date("valid_from"), F.lit(before))).join(F.broadcast(lookup), "_at", "left").drop("_at")


def scd2_rebuild(history: DataFrame, daily: DataFrame, first_day, key: str = "user_id",
                 tracked: tuple[str, ...] = ("email_hash", "risk_tier", "country_code"), day: str = "partition_date", full_days: list = ()) -> DataFrame:
    """The history made anew from a day on; `daily` holds the profiles of all days from `first_day`, `full_days` those that list all users.

    What the history says up to `first_day` stays, the version open at that time is taken up
    again. So days may come in any order and grouping and be repeated: the result is that of
    all days at once.
    """
    start = day_literal(first_day).cast("timestamp")
    known = history.where(F.col("valid_from") < start).withColumn("valid_to", F.when(F.col("valid_to") < start, F.col("valid_to")))
    later = [d for d in full_days if str(d) >= str(first_day)]
    return scd2_from_days(known, daily.where(F.col(day) >= day_literal(first_day)), key, tracked, day, later)


def full_listing(profiles: DataFrame, day, key: str = "user_id") -> DataFrame:
    """A full entity as events of its day: one row per key, and one row without a key that marks the day as full, so that an empty entity counts too."""
    listed = distinct_on(profiles.where(F.col(key).isNotNull()), [key], [F.xxhash64(*profiles.columns)])
    mark = profiles.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in profiles.schema])
    return listed.unionByName(mark).withColumn("partition_date", day_literal(day))


def daily_profiles(seen: DataFrame, listed: DataFrame, full_days: list, key: str = "user_id") -> DataFrame:
    """One profile per key and day: that of the full entity on full days, that of the transactions on others."""
    columns = seen.columns
    by_transactions = seen.where(~F.col("partition_date").isin(full_days)) if full_days else seen
    return by_transactions.unionByName(listed.where(F.col(key).isNotNull()).select(*columns))


def profile_for_history(staged: DataFrame, *extra: str) -> DataFrame:
    """Staged users as history input: a missing hash is derived, a missing tier is low."""
    return staged.select(
        *extra, "user_id", F.coalesce("email_hash", F.md5(F.col("user_id").cast("string"))).alias("email_hash"),
        F.coalesce("risk_tier", F.lit("low")).alias("risk_tier"), "country_code")


def dim_users(history: DataFrame, as_of=None) -> DataFrame:
    registered = instant(as_of) if as_of is not None else F.col("valid_from")
    return history.where(F.col("valid_to").isNull()).select(
        surrogate_key("user_id").alias("user_sk"), "user_id", "email_hash", registered.alias("registration_date"),
        "risk_tier", "country_code", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), "scd_id")


def dim_merchants(staged: DataFrame, as_of, raw_merchants: DataFrame | None = None) -> DataFrame:
    """Merchants with keys; with the raw merchant entity also their real names and risk."""
    base = staged
    if raw_merchants is not None:
        known = distinct_on(raw_merchants, ["merchant_id"], [F.xxhash64(*raw_merchants.columns)])
        base = base.join(known.select("merchant_id", F.col("merchant_name").alias("_name"), F.col("risk_score").alias("_risk")),
                         "merchant_id", "left")
        name, risk = F.coalesce("_name", "merchant_name"), F.coalesce("_risk", F.lit(0))
    else:
        name, risk = F.col("merchant_name"), F.lit(0)
    return base.select(
        surrogate_key("merchant_id").alias("merchant_sk"), "merchant_id", name.alias("merchant_name"), "mcc_code",
        "country_code", risk.cast(S.SCORE).alias("risk_score"), instant(as_of).alias("created_at"))


# ---------------------------------------------------------------- facts

def _key_lookup(facts: DataFrame, keys: DataFrame, key: str, spread_heavy: bool, heavy_rows: int, counted: DataFrame | None) -> DataFrame:
    """Left join of a surrogate key. Spark broadcasts `keys` while it is below the
    broadcast limit; beyond that both sides shuffle and heavy keys are spread. The keys are
    counted in `counted`, which holds at least the facts' rows, so that what made the facts is not run again."""
    if not spread_heavy:
        return facts.join(keys, key, "left")
    heavy = heavy_keys(count_per_key(facts if counted is None else counted, key), key, min_rows=heavy_rows)
    return salted_join(facts, keys, key, "left", heavy, F.col("transaction_id"))


def fact_user_key(facts: DataFrame, users: DataFrame, spread_heavy: bool = False, heavy_rows: int = HEAVY_ROWS, counted: DataFrame | None = None) -> DataFrame:
    current = users.where("is_current").select("user_id", "user_sk")
    return _key_lookup(facts, current, "user_id", spread_heavy, heavy_rows, counted)


def fact_merchant_key(facts: DataFrame, merchants: DataFrame, spread_heavy: bool = False, heavy_rows: int = HEAVY_ROWS, counted: DataFrame | None = None) -> DataFrame:
    return _key_lookup(facts, merchants.select("merchant_id", "merchant_sk"), "merchant_id", spread_heavy, heavy_rows, counted)


def drop_unresolved_keys(df: DataFrame, keys: tuple[str, ...] = ("user_sk", "merchant_sk")) -> DataFrame:
    return df.dropna(subset=list(keys))


def filter_by_watermark(source: DataFrame, target: DataFrame | None, column: str = "_silver_processed_at",
                        target_column: str = "created_at") -> DataFrame:
    """Rows newer than the newest row of the target; all rows while the target is empty."""
    if target is None:
        return source
    newest = target.agg(F.max(target_column)).scalar()
    return source.where(newest.isNull() | (F.col(column) > newest))


def fct_transactions(staged: DataFrame, users: DataFrame, merchants: DataFrame, *, target: DataFrame | None = None,
                     spread_heavy: bool = False, heavy_rows: int = HEAVY_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Facts with resolved keys. `created_at` keeps the silver stamp, so that the next
    incremental run can tell what is new. `counted`: a stored table with all rows of `staged`, copies too, to find heavy keys in."""
    fresh = filter_by_watermark(staged, target)
    counted = fresh if counted is None else counted
    keyed = fact_user_key(fresh, users, spread_heavy, heavy_rows, counted)
    keyed = fact_merchant_key(keyed, merchants, spread_heavy, heavy_rows, counted)
    derived = time_key(F.to_date("_silver_processed_at"))
    return drop_unresolved_keys(keyed).select(
        "transaction_id", "user_sk", "merchant_sk", F.coalesce("time_sk", derived).alias("time_sk"), "amount", "currency",
        "transaction_type", "status", "payment_method", F.coalesce("is_flagged_fraud", F.lit(False)).alias("is_flagged_fraud"),
        F.coalesce("fraud_score", F.lit(0).cast(S.SCORE)).alias("fraud_score"), "latitude", "longitude", "country_code",
        F.col("_silver_processed_at").alias("created_at"))


def incremental_upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the batch, and the batch. Columns must agree."""
    if set(target.columns) != set(batch.columns):
        raise ValueError(f"schema change: {sorted(set(target.columns) ^ set(batch.columns))}")
    return target.join(batch.select(key), key, "left_anti").unionByName(batch)


def keep_flags(batch: DataFrame, target: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Carry fraud flags already set in the target over to re-staged rows."""
    flagged = target.where("is_flagged_fraud").select(key, F.lit(True).alias("_was"), F.col("fraud_score").alias("_score"))
    return batch.join(flagged, key, "left").withColumns({
        "is_flagged_fraud": F.col("is_flagged_fraud") | F.coalesce("_was", F.lit(False)),
        "fraud_score": F.greatest("fraud_score", F.coalesce("_score", F.lit(0).cast(S.SCORE)))}).select(*batch.columns)


def worst_open_alert(alerts: DataFrame, day=None) -> DataFrame:
    """The highest severity per transaction among open alerts, of one day if given."""
    rows = alerts.where(F.col("status") == "open")
    if day is not None:
        rows = rows.where(F.col("alert_date") == day_literal(day))
    return rows.groupBy("transaction_id").agg(F.max("severity_score").alias("_severity"))


def flag_join(facts: DataFrame, alerts: DataFrame, day=None) -> DataFrame:
    return facts.join(worst_open_alert(alerts, day), "transaction_id", "left")


def apply_fraud_flags(facts: DataFrame, alerts: DataFrame, day=None) -> DataFrame:
    """Flag the facts that have an open alert and score them with the worst one."""
    joined = flag_join(facts, alerts, day)
    return joined.withColumns({
        "is_flagged_fraud": F.col("is_flagged_fraud") | F.col("_severity").isNotNull(),
        "fraud_score": F.coalesce(F.col("_severity").cast(S.SCORE), F.col("fraud_score"))}).select(*facts.columns)


# ---------------------------------------------------------------- marts

def fact_calendar(facts: DataFrame, days: DataFrame) -> DataFrame:
    """Facts with their calendar row. One row per day, so Spark broadcasts the calendar by size."""
    return facts.join(days, "time_sk", "inner")


def daily_kpis(dated: DataFrame, day: str = "date") -> DataFrame:
    done = F.col("status") == "completed"
    flagged = F.count_if(F.col("is_flagged_fraud"))
    return dated.groupBy(F.col(day).alias("txn_date")).agg(
        F.count("transaction_id").alias("total_transactions"),
        F.count_if(done & F.col("transaction_id").isNotNull()).alias("completed_transactions"),
        F.sum(F.when(done, F.col("amount"))).alias("daily_tpv"),
        mean(F.when(done, F.col("amount"))).alias("avg_txn_value"),
        flagged.alias("fraud_alerts"),
        percent(flagged, F.count("*"), 4).alias("fraud_rate_pct"))


def with_rolling_kpis(daily: DataFrame, calendar_days: bool = False) -> DataFrame:
    return daily.withColumns({
        "tpv_30d": rolling_over_days(daily, "daily_tpv", F.sum, 30, "txn_date", calendar_days),
        "fraud_rate_7d_avg": rolling_over_days(daily, "fraud_rate_pct", F.avg, 7, "txn_date", calendar_days)})


def mart_executive_kpis(facts: DataFrame, days: DataFrame, calendar_days: bool = False) -> DataFrame:
    # Facts collapse to one row per day before they meet the calendar.
    per_key = daily_kpis(facts, "time_sk").withColumnRenamed("txn_date", "time_sk")
    daily = fact_calendar(per_key, days.select("time_sk", F.col("date").alias("txn_date"))).drop("time_sk")
    return with_rolling_kpis(daily.select("txn_date", *[c for c in daily.columns if c != "txn_date"]), calendar_days)


def refresh_executive_kpis(mart: DataFrame, facts: DataFrame, days: DataFrame, changed: list[int]) -> DataFrame:
    """The mart after some days of the fact table changed: only those days are aggregated
    again (the list prunes partitions), the rolling columns run over the days' rows."""
    fresh = mart_executive_kpis(facts.where(F.col("time_sk").isin(changed)), days).drop("tpv_30d", "fraud_rate_7d_avg")
    kept = mart.where(~time_key("txn_date").isin(changed)).select(*fresh.columns)
    return with_rolling_kpis(kept.unionByName(fresh))


def fraud_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(
        F.to_date("alert_timestamp").alias("alert_date"), "reason_code", severity_bucket().alias("severity_bucket"), "status"
    ).agg(F.count("*").alias("alert_count"), mean("severity_score").alias("avg_severity"),
          F.max("severity_score").alias("max_severity"), F.count_distinct("transaction_id").alias("unique_transactions"))


def mart_fraud_summary(alerts: DataFrame) -> DataFrame:
    return fraud_summary(alerts)


def mart_order(mart: DataFrame) -> DataFrame:
    """Read order of a mart: newest day first, then the largest count."""
    if "txn_date" in mart.columns:
        return mart.orderBy(F.col("txn_date").desc())
    return mart.orderBy(F.col("alert_date").desc(), F.col("alert_count").desc(), "reason_code", "severity_bucket", "status")
