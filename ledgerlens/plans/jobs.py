"""The jobs a user runs, from landed files to marts."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerlens import schemas as S
from ledgerlens.functions.scalars import instant, surrogate_key, time_key
from ledgerlens.operators import cleanse, forest, kpis, ledger, model, quality, rules
from ledgerlens.plans.layout import Lake
from ledgerlens.session import scratch
from ledgerlens.sources import scans, sinks
from ledgerlens.sources.key_index import KeyIndex


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _finish(spark: SparkSession, lake: Lake, job: str, run_id: str, started: float, **metrics) -> dict:
    duration = round(time.monotonic() - started, 3)
    sinks.audit_record(spark, lake.audit, job, run_id, duration_seconds=duration, **metrics)
    return {**metrics, "run_id": run_id, "duration_seconds": duration}


def _label(date: str | list[str]) -> str:
    return date if isinstance(date, str) else f"{min(date)}..{max(date)}" if len(date) > 1 else date[0]


def _as_list(date: str | list[str]) -> str | list[str]:
    return date if date == "all" or isinstance(date, list) else [date]


def _many(date: str | list[str]) -> bool:
    return date == "all" or isinstance(date, list) and len(date) > 1


def run_bronze_ingest(spark: SparkSession, root: str, date: str | list[str], hours: int | str | list | None = None, *, as_of=None,
                      raw_root: str | None = None) -> dict:
    """Land one or more hours of raw lines in bronze; without `hours`, whole days. Hours asked
    for that were never landed are counted as `missing_folders`.

    Several dates go through one read; each line's day is then that of its folder.
    """
    started, batch_id, lake = time.monotonic(), str(uuid.uuid4()), Lake(root)
    dates = date if isinstance(date, list) else [date]
    wanted = None if hours is None else hours if isinstance(hours, list) else [hours]
    paths = [p for d in dates for p in scans.landed_folders(spark, raw_root or root, d, wanted)]
    missing = [p for d in dates for p in scans.missing_folders(spark, raw_root or root, d, wanted)] if wanted is not None else []
    raw = scans.scan_raw_jsonl(spark, paths) if paths else spark.createDataFrame([], "raw_data string, source_file string")
    seen = Observation()
    counted = raw.observe(seen, F.count("*").alias("lines"))
    lines = cleanse.drop_blank_lines(counted)
    bronze = cleanse.bronze_metadata(lines, as_of=as_of or _now(), partition_date=dates[0], batch_id=batch_id)
    if len(dates) > 1:
        bronze = bronze.withColumn("partition_date", scans.landing_day("source_file"))
    rows = sinks.write_bronze(bronze, lake.bronze, many_days=len(dates) > 1)
    return _finish(spark, lake, "bronze_ingest", batch_id, started, input_rows=seen.get["lines"], output_rows=rows,
                   blank_lines=seen.get["lines"] - rows, missing_folders=len(missing), date=_label(date))


def cleanse_bronze(bronze: DataFrame, as_of) -> DataFrame:
    """Parsed, typed and hashed rows before validation."""
    typed = cleanse.cast_types(cleanse.parse_raw_json(bronze))
    return cleanse.stamp_processed(cleanse.hash_pii(typed), as_of)


def run_silver_cleanse(spark: SparkSession, root: str, date: str | list[str], *, as_of=None) -> dict:
    """Clean bronze days into silver; the days are replaced, so a re-run changes nothing, and a day
    without good rows is emptied. Each day keeps its own copy of a transaction, so days give the
    same rows in one run or in many.

    Input, valid and output rows are counted while the one write runs.
    """
    started, lake, as_of = time.monotonic(), Lake(root), as_of or _now()
    bronze = scans.scan_layer(spark, lake.bronze, _as_list(date), S.BRONZE)
    seen, kept = Observation(), Observation()
    typed = cleanse_bronze(bronze.observe(seen, F.count("*").alias("rows")), as_of)
    valid = cleanse.validate_rows(typed, as_of).observe(kept, F.count("*").alias("rows"))
    unique = cleanse.dedup_latest(valid, ["partition_date", "transaction_id"])
    rows = sinks.write_silver(cleanse.enforce_schema(unique, S.SILVER), lake.silver, many_days=_many(date), days=_days_of(spark, lake, date))
    read, ok = seen.get["rows"], kept.get["rows"]
    return _finish(spark, lake, "silver_cleanse", f"silver-{_label(date)}", started, input_rows=read, output_rows=rows,
                   rejected_rows=read - rows, invalid_rows=read - ok, duplicate_rows=ok - rows,
                   rejection_pct=round(100.0 * (read - rows) / read, 2) if read else 0.0)


def _days_of(spark: SparkSession, lake: Lake, date: str | list[str]) -> list[str]:
    """The named days; for `all`, the days that bronze or silver hold."""
    if date != "all":
        return sorted(_as_list(date))
    layers = [scans.scan_layer(spark, path, "all", schema).select("partition_date") for path, schema in ((lake.bronze, S.BRONZE), (lake.silver, S.SILVER))]
    return sorted(str(r[0]) for r in layers[0].union(layers[1]).distinct().collect())


def _silver(spark: SparkSession, lake: Lake, date) -> DataFrame:
    return scans.scan_layer(spark, lake.silver, _as_list(date), S.SILVER)


def run_quality_gate(spark: SparkSession, root: str, date: str | list[str]) -> dict:
    """Check the silver rows of a day; raises QualityGateError to stop what follows."""
    silver = _silver(spark, Lake(root), date)
    return quality.run_suite(silver, quality.silver_suite(), label=f"silver {_label(date)}", required=S.SILVER_REQUIRED_COLUMNS,
                             forbidden=("ip_address",))


def _merge_small(spark: SparkSession, path: str, batch: DataFrame, key: str) -> int:
    if scans.path_exists(spark, path):
        batch = model.incremental_upsert(spark.read.parquet(path), batch, key)
    return sinks.rewrite_table(batch, path)


def run_gold_modeling(spark: SparkSession, root: str, date: str | list[str], *, as_of=None, users: DataFrame | None = None,
                      merchants: DataFrame | None = None, spread_heavy: bool = True) -> dict:
    """Stage a day, bring user history and dimensions up to date, upsert the facts.

    `users` and `merchants` are the optional raw entities, by default those landed for the
    last day. A full user entity also closes users that vanished; users seen in one day's
    transactions cannot tell that.

    The user history is made of one profile per user and day, and changes hold from their
    day on: days may come one by one, together, or late, with the same result. Full entities
    are kept by day as well, so a late day before one keeps what it closed; a day's listing
    stays until the day gets another one.
    """
    started, lake = time.monotonic(), Lake(root)
    days = _days_of(spark, lake, date)
    # The clock only stamps what was loaded when; what is valid from when follows the data's days.
    as_of = as_of or _now()
    users = users if users is not None else _landed_entity(spark, lake, "users", days)
    merchants = merchants if merchants is not None else _landed_entity(spark, lake, "merchants", days)
    silver = _silver(spark, lake, date)
    staged = {
        "merchants": sinks.write_staging(model.stage_merchants(silver, as_of), lake.staging("merchants")),
        "users": sinks.write_staging(model.stage_users(silver, as_of), lake.staging("users")),
        "transactions": sinks.write_staging(model.stage_fact(silver, as_of), lake.staging("transactions")),
    }
    tables = {name: spark.read.parquet(lake.staging(name)) for name in staged}
    sinks.log_staged(tables["transactions"], lake.gold("staged_log"))
    problems = [r for r in quality.check_staging(tables["transactions"], tables["users"], tables["merchants"]).collect() if not r["success"]]
    if problems:
        raise quality.QualityGateError("staging", [f"{r['table_name']}.{r['check']}" for r in problems])

    history_path = lake.gold("users_history")
    history = scans.scan_or_empty(spark, history_path, S.USER_HISTORY)
    by_day = model.profile_for_history(model.stage_users_by_day(silver), "partition_date").select(*S.USERS_DAILY.names)
    sinks.replace_days(by_day, lake.gold("users_daily"), days, many=len(days) > 1)
    if users is not None:
        listing_day = days[-1] if days else str(as_of)[:10]
        listing = model.full_listing(model.profile_for_history(users), listing_day)
        sinks.replace_days(listing.select(*S.USERS_DAILY.names), lake.gold("users_listed"), [listing_day])
    if days or users is not None:
        first = days[0] if days else listing_day
        from_first = F.col("partition_date") >= F.lit(first).cast("date")
        seen = scans.scan_or_empty(spark, lake.gold("users_daily"), S.USERS_DAILY).where(from_first)
        listed = scans.scan_or_empty(spark, lake.gold("users_listed"), S.USERS_DAILY).where(from_first)
        full_days = [r[0] for r in listed.where("user_id IS NULL").select("partition_date").distinct().collect()]
        daily = model.daily_profiles(seen, listed, full_days)
        sinks.rewrite_table(model.scd2_rebuild(history, daily, first, full_days=full_days), history_path)
    sinks.overwrite_table(model.dim_users(spark.read.parquet(history_path)), lake.gold("dim_users"))
    _merge_small(spark, lake.gold("dim_merchants"),
                 model.dim_merchants(model.stg_merchants(tables["merchants"]), as_of, merchants), "merchant_id")

    # Of copies on several days the last day's is the fact.
    newest = [F.col("time_sk").desc_nulls_last(), F.xxhash64(*[c for c in tables["transactions"].columns if c != "loaded_at"])]
    facts = model.fct_transactions(
        model.stg_transactions(tables["transactions"], newest), spark.read.parquet(lake.gold("dim_users")),
        spark.read.parquet(lake.gold("dim_merchants")), spread_heavy=spread_heavy, counted=tables["transactions"])
    written, touched = sinks.upsert_partitions(facts, lake.gold("fact_transactions"), whole=[int(d.replace("-", "")) for d in days],
                                              index=KeyIndex(lake.gold("fact_keys")))
    _book(spark, lake, touched)
    return _finish(spark, lake, "gold_modeling", f"gold-{_label(date)}", started, output_rows=staged["transactions"],
                   merchants_staged=staged["merchants"], users_staged=staged["users"], fact_rows_written=written,
                   touched_days=touched)


def run_anomaly_detection(spark: SparkSession, root: str, date: str | list[str], *, as_of=None, lookback_days: int = 30,
                          **thresholds) -> dict:
    """Run the three rules on a day and append new alerts.

    Several dates run in one job and each day gives the same alerts as it would alone: bursts reach back over midnight, and a
    day's first event of a user is held against the last one of the days before, as far back as it can matter. The usual amount
    of a user is that of the `lookback_days` days of silver up to the row's own day; `as_of` only stamps the alerts.
    """
    started, lake, as_of = time.monotonic(), Lake(root), as_of or _now()
    days = [dt.date.fromisoformat(d) for d in _days_of(spark, lake, date)]
    velocity, amount, geo = (dict(thresholds.get(name) or {}) for name in ("velocity", "amount", "geo"))
    burst, reach = velocity.get("seconds", 60), rules.reach_seconds(geo.get("max_kmh", 800.0))
    back = -(-max(burst, reach) // 86_400)
    wanted = sorted({d - dt.timedelta(days=k) for d in days for k in range(back + 1)})
    silver = scans.scan_layer(spark, lake.silver, "all", S.SILVER)
    history = silver.where(F.col("partition_date").between(days[0] - dt.timedelta(days=lookback_days - 1), days[-1])) if days else silver.limit(0)

    def by_day(df: DataFrame) -> DataFrame:
        return df.withColumn("user_id", F.concat_ws("|", F.col("partition_date").cast("string"), "user_id"))
    usual = by_day(rules.daily_baseline(history, lookback_days)).drop("partition_date")
    # The narrow columns of the days and of those before are written once; the three rules read them several times.
    with scratch(spark) as keep:
        rows = keep(silver.where(F.col("partition_date").isin(wanted)).select(*rules.COLUMNS, "partition_date"), "rule-rows", ["partition_date"])
        extra = ("partition_date", "_own")
        own = by_day(rows.where(F.col("partition_date").isin(days))).withColumn("_own", F.lit(True))
        found = rules.union_alerts(
            rules.detect_velocity_attack(rules.with_context(rows, days, burst), extra=extra, **velocity),
            rules.detect_high_amount(own, as_of=as_of, baseline=usual, extra=extra, **amount),
            rules.detect_geo_impossible(rules.with_context(rows, days, reach, last_only=True), extra=extra, store=keep, **geo))
        return _log_alerts(spark, lake, found.where("_own").drop("_own"), as_of, date, started)


def _log_alerts(spark: SparkSession, lake: Lake, found: DataFrame, as_of, date, started: float) -> dict:
    shaped = rules.alert_envelope(found, alert_time=instant(as_of), alert_day=F.col("partition_date"))
    counts = sinks.append_alerts(shaped, lake.gold("alerts_log"), ledger_path=lake.gold("alert_ledger"))
    return _finish(spark, lake, "anomaly_detection", f"anomaly-{_label(date)}", started, total_alerts=sum(counts.values()),
                   velocity_alerts=counts["VELOCITY_ATTACK"], amount_alerts=counts["HIGH_AMOUNT"], geo_alerts=counts["GEO_IMPOSSIBLE"])


def _book(spark: SparkSession, lake: Lake, time_keys: list[int]) -> None:
    """Bring the load ledger up to date for days of the fact table that changed."""
    facts, path = fact_table(spark, lake), lake.gold("load_ledger")
    if scans.path_exists(spark, path):
        facts = facts.where(F.col("time_sk").isin(time_keys))
    sinks.replace_days(ledger.fact_ledger(facts), path, time_keys, "time_sk")


def fact_table(spark: SparkSession, lake: Lake) -> DataFrame:
    return scans.scan_or_empty(spark, lake.gold("fact_transactions"), S.FACTS)


def _landed_entity(spark: SparkSession, lake: Lake, entity: str, days: list[str]) -> DataFrame | None:
    """The raw entity landed on the last of the days, if it was."""
    folder = days and "/".join([lake.raw(entity), days[-1].replace("-", "/")])
    return scans.scan_entity(spark, folder, entity) if folder and scans.path_exists(spark, folder) else None


def alerts_log(spark: SparkSession, lake: Lake) -> DataFrame:
    return scans.scan_or_empty(spark, lake.gold("alerts_log"), S.ALERTS)


def run_flag_update(spark: SparkSession, root: str, date: str | list[str]) -> dict:
    """Flag the facts of a day that have open alerts; only that day's partitions are rewritten."""
    lake = Lake(root)
    path = lake.gold("fact_transactions")
    if date == "all":
        raise ValueError("name the days to flag")
    days = [date] if isinstance(date, str) else date
    keys = [int(d.replace("-", "")) for d in days]
    facts = fact_table(spark, lake).where(F.col("time_sk").isin(keys))
    alerts = alerts_log(spark, lake).where(F.col("alert_date").isin([dt.date.fromisoformat(d) for d in days]))
    with scratch(spark) as keep:
        flagged = keep(model.apply_fraud_flags(facts, alerts), "flags")
        written = sinks.replace_partitions(flagged, path, "time_sk", many=len(days) > 1)
    _book(spark, lake, keys)
    return {"facts": written}


def run_ml_scoring(spark: SparkSession, root: str, date: str | list[str], *, train: bool = False, as_of=None, threshold: float = 0.7,
                   **forest_options) -> dict:
    """Score a day with the stored forest, training one first if asked or absent."""
    started, lake, as_of = time.monotonic(), Lake(root), as_of or _now()
    rows = _silver(spark, lake, date).select("transaction_id", "user_id", *S.FEATURE_COLUMNS, "partition_date")
    if rows.isEmpty():
        return _finish(spark, lake, "ml_scoring", f"ml-{_label(date)}", started, ml_alerts=0)
    if train or not scans.path_exists(spark, f"{lake.model}/trees"):
        sinks.save_model(forest.train_isolation_forest(rows, **forest_options), forest.fit_scaler(rows), lake.model)
    trees, _ = sinks.load_model(spark, lake.model)
    scored = forest.score_isolation_forest(rows, trees)
    found = forest.ml_alerts(scored, alerts_log(spark, lake), threshold, extra=("partition_date",))
    shaped = rules.alert_envelope(found, alert_time=instant(as_of), alert_day=F.col("partition_date"), ml=True)
    counts = sinks.append_alerts(shaped, lake.gold("alerts_log"), one_per_transaction=True, ledger_path=lake.gold("alert_ledger"))
    return _finish(spark, lake, "ml_scoring", f"ml-{_label(date)}", started, ml_alerts=counts["ML_ANOMALY"])


def run_marts(spark: SparkSession, root: str, calendar: DataFrame | None = None, changed_days: list[int] | None = None) -> dict:
    """Rebuild the marts. With `changed_days` (yyyymmdd), only these days of the fact table
    are read; the other days' rows come from the mart as it is."""
    lake = Lake(root)
    facts, path = fact_table(spark, lake), lake.gold("mart_executive_kpis")
    # By default the calendar is that of the facts, so no day of theirs can be missing.
    days = calendar if calendar is not None else model.dim_time(model.calendar_of_keys(facts))
    if changed_days is not None and scans.path_exists(spark, path):
        kpis = sinks.rewrite_table(model.refresh_executive_kpis(spark.read.parquet(path), facts, days, changed_days), path)
    else:
        kpis = sinks.overwrite_table(model.mart_executive_kpis(facts, days), path)
    return {"executive_kpis": kpis,
            "fraud_summary": sinks.overwrite_table(model.mart_fraud_summary(alerts_log(spark, lake)), lake.gold("mart_fraud_summary"))}


def rejection_report(spark: SparkSession, root: str, as_of, days: int = 7) -> DataFrame:
    """Staged rows that did not become facts, per load date of all runs of the span."""
    lake = Lake(root)
    staged = scans.scan_or_empty(spark, lake.gold("staged_log"), S.STAGED_LOG)
    return kpis.staged_log_rejections(staged, fact_table(spark, lake), as_of, days)


def run_gold_tests(spark: SparkSession, root: str) -> dict:
    """The data tests on the finished tables; the first failing table stops the run."""
    lake = Lake(root)
    table = {name: spark.read.parquet(lake.gold(name)) for name in ("dim_users", "dim_merchants", "mart_executive_kpis", "mart_fraud_summary")}
    table["fact_transactions"] = fact_table(spark, lake)
    suites = {"fact_transactions": quality.fact_suite(), "dim_users": quality.user_suite(),
              "dim_merchants": [quality.expect_not_null("merchant_id")],
              "mart_executive_kpis": quality.mart_suites()["executive_kpis"],
              "mart_fraud_summary": quality.mart_suites()["fraud_summary"]}
    evaluated = sum(quality.run_suite(table[name], checks, label=name)["evaluated"] for name, checks in suites.items())
    # Users that vanished keep their facts, so facts are held against the whole user history.
    known = spark.read.parquet(lake.gold("users_history")).select(surrogate_key("user_id").alias("user_sk"))
    facts = table["fact_transactions"]
    quality.assert_empty(quality.orphan_keys(facts, known, "user_sk"), "no_orphan_facts")
    quality.assert_empty(quality.orphan_keys(facts, table["dim_merchants"], "merchant_sk"), "merchants_of_facts")
    in_mart = table["mart_executive_kpis"].select(time_key("txn_date").alias("time_sk"))
    quality.assert_empty(quality.orphan_keys(facts, in_mart, "time_sk"), "days_of_facts")
    quality.assert_empty(quality.duplicate_keys(table["dim_users"], "user_id", current_only=True), "one_current_row_per_user")
    quality.assert_empty(ledger.ledger_gaps(facts, scans.scan_or_empty(spark, lake.gold("load_ledger"), S.LOAD_LEDGER)), "load_ledger_counts_all_facts")
    return {"evaluated": evaluated + 5}


def run_all_layers(spark: SparkSession, root: str, date: str | list[str], hours: list | None = None, *, as_of=None, ml: bool = False,
                   users: DataFrame | None = None, merchants: DataFrame | None = None, raw_root: str | None = None, **thresholds) -> dict:
    """A day in order: the gate stands before modelling, flags before marts.

    With several dates every layer makes one read and one write for all of them.
    """
    as_of = as_of or _now()
    out = {"bronze": run_bronze_ingest(spark, root, date, hours, as_of=as_of, raw_root=raw_root)}
    out.update(_after_bronze(spark, root, date, as_of, ml, users, merchants, thresholds))
    return out


def _after_bronze(spark, root, date, as_of, ml, users, merchants, thresholds) -> dict:
    out = {"silver": run_silver_cleanse(spark, root, date, as_of=as_of)}
    out["gate"] = run_quality_gate(spark, root, date)
    out["gold"] = run_gold_modeling(spark, root, date, as_of=as_of, users=users, merchants=merchants)
    out["rules"] = run_anomaly_detection(spark, root, date, as_of=as_of, **thresholds)
    if ml:
        out["ml"] = run_ml_scoring(spark, root, date, as_of=as_of)
    out["flags"] = run_flag_update(spark, root, date)
    flagged = [int(d.replace("-", "")) for d in _as_list(date)]
    out["marts"] = run_marts(spark, root, changed_days=sorted({*out["gold"]["touched_days"], *flagged}))
    out["tests"] = run_gold_tests(spark, root)
    return out


def backfill(spark: SparkSession, root: str, dates: list[str], *, as_of=None, ml: bool = False, **thresholds) -> dict:
    """Rebuild everything behind bronze for many days, in one pass per layer."""
    return _after_bronze(spark, root, sorted(dates), as_of or _now(), ml, None, None, thresholds)
