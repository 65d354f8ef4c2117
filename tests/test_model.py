import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.operators import kpis, model, quality

D1, D2, D3 = "2026-04-01 00:00:00", "2026-04-02 00:00:00", "2026-04-03 00:00:00"


def users(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id string, email_hash string, risk_tier string, country_code string")


def intervals(df):
    return {(r["user_id"], r["risk_tier"], r["valid_from"], r["valid_to"]) for r in df.collect()}


def test_calendar(spark):
    days = model.dim_time(model.calendar(spark))
    assert days.count() == 4018
    row = days.where("time_sk = 20240229").collect()[0]
    assert (row["day_of_week"], row["is_weekend"], row["quarter"], row["month_name"], row["week_of_year"]) == (4, False, 1, "February ", 9)


@pytest.fixture(scope="module")
def three_days(spark):
    empty = spark.createDataFrame([], S.USER_HISTORY)
    day1 = model.scd2_snapshot(empty, users(spark, ("u1", "h", "low", "MX")), as_of=D1)
    day2 = model.scd2_snapshot(day1, users(spark, ("u1", "h", "high", "MX"), ("u2", None, "low", None)), as_of=D2)
    day3 = model.scd2_snapshot(day2, users(spark, ("u2", None, "low", None)), as_of=D3)
    return day1, day2, day3


def test_scd2_versions(three_days):
    _, day2, day3 = three_days
    assert intervals(day2) == {("u1", "low", at(D1), at(D2)), ("u1", "high", at(D2), None), ("u2", "low", at(D2), None)}
    assert intervals(day3) == {("u1", "low", at(D1), at(D2)), ("u1", "high", at(D2), at(D3)), ("u2", "low", at(D2), None)}


def test_scd2_is_idempotent_and_consistent(spark, three_days):
    _, day2, _ = three_days
    again = model.scd2_snapshot(day2, users(spark, ("u1", "h", "high", "MX"), ("u2", None, "low", None)), as_of=D3)
    assert intervals(again) == intervals(day2)
    assert quality.duplicate_keys(again.where("valid_to is null"), "user_id").count() == 0
    kept = model.scd2_snapshot(day2, users(spark, ("u2", None, "low", None)), as_of=D3, hard_deletes=False)
    assert intervals(kept) == intervals(day2)


def test_scd2_timestamp_strategy(spark):
    empty = spark.createDataFrame([], S.USER_HISTORY)
    batch = users(spark, ("u1", "h", "low", "MX")).withColumn("updated_at", F.lit(D1).cast("timestamp"))
    first = model.scd2_snapshot(empty, batch, as_of=D1, strategy="timestamp")
    newer = batch.withColumns({"updated_at": F.lit(D2).cast("timestamp"), "risk_tier": F.lit("high")})
    second = model.scd2_snapshot(first, newer, as_of=D3, strategy="timestamp")
    assert intervals(second) == {("u1", "low", at(D1), at(D2)), ("u1", "high", at(D2), None)}
    assert intervals(model.scd2_snapshot(second, newer, as_of=D3, strategy="timestamp")) == intervals(second)


def test_scd2_from_days_equals_day_by_day(spark):
    tiers = {"u1": "llhhl", "u2": ".lllh", "u3": "h.l.l", "u4": "....l"}
    names = {"l": "low", "h": "high"}
    days = [f"2026-04-0{i}" for i in range(1, 6)]
    empty = spark.createDataFrame([], S.USER_HISTORY)
    slow = empty
    for i, day in enumerate(days):
        rows = [(u, "h", names[t[i]], "MX") for u, t in tiers.items() if t[i] != "."]
        slow = model.scd2_snapshot(slow, users(spark, *rows), as_of=f"{day} 00:00:00", hard_deletes=False)
        slow = spark.createDataFrame(slow.collect(), S.USER_HISTORY)
    daily = spark.createDataFrame([(u, "h", names[t[i]], "MX", dt.date.fromisoformat(days[i])) for u, t in tiers.items() for i in range(5) if t[i] != "."],
                                  "user_id string, email_hash string, risk_tier string, country_code string, partition_date date")
    fast = model.scd2_from_days(empty, daily)
    assert intervals(fast) == intervals(slow)
    assert intervals(model.scd2_from_days(fast, daily)) == intervals(slow)
    half = model.scd2_from_days(empty, daily.where("partition_date <= '2026-04-03'"))
    assert intervals(model.scd2_from_days(half, daily)) == intervals(slow)


def test_history_from_events_equals_snapshots_in_order(spark):
    """Random users on random days, some of them full: days at once and a late day give what snapshots in order give."""
    draw = random.Random(5)
    days = [dt.date(2026, 4, i) for i in range(1, 9)]
    full_days, names = [days[2], days[4], days[7]], [f"u{i}" for i in range(12)]
    seen, listed, slow = [], [], spark.createDataFrame([], S.USER_HISTORY)
    for day in days:
        today = [(u, "h", draw.choice(["low", "high"]), "MX") for u in names if draw.random() < 0.5]
        seen += [(*r, day) for r in today]
        if day in full_days:
            today = [] if day == days[4] else [(u, "h", draw.choice(["low", "high"]), "MX") for u in names if draw.random() < 0.6]
            listed += [(*r, day) for r in today]
        slow = model.scd2_snapshot(slow, users(spark, *today), as_of=f"{day} 00:00:00", hard_deletes=day in full_days)
        slow = spark.createDataFrame(slow.collect(), S.USER_HISTORY)
    seen, listed = spark.createDataFrame(seen, S.USERS_DAILY), spark.createDataFrame(listed, S.USERS_DAILY)
    want, empty = intervals(slow), spark.createDataFrame([], S.USER_HISTORY)
    at_once = model.scd2_rebuild(empty, model.daily_profiles(seen, listed, full_days), days[0], full_days=full_days)
    assert intervals(at_once) == want and at_once.count() == slow.count()
    for late in (days[0], days[1], days[3], days[5]):
        without = model.daily_profiles(seen.where(F.col("partition_date") != late), listed, full_days)
        before = spark.createDataFrame(model.scd2_rebuild(empty, without, days[0], full_days=full_days).collect(), S.USER_HISTORY)
        again = model.scd2_rebuild(before, model.daily_profiles(seen, listed, full_days), late, full_days=full_days)
        assert intervals(again) == want and again.count() == slow.count(), late


def test_full_listing_marks_its_day_and_keeps_one_row_a_key(spark):
    profiles = users(spark, ("u1", "h", "low", "MX"), ("u1", "h", "low", "MX"), (None, "h", "low", "MX"))
    rows = model.full_listing(profiles, "2026-04-01").collect()
    assert sorted(str(r["user_id"]) for r in rows) == ["None", "u1"]
    assert [str(r["partition_date"]) for r in model.full_listing(profiles.limit(0), "2026-04-01").collect()] == ["2026-04-01"]


FACT_DDL = ("transaction_id string, user_id string, merchant_id string, time_sk int, amount decimal(18,2), currency string, transaction_type string, "
            "status string, payment_method string, is_flagged_fraud boolean, fraud_score decimal(5,4), latitude decimal(9,6), "
            "longitude decimal(9,6), country_code string, _silver_processed_at timestamp, loaded_at timestamp")


def staged(spark, *ids, user="u1", merchant="m1", sk=20260401, stamp=D1, amount="10.00"):
    return spark.createDataFrame([(i, user, merchant, sk, Decimal(amount), "USD", "purchase", "completed", "card", None, None, None, None, "MX", at(stamp), at(stamp))
                                  for i in ids], FACT_DDL)


def star(spark):
    history = model.scd2_snapshot(spark.createDataFrame([], S.USER_HISTORY), users(spark, ("u1", "h", "low", "MX")), as_of=D1)
    merchants = spark.createDataFrame([("m1", "Unknown", "5411", "MX")], "merchant_id string, merchant_name string, mcc_code string, country_code string")
    return model.dim_users(history), model.dim_merchants(merchants, D1)


@pytest.mark.parametrize("spread", [False, True])
def test_facts_need_both_keys(spark, spread):
    rows = staged(spark, "a", "b").unionAll(staged(spark, "c", user="nobody")).unionAll(staged(spark, "d", merchant="nothing"))
    out = model.fct_transactions(rows, *star(spark), spread_heavy=spread, heavy_rows=1).collect()
    assert {r["transaction_id"] for r in out} == {"a", "b"}
    assert out[0]["is_flagged_fraud"] is False and out[0]["fraud_score"] == 0


def test_heavy_keys_are_counted_in_the_staged_table(spark, tmp_path):
    staged(spark, "a", "b").unionAll(staged(spark, "b", stamp=D2)).unionAll(staged(spark, "c", user="nobody")).write.parquet(f"{tmp_path}/staged")
    rows = spark.read.parquet(f"{tmp_path}/staged")
    order = [F.col("_silver_processed_at").desc()]
    plain, spread = (model.fct_transactions(model.stg_transactions(rows, order), *star(spark), spread_heavy=heavy, heavy_rows=1, counted=rows) for heavy in (False, True))
    assert sorted(plain.collect()) == sorted(spread.collect()) and spread.count() == 2
    # Rows are told apart once, not again for each count of keys.
    windows = [x for x in spread._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x and "windowspecdefinition(transaction_id" in x]
    assert len(windows) == 1, windows


def test_time_key_falls_back_to_the_load_day(spark):
    rows = staged(spark, "a").withColumn("time_sk", F.lit(None).cast("int"))
    assert model.fct_transactions(rows, *star(spark)).collect()[0]["time_sk"] == 20260401


def test_watermark(spark):
    target = model.fct_transactions(staged(spark, "a"), *star(spark))
    new = model.fct_transactions(staged(spark, "a").unionAll(staged(spark, "b", stamp=D2)), *star(spark), target=target)
    assert [r["transaction_id"] for r in new.collect()] == ["b"]
    assert model.fct_transactions(staged(spark, "a"), *star(spark), target=target.limit(0)).count() == 1


def test_upsert_twice_equals_once(spark):
    target = model.fct_transactions(staged(spark, "a", "b"), *star(spark))
    batch = model.fct_transactions(staged(spark, "b", "c", amount="20.00"), *star(spark))
    once = model.incremental_upsert(target, batch, "transaction_id")
    twice = model.incremental_upsert(once, batch, "transaction_id")
    got = {(r["transaction_id"], str(r["amount"])) for r in once.collect()}
    assert got == {("a", "10.00"), ("b", "20.00"), ("c", "20.00")} == {(r["transaction_id"], str(r["amount"])) for r in twice.collect()}
    with pytest.raises(ValueError, match="schema change"):
        model.incremental_upsert(target, batch.drop("currency"), "transaction_id")


def test_flags_take_the_worst_open_alert_and_keep_the_rest(spark):
    facts = model.fct_transactions(staged(spark, "a", "b", "c"), *star(spark))
    alerts = spark.createDataFrame(
        [("a", "open", Decimal("0.3"), dt.date(2026, 4, 1)), ("a", "open", Decimal("0.9"), dt.date(2026, 4, 1)),
         ("a", "confirmed_fraud", Decimal("1.0"), dt.date(2026, 4, 1)), ("b", "open", Decimal("0.5"), dt.date(2026, 4, 2))],
        "transaction_id string, status string, severity_score decimal(5,4), alert_date date")
    out = {r["transaction_id"]: (r["is_flagged_fraud"], float(r["fraud_score"])) for r in model.apply_fraud_flags(facts, alerts, "2026-04-01").collect()}
    assert out == {"a": (True, 0.9), "b": (False, 0.0), "c": (False, 0.0)}
    flagged = model.apply_fraud_flags(facts, alerts, "2026-04-01")
    again = model.keep_flags(facts, flagged)
    assert {r["transaction_id"] for r in again.where("is_flagged_fraud").collect()} == {"a"}


def test_kpi_marts(spark):
    facts = model.fct_transactions(staged(spark, "a", "b").unionAll(staged(spark, "c", sk=20260403, amount="5.50")), *star(spark))
    mart = model.mart_executive_kpis(facts, model.dim_time(model.calendar(spark))).orderBy("txn_date").collect()
    assert [(str(r["txn_date"]), r["total_transactions"], float(r["daily_tpv"]), float(r["tpv_30d"])) for r in mart] == [
        ("2026-04-01", 2, 20.0, 20.0), ("2026-04-03", 1, 5.5, 25.5)]


def test_refreshed_mart_equals_a_rebuilt_one(spark):
    days = model.dim_time(model.calendar(spark))
    old = model.fct_transactions(staged(spark, "a").unionAll(staged(spark, "b", sk=20260402, amount="3.00")), *star(spark))
    new = model.fct_transactions(staged(spark, "a").unionAll(staged(spark, "b", "c", sk=20260403, amount="7.00")), *star(spark))
    refreshed = model.refresh_executive_kpis(model.mart_executive_kpis(old, days), new, days, [20260402, 20260403])
    assert sorted(refreshed.collect()) == sorted(model.mart_executive_kpis(new, days).collect())


def test_merchant_details_from_the_raw_entity(spark):
    staged_m = spark.createDataFrame([("m1", "5411", "MX"), ("m1", "5411", "BR"), ("m2", "1", "X")], "merchant_id string, mcc_code string, country_code string")
    one = model.stg_merchants(staged_m.withColumn("loaded_at", F.lit(D1)))
    assert {(r["merchant_id"], r["country_code"]) for r in one.collect()} == {("m1", "BR"), ("m2", "X")}
    raw = spark.createDataFrame([("m1", "Shop", Decimal("0.25"))], "merchant_id string, merchant_name string, risk_score decimal(5,4)")
    dim = {r["merchant_id"]: (r["merchant_name"], float(r["risk_score"])) for r in model.dim_merchants(one, D1, raw).collect()}
    assert dim == {"m1": ("Shop", 0.25), "m2": ("Unknown", 0.0)}


def test_monitors_and_empty_tables(spark):
    facts = model.fct_transactions(staged(spark, "a"), *star(spark))
    low = kpis.monitor_low_ingest(facts, D1).collect()[0]
    assert (low["value"], low["breached"]) == (1.0, True)
    empty = kpis.monitor_fraud_spike(facts.limit(0), D1).collect()[0]
    assert empty["value"] is None and empty["breached"] is False
    assert kpis.headline_kpis(model.mart_executive_kpis(facts.limit(0), model.dim_time(model.calendar(spark))), D1).collect()[0]["total_txns"] == 0
