import datetime as dt
import math
import random

import pytest
from conftest import AS_OF, at
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import haversine_km
from ledgerlens.operators import rules, windows

T0 = at("2026-04-24 10:00:00")
DDL = "transaction_id string, user_id string, timestamp timestamp, amount decimal(18,2), latitude decimal(9,6), longitude decimal(9,6), country_code string"


def event(tid, user="u1", seconds=0, amount="10.00", place=(19.43, -99.13), country="MX", micros=0):
    from decimal import Decimal
    lat, lon = place if place else (None, None)
    return (tid, user, T0 + dt.timedelta(seconds=seconds, microseconds=micros), Decimal(amount),
            None if lat is None else Decimal(str(lat)), None if lon is None else Decimal(str(lon)), country)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def test_velocity_alerts_from_the_tenth_event_on(spark):
    df = frame(spark, *[event(f"t{i:02d}", seconds=5 * i) for i in range(12)])
    out = {r["transaction_id"]: round(r["severity_score"], 2) for r in rules.detect_velocity_attack(df).collect()}
    assert out == {"t09": 0.50, "t10": 0.55, "t11": 0.60}


def test_velocity_needs_ten_events_of_one_user(spark):
    quiet = [event(f"q{i}", seconds=10 * i) for i in range(5)]
    assert rules.detect_velocity_attack(frame(spark, *quiet)).count() == 0
    mixed = [event(f"a{i}", "u1", 5 * i) for i in range(12)] + [event(f"b{i}", "u2", 5 * i) for i in range(3)]
    ids = {r[0] for r in rules.detect_velocity_attack(frame(spark, *mixed)).select("transaction_id").collect()}
    assert ids and all(i.startswith("a") for i in ids)


def test_velocity_window_includes_both_ends(spark):
    df = frame(spark, event("a"), event("b", seconds=60), event("c", seconds=121))
    counts = {r["transaction_id"]: r["rolling_count"] for r in windows.rolling_count(df).collect()}
    assert counts == {"a": 1, "b": 2, "c": 1}


def brute_counts(rows, seconds):
    out = {}
    for tid, user, ts, *_ in rows:
        e = math.floor(ts.timestamp())
        out[tid] = sum(1 for _, u, t, *_ in rows if u == user and e - seconds <= math.floor(t.timestamp()) <= e)
    return out


def skewed_rows(n=400, seed=7):
    """One user holds most rows, many of them in the same seconds and microseconds."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.6 else f"u{rng.randrange(12)}"
        burst = rng.random() < 0.4
        rows.append(event(f"t{i:04d}", user, 300 if burst else rng.randrange(0, 3000), micros=rng.choice([0, 0, 5, 250000]),
                          place=None if rng.random() < 0.1 else (rng.randrange(-60, 60), rng.randrange(-170, 170)), country=rng.choice("ABC"),
                          amount=f"{rng.expovariate(0.1) + 0.01:.2f}"))
    return rows


@pytest.mark.parametrize("seconds,tile", [(60, None), (60, 60), (60, 7), (1, None), (600, 601)])
def test_rolling_count_equals_brute_force(spark, seconds, tile):
    rows = skewed_rows()
    out = windows.rolling_count(frame(spark, *rows), seconds=seconds, tile_seconds=tile)
    assert {r["transaction_id"]: r["rolling_count"] for r in out.collect()} == brute_counts(rows, seconds)


@pytest.mark.parametrize("heavy_rows", [10**9, 100, 17, 3])
def test_lag_equals_brute_force_however_keys_are_cut(spark, heavy_rows):
    rows = [r if i % 9 else (r[0], None, *r[2:]) for i, r in enumerate(skewed_rows())]
    out = windows.lag_previous(frame(spark, *rows), "user_id", "timestamp", "transaction_id", ["transaction_id", "latitude"],
                               heavy_rows=heavy_rows)
    got = {r["transaction_id"]: r["_prev"] and (r["_prev"]["transaction_id"], r["_prev"]["latitude"]) for r in out.collect()}
    want, last = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        want[r[0]] = last.get(r[1])
        last[r[1]] = (r[0], r[4])
    assert got == want
    assert out.columns == [f.split()[0] for f in DDL.split(", ")] + ["_prev"]


@pytest.mark.parametrize("heavy_rows", [10**9, 50, 1])
def test_heavy_users_change_no_alert(spark, heavy_rows):
    df = frame(spark, *skewed_rows())
    base_amount = rules.detect_high_amount(df, as_of=AS_OF, ratio=2.0)
    base_geo = rules.detect_geo_impossible(df)
    assert base_amount.count() > 0 and base_geo.count() > 0
    assert sorted(rules.detect_high_amount(df, as_of=AS_OF, ratio=2.0, heavy_rows=heavy_rows).collect()) == sorted(base_amount.collect())
    assert sorted(rules.detect_geo_impossible(df, heavy_rows=heavy_rows).collect()) == sorted(base_geo.collect())


def test_high_amount(spark):
    usual = [event(f"t{i:02d}", amount="10.00") for i in range(30)]
    out = rules.detect_high_amount(frame(spark, *usual, event("big", amount="1000.00")), as_of=AS_OF).collect()
    assert [r["transaction_id"] for r in out] == ["big"]
    assert out[0]["severity_score"] == 1.0 and out[0]["description"] == "Amount $1000.00 vs user avg $41.94"
    fair = [event(f"t{i:02d}", amount="100.00") for i in range(30)] + [event("more", amount="350.00")]
    assert rules.detect_high_amount(frame(spark, *fair), as_of=AS_OF).count() == 0


def test_high_amount_baseline_can_come_from_history(spark):
    today = frame(spark, event("t", amount="100.00"))
    history = frame(spark, *[event(f"h{i}", seconds=-86400, amount="10.00") for i in range(5)])
    assert rules.detect_high_amount(today, as_of=AS_OF).count() == 0
    assert rules.detect_high_amount(today, as_of=AS_OF, history=history).count() == 1
    assert rules.detect_high_amount(today, as_of="2026-08-01", history=history).count() == 0  # history too old


def test_impossible_travel(spark):
    tokyo = (35.6762, 139.6503)
    hit = rules.detect_geo_impossible(frame(spark, event("a"), event("b", seconds=1800, place=tokyo, country="JP"))).collect()
    assert [(r["transaction_id"], r["severity_score"]) for r in hit] == [("b", 1.0)]
    assert hit[0]["description"].startswith("Impossible travel: 1")
    stay = frame(spark, event("a"), event("b", seconds=3600))
    assert rules.detect_geo_impossible(stay).count() == 0
    same_second = rules.hops(frame(spark, event("a"), event("b", place=tokyo, country="JP"))).collect()[0]["hop"]
    assert same_second["hours"] == 0 and same_second["kmh"] == pytest.approx(same_second["km"] / 0.001)


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    d = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert d[0] == pytest.approx(math.pi * 6371) and d[1] == 0 and d[2] == pytest.approx(math.pi * 6371 / 180)


def test_alert_counts_and_ids(spark):
    df = frame(spark, *[event(f"t{i:02d}", seconds=5 * i) for i in range(12)])
    found = rules.detect_all(df, as_of=AS_OF, extra=("timestamp",))
    log = rules.alert_envelope(found, alert_time=F.col("timestamp"))
    assert {r["reason_code"]: r["alerts"] for r in rules.alert_counts(log).collect()} == {"VELOCITY_ATTACK": 3, "TOTAL": 3}
    rows = log.collect()
    assert len({r["alert_id"] for r in rows}) == 3 and all(r["status"] == "open" and r["ml_score"] is None for r in rows)


def test_rule_precision_on_injected_fraud(spark):
    burst = [event(f"f{i:02d}", "bad", 4 * i, amount="20.00") for i in range(12)]
    normal = [event(f"n{i:02d}", f"u{i}", 600 * i, amount="20.00") for i in range(20)]
    df = frame(spark, *burst, *normal)
    labels = df.select("transaction_id", (F.col("user_id") == "bad").alias("is_fraud"))
    out = {r["reason_code"]: r for r in rules.rule_precision(rules.detect_all(df, as_of=AS_OF), labels).collect()}
    assert out["ANY"]["precision_pct"] == 100.0 and out["ANY"]["recall_pct"] == 25.0


def test_rolling_count_keeps_rows_without_key_or_time(spark):
    from ledgerlens.operators.windows import rolling_count
    df = spark.sql("SELECT * FROM VALUES ('a', 'u', timestamp'2024-01-01 00:00:00'), ('b', NULL, timestamp'2024-01-01 00:00:00'), ('c', 'u', NULL) AS t(transaction_id, user_id, timestamp)")
    assert {r["transaction_id"]: r["rolling_count"] for r in rolling_count(df).collect()} == {"a": 1, "b": None, "c": None}


@pytest.mark.parametrize("heavy_rows", [10**9, 5])
def test_days_alone_see_bursts_and_trips_over_midnight(spark, heavy_rows):
    """Events about two midnights: day by day, with context, the alerts of the rules over everything."""
    rng = random.Random(4)
    rows = [event(f"t{i:04d}", f"u{rng.randrange(6)}", rng.randrange(9 * 3600, 66 * 3600) if i % 3 else rng.choice([14, 38]) * 3600 + rng.randrange(-90, 90),
                  place=(rng.randrange(-60, 60), rng.randrange(-170, 170)), country=rng.choice("ABC")) for i in range(240)]
    df = frame(spark, *rows).withColumn("partition_date", F.to_date("timestamp")).cache()
    days = [r[0] for r in df.select("partition_date").distinct().orderBy("partition_date").collect()]
    assert len(days) == 4
    options, extra = {"min_count": 4, "seconds": 60}, ("partition_date", "_own")
    for rule, back, last in ((lambda d, e=(): rules.detect_velocity_attack(d, extra=e, **options), 60, False),
                             (lambda d, e=(): rules.detect_geo_impossible(d, heavy_rows=heavy_rows, extra=e), rules.reach_seconds(800.0), True)):
        want = sorted(rule(df).collect())
        for parts in ([days], [[d] for d in days], [days[::2], days[1::2]]):
            found = [r for part in parts for r in rule(rules.with_context(df, part, back, last), extra).where("_own").drop(*extra).collect()]
            assert sorted(found) == want
        keyed = df.withColumn("user_id", F.concat_ws("|", F.col("partition_date").cast("string"), "user_id"))
        assert rule(keyed).count() < len(want)  # some do go over midnight
