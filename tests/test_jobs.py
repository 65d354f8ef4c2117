import json
import os

import pytest
from conftest import raw_row

from ledgerlens import schemas as S
from ledgerlens.operators.quality import QualityGateError
from ledgerlens.plans import jobs
from ledgerlens.plans.layout import Lake
from ledgerlens.sources import scans

AS_OF = "2026-04-26 00:00:00"


def land(root, day, hour, rows):
    folder = scans.landing_path(str(root), day, hour)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part.jsonl", "w") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def tx(i, user, day="2026-04-24", second=0, **changes):
    return {**raw_row(), "transaction_id": f"t{i:03d}", "user_id": user, "amount": 10.0, "latitude": 19.43, "longitude": -99.13,
            "timestamp": f"{day}T10:{second // 60:02d}:{second % 60:02d}", **changes}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    burst = [tx(i, "u1", second=4 * i) for i in range(12)]
    land(root, "2026-04-24", 10, burst + [tx(20, "u2"), tx(21, "u2", country_code="JP", latitude=35.6, longitude=139.6, second=600), "", "not json"])
    land(root, "2026-04-24", 11, [tx(20, "u2", amount=11.0), tx(30, "u3", currency="XYZ")])
    land(root, "2026-04-25", 10, [tx(40, "u1", "2026-04-25", country_code="BR"), tx(41, "u2", "2026-04-25", country_code="JP")])
    return root


@pytest.fixture(scope="module")
def first_day(spark, lake):
    return jobs.run_all_layers(spark, lake, "2026-04-24", [10, 11], as_of=AS_OF)


def facts(spark, root):
    return {r["transaction_id"]: r for r in spark.read.parquet(Lake(root).gold("fact_transactions")).collect()}


def test_first_day(spark, lake, first_day):
    assert (first_day["bronze"]["input_rows"], first_day["bronze"]["output_rows"], first_day["bronze"]["blank_lines"]) == (18, 17, 1)
    silver = first_day["silver"]
    assert (silver["input_rows"], silver["output_rows"], silver["invalid_rows"], silver["duplicate_rows"]) == (17, 14, 2, 1)
    assert first_day["rules"]["velocity_alerts"] == 3 and first_day["rules"]["geo_alerts"] == 1
    out = facts(spark, lake)
    assert {t for t, r in out.items() if r["is_flagged_fraud"]} == {"t009", "t010", "t011", "t021"}
    assert float(out["t021"]["fraud_score"]) == 1.0 and out["t020"]["time_sk"] == 20260424


def test_ledgers_follow_facts_and_alerts(spark, lake, first_day):
    from ledgerlens.operators import ledger
    at = Lake(lake)
    table = jobs.fact_table(spark, at)
    booked = spark.read.schema(S.LOAD_LEDGER).parquet(at.gold("load_ledger"))
    assert sorted(booked.collect()) == sorted(ledger.fact_ledger(table).select(*booked.columns).collect())
    assert sum(r["flagged"] for r in booked.collect()) == 4 and ledger.ledger_gaps(table, booked).count() == 0
    log = jobs.alerts_log(spark, at)
    assert [r["rows"] for r in spark.read.parquet(at.gold("alert_ledger")).collect()] == [log.count()]


def test_rerun_changes_nothing(spark, lake, first_day):
    before = facts(spark, lake)
    assert jobs.run_silver_cleanse(spark, lake, "2026-04-24", as_of=AS_OF)["output_rows"] == first_day["silver"]["output_rows"]
    jobs.run_gold_modeling(spark, lake, "2026-04-24", as_of=AS_OF)
    again = jobs.run_anomaly_detection(spark, lake, "2026-04-24", as_of=AS_OF)
    assert again["total_alerts"] == 0
    assert facts(spark, lake) == before  # flags survive the re-staging


def test_second_day_and_backfill_agree(spark, lake, first_day, tmp_path):
    jobs.run_all_layers(spark, lake, "2026-04-25", [10], as_of=AS_OF, ml=True)
    daily = facts(spark, lake)
    assert len(daily) == first_day["silver"]["output_rows"] + 2
    history = spark.read.parquet(Lake(lake).gold("users_history"))
    assert history.where("user_id = 'u1'").count() == 2 and history.where("user_id = 'u1' and valid_to is null").count() == 1

    other = str(tmp_path)
    days = ["2026-04-24", "2026-04-25"]
    jobs.run_bronze_ingest(spark, other, days, as_of=AS_OF, raw_root=lake)
    jobs.backfill(spark, other, days, as_of=AS_OF)
    rebuilt = facts(spark, other)
    keep = ("time_sk", "amount", "user_sk", "is_flagged_fraud", "fraud_score")
    assert {t: [r[c] for c in keep] for t, r in rebuilt.items()} == {t: [r[c] for c in keep] for t, r in daily.items()}


def test_missing_day_gives_zero_metrics(spark, tmp_path):
    assert jobs.run_bronze_ingest(spark, str(tmp_path), "2026-01-01", 3)["output_rows"] == 0
    assert jobs.run_silver_cleanse(spark, str(tmp_path / "empty"), "2026-01-01")["output_rows"] == 0
    assert jobs.run_ml_scoring(spark, str(tmp_path / "empty"), "2026-01-01")["ml_alerts"] == 0
    with pytest.raises(ValueError):
        jobs.run_bronze_ingest(spark, str(tmp_path), "01.01.2026", 3)


def test_gate_stops_the_day(spark, tmp_path):
    root = str(tmp_path)
    land(root, "2026-04-24", 10, [tx(1, "u1", amount=2_000_000)])  # valid for the row rules, above the gate's limit
    with pytest.raises(QualityGateError, match="between"):
        jobs.run_all_layers(spark, root, "2026-04-24", [10], as_of=AS_OF)
    assert not os.path.exists(Lake(root).gold("fact_transactions"))


def test_users_entity_closes_vanished_users(spark, tmp_path):
    root = str(tmp_path)
    land(root, "2026-04-24", 10, [tx(1, "u1"), tx(2, "u2")])
    everyone = spark.createDataFrame([("u1", "h1", "low", "MX"), ("u2", "h2", "high", "MX")], "user_id string, email_hash string, risk_tier string, country_code string")
    jobs.run_all_layers(spark, root, "2026-04-24", [10], as_of="2026-04-25 00:00:00", users=everyone)
    land(root, "2026-04-25", 10, [tx(3, "u1", "2026-04-25")])
    jobs.run_all_layers(spark, root, "2026-04-25", [10], as_of=AS_OF, users=everyone.where("user_id = 'u1'"))
    history = {(r["user_id"], r["risk_tier"], r["valid_to"] is None) for r in spark.read.parquet(Lake(root).gold("users_history")).collect()}
    assert history == {("u1", "low", True), ("u2", "high", False)}


def test_a_late_day_keeps_what_full_entities_closed(spark, tmp_path):
    days = ["2026-04-24", "2026-04-25", "2026-04-26"]
    ddl = "user_id string, email_hash string, risk_tier string, country_code string"
    entity = {"2026-04-25": [("u1", "h1", "low", "MX"), ("u2", "h2", "high", "MX")], "2026-04-26": [("u1", "h1", "low", "MX")]}
    found = {}
    for name, order in (("in_order", days), ("late", [days[1], days[2], days[0]])):
        root = str(tmp_path / name)
        for k, day in enumerate(days):
            land(root, day, 10, [tx(10 * k, "u1", day), tx(10 * k + 1, "u3", "2026-04-24") if k == 0 else tx(10 * k + 1, "u2", day)])
        for day in order:
            listed = spark.createDataFrame(entity[day], ddl) if day in entity else None
            jobs.run_all_layers(spark, root, day, [10], as_of=AS_OF, users=listed)
        found[name] = history(spark, root)
    assert found["late"] == found["in_order"]
    # u3 of the first day is in no entity, u2 not in the last one.
    ends = {(user, until[:10]) for user, _, _, until in found["late"]}
    assert {("u3", "2026-04-25"), ("u2", "2026-04-26"), ("u1", "None")} <= ends


def test_audit_lines(spark, lake, first_day):
    lines = spark.read.json(Lake(lake).audit)
    assert {"bronze_ingest", "silver_cleanse", "gold_modeling", "anomaly_detection"} <= {r["job_name"] for r in lines.collect()}


def test_upsert_moves_a_transaction_between_days(spark, tmp_path):
    from ledgerlens.sources import sinks
    path = str(tmp_path / "t")
    ddl = "transaction_id string, amount int, is_flagged_fraud boolean, fraud_score decimal(5,4), time_sk int"
    sinks.upsert_partitions(spark.createDataFrame([("a", 1, False, 0, 1), ("b", 1, False, 0, 2)], ddl.replace("decimal(5,4)", "int")).selectExpr(
        "transaction_id", "amount", "is_flagged_fraud", "cast(fraud_score as decimal(5,4)) fraud_score", "time_sk"), path)
    sinks.upsert_partitions(spark.createDataFrame([("a", 2, False, 0, 3)], ddl.replace("decimal(5,4)", "int")).selectExpr(
        "transaction_id", "amount", "is_flagged_fraud", "cast(fraud_score as decimal(5,4)) fraud_score", "time_sk"), path)
    assert {(r["transaction_id"], r["amount"], r["time_sk"]) for r in spark.read.parquet(path).collect()} == {("a", 2, 3), ("b", 1, 2)}


def history(spark, root):
    rows = spark.read.parquet(Lake(root).gold("users_history")).collect()
    return sorted((r["user_id"], r["country_code"], str(r["valid_from"]), str(r["valid_to"])) for r in rows)


def test_days_may_come_in_any_order_and_grouping(spark, tmp_path):
    raw = str(tmp_path / "raw")
    days = ["2026-04-24", "2026-04-25", "2026-04-26"]
    for k, day in enumerate(days):
        land(raw, day, 10, [tx(1, "u1", day, country_code="MX"), tx(10 + k, "u2", day, country_code=["MX", "JP", "MX"][k]), tx(20 + k, "u3", day, amount=10.0 + k)])
    seen = []
    for plan in ([days], [[d] for d in days], [[days[2]], days], [[days[1]], [days[0]], [days[2]]]):
        root = str(tmp_path / f"lake{len(seen)}")
        jobs.run_bronze_ingest(spark, root, days, as_of=AS_OF, raw_root=raw)
        for part in plan:
            jobs.run_silver_cleanse(spark, root, part)
            jobs.run_gold_modeling(spark, root, part)
        rows = {t: (r["time_sk"], r["amount"]) for t, r in facts(spark, root).items()}
        seen.append((history(spark, root), rows, scans.scan_layer(spark, Lake(root).silver).count()))
    assert all(s == seen[0] for s in seen)
    assert seen[0][1]["t001"][0] == 20260426 and seen[0][2] == 9
    assert sorted(h[2:] for h in seen[0][0] if h[0] == "u2") == [
        ("2026-04-24 00:00:00", "2026-04-25 00:00:00"), ("2026-04-25 00:00:00", "2026-04-26 00:00:00"), ("2026-04-26 00:00:00", "None")]


def test_high_amount_needs_no_clock(spark, tmp_path):
    root = str(tmp_path)
    land(root, "2026-04-20", 10, [tx(i, "u1", "2026-04-20", second=i * 300) for i in range(10)])
    land(root, "2026-04-24", 10, [tx(50, "u1", amount=1000.0)])
    for day in ("2026-04-20", "2026-04-24"):
        jobs.run_bronze_ingest(spark, root, day, 10)
        jobs.run_silver_cleanse(spark, root, day)
    assert jobs.run_anomaly_detection(spark, root, "2026-04-24")["amount_alerts"] == 1


def test_an_emptied_day_leaves_nothing(spark, tmp_path):
    root = str(tmp_path)
    land(root, "2026-04-24", 10, [tx(i, "u1", second=i * 300) for i in range(5)])
    jobs.run_all_layers(spark, root, "2026-04-24", [10], as_of=AS_OF)
    assert len(facts(spark, root)) == 5
    jobs.run_silver_cleanse(spark, root, "2026-04-24", as_of="2026-04-01 00:00:00")  # all rows lie in the future now
    assert scans.scan_layer(spark, Lake(root).silver, "all", S.SILVER).count() == 0
    jobs.run_gold_modeling(spark, root, "2026-04-24", as_of=AS_OF)
    assert spark.read.parquet(Lake(root).gold("users_history")).count() == 0
    assert jobs.fact_table(spark, Lake(root)).count() == 0


def test_new_lake_without_files(spark, tmp_path):
    out = jobs.run_all_layers(spark, str(tmp_path), "2026-04-24", [10, 11], as_of=AS_OF)
    assert out["bronze"]["missing_folders"] == 2 and out["flags"]["facts"] == 0 and out["marts"]["executive_kpis"] == 0


def test_facts_outside_any_fixed_calendar_reach_the_mart(spark, tmp_path):
    root = str(tmp_path)
    land(root, "2019-12-31", 10, [tx(1, "u1", "2019-12-31")])
    jobs.run_all_layers(spark, root, "2019-12-31", [10], as_of=AS_OF)
    assert [str(r["txn_date"]) for r in spark.read.parquet(Lake(root).gold("mart_executive_kpis")).collect()] == ["2019-12-31"]


def test_scratch_is_deleted(spark, lake, first_day):
    base = spark.conf.get("spark.checkpoint.dir") + "/ledgerlens"
    before = set(os.listdir(base)) if os.path.exists(base) else set()
    jobs.run_gold_modeling(spark, lake, "2026-04-24", as_of=AS_OF)
    jobs.run_anomaly_detection(spark, lake, "2026-04-24", as_of=AS_OF)
    jobs.run_flag_update(spark, lake, "2026-04-24")
    assert (set(os.listdir(base)) if os.path.exists(base) else set()) == before


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    from ledgerlens import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Fake:
        conf = Conf()

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Fake())


def test_command_line(spark, tmp_path):
    from ledgerlens.__main__ import parser, run
    land(str(tmp_path), "2026-04-24", 10, [tx(1, "u1")])
    command = lambda *words: run(spark, parser().parse_args([*words, "--root", str(tmp_path), "--as-of", AS_OF]))
    assert command("bronze", "--date", "2026-04-24", "--hour", "10")["output_rows"] == 1
    assert command("silver", "--date", "2026-04-24")["output_rows"] == 1
    with pytest.raises(SystemExit):
        command("gold")
