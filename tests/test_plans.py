"""The plans are the ones meant: pruned scans, limits before shuffles, bounded broadcasts."""


import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import time_key
from ledgerlens.operators import cleanse, kpis, ledger, model, rules, skew, windows
from ledgerlens.session import materialize_scratch
from ledgerlens.sources import scans, tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def executed(df) -> str:
    """The final adaptive plan after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return tables.transactions(spark, SF)


@pytest.fixture(scope="module")
def layer(spark, t, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layer") / "t")
    t.write.partitionBy("partition_date").parquet(path)
    return path


def test_days_prune_partitions_and_columns(spark, layer):
    df = scans.scan_features(scans.scan_layer(spark, layer, "2024-01-05"))
    text = plan(df)
    scan = [line for line in text.splitlines() if "FileScan" in line][-1]
    assert "PartitionFilters: [isnotnull(partition_date" in scan and "2024-01-05" in scan
    assert "[transaction_id#" in scan and not [c for c in ("currency", "status", "mcc_code", "ip_address") if c in scan]


def test_lookback_reaches_the_scan(spark, layer):
    text = plan(kpis.volume_trend(scans.scan_layer(spark, layer).withColumnRenamed("timestamp", "created_at"), "2024-01-31 00:00:00"))
    scan = [line for line in text.splitlines() if "FileScan" in line][-1]
    assert "(timestamp,2024-01-17 00:00:00" in scan and "IsNotNull(status)" in scan and "user_id" not in scan


@pytest.fixture(scope="module")
def booked(spark, t, tmp_path_factory):
    """Facts by day whose load hours do not follow their days, alerts, and the ledgers of both."""
    root = str(tmp_path_factory.mktemp("booked"))
    loaded = F.timestamp_seconds(F.unix_seconds("timestamp") + F.when(F.col("transaction_id") % 50 == 0, 5 * 86400).otherwise(0))
    facts = t.withColumns({"created_at": loaded, "is_flagged_fraud": F.col("is_fraud"), "time_sk": time_key("partition_date")})
    alerts = rules.alert_envelope(rules.detect_velocity_attack(t, min_count=2, seconds=36000, extra=("timestamp", "partition_date")),
                                  alert_time=loaded, alert_day=F.col("partition_date"))
    out = {}
    for name, df, by, book in (("facts", facts, "time_sk", ledger.fact_ledger), ("alerts", alerts, "alert_date", ledger.alert_ledger)):
        df.write.partitionBy(by).parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
        book(out[name]).write.parquet(f"{root}/{name}-ledger")
        out[f"{name}_ledger"] = spark.read.parquet(f"{root}/{name}-ledger")
    return out


def files_read(df) -> list[tuple[str, int]]:
    """(source, files) of the scans that ran."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            metric = node.metrics().get("numFiles")
            found.append((node.simpleString(1000), int(metric.get().value())))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
    walk(lines)
    return found


LATE = "2024-01-30 21:17:30"


def test_monitors_read_the_ledger_and_one_hour_of_facts(booked):
    facts, book = booked["facts"], booked["facts_ledger"]
    for df, plain in ((kpis.monitor_low_ingest(facts, LATE, hours=5, ledger=book), kpis.monitor_low_ingest(facts, LATE, hours=5)),
                      (kpis.monitor_fraud_spike(facts, LATE, hours=5, ledger=book), kpis.monitor_fraud_spike(facts, LATE, hours=5)),
                      (kpis.fraud_rate_window(facts, LATE, ledger=book), kpis.fraud_rate_window(facts, LATE)),
                      (kpis.ingest_gauge(facts, LATE, ledger=book), kpis.ingest_gauge(facts, LATE)),
                      (kpis.volume_trend(facts, LATE, ledger=book), kpis.volume_trend(facts, LATE))):
        assert df.collect() == plain.collect()
        assert "dynamicpruning" in plan(df)
        of_facts = [n for text, n in files_read(df) if "created_at" in text]
        assert of_facts and max(of_facts) <= 3 < len(facts.inputFiles())
    # A span that begins on the hour needs no fact.
    whole = kpis.monitor_low_ingest(facts, "2024-01-30 21:00:00", hours=5, ledger=book)
    assert whole.collect() == kpis.monitor_low_ingest(facts, "2024-01-30 21:00:00", hours=5).collect()
    assert not [text for text, _ in files_read(whole) if "created_at" in text]


def test_alert_panels_read_days_with_alerts_of_the_span(booked):
    alerts, book = booked["alerts"], booked["alerts_ledger"]
    for panel in (kpis.alert_kpis, kpis.alerts_by_rule, kpis.alert_timeline, kpis.severity_distribution, kpis.recent_alerts):
        df = panel(alerts, LATE, days=3, ledger=book)
        assert df.collect() == panel(alerts, LATE, days=3).collect()
        scan = [line for line in plan(df).splitlines() if "FileScan" in line and "reason_code" in line or "FileScan" in line and "severity_score" in line]
        assert scan and all("dynamicpruning" in line for line in scan)
    by_country = kpis.alerts_by_country(alerts, booked["facts"], LATE, days=3, ledger=book)
    assert by_country.collect() == kpis.alerts_by_country(alerts, booked["facts"], LATE, days=3).collect()
    line = [line for line in plan(by_country).splitlines() if "FileScan" in line and "country_code" in line][-1]
    assert "time_sk" in line.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_ledger_gaps_are_found(booked):
    facts, book = booked["facts"], booked["facts_ledger"]
    assert ledger.ledger_gaps(facts, book).count() == 0
    assert [r["time_sk"] for r in ledger.ledger_gaps(facts, book.where("time_sk <> 20240107")).collect()] == [20240107]
    assert "ReadSchema: struct<>" in plan(ledger.ledger_gaps(facts, book))


def test_dedup_limits_each_key_before_the_shuffle(t):
    text = plan(cleanse.dedup_latest(t.withColumn("ingestion_timestamp", F.col("timestamp"))))
    assert "WindowGroupLimit" in text and "row_number(), 1, Partial" in text


def test_json_is_parsed_once_per_row(spark):
    from ledgerlens.plans.jobs import cleanse_bronze
    lines = spark.createDataFrame([("{}", dt.date(2024, 1, 1))], "raw_data string, partition_date date")
    text = cleanse.validate_rows(cleanse_bronze(lines, "2024-01-31 00:00:00"), "2024-01-31 00:00:00")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_calendar_join_is_broadcast_by_size(spark, t):
    text = executed(model.fact_calendar(model.stage_fact(t), model.dim_time(model.calendar(spark))))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_recent_alerts_is_a_top_n(t):
    log = rules.alert_envelope(rules.detect_velocity_attack(t, min_count=2, seconds=3600, extra=("timestamp",)), alert_time=F.col("timestamp"))
    assert "TakeOrderedAndProject" in plan(kpis.recent_alerts(log, "2024-01-31 00:00:00"))


def test_velocity_counts_before_it_shuffles(t):
    text = plan(rules.detect_velocity_attack(t))
    assert "partial_count" in text
    scans_ = [line for line in text.splitlines() if "FileScan" in line]
    assert all("props" not in line.split("ReadSchema")[1] for line in scans_)


def test_window_groups_are_bounded_for_a_hot_user(spark):
    """20,000 rows of one user in 1,000 seconds: no group of the window exceeds its tile."""
    hot = spark.range(20_000).select(F.col("id").alias("transaction_id"), F.lit("hot").alias("user_id"),
                                     F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 1000).alias("timestamp"))
    counts = windows.rolling_count_per_second(hot, "user_id", "timestamp", "transaction_id", 10)
    assert counts.count() == 1000
    assert counts.agg(F.max("rolling")).first()[0] == 11 * 20


def test_salted_join_spreads_only_heavy_keys(spark):
    left = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 2000, 1).when(F.col("id") < 2900, F.col("id")).alias("k"))
    right = left.select("k").distinct().dropna().withColumn("v", F.col("k") * 2)
    heavy = skew.heavy_keys(skew.count_per_key(left, "k"), "k", min_rows=100)
    assert [r["k"] for r in heavy.collect()] == [1]
    for how in ("inner", "left"):
        out = skew.salted_join(left, right.where("k <> 2500"), "k", how, heavy, F.col("id"))
        want = left.join(right.where("k <> 2500"), "k", how)
        assert sorted(out.select("id", "k", "v").collect(), key=str) == sorted(want.select("id", "k", "v").collect(), key=str)
    with pytest.raises(ValueError):
        skew.salted_join(left, right, "k", "full_outer", heavy, F.col("id"))


def test_every_heavy_key_is_listed_with_the_tasks_it_needs(spark):
    counts = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 20_000).alias("n"))
    heavy = {r["k"]: r["parts"] for r in skew.heavy_keys(counts, "k").collect()}
    assert len(heavy) == 750 and heavy[250] == 1 and heavy[999] == 4


def test_one_moment_of_a_hot_user_is_cut_into_even_pieces(spark):
    """20,000 rows of one user in one microsecond: pieces of about 1,000 rows, linked as by the plain window."""
    rows = spark.range(20_000).select(F.lit("hot").alias("user_id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), F.col("id"))
    pieces = skew.in_pieces(rows, ["user_id", "timestamp", "id"], 20, materialize_scratch)
    sizes = [r["count"] for r in pieces.groupBy("_piece").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2500
    # The scan over pieces sees a row for each of them.
    found = windows.lag_previous(rows, "user_id", "timestamp", "id", ["id"], heavy_rows=1000)
    assert found.where("_prev.id = id - 1").count() == 19_999 and found.where("_prev is null and id = 0").count() == 1


def test_without_hot_users_the_lag_is_one_window(t):
    text = plan(windows.lag_previous(t, "user_id", "timestamp", "transaction_id", ["country_code"])).split("== Physical Plan ==")[1]
    assert "Join" not in text and text.count("Exchange") == 1


def test_no_operator_collects_or_uses_local_checkpoints():
    import pathlib
    root = pathlib.Path(__file__).resolve().parent.parent / "ledgerlens"
    text = {p: p.read_text() for p in root.rglob("*.py")}
    assert not [p for p, s in text.items() if "localCheckpoint" in s or "crossJoin" in s or ".rdd" in s]
