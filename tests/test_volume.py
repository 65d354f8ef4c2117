"""What the jobs write and how their scans are cut."""

from pyspark.sql import functions as F

from ledgerlens.session import SPLIT, configure
from ledgerlens.sources import scans, tables


def test_landed_lines_are_compressed_and_read_back(spark, tmp_path):
    rows = spark.range(400).select(
        F.col("id").alias("transaction_id"), F.col("id").alias("user_id"), F.col("id").alias("merchant_id"), F.lit(1.5).cast("decimal(18,2)").alias("amount"),
        F.lit("USD").alias("currency"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 600).alias("timestamp"),
        *[F.lit("x").alias(c) for c in ("transaction_type", "status", "payment_method", "device_id", "ip_address")],
        *[F.lit(1).cast("decimal(9,6)").alias(c) for c in ("latitude", "longitude")], *[F.lit("A").alias(c) for c in ("country_code", "mcc_code")])
    tables.land_transactions(rows, str(tmp_path))
    files = [f for f in (tmp_path / "raw").rglob("part-*")]
    assert files and all(f.name.endswith(".gz") for f in files)
    back = scans.scan_raw_jsonl(spark, f"{tmp_path}/raw/transactions/*/*/*/*").select("raw_data")
    assert sorted(r[0] for r in back.collect()) == sorted(r[0] for r in tables.raw_json(rows).select("value").collect())
    days = scans.scan_raw_jsonl(spark, f"{tmp_path}/raw/transactions/*/*/*/*").select(scans.landing_day("source_file")).distinct()
    assert days.count() == 4


def test_scan_tasks_are_small_unless_somebody_set_them(spark):
    before = spark.conf.get(SPLIT)
    try:
        spark.conf.set(SPLIT, "128m")
        assert configure(spark).conf.get(SPLIT) == "8m"
        spark.conf.set(SPLIT, "64m")
        assert configure(spark).conf.get(SPLIT) == "64m"
    finally:
        spark.conf.set(SPLIT, before)
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"
