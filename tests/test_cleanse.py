import hashlib
import json

import pytest
from conftest import AS_OF, at, raw_frame, raw_row
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.operators import cleanse
from ledgerlens.sources import scans


def cleaned(spark, *rows):
    return cleanse.validate_rows(cleanse.hash_pii(cleanse.cast_types(raw_frame(spark, *rows))), AS_OF)


def test_valid_row_is_kept_hashed_and_typed(spark):
    out = cleaned(spark, raw_row())
    row = out.collect()[0]
    assert row["ip_address_hash"] == hashlib.sha256(b"192.168.1.1").hexdigest()
    assert "ip_address" not in out.columns
    assert out.schema["amount"].dataType == S.AMOUNT and out.schema["latitude"].dataType == S.COORDINATE
    assert row["timestamp"] == at("2026-04-24 10:00:00")


@pytest.mark.parametrize("change", [
    {"transaction_id": None}, {"user_id": None}, {"merchant_id": None}, {"amount": None}, {"amount": "-50"}, {"amount": "0"}, {"amount": "many"},
    {"currency": "XYZ"}, {"currency": None}, {"transaction_type": "bribe"}, {"status": "lost"}, {"payment_method": "shells"},
    {"latitude": "91"}, {"longitude": "-181"}, {"timestamp": "2026-05-01T00:00:00"}, {"timestamp": "soon"}, {"timestamp": None},
])
def test_bad_rows_are_rejected(spark, change):
    assert cleaned(spark, raw_row(**change)).count() == 0


def test_missing_coordinates_are_allowed(spark):
    assert cleaned(spark, raw_row(latitude=None, longitude=None)).count() == 1


def test_missing_address_hash_stays_null(spark):
    assert cleaned(spark, raw_row(ip_address=None)).collect()[0]["ip_address_hash"] is None


def test_malformed_json_is_rejected_and_counted(spark):
    good = json.dumps({**raw_row(), "amount": 100.0, "latitude": 10, "longitude": 139.6503, "metadata": {"a": "b"}, "other": 1})
    lines = spark.createDataFrame([(good,), ("not json",), ("",), (None,)], "raw_data string")
    assert cleanse.drop_blank_lines(lines).count() == 2
    parsed = cleanse.parse_raw_json(cleanse.drop_blank_lines(lines))
    assert parsed.columns == S.RAW_TRANSACTION.names
    stats = cleanse.reject_stats(cleanse.hash_pii(cleanse.cast_types(parsed)), AS_OF).collect()[0]
    assert (stats["input_rows"], stats["output_rows"], stats["invalid_rows"], stats["rejection_pct"]) == (2, 1, 1, 50.0)
    assert str(parsed.where("transaction_id is not null").collect()[0]["longitude"]) == "139.650300"
    with_map = cleanse.parse_raw_json(lines, keep_metadata=True).where("transaction_id is not null").collect()[0]
    assert with_map["metadata"] == {"a": "b"}


def test_reject_counts_name_the_rule(spark):
    df = cleanse.cast_types(raw_frame(spark, raw_row(), raw_row(amount="-1"), raw_row(amount="0", currency="XYZ")))
    counts = {r["rule"]: r["rejected"] for r in cleanse.reject_counts(df, AS_OF).collect()}
    assert counts["amount_positive"] == 2 and counts["currency_known"] == 1 and counts["user_id_present"] == 0


def test_dedup_keeps_the_newest_and_is_idempotent(spark):
    df = spark.createDataFrame([("a", 100, at("2026-04-24 10:00:00")), ("a", 200, at("2026-04-24 11:00:00")), ("b", 5, at("2026-04-24 09:00:00"))],
                               "transaction_id string, amount int, ingestion_timestamp timestamp")
    once = cleanse.dedup_latest(df)
    assert {(r[0], r[1]) for r in once.collect()} == {("a", 200), ("b", 5)}
    assert sorted(cleanse.dedup_latest(once).collect()) == sorted(once.collect())


def test_dedup_of_equal_ages_is_repeatable(spark):
    df = spark.createDataFrame([("a", i, at("2026-04-24 10:00:00")) for i in range(50)],
                               "transaction_id string, amount int, ingestion_timestamp timestamp")
    first = cleanse.dedup_latest(df).collect()
    assert len(first) == 1 and first == cleanse.dedup_latest(df.repartition(7)).collect()


def test_enforce_schema(spark):
    df = cleanse.stamp_processed(cleanse.hash_pii(cleanse.cast_types(raw_frame(spark, raw_row()))), AS_OF).withColumns({
        "ingestion_timestamp": F.lit(AS_OF), "source_file": F.lit("f"), "partition_date": F.lit("2026-04-24")})
    out = cleanse.enforce_schema(df)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in S.SILVER]
    assert out.count() == 1
    with pytest.raises(ValueError, match="mcc_code"):
        cleanse.enforce_schema(df.drop("mcc_code"))
    with pytest.raises(Exception, match="user_id must not be NULL"):
        cleanse.enforce_schema(df.withColumn("user_id", F.lit(None).cast("string"))).collect()


def test_landing_path():
    assert scans.landing_path("/lake", "2026-04-24", 5) == "/lake/raw/transactions/2026/04/24/05/"
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        scans.landing_path("/lake", "24.04.2026", 5)


def test_bronze_metadata(spark):
    df = cleanse.bronze_metadata(spark.createDataFrame([("x",)], "raw_data string"), as_of=AS_OF, partition_date="2026-04-24", batch_id="b")
    row = df.collect()[0]
    assert str(row["partition_date"]) == "2026-04-24" and row["bronze_batch_id"] == "b" and row["ingestion_timestamp"] == at(AS_OF)
