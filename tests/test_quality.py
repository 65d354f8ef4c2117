import pytest
from conftest import AS_OF, raw_frame, raw_row
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.operators import cleanse, quality


def silver(spark, *rows):
    return cleanse.stamp_processed(cleanse.hash_pii(cleanse.cast_types(raw_frame(spark, *rows))), AS_OF)


def test_good_table_passes(spark):
    out = quality.run_suite(silver(spark, raw_row(), raw_row(transaction_id="txn-002")), quality.silver_suite(),
                            required=S.SILVER_REQUIRED_COLUMNS, forbidden=("ip_address",))
    assert out["success"] and out["evaluated"] == 15


@pytest.mark.parametrize("change,check", [
    ({"user_id": None}, "not_null(user_id)"), ({"amount": "2000000"}, "between(amount)"), ({"currency": "XYZ"}, "in_set(currency)"),
    ({"latitude": "91"}, "between(latitude)"), ({"transaction_id": "txn-001"}, "unique(transaction_id)"),
])
def test_each_fault_stops_the_gate(spark, change, check):
    df = silver(spark, raw_row(), raw_row(**{"transaction_id": "txn-002", **change}))
    with pytest.raises(quality.QualityGateError) as failure:
        quality.run_suite(df, quality.silver_suite(), label="silver")
    assert failure.value.failed == [check]


def test_columns_are_required_and_forbidden(spark):
    df = silver(spark, raw_row())
    with pytest.raises(quality.QualityGateError, match="column"):
        quality.run_suite(df.drop("user_id"), [], required=["user_id"])
    with pytest.raises(quality.QualityGateError, match="forbidden"):
        quality.forbid_column(raw_frame(spark, raw_row()))
    assert {r["column_name"] for r in quality.expect_columns(df.drop("amount")).where("not present").collect()} == {"amount"}


def test_null_passes_range_set_and_length(spark):
    df = silver(spark, raw_row(latitude=None, longitude=None, ip_address=None))
    assert quality.run_suite(df, quality.silver_suite())["success"]


def test_values_present_min_rows_and_foreign_keys(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", None)], "code string, k int")
    checks = [quality.expect_values_present("code", ["A", "C"]), quality.expect_min_rows(5)]
    assert quality.run_suite(df, checks, raise_on_failure=False)["failed"] == ["present(code=C)", "min_rows(5)"]
    dim = spark.createDataFrame([(1,)], "k int")
    assert quality.expect_foreign_key(df, dim, "k").collect()[0]["failed"] == 1
    assert {r["code"] for r in quality.orphan_facts(df, dim, "k").collect()} == {"A", "B"}
    assert quality.orphan_facts(df.where("k = 1"), dim, "k").count() == 0


def test_assert_empty(spark):
    df = spark.createDataFrame([(0.5,)], "fraud_score double")
    quality.assert_empty(quality.fraud_score_out_of_range(df), "range")
    with pytest.raises(quality.QualityGateError):
        quality.assert_empty(quality.fraud_score_out_of_range(df.select((F.col("fraud_score") + 1).alias("fraud_score"))), "range")
