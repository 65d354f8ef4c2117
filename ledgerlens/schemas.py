"""Declared schemas and value domains."""

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 2)
COORDINATE = T.DecimalType(9, 6)
SCORE = T.DecimalType(5, 4)

# Fixed values of the data contract.
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD", "MXN", "BRL"]
TRANSACTION_TYPES = ["purchase", "refund", "transfer", "withdrawal"]
STATUSES = ["completed", "pending", "failed", "disputed"]
PAYMENT_METHODS = ["card", "bank_transfer", "wallet", "crypto"]
RISK_TIERS = ["low", "medium", "high"]
ALERT_STATUSES = ["open", "investigating", "closed_false_positive", "confirmed_fraud"]
REASON_CODES = ["VELOCITY_ATTACK", "HIGH_AMOUNT", "GEO_IMPOSSIBLE", "ML_ANOMALY"]


_TYPES = {
    "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "decimal(28,2)": T.DecimalType(28, 2), "decimal(18,2)": AMOUNT, "decimal(9,6)": COORDINATE, "decimal(5,4)": SCORE,
}


def _struct(spec: str, required: str = "") -> T.StructType:
    """A StructType from "name type, ..."; columns named in `required` are not nullable.

    Built without `fromDDL`, which needs a running session at import time.
    """
    needed = set(required.split())
    pairs = [item.split() for item in spec.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind], name not in needed) for name, kind in pairs])


# Coordinates are parsed as decimals: a float would lose digits of 139.6503.
RAW_TRANSACTION = _struct(
    "transaction_id string, user_id string, merchant_id string, amount decimal(18,2), currency string, "
    "timestamp string, transaction_type string, status string, payment_method string, device_id string, "
    "ip_address string, latitude decimal(9,6), longitude decimal(9,6), country_code string, mcc_code string"
)

RAW_USER = _struct(
    "user_id string, email string, email_hash string, registration_date date, risk_tier string, "
    "country_code string, is_active boolean"
)

RAW_MERCHANT = _struct(
    "merchant_id string, merchant_name string, mcc_code string, country_code string, "
    "risk_score decimal(5,4), is_active boolean"
)

RAW_DISPUTE = _struct(
    "dispute_id string, transaction_id string, user_id string, reason string, status string, "
    "opened_at timestamp, resolved_at timestamp, resolution_notes string"
)

RAW_ENTITIES = {
    "transactions": RAW_TRANSACTION,
    "users": RAW_USER,
    "merchants": RAW_MERCHANT,
    "disputes": RAW_DISPUTE,
}

BRONZE = _struct(
    "raw_data string, ingestion_timestamp timestamp, source_file string, bronze_batch_id string, "
    "partition_date date",
    required="raw_data ingestion_timestamp source_file bronze_batch_id partition_date",
)

SILVER = _struct(
    "transaction_id string, user_id string, merchant_id string, amount decimal(18,2), currency string, "
    "timestamp timestamp, transaction_type string, status string, payment_method string, device_id string, "
    "ip_address_hash string, latitude decimal(9,6), longitude decimal(9,6), country_code string, "
    "mcc_code string, ingestion_timestamp timestamp, source_file string, partition_date date, "
    "_silver_processed_at timestamp",
    required="transaction_id user_id merchant_id amount currency timestamp transaction_type status "
    "payment_method _silver_processed_at",
)

ALERTS = _struct(
    "alert_id string, transaction_id string, alert_timestamp timestamp, reason_code string, "
    "severity_score decimal(5,4), description string, status string, ml_score decimal(5,4), "
    "rule_score decimal(5,4), created_at timestamp, alert_date date"
)

FACTS = _struct(
    "transaction_id string, user_sk string, merchant_sk string, amount decimal(18,2), currency string, "
    "transaction_type string, status string, payment_method string, is_flagged_fraud boolean, "
    "fraud_score decimal(5,4), latitude decimal(9,6), longitude decimal(9,6), country_code string, "
    "created_at timestamp, time_sk int"
)

STAGED_LOG = _struct("transaction_id string, time_sk int, loaded_at timestamp, load_date date")

LOAD_LEDGER = _struct("hour timestamp, rows bigint, flagged bigint, done_rows bigint, done_amount decimal(28,2), time_sk int")

# What a user's newest transaction of a day says about them; the history is made of these rows.
USERS_DAILY = _struct("user_id string, email_hash string, risk_tier string, country_code string, partition_date date")

USER_HISTORY = _struct(
    "user_id string, email_hash string, risk_tier string, country_code string, updated_at timestamp, "
    "valid_from timestamp, valid_to timestamp, scd_id string"
)

SILVER_REQUIRED_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "amount", "currency", "timestamp", "transaction_type",
    "status", "payment_method", "ip_address_hash", "_silver_processed_at",
]
SILVER_NOT_NULL_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "amount", "timestamp", "_silver_processed_at",
]
FEATURE_COLUMNS = ["amount", "latitude", "longitude"]
