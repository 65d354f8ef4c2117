import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
           "spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


AS_OF = "2026-04-30 00:00:00"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def raw_row(**changes) -> dict:
    """A transaction that passes every rule, as landed."""
    row = {
        "transaction_id": "txn-001", "user_id": "user-001", "merchant_id": "merchant-001", "amount": "100.00", "currency": "USD",
        "timestamp": "2026-04-24T10:00:00", "transaction_type": "purchase", "status": "completed", "payment_method": "card",
        "device_id": "dev-1", "ip_address": "192.168.1.1", "latitude": "19.43", "longitude": "-99.13", "country_code": "MX", "mcc_code": "5411",
    }
    return {**row, **changes}


RAW_DDL = ", ".join(f"{c} string" for c in raw_row())


def raw_frame(spark, *rows: dict):
    return spark.createDataFrame([tuple(r.values()) for r in rows], RAW_DDL)
