"""Quality checks over whole tables: one aggregate pass for all row checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens import schemas as S


class QualityGateError(RuntimeError):
    """A suite failed; `failed` holds the names of the checks."""

    def __init__(self, label: str, failed: list[str]):
        super().__init__(f"quality gate failed for {label}: {', '.join(failed)}")
        self.failed = failed


@dataclass(frozen=True)
class RowCheck:
    """Fails for every row where `violation` is TRUE."""

    name: str
    violation: Column


@dataclass(frozen=True)
class TableCheck:
    """Fails when the aggregate `problems` is above zero."""

    name: str
    problems: Column


@dataclass(frozen=True)
class KeyCheck:
    """Fails for every row whose key occurs more than once."""

    name: str
    key: str


def expect_not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null({column})", F.col(column).isNull())


def expect_between(column: str, low, high) -> RowCheck:
    return RowCheck(f"between({column})", ~F.col(column).between(F.lit(str(low)).cast("decimal(20,4)"), F.lit(str(high)).cast("decimal(20,4)")))


def expect_in_set(column: str, values: list) -> RowCheck:
    return RowCheck(f"in_set({column})", ~F.col(column).isin(values))


def expect_length(column: str, length: int) -> RowCheck:
    return RowCheck(f"length({column})", F.length(column) != length)


def expect_expression(name: str, condition: Column) -> RowCheck:
    return RowCheck(f"expression({name})", ~condition)


def expect_min_rows(n: int) -> TableCheck:
    return TableCheck(f"min_rows({n})", F.greatest(F.lit(n) - F.count("*"), F.lit(0)))


def expect_values_present(column: str, values: list[str]) -> list[TableCheck]:
    """Each value occurs at least once; answered inside the suite's one pass."""
    return [TableCheck(f"present({column}={v})", F.when(F.count_if(F.col(column) == v) == 0, 1).otherwise(0)) for v in values]


def expect_unique(key: str) -> KeyCheck:
    return KeyCheck(f"unique({key})", key)


def missing_values(df: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Expected values that never occur. Distinct values are few, whatever the table's size."""
    return expected.join(df.select(F.col(column).alias(expected.columns[0])).distinct(), expected.columns[0], "left_anti")


def expect_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Which required columns exist; answered from the schema alone."""
    wanted = columns or S.SILVER_REQUIRED_COLUMNS
    return df.sparkSession.createDataFrame([(c, c in df.columns) for c in wanted], "column_name string, present boolean")


def forbid_column(df: DataFrame, column: str = "ip_address") -> DataFrame:
    """Pass the table through, or fail if it still carries a personal column."""
    if column in df.columns:
        raise QualityGateError("personal data", [f"forbidden({column})"])
    return df


def duplicate_keys(df: DataFrame, key: str, current_only: bool = False) -> DataFrame:
    rows = df.where("is_current") if current_only else df
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def orphan_keys(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Key values without a dimension row, with their row counts.

    Facts collapse to one row per key first, so a hot key costs no more than a rare one.
    """
    counted = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(dim.select(F.col(dim_key or key).alias(key)), key, "left_anti")


def orphan_facts(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """The failing fact rows; the keys that fail are found before any fact row moves."""
    resolved = facts.join(orphan_keys(facts, dim, key, dim_key).select(key), key, "left_semi")
    return resolved.unionByName(facts.where(F.col(key).isNull()))


def expect_foreign_key(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    lost = orphan_keys(facts, dim, key, dim_key)
    return lost.agg(F.lit(f"foreign_key({key})").alias("check"), F.coalesce(F.sum("rows"), F.lit(0)).alias("failed"),
                    F.count("*").alias("failed_keys"))


def assert_empty(df: DataFrame, label: str) -> None:
    """A test query passes when it returns nothing; looks for one row only."""
    if not df.isEmpty():
        raise QualityGateError(label, [label])


def fraud_score_out_of_range(facts: DataFrame) -> DataFrame:
    return facts.where((F.col("fraud_score") < 0) | (F.col("fraud_score") > 1))


def non_positive_amounts(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("amount") <= 0)


def run_checks(df: DataFrame, checks: list) -> DataFrame:
    """Result of every check: (check, evaluated, failed, success).

    All row and table checks share one aggregate; each unique key adds one grouped
    pass over that key column. Nothing is sampled.
    """
    flat = [c for item in checks for c in (item if isinstance(item, list) else [item])]
    inline = [c for c in flat if not isinstance(c, KeyCheck)]
    parts = []
    if inline:
        measures = [
            (F.count_if(c.violation) if isinstance(c, RowCheck) else c.problems).cast("long").alias(f"_c{i}") for i, c in enumerate(inline)]
        totals = df.agg(F.count("*").alias("_rows"), *measures)
        rows = F.array(*[F.struct(F.lit(c.name).alias("check"), F.col("_rows").alias("evaluated"), F.col(f"_c{i}").alias("failed"))
                         for i, c in enumerate(inline)])
        parts.append(totals.select(F.inline(rows)))
    for c in (c for c in flat if isinstance(c, KeyCheck)):
        per_key = df.where(F.col(c.key).isNotNull()).groupBy(c.key).agg(F.count("*").alias("_n"))
        parts.append(per_key.agg(
            F.lit(c.name).alias("check"), F.coalesce(F.sum("_n"), F.lit(0)).alias("evaluated"),
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("failed")))
    out, *rest = parts
    for part in rest:
        out = out.unionByName(part)
    return out.withColumn("success", F.col("failed") == 0)


def silver_suite() -> list:
    return [
        *[expect_not_null(c) for c in S.SILVER_NOT_NULL_COLUMNS],
        expect_unique("transaction_id"),
        expect_between("amount", "0.01", "1000000"),
        expect_in_set("currency", S.CURRENCIES),
        expect_in_set("transaction_type", S.TRANSACTION_TYPES),
        expect_in_set("status", S.STATUSES),
        expect_in_set("payment_method", S.PAYMENT_METHODS),
        expect_between("latitude", -90, 90),
        expect_between("longitude", -180, 180),
        expect_length("ip_address_hash", 64),
    ]


def staging_suite() -> dict[str, list]:
    """Checks of the three staging tables before modelling."""
    return {
        "transactions": [*[expect_not_null(c) for c in ("transaction_id", "user_id", "merchant_id", "amount")],
                         expect_expression("amount > 0", F.col("amount") > 0)],
        "users": [expect_not_null("user_id")],
        "merchants": [expect_not_null("merchant_id")],
    }


def fact_suite() -> list:
    return [
        *[expect_not_null(c) for c in ("transaction_id", "user_sk", "merchant_sk", "time_sk", "amount")],
        expect_unique("transaction_id"),
        expect_expression("amount > 0", F.col("amount") > 0),
        expect_expression("fraud_score in 0..1", F.col("fraud_score").between(0, 1)),
    ]


def user_suite() -> list:
    return [*[expect_not_null(c) for c in ("user_sk", "user_id")], expect_unique("user_sk"), expect_unique("user_id"),
            expect_in_set("risk_tier", S.RISK_TIERS)]


def mart_suites() -> dict[str, list]:
    return {
        "fraud_summary": [expect_not_null("alert_date"), expect_not_null("reason_code"), expect_not_null("alert_count"),
                          expect_in_set("reason_code", S.REASON_CODES), expect_expression("alert_count >= 0", F.col("alert_count") >= 0)],
        "executive_kpis": [expect_not_null("txn_date"), expect_unique("txn_date"),
                           expect_expression("fraud_rate_pct in 0..100", F.col("fraud_rate_pct").between(0, 100))],
    }


def check_staging(transactions: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    tables = {"transactions": transactions, "users": users, "merchants": merchants}
    out = None
    for name, checks in staging_suite().items():
        part = run_checks(tables[name], checks).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def run_suite(df: DataFrame, checks: list, *, label: str = "table", required: list[str] | None = None,
              forbidden: tuple[str, ...] = (), raise_on_failure: bool = True) -> dict:
    """Run a suite and stop the caller if a check fails.

    Returns {success, evaluated, failed, results}; the result rows are one per check.
    """
    absent = [f"column({c})" for c in (required or []) if c not in df.columns]
    present = [f"forbidden({c})" for c in forbidden if c in df.columns]
    if absent or present:
        raise QualityGateError(label, absent + present)
    results = run_checks(df, checks).collect()  # one row per check
    failed = [r["check"] for r in results if not r["success"]]
    if failed and raise_on_failure:
        raise QualityGateError(label, failed)
    return {"success": not failed, "evaluated": len(results), "failed": failed, "results": [r.asDict() for r in results]}
