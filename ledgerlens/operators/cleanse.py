"""Parse, cast, hash, validate and deduplicate raw transactions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens import schemas as S
from ledgerlens.functions.scalars import as_col, day_literal, instant, percent
from ledgerlens.operators.windows import distinct_on


def drop_blank_lines(df: DataFrame, column: str = "raw_data") -> DataFrame:
    return df.where(F.length(column) > 0)  # NULL has no length, so it goes too


def bronze_metadata(df: DataFrame, *, as_of, partition_date, batch_id: str) -> DataFrame:
    """Stamp a run: when, for which day, by which batch."""
    return df.withColumns({
        "ingestion_timestamp": instant(as_of),
        "partition_date": day_literal(partition_date),
        "bronze_batch_id": F.lit(batch_id),
    })


def parse_raw_json(df: DataFrame, schema: T.StructType = S.RAW_TRANSACTION, *, keep_metadata: bool = False) -> DataFrame:
    """Expand the JSON text into typed columns.

    A malformed line becomes a row of NULLs, which validation rejects later.
    `keep_metadata` adds the free-form `metadata` object as a string map.
    """
    if keep_metadata:
        schema = T.StructType([*schema.fields, T.StructField("metadata", T.MapType(T.StringType(), T.StringType()))])
    carried = [c for c in ("ingestion_timestamp", "source_file", "partition_date") if c in df.columns]
    parsed = F.from_json("raw_data", schema, {"mode": "PERMISSIVE"})
    # As a generator the parser runs once per row. As a projection it would be copied
    # into every predicate that validation puts on a field, and run once for each.
    return df.select(F.inline(F.array(parsed)), *carried)


def cast_types(df: DataFrame) -> DataFrame:
    """Declared types; text that does not fit becomes NULL instead of failing the job."""
    targets = {"amount": S.AMOUNT, "timestamp": T.TimestampType(), "latitude": S.COORDINATE, "longitude": S.COORDINATE}
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in targets.items()})


def hash_pii(df: DataFrame, column: str = "ip_address", output: str | None = None) -> DataFrame:
    """Replace a column by its SHA-256 hex digest."""
    digest = F.sha2(F.col(column).cast("binary"), 256)
    return df.withColumn(output or f"{column}_hash", digest).drop(column)


def stamp_processed(df: DataFrame, as_of) -> DataFrame:
    return df.withColumn("_silver_processed_at", instant(as_of))


def validation_rules(as_of, columns: list[str] | None = None, max_age_days: int | None = None) -> dict[str, Column]:
    """The row rules by name; each is TRUE or FALSE, never NULL.

    With `columns`, rules on absent columns are left out.
    """
    def filled(name):
        return F.col(name).isNotNull()

    def within(name, low, high):
        return F.col(name).isNull() | F.col(name).between(low, high)

    def member(name, values):
        return F.coalesce(F.col(name).isin(values), F.lit(False))

    rules = {f"{name}_present": (name, filled(name)) for name in ("transaction_id", "user_id", "merchant_id", "amount", "timestamp")}
    rules["amount_positive"] = ("amount", F.coalesce(F.col("amount") > 0, F.lit(False)))
    rules["timestamp_not_future"] = ("timestamp", F.coalesce(F.col("timestamp") <= instant(as_of), F.lit(False)))
    rules["currency_known"] = ("currency", member("currency", S.CURRENCIES))
    rules["transaction_type_known"] = ("transaction_type", member("transaction_type", S.TRANSACTION_TYPES))
    rules["status_known"] = ("status", member("status", S.STATUSES))
    rules["payment_method_known"] = ("payment_method", member("payment_method", S.PAYMENT_METHODS))
    rules["latitude_in_range"] = ("latitude", within("latitude", -90, 90))
    rules["longitude_in_range"] = ("longitude", within("longitude", -180, 180))
    if max_age_days is not None:
        oldest = instant(as_of) - F.make_dt_interval(F.lit(max_age_days))
        rules["timestamp_recent"] = ("timestamp", F.coalesce(F.col("timestamp") >= oldest, F.lit(False)))
    return {name: rule for name, (column, rule) in rules.items() if columns is None or column in columns}


def is_valid(rules: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, rules.values())


def validate_rows(df: DataFrame, as_of, **options) -> DataFrame:
    return df.where(is_valid(validation_rules(as_of, df.columns, **options)))


def reject_counts(df: DataFrame, as_of) -> DataFrame:
    """How many rows break each rule, one pass; a row may break several."""
    rules = validation_rules(as_of, df.columns)
    totals = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("rejected")) for name in rules]
    return totals.select(F.inline(F.array(*pairs)))


def reject_stats(df: DataFrame, as_of, key: str = "transaction_id") -> DataFrame:
    """Input, output and rejected rows; invalid rows and surplus copies counted apart."""
    ok = is_valid(validation_rules(as_of, df.columns))
    # Copies collapse per key on the map side first; a key held by a third of all
    # rows leaves each task as one row.
    per_key = df.select(F.when(ok, F.col(key)).alias("_key"), ok.alias("_ok")).groupBy("_key", "_ok").agg(F.count("*").alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    valid = F.coalesce(F.sum(F.when(F.col("_ok"), F.col("_n"))), F.lit(0))
    output = F.count_if("_ok")
    return per_key.agg(
        total.alias("input_rows"),
        output.alias("output_rows"),
        (total - output).alias("rejected_rows"),
        (total - valid).alias("invalid_rows"),
        (valid - output).alias("duplicate_rows"),
        percent(total - output, total, 2).alias("rejection_pct"),
    )


def dedup_latest(df: DataFrame, key: str | list[str] = "transaction_id", order: str = "ingestion_timestamp",
                 tie_break: list[str] | None = None) -> DataFrame:
    """The newest row per key; ties fall to the given columns, newest first.

    Without `tie_break`, rows of equal age are ordered by a hash of the whole row,
    so a re-run keeps the same one.
    """
    ties = [F.col(c).desc_nulls_last() for c in tie_break] if tie_break else [F.xxhash64(*[F.col(c) for c in sorted(df.columns)])]
    return distinct_on(df, [key] if isinstance(key, str) else key, [F.col(order).desc_nulls_last(), *ties])


def enforce_schema(df: DataFrame, schema: T.StructType = S.SILVER) -> DataFrame:
    """Project onto a declared schema: order, names, types; a missing column fails.

    Not-null columns are asserted in the plan, so a NULL stops the job.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    out = []
    for field in schema:
        value = F.col(field.name).try_cast(field.dataType)
        if not field.nullable:
            value = F.when(value.isNotNull(), value).otherwise(
                F.raise_error(F.lit(f"{field.name} must not be NULL")).cast(field.dataType))
        out.append(as_col(value).alias(field.name))
    return df.select(*out)
