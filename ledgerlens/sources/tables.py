"""The transaction shape over the shared benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens import schemas as S

# Fixed instant of the queries: the day after the last event.
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as payment transactions."""
    raw = table(spark, sf_dir, "events")
    # A generator, so that predicates on k do not parse the JSON again.
    events = raw.select("*", F.json_tuple("props", "k").alias("k")).withColumn("k", F.col("k").cast("int"))
    kind = F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    parity = F.pmod("event_id", F.lit(10))
    return events.select(
        F.col("event_id").alias("transaction_id"), "user_id", F.col("k").cast("long").alias("merchant_id"),
        F.col("value").cast(S.AMOUNT).alias("amount"), _pick(F.pmod("user_id", F.lit(7)), S.CURRENCIES).alias("currency"),
        ts.alias("timestamp"),
        F.when(kind == "purchase", "purchase").when(kind == "click", "transfer").when(kind == "view", "withdrawal")
        .otherwise("refund").alias("transaction_type"),
        F.when(kind == "error", "failed").when(parity == 0, "pending").when(parity == 1, "disputed")
        .otherwise("completed").alias("status"),
        _pick(F.pmod("k", F.lit(4)), S.PAYMENT_METHODS).alias("payment_method"),
        F.concat(F.lit("dev-"), F.lpad(F.lower(F.hex("user_id")), 8, "0")).alias("device_id"),
        F.concat(F.lit("10.0."), F.pmod("user_id", F.lit(256)).cast("string"), F.lit("."), F.col("k").cast("string")).alias("ip_address"),
        (F.pmod("k", F.lit(25)) * 5 - 60).cast(S.COORDINATE).alias("latitude"),
        (F.pmod("k", F.lit(25)) * 14 - 168).cast(S.COORDINATE).alias("longitude"),
        F.pmod("k", F.lit(25)).cast("string").alias("country_code"), F.lit("5411").alias("mcc_code"),
        F.to_date(ts).alias("partition_date"), (kind == "error").alias("is_fraud"))


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with planted faults: missing users, negative amounts, unknown
    currencies, coordinates out of range or missing."""
    tid = F.col("transaction_id")

    def every(n):
        return F.pmod(tid, F.lit(n)) == 0
    return transactions(spark, sf_dir).withColumns({
        "user_id": F.when(~every(90), F.col("user_id")),
        "amount": F.when(every(50), (-F.col("amount")).cast(S.AMOUNT)).otherwise(F.col("amount")),
        "currency": F.when(every(70), "XYZ").otherwise(F.col("currency")),
        "latitude": F.when(every(110), F.lit(91).cast(S.COORDINATE)).when(~every(30), F.col("latitude")),
    })


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.sha2("c_name", 256).alias("email_hash"),
        F.when(balance < 0, "high").when(balance < 3000, "medium").otherwise("low").alias("risk_tier"),
        F.col("c_nationkey").cast("string").alias("country_code"))


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("merchant_id"), F.col("p_name").alias("merchant_name"), F.lit("5411").alias("mcc_code"),
        F.col("p_brand").alias("country_code"))


def raw_json(rows: DataFrame) -> DataFrame:
    """Transactions as landed JSON lines."""
    names = S.RAW_TRANSACTION.names
    text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) if c in ("transaction_id", "user_id", "merchant_id", "timestamp")
                                else F.col(c) for c in names]))
    return rows.select(text.alias("value"), "transaction_id", "timestamp")


def land_transactions(rows: DataFrame, root: str, hours_per_folder: int = 6) -> None:
    """Write transactions as JSON lines, gzipped, into landing folders yyyy/mm/dd/HH."""
    spark = rows.sparkSession
    hour = (F.floor(F.hour("timestamp") / hours_per_folder) * hours_per_folder).cast("int")
    slot = F.concat_ws("-", F.date_format("timestamp", "yyyy-MM-dd"), F.lpad(hour.cast("string"), 2, "0"))
    lines = raw_json(rows).select("value", slot.alias("slot"), F.pmod("transaction_id", F.lit(4)).alias("_part"))
    staging = f"{root}/landing"
    lines.repartition("slot", "_part").drop("_part").write.partitionBy("slot").option("compression", "gzip").text(staging)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(staging).getFileSystem(conf)
    for entry in fs.listStatus(path(staging)):
        name = entry.getPath().getName()
        if name.startswith("slot="):
            folder = path(f"{root}/raw/transactions/{name[5:].replace('-', '/')}")
            fs.mkdirs(folder.getParent())
            fs.rename(entry.getPath(), folder)
