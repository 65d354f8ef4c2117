"""Readers for raw files and table layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerlens import schemas as S


def landing_path(root: str, day: str, hour: int | str, entity: str = "transactions") -> str:
    """Folder of one landed hour: raw/{entity}/yyyy/mm/dd/HH/."""
    try:
        d = dt.date.fromisoformat(day)
    except ValueError as exc:
        raise ValueError(f"expected a date as YYYY-MM-DD, got {day!r}") from exc
    return f"{root.rstrip('/')}/raw/{entity}/{d:%Y/%m/%d}/{int(hour):02d}/"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()


def landed_folders(spark: SparkSession, root: str, day: str, hours: list | None = None, entity: str = "transactions") -> list[str]:
    """The landing folders of a day that exist; without `hours`, all of them. One listing a day."""
    there = _landed_hours(spark, root, day, entity)
    return [landing_path(root, day, h, entity) for h in (hours if hours is not None else range(24)) if int(h) in there]


def _landed_hours(spark: SparkSession, root: str, day: str, entity: str) -> set[int]:
    names = file_names(spark, landing_path(root, day, 0, entity).rstrip("/").rpartition("/")[0])
    return {int(n) for n in names if n.isdigit() and len(n) == 2}


def missing_folders(spark: SparkSession, root: str, day: str, hours: list, entity: str = "transactions") -> list[str]:
    """Of the hours asked for, the landing folders that do not exist."""
    there = _landed_hours(spark, root, day, entity)
    return [landing_path(root, day, h, entity) for h in hours if int(h) not in there]


def landing_day(source_file: str | Column) -> Column:
    """The day of a landing folder, from a file's path."""
    return F.to_date(F.regexp_replace(F.regexp_extract(source_file, r"/(\d{4}/\d{2}/\d{2})/\d{2}/", 1), "/", "-"))


def scan_raw_jsonl(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per text line with the file it came from; several hours in one read."""
    return spark.read.text(paths).select(F.col("value").alias("raw_data"), F.col("_metadata.file_path").alias("source_file"))


def scan_entity(spark: SparkSession, path: str | list[str], entity: str) -> DataFrame:
    """Typed reader of a raw entity: users, merchants, transactions or disputes."""
    if entity not in S.RAW_ENTITIES:
        raise ValueError(f"unknown entity {entity!r}, expected one of {sorted(S.RAW_ENTITIES)}")
    return spark.read.schema(S.RAW_ENTITIES[entity]).json(path)


def scan_layer(spark: SparkSession, root: str, date: str | list[str] = "all", schema: T.StructType | None = None) -> DataFrame:
    """A layer, or some of its days; the date filter prunes partitions.

    With a schema, a layer that does not exist yet reads as empty.
    """
    df = scan_or_empty(spark, root, schema)
    if date == "all":
        return df
    days = [date] if isinstance(date, str) else list(date)
    return df.where(F.col("partition_date").isin([dt.date.fromisoformat(str(d)) for d in days]))


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table, or an empty one where the path does not exist.

    Without `schema`, the files give it and the path has to exist.
    """
    if schema is None:
        return spark.read.parquet(path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def scan_features(silver: DataFrame, features: list[str] | None = None) -> DataFrame:
    return silver.select("transaction_id", "user_id", *(features or S.FEATURE_COLUMNS))
