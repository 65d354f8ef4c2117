"""Which partitions of a table may hold a key, without reading the table.

The index is a folder of runs, `run=<n>-<buckets>/bucket=<b>`, each a set of (key, partition) pairs, bucketed by the key's hash. A load
looks up its keys in their buckets only, and adds the pairs that are new in a run of its own before it writes the table. So the
index always holds at least the table's pairs; pairs that are not true any more (rows that moved or went) only make a reader look
into a partition in vain. When there are more than MOST_RUNS runs they are merged into one, which also sets the number of
buckets anew by the number of pairs.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.session import drop_path
from ledgerlens.sources.scans import file_names, path_exists, touch

PAIRS_PER_BUCKET = 2_000_000
FEWEST_BUCKETS, MOST_BUCKETS = 16, 4096  # powers of two: a key's bucket among 16 follows from its bucket among 4096
MOST_RUNS = 16


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class KeyIndex:
    path: str
    key: str = "transaction_id"
    partition: str = "time_sk"

    def _runs(self, spark: SparkSession) -> list[tuple[int, int]]:
        """(number, buckets) of the runs."""
        names = [n.removeprefix("run=").split("-") for n in file_names(spark, self.path) if n.startswith("run=")]
        return sorted((int(run), int(buckets)) for run, buckets in names)

    def _folder(self, run: int, buckets: int) -> str:
        return f"{self.path.rstrip('/')}/run={run:08d}-{buckets}"

    def is_built(self, spark: SparkSession) -> bool:
        return path_exists(spark, f"{self.path.rstrip('/')}/_complete")

    def build(self, pairs: DataFrame) -> None:
        """A new index of a table's pairs; what stood there goes."""
        drop_path(pairs.sparkSession, self.path)
        self._write(pairs.dropDuplicates([self.key, self.partition]), 0, pairs.count())
        touch(pairs.sparkSession, f"{self.path.rstrip('/')}/_complete")

    def _write(self, pairs: DataFrame, run: int, number: int) -> None:
        buckets = FEWEST_BUCKETS
        while buckets < MOST_BUCKETS and buckets * PAIRS_PER_BUCKET < number:
            buckets *= 2
        rows = pairs.where(F.col(self.key).isNotNull()).select(self.key, self.partition, _bucket(self.key, buckets).alias("bucket"))
        # A bucket is one task's, and sorted, so that readers skip row groups too.
        rows.repartition("bucket").sortWithinPartitions("bucket", self.key).write.mode("overwrite").partitionBy("bucket").parquet(self._folder(run, buckets))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """(key, partition) pairs recorded for some keys; only files of their buckets are listed and read."""
        spark, runs = keys.sparkSession, self._runs(keys.sparkSession)
        columns = keys.select(self.key).where(F.col(self.key).isNotNull())
        finest = max((b for _, b in runs), default=FEWEST_BUCKETS)
        # At most MOST_BUCKETS numbers.
        wanted = {r[0] for r in columns.select(_bucket(self.key, finest).alias("b")).distinct().collect()}
        by_buckets: dict[int, list[str]] = defaultdict(list)
        for run, buckets in runs:
            there = {n.removeprefix("bucket=") for n in file_names(spark, self._folder(run, buckets))}
            by_buckets[buckets] += [f"{self._folder(run, buckets)}/bucket={b}" for b in sorted({w % buckets for w in wanted}) if str(b) in there]
        parts = [spark.read.parquet(*paths).select(self.key, self.partition) for paths in by_buckets.values() if paths]
        if not parts:
            return columns.limit(0).withColumn(self.partition, F.lit(None).cast("int"))
        found, *rest = parts
        for part in rest:
            found = found.unionByName(part)
        return found.join(columns, self.key, "left_semi").distinct()

    def add(self, pairs: DataFrame, known: DataFrame) -> None:
        """Record pairs; `known` is what lookup found for their keys."""
        spark = pairs.sparkSession
        fresh = pairs.select(self.key, self.partition).join(known, [self.key, self.partition], "left_anti").distinct()
        number = fresh.count()
        runs = self._runs(spark)
        if number:
            self._write(fresh, max((run for run, _ in runs), default=0) + 1, number)
        if len(runs) >= MOST_RUNS:
            self.merge(spark)

    def merge(self, spark: SparkSession) -> None:
        """All runs as one. Until the older ones are gone their pairs stand twice, which does no harm."""
        runs = self._runs(spark)
        folders = [self._folder(*r) for r in runs]
        pairs = spark.read.option("basePath", self.path).parquet(*folders).select(self.key, self.partition).distinct()
        self._write(pairs, runs[-1][0] + 1, pairs.count())
        for folder in folders:
            drop_path(spark, folder)
