"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on. The number of shuffle partitions
# stays with the cluster: AQE coalesces small partitions and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}
# Tables are narrow on disk and wide in memory (JSON lines, hashes, sort rows), so a scan task of Spark's 128 MB does not
# fit a core's share of memory and spills. Used where the session has Spark's own value; a value somebody set stays.
SPLIT = "spark.sql.files.maxPartitionBytes"
SPARKS_SPLIT, SPLIT_BYTES = 128 * 2**20, "8m"


def get_spark(app_name: str = "ledgerlens", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SPLIT)) == SPARKS_SPLIT:
        spark.conf.set(SPLIT, SPLIT_BYTES)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster.

    Where none is set, one process on one machine gets a private folder; a cluster is refused,
    since its executors would each write to their own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ledgerlens-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark)}/ledgerlens/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator:
    """Gives `materialize_scratch` for tables that are deleted when the block ends."""
    made = []

    def keep(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
        made.append(scratch_path(spark, label))
        return materialize_scratch(df, label, partition_by, made[-1])
    try:
        yield keep
    finally:
        for path in made:
            drop_path(spark, path)


def materialize_scratch(df: DataFrame, label: str, partition_by: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Write a DataFrame once to the shared folder and read it back.

    Cuts the lineage like a checkpoint but keeps the data columnar, so readers
    still prune columns; it does not depend on the executors that wrote it.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
