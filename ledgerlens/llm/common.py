"""What several operators share: the shared folder, saved tables, word rules."""

from __future__ import annotations

import ctypes
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import checkpoint_dir, drop_path

# A word is a run of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WORDS_PER_SHINGLE = 5
# A batch of Spark's 64 MB (10,000 texts or sets of tokens come near) is held by the JVM, in buffers that double as they grow, and by the
# Python worker, once for each core. Neither is part of the heap.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARKS_BATCH, BATCH_BYTES = 64 * 2**20, "4m"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


# Spark deletes an action's shuffle files when the action has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """For actions on frames that no later action runs again: their shuffle files go at once. The session's own value comes back."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def write(df: DataFrame, path: str) -> DataFrame:
    with brief_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: later steps do not depend on executors that may be lost."""
    return write(df, new_folder(df.sparkSession, label))


class Scratch:
    """Saved tables of which the older ones are deleted as soon as nothing reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def save(self, df: DataFrame, label: str) -> DataFrame:
        path = new_folder(self.spark, label)
        self.paths.append(path)
        return write(df, path)

    def drop_all_but(self, last: int) -> None:
        while len(self.paths) > last:
            drop_path(self.spark, self.paths.pop(0))


def give_back() -> None:
    """Memory that this process has freed goes back to the system (where the C library can), instead of staying with it for later use."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches end at BATCH_BYTES where the session has Spark's own value; a value somebody set stays."""
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH)) == SPARKS_BATCH:
        spark.conf.set(BATCH, BATCH_BYTES)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """df.mapInArrow with little memory: batches are small, and a worker gives back its memory at the end of each task. Spark keeps
    workers for later tasks and operators, and what they hold idle adds to the executor's memory."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    small_batches(df.sparkSession)
    return df.mapInArrow(whole, schema)


_LIMB = 32


def exact_totals(df: DataFrame, per_task: Callable[[Iterator[pa.RecordBatch]], dict[int, int]]) -> dict[int, int]:
    """Sums of integers of any size: per_task gives a task's sum for each place; Spark adds them up in pieces of 32 bits.

    The result has one row per place and piece, so callers see to it that places are few (clusters, dimensions, pairs of dimensions).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, limb, value = [], [], []
        for at, total in per_task(batches).items():
            sign, total, k = (-1 if total < 0 else 1), abs(int(total)), 0
            while total:
                place.append(at), limb.append(k), value.append(sign * (total & ((1 << _LIMB) - 1)))
                total, k = total >> _LIMB, k + 1
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())], ["place", "limb", "value"])

    found = df.mapInArrow(run, "place long, limb int, value long").groupBy("place", "limb").agg(F.sum("value").alias("value")).collect()
    out: dict[int, int] = defaultdict(int)
    for r in found:
        out[r.place] += r.value << (_LIMB * r.limb)
    return out


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list column, all of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def usable_vector(vector: Column, scale: int) -> Column:
    """Whether there is a vector and every entry, times scale, is a number whose floor a long holds: no null, no NaN, no infinity."""
    limit = F.lit(float(2**62) / scale)
    return F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < limit, F.lit(False))), F.lit(False))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
