"""Joins and per-key ordering when one key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A key below this number of rows fits one task and is never spread. There are at most
# rows / HEAVY_ROWS heavy keys (200,000 for 10^12 rows), so their list can be broadcast.
HEAVY_ROWS = 5_000_000
# Up to so many listed keys are broadcast by hand; a longer list is left to Spark's own limits.
MOST_LISTED = 200_000


def heavy_keys(counts: DataFrame, key: str, n: str = "n", *, min_rows: int = HEAVY_ROWS) -> DataFrame:
    """All keys of a (key, row count) table with at least `min_rows` rows, and the tasks that each needs."""
    return counts.where((F.col(n) >= min_rows) & F.col(key).isNotNull()).select(key, F.ceil(F.col(n) / min_rows).cast("int").alias("parts"))


def count_per_key(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str, heavy: DataFrame, spread_by: Column, null_parts: int = 64,
                hot: Column | None = None) -> DataFrame:
    """Equi join where each heavy key of `left` goes to as many tasks as its row count asks for.

    `right` holds one row per key; only its heavy rows are copied. The list of heavy keys
    is bounded and broadcast. `hot` may give the copies of a right row from that row alone
    (the list's number, NULL for light keys), which saves looking the list up there.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join keeps every left row once, so it does inner and left joins only")
    marks = F.broadcast(heavy.select(F.col(key).alias("_heavy_key"), F.col("parts").alias("_parts")))
    # NULL keys match nothing, but a left join keeps them and would shuffle them to one task.
    parts = F.coalesce("_parts", F.when(F.col(key).isNull(), F.lit(null_parts)), F.lit(1))
    spread = (left.join(marks, F.col(key) == F.col("_heavy_key"), "left")
              .withColumn("_salt", F.pmod(F.xxhash64(spread_by), parts).cast("int"))
              .drop("_heavy_key", "_parts"))
    marked = right.withColumn("_parts", hot) if hot is not None else right.join(marks, F.col(key) == F.col("_heavy_key"), "left").drop("_heavy_key")
    copies = marked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return spread.join(copies, [key, "_salt"], how).drop("_salt")


def in_pieces(df: DataFrame, order: list[str], parts: int, store) -> DataFrame:
    """The rows with `_piece`: their number among `parts` stretches of about equal row count of the whole order.

    Stretches follow the full order (key, time, tie-break), so neither a key nor one moment of it holds rows together; only
    rows alike in all of `order` stay in one stretch. The bounds come from a sample and steer balance, not results; the
    rows are stored once, so that everything that follows sees the same stretches.
    """
    return store(df.repartitionByRange(parts, *order).withColumn("_piece", F.spark_partition_id()), "pieces")


def lag_in_pieces(rows: DataFrame, key: str, order: list[str], columns: list[str], output: str = "_prev") -> DataFrame:
    """The previous row's columns per key in the given order, for rows with a `_piece`, one piece of a key to a task.

    Two levels: the window runs per key and piece, and the first row of a piece gets its predecessor from a scan over the
    pieces' last rows (one row per key and piece, whatever they hold), carried into the key's next piece.
    """
    last = rows.groupBy(key, "_piece").agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
    following = F.lead("_piece").over(Window.partitionBy(key).orderBy("_piece"))
    carried = last.withColumn("_piece", following).where(F.col("_piece").isNotNull()).select(key, "_piece", "_last.*", F.lit(True).alias("_carried"))

    w = Window.partitionBy(key, "_piece").orderBy(F.col("_carried").desc(), *[F.col(c) for c in order])
    lagged = _lagged(w, columns)
    linked = (rows.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
              .withColumns({**lagged, "_linked": F.lag("_carried").over(w)}).where(~F.col("_carried")))
    return linked.select(*[c for c in rows.columns if c != "_piece"], _previous(columns).alias(output))


def lag_in_groups(df: DataFrame, key: str, order: list[str], columns: list[str], output: str = "_prev") -> DataFrame:
    """The same with one window per key."""
    w = Window.partitionBy(key).orderBy(*order)
    linked = df.withColumns({**_lagged(w, columns), "_linked": F.lag(F.lit(True)).over(w)})
    return linked.select(*df.columns, _previous(columns).alias(output))


def _lagged(w, columns: list[str]) -> dict[str, Column]:
    # One lag per column: a struct built before the window would be shuffled as well.
    return {f"_lag_{c}": F.lag(c).over(w) for c in columns}


def _previous(columns: list[str]) -> Column:
    return F.when(F.col("_linked").isNotNull(), F.struct(*[F.col(f"_lag_{c}").alias(c) for c in columns]))
