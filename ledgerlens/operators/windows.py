"""Window operators: newest row per key, rolling counts, previous row, rolling sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.scalars import as_col
from ledgerlens.operators.skew import HEAVY_ROWS, MOST_LISTED, count_per_key, in_pieces, lag_in_groups, lag_in_pieces
from ledgerlens.session import materialize_scratch


def distinct_on(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark limits each key to one row before the shuffle (WindowGroupLimit), so a
    key with very many copies does not gather in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def rolling_count_per_second(df: DataFrame, key: str, ts: str, counted: str, seconds: int, tile_seconds: int | None = None) -> DataFrame:
    """Rows of a key in the last `seconds` seconds (both ends included), per second that has rows.

    Result: (key, _second, rolling). The rows are first counted per key and second,
    on the map side too. The window then runs per (key, tile of time); a second near
    the end of a tile is copied into the next one, because windows that end there
    reach back to it. A window group therefore never exceeds tile + seconds + 1
    rows, however many rows the key has.
    """
    tile = max(tile_seconds or 10 * seconds, seconds, 1)
    per_second = (df.select(F.col(key), F.col(ts).cast("timestamp").cast("long").alias("_second"), F.col(counted).alias("_counted"))
                  .groupBy(key, "_second").agg(F.count("_counted").alias("_n")))
    home = F.floor(F.col("_second") / tile)
    spills = F.col("_second") + seconds >= (home + 1) * tile
    tiled = per_second.withColumn("_home", home).withColumn(
        "_tile", F.explode(F.when(spills, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))))
    w = Window.partitionBy(key, "_tile").orderBy("_second").rangeBetween(-seconds, 0)
    return (tiled.withColumn("rolling", F.sum("_n").over(w))
            .where(F.col("_home") == F.col("_tile"))
            .select(key, "_second", "rolling"))


def rolling_count(df: DataFrame, key: str = "user_id", ts: str = "timestamp", counted: str = "transaction_id",
                  seconds: int = 60, output: str = "rolling_count", at_least: int | None = None,
                  tile_seconds: int | None = None) -> DataFrame:
    """Every row with the number of rows of its key in the last `seconds` seconds, NULL for a row without key or time.

    With `at_least`, only rows that reach that number; the filter runs before the
    rows are joined back, so the join's small side is the hits alone.
    """
    counts = rolling_count_per_second(df, key, ts, counted, seconds, tile_seconds)
    if at_least is not None:
        counts = counts.where(F.col("rolling") >= at_least)
    counts = counts.withColumnRenamed("rolling", output)
    rows = df.withColumn("_second", F.col(ts).cast("timestamp").cast("long"))
    return rows.join(counts, [key, "_second"], "left" if at_least is None else "inner").drop("_second")


def lag_previous(df: DataFrame, key: str, ts: str, tie_break: str, columns: list[str], output: str = "_prev",
                 heavy_rows: int = HEAVY_ROWS, store=materialize_scratch) -> DataFrame:
    """Add a struct of the previous row's columns per key, in (ts, tie_break) order; rows without key count as one key's.

    Keys below `heavy_rows` rows get one window each. The rows of the others are cut into pieces of about that many rows, and
    each piece's last row is carried over. The list of these keys (at most rows / heavy_rows) is worked out first, which
    reads the key column once; where it is empty, the plan is the plain window's.
    """
    counts = count_per_key(df, key).where(F.col("n") >= heavy_rows)
    heavy = store(counts, "heavy-keys")
    keys, rows = heavy.agg(F.count("*"), F.sum("n")).first()
    order = [ts, tie_break]
    if not keys:
        return lag_in_groups(df, key, order, columns, output)
    listed = heavy.select(F.col(key).alias("_heavy_key"))
    listed = F.broadcast(listed) if keys <= MOST_LISTED else listed
    on = F.col(key).eqNullSafe(F.col("_heavy_key"))
    pieces = in_pieces(df.join(listed, on, "left_semi"), [key, *order], -(-rows // heavy_rows), store)
    light = lag_in_groups(df.join(listed, on, "left_anti"), key, order, columns, output)
    return light.unionByName(lag_in_pieces(pieces, key, order, columns, output))


def rolling_over_days(df: DataFrame, value: str | Column, agg, rows: int, day: str, calendar_days: bool = False) -> Column:
    """A rolling aggregate over a table that already holds one row per day.

    Counts rows, not days, unless `calendar_days`. The window has no partition key:
    its input is one row per day, so it stays small whatever the fact table holds.
    """
    if calendar_days:
        w = Window.orderBy(F.unix_date(day)).rangeBetween(-(rows - 1), 0)
    else:
        w = Window.orderBy(day).rowsBetween(-(rows - 1), 0)
    return agg(as_col(value)).over(w)
